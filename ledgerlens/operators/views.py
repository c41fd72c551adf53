"""Dashboard data preparation (D1–D17) as column expressions over operator results.

The dashboard itself (pages, charts, caching) is not rebuilt; what it computes
from the query results is: shares of a total, percent columns, display text,
long (unpivoted) series for charts, top-k and tail slices, and the status
tallies of the checks. All inputs here are already aggregated (one row per
month, gateway, reason, cohort or check), so the whole-frame windows below
work on bounded row counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expr import pct, r2_even, ratio
from ledgerlens.functions.fmt import DASH, fmt_inr, fmt_pct, pct_or_dash, text_or_dash
from ledgerlens.operators.checks import STATUSES, status_tally

# Fixed values that must equal the reference's display labels.
GATEWAY_REVENUE_LABELS = {"gateway": "Gateway", "revenue": "Revenue (₹)", "transactions": "Transactions",
                          "unique_payers": "Unique Payers", "avg_transaction": "Avg Txn (₹)"}
COHORT_LIFETIME_LABELS = {"cohort_month": "Cohort", "cohort_size": "Users", "paying_users": "Paying",
                          "lifetime_revenue": "Lifetime Rev (₹)", "total_transactions": "Transactions"}
FAILURE_MONITOR_LABELS = {"gateway": "Gateway", "failure_reason": "Reason", "failure_count": "Count",
                          "revenue_at_risk": "At Risk (₹)", "recovered_count": "Recovered",
                          "recovery_rate_pct": "Recovery %", "net_revenue_lost": "Net Lost (₹)"}
DUPLICATE_LABELS = {"user_id": "User", "payment_date": "Date", "amount": "Amount (₹)", "gateway": "Gateway",
                    "duplicate_count": "Dupes"}
NULL_SCAN_LABELS = {"column_ref": "Column", "null_count": "Nulls", "total_rows": "Total", "null_pct": "Null %"}
CHECK_DISPLAY_LABELS = {"check_name": "Check", "status": "Status", "metric": "Metric",
                        "threshold": "Threshold", "message": "Message"}
RATE_SERIES = (("success_rate_pct", "Success %"), ("failure_rate_pct", "Failure %"))
REVENUE_SERIES = (("success_revenue", "Recovered Revenue"), ("unrecovered_revenue", "Unrecovered Loss"))
CHECK_NAME_WIDTH = 42
STATUS_WIDTH = 5


# -- D1 --------------------------------------------------------------------------------
def growth_clean(growth: DataFrame) -> DataFrame:
    return growth.na.drop(subset=["growth_pct"])


# -- D2 / D3 -----------------------------------------------------------------------------
def share_of_total(df: DataFrame, value: str, out: str) -> DataFrame:
    """``value`` as % of its column total, summed exactly (2-dp money as DECIMAL). The total is one
    row of its own, so the rows stay where they are, however many texts they are grouped by."""
    dec = F.col(value).cast("decimal(38,2)")
    total = df.agg(F.sum(dec).alias("_total"))
    return df.crossJoin(F.broadcast(total)).withColumn(out, pct(dec, "_total")).drop("_total")


def gateway_revenue_share(by_gateway: DataFrame) -> DataFrame:
    return share_of_total(by_gateway.select("gateway", "revenue"), "revenue", "share_pct")


def reason_loss_share(reasons: DataFrame) -> DataFrame:
    return share_of_total(reasons.select("failure_reason", "revenue_lost"), "revenue_lost", "share_pct")


# -- D4 --------------------------------------------------------------------------------
def null_pct(scan: DataFrame) -> DataFrame:
    return scan.withColumn("null_pct", r2_even(ratio("null_count", "total_rows") * F.lit(100.0)))


# -- D5 / D6 -----------------------------------------------------------------------------
def status_counts(checks: DataFrame) -> DataFrame:
    """PASS/WARN/FAIL/ERROR with counts (zero included); the chart keeps count > 0."""
    return status_tally(checks)


def worst_status(checks: DataFrame) -> DataFrame:
    """FAIL if any check failed, else WARN if any warned, else PASS (ERROR is ignored)."""
    st = F.col("status")
    a = checks.agg(F.max((st == "FAIL").cast("int")).alias("f"), F.max((st == "WARN").cast("int")).alias("w"))
    return a.select(F.when(F.col("f") == 1, F.lit("FAIL")).when(F.col("w") == 1, F.lit("WARN"))
                    .otherwise(F.lit("PASS")).alias("worst_status"))


# -- D7 / D17 ----------------------------------------------------------------------------
def checks_display(checks: DataFrame) -> DataFrame:
    return checks.select(
        F.col("check_name").alias(CHECK_DISPLAY_LABELS["check_name"]),
        F.col("status").alias(CHECK_DISPLAY_LABELS["status"]),
        text_or_dash("metric").alias(CHECK_DISPLAY_LABELS["metric"]),
        text_or_dash("threshold").alias(CHECK_DISPLAY_LABELS["threshold"]),
        F.col("message").alias(CHECK_DISPLAY_LABELS["message"]))


def _pad(c, width: int):
    """Left-aligned, space-padded to ``width`` (never truncated)."""
    return F.when(F.length(c) >= width, c).otherwise(F.rpad(c, width, " "))


def check_line(checks: DataFrame) -> DataFrame:
    """One text line per check: [STATUS]  name  metric=…  threshold=…  — message."""
    m = F.coalesce(F.concat(F.lit("  metric="), F.col("metric")), F.lit(""))
    t = F.coalesce(F.concat(F.lit("  threshold="), F.col("threshold")), F.lit(""))
    line = F.concat(F.lit("["), _pad(F.col("status"), STATUS_WIDTH), F.lit("]  "),
                    _pad(F.col("check_name"), CHECK_NAME_WIDTH), m, t, F.lit("  — "), F.col("message"))
    return checks.select("check_name", line.alias("line"))


# -- D8 / D16 ----------------------------------------------------------------------------
def head(df: DataFrame, n: int) -> DataFrame:
    """First ``n`` rows of an ordered result (top-k; the plan is TakeOrderedAndProject)."""
    return df.limit(n)


def tail_by(df: DataFrame, key: str, n: int) -> DataFrame:
    """Last ``n`` rows by ``key``, returned in ascending order."""
    return df.orderBy(F.desc(key)).limit(n).orderBy(key)


# -- D9 --------------------------------------------------------------------------------
def rename_for_display(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in labels.items() if k in df.columns})


# -- D10 / D11 / D12 ---------------------------------------------------------------------
def with_inr(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{value}_inr", fmt_inr(value))


def with_pct_text(df: DataFrame, value: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or f"{value}_text", fmt_pct(value))


def kpi_header(summary: DataFrame) -> DataFrame:
    """The five header figures as display text: revenue and ARPU in ₹ lakh/crore,
    counts with thousands separators, failure rate as x.x%."""
    return summary.select(
        fmt_inr("total_revenue").alias("total_revenue"),
        fmt_inr("arpu").alias("arpu"),
        F.format_number(F.col("active_paying_users"), 0).alias("paying_users"),
        F.format_number(F.col("total_transactions"), 0).alias("total_transactions"),
        fmt_pct("overall_failure_pct").alias("failure_rate"))


def retention_display(retention: DataFrame) -> DataFrame:
    cells = [c for c in retention.columns if c != "cohort_month"]
    return retention.select("cohort_month", *[pct_or_dash(c).alias(c) for c in cells])


# -- D13 / D14 ---------------------------------------------------------------------------
def _long(df: DataFrame, series: tuple[tuple[str, str], ...], value_name: str) -> DataFrame:
    stack = ", ".join(f"'{label}', `{col}`" for col, label in series)
    return df.selectExpr("gateway", f"stack({len(series)}, {stack}) AS (series, {value_name})")


def gateway_rate_long(health: DataFrame) -> DataFrame:
    return _long(health, RATE_SERIES, "rate_pct")


def collected_vs_lost(health: DataFrame) -> DataFrame:
    """Collected (success) revenue and unrecovered loss per gateway; the first series
    carries the reference chart's label."""
    return _long(health, REVENUE_SERIES, "revenue")


__all__ = [
    "DASH", "STATUSES", "check_line", "checks_display", "collected_vs_lost", "gateway_rate_long",
    "gateway_revenue_share", "growth_clean", "head", "kpi_header", "null_pct", "reason_loss_share",
    "rename_for_display", "retention_display", "share_of_total", "status_counts", "tail_by",
    "with_inr", "with_pct_text", "worst_status",
]

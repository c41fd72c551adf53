"""Revenue metrics (M1–M11) and the stand-alone SQL reports Q1, Q3, Q4.

Plan notes (what each job costs at scale):

* Every metric is one scan of ``payments`` (or ``payment_failures``) with the
  status predicate pushed into the Parquet reader and only the needed columns
  read; aggregation is partial (map-side) then final on the group key.
* ``COUNT(DISTINCT user_id)`` per group is planned by Catalyst as a partial
  aggregate on (key, user_id) before the shuffle, so a hot user or month is
  collapsed map-side instead of landing whole in one task.
* Grand-total rows (``ALL GATEWAYS``) are computed from the already-aggregated
  per-gateway rows, not by a second pass over the fact table.
* The month-over-month window runs after aggregation on ≤ a few hundred rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.expr import count_where, money, month_key, pct, r2, ratio, sum_where
from ledgerlens.params import Params
from ledgerlens.sources.tables import Tables, as_tables

ALL_GATEWAYS = "ALL GATEWAYS"


class MetricsEngine:
    def __init__(self, tables: Tables | dict[str, DataFrame], params: Params | None = None):
        self.t = as_tables(tables)
        self.params = params or Params()

    # -- helpers -----------------------------------------------------------------
    def _success(self) -> DataFrame:
        return self.t.payments.where(F.col("status") == "success")

    # -- M1 ------------------------------------------------------------------------
    def arpu(self) -> DataFrame:
        """arpu, total_revenue, paying_users over successful payments; zeros when empty."""
        agg = self._success().agg(F.sum("amount").alias("rev"),
                                  F.countDistinct("user_id").alias("payers"))
        return agg.select(
            F.coalesce(r2(ratio("rev", "payers")), F.lit(0.0)).alias("arpu"),
            F.coalesce(money("rev"), F.lit(0.0)).alias("total_revenue"),
            F.col("payers").alias("paying_users"),
        )

    # -- M2 ------------------------------------------------------------------------
    def monthly_revenue(self) -> DataFrame:
        # Grouped on the month's first day (a 4-byte date); the YYYY-MM text is
        # formatted once per result row instead of once per payment.
        return (self._success()
                .groupBy(F.trunc("payment_date", "month").alias("m"))
                .agg(money(F.sum("amount")).alias("revenue"),
                     F.count(F.lit(1)).alias("transactions"),
                     F.countDistinct("user_id").alias("unique_payers"))
                .select(month_key("m").alias("month"), "revenue", "transactions", "unique_payers")
                .orderBy("month"))

    # -- M3 / Q4 ---------------------------------------------------------------------
    def revenue_growth(self) -> DataFrame:
        """Growth % against the previous month's (rounded) revenue; NULL after a 0 or first month."""
        monthly = (self._success()
                   .groupBy(F.trunc("payment_date", "month").alias("m"))
                   .agg(money(F.sum("amount")).alias("revenue"))
                   .select(month_key("m").alias("month"), "revenue"))
        prev = F.lag("revenue").over(Window.orderBy("month"))
        with_prev = monthly.select("month", "revenue", prev.alias("prev_revenue"))
        p = F.col("prev_revenue")
        growth = F.when(p.isNull() | (p == 0), F.lit(None).cast("double")).otherwise(
            r2((F.col("revenue") - p) / p * F.lit(100.0)))
        return with_prev.select("month", "revenue", "prev_revenue", growth.alias("growth_pct")).orderBy("month")

    # -- M4 ------------------------------------------------------------------------
    def revenue_by_gateway(self) -> DataFrame:
        return (self._success().groupBy("gateway")
                .agg(money(F.sum("amount")).alias("revenue"),
                     F.count(F.lit(1)).alias("transactions"),
                     F.countDistinct("user_id").alias("unique_payers"),
                     r2(ratio(F.sum("amount"), F.count("amount"))).alias("avg_transaction"))
                .orderBy(F.desc("revenue"), "gateway"))

    # -- M5 / Q3 ---------------------------------------------------------------------
    def _gateway_totals(self, with_success: bool) -> DataFrame:
        aggs = [F.count(F.lit(1)).alias("total")]
        if with_success:
            aggs.append(count_where(F.col("status") == "success").alias("success"))
        aggs.append(count_where(F.col("status") == "failed").alias("failed"))
        return self.t.payments.groupBy("gateway").agg(*aggs)

    def failed_payment_pct(self, with_success: bool = False) -> DataFrame:
        """Failure % per gateway plus an ``ALL GATEWAYS`` row summed from the per-gateway rows.

        ``with_success=True`` is the stand-alone report shape (Q3) with success counts and %.
        """
        per_gw = self._gateway_totals(with_success)
        count_cols = ["total"] + (["success"] if with_success else []) + ["failed"]
        total_row = per_gw.agg(F.lit(ALL_GATEWAYS).alias("gateway"),
                               *[F.sum(c).alias(c) for c in count_cols])
        both = per_gw.unionByName(total_row)
        out = [F.col("gateway")] + [F.col(c) for c in count_cols]
        out.append(pct("failed", "total").alias("failure_pct"))
        if with_success:
            out.append(pct("success", "total").alias("success_pct"))
        return both.select(*out).orderBy(F.desc("failure_pct"), "gateway")

    # -- M6 ------------------------------------------------------------------------
    def gateway_success_pct(self) -> DataFrame:
        st = F.col("status")
        return (self.t.payments.groupBy("gateway")
                .agg(F.count(F.lit(1)).alias("total"),
                     count_where(st == "success").alias("success_count"),
                     count_where(st == "failed").alias("failed_count"),
                     count_where(st == "refunded").alias("refunded_count"))
                .withColumn("success_pct", pct("success_count", "total"))
                .orderBy(F.desc("success_pct"), "gateway"))

    # -- M7 ------------------------------------------------------------------------
    def payment_recovery(self) -> DataFrame:
        rec = F.col("recovered")
        agg = self.t.payment_failures.agg(
            F.count(F.lit(1)).alias("total_failures"),
            F.sum(rec).alias("recovered_count"),
            sum_where("recovery_amount", rec == 1).alias("rr"),
            sum_where("amount", rec == 0).alias("ur"))
        return agg.select(
            "total_failures",
            F.coalesce(F.col("recovered_count"), F.lit(0)).cast("bigint").alias("recovered_count"),
            F.coalesce(pct("recovered_count", "total_failures"), F.lit(0.0)).alias("recovery_pct"),
            F.coalesce(money("rr"), F.lit(0.0)).alias("recovered_revenue"),
            F.coalesce(money("ur"), F.lit(0.0)).alias("unrecovered_revenue"),
        )

    # -- M8 / M9 ---------------------------------------------------------------------
    def revenue_lost(self) -> DataFrame:
        return (self.t.payment_failures.where(F.col("recovered") == 0)
                .groupBy("gateway", "failure_reason")
                .agg(F.count(F.lit(1)).alias("failure_count"),
                     money(F.sum("amount")).alias("revenue_lost"))
                .orderBy(F.desc("revenue_lost"), "gateway", "failure_reason"))

    def revenue_lost_total(self) -> DataFrame:
        """Σ revenue_lost over M8 (0 when there is none), as a one-row frame."""
        s = self.t.payment_failures.where(F.col("recovered") == 0).agg(F.sum("amount").alias("s"))
        return s.select(F.coalesce(money("s"), F.lit(0.0)).alias("revenue_lost_total"))

    # -- M10 -----------------------------------------------------------------------
    def daily_revenue_trend(self) -> DataFrame:
        return (self._success().groupBy("payment_date")
                .agg(money(F.sum("amount")).alias("daily_revenue"),
                     F.count(F.lit(1)).alias("transactions"))
                .orderBy("payment_date"))

    # -- M11 -----------------------------------------------------------------------
    def top_summary(self) -> DataFrame:
        """All headline KPIs in one pass; NULLs of an empty table become 0."""
        st = F.col("status")
        ok = st == "success"
        agg = self.t.payments.agg(
            sum_where("amount", ok).alias("rev"),
            F.countDistinct(F.when(ok, F.col("user_id"))).alias("payers"),
            F.count(F.lit(1)).alias("total_transactions"),
            count_where(st == "failed").alias("failed_transactions"),
            count_where(st == "refunded").alias("refunded_transactions"))
        return agg.select(
            F.coalesce(money("rev"), F.lit(0.0)).alias("total_revenue"),
            F.col("payers").alias("active_paying_users"),
            F.coalesce(r2(ratio("rev", "payers")), F.lit(0.0)).alias("arpu"),
            "total_transactions", "failed_transactions", "refunded_transactions",
            F.coalesce(pct("failed_transactions", "total_transactions"), F.lit(0.0)).alias("overall_failure_pct"),
        )

    # -- S14 -----------------------------------------------------------------------
    def export_revenue_report(self, out_dir: str) -> str:
        """Monthly revenue as ``revenue_report.csv`` under ``out_dir``."""
        from ledgerlens.sources.reports import export_revenue_report

        return export_revenue_report(self, out_dir)

    # -- Q1 (stand-alone report) ----------------------------------------------------
    def sql_arpu(self) -> DataFrame:
        """Stand-alone ARPU report: M1 plus transaction count and average value (no zero-fill)."""
        agg = self._success().agg(F.sum("amount").alias("rev"),
                                  F.countDistinct("user_id").alias("payers"),
                                  F.count("payment_id").alias("successful_transactions"),
                                  F.count("amount").alias("n_amount"))
        return agg.select(
            r2(ratio("rev", "payers")).alias("arpu"),
            money("rev").alias("total_revenue"),
            F.col("payers").alias("paying_users"),
            "successful_transactions",
            r2(ratio("rev", "n_amount")).alias("avg_transaction_value"),
        )

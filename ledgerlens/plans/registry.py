"""Query registry: key → callable(spark, sf_dir) → DataFrame.

Every query binds the driver's tables to the domain tables (a lazy projection
over one scan each) and runs one operator over them whole.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.alerts import AlertRules
from ledgerlens.operators.checks import Validator
from ledgerlens.operators.cohort import CohortEngine
from ledgerlens.operators.failures import FailureMonitor
from ledgerlens.operators.metrics import MetricsEngine
from ledgerlens.params import FIXTURE_PARAMS
from ledgerlens.sources.binding import bind

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
_BOUND: dict[tuple[int, str], tuple[SparkSession, object]] = {}


def bound(spark: SparkSession, sf_dir: str):
    """The bound tables of ``sf_dir``, planned once per session (like registering
    tables once and running many queries over them)."""
    key = (id(spark), sf_dir.rstrip("/"))
    hit = _BOUND.get(key)
    if hit is None or hit[0] is not spark:
        hit = (spark, bind(spark, sf_dir))
        _BOUND[key] = hit
    return hit[1]


def _reg(key: str, fn: QueryFn) -> None:
    if key in QUERIES:
        raise KeyError(f"duplicate query key {key}")
    QUERIES[key] = fn


def _metrics(method: str, **kw) -> QueryFn:
    return lambda spark, d: getattr(MetricsEngine(bound(spark, d), FIXTURE_PARAMS), method)(**kw)


for _m in ("arpu", "monthly_revenue", "revenue_growth", "revenue_by_gateway", "failed_payment_pct",
           "gateway_success_pct", "payment_recovery", "revenue_lost", "revenue_lost_total",
           "daily_revenue_trend", "top_summary", "sql_arpu"):
    _reg(_m, _metrics(_m))
_reg("sql_failure_rate", _metrics("failed_payment_pct", with_success=True))
_reg("sql_revenue_growth", _metrics("revenue_growth"))


# Extensions: rules the reference names in prose only.
for _m in ("revenue_alert", "negative_growth_runs", "gateway_trailing_success"):
    _reg(_m, lambda spark, d, m=_m: getattr(AlertRules(bound(spark, d), FIXTURE_PARAMS), m)())


def _failures(method: str, **kw) -> QueryFn:
    return lambda spark, d: getattr(FailureMonitor(bound(spark, d), FIXTURE_PARAMS), method)(**kw)


for _m in ("failure_monitor", "failure_monitor_total", "retry_detail", "retry_summary",
           "duplicate_transactions", "stale_pending", "revenue_leakage", "leakage_total", "failure_trend",
           "top_failure_reasons", "gateway_health", "null_monitoring"):
    _reg(_m, _failures(_m))
_reg("reconciliation_check", _failures("reconciliation_summary"))
_reg("retry_analysis", _failures("retry_analysis_summary"))


def _cohort(method: str, **kw) -> QueryFn:
    return lambda spark, d: getattr(CohortEngine(bound(spark, d), FIXTURE_PARAMS), method)(**kw)


for _m in ("cohort_size", "cohort_revenue_raw", "sql_cohort_revenue", "cohort_count", "cohort_revenue_matrix",
           "cohort_retention", "cohort_arpu", "cohort_lifetime"):
    _reg(_m, _cohort(_m))
_reg("heatmap_long", _cohort("cohort_heatmap_long"))


def _checks(method: str, **kw) -> QueryFn:
    return lambda spark, d: getattr(Validator(bound(spark, d), FIXTURE_PARAMS), method)(**kw)


for _m in ("validate_arpu", "validate_revenue", "validate_cohort", "validate_failure_rate", "detect_duplicates",
           "detect_nulls", "freshness_check", "orphan_check", "run_all", "quality_report", "null_scan",
           "duplicates_detail"):
    _reg(_m, _checks(_m))


# ---------------------------------------------------------------- sources, ETL, report sinks
def _scratch(spark: SparkSession, name: str) -> str:
    from ledgerlens.session import scratch_path

    return scratch_path(spark, name)


def q_src_csv(spark, d):
    from ledgerlens.sources.csv import read_csv, write_csv

    t = bound(spark, d)
    path = write_csv(t.payments, _scratch(spark, "payments-csv"))
    return read_csv(spark, path, schema=t.payments.schema)


def q_src_table(spark, d):
    from ledgerlens.sources.tables import read_table, write_table

    root = _scratch(spark, "store")
    write_table(bound(spark, d).users, root, "users")
    return read_table(spark, root, "users")


def q_load_table(spark, d):
    from ledgerlens.sources.csv import write_csv
    from ledgerlens.sources.etl import load_table
    from ledgerlens.sources.tables import read_table

    apps = bound(spark, d).applications
    csv_path = write_csv(apps, _scratch(spark, "applications-csv"))
    root = _scratch(spark, "store")
    if load_table(spark, csv_path, root, "applications", schema=apps.schema) < 0:
        raise RuntimeError("applications: stored row count differs from the source")
    return read_table(spark, root, "applications")


def _applications_csv(spark, d):
    """The bound applications as a CSV, and an empty store to load it into."""
    from ledgerlens.sources.csv import write_csv

    apps = bound(spark, d).applications
    return apps, write_csv(apps, _scratch(spark, "applications-csv")), _scratch(spark, "store")


def q_truncate_table(spark, d):
    """Rows of a loaded table before and after it is emptied."""
    from ledgerlens.sources.etl import load_table
    from ledgerlens.sources.tables import read_table, truncate_table

    apps, csv_path, root = _applications_csv(spark, d)
    before = load_table(spark, csv_path, root, "applications", schema=apps.schema)
    truncate_table(spark, root, "applications")
    return read_table(spark, root, "applications").agg(
        F.lit("applications").alias("table_name"), F.lit(before).cast("bigint").alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"))


def q_append_mode(spark, d):
    """A refresh and then a load that keeps the rows: every row twice."""
    from ledgerlens.sources.etl import load_table
    from ledgerlens.sources.tables import read_table

    apps, csv_path, root = _applications_csv(spark, d)
    for keep in (False, True):
        if load_table(spark, csv_path, root, "applications", skip_truncate=keep, schema=apps.schema) < 0:
            raise RuntimeError("applications: stored row count differs from the source")
    return read_table(spark, root, "applications")


def q_validate_load(spark, d):
    """The stored count held against the source's count, and against one row more."""
    from ledgerlens.sources.etl import load_table, validate_load
    from ledgerlens.sources.tables import read_table

    apps, csv_path, root = _applications_csv(spark, d)
    load_table(spark, csv_path, root, "applications", schema=apps.schema)
    n = apps.count()
    found = [F.lit(validate_load(spark, root, "applications", k)) for k in (n, n + 1)]
    return read_table(spark, root, "applications").agg(
        F.lit("applications").alias("table_name"), F.count(F.lit(1)).alias("stored_rows"),
        found[0].alias("ok"), found[1].alias("ok_with_one_more"))


def q_save_datasets(spark, d):
    """The five tables saved as CSVs, read back and counted."""
    from ledgerlens.sources.csv import read_csv, save_datasets
    from ledgerlens.sources.etl import post_load_counts
    from ledgerlens.sources.tables import Tables

    t = bound(spark, d).as_dict()
    paths = save_datasets(t, _scratch(spark, "datasets"))
    return post_load_counts(Tables(**{n: read_csv(spark, paths[n], schema=df.schema) for n, df in t.items()}))


def q_load_all(spark, d):
    """Bound tables exported as CSVs (events without the retry_success rows, which the
    load derives) → ``load_all`` into a fresh store → row counts of the stored tables."""
    from ledgerlens.sources.csv import write_csv
    from ledgerlens.sources.etl import RETRY_EVENT_TYPE, load_all, post_load_counts
    from ledgerlens.sources.tables import read_tables

    t = bound(spark, d)
    t = t.replace(revenue_events=t.revenue_events.where(F.col("event_type") != RETRY_EVENT_TYPE))
    csv_dir, root = _scratch(spark, "csv"), _scratch(spark, "store")
    for name, df in t.as_dict().items():
        write_csv(df, f"{csv_dir}/{name}.csv")
    result = load_all(spark, csv_dir, root)
    if not result.ok:
        raise RuntimeError(f"load_all: row count mismatch {result.rows}")
    return post_load_counts(read_tables(spark, root))


def _etl(fn_name: str, *tables: str, **kw) -> QueryFn:
    def q(spark, d):
        from ledgerlens.sources import etl

        t = bound(spark, d)
        args = [getattr(t, n) for n in tables] if tables else [t]
        return getattr(etl, fn_name)(*args, **kw)

    return q


def _export(which: str) -> QueryFn:
    def q(spark, d):
        from ledgerlens.sources import reports

        t, out = bound(spark, d), _scratch(spark, "reports")
        if which == "revenue":
            src = MetricsEngine(t, FIXTURE_PARAMS).monthly_revenue()
            path = reports.export_revenue_report(MetricsEngine(t, FIXTURE_PARAMS), out)
        elif which == "cohort":
            src = CohortEngine(t, FIXTURE_PARAMS).cohort_arpu()
            path = reports.export_cohort_report(CohortEngine(t, FIXTURE_PARAMS), out)
        elif which in ("failure", "retry"):
            fm = FailureMonitor(t, FIXTURE_PARAMS)
            a, b = reports.export_full_report(fm, out)
            src, path = (fm.failure_monitor(), a) if which == "failure" else (fm.retry_summary(), b)
        else:
            src = Validator(t, FIXTURE_PARAMS).quality_report()
            path = reports.export_quality_report(Validator(t, FIXTURE_PARAMS), out)
        return reports.read_report(spark, path, src.schema)

    return q


_reg("src_csv", q_src_csv)
_reg("src_table", q_src_table)
_reg("load_table", q_load_table)
_reg("truncate_table", q_truncate_table)
_reg("append_mode", q_append_mode)
_reg("validate_load", q_validate_load)
_reg("save_datasets", q_save_datasets)
_reg("load_all", q_load_all)
_reg("post_load_counts", _etl("post_load_counts"))
_reg("retry_success_events", _etl("retry_success_events", "payment_failures"))
_reg("derive_revenue_events", _etl("derive_revenue_events", "payments"))
_reg("derive_payment_failures", _etl("derive_payment_failures", "payments", "users"))
_reg("cap_recovery", _etl("cap_recovery", "payment_failures", period_end=_dt.date(2000, 12, 31)))
_reg("derive_cohort_month", _etl("derive_cohort_month", "users"))
_reg("profile_datasets", _etl("profile_datasets"))
_reg("export_revenue_report", _export("revenue"))
_reg("export_cohort_report", _export("cohort"))
_reg("export_full_report", _export("failure"))
_reg("export_retry_report", _export("retry"))
_reg("export_quality_report", _export("quality"))


# ---------------------------------------------------------------- dashboard data preparation
def _view(build) -> QueryFn:
    def q(spark, d):
        t = bound(spark, d)
        engines = {"m": MetricsEngine(t, FIXTURE_PARAMS), "c": CohortEngine(t, FIXTURE_PARAMS),
                   "f": FailureMonitor(t, FIXTURE_PARAMS), "v": Validator(t, FIXTURE_PARAMS)}
        return build(**engines)

    return q


def _views():
    from ledgerlens.operators import views as V

    return {
        "growth_clean": lambda m, **_: V.growth_clean(m.revenue_growth()),
        "gateway_revenue_share": lambda m, **_: V.gateway_revenue_share(m.revenue_by_gateway()),
        "reason_loss_share": lambda f, **_: V.reason_loss_share(f.top_failure_reasons()),
        "null_pct": lambda v, **_: V.null_pct(v.null_scan()),
        "status_counts": lambda v, **_: V.status_counts(v.run_all_isolated()),
        "worst_status": lambda v, **_: V.worst_status(v.run_all_isolated()),
        "checks_display": lambda v, **_: V.checks_display(v.run_all_isolated()),
        "check_line": lambda v, **_: V.check_line(v.run_all_isolated()),
        "duplicates_top15": lambda f, **_: f.duplicate_transactions(top=15),
        "gateway_revenue_display": lambda m, **_: V.rename_for_display(m.revenue_by_gateway(),
                                                                       V.GATEWAY_REVENUE_LABELS),
        "cohort_lifetime_display": lambda c, **_: V.rename_for_display(c.cohort_lifetime(),
                                                                       V.COHORT_LIFETIME_LABELS),
        "failure_monitor_display": lambda f, **_: V.rename_for_display(f.failure_monitor(),
                                                                       V.FAILURE_MONITOR_LABELS),
        "duplicates_display": lambda f, **_: V.rename_for_display(f.duplicate_transactions(top=15),
                                                                  V.DUPLICATE_LABELS),
        "null_scan_display": lambda v, **_: V.rename_for_display(V.null_pct(v.null_scan()), V.NULL_SCAN_LABELS),
        "kpi_header": lambda m, **_: V.kpi_header(m.top_summary()),
        "fmt_inr": lambda m, **_: V.with_inr(m.daily_revenue_trend(), "daily_revenue"),
        "fmt_pct": lambda m, **_: V.with_pct_text(m.gateway_success_pct(), "success_pct"),
        "retention_display": lambda c, **_: V.retention_display(c.cohort_retention()),
        "gateway_rate_long": lambda f, **_: V.gateway_rate_long(f.gateway_health()),
        "collected_vs_lost": lambda f, **_: V.collected_vs_lost(f.gateway_health()),
        "monthly_revenue_tail5": lambda m, **_: V.tail_by(m.monthly_revenue(), "month", 5),
        "growth_tail5": lambda m, **_: V.tail_by(m.revenue_growth(), "month", 5),
        "revenue_lost_top5": lambda m, **_: V.head(m.revenue_lost(), 5),
        "failure_monitor_top8": lambda f, **_: V.head(f.failure_monitor(), 8),
        "retry_detail_head10": lambda f, **_: V.head(f.retry_detail(), 10),
        "leakage_top10": lambda f, **_: V.head(f.revenue_leakage(), 10),
        "duplicates_top5": lambda f, **_: f.duplicate_transactions(top=5),
    }


for _k, _b in _views().items():
    _reg(_k, _view(_b))

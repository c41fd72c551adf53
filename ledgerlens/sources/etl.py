"""Load path and derived tables.

The reference loads CSVs into a database in FK order, validates row counts,
then appends derived ``retry_success`` events. Here each table is one parallel
Parquet write of a new version (staged, counted, then switched in, as the whole table or
as a part more), the count check reads the staged files back, and the derivations are lazy
projections that can be unioned into the event table before it is written.
Writing each table also cuts lineage, so a lost executor re-runs only the
current table's job.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ledgerlens.functions.expr import month_key
from ledgerlens.schema import TABLE_NAMES, TABLE_SCHEMAS
from ledgerlens.sources.csv import read_csv
from ledgerlens.sources.tables import (Tables, drop_staged, read_table, stage_table, switch_table, write_table)

log = logging.getLogger("ledgerlens.etl")

# Fixed values that must equal the reference: load order (parents first) and the
# payment status → event type mapping (anything else is a received payment).
LOAD_PLAN = (
    ("users", "users"),
    ("payments", "payments"),
    ("applications", "applications"),
    ("revenue_events", "revenue_events"),
    ("payment_failures", "payment_failures"),
)
EVENT_TYPE_BY_STATUS = {"success": "payment_received", "failed": "payment_received",
                        "pending": "payment_received", "refunded": "refund_issued"}
DEFAULT_EVENT_TYPE = "payment_received"
# A recovery date that does not parse is loaded as NULL and gives no retry event.
LENIENT_DATES = {"payment_failures": ("recovery_date",)}
RETRY_EVENT_TYPE = "retry_success"
UNKNOWN_REASON = "unknown"


# -- S6 / S3 ---------------------------------------------------------------------------
def validate_load(spark: SparkSession, root: str, table: str, expected: int) -> bool:
    actual = read_table(spark, root, table).count()
    if actual != expected:
        log.error("Row count mismatch for %s: expected %d, got %d", table, expected, actual)
        return False
    return True


def load_table(spark: SparkSession, csv_path: str, root: str, table: str, skip_truncate: bool = False,
               schema=None) -> int:
    """Read a CSV, write it as the stored table (overwrite, or append with
    ``skip_truncate``) and check the stored count. Returns the rows loaded or -1.
    What was written is counted before it becomes (a part of) the table: on a bad row or a
    wrong count the table stays as it was.

    The source row count is an ``observe`` metric of the write job itself, so the
    CSV is read once.
    """
    from pyspark.sql import Observation

    src = read_csv(spark, csv_path, schema=schema, table=None if schema is not None else table,
                   lenient_dates=LENIENT_DATES.get(table, ()))
    obs = Observation(f"load_{table}")
    counted = src.observe(obs, F.count(F.lit(1)).alias("rows"))
    staged = stage_table(counted, root, table)
    src_rows = obs.get["rows"]
    stored = spark.read.schema(src.schema).parquet(staged).count()
    if stored != src_rows:
        log.error("Row count mismatch for %s: expected %d, got %d", table, src_rows, stored)
        drop_staged(spark, staged)
        return -1
    switch_table(spark, staged, root, table, skip_truncate)
    return src_rows


# -- S9 / S10 / S11 / S12 / S13 ------------------------------------------------------------
def retry_success_events(payment_failures: DataFrame) -> DataFrame:
    """One ``retry_success`` event per recovered failure, dated on its recovery day.

    Rows whose recovery date does not parse are skipped. The event id is derived from
    the failure id: a payment can fail, and recover, more than once.
    """
    rd = F.col("recovery_date")
    if isinstance(payment_failures.schema["recovery_date"].dataType, StringType):
        rd = F.try_to_date(rd)
    rec = (payment_failures.where((F.col("recovered") == 1) & F.col("recovery_date").isNotNull())
           .select("failure_id", "payment_id", rd.alias("rdate")).where(F.col("rdate").isNotNull()))
    return rec.select(F.concat(F.lit("retry:"), F.col("failure_id").cast("string")).alias("event_id"),
                      "payment_id", F.lit(RETRY_EVENT_TYPE).alias("event_type"),
                      F.col("rdate").cast("timestamp_ntz").alias("event_time"))


def derive_revenue_events(payments: DataFrame) -> DataFrame:
    """One event per payment: refunded → refund_issued, everything else → payment_received,
    at midnight of the payment day."""
    mapping = F.create_map(*[F.lit(x) for kv in EVENT_TYPE_BY_STATUS.items() for x in kv])
    etype = F.coalesce(F.element_at(mapping, F.col("status")), F.lit(DEFAULT_EVENT_TYPE))
    return payments.select(F.concat(F.lit("pay:"), F.col("payment_id").cast("string")).alias("event_id"),
                           "payment_id", etype.alias("event_type"),
                           F.col("payment_date").cast("timestamp_ntz").alias("event_time"))


def derive_payment_failures(payments: DataFrame, users: DataFrame) -> DataFrame:
    """Failed payments of known users as failure rows (reason NULL → 'unknown'), not yet recovered."""
    failed = (payments.where(F.col("status") == "failed")
              .join(users.select("user_id"), "user_id", "left_semi"))
    return failed.select(
        F.col("payment_id").alias("failure_id"), "payment_id", "user_id",
        F.col("payment_date").alias("failure_date"),
        F.coalesce(F.col("failure_reason"), F.lit(UNKNOWN_REASON)).alias("failure_reason"),
        "gateway", "amount",
        F.lit(0).cast("int").alias("recovered"),
        F.lit(None).cast("date").alias("recovery_date"),
        F.lit(None).cast(payments.schema["amount"].dataType).alias("recovery_amount"))


def cap_recovery(payment_failures: DataFrame, period_end: dt.date) -> DataFrame:
    """A recovery dated after the period end is void: date and amount NULL, recovered 0."""
    late = F.col("recovery_date") > F.lit(period_end)
    return payment_failures.withColumns({
        "recovered": F.when(late, F.lit(0)).otherwise(F.col("recovered")).cast("int"),
        "recovery_date": F.when(late, F.lit(None)).otherwise(F.col("recovery_date")),
        "recovery_amount": F.when(late, F.lit(None)).otherwise(F.col("recovery_amount")),
    })


def derive_cohort_month(users: DataFrame) -> DataFrame:
    return users.withColumn("cohort_month", month_key("signup_date"))


# -- S7 / S8 ------------------------------------------------------------------------------
@dataclass
class LoadResult:
    ok: bool
    rows: dict[str, int]


def load_all(spark: SparkSession, csv_dir: str, root: str, skip_truncate: bool = False) -> LoadResult:
    """Load the five tables in FK order, then append the derived retry events (not from the
    old rows of a table whose load failed)."""
    rows: dict[str, int] = {}
    ok = True
    for stem, table in LOAD_PLAN:
        n = load_table(spark, f"{csv_dir.rstrip('/')}/{stem}.csv", root, table, skip_truncate,
                       schema=TABLE_SCHEMAS[table])
        rows[table] = n
        ok &= n != -1
    if -1 in (rows["payment_failures"], rows["revenue_events"]):
        log.error("Retry events not derived: payment_failures or revenue_events did not load")
        return LoadResult(ok=False, rows=rows)
    # Derived events read the failures table just written (lineage is cut by the write).
    retry = retry_success_events(read_table(spark, root, "payment_failures"))
    # Events that an earlier load appended are not appended again.
    known = read_table(spark, root, "revenue_events").where(F.col("event_type") == RETRY_EVENT_TYPE).select("event_id")
    write_table(retry.join(known, "event_id", "left_anti").select(*retry.columns), root, "revenue_events", mode="append")
    return LoadResult(ok=ok, rows=rows)


def post_load_counts(tables: Tables) -> DataFrame:
    """table_name, row_count for the five tables (one count job per table, unioned)."""
    parts = [getattr(tables, n).agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
             for n in TABLE_NAMES]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# -- S19 ----------------------------------------------------------------------------------
def profile_datasets(tables: Tables) -> DataFrame:
    """dataset, measure, key, value: rows and column list per table, status and
    gateway value counts of payments, and the recovered percentage of failures.

    Payments are profiled in one pass with GROUPING SETS ((status), (gateway), ());
    every other table is one aggregate pass.
    """
    parts = []
    for n in TABLE_NAMES:
        if n == "payments":
            continue
        df = getattr(tables, n)
        cols_key = ",".join(df.columns)
        if n == "payment_failures":
            a = df.agg(F.count(F.lit(1)).cast("double").alias("rows"),
                       (F.avg(F.col("recovered").cast("double")) * F.lit(100.0)).alias("recovered_pct"))
            # Both rows from one select, so the aggregate is computed once.
            parts.append(a.selectExpr(
                f"stack(2, 'rows', '{cols_key}', rows, 'recovered_pct', CAST(NULL AS STRING), recovered_pct)"
                " AS (measure, key, value)").select(F.lit(n).alias("dataset"), "measure", "key", "value"))
        else:
            parts.append(df.agg(F.lit(n).alias("dataset"), F.lit("rows").alias("measure"),
                                F.lit(cols_key).alias("key"), F.count(F.lit(1)).cast("double").alias("value")))
    p = tables.payments
    g = (p.groupingSets([["status"], ["gateway"], []], "status", "gateway")
         .agg(F.count(F.lit(1)).cast("double").alias("value"), F.grouping_id().alias("gid")))
    # grouping_id bits: status = 2, gateway = 1 (a set bit means "not grouped by").
    measure = (F.when(F.col("gid") == 1, F.lit("status_count")).when(F.col("gid") == 2, F.lit("gateway_count"))
               .otherwise(F.lit("rows")))
    key = (F.when(F.col("gid") == 1, F.col("status")).when(F.col("gid") == 2, F.col("gateway"))
           .otherwise(F.lit(",".join(p.columns))))
    parts.append(g.select(F.lit("payments").alias("dataset"), measure.alias("measure"), key.alias("key"), "value"))
    out = parts[0]
    for q in parts[1:]:
        out = out.unionByName(q)
    return out

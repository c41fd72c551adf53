"""Failure monitoring, retry outcomes, leakage and reconciliation.

Plan notes:

* Fingerprint duplicates (F5) run in two phases. Phase 1 counts rows per 64-bit
  fingerprint hash with a map-side partial count, so a hash and a counter cross the
  shuffle and a hot fingerprint is one row a map task. Phase 2 semi-joins payments to the
  (usually few) repeated hashes (AQE broadcasts that side only when its measured size is
  under the threshold) and regroups on the exact keys (NULL user = NULL user, as SQL
  GROUP BY does). Top-k reports choose their groups by count before any id list is built, and
  the ids of a large group are collected and sorted in parts by many tasks.
* Stale pendings (F6) are a LEFT ANTI join (not LEFT JOIN + IS NULL, which
  Spark would keep as an outer join plus filter) against events first reduced
  by a LEFT SEMI join to the pending ids, so the event table is never shuffled
  whole when the pending set is small.
* Leakage by cohort (F7) pre-aggregates failures per (user, gateway) before the
  join to ``users``, so a user with very many failures is one row at the join.
* Gateway health (F10) joins two per-gateway aggregates; both sides are already
  reduced to one row per gateway before the join.
* Null monitoring (F11) is one conditional-count pass per table, unpivoted with
  ``stack`` — three scans instead of five.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import count_where, days_between, money, pct, r2, ratio, sum_where
from ledgerlens.params import Params
from ledgerlens.sources.tables import Tables, as_tables

FINGERPRINT = ("user_id", "payment_date", "amount")
CHUNK = 50_000  # ids of one group that one task collects and sorts

# Fixed values that must equal the reference's null-monitoring labels (in its order).
NULL_MONITOR_LABELS = (
    "payments.failure_reason (non-failed rows with value)",
    "payments.failure_reason (failed rows missing value)",
    "users.active (NULL active flag)",
    "payment_failures.recovery_date (recovered=1 but no date)",
    "payments.user_id (NULL user)",
)


def _stack(labels_and_cols: list[tuple[str, str]], name: str = "check_name",
           value: str = "issue_count") -> str:
    """A ``stack`` expression turning one wide row of counts into (label, count) rows."""
    parts = ", ".join(f"'{lbl}', `{col}`" for lbl, col in labels_and_cols)
    return f"stack({len(labels_and_cols)}, {parts}) AS ({name}, {value})"


def _payment_null_counts() -> list:
    """The three null monitoring counts of payments, under the places of their labels."""
    st, reason = F.col("status"), F.col("failure_reason")
    return [count_where(~st.isin("failed", "refunded") & reason.isNotNull()).alias("a"),
            count_where((st == "failed") & reason.isNull()).alias("b"),
            count_where(F.col("user_id").isNull()).alias("e")]


def _fingerprint_hash():
    """One 64-bit key per fingerprint (NULLs hash like any value, so NULL user = NULL user)."""
    return F.xxhash64(*[F.col(k) for k in FINGERPRINT])


def duplicate_members(payments: DataFrame, size: str | None = None) -> DataFrame:
    """Payments whose fingerprint hash occurs more than once (all duplicates; a hash
    collision can let other rows through, so the exact keys decide afterwards). ``size``:
    also the number of payments of the hash, as a column of that name."""
    hashed = payments.withColumn("_fp", _fingerprint_hash())
    again = hashed.groupBy("_fp").agg(F.count("payment_id").alias("_n")).where(F.col("_n") > 1)
    if size is None:
        return hashed.join(again.select("_fp"), "_fp", "left_semi").drop("_fp")
    return hashed.join(again, "_fp").withColumnRenamed("_n", size).drop("_fp")


def duplicate_groups(payments: DataFrame, with_gateway: bool = True, top: int | None = None, chunk: int = CHUNK) -> DataFrame:
    """Fingerprint groups with more than one payment id, with the sorted id list.

    Output: user_id, payment_date, amount (DOUBLE), duplicate_count, payment_ids[, gateway].
    ``gateway`` is the smallest gateway of the group (deterministic stand-in for an
    arbitrary row's value). ``top``: only the first groups by count, amount, user and day;
    they are chosen by their counts, and id lists are built for these alone.

    A group's ids are dealt by hash into parts of about ``chunk``; each part is collected and
    sorted by a task of its own, and the sorted parts are merged where the list is written.
    """
    keys = list(FINGERPRINT)
    members = duplicate_members(payments, size="_n")
    if top is not None:
        first = (members.groupBy(*keys).agg(F.count("payment_id").alias("n")).where(F.col("n") > 1)
                 .orderBy(F.desc("n"), F.desc("amount"), "user_id", "payment_date").limit(top)
                 .select(*[F.col(k).alias(f"_{k}") for k in keys]))
        same = F.lit(True)
        for k in keys:
            same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
        members = members.join(first, same, "left_semi")
    part = F.pmod(F.xxhash64("payment_id"), F.ceil(F.col("_n") / chunk))
    gateway = [F.min("gateway").alias("gateway")] if with_gateway else []
    parts = (members.withColumn("_part", part).groupBy(*keys, "_part")
             .agg(F.count("payment_id").alias("cnt"), F.array_sort(F.collect_list("payment_id")).alias("ids"), *gateway))
    ids = F.array_sort(F.flatten(F.collect_list("ids"))).cast("array<string>")  # sorted runs: a merge
    g = (parts.groupBy(*keys).agg(F.sum("cnt").alias("duplicate_count"), F.array_join(ids, ",").alias("payment_ids"), *gateway)
         .where(F.col("duplicate_count") > 1))
    return g.withColumn("amount", money("amount"))


class FailureMonitor:
    def __init__(self, tables: Tables | dict[str, DataFrame], params: Params | None = None):
        self.t = as_tables(tables)
        self.params = params or Params()

    # -- F1 / F2 -----------------------------------------------------------------------
    def _failure_groups(self) -> DataFrame:
        pf = self.t.payment_failures
        return (pf.groupBy("gateway", "failure_reason")
                .agg(F.count(F.lit(1)).alias("failure_count"),
                     F.sum("amount").alias("at_risk"),
                     F.sum("recovered").alias("recovered_count"),
                     (F.sum("amount") - F.sum(F.coalesce(F.col("recovery_amount"), F.lit(0))))
                     .alias("net")))

    def failure_monitor(self) -> DataFrame:
        g = self._failure_groups()
        return (g.select("gateway", "failure_reason", "failure_count",
                         money("at_risk").alias("revenue_at_risk"),
                         F.col("recovered_count").cast("bigint").alias("recovered_count"),
                         pct("recovered_count", "failure_count").alias("recovery_rate_pct"),
                         money("net").alias("net_revenue_lost"))
                .orderBy(F.desc("net_revenue_lost"), "gateway", "failure_reason"))

    def failure_monitor_total(self) -> DataFrame:
        """Σ net_revenue_lost over the F1 groups, summed exactly in DECIMAL."""
        g = self._failure_groups()
        return g.agg(F.coalesce(money(F.sum("net")), F.lit(0.0)).alias("net_revenue_lost_total"))

    # -- F3 / F4 / F13 ------------------------------------------------------------------
    def retry_detail(self) -> DataFrame:
        pf = self.t.payment_failures
        return (pf.where((F.col("recovered") == 1) & F.col("recovery_date").isNotNull())
                .groupBy("gateway", days_between("recovery_date", "failure_date").alias("days_to_recovery"))
                .agg(F.count(F.lit(1)).alias("recovered_count"),
                     money(F.sum("recovery_amount")).alias("recovered_revenue"),
                     r2(ratio(F.sum("recovery_amount"), F.count("recovery_amount"))).alias("avg_recovery_amount"))
                .orderBy("gateway", "days_to_recovery"))

    def retry_summary(self) -> DataFrame:
        pf = self.t.payment_failures
        rec = F.col("recovered")
        days = F.when(rec == 1, days_between("recovery_date", "failure_date"))
        g = pf.groupBy("gateway").agg(
            F.count(F.lit(1)).alias("total_failures"),
            F.sum(rec).alias("recovered"),
            sum_where("recovery_amount", rec == 1).alias("rr"),
            sum_where("amount", rec == 0).alias("lr"),
            F.sum(days).alias("days_sum"), F.count(days).alias("days_n"))
        return (g.select("gateway", "total_failures",
                         F.col("recovered").cast("bigint").alias("recovered"),
                         (F.col("total_failures") - F.col("recovered")).cast("bigint").alias("not_recovered"),
                         pct("recovered", "total_failures").alias("recovery_pct"),
                         money("rr").alias("recovered_revenue"),
                         money("lr").alias("lost_revenue"),
                         r2(ratio("days_sum", "days_n")).alias("avg_days_to_recovery"))
                .orderBy(F.desc("recovery_pct"), "gateway"))

    def retry_analysis(self) -> dict[str, DataFrame]:
        return {"detail": self.retry_detail(), "summary": self.retry_summary()}

    # -- F5 ------------------------------------------------------------------------------
    def duplicate_transactions(self, top: int | None = None) -> DataFrame:
        """All duplicate groups, or the first ``top`` of them (a top-k report)."""
        g = duplicate_groups(self.t.payments, top=top)
        return (g.select("user_id", "payment_date", "amount", "duplicate_count", "payment_ids", "gateway")
                .orderBy(F.desc("duplicate_count"), F.desc("amount"), "user_id", "payment_date"))

    # -- F6 ------------------------------------------------------------------------------
    def stale_pending(self, min_days: int = 0) -> DataFrame:
        """Pending payments with no revenue event at all; days_stale counted to ``as_of``.

        ``min_days`` (default 0 = no age filter, as the reference query has none)
        keeps only payments at least that many days old.
        """
        as_of = F.lit(self.params.require_as_of().date())
        pend = self.t.payments.where(F.col("status") == "pending")
        # Events are first cut down to those of pending payments (a semi join against
        # the pending ids, which AQE broadcasts when they are few), so the large event
        # table is filtered where it is scanned instead of shuffled whole for the anti join.
        ev = (self.t.revenue_events.where(F.col("event_id").isNotNull()).select("payment_id")
              .join(pend.select("payment_id"), "payment_id", "left_semi"))
        out = (pend.join(ev, "payment_id", "left_anti")
               .select("payment_id", "user_id", "payment_date", money("amount").alias("amount"),
                       "gateway", "status", days_between(as_of, "payment_date").alias("days_stale")))
        if min_days:
            out = out.where(F.col("days_stale") >= F.lit(min_days))
        return out.orderBy(F.desc("days_stale"), F.desc("amount"), "payment_id")

    # -- F7 / F14 ------------------------------------------------------------------------
    def _leakage_groups(self) -> DataFrame:
        pf = self.t.payment_failures
        rec0 = F.col("recovered") == 0
        per_user = pf.groupBy("user_id", "gateway").agg(
            F.count("failure_id").alias("n"), F.sum("amount").alias("at_risk"),
            sum_where("amount", rec0).alias("leaked"))
        joined = per_user.join(self.t.users.select("user_id", "cohort_month"), "user_id")
        return joined.groupBy("cohort_month", "gateway").agg(
            F.sum("n").alias("failure_count"), F.sum("at_risk").alias("at_risk"),
            F.sum("leaked").alias("leaked"))

    def revenue_leakage(self) -> DataFrame:
        g = self._leakage_groups()
        return (g.select("cohort_month", "gateway",
                         F.col("failure_count").cast("bigint").alias("failure_count"),
                         money("at_risk").alias("total_at_risk"),
                         money("leaked").alias("leaked_revenue"),
                         pct("leaked", "at_risk").alias("leakage_pct"))
                .orderBy(F.desc("leaked_revenue"), "cohort_month", "gateway"))

    def leakage_total(self) -> DataFrame:
        g = self._leakage_groups()
        return g.agg(F.coalesce(money(F.sum("leaked")), F.lit(0.0)).alias("leaked_revenue_total"))

    # -- F8 ------------------------------------------------------------------------------
    def failure_trend(self) -> DataFrame:
        pf = self.t.payment_failures
        return (pf.groupBy("failure_date")
                .agg(F.count(F.lit(1)).alias("failures"),
                     F.sum("recovered").cast("bigint").alias("recovered"),
                     (F.count(F.lit(1)) - F.sum("recovered")).cast("bigint").alias("not_recovered"),
                     money(F.sum("amount")).alias("revenue_at_risk"))
                .orderBy("failure_date"))

    # -- F9 ------------------------------------------------------------------------------
    def top_failure_reasons(self) -> DataFrame:
        pf = self.t.payment_failures
        rec = F.col("recovered")
        return (pf.groupBy("failure_reason")
                .agg(F.count(F.lit(1)).alias("occurrences"),
                     money(F.sum("amount")).alias("total_at_risk"),
                     money(sum_where("amount", rec == 0)).alias("revenue_lost"),
                     pct(F.sum(rec), F.count(F.lit(1))).alias("recovery_pct"))
                .orderBy(F.desc("revenue_lost"), "failure_reason"))

    # -- F10 -----------------------------------------------------------------------------
    def gateway_health(self) -> DataFrame:
        st = F.col("status")
        pay = self.t.payments.groupBy("gateway").agg(
            F.count(F.lit(1)).alias("total_txns"),
            count_where(st == "success").alias("success_txns"),
            count_where(st == "failed").alias("failed_txns"),
            sum_where("amount", st == "success").alias("success_rev"))
        rec = F.col("recovered")
        fail = self.t.payment_failures.groupBy("gateway").agg(
            F.count(F.lit(1)).alias("tf"), F.sum(rec).alias("rc"),
            sum_where("amount", rec == 0).alias("ur"))
        j = pay.join(fail, "gateway", "left")
        tf = F.coalesce(F.col("tf"), F.lit(0)).cast("bigint")
        rc = F.coalesce(F.col("rc"), F.lit(0)).cast("bigint")
        return (j.select("gateway", "total_txns", "success_txns", "failed_txns",
                         pct("success_txns", "total_txns").alias("success_rate_pct"),
                         pct("failed_txns", "total_txns").alias("failure_rate_pct"),
                         tf.alias("total_failures"), rc.alias("recovered_count"),
                         pct(rc, tf).alias("recovery_rate_pct"),
                         money("success_rev").alias("success_revenue"),
                         F.coalesce(money("ur"), F.lit(0.0)).alias("unrecovered_revenue"))
                .orderBy(F.desc("success_rate_pct"), "gateway"))

    # -- F11 -----------------------------------------------------------------------------
    def null_monitoring(self) -> DataFrame:
        a, b, _, _, e = NULL_MONITOR_LABELS
        pay = self.t.payments.agg(*_payment_null_counts())
        rows = pay.selectExpr(_stack([(a, "a"), (b, "b"), (e, "e")])).unionByName(self._other_null_counts())
        return rows.orderBy(F.desc("issue_count"), "check_name")

    def _other_null_counts(self) -> DataFrame:
        """The null monitoring rows of users and payment_failures."""
        _, _, c, d, _ = NULL_MONITOR_LABELS
        usr = self.t.users.agg(count_where(F.col("active").isNull()).alias("c"))
        fl = self.t.payment_failures.agg(count_where((F.col("recovered") == 1) & F.col("recovery_date").isNull()).alias("d"))
        return usr.selectExpr(_stack([(c, "c")])).unionByName(fl.selectExpr(_stack([(d, "d")])))

    # -- F12 -----------------------------------------------------------------------------
    def reconciliation_check(self) -> dict[str, DataFrame]:
        return {"duplicates": self.duplicate_transactions(),
                "stale_pending": self.stale_pending(),
                "nulls": self.null_monitoring()}

    def reconciliation_summary(self) -> DataFrame:
        """One row per reconciliation part: offending rows, and for nulls the checks with issues.

        Duplicate groups and the null counts of payments come from one scan: the counts ride
        along with the fingerprint counts (id lists are not needed). Stale payments are looked
        up by id, from the pending rows alone (the status is pushed into their scan).
        """
        per = self.t.payments.groupBy(*FINGERPRINT).agg(F.count("payment_id").alias("n"), *_payment_null_counts())
        one = per.agg(count_where(F.col("n") > 1).alias("dups"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "abe"))
        stale = self.stale_pending().agg(F.lit("stale_pending").alias("section"), F.count(F.lit(1)).alias("rows"))
        others = self._other_null_counts().agg(F.lit("null_alerts").alias("section"), count_where(F.col("issue_count") > 0).alias("rows"))
        paid = F.expr("CAST(a > 0 AS BIGINT) + CAST(b > 0 AS BIGINT) + CAST(e > 0 AS BIGINT)")
        both = one.select(F.explode(F.array(F.struct(F.lit("duplicates").alias("section"), F.col("dups").alias("rows")),
                                            F.struct(F.lit("null_alerts").alias("section"), paid.alias("rows")))).alias("r")).select("r.*")
        return both.unionByName(others).unionByName(stale).groupBy("section").agg(F.sum("rows").alias("rows"))

    def retry_analysis_summary(self) -> DataFrame:
        r = self.retry_analysis()
        return (r["detail"].agg(F.lit("detail").alias("part"), F.count(F.lit(1)).alias("rows"),
                                F.sum("recovered_count").cast("bigint").alias("recovered"))
                .unionByName(r["summary"].agg(F.lit("summary").alias("part"), F.count(F.lit(1)).alias("rows"),
                                              F.sum("recovered").cast("bigint").alias("recovered"))))

    # -- S16 -----------------------------------------------------------------------
    def export_full_report(self, out_dir: str) -> tuple[str, str]:
        """Failure monitor and retry summary as two CSVs under ``out_dir``."""
        from ledgerlens.sources.reports import export_full_report

        return export_full_report(self, out_dir)

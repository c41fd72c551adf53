"""Graded data-quality checks.

Each check is a row ``check_name, status, message, metric, threshold`` (all
STRING). The aggregates are computed by Spark and the status rule and message
are column expressions (``when`` chains, ``format_string``), so a check never
pulls data to the driver; the report reads one row per aggregate pass.

Plan: all eight checks are answered from five aggregate passes —

* payments profile: one pass for ARPU, revenue, failure rate, freshness and the
  payment null counts;
* payments ⟕ users, pre-aggregated per (user, day) map-side: orphans and
  pre-signup payments together;
* fingerprint grouping: duplicate statistics (the payment total is the sum of
  the group sizes, so no second count);
* users and payment_failures: cohort statistics and null counts.

The report (``run_all``) runs every pass once, side by side, and applies the rules to the
five one-row results: five jobs, three scans of payments. A pass that fails is carried
to the checks that need it: those are then evaluated on their own, where a check reads only
the columns of its rule, and one that still raises is an ``ERROR`` row with the whole text.
A check asked for alone combines the passes it needs into one row (``union`` + ``max``).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.expr import count_where, month_key, pct, py_repr, py_str_2dp, r2, ratio
from ledgerlens.functions.fmt import fixed, fixed_commas
from ledgerlens.operators.failures import FINGERPRINT, duplicate_groups
from ledgerlens.params import Params
from ledgerlens.sources.tables import Tables, as_tables

CHECK_COLUMNS = ("check_name", "status", "message", "metric", "threshold")
STATUSES = ("PASS", "WARN", "FAIL", "ERROR")

# Fixed values that must equal the reference: the ten scanned columns (in scan
# order), the critical ones, and the fixed message texts.
NULL_SCAN_COLUMNS = (
    ("users", "user_id"), ("users", "cohort_month"), ("users", "active"),
    ("payments", "payment_id"), ("payments", "user_id"), ("payments", "amount"),
    ("payments", "status"), ("payments", "gateway"),
    ("payment_failures", "failure_reason"), ("payment_failures", "gateway"),
)
CRITICAL_COLUMNS = ("users.user_id", "payments.payment_id", "payments.amount", "payments.status")
# Message templates: ``%s`` is filled per row by Spark (format_string), ``{name}`` from
# Params on the driver; ``%%`` is a literal percent sign.
MESSAGES = {
    "arpu_no_payers": "No paying users — ARPU undefined.",
    "arpu_low": "ARPU %s below minimum {min_arpu}.",
    "arpu_ok": "ARPU=%s  paying_users=%s",
    "revenue_zero": "Total revenue is %s — pipeline may be broken.",
    "revenue_anomalies": "Revenue OK (%s) but %s non-positive, %s null amounts.",
    "revenue_ok": "Total revenue = %s — clean.",
    "cohort_fail": "%s null cohort months; %s pre-signup payments.",
    "cohort_mismatch": "%s cohort_month values don't match signup_date.",
    "cohort_ok": "%s cohorts — all valid, 0 pre-signup anomalies.",
    "failure_fail": "Failure rate %s%% exceeds max {max_pct}%% (%s/%s).",
    "failure_warn": "Failure rate %s%% approaching threshold.",
    "failure_ok": "Failure rate %s%%  (%s/%s).",
    "dupes_fail": "Duplicate rate %s exceeds max {max_rate} (%s groups, %s excess rows).",
    "dupes_warn": "%s duplicate groups (%s excess rows) — rate %s within threshold.",
    "dupes_ok": "No duplicate transactions detected.",
    "nulls_fail": "Critical columns have NULLs: %s",
    "nulls_warn": "%s column(s) exceed null threshold: %s",
    "nulls_ok": "All %s scanned columns within null threshold.",
    "fresh_none": "No successful payments found in database.",
    "fresh_stale": "Latest payment %s is %s days old (SLA={sla}h). Normal in dev — data ends 2024-12-31.",
    "fresh_ok": "Latest payment %s — %sh ago.",
    "orphans_fail": "%s payments reference non-existent users.",
    "orphans_ok": "No orphan payments — FK integrity intact.",
}
THRESHOLDS = {
    "revenue": "> 0",
    "revenue_anomalies": "no nulls/negatives",
    "cohort": "no nulls / no pre-signup",
    "cohort_mismatch": "zero mismatches",
    "failure": "<= {max_pct}%",
    "nulls_fail": "0 nulls in critical columns",
    "nulls": "null_rate <= {max_null}",
    "fresh_none": "within {sla}h",
    "fresh": "within {sla}h of now",
    "orphans": "0",
}
M, TH = MESSAGES, THRESHOLDS


def _s(v) -> Column:
    return F.lit(None).cast("string") if v is None else F.lit(str(v))


def _f2(c: Column) -> Column:
    return fixed(c, 2)


def _f1(c: Column) -> Column:
    return fixed(c, 1)


def _comma2(c: Column) -> Column:
    return fixed_commas(c, 2)


def _comma0(c: Column) -> Column:
    return F.format_number(c.cast("bigint"), 0)


def _check(df: DataFrame, name: str, status: Column, message: Column, metric: Column,
           threshold: Column) -> DataFrame:
    return df.select(F.lit(name).alias("check_name"), status.alias("status"), message.alias("message"),
                     metric.cast("string").alias("metric"), threshold.cast("string").alias("threshold"))


def _pick(*branches: tuple[Column, Column], otherwise: Column) -> Column:
    expr = None
    for cond, val in branches:
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr.otherwise(otherwise)


@dataclass(frozen=True)
class CheckResult:
    """A check row with the records behind it; ``detail`` is planned when it is asked for."""

    check: DataFrame
    _detail: Callable[[], DataFrame] | None = None

    @property
    def detail(self) -> DataFrame | None:
        return self._detail() if self._detail else None


class Validator:
    def __init__(self, tables: Tables | dict[str, DataFrame], params: Params | None = None):
        self.t = as_tables(tables)
        self.params = params or Params()

    # -- the five aggregate passes --------------------------------------------------------
    def payments_profile(self) -> DataFrame:
        st, amt = F.col("status"), F.col("amount")
        ok = st == "success"
        return self.t.payments.agg(
            F.sum(F.when(ok, amt)).alias("succ_rev"),
            F.countDistinct(F.when(ok, F.col("user_id"))).alias("payers"),
            F.sum(F.when(ok, amt).otherwise(F.lit(0))).alias("rev_else0"),
            count_where(amt <= 0).alias("nonpos"),
            F.count(F.lit(1)).alias("t_payments"),
            count_where(st == "failed").alias("failed"),
            F.max(F.when(ok, F.col("payment_date"))).alias("latest"),
            count_where(ok).alias("succ_n"),
            *_null_counts("payments"))

    def success_profile(self) -> DataFrame:
        """The successful payments' part of the profile, with the status filter in the scan."""
        return self.t.payments.where(F.col("status") == "success").agg(
            F.sum("amount").alias("succ_rev"), F.countDistinct("user_id").alias("payers"),
            F.max("payment_date").alias("latest"), F.count(F.lit(1)).alias("succ_n"))

    def payments_user_links(self) -> DataFrame:
        """orphan_payments and pre_signup from one payments ⟕ users pass.

        Payments are first reduced to one row per (user, day) map-side, so a user
        with a large share of all payments reaches the join as a few rows.
        """
        per = self.t.payments.groupBy("user_id", "payment_date").agg(
            F.count(F.lit(1)).alias("n"), count_where(F.col("status") == "success").alias("n_ok"))
        u = self.t.users.select("user_id", "signup_date", F.lit(1).alias("_present"))
        j = per.join(u, "user_id", "left")
        present = F.col("_present").isNotNull()
        return j.agg(
            F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).cast("bigint").alias("orphan_payments"),
            F.coalesce(F.sum(F.when(present & (F.col("payment_date") < F.col("signup_date")), F.col("n_ok"))),
                       F.lit(0)).cast("bigint").alias("pre_signup"))

    def duplicate_stats(self) -> DataFrame:
        """duplicate_groups, total_duplicate_rows, excess_rows, duplicate_rate in one grouping pass."""
        g = self.t.payments.groupBy(*FINGERPRINT).agg(F.count("payment_id").alias("cnt"),
                                                      F.count(F.lit(1)).alias("rows"))
        dup = F.col("cnt") > 1
        a = g.agg(count_where(dup).alias("duplicate_groups"),
                  F.sum(F.when(dup, F.col("cnt"))).alias("total_duplicate_rows"),
                  F.sum("rows").alias("all_rows"))
        excess = F.col("total_duplicate_rows") - F.col("duplicate_groups")
        return a.select("duplicate_groups", "total_duplicate_rows", excess.alias("excess_rows"),
                        ratio(excess, "all_rows").alias("duplicate_rate"))

    def users_profile(self) -> DataFrame:
        cm = F.col("cohort_month")
        return self.t.users.agg(
            F.count(F.lit(1)).alias("t_users"),
            count_where(cm != month_key("signup_date")).alias("coh_mismatched"),
            F.countDistinct(cm).alias("n_cohorts"),
            *_null_counts("users"))

    def failures_profile(self) -> DataFrame:
        return self.t.payment_failures.agg(F.count(F.lit(1)).alias("t_payment_failures"),
                                           *_null_counts("payment_failures"))

    def _wide(self, *parts: str) -> DataFrame:
        """The named one-row aggregates side by side in one row (union, then max per column)."""
        frames = [getattr(self, p)() for p in parts]
        if len(frames) == 1:
            return frames[0]
        cols = [c for f in frames for c in f.columns]
        u = frames[0]
        for f in frames[1:]:
            u = u.unionByName(f, allowMissingColumns=True)
        return u.agg(*[F.max(c).alias(c) for c in cols])

    # -- rules: four STRING columns per check over the wide row --------------------------------
    def _rule_validate_arpu(self):
        p = self.params
        arpu = F.coalesce(r2(ratio("succ_rev", "payers")), F.lit(0.0))
        payers = F.col("payers")
        low = arpu < F.lit(p.min_arpu)
        status = _pick((payers == 0, F.lit("WARN")), (low, F.lit("FAIL")), otherwise=F.lit("PASS"))
        msg = _pick((payers == 0, F.lit(M["arpu_no_payers"])),
                    (low, F.format_string(M["arpu_low"].format(min_arpu=p.min_arpu), _f2(arpu))),
                    otherwise=F.format_string(M["arpu_ok"], _comma2(arpu), _comma0(payers)))
        return status, msg, py_str_2dp(arpu), _s(p.min_arpu)

    def _rule_validate_revenue(self):
        rev_dec = F.coalesce(F.col("rev_else0"), F.lit(0))
        rev = rev_dec.cast("double")
        nonpos, nulls = F.col("nonpos"), F.col("n_payments_amount")
        fail, warn = rev <= 0, (nonpos > 0) | (nulls > 0)
        status = _pick((fail, F.lit("FAIL")), (warn, F.lit("WARN")), otherwise=F.lit("PASS"))
        msg = _pick((fail, F.format_string(M["revenue_zero"], _f2(rev))),
                    (warn, F.format_string(M["revenue_anomalies"], _comma2(rev), nonpos.cast("string"),
                                           nulls.cast("string"))),
                    otherwise=F.format_string(M["revenue_ok"], _comma2(rev)))
        thr = F.when(~fail & warn, F.lit(TH["revenue_anomalies"])).otherwise(F.lit(TH["revenue"]))
        return status, msg, py_str_2dp(rev_dec), thr

    def _rule_validate_cohort(self):
        nulls, mism = F.col("n_users_cohort_month"), F.col("coh_mismatched")
        n, pre = F.col("n_cohorts"), F.col("pre_signup")
        fail, warn = (nulls > 0) | (pre > 0), mism > 0
        status = _pick((fail, F.lit("FAIL")), (warn, F.lit("WARN")), otherwise=F.lit("PASS"))
        msg = _pick((fail, F.format_string(M["cohort_fail"], nulls.cast("string"), pre.cast("string"))),
                    (warn, F.format_string(M["cohort_mismatch"], mism.cast("string"))),
                    otherwise=F.format_string(M["cohort_ok"], n.cast("string")))
        thr = F.when(~fail & warn, F.lit(TH["cohort_mismatch"])).otherwise(F.lit(TH["cohort"]))
        return status, msg, n.cast("string"), thr

    def _rule_validate_failure_rate(self):
        p = self.params
        rate = F.coalesce(pct("failed", "t_payments"), F.lit(0.0))
        total, failed = F.col("t_payments").cast("string"), F.col("failed").cast("string")
        max_pct, warn_pct = p.max_failure_pct, p.warn_failure_pct
        fail, warn = rate > F.lit(max_pct), rate > F.lit(warn_pct)
        status = _pick((fail, F.lit("FAIL")), (warn, F.lit("WARN")), otherwise=F.lit("PASS"))
        msg = _pick((fail, F.format_string(M["failure_fail"].format(max_pct=f"{max_pct:.0f}"), _f1(rate),
                                           failed, total)),
                    (warn, F.format_string(M["failure_warn"], _f1(rate))),
                    otherwise=F.format_string(M["failure_ok"], _f1(rate), failed, total))
        return status, msg, py_str_2dp(rate), F.lit(TH["failure"].format(max_pct=f"{max_pct:.0f}"))

    def _rule_detect_duplicates(self):
        mx = self.params.max_duplicate_rate
        groups = F.coalesce(F.col("duplicate_groups"), F.lit(0))
        excess = F.coalesce(F.col("excess_rows"), F.lit(0))
        rate = F.coalesce(F.col("duplicate_rate"), F.lit(0.0))
        rate_pct = F.concat(fixed(rate * F.lit(100.0), 2), F.lit("%"))
        mx_txt = f"{mx:.2%}".replace("%", "%%")          # a literal % inside a format_string pattern
        fail, warn = rate > F.lit(mx), groups > 0
        status = _pick((fail, F.lit("FAIL")), (warn, F.lit("WARN")), otherwise=F.lit("PASS"))
        msg = _pick((fail, F.format_string(M["dupes_fail"].format(max_rate=mx_txt), rate_pct,
                                           groups.cast("string"), excess.cast("string"))),
                    (warn, F.format_string(M["dupes_warn"], groups.cast("string"), excess.cast("string"),
                                           rate_pct)),
                    otherwise=F.lit(M["dupes_ok"]))
        return status, msg, py_repr(rate), _s(mx)

    def _rule_detect_nulls(self):
        p = self.params
        scan = _scan_array()
        crit = F.filter(scan, lambda x: x["column_ref"].isin(*CRITICAL_COLUMNS) & (x["null_count"] > 0))
        high = F.filter(scan, lambda x: x["null_rate"] > F.lit(p.max_null_rate))

        def py_list(arr):
            names = F.transform(arr, lambda x: F.concat(F.lit("'"), x["column_ref"], F.lit("'")))
            return F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]"))

        fail, warn = F.size(crit) > 0, F.size(high) > 0
        status = _pick((fail, F.lit("FAIL")), (warn, F.lit("WARN")), otherwise=F.lit("PASS"))
        msg = _pick((fail, F.format_string(M["nulls_fail"], py_list(crit))),
                    (warn, F.format_string(M["nulls_warn"], F.size(high).cast("string"), py_list(high))),
                    otherwise=F.format_string(M["nulls_ok"], F.size(scan).cast("string")))
        thr = F.when(fail, F.lit(TH["nulls_fail"])).otherwise(
            F.lit(TH["nulls"].format(max_null=f"{p.max_null_rate:.0%}")))
        return status, msg, F.lit(None).cast("string"), thr

    def _rule_freshness_check(self):
        p = self.params
        as_of = p.require_as_of()
        frac_hours = as_of.hour + as_of.minute / 60 + as_of.second / 3600 + as_of.microsecond / 3.6e9
        latest = F.col("latest")
        latest_s = latest.cast("string")
        age = F.datediff(F.lit(as_of.date()), latest).cast("double") * F.lit(24.0) + F.lit(frac_hours)
        sla = p.freshness_sla_hours
        none = latest.isNull() | (F.col("succ_n") == 0)
        stale = age > F.lit(float(sla))
        status = _pick((none, F.lit("FAIL")), (stale, F.lit("WARN")), otherwise=F.lit("PASS"))
        msg = _pick((none, F.lit(M["fresh_none"])),
                    (stale, F.format_string(M["fresh_stale"].format(sla=sla), latest_s, _f1(age / F.lit(24.0)))),
                    otherwise=F.format_string(M["fresh_ok"], latest_s, _f1(age)))
        metric = F.when(none, F.lit(None).cast("string")).otherwise(latest_s)
        thr = F.when(none, F.lit(TH["fresh_none"].format(sla=sla))).otherwise(F.lit(TH["fresh"].format(sla=sla)))
        return status, msg, metric, thr

    def _rule_orphan_check(self):
        n = F.col("orphan_payments")
        status = F.when(n > 0, F.lit("FAIL")).otherwise(F.lit("PASS"))
        msg = F.when(n > 0, F.format_string(M["orphans_fail"], n.cast("string"))).otherwise(F.lit(M["orphans_ok"]))
        return status, msg, n.cast("string"), F.lit(TH["orphans"])

    # Which aggregate passes each check reads.
    NEEDS = {
        "validate_arpu": ("payments_profile",),
        "validate_revenue": ("payments_profile",),
        "validate_cohort": ("users_profile", "payments_user_links"),
        "validate_failure_rate": ("payments_profile",),
        "detect_duplicates": ("duplicate_stats",),
        "detect_nulls": ("users_profile", "payments_profile", "failures_profile"),
        "freshness_check": ("payments_profile",),
        "orphan_check": ("payments_user_links",),
    }
    CHECK_ORDER = tuple(NEEDS)
    # A check that runs alone reads less: successful payments only, an anti join.
    ALONE = {"validate_arpu": ("success_profile",), "freshness_check": ("success_profile",),
             "orphan_check": ("orphan_count",)}

    def _one(self, name: str) -> DataFrame:
        status, msg, metric, thr = getattr(self, f"_rule_{name}")()
        return self._wide(*self.ALONE.get(name, self.NEEDS[name])).select(
            F.lit(name).alias("check_name"), status.alias("status"), msg.alias("message"),
            metric.cast("string").alias("metric"), thr.cast("string").alias("threshold"))

    def validate_arpu(self) -> DataFrame:
        return self._one("validate_arpu")

    def validate_revenue(self) -> DataFrame:
        return self._one("validate_revenue")

    def validate_cohort(self) -> DataFrame:
        return self._one("validate_cohort")

    def validate_failure_rate(self) -> DataFrame:
        return self._one("validate_failure_rate")

    def detect_duplicates(self) -> DataFrame:
        return self._one("detect_duplicates")

    def detect_nulls(self) -> DataFrame:
        return self._one("detect_nulls")

    def freshness_check(self) -> DataFrame:
        return self._one("freshness_check")

    def orphan_check(self) -> DataFrame:
        return self._one("orphan_check")

    def orphan_count(self) -> DataFrame:
        """Stand-alone orphan count: payments pre-aggregated per user, LEFT ANTI users."""
        per_user = self.t.payments.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
        orphans = per_user.join(self.t.users.select("user_id"), "user_id", "left_anti")
        return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("orphan_payments"))

    # Checks with records behind them, by the method that lists these.
    DETAILS = {"detect_duplicates": "duplicates_detail", "detect_nulls": "null_scan"}

    def result(self, name: str) -> CheckResult:
        """One check with its detail: the top duplicate groups, the scanned columns, or none."""
        if name not in self.NEEDS:
            raise KeyError(f"unknown check {name!r}")
        return CheckResult(getattr(self, name)(), getattr(self, self.DETAILS[name]) if name in self.DETAILS else None)

    def duplicates_detail(self, limit: int = 20) -> DataFrame:
        """Top ``limit`` duplicate groups by count, then amount (a top-k report)."""
        return (duplicate_groups(self.t.payments, top=limit)
                .select("user_id", "payment_date", "amount", "gateway", "duplicate_count", "payment_ids")
                .orderBy(F.desc("duplicate_count"), F.desc("amount"), "user_id", "payment_date"))

    def null_scan(self) -> DataFrame:
        """column_ref, null_count, total_rows, null_rate for the ten scanned columns, in scan order."""
        wide = self._wide("users_profile", "payments_profile", "failures_profile")
        return (wide.select(F.inline(_scan_array(with_ord=True)))
                .orderBy("ord").drop("ord"))

    # -- V11 / V12 -----------------------------------------------------------------------
    def pass_results(self) -> dict[str, dict | Exception]:
        """Each aggregate pass's values by column, or the error that ended it; the passes run side by side."""
        parts = list(dict.fromkeys(p for name in self.CHECK_ORDER for p in self.NEEDS[name]))

        def one(part: str) -> dict | Exception:
            try:
                df = getattr(self, part)()
                row = df.first()  # an aggregate without groups: always one row
                return {f.name: F.lit(row[f.name]).cast(f.dataType) for f in df.schema}
            except Exception as exc:  # noqa: BLE001 - goes to the checks that need the pass
                return exc

        with ThreadPoolExecutor(len(parts)) as pool:
            return dict(zip(parts, pool.map(one, parts), strict=True))

    def _by_rule(self, spark: SparkSession, names: list[str], values: dict[str, Column]) -> list[tuple]:
        """Result rows of checks whose passes are done: constants in, so nothing is scanned."""
        rules = []
        for name in names:
            status, msg, metric, thr = getattr(self, f"_rule_{name}")()
            rules.append(F.struct(F.lit(name).alias("check_name"), status.alias("status"), msg.alias("message"),
                                  metric.cast("string").alias("metric"), thr.cast("string").alias("threshold")).alias(name))
        row = spark.range(1).select(*(c.alias(k) for k, c in values.items())).select(*rules).first()
        return [tuple(row[name][c] for c in CHECK_COLUMNS) for name in names]

    def run_all(self, spark: SparkSession | None = None) -> DataFrame:
        """The eight checks in fixed order; one that raises becomes an ERROR row with the whole
        error text. Only the one-row results of passes and checks reach the driver."""
        spark = spark or SparkSession.active()
        results = self.pass_results()
        values = {k: c for r in results.values() if isinstance(r, dict) for k, c in r.items()}
        sound = [n for n in self.CHECK_ORDER if all(isinstance(results[p], dict) for p in self.NEEDS[n])]
        try:
            rows = dict(zip(sound, self._by_rule(spark, sound, values), strict=True)) if sound else {}
        except Exception:  # noqa: BLE001 - some rule raises: the checks are evaluated one by one below
            rows = {}
        for name in self.CHECK_ORDER:
            if name not in rows:
                try:
                    rows[name] = self._by_rule(spark, [name], values)[0] if name in sound else tuple(getattr(self, name)().first())
                except Exception as exc:  # noqa: BLE001 - any failure of one check is reported, not raised
                    rows[name] = (name, "ERROR", str(exc) or repr(exc), None, None)
        return spark.createDataFrame([rows[n] for n in self.CHECK_ORDER], ", ".join(f"{c} string" for c in CHECK_COLUMNS))

    def run_all_isolated(self, spark: SparkSession | None = None) -> DataFrame:
        """The same as ``run_all``, which isolates its checks itself."""
        return self.run_all(spark)

    def quality_report(self) -> DataFrame:
        """The report users read: a check that raises is an ERROR row, the others still stand."""
        return self.run_all()

    def export_quality_report(self, out_dir: str) -> str:
        """The check rows (five columns, no detail) as ``quality_report.csv``."""
        from ledgerlens.sources.reports import export_quality_report

        return export_quality_report(self, out_dir)


def _null_counts(table: str) -> list[Column]:
    return [count_where(F.col(c).isNull()).alias(f"n_{table}_{c}") for t, c in NULL_SCAN_COLUMNS if t == table]


def _scan_array(with_ord: bool = False) -> Column:
    """The ten (column_ref, null_count, total_rows, null_rate) entries of the wide row, in scan order."""
    items = []
    for i, (t, c) in enumerate(NULL_SCAN_COLUMNS):
        n, tot = F.col(f"n_{t}_{c}"), F.col(f"t_{t}")
        rate = n.cast("double") / F.when(tot == 0, F.lit(1)).otherwise(tot).cast("double")
        fields = ([F.lit(i).alias("ord")] if with_ord else []) + [
            F.lit(f"{t}.{c}").alias("column_ref"), n.alias("null_count"), tot.alias("total_rows"),
            rate.alias("null_rate")]
        items.append(F.struct(*fields))
    return F.array(*items)


def status_tally(checks: DataFrame) -> DataFrame:
    """PASS/WARN/FAIL/ERROR counts, each status present even when zero."""
    a = checks.agg(*[count_where(F.col("status") == s).alias(s) for s in STATUSES])
    stack = ", ".join(f"'{s}', `{s}`" for s in STATUSES)
    return a.selectExpr(f"stack({len(STATUSES)}, {stack}) AS (status, count)")


def scalar(df: DataFrame, col: str):
    """The first row's value of ``col`` or None (absent column, no row, NaN)."""
    if col not in df.columns:
        return None
    r = df.select(col).first()
    if r is None:
        return None
    v = r[0]
    if isinstance(v, float) and v != v:
        return None
    return v

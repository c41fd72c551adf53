"""Signup-cohort analytics.

Plan notes:

* Payments are pre-aggregated to one row per (user_id, month) — or per user
  for lifetime views — before the join with ``users``. The partial aggregate
  runs map-side, so a user holding a large share of all payments is one row per
  month by the time it reaches the join, and ``COUNT(DISTINCT user_id)`` per
  cohort × month becomes a plain ``COUNT(*)`` (``users.user_id`` is the primary
  key, so a pre-aggregated row joins at most one user).
* The join side ``users`` is the dimension; no broadcast hint is forced — AQE
  turns the sort-merge join into a broadcast only when the measured size of
  the users side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.
* The matrix sums once per (cohort, offset), and only those few rows are pivoted by
  conditional aggregates (offsets 0..max_months fixed): one decimal sum per
  per-user-month row instead of one per cell.
* ``cohort_arpu`` and ``cohort_lifetime`` share one users ⟕ per-user-revenue pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.expr import month_key, month_offset, money, pct, r2, r2_even, ratio
from ledgerlens.params import Params
from ledgerlens.sources.tables import Tables, as_tables


class CohortEngine:
    def __init__(self, tables: Tables | dict[str, DataFrame], params: Params | None = None):
        self.t = as_tables(tables)
        self.params = params or Params()

    def _success(self) -> DataFrame:
        return self.t.payments.where(F.col("status") == "success")

    # -- C1 ------------------------------------------------------------------------
    def cohort_size(self) -> DataFrame:
        return (self.t.users.groupBy("cohort_month")
                .agg(F.count("user_id").alias("cohort_size"))
                .orderBy("cohort_month"))

    # -- C2 / Q2 / C7 ------------------------------------------------------------------
    def _cohort_month_rows(self) -> DataFrame:
        """(cohort_month, month_start, months_since_signup, user_id, rev) with offset ≥ 0."""
        per_user_month = (self._success()
                          .groupBy("user_id", F.trunc("payment_date", "month").alias("month_start"))
                          .agg(F.sum("amount").alias("rev")))
        j = per_user_month.join(self.t.users.select("user_id", "cohort_month"), "user_id")
        off = month_offset("month_start", "cohort_month")
        return (j.select("cohort_month", "month_start", off.alias("months_since_signup"), "user_id", "rev")
                .where(F.col("months_since_signup") >= 0))

    def _cohort_revenue_long(self, by_calendar_month: bool = True) -> DataFrame:
        # The calendar month is grouped as a date and formatted after the aggregate.
        keys = ["cohort_month"] + (["month_start"] if by_calendar_month else []) + ["months_since_signup"]
        g = (self._cohort_month_rows().groupBy(*keys)
             .agg(F.count(F.lit(1)).alias("paying_users"), money(F.sum("rev")).alias("revenue")))
        if by_calendar_month:
            g = g.withColumn("revenue_month", month_key("month_start")).drop("month_start")
        return g

    def cohort_revenue_raw(self) -> DataFrame:
        return (self._cohort_revenue_long()
                .select("cohort_month", "revenue_month", "months_since_signup", "paying_users", "revenue")
                .orderBy("cohort_month", "months_since_signup"))

    def sql_cohort_revenue(self) -> DataFrame:
        """Stand-alone report shape: grouped by months since signup, no calendar month."""
        return (self._cohort_revenue_long(by_calendar_month=False)
                .select("cohort_month", "months_since_signup", "paying_users", "revenue")
                .orderBy("cohort_month", "months_since_signup"))

    def cohort_count(self) -> DataFrame:
        return self._cohort_revenue_long().agg(F.countDistinct("cohort_month").alias("cohort_count"))

    # -- C3 / C4 -------------------------------------------------------------------------
    def cohort_revenue_matrix(self, max_months: int | None = None) -> DataFrame:
        """cohort_month, m0..mN: revenue by months since signup, 0 where a cohort had none.

        Cohorts whose revenue all falls after month N are absent. Each offset is one
        calendar month of the cohort, so a cell is the exact decimal sum of that month,
        as in the long form.
        """
        n = self.params.max_months if max_months is None else max_months
        rows = (self._cohort_month_rows().where(F.col("months_since_signup") <= n)
                .groupBy("cohort_month", "months_since_signup").agg(F.sum("rev").alias("rev")))
        off = F.col("months_since_signup")
        cells = [F.coalesce(F.sum(F.when(off == k, F.col("rev"))), F.lit(0)).cast("double").alias(f"m{k}")
                 for k in range(n + 1)]
        return rows.groupBy("cohort_month").agg(*cells).orderBy("cohort_month")

    def cohort_retention(self, max_months: int | None = None) -> DataFrame:
        """Each cell as % of the cohort's month-0 revenue (half-even, 2 dp); all NULL when m0 is 0."""
        n = self.params.max_months if max_months is None else max_months
        m = self.cohort_revenue_matrix(n)
        cells = [r2_even(ratio(f"m{k}", "m0") * F.lit(100.0)).alias(f"m{k}") for k in range(n + 1)]
        return m.select("cohort_month", *cells).orderBy("cohort_month")

    def cohort_heatmap_long(self, max_months: int | None = None) -> DataFrame:
        """Long form of the zero-filled matrix: cohort_month, months_since_signup, revenue."""
        n = self.params.max_months if max_months is None else max_months
        m = self.cohort_revenue_matrix(n)
        stack = ", ".join(f"{k}, m{k}" for k in range(n + 1))
        return (m.selectExpr("cohort_month", f"stack({n + 1}, {stack}) AS (months_since_signup, revenue)")
                .orderBy("cohort_month", "months_since_signup"))

    # -- C5 / C6 -------------------------------------------------------------------------
    def _cohort_totals(self) -> DataFrame:
        """users ⟕ per-user success totals, grouped by cohort."""
        per_user = (self._success().groupBy("user_id")
                    .agg(F.sum("amount").alias("rev"), F.count("payment_id").alias("n_tx"))
                    .withColumn("has_pay", F.lit(1)))
        j = self.t.users.select("user_id", "cohort_month").join(per_user, "user_id", "left")
        return j.groupBy("cohort_month").agg(
            F.count("user_id").alias("cohort_size"),
            F.count("has_pay").alias("paying_users"),
            F.sum("rev").alias("rev"),
            F.coalesce(F.sum("n_tx"), F.lit(0)).alias("total_transactions"))

    def cohort_arpu(self) -> DataFrame:
        """Cohorts with at least one payer; ARPU on the rounded lifetime revenue ÷ cohort size."""
        g = self._cohort_totals().where((F.col("paying_users") > 0) & F.col("cohort_month").isNotNull())
        return (g.select("cohort_month", "cohort_size", "paying_users",
                         money("rev").alias("lifetime_revenue"),
                         r2(ratio(money("rev"), "cohort_size")).alias("arpu_per_user"),
                         pct("paying_users", "cohort_size").alias("conversion_pct"))
                .orderBy("cohort_month"))

    def cohort_lifetime(self) -> DataFrame:
        """Every cohort, including those without a payer (revenue NULL, 0 transactions)."""
        g = self._cohort_totals()
        return (g.select("cohort_month", "cohort_size", "paying_users",
                         money("rev").alias("lifetime_revenue"),
                         F.col("total_transactions").cast("bigint").alias("total_transactions"))
                .orderBy("cohort_month"))

    # -- S15 -----------------------------------------------------------------------
    def export_cohort_report(self, out_dir: str) -> str:
        """Cohort ARPU as ``cohort_report.csv`` under ``out_dir``."""
        from ledgerlens.sources.reports import export_cohort_report

        return export_cohort_report(self, out_dir)

"""Alert rules over the metrics — an extension: the reference only names these rules in prose.

Every window runs on aggregates (a row per month, or per gateway and day), never on payments.
The choices the prose leaves open are parameters with the value used stated here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.functions.expr import count_where, money, month_key, pct, r2
from ledgerlens.operators.metrics import MetricsEngine
from ledgerlens.params import Params
from ledgerlens.sources.tables import Tables, as_tables

ROLLING_MONTHS = 3
GROWTH_RUN = 2
TRAILING_DAYS = 30
MIN_SUCCESS_PCT = 70.0


class AlertRules:
    def __init__(self, tables: Tables | dict[str, DataFrame], params: Params | None = None):
        self.t = as_tables(tables)
        self.params = params or Params()

    def revenue_alert(self, months: int = ROLLING_MONTHS) -> DataFrame:
        """Each month with the average of the ``months`` months with revenue before it (fewer at the
        start, NULL for the first) and whether its revenue is below; compared on exact sums."""
        monthly = (self.t.payments.where(F.col("status") == "success").groupBy(F.trunc("payment_date", "month").alias("m"))
                   .agg(F.sum("amount").alias("rev")))
        before = Window.orderBy("m").rowsBetween(-months, -1)
        w = monthly.select("m", "rev", F.sum("rev").over(before).alias("s"), F.count("rev").over(before).alias("n"))
        average = F.when(F.col("n") > 0, r2(money("s") / F.col("n")))
        below = F.coalesce(F.col("rev") * F.col("n") < F.col("s"), F.lit(False))
        return w.select(month_key("m").alias("month"), money("rev").alias("revenue"), average.alias("rolling_avg"),
                        below.alias("below_average")).orderBy("month")

    def negative_growth_runs(self, least: int = GROWTH_RUN) -> DataFrame:
        """Runs of at least ``least`` months in a row with negative growth: first and last month, length,
        and the revenue before and at the end of the run."""
        growth = MetricsEngine(self.t, self.params).revenue_growth()
        fell = F.coalesce(F.col("growth_pct") < 0, F.lit(False))
        # Months between two that did not fall share the count of those before them.
        island = F.sum((~fell).cast("int")).over(Window.orderBy("month"))
        runs = growth.select("*", fell.alias("fell"), island.alias("island")).where("fell")
        return (runs.groupBy("island").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count(F.lit(1)).alias("months"),
                                           F.min_by("prev_revenue", "month").alias("revenue_before"), F.max_by("revenue", "month").alias("revenue_after"))
                .where(F.col("months") >= least).drop("island").orderBy("first_month"))

    def gateway_trailing_success(self, days: int = TRAILING_DAYS, least: float = MIN_SUCCESS_PCT) -> DataFrame:
        """For each gateway and day with payments: payments and success rate of the ``days`` days that end
        with it, and whether the rate is below ``least`` percent."""
        daily = (self.t.payments.where(F.col("payment_date").isNotNull()).groupBy("gateway", "payment_date")
                 .agg(F.count(F.lit(1)).alias("n"), count_where(F.col("status") == "success").alias("ok")))
        day = F.unix_date("payment_date")
        trailing = Window.partitionBy("gateway").orderBy(day).rangeBetween(-(days - 1), 0)
        w = daily.select("gateway", "payment_date", F.sum("n").over(trailing).alias("total"), F.sum("ok").over(trailing).alias("success_count"))
        rate = pct("success_count", "total")
        return (w.select("gateway", "payment_date", "total", "success_count", rate.alias("success_pct"), (rate < F.lit(least)).alias("below_minimum"))
                .orderBy("gateway", "payment_date"))

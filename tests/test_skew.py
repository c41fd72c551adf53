"""Hot keys: one user holds a third of all payments and one fingerprint is copied
thousands of times. Results must stay whole and exact; checked against a pandas
brute force on the same (small) fixture."""

from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators.checks import Validator
from ledgerlens.operators.cohort import CohortEngine
from ledgerlens.operators.failures import FailureMonitor
from ledgerlens.operators.metrics import MetricsEngine
from ledgerlens.params import Params
from ledgerlens.schema import PAYMENTS, USERS
from ledgerlens.sources.tables import Tables

N = 30000
HOT_DUP_RANGE = 9000                    # ids below this (and not hot) are one fingerprint
HOT_DUP_COPIES = 6000                   # = 9000 minus the multiples of 3 taken by "hot"


@pytest.fixture(scope="module")
def skewed(spark):
    ids = spark.range(N)
    i = F.col("id")
    user = (F.when(i % 3 == 0, F.lit("hot"))                       # a third of all rows
            .when(i < HOT_DUP_RANGE, F.lit("dup"))                 # one fingerprint, many copies
            .otherwise(F.concat(F.lit("u"), (i % 500).cast("string"))))
    day = F.when(user == "dup", F.lit("2024-03-03").cast("date")).otherwise(
        F.date_add(F.lit("2023-06-01").cast("date"), (i % 400).cast("int")))
    amount = F.when(user == "dup", F.lit(9.99)).otherwise((i % 997) + F.lit(0.25)).cast("decimal(18,2)")
    status = F.when(i % 7 == 0, F.lit("failed")).otherwise(F.lit("success"))
    gateway = F.element_at(F.array(*[F.lit(g) for g in ("stripe", "razorpay", "paypal", "bank_transfer")]),
                           (i % 4 + 1).cast("int"))
    payments = ids.select(i.cast("string").alias("payment_id"), user.alias("user_id"), day.alias("payment_date"),
                          amount.alias("amount"), status.alias("status"), gateway.alias("gateway"),
                          F.lit(None).cast("string").alias("failure_reason"))
    payments = spark.createDataFrame(payments.collect(), PAYMENTS)      # a plain local fixture
    users = [(u, pd.Timestamp(d).date(), pd.Timestamp(d).strftime("%Y-%m"), 1) for u, d in
             [("hot", "2023-05-20"), ("dup", "2024-01-10")] + [(f"u{k}", f"2023-{1 + k % 12:02d}-15")
                                                               for k in range(500)]]
    users_df = spark.createDataFrame(users, USERS)
    failures = (payments.where("status = 'failed'").select(
        F.col("payment_id").alias("failure_id"), "payment_id", "user_id", F.col("payment_date").alias("failure_date"),
        F.lit("card_declined").alias("failure_reason"), "gateway", "amount",
        (F.col("payment_id").cast("int") % 2).alias("recovered"), F.lit(None).cast("date").alias("recovery_date"),
        F.lit(None).cast("decimal(18,2)").alias("recovery_amount")))
    empty_apps = spark.createDataFrame([], "application_id string, user_id string, company string, fee decimal(18,2)")
    empty_ev = spark.createDataFrame([], "event_id string, payment_id string, event_type string, "
                                         "event_time timestamp_ntz")
    t = Tables(users=users_df, payments=payments, applications=empty_apps, revenue_events=empty_ev,
               payment_failures=failures)
    return t, payments.toPandas(), users_df.toPandas(), failures.toPandas()


def test_fixture_is_skewed(skewed):
    _, p, _, _ = skewed
    assert (p.user_id == "hot").mean() == pytest.approx(1 / 3, abs=1e-3)
    assert ((p.user_id == "dup") & (p.amount == Decimal("9.99"))).sum() == HOT_DUP_COPIES


def test_monthly_revenue_exact(skewed):
    t, p, _, _ = skewed
    s = p[p.status == "success"].copy()
    s["month"] = pd.to_datetime(s.payment_date).dt.strftime("%Y-%m")
    want = {m: (float(sum(g.amount, Decimal(0))), len(g), g.user_id.nunique()) for m, g in s.groupby("month")}
    got = {r.month: (r.revenue, r.transactions, r.unique_payers) for r in MetricsEngine(t).monthly_revenue().collect()}
    assert got == want


def test_cohort_revenue_exact(skewed):
    t, p, u, _ = skewed
    s = p[p.status == "success"].merge(u[["user_id", "cohort_month"]], on="user_id")
    d = pd.to_datetime(s.payment_date)
    s["revenue_month"] = d.dt.strftime("%Y-%m")
    s["off"] = (d.dt.year - s.cohort_month.str[:4].astype(int)) * 12 + d.dt.month - s.cohort_month.str[5:].astype(int)
    s = s[s.off >= 0]
    want = {(c, m, int(o)): (g.user_id.nunique(), float(sum(g.amount, Decimal(0))))
            for (c, m, o), g in s.groupby(["cohort_month", "revenue_month", "off"])}
    got = {(r.cohort_month, r.revenue_month, r.months_since_signup): (r.paying_users, r.revenue)
           for r in CohortEngine(t).cohort_revenue_raw().collect()}
    assert got == want


def test_hot_duplicate_group_is_whole(skewed):
    t, p, _, _ = skewed
    g = p.groupby(["user_id", "payment_date", "amount"], dropna=False)
    sizes = g.payment_id.count()
    dup_keys = sizes[sizes > 1]
    got = {(r.user_id, r.payment_date, r.amount): r for r in FailureMonitor(t).duplicate_transactions().collect()}
    assert len(got) == len(dup_keys)
    hot = got[("dup", pd.Timestamp("2024-03-03").date(), 9.99)]
    ids = sorted(p[(p.user_id == "dup") & (p.amount == Decimal("9.99"))].payment_id)
    assert hot.duplicate_count == len(ids) == HOT_DUP_COPIES
    assert hot.payment_ids == ",".join(ids)                     # the whole list, no cap


def test_checks_and_leakage_exact(skewed):
    t, p, u, f = skewed
    links = Validator(t, Params()).payments_user_links().first()
    known = set(u.user_id)
    assert links.orphan_payments == int((~p.user_id.isin(known)).sum())
    m = p[p.status == "success"].merge(u[["user_id", "signup_date"]], on="user_id")
    assert links.pre_signup == int((m.payment_date < m.signup_date).sum())
    fj = f.merge(u[["user_id", "cohort_month"]], on="user_id")
    want = {(c, gw): (len(g), float(sum(g.amount[g.recovered == 0], Decimal(0))))
            for (c, gw), g in fj.groupby(["cohort_month", "gateway"])}
    got = {(r.cohort_month, r.gateway): (r.failure_count, r.leaked_revenue)
           for r in FailureMonitor(t).revenue_leakage().collect()}
    assert got == want

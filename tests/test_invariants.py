"""Cross-operator invariants on the sf0.01 bound tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators.cohort import CohortEngine
from ledgerlens.operators.failures import FailureMonitor
from ledgerlens.operators.metrics import ALL_GATEWAYS, MetricsEngine
from ledgerlens.params import FIXTURE_PARAMS
from ledgerlens.sources.binding import bind


@pytest.fixture(scope="module")
def t(spark):
    return bind(spark, SF_SMALL)


def total(df, col):
    return round(df.agg(F.sum(col)).first()[0], 2)


def test_revenue_totals_agree(t):
    m = MetricsEngine(t)
    arpu_total = round(m.arpu().first().total_revenue, 2)
    assert total(m.monthly_revenue(), "revenue") == arpu_total
    assert total(m.daily_revenue_trend(), "daily_revenue") == arpu_total
    assert total(m.revenue_by_gateway(), "revenue") == arpu_total
    assert arpu_total == 2815477243.63   # FIXTURES.md §3


def test_cohort_revenue_plus_presignup_is_total(t):
    raw = total(CohortEngine(t).cohort_revenue_raw(), "revenue")
    succ = t.payments.where("status = 'success'").join(t.users, "user_id")
    neg = succ.where(F.date_trunc("month", "payment_date") < F.to_date(F.concat("cohort_month", F.lit("-01"))))
    pre = float(neg.agg(F.sum("amount")).first()[0] or 0)
    assert round(raw + pre, 2) == round(MetricsEngine(t).arpu().first().total_revenue, 2)


def test_failure_counts_agree(t):
    f = FailureMonitor(t)
    n = t.payment_failures.count()
    assert n == 2475
    assert f.failure_monitor().agg(F.sum("failure_count")).first()[0] == n
    s = f.retry_summary().collect()
    assert sum(r.total_failures for r in s) == n
    assert all(r.recovered + r.not_recovered == r.total_failures for r in s)
    assert sum(r.recovered for r in s) == 873


def test_net_is_at_risk_minus_recovered(t):
    g = FailureMonitor(t).failure_monitor()
    ra = t.payment_failures.groupBy("gateway", "failure_reason").agg(
        F.sum(F.coalesce("recovery_amount", F.lit(0))).cast("double").alias("rec"))
    for r in g.join(ra, ["gateway", "failure_reason"]).collect():
        assert round(r.revenue_at_risk - r.rec, 2) == round(r.net_revenue_lost, 2)


def test_all_gateways_row_is_the_sum(t):
    rows = {r.gateway: r for r in MetricsEngine(t).failed_payment_pct().collect()}
    tot = rows.pop(ALL_GATEWAYS)
    assert tot.total == sum(r.total for r in rows.values()) == 15300
    assert tot.failed == sum(r.failed for r in rows.values()) == 2475
    assert tot.failure_pct == 16.18


def test_retention_month0_is_100_or_null(t):
    for r in CohortEngine(t, FIXTURE_PARAMS).cohort_retention().collect():
        assert r.m0 in (100.0, None)


def test_revenue_report_and_cohort_report_agree(t):
    """As in the reference's own report pair: the monthly report and the cohort report
    carry the same total revenue (the cohort ARPU view has no pre-signup guard)."""
    monthly = total(MetricsEngine(t).monthly_revenue(), "revenue")
    cohorts = total(CohortEngine(t).cohort_arpu(), "lifetime_revenue")
    assert monthly == cohorts


def test_failure_reports_agree(t):
    """failure_monitor and retry_summary agree on failures, recoveries and money."""
    f = FailureMonitor(t)
    fm, rs = f.failure_monitor(), f.retry_summary()
    assert total(fm, "failure_count") == total(rs, "total_failures")
    assert total(fm, "recovered_count") == total(rs, "recovered")
    assert round(total(fm, "revenue_at_risk") - total(fm, "net_revenue_lost"), 2) == total(rs, "recovered_revenue")

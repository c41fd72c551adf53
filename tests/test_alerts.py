"""Alert rules (extensions): windows over aggregates, edge months and days."""

from __future__ import annotations

import datetime as dt

from fixtures import make_tables, pay, user
from ledgerlens.operators.alerts import AlertRules


def rules(spark, *payments):
    return AlertRules(make_tables(spark, users=[user(1, "2024-01-01")], payments=list(payments)))


def test_revenue_alert(spark):
    r = rules(spark, *(pay(k, 1, day, amount) for k, (day, amount) in enumerate(
        [("2024-01-05", 10), ("2024-02-05", 20), ("2024-03-05", 30), ("2024-05-05", 19.99), ("2024-06-05", 23.33)])))
    got = [tuple(x) for x in r.revenue_alert().collect()]
    assert got == [("2024-01", 10.0, None, False), ("2024-02", 20.0, 10.0, False), ("2024-03", 30.0, 15.0, False),
                   ("2024-05", 19.99, 20.0, True), ("2024-06", 23.33, 23.33, False)]  # a third of 69.99 is just that
    assert rules(spark).revenue_alert().count() == 0


def test_negative_growth_runs(spark):
    amounts = [50, 40, 30, 35, 30, 36, 20, 10, 5]
    r = rules(spark, *(pay(k, 1, f"2024-{k + 1:02d}-03", a) for k, a in enumerate(amounts)))
    assert [tuple(x) for x in r.negative_growth_runs().collect()] == [("2024-02", "2024-03", 2, 50.0, 30.0), ("2024-07", "2024-09", 3, 36.0, 5.0)]
    assert r.negative_growth_runs(least=1).count() == 3 and r.negative_growth_runs(least=4).count() == 0


def test_gateway_trailing_success(spark):
    r = rules(spark, pay(1, 1, "2024-01-01", 1), pay(2, 1, "2024-01-01", 1, status="failed"), pay(3, 1, "2024-01-30", 1), pay(4, 1, "2024-01-31", 1))
    got = [(x.payment_date, x.total, x.success_count, x.success_pct, x.below_minimum) for x in r.gateway_trailing_success().collect()]
    assert got == [(dt.date(2024, 1, 1), 2, 1, 50.0, True), (dt.date(2024, 1, 30), 3, 2, 66.67, True), (dt.date(2024, 1, 31), 2, 2, 100.0, False)]
    assert "payment_id" not in r.gateway_trailing_success()._jdf.queryExecution().optimizedPlan().toString().split("Window")[0]

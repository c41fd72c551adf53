"""Edge cases on hand-built micro fixtures (FIXTURES.md §4)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fixtures import event, fail, make_tables, pay, user
from ledgerlens.functions.expr import r2, r2_even
from ledgerlens.operators.checks import Validator
from ledgerlens.operators.cohort import CohortEngine
from ledgerlens.operators.failures import FailureMonitor
from ledgerlens.operators.metrics import MetricsEngine
from ledgerlens.params import Params

AS_OF = Params(as_of=dt.datetime(2024, 2, 1))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def by(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


# -- empty -----------------------------------------------------------------------------
def test_empty_kpis_are_zero(spark):
    t = make_tables(spark)
    m = MetricsEngine(t)
    assert one(m.arpu()) == {"arpu": 0.0, "total_revenue": 0.0, "paying_users": 0}
    assert one(m.payment_recovery()) == {"total_failures": 0, "recovered_count": 0, "recovery_pct": 0.0,
                                         "recovered_revenue": 0.0, "unrecovered_revenue": 0.0}
    s = one(m.top_summary())
    assert s["total_revenue"] == 0.0 and s["arpu"] == 0.0 and s["total_transactions"] == 0
    assert m.monthly_revenue().count() == 0
    assert CohortEngine(t).cohort_revenue_matrix().count() == 0


def test_empty_checks(spark):
    t = make_tables(spark)
    rows = {r.check_name: r for r in Validator(t, AS_OF).run_all().collect()}
    assert rows["validate_arpu"].status == "WARN"
    assert rows["validate_revenue"].status == "FAIL"
    assert rows["freshness_check"].status == "FAIL"
    assert rows["freshness_check"].message == "No successful payments found in database."
    assert rows["orphan_check"].status == "PASS"
    assert rows["detect_duplicates"].status == "PASS"
    assert rows["detect_nulls"].status == "PASS"
    assert rows["validate_failure_rate"].status == "PASS"
    assert len(rows) == 8


# -- growth ---------------------------------------------------------------------------
def test_growth_first_and_after_zero_month(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[
        pay(1, 1, "2024-01-05", 100), pay(2, 1, "2024-02-05", 0), pay(3, 1, "2024-03-05", 50),
        pay(4, 1, "2024-04-05", 75)])
    g = by(MetricsEngine(t).revenue_growth(), "month")
    assert g["2024-01"]["growth_pct"] is None          # first month
    assert g["2024-02"]["growth_pct"] == -100.0
    assert g["2024-03"]["growth_pct"] is None          # previous revenue 0
    assert g["2024-04"]["growth_pct"] == 50.0


# -- cohorts --------------------------------------------------------------------------
def cohort_fixture(spark):
    users = [user(1, "2024-01-10"), user(2, "2024-01-20"),      # 2024-01: revenue in m0, m1
             user(3, "2024-02-01"),                              # 2024-02: only offset 2 (no month 0)
             user(4, "2023-01-15"),                              # 2023-01: only after offset 12
             user(5, "2024-03-03"), user(6, "2024-03-04")]       # 2024-03: no payer at all
    payments = [pay(1, 1, "2024-01-11", 100), pay(2, 2, "2024-01-21", 50), pay(3, 1, "2024-02-02", 30),
                pay(4, 3, "2024-04-02", 40),
                pay(5, 4, "2024-03-01", 10),
                pay(6, 1, "2023-12-31", 999),                    # pre-signup: excluded by the guard
                pay(7, 5, "2024-03-05", 20, status="failed")]
    return make_tables(spark, users=users, payments=payments)


def test_matrix_zero_fill_and_absent_cohorts(spark):
    c = CohortEngine(cohort_fixture(spark), Params(max_months=3))
    m = by(c.cohort_revenue_matrix(), "cohort_month")
    assert set(m) == {"2024-01", "2024-02"}             # 2023-01 only after month 3; 2024-03 no payer
    assert (m["2024-01"]["m0"], m["2024-01"]["m1"], m["2024-01"]["m2"]) == (150.0, 30.0, 0.0)
    assert (m["2024-02"]["m0"], m["2024-02"]["m2"]) == (0.0, 40.0)
    r = by(c.cohort_retention(), "cohort_month")
    assert r["2024-01"]["m0"] == 100.0 and r["2024-01"]["m1"] == 20.0
    assert all(r["2024-02"][f"m{k}"] is None for k in range(4))   # month-0 revenue 0 → NULL row


def test_offset_guard_and_presignup_check(spark):
    t = cohort_fixture(spark)
    raw = CohortEngine(t).cohort_revenue_raw().collect()
    assert all(r.months_since_signup >= 0 for r in raw)
    assert 999.0 not in [r.revenue for r in raw]
    v = one(Validator(t, AS_OF).validate_cohort())
    assert v["status"] == "FAIL" and "1 pre-signup payments" in v["message"]


def test_arpu_drops_cohorts_without_payers_lifetime_keeps_them(spark):
    c = CohortEngine(cohort_fixture(spark))
    arpu = by(c.cohort_arpu(), "cohort_month")
    life = by(c.cohort_lifetime(), "cohort_month")
    assert "2024-03" not in arpu
    assert life["2024-03"] == {"cohort_month": "2024-03", "cohort_size": 2, "paying_users": 0,
                               "lifetime_revenue": None, "total_transactions": 0}
    # C5 has no pre-signup guard: the 2023-12-31 payment counts for cohort 2024-01.
    assert arpu["2024-01"]["lifetime_revenue"] == 1179.0


# -- duplicates, orphans, pendings, misplaced values ----------------------------------------
def test_duplicates_null_user_and_sorted_ids(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[
        pay(13, 1, "2024-01-05", 10, gateway="stripe"), pay(11, 1, "2024-01-05", 10, gateway="paypal"),
        pay(12, 1, "2024-01-05", 10, gateway="stripe"),
        pay(21, None, "2024-01-06", 5), pay(22, None, "2024-01-06", 5),
        pay(31, 1, "2024-01-07", 7)])
    d = {(r.user_id, r.amount): r for r in FailureMonitor(t).duplicate_transactions().collect()}
    assert set(d) == {("1", 10.0), (None, 5.0)}
    assert d[("1", 10.0)].payment_ids == "11,12,13" and d[("1", 10.0)].duplicate_count == 3
    assert d[("1", 10.0)].gateway == "paypal"
    v = one(Validator(t, AS_OF).detect_duplicates())
    # 2 groups, 5 rows, 3 excess of 6 payments = 0.5 > 0.05
    assert v["status"] == "FAIL" and v["metric"] == "0.5"


def test_orphans(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")],
                    payments=[pay(1, 1, "2024-01-02", 5), pay(2, 9, "2024-01-02", 5), pay(3, None, "2024-01-02", 5)])
    v = one(Validator(t, AS_OF).orphan_check())
    assert v["status"] == "FAIL" and v["metric"] == "2"


def test_stale_pending_only_without_event(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")],
                    payments=[pay(1, 1, "2024-01-10", 5, status="pending"),
                              pay(2, 1, "2024-01-20", 5, status="pending")],
                    revenue_events=[event(100, 1)])
    rows = FailureMonitor(t, AS_OF).stale_pending().collect()
    assert [(r.payment_id, r.days_stale) for r in rows] == [("2", 12)]
    assert FailureMonitor(t, AS_OF).stale_pending(min_days=20).count() == 0


def test_null_monitoring_counts(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01", active=None)],
                    payments=[pay(1, 1, "2024-01-02", 5, status="success", reason="card_declined"),
                              pay(2, 1, "2024-01-02", 5, status="failed", reason=None),
                              pay(3, None, "2024-01-02", 5, status="refunded", reason="x")],
                    payment_failures=[fail(2, 1, "2024-01-02", 5, recovered=1, rdate=None)])
    n = {r.check_name: r.issue_count for r in FailureMonitor(t).null_monitoring().collect()}
    assert list(n.values()) == [1, 1, 1, 1, 1]


# -- thresholds ------------------------------------------------------------------------
@pytest.mark.parametrize("failed,total,status", [(3, 10, "PASS"), (4, 10, "WARN"), (4001, 10000, "FAIL")])
def test_failure_rate_edges(spark, failed, total, status):
    ps = [pay(i, 1, "2024-01-02", 1, status="failed" if i < failed else "success") for i in range(total)]
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=ps)
    assert one(Validator(t, AS_OF).validate_failure_rate())["status"] == status


def test_gateway_without_failures(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")],
                    payments=[pay(1, 1, "2024-01-02", 5, gateway="paypal"),
                              pay(2, 1, "2024-01-02", 5, gateway="stripe", status="failed")],
                    payment_failures=[fail(2, 1, "2024-01-02", 5, gateway="stripe")])
    h = by(FailureMonitor(t).gateway_health(), "gateway")
    assert h["paypal"]["total_failures"] == 0 and h["paypal"]["recovered_count"] == 0
    assert h["paypal"]["recovery_rate_pct"] is None and h["paypal"]["unrecovered_revenue"] == 0.0


@pytest.mark.parametrize("latest,status", [("2024-01-31", "PASS"), ("2024-01-30", "WARN")])
def test_freshness_boundary(spark, latest, status):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, latest, 5)])
    v = one(Validator(t, AS_OF).freshness_check())
    assert v["status"] == status and v["metric"] == latest


def test_freshness_one_second_past_sla(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-31", 5)])
    p = Params(as_of=dt.datetime(2024, 2, 1, 0, 0, 1))
    assert one(Validator(t, p).freshness_check())["status"] == "WARN"


def test_round_ties(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (0.125,), (-1.005,)], "x double")
    got = [tuple(r) for r in df.select(r2("x"), r2_even("x")).collect()]
    assert got == [(1.01, 1.0), (0.29, 0.28), (0.13, 0.12), (-1.01, -1.0)]


def test_csv_dirty(spark, tmp_path):
    from ledgerlens.sources.csv import read_csv

    p = tmp_path / "payments.csv"
    p.write_text("payment_id,user_id,payment_date,amount,status,gateway,failure_reason\n"
                 "1,7,2024-01-02,10.50,success,stripe,\n"
                 "2,,2024-01-03,3.25,failed,paypal,card_declined\n")
    rows = read_csv(spark, str(p), table="payments").collect()
    assert rows[0].failure_reason is None and rows[1].user_id is None
    bad = tmp_path / "bad.csv"
    bad.write_text("payment_id,user_id,payment_date,amount,status,gateway,failure_reason\n"
                   "1,7,2024-01-02,ten,success,stripe,\n")
    with pytest.raises(Exception):
        read_csv(spark, str(bad), table="payments").collect()
    with pytest.raises(FileNotFoundError):
        read_csv(spark, str(tmp_path / "missing.csv"), table="payments")


def test_run_all_isolated_reports_error_rows(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-02", 5)])
    broken = t.replace(payments=t.payments.withColumn("amount", F.raise_error(F.lit("boom"))))
    out = {r.check_name: r for r in Validator(broken, AS_OF).run_all_isolated(spark).collect()}
    assert out["validate_revenue"].status == "ERROR"
    assert out["validate_cohort"].status in ("PASS", "WARN", "FAIL")


def test_retry_events_skip_bad_dates(spark):
    from ledgerlens.sources.etl import retry_success_events

    pf = spark.createDataFrame(
        [("f1", "1", 1, "2024-01-05"), ("f2", "2", 1, "not-a-date"), ("f3", "3", 0, "2024-01-06"), ("f4", "4", 1, None)],
        "failure_id string, payment_id string, recovered int, recovery_date string")
    rows = retry_success_events(pf).collect()
    assert [(r.payment_id, r.event_type, r.event_time) for r in rows] == [
        ("1", "retry_success", dt.datetime(2024, 1, 5))]


def test_derived_failures_keep_known_users_only(spark):
    from ledgerlens.sources.etl import derive_payment_failures

    t = make_tables(spark, users=[user(1, "2024-01-01")],
                    payments=[pay(1, 1, "2024-01-02", 5, status="failed", reason=None),
                              pay(2, 9, "2024-01-02", 5, status="failed", reason="card_declined"),
                              pay(3, 1, "2024-01-02", 5, status="success")])
    rows = derive_payment_failures(t.payments, t.users).collect()
    assert [(r.failure_id, r.failure_reason, r.recovered) for r in rows] == [("1", "unknown", 0)]


def test_engines_accept_a_dict_of_tables(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-02", 5)])
    assert one(MetricsEngine(t.as_dict()).arpu())["total_revenue"] == 5.0
    with pytest.raises(TypeError):
        MetricsEngine(42)


def test_null_group_keys_form_groups(spark):
    from decimal import Decimal

    rows = [pay(1, 1, "2024-01-02", 5, gateway=None), pay(2, 1, "2024-01-03", 7, status="failed", gateway=None),
            pay(3, 1, "2024-01-04", 11, gateway="stripe")]
    null_day = ("4", "1", None, Decimal("13.00"), "success", "paypal", None)
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=rows + [null_day])
    m = MetricsEngine(t)
    f = by(m.failed_payment_pct(), "gateway")
    assert (f[None]["total"], f[None]["failed"], f[None]["failure_pct"]) == (2, 1, 50.0)
    assert (f["ALL GATEWAYS"]["total"], f["ALL GATEWAYS"]["failed"]) == (4, 1)
    months = by(m.monthly_revenue(), "month")
    assert months[None]["revenue"] == 13.0 and months["2024-01"]["revenue"] == 16.0


def test_single_rounding_and_python_text(spark):
    """One rounding; display text as Python writes the exact binary value."""
    from ledgerlens.functions.expr import py_repr
    from ledgerlens.functions.fmt import fixed, fixed_commas

    xs = [12.3449996, 33.3349999, 0.0049997, 53.65, 53.55, 0.05, 0.15, 0.25, 0.35, 2.5, 3.5, 1e7 + 0.5, 1234567.125, 1234567.135,
          -0.04, -53.65, 0.0, 99.95, 1 / 3, 17090.33, 1.005]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    got = df.select("x", r2("x").alias("r"), *[fixed("x", d).alias(f"f{d}") for d in (1, 2)], fixed_commas("x", 2).alias("c2"), fixed_commas("x", 0).alias("c0")).collect()
    assert [g.f1 for g in got] == [f"{x:.1f}" for x in xs]
    assert [g.f2 for g in got] == [f"{x:.2f}" for x in xs]
    assert [g.c2 for g in got] == [f"{x:,.2f}" for x in xs]
    assert [g.c0 for g in got] == [f"{x:,.0f}" for x in xs]
    assert {g.x: g.r for g in got}[12.3449996] == 12.34
    assert {g.x: g.r for g in got}[33.3349999] == 33.33
    assert {g.x: g.r for g in got}[0.0049997] == 0.0
    rates = [1 / 2001, 0.0005, 0.0001, 0.001, 0.05, 0.0, 5e-05, 4.9975e-05, 1.25e-11, 0.5]
    df = spark.createDataFrame([(x,) for x in rates], "x double")
    assert [g.t for g in df.select(py_repr("x").alias("t")).collect()] == [str(x) for x in rates]


def test_csv_refuses_finer_amounts_and_tolerates_recovery_dates(spark, tmp_path):
    from ledgerlens.sources.csv import read_csv

    p = tmp_path / "payments.csv"
    p.write_text("payment_id,user_id,payment_date,amount,status,gateway,failure_reason\n"
                 "1,7,2024-01-02,199.995,success,stripe,\n")
    with pytest.raises(Exception, match="more decimal places"):
        read_csv(spark, str(p), table="payments").collect()
    f = tmp_path / "payment_failures.csv"
    f.write_text("failure_id,payment_id,user_id,failure_date,failure_reason,gateway,amount,recovered,recovery_date,recovery_amount\n"
                 "f1,1,7,2024-01-02,x,stripe,5.5,1,soon,5.5\nf2,1,7,2024-01-02,x,stripe,5.5,1,2024-01-09,5.50\n")
    rows = read_csv(spark, str(f), table="payment_failures", lenient_dates=("recovery_date",)).collect()
    assert [r.recovery_date for r in rows] == [None, dt.date(2024, 1, 9)]
    with pytest.raises(Exception):
        read_csv(spark, str(f), table="payment_failures").collect()


def test_duplicate_top_lists_only_the_chosen_groups(spark):
    ps = [pay(i, None, "2024-01-05", 10) for i in range(5)] + [pay(10 + i, 1, "2024-01-05", 20) for i in range(2)] + [
        pay(20 + i, 2, "2024-01-05", 30) for i in range(2)] + [pay(30, 3, "2024-01-05", 40)]
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=ps)
    f = FailureMonitor(t)
    every = [tuple(r) for r in f.duplicate_transactions().collect()]
    assert [tuple(r) for r in f.duplicate_transactions(top=2).collect()] == every[:2]
    assert [r.duplicate_count for r in Validator(t, AS_OF).duplicates_detail(limit=3).collect()] == [5, 2, 2]

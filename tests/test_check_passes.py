"""The check report runs each aggregate pass once and keeps failures to the checks they concern."""

from __future__ import annotations

import threading

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import make_tables, pay, user
from ledgerlens.operators.checks import CHECK_COLUMNS, Validator
from ledgerlens.params import FIXTURE_PARAMS
from ledgerlens.sources.binding import bind
from ledgerlens.sources.tables import Tables


def counted(tables, counts):
    """The same tables; every build of a table's frame by a pass is counted."""
    class Counted:
        def __init__(self):
            self.lock = threading.Lock()

        def __getattr__(self, name):
            with self.lock:
                counts[name] = counts.get(name, 0) + 1
            return getattr(tables, name)

    return Counted()


def test_each_pass_runs_once(spark, monkeypatch):
    v = Validator(bind(spark, SF_SMALL), FIXTURE_PARAMS)
    counts, ran = {}, []
    v.t = counted(v.t, counts)
    for part in {p for needs in Validator.NEEDS.values() for p in needs}:
        real = getattr(v, part)
        monkeypatch.setattr(v, part, lambda real=real, part=part: (ran.append(part), real())[1])
    for name in Validator.CHECK_ORDER:  # no check is evaluated alone when all is well
        monkeypatch.setattr(v, name, lambda name=name: (_ for _ in ()).throw(AssertionError(name)))
    rows = v.run_all(spark).collect()
    assert [r.check_name for r in rows] == list(Validator.CHECK_ORDER) and not any(r.status == "ERROR" for r in rows)
    assert sorted(ran) == sorted({p for needs in Validator.NEEDS.values() for p in needs}) and len(ran) == 5
    assert counts == {"payments": 3, "users": 2, "payment_failures": 1}


def test_report_equals_the_checks_alone(spark):
    v = Validator(bind(spark, SF_SMALL), FIXTURE_PARAMS)
    alone = {n: tuple(getattr(v, n)().first()) for n in Validator.CHECK_ORDER}
    assert {r.check_name: tuple(r) for r in v.run_all(spark).collect()} == alone
    assert v.quality_report().columns == list(CHECK_COLUMNS)


def test_a_failed_pass_concerns_only_the_checks_that_read_its_column(spark):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-02", 5)])
    boom = lambda c: t.payments.withColumn(c, F.raise_error(F.lit(f"boom {c}")).cast(t.payments.schema[c].dataType))
    out = {r.check_name: r for r in Validator(t.replace(payments=boom("gateway")), FIXTURE_PARAMS).run_all(spark).collect()}
    assert {n for n, r in out.items() if r.status == "ERROR"} == {"detect_nulls"} and "boom gateway" in out["detect_nulls"].message
    out = {r.check_name: r for r in Validator(t.replace(payments=boom("user_id")), FIXTURE_PARAMS).run_all(spark).collect()}
    assert {"validate_cohort", "orphan_check", "validate_arpu"} <= {n for n, r in out.items() if r.status == "ERROR"}
    assert out["validate_revenue"].status != "ERROR" and out["validate_failure_rate"].status != "ERROR"


def test_a_missing_table_and_a_raising_rule(spark, monkeypatch):
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-02", 5)])

    def gone():
        raise FileNotFoundError("no payment_failures")

    lost = Tables(**{n: (gone if n == "payment_failures" else getattr(t, n)) for n in ("users", "payments", "applications", "revenue_events", "payment_failures")})
    out = {r.check_name: r for r in Validator(lost, FIXTURE_PARAMS).run_all(spark).collect()}
    assert [n for n, r in out.items() if r.status == "ERROR"] == ["detect_nulls"] and out["detect_nulls"].message == "no payment_failures"

    v = Validator(t, FIXTURE_PARAMS)
    broken = (F.raise_error(F.lit("rule is broken")).cast("string"),) * 4
    monkeypatch.setattr(v, "_rule_orphan_check", lambda: broken)
    out = {r.check_name: r for r in v.run_all(spark).collect()}
    assert [n for n, r in out.items() if r.status == "ERROR"] == ["orphan_check"] and "rule is broken" in out["orphan_check"].message

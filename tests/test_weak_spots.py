"""Malformed cohort months, large duplicate groups, fused reconciliation counts, check details, shares."""

from __future__ import annotations

import datetime as dt
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import make_tables, pay, user
from ledgerlens.functions.expr import leading_int
from ledgerlens.operators import views
from ledgerlens.operators.checks import Validator
from ledgerlens.operators.cohort import CohortEngine
from ledgerlens.operators.failures import FailureMonitor, duplicate_groups
from ledgerlens.params import FIXTURE_PARAMS
from ledgerlens.plans.sqlkit import LEADING_INT, MOFF
from ledgerlens.sources.binding import bind

TEXTS = ["2024", " 24x", "x24", "", "-3", "+7a", "20-2", "1 2", None, "\t5", "00", "٣"]


def sqlite_cast(texts):
    import sqlite3

    con = sqlite3.connect(":memory:")
    return [con.execute("SELECT CAST(? AS INTEGER)", (t,)).fetchone()[0] for t in texts]


def test_leading_int_reads_texts_leniently(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "k int, t string")
    got = [r.v for r in frame.select("k", leading_int("t").alias("v")).orderBy("k").collect()]
    assert got == sqlite_cast(TEXTS) == [2024, 24, 0, 0, -3, 7, 20, 1, None, 5, 0, 0]
    con = duckdb.connect()
    assert [con.execute(f"SELECT {LEADING_INT('t')} FROM (SELECT ?::VARCHAR AS t)", [t]).fetchone()[0] for t in TEXTS] == got


def test_payments_of_a_malformed_cohort_stay(spark):
    t = make_tables(spark, users=[user(1, "2024-01-05"), user(2, "2024-01-05"), user(3, "2024-01-05")],
                    payments=[pay(1, 1, "2024-03-02", 5), pay(2, 2, "2024-03-02", 7), pay(3, 3, "2024-03-09", 11)])
    month = F.when(F.col("user_id").cast("int") == 2, F.lit("soon")).when(F.col("user_id").cast("int") == 3, F.lit("2024/2x")).otherwise(F.col("cohort_month"))
    rows = CohortEngine(t.replace(users=t.users.withColumn("cohort_month", month))).cohort_revenue_raw().collect()
    assert {(r.cohort_month, r.months_since_signup, r.revenue) for r in rows} == {("2024-01", 2, 5.0), ("soon", 2024 * 12 + 3, 7.0), ("2024/2x", 1, 11.0)}
    con = duckdb.connect()
    for month, offset in (("2024-01", 2), ("soon", 2024 * 12 + 3), ("2024/2x", 1)):
        assert con.execute(f"SELECT {MOFF('d', 'c')} FROM (SELECT DATE '2024-03-02' AS d, ?::VARCHAR AS c)", [month]).fetchone()[0] == offset


@pytest.mark.parametrize("chunk", [50_000, 7, 1])
def test_ids_of_a_hot_group_are_collected_by_many_tasks(spark, chunk):
    day = dt.date(2024, 1, 2)
    rows = [(f"p{k:05d}", "hot", day, 5, "B" if k % 2 else "A") for k in range(400)] + [(f"q{k}", None, None, None, "C") for k in range(3)]
    rows += [(f"r{k}", f"u{k // 2}", day, 1, "D") for k in range(9)] + [(None, "hot", day, 5, "0")]
    p = spark.createDataFrame(rows, "payment_id string, user_id string, payment_date date, amount int, gateway string").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = {r.user_id: (r.duplicate_count, r.payment_ids, r.gateway) for r in duplicate_groups(p.repartition(5), chunk=chunk).collect()}
    assert got == {"hot": (400, ",".join(f"p{k:05d}" for k in range(400)), "0"), None: (3, "q0,q1,q2", "C"),
                   **{f"u{k}": (2, f"r{2 * k},r{2 * k + 1}", "D") for k in range(4)}}
    assert [r.user_id for r in duplicate_groups(p, top=1, chunk=chunk).collect()] == ["hot"]


def test_reconciliation_scans_all_payments_once(spark):
    f = FailureMonitor(bind(spark, SF_SMALL), FIXTURE_PARAMS)
    plan = f.reconciliation_summary()._jdf.queryExecution().optimizedPlan().toString()
    full = [b for b in re.split(r"\n(?=.*(?:Aggregate|Join))", plan) if "Relation [o_orderkey" in b and "Filter" not in b]
    assert len(full) <= 1
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[])
    assert {r.section: r.rows for r in FailureMonitor(t, FIXTURE_PARAMS).reconciliation_summary().collect()} == {"duplicates": 0, "stale_pending": 0, "null_alerts": 0}


def test_check_result_plans_its_detail_when_asked(spark, monkeypatch):
    v = Validator(bind(spark, SF_SMALL), FIXTURE_PARAMS)
    asked = []
    for m in ("duplicates_detail", "null_scan"):
        real = getattr(v, m)
        monkeypatch.setattr(v, m, lambda real=real, m=m: (asked.append(m), real())[1])
    results = {n: v.result(n) for n in v.CHECK_ORDER}
    assert v.run_all(spark).count() == 8 and not asked
    assert {n for n, r in results.items() if r.detail is not None} == {"detect_duplicates", "detect_nulls"} and sorted(asked) == ["duplicates_detail", "null_scan"]
    assert results["detect_duplicates"].check.first().check_name == "detect_duplicates"
    assert results["detect_nulls"].detail.count() == 10 and results["detect_duplicates"].detail.count() <= 20
    with pytest.raises(KeyError):
        v.result("nothing")


def test_share_of_total_needs_no_single_task_window(spark):
    frame = spark.createDataFrame([(f"r{k}", float(k)) for k in range(5)] + [("none", None)], "failure_reason string, revenue_lost double")
    out = views.reason_loss_share(frame)
    assert "Window" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert {r.failure_reason: r.share_pct for r in out.collect()} == {"r0": 0.0, "r1": 10.0, "r2": 20.0, "r3": 30.0, "r4": 40.0, "none": None}

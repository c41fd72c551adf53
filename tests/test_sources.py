"""Stored tables, CSV load path and catalog helpers."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fixtures import make_tables, pay, user
from ledgerlens.schema import TABLE_NAMES
from ledgerlens.sources.binding import bind
from ledgerlens.sources.csv import write_csv
from ledgerlens.sources.etl import load_table, post_load_counts, validate_load
from ledgerlens.sources.tables import (create_tables, read_table, read_tables, reset_tables, verify_tables,
                                       write_table, write_tables)


def test_create_verify_reset(spark, tmp_path):
    root = str(tmp_path / "store")
    assert not any(r.exists for r in verify_tables(spark, root).collect())
    assert create_tables(spark, root) == list(TABLE_NAMES)
    assert create_tables(spark, root) == []                      # idempotent
    assert all(r.exists for r in verify_tables(spark, root).collect())
    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-02", 5)])
    write_table(t.users, root, "users")
    assert read_table(spark, root, "users").count() == 1
    reset_tables(spark, root)
    assert {r.table_name: r.row_count for r in post_load_counts(read_tables(spark, root)).collect()} == \
        {n: 0 for n in TABLE_NAMES}


def test_load_overwrite_then_append(spark, tmp_path):
    apps = bind(spark, SF_SMALL).applications
    csv = write_csv(apps, str(tmp_path / "applications.csv"))
    root = str(tmp_path / "store")
    assert load_table(spark, csv, root, "applications", schema=apps.schema) == 15000
    assert load_table(spark, csv, root, "applications", schema=apps.schema) == 15000      # full refresh
    assert load_table(spark, csv, root, "applications", skip_truncate=True, schema=apps.schema) == 15000
    assert read_table(spark, root, "applications").count() == 30000
    assert validate_load(spark, root, "applications", 30000)
    assert not validate_load(spark, root, "applications", 15000)
    fee = read_table(spark, root, "applications").agg(F.sum("fee")).first()[0]
    assert float(fee) == 2 * 37717500.00                          # FIXTURES.md §3


def test_unknown_table(spark, tmp_path):
    with pytest.raises(KeyError):
        read_table(spark, str(tmp_path), "nope")


def test_truncate_save_and_views(spark, tmp_path):
    from ledgerlens.operators.checks import Validator, scalar
    from ledgerlens.sources.csv import read_csv, save_datasets
    from ledgerlens.sources.tables import truncate_table

    t = make_tables(spark, users=[user(1, "2024-01-01")], payments=[pay(1, 1, "2024-01-02", 5)])
    root = str(tmp_path / "store")
    write_table(t.payments, root, "payments")
    truncate_table(spark, root, "payments")
    assert read_table(spark, root, "payments").count() == 0
    paths = save_datasets(t.as_dict(), str(tmp_path / "csv"))
    assert read_csv(spark, paths["users"], table="users").count() == 1
    t.register_views()
    assert spark.sql("SELECT COUNT(*) FROM payments").first()[0] == 1
    assert scalar(Validator(t).orphan_count(), "orphan_payments") == 0
    assert scalar(Validator(t).orphan_count(), "missing") is None


def test_cluster_conf_applies(spark):
    from ledgerlens.session import CLUSTER_SQL_CONF, apply_cluster_conf

    before = {k: spark.conf.get(k, None) for k in CLUSTER_SQL_CONF}
    try:
        apply_cluster_conf(spark, {"spark.sql.shuffle.partitions": "16"})
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16"
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == str(512 << 20)
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_engine_exports(spark, tmp_path):
    from ledgerlens.operators.checks import Validator
    from ledgerlens.operators.cohort import CohortEngine
    from ledgerlens.operators.failures import FailureMonitor
    from ledgerlens.operators.metrics import MetricsEngine
    from ledgerlens.params import FIXTURE_PARAMS
    from ledgerlens.sources.reports import read_report

    t = bind(spark, SF_SMALL)
    out = str(tmp_path / "reports")
    m = MetricsEngine(t, FIXTURE_PARAMS)
    assert read_report(spark, m.export_revenue_report(out), m.monthly_revenue().schema).count() == 80
    c = CohortEngine(t, FIXTURE_PARAMS)
    assert read_report(spark, c.export_cohort_report(out), c.cohort_arpu().schema).count() == 24
    f = FailureMonitor(t, FIXTURE_PARAMS)
    a, b = f.export_full_report(out)
    assert read_report(spark, b, f.retry_summary().schema).count() == 4
    v = Validator(t, FIXTURE_PARAMS)
    rows = read_report(spark, v.export_quality_report(out), v.quality_report().schema).collect()
    assert [r.check_name for r in rows] == list(Validator.CHECK_ORDER)
    header = open([p for p in (tmp_path / "reports" / "quality_report.csv").iterdir()
                   if p.name.endswith(".csv")][0]).readline().strip()
    assert header == "check_name,status,message,metric,threshold"


def test_write_tables_partitioned(spark, tmp_path):
    from ledgerlens.operators.metrics import MetricsEngine

    t = bind(spark, SF_SMALL)
    pay = t.payments.withColumn("pay_month", F.date_format("payment_date", "yyyy-MM"))
    root = str(tmp_path / "store")
    write_tables(t.replace(payments=pay), root, partition_by={"payments": ["pay_month"]})
    stored = read_tables(spark, root)
    assert {r.table_name: r.row_count for r in post_load_counts(stored).collect()}["payments"] == 15300
    # A month filter prunes partitions at the scan.
    plan = stored.payments.where("pay_month = '1996-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pay_month" in plan
    rev = MetricsEngine(stored).arpu().first().total_revenue
    assert round(rev, 2) == 2815477243.63


def test_report_headers_match_reference_reports(spark, tmp_path):
    """Headers of the five report files equal those of the reference's shipped reports."""
    import pathlib

    from ledgerlens.operators.checks import Validator
    from ledgerlens.operators.cohort import CohortEngine
    from ledgerlens.operators.failures import FailureMonitor
    from ledgerlens.operators.metrics import MetricsEngine
    from ledgerlens.params import FIXTURE_PARAMS

    t = bind(spark, SF_SMALL)
    out = str(tmp_path / "r")
    MetricsEngine(t, FIXTURE_PARAMS).export_revenue_report(out)
    CohortEngine(t, FIXTURE_PARAMS).export_cohort_report(out)
    FailureMonitor(t, FIXTURE_PARAMS).export_full_report(out)
    Validator(t, FIXTURE_PARAMS).export_quality_report(out)
    expected = {  # FIXTURES.md §5
        "revenue_report.csv": "month,revenue,transactions,unique_payers",
        "cohort_report.csv": "cohort_month,cohort_size,paying_users,lifetime_revenue,arpu_per_user,conversion_pct",
        "failure_monitor.csv": "gateway,failure_reason,failure_count,revenue_at_risk,recovered_count,"
                               "recovery_rate_pct,net_revenue_lost",
        "retry_summary.csv": "gateway,total_failures,recovered,not_recovered,recovery_pct,recovered_revenue,"
                             "lost_revenue,avg_days_to_recovery",
        "quality_report.csv": "check_name,status,message,metric,threshold",
    }
    for name, header in expected.items():
        parts = [p for p in (pathlib.Path(out) / name).iterdir() if p.name.endswith(".csv")]
        assert len(parts) == 1, name                     # one file per report
        assert parts[0].open().readline().strip() == header, name


def test_failed_refresh_keeps_the_previous_table(spark, tmp_path, monkeypatch):
    from ledgerlens.sources import etl

    root, good, bad = str(tmp_path / "root"), tmp_path / "good.csv", tmp_path / "bad.csv"
    head = "application_id,user_id,company,fee\n"
    good.write_text(head + "a1,u1,c,10.00\na2,u2,c,20.00\n")
    bad.write_text(head + "a3,u3,c,not a number\n")
    schema = "application_id string, user_id string, company string, fee decimal(18,2)"
    assert etl.load_table(spark, str(good), root, "applications", schema=schema) == 2
    with pytest.raises(Exception):
        etl.load_table(spark, str(bad), root, "applications", schema=schema)
    assert read_table(spark, root, "applications").count() == 2
    monkeypatch.setattr(etl, "switch_table", lambda *a: (_ for _ in ()).throw(OSError("no rename")))
    with pytest.raises(OSError):
        etl.load_table(spark, str(good), root, "applications", schema=schema)
    assert read_table(spark, root, "applications").count() == 2


def test_two_recovered_failures_of_one_payment_have_two_events(spark):
    from ledgerlens.sources.etl import retry_success_events

    f = spark.createDataFrame([("f1", "p1", 1, "2024-01-02"), ("f2", "p1", 1, "2024-01-05"), ("f3", "p2", 1, "soon")],
                              "failure_id string, payment_id string, recovered int, recovery_date string")
    assert sorted(r.event_id for r in retry_success_events(f).collect()) == ["retry:f1", "retry:f2"]

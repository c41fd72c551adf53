"""Dashboard data preparation on hand-built rows (cases the driver data never produces)."""

from ledgerlens.operators import views as V

CHECK_SCHEMA = "check_name string, status string, message string, metric string, threshold string"


def checks(spark, *statuses):
    return spark.createDataFrame([(f"c{i}", s, f"m{i}", None if i % 2 else "1.0", None if i % 3 else "> 0")
                                  for i, s in enumerate(statuses)], CHECK_SCHEMA)


def test_worst_status_ignores_error(spark):
    assert V.worst_status(checks(spark, "PASS", "ERROR")).first().worst_status == "PASS"
    assert V.worst_status(checks(spark, "WARN", "ERROR", "PASS")).first().worst_status == "WARN"
    assert V.worst_status(checks(spark, "WARN", "FAIL")).first().worst_status == "FAIL"


def test_status_counts_include_zeros(spark):
    got = {r.status: r["count"] for r in V.status_counts(checks(spark, "PASS", "PASS", "ERROR")).collect()}
    assert got == {"PASS": 2, "WARN": 0, "FAIL": 0, "ERROR": 1}


def test_check_line_and_display(spark):
    rows = {r.check_name: r.line for r in V.check_line(checks(spark, "PASS", "FAIL")).collect()}
    assert rows["c0"] == "[PASS ]  " + "c0".ljust(42) + "  metric=1.0  threshold=> 0  — m0"
    assert rows["c1"] == "[FAIL ]  " + "c1".ljust(42) + "  — m1"          # no metric, no threshold
    d = V.checks_display(checks(spark, "FAIL", "PASS")).collect()
    assert (d[1]["Metric"], d[1]["Threshold"]) == ("—", "—")
    long_name = spark.createDataFrame([("x" * 50, "WARN", "m", None, None)], CHECK_SCHEMA)
    assert V.check_line(long_name).first().line.startswith("[WARN ]  " + "x" * 50 + "  — ")


def test_money_and_percent_text(spark):
    df = spark.createDataFrame([(31890551.44,), (2781583.69,), (99999.5,), (1234.4,), (0.0,)], "v double")
    got = [r.v_inr for r in V.with_inr(df, "v").collect()]
    assert got == ["₹3.19 Cr", "₹27.82 L", "₹100,000", "₹1,234", "₹0"]
    pct = spark.createDataFrame([(18.13,), (100.0,), (None,)], "p double")
    assert [r.p_text for r in V.with_pct_text(pct.na.drop(), "p").collect()] == ["18.1%", "100.0%"]
    ret = spark.createDataFrame([("2024-01", 100.0, None)], "cohort_month string, m0 double, m1 double")
    r = V.retention_display(ret).first()
    assert (r.m0, r.m1) == ("100.0%", "—")


def test_share_of_total_is_exact(spark):
    df = spark.createDataFrame([("a", 0.1), ("b", 0.2), ("c", 0.7)], "gateway string, revenue double")
    got = {r.gateway: r.share_pct for r in V.gateway_revenue_share(df).collect()}
    assert got == {"a": 10.0, "b": 20.0, "c": 70.0}

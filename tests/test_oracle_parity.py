"""Every registered query against its DuckDB oracle on the sf0.01 driver tables."""

import pytest

import __spark_entry__ as entry
from parity import compare
from conftest import SF_SMALL
from ledgerlens.plans.oracle import ORACLE as ORACLES
from ledgerlens.plans.registry import QUERIES

# The reference's operators, each with an oracle; the training-data subpackage has its own tests.


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_parity(spark, duck, key):
    assert compare(spark, duck, key, SF_SMALL, QUERIES[key], ORACLES[key], verbose=True)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["month", "revenue", "transactions", "unique_payers"]
    assert len(rows) > 0


@pytest.mark.parametrize("key", ["arpu", "revenue_growth", "cohort_retention", "failure_monitor", "run_all",
                                 "gateway_health", "duplicate_transactions", "kpi_header"])
def test_parity_with_ansi_off(spark, duck, key):
    """Results do not depend on ANSI mode (ratios use NULLIF, casts are try_cast)."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert compare(spark, duck, key, SF_SMALL, QUERIES[key], ORACLES[key], verbose=True)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)

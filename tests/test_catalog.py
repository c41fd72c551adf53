"""The five tables in the session catalog."""

from __future__ import annotations

import pytest

from conftest import SF_SMALL
from ledgerlens.schema import TABLE_NAMES, TABLE_SCHEMAS
from ledgerlens.sources import catalog
from ledgerlens.sources.binding import bind
from ledgerlens.sources.tables import write_table


@pytest.fixture
def database(spark, tmp_path):
    name = "ledger_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {catalog._quoted(name)} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {catalog._quoted(name)} CASCADE")


def flags(spark, database):
    return {r.table_name: r.exists for r in catalog.catalog_verify(spark, database).collect()}


def test_create_verify_drop_and_reset(spark, database):
    assert not any(flags(spark, database).values())
    assert catalog.catalog_create(spark, database) == list(TABLE_NAMES)
    assert catalog.catalog_create(spark, database) == [] and all(flags(spark, database).values())
    for name in TABLE_NAMES:
        stored = spark.table(catalog._full(database, name)).schema
        assert [(f.name, f.dataType) for f in stored] == [(f.name, f.dataType) for f in TABLE_SCHEMAS[name]]
    spark.sql(f"INSERT INTO {catalog._full(database, 'users')} VALUES ('u1', DATE '2024-01-02', '2024-01', 1)")
    assert spark.table(catalog._full(database, "users")).count() == 1
    spark.sql(f"DROP TABLE {catalog._full(database, 'payments')}")
    assert catalog.catalog_create(spark, database) == ["payments"] and spark.table(catalog._full(database, "users")).count() == 1
    assert catalog.catalog_drop(spark, database) == list(reversed(TABLE_NAMES)) and catalog.catalog_drop(spark, database) == []
    assert catalog.catalog_reset(spark, database) == list(TABLE_NAMES) and spark.table(catalog._full(database, "users")).count() == 0


def test_parents_come_before_their_children():
    order = {n: k for k, n in enumerate(TABLE_NAMES)}
    for child, columns in catalog.PARENTS.items():
        for column, parent in columns.items():
            assert order[parent] < order[child] and column in TABLE_SCHEMAS[child].names


def test_publish_reads_the_current_versions(spark, tmp_path):
    root, users = str(tmp_path / "store"), bind(spark, SF_SMALL).users
    write_table(users, root, "users")
    try:
        assert catalog.publish(spark, root) == ["users"]
        assert spark.sql("SELECT COUNT(*) AS n FROM users").first().n == users.count()
    finally:
        spark.catalog.dropTempView("users")

"""The five tables in the session catalog (S20–S22), for SQL by name.

Tables are created from their StructTypes with ``CREATE TABLE IF NOT EXISTS``, parents
first, and dropped children first; a table's comment names the columns that point at a parent,
as Spark doesn't enforce them. ``publish`` puts the current version of stored tables behind
the names as views, so ``spark.sql`` reads what ``read_table`` reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlens.schema import TABLE_NAMES, TABLE_SCHEMAS
from ledgerlens.sources.tables import read_table, table_exists

# The columns that point at another table's key.
PARENTS = {
    "payments": {"user_id": "users"},
    "applications": {"user_id": "users"},
    "revenue_events": {"payment_id": "payments"},
    "payment_failures": {"payment_id": "payments", "user_id": "users"},
}


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _full(database: str, table: str) -> str:
    return f"{_quoted(database)}.{_quoted(table)}"


def _columns(schema: T.StructType) -> str:
    return ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in schema)


def catalog_verify(spark: SparkSession, database: str = "default") -> DataFrame:
    """One row per expected table with an ``exists`` flag."""
    rows = [(n, spark.catalog.tableExists(f"{_full(database, n)}")) for n in TABLE_NAMES]
    return spark.createDataFrame(rows, "table_name string, exists boolean")


def catalog_create(spark: SparkSession, database: str = "default") -> list[str]:
    """Create the missing tables (and the database), parents first; returns their names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}")
    created = []
    for name in TABLE_NAMES:
        if not spark.catalog.tableExists(_full(database, name)):
            note = "; ".join(f"{c} refers to {p}" for c, p in PARENTS.get(name, {}).items())
            spark.sql(f"CREATE TABLE IF NOT EXISTS {_full(database, name)} ({_columns(TABLE_SCHEMAS[name])}) USING parquet COMMENT '{note}'")
            created.append(name)
    return created


def catalog_drop(spark: SparkSession, database: str = "default") -> list[str]:
    """Drop the tables that exist, children first; returns their names in that order."""
    dropped = [n for n in reversed(TABLE_NAMES) if spark.catalog.tableExists(_full(database, n))]
    for name in dropped:
        spark.sql(f"DROP TABLE IF EXISTS {_full(database, name)}")
    return dropped


def catalog_reset(spark: SparkSession, database: str = "default") -> list[str]:
    """Drop all tables and create them anew, empty."""
    catalog_drop(spark, database)
    return catalog_create(spark, database)


def publish(spark: SparkSession, root: str) -> list[str]:
    """Temporary views of the stored tables' current versions; returns the names published."""
    found = [n for n in TABLE_NAMES if table_exists(spark, root, n)]
    for name in found:
        read_table(spark, root, name).createOrReplaceTempView(name)
    return found

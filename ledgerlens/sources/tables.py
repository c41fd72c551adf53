"""The five domain tables as one bundle of lazy DataFrames, plus stored-table IO.

Stored layout (one folder per table under a root path, Parquet):

* ``write_table(..., partition_by=[...])`` can lay a table out by a column (e.g. a
  month) so that date-bounded reads prune files; the operators do not need it.
* No bucketing by ``user_id``: with one user able to hold a third of all payments,
  that bucket would be one task's third of the table. Map-side pre-aggregation
  before each shuffle keeps hot users cheap instead.
* Every change is a new version (``snapshots``): its data is written aside, in the load
  path counted, and becomes the table by one small manifest written last. Whatever step
  is lost, readers see the version before or the version after, never none.
* Read tables are held against their StructType: a missing or retyped column is an error
  that names it (``read_tables`` always, ``read_table`` on request).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlens.schema import TABLE_NAMES, TABLE_SCHEMAS
from ledgerlens.sources.snapshots import Snapshots


class Tables:
    """The five domain tables. Each may be given as a DataFrame or as a zero-argument
    callable that builds it; a callable runs on first access only, so an operator
    that reads two tables never plans the other three."""

    __slots__ = ("_src", "_built")

    def __init__(self, **frames):
        unknown = set(frames) - set(TABLE_NAMES)
        missing = set(TABLE_NAMES) - set(frames)
        if unknown or missing:
            raise TypeError(f"Tables needs exactly {TABLE_NAMES}; unknown={sorted(unknown)} missing={sorted(missing)}")
        object.__setattr__(self, "_src", dict(frames))
        object.__setattr__(self, "_built", {})

    def __getattr__(self, name: str) -> DataFrame:
        src = object.__getattribute__(self, "_src")
        if name not in src:
            raise AttributeError(name)
        built = object.__getattribute__(self, "_built")
        if name not in built:
            v = src[name]
            built[name] = v if isinstance(v, DataFrame) else v()
        return built[name]

    def __setattr__(self, name, value):
        raise AttributeError("Tables is immutable; use replace()")

    def as_dict(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in TABLE_NAMES}

    def replace(self, **kw: DataFrame) -> "Tables":
        src = dict(object.__getattribute__(self, "_src"))
        src.update(kw)
        return Tables(**src)

    def register_views(self) -> None:
        """Expose every table as a temp view of the same name for spark.sql."""
        for name, df in self.as_dict().items():
            df.createOrReplaceTempView(name)


def as_tables(tables) -> Tables:
    """A ``Tables`` bundle from a ``Tables`` or a ``dict`` name → DataFrame (or builder)."""
    if isinstance(tables, Tables):
        return tables
    if isinstance(tables, dict):
        return Tables(**tables)
    raise TypeError(f"expected Tables or dict of the five tables, got {type(tables).__name__}")


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def snapshots(spark: SparkSession, root: str, name: str) -> Snapshots:
    return Snapshots(spark, table_path(root, name))


def stage_table(df: DataFrame, root: str, name: str, partition_by: list[str] | None = None) -> str:
    """Write the data of a new version of a table; returns its folder."""
    return snapshots(df.sparkSession, root, name).stage(df, partition_by)


def drop_staged(spark: SparkSession, staged: str) -> None:
    Snapshots(spark, staged).discard(staged)


def switch_table(spark: SparkSession, staged: str, root: str, name: str, append: bool = False) -> None:
    """Make a staged folder the table (``append``: a part of it), then drop versions no longer kept."""
    s = snapshots(spark, root, name)
    s.commit([staged], append=append)
    s.expire()


ID_TYPES = {"string", "bigint", "int"}


class SchemaMismatch(ValueError):
    """A stored table doesn't have the columns of its contract."""


def schema_differences(found: T.StructType, expected: T.StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(column, difference, found type, expected type) with difference missing, extra or retyped;
    order and nullability are no difference, and ids may be text or whole numbers (they are only compared)."""
    same = lambda c, a, b: a == b or (c.endswith("_id") and {a, b} <= ID_TYPES)
    have = {f.name: f.dataType.simpleString() for f in found}
    want = {f.name: f.dataType.simpleString() for f in expected}
    out = [(c, "missing", None, t) for c, t in want.items() if c not in have]
    out += [(c, "retyped", have[c], t) for c, t in want.items() if c in have and not same(c, have[c], t)]
    return out + [(c, "extra", t, None) for c, t in have.items() if c not in want]


def checked(df: DataFrame, name: str, expected: T.StructType | None = None) -> DataFrame:
    """The frame itself if it has every column of the contract in its type (more may follow)."""
    wrong = [f"{c} is {kind}" + (f" ({have} instead of {want})" if have else f" ({want})")
             for c, kind, have, want in schema_differences(df.schema, expected or TABLE_SCHEMAS[name]) if kind != "extra"]
    if wrong:
        raise SchemaMismatch(f"table {name}: " + "; ".join(wrong))
    return df


def read_table(spark: SparkSession, root: str, name: str, contract: bool = False) -> DataFrame:
    """S2 ``src_table``: a stored table by name, as its current version is; with ``contract``
    the columns are held against the table's StructType."""
    if name not in TABLE_SCHEMAS:
        raise KeyError(f"unknown table {name!r}")
    s = snapshots(spark, root, name)
    # Without any folder the plain path gives Spark's own error for a missing table.
    df = spark.read.parquet(*(s.paths() or [s.path]))
    return checked(df, name) if contract else df


def read_tables(spark: SparkSession, root: str) -> Tables:
    """All five stored tables; each is opened (file listing, footers) on first use only."""
    return Tables(**{n: (lambda n=n: read_table(spark, root, n, contract=True)) for n in TABLE_NAMES})


def write_table(df: DataFrame, root: str, name: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """``overwrite`` = truncate + load (full refresh), ``append`` keeps rows."""
    if mode not in ("overwrite", "append"):
        raise ValueError("mode must be 'overwrite' or 'append'")
    switch_table(df.sparkSession, stage_table(df, root, name, partition_by), root, name, append=mode == "append")


def write_tables(tables: Tables, root: str, mode: str = "overwrite",
                 partition_by: dict[str, list[str]] | None = None) -> None:
    """Store all five tables under ``root`` in load order (parents first), one parallel
    Parquet write per table; ``partition_by`` maps a table name to its partition columns."""
    for name in TABLE_NAMES:
        write_table(getattr(tables, name), root, name, mode=mode, partition_by=(partition_by or {}).get(name))


def truncate_table(spark: SparkSession, root: str, name: str) -> None:
    """Empty one stored table (an overwrite with no rows, schema kept)."""
    write_table(spark.createDataFrame([], TABLE_SCHEMAS[name]), root, name)


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    """True when there is a version to read, also one that only a lost rename of the older layout left."""
    s = snapshots(spark, root, name)
    return s.exists() or (s.recover() is not None)


def verify_tables(spark: SparkSession, root: str) -> DataFrame:
    """One row per expected table with an ``exists`` flag."""
    rows = [(n, table_exists(spark, root, n)) for n in TABLE_NAMES]
    return spark.createDataFrame(rows, "table_name string, exists boolean")


def create_tables(spark: SparkSession, root: str) -> list[str]:
    """Create each missing table empty from its StructType; idempotent.

    Returns the names that were created.
    """
    created = [name for name in TABLE_NAMES if not table_exists(spark, root, name)]
    for name in created:
        write_table(spark.createDataFrame([], TABLE_SCHEMAS[name]), root, name)
    return created


def drop_tables(spark: SparkSession, root: str) -> list[str]:
    """Drop every table that exists, children before parents; returns their names in that order."""
    dropped = [name for name in reversed(TABLE_NAMES) if table_exists(spark, root, name)]
    for name in dropped:
        s = snapshots(spark, root, name)
        s.drop()
        s.expire(keep=1)
    return dropped


def reset_tables(spark: SparkSession, root: str) -> None:
    """Drop all tables, children first, and create them anew, parents first."""
    drop_tables(spark, root)
    create_tables(spark, root)

"""CSV source and sink (S1, S18) with explicit schemas.

Header row, empty cell = NULL, ISO dates; the schema is always given, never
inferred, and malformed rows fail the read (FAILFAST) rather than turning into
silent NULLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from ledgerlens.schema import TABLE_SCHEMAS

READ_SCALE = 20  # decimals are read with this many places, then held against the column's own


def _exists(spark: SparkSession, path: str) -> bool:
    """Path existence through the Hadoop file system of the session (any scheme)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - no JVM handle (e.g. a remote session): local paths only
        import os

        return os.path.exists(path.removeprefix("file:"))
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             table: str | None = None, lenient_dates: tuple[str, ...] = ()) -> DataFrame:
    """Read a header CSV (file or folder of part files) with a fixed schema.

    ``schema`` defaults to the domain schema of ``table``. A missing path raises
    ``FileNotFoundError``. A decimal with more places than its column holds fails the read
    instead of being rounded. Dates in ``lenient_dates`` that don't parse become NULL.
    """
    if schema is None:
        if table not in TABLE_SCHEMAS:
            raise ValueError("give a schema or a known table name")
        schema = TABLE_SCHEMAS[table]
    if not _exists(spark, path):
        raise FileNotFoundError(f"CSV not found: {path}")
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    raw = (spark.read.schema(StructType([_as_read(f, lenient_dates) for f in schema]))
           .option("header", True)
           .option("nullValue", "")
           .option("mode", "FAILFAST")
           .option("dateFormat", "yyyy-MM-dd")
           .csv(path))
    return raw.select(*[_as_declared(f, lenient_dates).alias(f.name) for f in schema])


def _as_read(f: StructField, lenient_dates: tuple[str, ...]) -> StructField:
    if isinstance(f.dataType, DecimalType):
        return StructField(f.name, DecimalType(38, READ_SCALE), f.nullable)
    return StructField(f.name, StringType(), f.nullable) if f.name in lenient_dates else f


def _as_declared(f: StructField, lenient_dates: tuple[str, ...]) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, DecimalType):
        exact = c.cast(f.dataType)
        too_fine = F.raise_error(F.concat(F.lit(f"{f.name}: more decimal places than {f.dataType.scale}: "), c.cast("string")))
        return F.when(c.isNull() | (c == exact), exact).otherwise(too_fine.cast(f.dataType))
    return F.try_to_date(c, "yyyy-MM-dd") if f.name in lenient_dates else c


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> str:
    """Write a header CSV folder. ``single_file`` is for small report frames only
    (one writer task); data sets are written in parallel, one part per task."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).option("header", True).option("nullValue", "").csv(path)
    return path


def save_datasets(frames: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    """Every frame as ``<out_dir>/<name>.csv`` (a folder of part files, written in parallel)."""
    return {name: write_csv(df, f"{out_dir.rstrip('/')}/{name}.csv") for name, df in frames.items()}

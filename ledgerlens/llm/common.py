"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlens
from ledgerlens.session import scratch_path

# Words of the contracts: maximal runs without ASCII white space, and (licences,
# benchmark passages) maximal runs of ASCII letters, digits and non-ASCII characters.
ASCII_SPACE = "[\\x20\\x09-\\x0D]+"
NOT_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def for_python(spark: SparkSession, rows: int = 512) -> None:
    """Before a job that runs Python on the executors: bound the Arrow batches (texts can be
    very long, and the default of 10,000 rows would hold all of them in a worker at once)
    and ship this package, so that workers import it rather than unpickle it per task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    sc = spark.sparkContext
    if getattr(sc, "_ledgerlens_shipped", False):
        return
    root = Path(ledgerlens.__file__).parent
    package = Path(tempfile.mkdtemp(prefix="ledgerlens-package-")) / "ledgerlens.zip"  # the driver serves it to executors
    with zipfile.ZipFile(package, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    sc.addPyFile(str(package))
    sc._ledgerlens_shipped = True


def stored(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Write a frame below the shared folder of ``spark.checkpoint.dir`` and read it back
    (cuts the lineage; a lost executor costs a re-read, not a recomputation)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet (compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_or_empty(c: str = "text") -> Column:
    """The text; NULL counts as the empty text."""
    return F.coalesce(F.col(c).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only (``lower`` would also map other alphabets)."""
    return F.translate(c, UPPER, LOWER)


def split_words(c: Column, gap: str) -> Column:
    """Words between runs of ``gap``; an empty array where there is none."""
    return F.filter(F.split(c, gap), lambda w: w != F.lit(""))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")

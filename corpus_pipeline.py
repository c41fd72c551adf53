"""The corpus pipeline: documents to token shards in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes every
stage's result as Parquet in the shared folder and reads it back as the next one's input,
so a lost executor costs at most the current stage. All stages but the last return the
columns of ``docs``; the last returns the token index read back from the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bitplane, decontaminate, mixing, ordinal, queries, simhash
from ledgerlens.llm.common import documents, fresh, stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier rejects (toxic, poor) go."""
    return ordinal.accepted(docs, queries.table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays."""
    return simhash.one_of_each_group(docs, shingle=3, distance=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated as often as the mix takes them (rows; none: the document goes)."""
    own, of, times, tie, copy = (fresh(docs, c) for c in ("own_id", "own_text", "times", "tie", "copy"))  # columns of docs may have any name
    use = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    taken = mixing.mix(queries.sized(docs)).groupBy(F.col("doc_id").alias(own), F.col("tie").alias(of)).agg(F.max(use).alias(times))
    taken = stored(taken.where(F.col(times) > 0), "mix-times")
    d = docs.withColumn(tie, F.xxhash64("text"))
    joined = d.join(taken, d["doc_id"].cast("long").eqNullSafe(taken[own]) & (d[tie] == taken[of]))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix as bit-plane shards, in document order; their index read back."""
    return bitplane.encode_corpus(docs, queries.VOCABULARY)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixture),
    ("bitplane_tokens", tokens),
]

# The classifier, the near-duplicate groups and the tokens are outside SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Registered queries of the training-data operators: each applies its operator, with
production parameters, to its whole table. ORACLE holds SQL where SQL can express one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import bitplane, collocations, decontaminate, hyperminhash, licenses, mixing, ordinal, periodic, rankmerge, rlz, simhash, suffixes, syncmers
from ledgerlens.llm.common import ASCII_SPACE, documents

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
WORD = ASCII_SPACE.replace("[", "[^")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = ordinal.fit(docs, ordinal.graded(table(spark, sf_dir, "labels")), 3)
    return ordinal.scored(docs, model, 2).select("doc_id", "score.expected_grade", "score.tail", (F.col("score.tail") >= 0.5).alias("keep"))


def op2_bitplane_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplane.encode_corpus(documents(spark, sf_dir), VOCABULARY)


def op3_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = simhash.groups(documents(spark, sf_dir), shingle=3, distance=2)
    return g.select("doc_id", simhash.hexed(F.col("fp")).alias("fingerprint"), "component_id")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankmerge.token_counts(documents(spark, sf_dir), VOCABULARY, limit=2048)


def op6_syncmer_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.fingerprints(documents(spark, sf_dir))


def sized(docs: DataFrame) -> DataFrame:
    """The mixing operator's input: each document belongs to its own source."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD.removesuffix("+") + "+")), F.lit(0))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), F.array(F.col("source").cast("string")).alias("members"), F.xxhash64("text").alias("tie"))


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mixing.mix(sized(documents(spark, sf_dir)))
    return m.select("doc_id", "size", F.get("source_sizes", 0).alias("source_size"), F.get("targets", 0).alias("target"), "taken")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.removed_bytes(documents(spark, sf_dir), length=400)


def op9_benchmark_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op10_rlz_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rlz.removed_words(documents(spark, sf_dir), length=35)


def op11_hyperminhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.groups(documents(spark, sf_dir))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(documents(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.collapsed_runs(documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_quality_classifier, op2_bitplane_tokens, op3_simhash_groups, op4_license_scan, op5_token_counts, op6_syncmer_fingerprints,
    op7_source_mix, op8_suffix_dedup, op9_benchmark_overlaps, op10_rlz_dedup, op11_hyperminhash_groups, op12_collocations, op13_periodic_runs, pipeline)}
ORACLE: dict[str, str] = {"op11_hyperminhash_groups": hyperminhash.ORACLE_SQL, "op12_collocations": collocations.ORACLE_SQL}

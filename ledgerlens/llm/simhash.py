"""SimHash near-duplicates by deletion-variant signatures (operator 3).

Each text gets a 64-bit fingerprint of its word shingles; fingerprints that differ in at
most ``distance`` = 2 bits are linked, and documents reachable over links form a group.

Two segments of 32 bits suffice: of two differing bits, one segment holds at most one. So
each distinct fingerprint is indexed under 2 x 32 signatures, "segment s without its bit
j"; segments equal up to one bit agree in the signature that leaves that bit out. An
equality join on signatures gives the candidates and the exact bit distance decides.

Equal texts collapse first: one row per distinct fingerprint enters the index. A signature
shared by more than ``bucket`` fingerprints is not expanded into pairs; its members look
up their neighbours instead: the 64 + 2016 fingerprints one or two flipped bits away,
again by equality join. That finds every link of those members, at a cost per member that
does not depend on the size of the signature's group. (The bucket bound chooses between two exact
ways; it drops nothing.)

Defined results: NULL or word-less text has fingerprint zero, linked like any other;
fewer words than a shingle hash as one sequence; NULL doc_id is kept (the group's id is the
smallest known one, NULL if none is); repeated rows stay rows; an empty table gives no row.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import fresh, for_python, shuffle_partitions, stored, text_or_empty
from ledgerlens.llm.components import components
from ledgerlens.llm.wordcache import of_worker

SEED = 42
BITS = 64
HALF = 32


def fingerprint(text: bytes, shingle: int) -> int:
    """Signed 64-bit SimHash: a bit is set if more than half of the shingle hashes set it."""
    words = text.lower().split()  # bytes: lower-cases A-Z only, splits at ASCII white space only
    if not words:
        return 0
    flat = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    hashes = np.array([digest(flat[a:b], SEED) for a, b in zip(starts[:n], last, strict=True)], "<u8")
    ones = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(shingle: int):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        of_worker("simhash", None, dict)  # drops what an earlier stage kept in this worker
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return of(text_or_empty().cast("binary"))


def _apart(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, distance: int = 2, bucket: int = 64) -> DataFrame:
    """a < b: all pairs of distinct fingerprints (column ``fp``) at most ``distance`` bits
    apart that share a signature of at most ``bucket`` members, and all pairs of the others."""
    if not 0 <= distance <= 2:
        raise ValueError("two segments with one wildcard bit find distances up to 2")
    fps = fps.repartition(shuffle_partitions(fps.sparkSession), "fp")  # each row becomes 64: more tasks than its few files
    segment = F.when(F.col("k") < HALF, F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF))).otherwise(F.shiftrightunsigned("fp", HALF))
    signed = (fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(BITS - 1))).alias("k"))
              .select("fp", F.col("k").cast("byte").alias("k"),
                      segment.bitwiseAND(F.bitwise_not(F.expr(f"shiftleft(1L, k % {HALF})"))).alias("rest")))
    groups = signed.groupBy("k", "rest").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stored(signed.join(groups, ["k", "rest"]), "signatures")
    few = shared.where(F.col("n") <= bucket).select("k", "rest", "fp")
    pairs = (few.select("k", "rest", F.col("fp").alias("a")).join(few.select("k", "rest", F.col("fp").alias("b")), ["k", "rest"])
             .where((F.col("a") < F.col("b")) & (_apart("a", "b") <= distance)).select("a", "b"))
    hot = stored(shared.where(F.col("n") > bucket).select("fp").distinct(), "hot-fingerprints")
    if hot.isEmpty():
        return pairs.distinct()
    flips = [1 << i for i in range(BITS)] if distance else []
    if distance == 2:
        flips += [1 << i | 1 << j for i in range(BITS) for j in range(i)]
    signed64 = [x - (1 << 64) if x >> 63 else x for x in flips]
    masks = fps.sparkSession.createDataFrame([(signed64,)], "masks array<long>")
    near = (hot.join(F.broadcast(masks))  # one row: the flip masks
            .select(F.col("fp").alias("a"), F.explode("masks").alias("m"))
            .select("a", F.col("a").bitwiseXOR(F.col("m")).alias("b")))
    found = near.join(fps.select(F.col("fp").alias("b")), "b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return pairs.union(found).distinct()


def groups(docs: DataFrame, shingle: int = 3, distance: int = 2, bucket: int = 64) -> DataFrame:
    """doc_id, fp (signed long), component_id (smallest doc_id reachable), h (hash of the text),
    root (smallest fingerprint of the group) of every row."""
    for_python(docs.sparkSession)
    marked = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text_or_empty()).alias("h"), fingerprint_column(shingle).alias("fp")), "fingerprints")
    fps = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = components(links(fps.select("fp"), distance, bucket))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id"))
    # Both joins meet a group of copies on one key; adaptive skew splitting divides the side of the documents.
    of_fp = stored(named.select("fp", "root").join(smallest, "root").select("fp", "root", "component_id"), "fingerprint-groups")
    return marked.join(of_fp, "fp").select("doc_id", "fp", "component_id", "h", "root")


def hexed(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_of_each_group(docs: DataFrame, shingle: int = 3, distance: int = 2) -> DataFrame:
    """The documents without near-duplicates, all columns: of each group the row with the
    smallest doc_id (NULL last), then the smallest text hash, stays once."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("_id"), F.col("h").alias("_h")))
    stay = stored(groups(docs, shingle, distance).groupBy("root").agg(first.alias("m")).select("m._id", "m._h"), "kept-ids")
    h, rank = fresh(docs, "h"), fresh(docs, "rank")
    d = docs.withColumn(h, F.xxhash64(text_or_empty()))
    kept = d.join(stay, d["doc_id"].cast("long").eqNullSafe(stay["_id"]) & (d[h] == stay["_h"]), "left_semi")
    once = Window.partitionBy("doc_id", h).orderBy(text_or_empty())
    return kept.withColumn(rank, F.row_number().over(once)).where(F.col(rank) == 1).drop(rank, h)

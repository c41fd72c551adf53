"""Benchmark decontamination by spaced seeds (operator 9, DataFrame functions only).

A fixed mask selects some of the next ``span`` words and ignores the others, so a seed
still hits when an ignored word was substituted. The hashes of the selected words of every
position, for every mask, are joined between the documents and the benchmark items. A hit
fixes an alignment (document position minus item position); each alignment is verified on
the words themselves. It counts if ``need`` equal words stand in a run of at most
``need / 0.7`` aligned words, where ``need`` is the smaller of ``least`` and 70% of the item,
but not under FLOOR words (or every word of a shorter item), which keeps chance hits out.
The score of the best segment (+1 for an equal word, -2 for a substituted one) is reported.

With the default ``least`` no alignment that counts is missed: by enumeration, the masks hit every
placement of the most substitutions that still count in an item of 9 to 18 words (1 in 9 words, 2 in
10, 3 in 11 to 13, 4 in 14 to 16, 5 in 17 and 18), and in longer items 13 equal words stand in a run of
18. The price of four selected words is more chance hits, each of which is verified.

Before hashing, words whose hash is not in a fixed-size bit table of the benchmark's words
become NULL: a position can only hit if all its selected words are known, so nearly all
positions end there. The table can only let too many through, never lose one.

Words are maximal runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
Items shorter than a mask are found by plain seeds of their own length.

Defined results: NULL or word-less texts and items match nothing; NULL ids are ids like any
other; rows that repeat a document (or an item) with the same text give one result row per
(doc_id, item_id), repeated doc_ids with other texts count by their best; empty tables give
no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import NOT_WORD, ascii_lower, split_words, stored, text_or_empty
from ledgerlens.llm.syncmers import let

# Selected places of each mask (weight 4): together they hit whatever the substitutions that count.
MASKS = ((0, 1, 4, 6), (0, 1, 3, 4), (0, 1, 2, 3))
# Equal words in ten that a run must have, and the fewest equal words that count.
SHARE, FLOOR = 7, 8
TABLE_BITS = 1 << 20
BROADCAST_SEEDS = 1_000_000


def worded(rows: DataFrame, id_col: str, *more: Column) -> DataFrame:
    return rows.select(F.col(id_col).alias("id"), split_words(ascii_lower(text_or_empty()), NOT_WORD).alias("words"), *more)


def known_words(items: DataFrame) -> Column:
    """Bit table of the items' words: 2^20 bits whatever the benchmark's size."""
    bits = [0] * (TABLE_BITS // 64)
    cell = F.pmod(F.xxhash64("w"), F.lit(TABLE_BITS))
    # One row of at most 64 bits per table word: at most 16,384 rows.
    found = (items.select(F.explode("words").alias("w")).select(cell.alias("c")).distinct()
             .groupBy(F.floor(F.col("c") / 64).cast("int").alias("k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(c % 64 as int))")).alias("b")))
    for r in found.collect():
        bits[r.k] = r.b
    # A cast of a split literal is folded to one literal array when the query is optimised.
    return F.split(F.lit(",".join(map(str, bits))), ",").cast("array<bigint>")


def seeds(words: DataFrame, masks: list[tuple[int, ...]], table: Column | None) -> DataFrame:
    """id, h, at, seed of every position whose selected words may all be known."""
    def word_hash(w: Column) -> Column:
        x = F.xxhash64(w)
        if table is None:
            return x
        return let(x, lambda v: F.when(F.getbit(F.get(table, F.shiftright(v.bitwiseAND(F.lit(TABLE_BITS - 1)), 6).cast("int")), v.bitwiseAND(F.lit(63)).cast("int")) == 1, v))

    def of_hashes(h: Column) -> Column:
        def of_mask(k: int, mask: tuple[int, ...]) -> Column:
            last = F.size(h) - mask[-1] - 1
            full = lambda i: reduce(Column.__and__, [F.get(h, i + p).isNotNull() for p in mask])
            seed = lambda i: F.struct(i.cast("int").alias("at"), F.xxhash64(F.lit(k), *(F.get(h, i + p) for p in mask)).alias("seed"))
            return F.when(last >= 0, F.transform(F.filter(F.sequence(F.lit(0), last), full), seed)).otherwise(F.array().cast("array<struct<at:int,seed:bigint>>"))

        return F.concat(*(of_mask(k, m) for k, m in enumerate(masks)))

    all_seeds = let(F.transform("words", word_hash), of_hashes)
    return words.select("id", "h", F.explode(all_seeds).alias("s")).select("id", "h", "s.at", "s.seed")


def needed(n: Column, least: int) -> Column:
    """Equal words that an alignment with an item of ``n`` words must have."""
    return F.greatest(F.least(F.lit(least), F.ceil(n * SHARE / 10)), F.least(F.lit(min(least, FLOOR)), n)).cast("int")


def best_segment(doc: Column, item: Column, shift: Column, span: Column) -> Column:
    """struct(score, matched, most): the best run of aligned words, +1 equal, -2 not, and the
    most equal words in a run of ``span``."""
    names = ("now", "n", "score", "matched", "run", "most")
    none = F.struct(*(F.lit(0).alias(c) for c in names))

    def equal(i: Column) -> Column:
        at = i + shift
        return (i >= 0) & (at >= 0) & F.coalesce(F.get(doc, F.greatest(at, F.lit(0))) == F.get(item, F.greatest(i, F.lit(0))), F.lit(False))

    def step(acc: Column, i: Column) -> Column:
        same = equal(i)
        now = F.greatest(acc["now"] + F.when(same, 1).otherwise(-2), F.lit(0))
        n = F.when(now == 0, F.lit(0)).otherwise(acc["n"] + same.cast("int"))
        better = now > acc["score"]
        run = acc["run"] + same.cast("int") - equal(i - span).cast("int")
        values = (now, n, F.when(better, now).otherwise(acc["score"]), F.when(better, n).otherwise(acc["matched"]), run, F.greatest(acc["most"], run))
        return F.struct(*(v.alias(c) for v, c in zip(values, names, strict=True)))

    return F.aggregate(F.sequence(F.lit(0), F.size(item) - 1), none, step)


def text_hash() -> Column:
    return F.xxhash64(text_or_empty())


def alignments(docs: DataFrame, items: DataFrame, least: int, masks) -> DataFrame:
    """doc_id, h (hash of the document's text), item_id, shift, item_words, need, best: every alignment that counts."""
    item_words = stored(worded(items, "item_id").where(F.size("words") > 0).withColumn("h", F.xxhash64("words")).distinct(), "items")
    doc_words = worded(docs, "doc_id", text_hash().alias("h"))
    span = max(m[-1] for m in masks) + 1
    short = [r.n for r in item_words.select(F.size("words").alias("n")).where(F.col("n") < span).distinct().collect()]  # fewer than a span
    every = [*masks, *(tuple(range(n)) for n in sorted(short))]
    item_seeds = stored(seeds(item_words, every, None).select(F.col("id").alias("item_id"), F.col("h").alias("item_h"), F.col("at").alias("item_at"), "seed"), "item-seeds")
    if item_seeds.count() <= BROADCAST_SEEDS:
        item_seeds = F.broadcast(item_seeds)
    hits = (seeds(doc_words, every, known_words(item_words)).join(item_seeds, "seed")
            .select("id", "h", "item_id", "item_h", (F.col("at") - F.col("item_at")).alias("shift")).distinct())
    hits = stored(hits, "seed-hits").withColumnsRenamed({"id": "hit_id", "h": "hit_h"})
    on_doc = doc_words.join(hits, doc_words["id"].eqNullSafe(hits["hit_id"]) & (doc_words["h"] == hits["hit_h"]))
    i = item_words.select(F.col("id").alias("i_id"), F.col("h").alias("i_h"), F.col("words").alias("i_words"))
    both = on_doc.join(i, on_doc["item_id"].eqNullSafe(i["i_id"]) & (on_doc["item_h"] == i["i_h"]))
    both = both.withColumn("item_words", F.size("i_words")).withColumn("need", needed(F.col("item_words"), least))
    scored = both.select(F.col("id").alias("doc_id"), on_doc["h"], "item_id", "shift", "item_words", "need",
                         best_segment(F.col("words"), F.col("i_words"), F.col("shift"), F.floor(F.col("need") * 10 / SHARE).cast("int")).alias("best"))
    return scored.where(F.col("best.most") >= F.col("need"))


def overlaps(docs: DataFrame, items: DataFrame, least: int = 13, masks=MASKS) -> DataFrame:
    """doc_id, item_id, matched (equal words of the best segment, or of the best run if more),
    score, item_words, shift: one row per document and item that it holds."""
    return (alignments(docs, items, least, masks).groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("best.score", F.greatest("best.matched", "best.most").alias("matched"), "item_words", (-F.col("shift")).alias("back"))).alias("m"))
            .select("doc_id", "item_id", F.col("m.matched").cast("long").alias("matched"), F.col("m.score").cast("long").alias("score"),
                    F.col("m.item_words").cast("long").alias("item_words"), (-F.col("m.back")).cast("long").alias("shift")))


def clean(docs: DataFrame, items: DataFrame, least: int = 13) -> DataFrame:
    """The documents that hold no benchmark passage, all columns. Rows of one doc_id are one
    document and go together; a NULL id names no document, so such a row goes by its own text."""
    own = lambda id_col, h: F.when(id_col.isNull(), h)
    leaked = alignments(docs, items, least, MASKS).select(F.col("doc_id").alias("_leaked"), own(F.col("doc_id"), F.col("h")).alias("_text"))
    leaked = stored(leaked.distinct(), "leaked")
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["_leaked"]) & own(docs["doc_id"], text_hash()).eqNullSafe(leaked["_text"]), "left_anti")

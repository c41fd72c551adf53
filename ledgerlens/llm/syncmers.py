"""Document fingerprints from closed syncmers (operator 6, DataFrame functions only).

A text is a sequence of words (runs without ASCII white space). A k-mer of K words is
an anchor if the smallest hash of its inner S-mers stands at its first or last place.
Whether a k-mer is an anchor depends on its own words alone, so an edit moves anchors only
where it changes words, and texts can be matched by equal anchors and their positions.

The fingerprint holds every anchor of the text by position. Likeness is the share of common
distinct anchors, and ``aligned`` the number of them whose first places differ by one common
offset, both from all anchors of both texts: one sort of the two anchor lists, linear in
their length otherwise. The anchor lists are about as large as the text, so only texts are shuffled.
A sketch (the ``size`` smallest hashes at their first place) is an extra column; nothing is computed from it.

Fewer words than K: one anchor over all of them; no words: none. Everything is row by
row except the successor of a document in id order: rows are cut into id ranges at
approximate quantiles, ``lead`` runs inside a range, and every range ends with a copy of
the next range's first row (after the last range: of the first).

Defined results: NULL text = empty text; two texts without anchors have likeness 1, one
without and one with 0; NULL doc_id sorts first; rows that repeat a doc_id are ordered by
the hash of their text; a single row is its own successor; an empty table gives no row.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import ASCII_SPACE, shuffle_partitions, split_words, text_or_empty

K, S, SIZE = 6, 2, 64


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """Bind a value for use inside lambdas, where a plain expression would be computed again per element."""
    return F.get(F.transform(F.array(value), use), 0)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<hash long, at int>> of all closed syncmers, by position."""
    if not 0 < s < k:
        raise ValueError("inner substrings must be shorter than the k-mer")
    inner = k - s + 1
    empty = F.array().cast("array<struct<hash:bigint,at:int>>")

    def of_words(h: Column) -> Column:
        n = F.size(h)
        smers = F.transform(F.sequence(F.lit(0), n - s), lambda i: F.xxhash64(*(F.get(h, i + j) for j in range(s))))

        def closed(g: Column) -> Column:
            ends = lambda i: F.least(F.get(g, i), F.get(g, i + inner - 1))
            middle = lambda i: F.least(*(F.get(g, i + j) for j in range(1, inner - 1))) if inner > 3 else F.get(g, i + 1)
            keep = (lambda i: ends(i) <= middle(i)) if inner > 2 else (lambda i: F.lit(True))
            covers = sorted({*range(0, k - s + 1, s), k - s})
            return F.transform(F.filter(F.sequence(F.lit(0), n - k), keep),
                               lambda i: F.struct(F.xxhash64(*(F.get(g, i + j) for j in covers)).alias("hash"), i.cast("int").alias("at")))

        return (F.when(n == 0, empty).when(n < k, F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("at"))))
                .otherwise(let(smers, closed)))

    return let(F.transform(split_words(text, ASCII_SPACE), lambda w: F.xxhash64(w)), of_words)


def sketch(a: Column, size: int = SIZE) -> Column:
    """array<struct<hash, at>>: the smallest distinct anchor hashes, ascending, at their first place."""
    # Ascending by hash, then place: the first of each hash stands at its first place.
    return let(F.sort_array(a), lambda c: F.slice(F.filter(c, lambda x, i: ~F.coalesce(F.get(c, i - 1)["hash"] == x["hash"], F.lit(False))), 1, size))


def compared(a: Column, b: Column) -> Column:
    """struct(likeness, aligned) of two anchor lists: the share of common distinct anchors, 0 to 1,
    and the most common anchors whose first places differ by the same offset."""
    def side(c: Column, k: int) -> Column:
        return F.transform(c, lambda x: F.struct(x["hash"].alias("hash"), F.lit(k).alias("side"), x["at"].alias("at")))

    def firsts(c: Column) -> Column:
        def again(x: Column, i: Column) -> Column:
            before = F.get(c, i - 1)
            return F.coalesce((before["hash"] == x["hash"]) & (before["side"] == x["side"]), F.lit(False))

        return F.filter(c, lambda x, i: ~again(x, i))

    def offsets(f: Column) -> Column:
        step = F.transform(f, lambda x, i: let(F.get(f, i - 1), lambda before: F.when(before["hash"] == x["hash"], x["at"] - before["at"])))
        return F.sort_array(F.filter(step, lambda o: o.isNotNull()))

    def longest_run(o: Column) -> Column:
        none = F.struct(F.lit(None).cast("int").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("most"))

        def step(acc: Column, x: Column) -> Column:
            run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(1)
            return F.struct(x.alias("last"), run.alias("run"), F.greatest(acc["most"], run).alias("most"))

        return F.aggregate(o, none, step, lambda acc: acc["most"])

    def of(f: Column) -> Column:
        def result(o: Column) -> Column:
            union = F.size(f) - F.size(o)
            return F.struct(F.when(union == 0, F.lit(1.0)).otherwise(F.size(o) / union).alias("likeness"), longest_run(o).cast("long").alias("aligned"))

        return let(offsets(f), result)

    return let(F.sort_array(F.concat(side(a, 0), side(b, 1))), lambda c: let(firsts(c), of))


def as_text(sk: Column) -> Column:
    """hash@position of every anchor of a list, comma-joined."""
    return F.array_join(F.transform(sk, lambda x: F.concat(F.lpad(F.lower(F.hex(x["hash"])), 16, "0"), F.lit("@"), x["at"].cast("string"))), ",")


def _range_of(c: Column, bounds: list[int]) -> Column:
    """How many bounds are at most ``c`` (NULL: 0), by a two-level search."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    fine = F.array(*(F.array(*map(F.lit, bounds[k:k + step])) for k in range(0, len(bounds), step)))
    top = F.array(*map(F.lit, bounds[::step]))
    return let(F.size(F.filter(top, lambda b: b <= c)), lambda n: F.when(n == 0, F.lit(0)).otherwise(
        (n - 1) * step + F.size(F.filter(F.get(fine, n - 1), lambda b: b <= c))))


def with_next(rows: DataFrame, id_col: str, tie: str, carry: list[str]) -> DataFrame:
    """Each row with ``next_<c>`` of the row after it in (id, tie) order, the last one with the first's."""
    spark = rows.sparkSession
    n = 2 * shuffle_partitions(spark)
    cuts = rows.agg(F.percentile_approx(id_col, [k / n for k in range(1, n)], 10 * n).alias("q")).first().q or []
    bounds = sorted(set(cuts))
    rows = rows.withColumn("_range", _range_of(F.col(id_col), bounds))
    # One row per range: its first (id, tie).
    first = {r["_range"]: r.m for r in rows.groupBy("_range").agg(F.min(F.struct(F.col(id_col).isNotNull().alias("known"), F.col(id_col).alias("id"), F.col(tie).alias("tie"))).alias("m")).collect()}
    ranges = sorted(first)
    ends = [(r, first[ranges[(k + 1) % len(ranges)]].id, first[ranges[(k + 1) % len(ranges)]].tie) for k, r in enumerate(ranges)]
    heads = F.broadcast(spark.createDataFrame(ends, "_before int, _id long, _tie long"))  # a row per range
    copies = (rows.join(heads, rows[id_col].eqNullSafe(heads["_id"]) & (rows[tie] == heads["_tie"]))
              .select(*(F.col("_before").alias("_range") if c == "_range" else rows[c] for c in rows.columns), F.lit(1).alias("_copy")))
    order = Window.partitionBy("_range").orderBy("_copy", F.col(id_col).asc_nulls_first(), tie)
    return (rows.withColumn("_copy", F.lit(0)).unionByName(copies)
            .select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in carry)).where("_copy = 0").drop("_copy", "_range"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of every text, of its edited text (last half replaced by the start of
    the next document) and their likeness to it and to the next document."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("t"))
    pairs = with_next(rows.select("doc_id", "t", F.xxhash64("t").alias("h")), "doc_id", "h", ["t"])
    edited = pairs.select("doc_id", F.char_length("t").cast("long").alias("n_chars"), "t", "next_t",
                          F.concat(F.expr("left(t, char_length(t) - char_length(t) div 2)"), F.expr("left(next_t, cast(char_length(t) div 2 as int))")).alias("e"))
    found = edited.select("doc_id", "n_chars", F.sha2(F.col("e").cast("binary"), 256).alias("edited_sha256"),
                          anchors(F.col("t")).alias("a"), anchors(F.col("e")).alias("e_a"), anchors(F.col("next_t")).alias("next_a"))
    done = found.select("*", compared(F.col("a"), F.col("e_a")).alias("to_edited"), compared(F.col("a"), F.col("next_a")).alias("to_next"))
    return done.select("doc_id", "n_chars", "edited_sha256", as_text(F.col("a")).alias("fingerprint"), as_text(F.col("e_a")).alias("edited_fingerprint"),
                       F.col("to_edited.likeness").alias("near_edited"), F.col("to_next.likeness").alias("near_next"),
                       F.col("to_edited.aligned").alias("aligned_edited"), F.col("to_next.aligned").alias("aligned_next"),
                       as_text(sketch(F.col("a"))).alias("sketch"))

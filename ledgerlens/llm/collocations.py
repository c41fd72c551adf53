"""Phrase collocation mining by set-oriented merge joins, SETM (operator 12).

Texts are cut into pieces at punctuation and line ends, pieces into words; phrases are words
that stand side by side in a piece. All counts are per language.

1. Words are counted over the whole corpus; words of at least ``least`` occurrences get a
   number per language (no other word can be part of a frequent phrase).
2. The occurrence relation of length 1 (piece, place, word) is written bucketed by piece and
   sorted by piece and place. The pieces of a text go under one number, with a place left out
   between them, so that no two words of different pieces are adjacent. The relation of length
   k+1 is the merge join of the one of length k with it, by piece and adjacent place: buckets
   meet without a shuffle. From length 3 on only words that end a frequent pair are joined.
3. The joined rows are counted by phrase; the frequent groups are kept, the joined rows are
   semi-joined with them and written, sorted again, as the relation of length k+1.
4. Every part of a frequent phrase is frequent itself, so the counts of all cuts and all longer
   phrases are in these tables; scores, containment and ranks work on them alone.

A phrase is held as the numbers of its words, two to a long integer, so equality is exact.
The table of frequent groups is broadcast while it has at most ``BROADCAST_ROWS`` rows, and
joined by shuffle beyond (the result is the same; the relation is dealt to buckets anew).

Defined results: NULL or word-less text has no words; NULL lang counts as ``und``; rows that
repeat a document are documents of their own and count again; doc_id is not read; a
language without candidates gives no row; an empty table gives no row.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlens.llm.common import ascii_lower, shuffle_partitions, stored, text_or_empty
from ledgerlens.session import scratch_path

PIECE_END = "[.,;:!?\\x0A-\\x0D]"
GAP = "[\\x20\\x09]+"
ANY_GAP = "[.,;:!?\\x09-\\x0D\\x20]+"
PIECE_MARK = "."  # never a word, as it ends pieces
BROADCAST_ROWS = 500_000
SLOTS = 4096  # word numbers are dealt by hash slot, so that no single task numbers them all
# One sorted file a bucket: scans keep its order. Rows that agree in all join keys agree in the piece: its buckets will do.
BY_BUCKET = {"spark.sql.legacy.bucketedTableScan.outputOrdering": "true", "spark.sql.requireAllClusterKeysForCoPartition": "false"}


class Relations:
    """Occurrence relations as bucketed, sorted tables in the shared scratch folder; the
    catalog entries last until ``close``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.buckets = spark, shuffle_partitions(spark)
        self.names: list[str] = []
        self.before = {k: spark.conf.get(k) for k in BY_BUCKET}

    def __enter__(self) -> Relations:
        for k, v in BY_BUCKET.items():
            self.spark.conf.set(k, v)
        return self

    def __exit__(self, *_) -> None:
        for k, v in self.before.items():
            self.spark.conf.set(k, v)
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: the files stay

    def dealt(self, rows: DataFrame) -> DataFrame:
        """By piece, as the buckets are: each task then writes one bucket, as one file."""
        return rows.repartition(self.buckets, "piece")

    def store(self, rows: DataFrame, place: str) -> DataFrame:
        name = f"occurrences_{uuid.uuid4().hex}"
        self.names.append(name)
        (rows.write.bucketBy(self.buckets, "piece").sortBy("piece", place)
         .option("path", scratch_path(self.spark, "occurrences")).format("parquet").saveAsTable(name))
        return self.spark.table(name)


def language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("und"))


def folded(word: Column) -> Column:
    """A-Z in lower case. In ASCII words, which most are, ``lower`` does no more and is faster."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(ascii_lower(word))


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, f of all words."""
    words = texts.select("lang", F.explode(F.split("t", ANY_GAP)).alias("word")).where("word <> ''")
    return words.select("lang", folded(F.col("word")).alias("word")).groupBy("lang", "word").agg(F.count(F.lit(1)).alias("f"))


def numbered(counts: DataFrame, least: int) -> DataFrame:
    """lang, word, f, w: the frequent words with numbers from 1."""
    slot = F.pmod(F.xxhash64("lang", "word"), F.lit(SLOTS))
    within = Window.partitionBy("slot").orderBy("lang", "word")
    return (counts.where(F.col("f") >= least).withColumn("slot", slot).withColumn("k", F.row_number().over(within))
            .select("lang", "word", "f", ((F.col("k") - 1) * SLOTS + F.col("slot") + 1).cast("long").alias("w")))


def kept(rows: DataFrame, groups: DataFrame, on: list[str], how: str, broadcast_rows: int) -> tuple[DataFrame, bool]:
    """Rows joined with a stored table of groups, and whether they stayed where they were."""
    if groups.count() <= broadcast_rows:
        return rows.join(F.broadcast(groups), on, how), True
    return rows.join(groups, on, how), False


def placed(texts: DataFrame) -> DataFrame:
    """piece, lang, place, word: the words of texts (piece, lang, t), and marks between their pieces. Arrays
    are exploded as they are split, without a lambda that would keep the step out of generated code."""
    marked = F.regexp_replace("t", PIECE_END + "+", f" {PIECE_MARK} ")
    return texts.select("piece", "lang", F.posexplode(F.split(marked, GAP)).alias("place", "word")).withColumn("word", folded(F.col("word")))


def occurrences(texts: DataFrame, words: DataFrame, relations: Relations, broadcast_rows: int) -> DataFrame:
    """piece, place, w: the frequent words of all texts, sorted."""
    rows = placed(relations.dealt(texts.select(F.monotonically_increasing_id().alias("piece"), "lang", "t")))
    found, in_place = kept(rows, words.select("lang", "word", "w"), ["lang", "word"], "inner", broadcast_rows)
    found = found.select("piece", "place", F.col("w").cast("int").alias("w"))
    return relations.store(found if in_place else relations.dealt(found), "place")


def packed(left: Column, right: Column) -> Column:
    """Two word numbers in one long integer."""
    return F.shiftleft(left.cast("long"), 32).bitwiseOR(right.cast("long"))


def longer(relation: DataFrame, single: DataFrame, size: int) -> DataFrame:
    """The occurrences (piece, next, a, b) of ``size`` words whose first words stand in ``relation``;
    ``next`` is the place after the phrase, a and b hold its words."""
    s = single.select("piece", F.col("place").alias("next"), "w")
    both = relation.hint("merge").join(s, ["piece", "next"])
    zero = F.lit(0).cast("long")
    a, b = {2: (packed(F.col("a"), F.col("w")), zero), 3: (F.col("a"), packed(F.col("w"), zero)), 4: (F.col("a"), F.col("b").bitwiseOR(F.col("w").cast("long")))}[size]
    return both.select("piece", (F.col("next") + 1).alias("next"), a.alias("a"), b.alias("b"))


def mined(texts: DataFrame, words: DataFrame, least: int, most: int, broadcast_rows: int) -> DataFrame:
    """words (array of numbers), f: all phrases of 1 to ``most`` words with f >= least."""
    levels = [words.select(F.array(F.col("w").cast("int")).alias("words"), "f")]
    with Relations(texts.sparkSession) as relations:
        single = occurrences(texts, words, relations, broadcast_rows)
        now = single.select("piece", (F.col("place") + 1).alias("next"), F.col("w").cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
        for size in range(2, most + 1):
            joined = longer(now, single, size)
            groups = stored(joined.groupBy("a", "b").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= least), f"phrases-{size}")
            number = [half.cast("int") for c in (F.col("a"), F.col("b")) for half in (F.shiftright(c, 32), c.bitwiseAND(F.lit(0xFFFFFFFF)))]
            levels.append(groups.select(F.array(*number[:size]).alias("words"), "f"))
            if size < most:
                frequent, in_place = kept(joined, groups.select("a", "b"), ["a", "b"], "left_semi", broadcast_rows)
                frequent = frequent.select("piece", "next", "a", "b")
                now = relations.store(frequent if in_place else relations.dealt(frequent), "next")
                if size == 2:  # a frequent phrase has frequent pairs only: from here on, words that end one (numbered by ``next``, one higher)
                    single = now.select("piece", F.col("next").alias("place"), F.col("a").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("w"))
                    now = now.withColumn("next", F.col("next") + 1)
        return stored(reduce(DataFrame.union, levels), "phrases")


def scored(phrases: DataFrame) -> DataFrame:
    """words, a, l, r, score of every phrase of two words or more, by its lowest-scoring cut."""
    size = F.size("words")
    cuts = (phrases.where(size > 1).select("words", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
            .select("words", "a", "k", F.slice("words", 1, F.col("k")).alias("first"), F.slice("words", F.col("k") + 1, size).alias("rest")))
    left = phrases.select(F.col("words").alias("first"), F.col("f").alias("l"))
    right = phrases.select(F.col("words").alias("rest"), F.col("f").alias("r"))
    score = F.expr("cast(a as decimal(20,0)) * 2000000 div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    best = cuts.join(left, "first").join(right, "rest").select("words", "a", F.struct(score.alias("score"), "k", "l", "r").alias("cut"))
    return best.groupBy("words").agg(F.min("a").alias("a"), F.min("cut").alias("cut")).select("words", "a", "cut.l", "cut.r", "cut.score")


def standing(phrases: DataFrame, share: int) -> DataFrame:
    """words of the phrases of two words or more that no longer phrase covers: none that holds them
    has ``share`` percent of their count or more."""
    size = F.size("words")
    part = lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("words", i, n))
    # Parts of 2 words to one less than the phrase: at most 5 of a phrase of 4 words.
    parts = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), part))
    inside = phrases.where(size > 2).select(F.explode(parts).alias("words"), "f").groupBy("words").agg(F.max("f").alias("most"))
    own = phrases.where(size > 1)
    return own.join(inside, "words", "left").where(F.col("most").isNull() | (F.lit(100) * F.col("most") < F.lit(share) * F.col("f"))).select("words")


def collocations(docs: DataFrame, least: int = 30, most: int = 4, share: int = 80, first: int = 2000, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: of each language the ``first`` phrases by score."""
    if not 2 <= most <= 4:
        raise ValueError("phrases have 2 to 4 words")
    texts = docs.select(language().alias("lang"), text_or_empty().alias("t"))
    counts = stored(word_counts(texts), "word-counts")
    n = counts.groupBy("lang").agg(F.sum("f").alias("n"))
    words = stored(numbered(counts, least), "frequent-words")
    phrases = mined(texts, words, least, most, broadcast_rows)
    found = scored(phrases).join(standing(phrases, share), "words", "left_semi")
    names = words.select(F.col("w").cast("int").alias("w"), "lang", "word")
    spelled = (found.select("*", F.posexplode("words").alias("at", "w")).join(names, "w")
               .groupBy("words", "a", "l", "r", "score").agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("s"))
               .select("lang", "a", "l", "r", "score", F.array_join(F.transform("s", lambda x: x["word"]), " ").alias("phrase")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = spelled.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= first)
    return stored(ranked.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"), "collocations")


#: The same in DuckDB SQL, phrases as lists, for the default parameters.
ORACLE_SQL = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), cut AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM texts
), pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM cut
), placed AS (
  SELECT lang, piece, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM pieces
), rows_ AS (
  SELECT lang, word AS w1, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3, lead(word, 3) OVER o AS w4
  FROM placed WINDOW o AS (PARTITION BY piece ORDER BY i)
), grams AS (
  SELECT lang, [w1] AS p, 1 AS k, count(*) AS f FROM rows_ GROUP BY lang, w1
  UNION ALL SELECT lang, [w1, w2], 2, count(*) FROM rows_ WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3], 3, count(*) FROM rows_ WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3 HAVING count(*) >= 30
  UNION ALL SELECT lang, [w1, w2, w3, w4], 4, count(*) FROM rows_ WHERE w4 IS NOT NULL GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 30
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE k = 1 GROUP BY lang
), cands AS (
  SELECT lang, p, k AS size, f AS a FROM grams WHERE k > 1
), cuts AS (
  SELECT c.lang, c.p, c.a, j.head, x.f AS l, y.f AS r,
         ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f::HUGEINT))::BIGINT AS score
  FROM cands c
  JOIN (SELECT unnest([1, 2, 3]) AS head) j ON j.head < c.size
  JOIN grams x ON x.lang = c.lang AND x.p = c.p[1:j.head]
  JOIN grams y ON y.lang = c.lang AND y.p = c.p[j.head + 1:c.size]
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, head) = 1
), parts AS (
  SELECT lang, p[i:i + m - 1] AS p, max(a) AS most
  FROM cands, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
  WHERE m < size AND i + m - 1 <= size
  GROUP BY ALL
), standing AS (
  SELECT b.lang, array_to_string(b.p, ' ') AS phrase, b.a, b.l, b.r, b.score
  FROM best b LEFT JOIN parts o ON o.lang = b.lang AND o.p = b.p
  WHERE o.most IS NULL OR 100 * o.most < 80 * b.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM standing
)
SELECT s.lang, s.rank, s.phrase, s.a, s.l, s.r, t.n, s.score
FROM ranked s JOIN totals t ON t.lang = s.lang
WHERE s.rank <= 2000
"""

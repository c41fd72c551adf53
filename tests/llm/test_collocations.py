"""Phrase collocations against counting every phrase in plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import collocations
from ledgerlens.llm.common import stored

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def brute(rows, least, most=4, share=80, first=2000):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        t = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", t):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, most + 1):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in found.items():
            holds = lambda q: len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))  # noqa: B023, E731
            if any(holds(q) and 100 * b >= share * a for q, b in found.items()):
                continue
            score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows_.append((" ".join(p), a, left, right, score))
        rows_.sort(key=lambda r: (-r[4], -r[1], r[0].encode()))
        out += [(lang, k, p, a, left, right, n[lang], s) for k, (p, a, left, right, s) in enumerate(rows_[:first], 1)]
    return Counter(out)


def corpus():
    rnd = random.Random(5)
    words = [f"w{k}" for k in range(12)] + ["Éé", "don't", "ΑΣ", "NEW", "new", "\x0b", "x y", " "]
    fixed = ["New York city hall", "as well as", "ta ta ta ta ta"]
    rows = []
    for k in range(160):
        text = ""
        for _ in range(rnd.randint(0, 25)):
            text += rnd.choice(fixed) if rnd.random() < 0.3 else rnd.choice(words)
            text += rnd.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "?! ", "\r\n"])
        rows.append((rnd.choice(["en", "de", None, "und", ""]), text))
    rows += [("en", None), ("en", ""), (None, " \t \n ."), ("fr", "only two"), ("de", "la la land " * 4000), ("de", "x" * 50_000), rows[3], rows[3], rows[4]]
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    extra = [(7 if k % 9 else None, lang, t, "clash", k, "p") for k, (lang, t) in enumerate(rows)]  # repeated and missing ids
    return stored(spark.createDataFrame(extra, "doc_id long, lang string, text string, word string, piece long, t string").repartition(4), "collocation-docs")


@pytest.mark.parametrize(("least", "first", "broadcast_rows"), [(30, 2000, 500_000), (4, 7, 500_000), (4, 2000, 0)])
def test_collocations(docs, rows, least, first, broadcast_rows):
    out = collocations.collocations(docs, least=least, first=first, broadcast_rows=broadcast_rows)
    assert out.columns == COLUMNS and all(kind == "bigint" for c, kind in out.dtypes if c not in ("lang", "phrase"))
    want = brute(rows, least, first=first)
    assert Counter(map(tuple, out.collect())) == want and len(want) > 15


def test_shorter_phrases_and_empty_table(docs, rows):
    assert Counter(map(tuple, collocations.collocations(docs, least=5, most=3, share=50).collect())) == brute(rows, 5, most=3, share=50)
    assert collocations.collocations(docs.where("false")).count() == 0
    assert collocations.collocations(docs.withColumn("text", F.lit(None).cast("string"))).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 10**13
    phrases = spark.createDataFrame([([1, 2], big + 7), ([1], 3 * big), ([2], 2 * big + 1)], "words array<int>, f long")
    (row,) = collocations.scored(phrases).collect()
    assert (row.a, row.l, row.r, row.score) == (big + 7, 3 * big, 2 * big + 1, 2_000_000 * (big + 7) // (5 * big + 1))


def test_joins_of_relations_need_no_shuffle(docs, spark):
    """The relations meet by bucket, in stored order: a sort-merge join without exchange; at most one side is sorted anew."""
    texts = docs.select(collocations.language().alias("lang"), F.col("text").alias("t")).where("t is not null")
    words = stored(collocations.numbered(collocations.word_counts(texts), 2), "test-words")
    with collocations.Relations(spark) as relations:
        single = collocations.occurrences(texts, words, relations, 1000)
        now = relations.store(single.select("piece", (F.col("place") + 1).alias("next"), F.col("w").cast("long").alias("a"), F.lit(0).cast("long").alias("b")), "next")
        joined = collocations.longer(now, single, 2)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Sort [" not in plan
        assert joined.count() > 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("occurrences_")]


def test_splitting_runs_in_generated_code(docs, spark):
    """The steps that see every word: a Generate outside generated code costs more than the split itself."""
    texts = docs.select(F.col("doc_id").alias("piece"), collocations.language().alias("lang"), F.col("text").alias("t"))
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans do not show what is generated
    try:
        for rows in (collocations.placed(texts), collocations.word_counts(texts)):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            generate = [line for line in plan.splitlines() if "Generate" in line]
            assert generate and all("*(" in line for line in generate) and "lambda" not in plan
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_pieces_and_case(spark):
    """Piece ends without spaces, in runs and at both ends; letters outside A-Z that ``lower`` would map, some to ASCII."""
    rows = [("en", t) for t in ("A b.C  d", ".;a B,,c\td!", "a\nb c", "\u212aa \u0130b", "ka \u0131b \u212aA", "KA ib", "\x0bA b\x0c\x0d c D", "\u00c4A B", "\u00e4a b", "x", ". , .", " ")] * 2
    docs = spark.createDataFrame(rows, "lang string, text string")
    want = brute(rows, 2)
    assert Counter(map(tuple, collocations.collocations(docs, least=2).collect())) == want
    assert {r[2] for r in want} >= {"a b", "c d", "\u212aa \u0130b", "ka ib", "\u00c4a b", "\u00e4a b"}

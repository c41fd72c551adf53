"""Periodic runs against a plain look at every lag and place."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import periodic, queries


def brute_runs(w, shortest=6, exponent=4):
    out, n = [], len(w)
    for q in range(1, n // exponent + 1):
        x = 0
        while x + q < n:
            y = x
            while y + q < n and w[y] == w[y + q]:
                y += 1
            length = y - x + q
            if y > x and length >= max(shortest, exponent * q) and all(w[x:x + length - p] != w[x + p:x + length] for p in range(1, q)):
                out.append((x, length, q))
            x = max(y, x + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def periodic_words(rnd, most=120):
    words, letters = [], rnd.choice([1, 2, 3, 5, 50])
    while len(words) < rnd.randint(0, most):
        unit = [f"w{rnd.randrange(letters)}" for _ in range(rnd.randint(1, 12))]
        words += unit * rnd.randint(1, 7) + unit[:rnd.randint(0, len(unit))]
    return words


def test_runs_against_every_lag():
    rnd = random.Random(1)
    docs = [periodic_words(rnd) for _ in range(800)] + [[], ["a"] * 300, ["a"] * 5, ["a"] * 6, ["a", "b"] * 4]
    found = periodic.documents_runs([[w.encode() for w in d] for d in docs])
    assert found == [brute_runs(d) for d in docs] and sum(map(len, found)) > 1000


def test_runs_of_other_bounds():
    rnd = random.Random(2)
    docs = [periodic_words(rnd, 60) for _ in range(200)]
    for shortest, exponent in ((2, 3), (9, 3), (20, 5)):
        assert periodic.documents_runs([[w.encode() for w in d] for d in docs], shortest, exponent) == [brute_runs(d, shortest, exponent) for d in docs]


def test_seed_length_is_the_least_overlap():
    assert [periodic.seed_length(lag, 6, 4) for lag in (1, 2, 4, 8)] == [5, 6, 12, 24]


def test_next_occurrence():
    values = np.array([3, 1, 3, 3, 2, 1], np.uint64) << np.uint64(40)
    at = periodic.repeated(values)
    assert at.tolist() == [0, 1, 2, 3, 5]
    assert [x.tolist() for x in periodic.next_occurrence(values, at)] == [[0, 1, 2, 3, 5], [2, 4, 1, 0, 0]]


@pytest.mark.parametrize("most", [periodic.BYTES_AT_ONCE, 200])
def test_query_columns(spark, monkeypatch, most):
    rnd = random.Random(3)
    rows = [(k, rnd.choice([" ", "\t", " \x0b\n"]).join(periodic_words(rnd))) for k in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "x" * 100_000), (1004, "la " * 20_000), (1005, "É " * 9), (5, rows[5][1]), (5, "other " * 7), (None, "a b " * 9), (None, None)]
    frame = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, runs_sha256 string, period long").repartition(3)
    want = Counter(brute_row(i, t) for i, t in rows if i != 1004)
    got = periodic.collapsed_runs(frame)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    found = got.collect()
    assert Counter(tuple(r) for r in found if r.doc_id != 1004) == want and len(found) == len(rows)
    assert [(r.n_runs, r.start, r.length, r.period) for r in found if r.doc_id == 1004] == [(1, 0, 20_000, 1)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i) > 20
    assert periodic.collapsed_runs(frame.where("false")).count() == 0
    own = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.periodic_runs(frame.where("doc_id < 50 and doc_id <> 5")).collect()}
    assert own == {i: brute_runs(t.split()) for i, t in rows[:50] if i != 5}


def test_registered_query(spark):
    out = queries.QUERIES["op13_periodic_runs"](spark, "/root/testdata/sf0.001")
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    assert Counter(map(tuple, out.collect())) == Counter(brute_row(*r) for r in docs)

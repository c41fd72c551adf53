"""HyperMinHash near-duplicates against comparing all pairs of full sets."""

from __future__ import annotations

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlens.llm import hyperminhash as hm
from ledgerlens.llm.common import stored


def shingle_set(text, size=5):
    w = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def brute(rows, percent=85, size=5):
    sets = [shingle_set(t, size) for _, t in rows]
    root = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]) and root[i] != root[j]:
            a, b = root[i], root[j]
            root = [a if x == b else x for x in root]
    first = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            first[root[k]] = min(first.get(root[k], i), i)
    out = Counter()
    for k, (i, _) in enumerate(rows):
        c = first.get(root[k]) if sets[k] else i
        out[(i, len(sets[k]), c, c == i)] += 1
    return out


def near_copies():
    rnd = random.Random(7)
    word = lambda: f"w{rnd.randrange(4000)}"
    texts = []
    for n, copies in ((7, 10), (11, 10), (40, 12), (120, 40), (400, 12), (120, 40)):
        base = [word() for _ in range(n)]
        for _ in range(copies):
            own = [*base]
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3])):
                own[rnd.randrange(n)] = word()
            own += [word() for _ in range(rnd.choice([0, 0, 1, 2, n // 12, n // 6]))]
            texts.append(" ".join(own))
    texts += [" ".join(word() for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "one two"), (1004, "ONE  two"), (1005, "one two three"), (1006, "é É"), (1007, "É É"),
             (1008, "la " * 30_000), (1009, "La la la la la la"), (1010, "x" * 200_000)]
    return rows + [rows[0], rows[0], (0, texts[50]), (None, texts[20]), (None, "alone in its group without id"), (None, None), (2000, texts[60].upper())]


@pytest.fixture(scope="module")
def rows():
    return near_copies()


@pytest.fixture(scope="module")
def docs(spark, rows):
    frame = spark.createDataFrame([(i, t, "n", 3, "k") for i, t in rows], "doc_id long, text string, name string, n int, key string")
    return stored(frame.repartition(4), "near-copies")


@pytest.mark.parametrize(("percent", "block"), [(85, hm.BLOCK), (85, 5), (70, hm.BLOCK)])
def test_groups_against_all_pairs(docs, rows, percent, block):
    out = hm.groups(docs, percent=percent, block=block)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(rows, percent)
    assert Counter(map(tuple, out.collect())) == want
    assert 20 < sum(not kept for *_, kept in want.elements()) < len(rows) - 80


def test_empty_table(docs):
    assert hm.groups(docs.where("false")).count() == 0


def naive_register(hashes, bucket):
    v = [h & (1 << hm.REST) - 1 for h in hashes if h >> hm.REST == bucket]
    bits = format(min(v) >> hm.REST - 53, "053b")
    zeros = len(bits) - len(bits.lstrip("0"))
    return zeros, int((bits[zeros + 1:] + "0" * hm.MANTISSA)[:hm.MANTISSA], 2)


def test_registers_hold_zeros_and_mantissa():
    rnd = random.Random(1)
    hashes = sorted({rnd.getrandbits(64) >> rnd.choice([0, 0, 3, 9]) for _ in range(3000)})
    regs = hm.registers(np.array(hashes, np.uint64))
    buckets = {h >> hm.REST for h in hashes}
    for b in buckets:
        assert (int(regs[b]) >> hm.MANTISSA, int(regs[b]) & (1 << hm.MANTISSA) - 1) == naive_register(hashes, b)
    few = hm.registers(np.array(hashes[-3:], np.uint64))
    assert set(few.tolist()) == {int(few[h >> hm.REST]) for h in hashes[-3:]}  # the others borrow


@pytest.mark.parametrize("size", [6, 13, 40, 200, 2000])
def test_pairs_at_the_bound_are_candidates(size):
    """Pairs that only just reach 0.85 share a band and are not cut off by their estimate."""
    rnd = np.random.default_rng(size)
    draw = lambda n: rnd.integers(0, 2**64, n, dtype=np.uint64)
    estimates = []
    for _ in range(300 if size < 1000 else 60):
        common, extra = draw(size), int(size / 0.85 - size + 1e-9)
        own = extra // 2
        a, b = np.unique(np.concatenate((common, draw(own)))), np.unique(np.concatenate((common, draw(extra - own))))
        ra, rb = hm.registers(a), hm.registers(b)
        keys = hm.bands(np.stack((ra, rb)))
        assert (keys[0] == keys[1]).any()
        estimates.append(hm.estimate(np.array([(ra == rb).sum()]), np.array([len(a)]), np.array([len(b)]))[0])
    assert min(estimates) >= hm.lowest(85)
    assert abs(np.mean(estimates) - size / (size + extra)) < 0.02


def test_chance_agreement_is_corrected():
    rnd = np.random.default_rng(3)
    draw = lambda n: np.unique(rnd.integers(0, 2**64, n, dtype=np.uint64))
    for n, m in ((2000, 2000), (4000, 1000)):
        equal = [(hm.registers(draw(n)) == hm.registers(draw(m))).mean() for _ in range(1500)]
        assert np.mean(equal) == pytest.approx(float(hm.chance(np.array(n), np.array(m))), rel=0.35)


def test_forest_takes_the_best_edges():
    pairs, score = np.array([[0, 1], [1, 2], [0, 2], [3, 4]]), np.array([0.9, 0.8, 0.95, 0.7])
    assert hm.forest(pairs, score, ["a", "b", "c", "d", "e"]) == [2, 0, 3]
    assert hm.forest(pairs, score, ["a", "a", "c", "c", "e"]) == [2, 3]

"""Training-data operators against brute force on small frames with awkward rows:
NULLs in any column, empty and very long texts, ties, repeated rows, clashing extra columns."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlens.llm import (bitplane, components, decontaminate, licenses, mixing, ordinal, queries, rankmerge, repeats, rlz, simhash,
                            suffixes, syncmers)

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h long, block long, fp long, size string, _id string"
WORDS = [f"w{k}" for k in range(30)] + ["Éé", "don't", "ΑΣ", "ﬁ", "x1½", "<|endoftext|>"]


def corpus():
    rnd = random.Random(3)
    base = [" ".join(rnd.choice(WORDS) for _ in range(160)) for _ in range(3)]
    texts = []
    for k in range(60):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 2)):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        lead = " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 25)))
        texts.append(lead + " " + " ".join(words[rnd.randint(0, 60):rnd.randint(90, 160)]) + ("\n" * (k % 3)))
    texts += [base[0], base[0], "", None, "   \t\n", "a" * 5000, "ab " * 3000, "é" * 900, "Released under the MIT License.", "CC BY-NC 4.0 cc by nc"]
    rows = [(k, t, None, None if k % 7 == 0 else f"s{k % 4}", None, k, 1, 2, "x", "y") for k, t in enumerate(texts)]
    return rows + [rows[5], (None, base[1], None, None, None, None, None, None, None, None), (None, None, None, "s1", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(4).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def key(x):
    return tuple((v is None, v) for v in x)


def lower(t):
    return re.sub("[A-Z]", lambda m: m.group().lower(), t or "")


def test_bitplane_round_trip(docs, rows, none):
    library = Tokenizer.from_file(VOCABULARY)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for planes in bitplane.PLANES:
        got = sorted(bitplane.encode_corpus(docs, VOCABULARY, planes=planes).collect(), key=lambda r: r.start)
        assert [r.doc_id for r in got] == [r[0] for r in ordered]
        at, want, have = 0, Counter(), Counter()
        for r in got:
            assert r.start == at
            at += r.n_tokens
            have[(r.doc_id, r.n_tokens, r.ids_crc32)] += 1
        for r in ordered:
            ids = np.array(library.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
            want[(r[0], len(ids), zlib.crc32(ids.tobytes()))] += 1
        assert have == want
    assert bitplane.encode_corpus(none, VOCABULARY).count() == 0


def test_planes_invert():
    ids = np.array([0, 1, 255, 256, 65535, 65536, 2**32 - 1], np.uint32)
    for kind in bitplane.PLANES:
        assert (bitplane.from_planes(bitplane.to_planes(ids, kind), len(ids), kind) == ids).all()


def test_token_counts(docs, rows, none):
    library = Tokenizer.from_file(VOCABULARY)
    want = Counter((r[0], len((r[1] or "").encode()), n := len(library.encode(r[1] or "", add_special_tokens=False).ids), n > 50) for r in rows)
    assert Counter(map(tuple, rankmerge.token_counts(docs, VOCABULARY, limit=50).collect())) == want
    assert rankmerge.token_counts(none, VOCABULARY).count() == 0


def naive_fingerprint(t):
    w = re.findall("[^\x20\x09-\x0d]+", lower(t))
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum((2 * sum(x >> b & 1 for x in h) > len(h)) << b for b in range(64)) if h else 0


@pytest.mark.parametrize("bucket", [64, 1])
def test_simhash_groups(docs, rows, none, bucket):
    fps = [naive_fingerprint(r[1]) for r in rows]
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                a, b = root[i], root[j]
                root = [b if x == a else x for x in root]
    first = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            first[root[k]] = min(first.get(root[k], r[0]), r[0])
    want = Counter((r[0], f"{f:016x}", first.get(root[k])) for k, (r, f) in enumerate(zip(rows, fps)))
    g = simhash.groups(docs, bucket=bucket).select("doc_id", simhash.hexed(F.col("fp")), "component_id")
    assert Counter(map(tuple, g.collect())) == want
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns and Counter(r.doc_id for r in kept.collect()) == Counter(first.get(x) for x in set(root))
    assert simhash.groups(none).count() == 0


def test_simhash_links_any_two_bits(spark):
    rnd = random.Random(1)
    base = [rnd.getrandbits(64) for _ in range(20)]
    fps = {x for b in base for x in (b, b ^ 1 << rnd.randrange(64), b ^ 1 << rnd.randrange(64) ^ 1 << rnd.randrange(64))}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    for bucket in (64, 1):
        got = {tuple(r) for r in simhash.links(frame, bucket=bucket).collect()}
        assert {(min(p), max(p)) for p in got} == want


def test_components_long_path(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components.components(edges).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100}


def test_license_scan(docs, rows, none):
    want = Counter()
    for r in rows:
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(r[1]))
        at, labels = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            here = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            at += here
            labels |= {label} if here else set()
        base = ",".join(sorted(labels))
        for k in range(0, len(w), licenses.STEP):
            block = set(w[k:k + 2 * licenses.STEP])
            labels |= {n for n, t in licenses.TEMPLATES.items() if len(block & set(t.split())) >= 0.8 * len(set(t.split())) - 1e-9}
        want[(r[0], len(w), len(at), min(at, default=None), max(at, default=None), base, ",".join(sorted(labels)))] += 1
    got = licenses.scan(docs).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert all(0 <= r.score <= 1 and (r.score > 0) == bool(r.labels) for r in got) and any(r.labels for r in got)
    assert licenses.scan(none).count() == 0


def test_syncmers(docs, rows, none):
    got = syncmers.fingerprints(docs).collect()
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    by_id = {r[0]: r[1] or "" for r in ordered}
    ids = [r[0] for r in ordered if r[0] is not None]
    alone = [i for i, n in Counter(ids).items() if n == 1]
    after = {a: b for a, b in zip(ids, ids[1:])}
    seen = 0
    for r in got:
        if r.doc_id in alone and r.doc_id in after:
            t, n = by_id[r.doc_id], len(by_id[r.doc_id]) // 2
            e = t[:len(t) - n] + by_id[after[r.doc_id]][:n]
            assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(e.encode()).hexdigest())
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
            assert e != t or r.fingerprint == r.edited_fingerprint
            seen += 1
    assert seen > 50 and len(got) == len(rows)
    same = [r.fingerprint for r in got if r.doc_id in (60, 61)]
    assert same[0] == same[1]
    assert syncmers.fingerprints(none).count() == 0


def brute_compared(a, b):
    """likeness and aligned of two anchor lists (hash, at) by brute force."""
    first = [{h: min(at for x, at in c if x == h) for h, _ in c} for c in (a, b)]
    common = first[0].keys() & first[1].keys()
    both = first[0].keys() | first[1].keys()
    return (len(common) / len(both) if both else 1.0, max(Counter(first[1][h] - first[0][h] for h in common).values(), default=0))


def test_syncmers_compare_all_anchors(spark):
    rnd = random.Random(11)
    make = lambda n: [f"v{rnd.randrange(10**6)}" for _ in range(n)]
    shared, long, line = make(60), make(3000), make(12)
    pairs = [([*make(5000), *shared], [*make(700), *shared, *make(4300)]), (long, ["one", *long]), (long, long), (line * 40, ["x", *line * 35]),
             (["ab"] * 3000, ["ab"] * 2000), ([], []), ([], shared), (make(3), make(3)), (shared, make(60))]
    rows = [(k, " ".join(a), " ".join(b)) for k, (a, b) in enumerate(pairs)]
    f = spark.createDataFrame(rows, "k int, a string, b string").select("k", *(syncmers.anchors(F.col(c)).alias(c) for c in "ab"))
    got = f.select("*", syncmers.compared(F.col("a"), F.col("b")).alias("r")).collect()
    for r in got:
        assert tuple(r.r) == brute_compared([tuple(x) for x in r.a], [tuple(x) for x in r.b])
    by = {r.k: r for r in got}
    assert by[0].r.likeness > 0 and by[0].r.aligned >= 10 and by[1].r.likeness > 0.99 and by[1].r.aligned >= len(by[1].a) - 1


def test_syncmer_fingerprint_holds_every_anchor(spark):
    rnd = random.Random(12)
    texts = [" ".join(f"v{rnd.randrange(10**6)}" for _ in range(n)) for n in (1500, 900, 0, 2)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: [tuple(x) for x in r.a] for r in frame.select("doc_id", syncmers.anchors(F.col("text")).alias("a")).collect()}
    for r in syncmers.fingerprints(frame).collect():
        want = [f"{h & (2**64 - 1):016x}@{at}" for h, at in found[r.doc_id]]
        assert r.fingerprint == ",".join(want) and r.sketch == ",".join(f"{h & (2**64 - 1):016x}@{at}" for h, at in sorted(found[r.doc_id])[:syncmers.SIZE])
        assert (r.near_next, r.aligned_next) == brute_compared(found[r.doc_id], found[(r.doc_id + 1) % 4])


def test_closed_syncmers_depend_on_their_words_only(spark):
    words = [f"t{k}" for k in range(60)]
    f = spark.createDataFrame([(" ".join(words),), (" ".join(["other", "lead", *words]),)], "t string")
    a, b = (r.a for r in f.select(syncmers.anchors(F.col("t")).alias("a")).collect())
    assert {(x.hash, x.at + 2) for x in a} <= {(x.hash, x.at) for x in b} and a


def test_mixing(spark, rows, docs, none):
    m = mixing.mix(queries.sized(docs))
    got, again = m.collect(), m.collect()
    assert sorted(map(key, (r[:3] for r in map(lambda r: (r.doc_id, r.size, r.taken), got)))) == sorted(map(key, ((r.doc_id, r.size, r.taken) for r in again)))
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(re.findall("[^\x20\x09-\x0d]+", r[1] or ""))
    order = sorted(sizes, key=mixing.source_key)
    target = mixing.water_fill({s: sizes[s] for s in order}, {s: k % 3 + 1 for k, s in enumerate(order)})
    assert sum(target.values()) == pytest.approx(sum(sizes.values())) and all(t <= 3 * sizes[s] + 1e-6 for s, t in target.items())
    taken = Counter()
    for r in got:
        assert r.targets[0] == pytest.approx(target[r.members[0]]) and 0 <= r.taken <= 3 * r.size
        taken[r.members[0]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 3000 for s in order) and len(got) == len(rows)
    assert mixing.mix(queries.sized(none)).count() == 0


def test_flow_uses_shared_documents_and_repeats_last():
    give = mixing.min_cost_flow([(frozenset("a"), 10), (frozenset("ab"), 10), (frozenset("b"), 10)], {"a": 20, "b": 10})
    assert give[0] == {"a": 10} and give[1] == {"a": 10, "b": 0} and give[2] == {"b": 10}


def removed(units, n):
    c = Counter(u[i:i + n] for u in units for i in range(len(u) - n + 1))
    out = []
    for u in units:
        m = np.zeros(len(u), bool)
        for i in range(len(u) - n + 1):
            if c[u[i:i + n]] > 1:
                m[i:i + n] = True
        out.append(m)
    return out


@pytest.mark.parametrize(("length", "largest"), [(400, 100_000), (40, 100_000), (40, 3)])
def test_suffix_dedup(docs, rows, none, length, largest):
    texts = [(r[1] or "").encode() for r in rows]
    want = Counter((r[0], len(t), int(m.sum()), len(suffixes.spans(m)), hashlib.sha256(np.frombuffer(t, np.uint8)[~m].tobytes()).hexdigest())
                   for r, t, m in zip(rows, texts, removed(texts, length)))
    assert Counter(map(tuple, suffixes.removed_bytes(docs, length, largest).collect())) == want
    assert suffixes.removed_bytes(none, length).count() == 0


@pytest.mark.parametrize("length", [35, 5])
def test_rlz_dedup(docs, rows, none, length):
    words = [tuple((r[1] or "").encode().split()) for r in rows]
    want = Counter((r[0], len(w), int(m.sum()), hashlib.sha256(b" ".join(x for x, g in zip(w, m) if not g)).hexdigest())
                   for r, w, m in zip(rows, words, removed(words, length)))
    assert Counter(map(tuple, rlz.removed_words(docs, length, min(12, length)).collect())) == want
    assert rlz.removed_words(none, length).count() == 0


def test_multikey_quicksort_and_minimum():
    rnd = random.Random(2)
    texts = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    order = suffixes.multikey_quicksort(suffixes.as_keys(texts)[0])
    assert [texts[k] for k in order] == sorted(texts)
    x = np.array([rnd.randrange(50) for _ in range(200)], np.uint64)
    assert repeats.sliding_min(x, 7).tolist() == [x[i:i + 7].min() for i in range(194)]


def test_rlz_greedy_takes_the_longest_copy_and_looks_up_the_factor_end():
    assert rlz.greedy([(0, 2, 1, 4), (1, 3, 2, 0), (2, 1, 2, 1), (5, 1, 7, 3)]) == [(0, 1, 1, 4), (2, 2, 2, 1), (5, 5, 7, 3)]
    a, b = (b"".join(x.to_bytes(8) for x in xs) for xs in ([5, 6, 7], [5, 6, 8, 9]))
    assert rlz.shared(a, b) == 2 and rlz.shared(a, a[:8]) == 1 and rlz.shared(a, b[8:]) == 0 and rlz.shared(a, a) == 3


@pytest.mark.parametrize("partitions", [1, 7])
def test_rlz_factors_equal_a_naive_greedy_parse(spark, partitions):
    """Over every block that is parsed: same factors as trying all places of all other blocks; the named copy is one."""
    rnd = random.Random(21)
    base = [[rnd.randrange(1, 1 << 64) for _ in range(12)] for _ in range(6)]
    blocks, parsed = [], []
    for _ in range(150):
        b = rnd.choice(base)
        a = rnd.randint(0, 6)
        row = b[a:rnd.randint(a + 1, 12)]
        if rnd.random() < 0.5:
            row[rnd.randrange(len(row))] = rnd.randrange(1, 1 << 64)
        blocks.append(row)
        parsed.append(rnd.random() < 0.9)

    def best(n, i):
        k = 0
        for m, other in enumerate(blocks):
            for j in range(len(other)) if m != n else ():
                same = 0
                while same < min(len(blocks[n]) - i, len(other) - j) and blocks[n][i + same] == other[j + same]:
                    same += 1
                k = max(k, same)
        return k

    want = set()
    for n, row in enumerate(blocks):
        i = 0
        while i < len(row) and parsed[n]:
            k = best(n, i)
            if k:
                want.add((n, i, i + k - 1))
            i += max(k, 1)
    frame = spark.createDataFrame([(n, p, bytearray(b"".join(x.to_bytes(8) for x in row))) for n, (p, row) in enumerate(zip(parsed, blocks, strict=True))],
                                  "block long, parsed boolean, names binary")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = rlz.factors(frame).collect()
        assert rlz.factors(frame.where("false")).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)
    assert {(r.block, r.a, r.b) for r in got} == want and len(got) == len(want) > 150
    for r in got:
        n = r.b - r.a + 1
        assert r.reference != r.block and blocks[r.block][r.a:r.b + 1] == blocks[r.reference][r.place:r.place + n]


def test_decontamination(spark, docs, none):
    rnd = random.Random(8)
    items = [(k, " ".join(f"q{rnd.randrange(400)}" for _ in range(n))) for k, n in enumerate([20, 40, 14, 5, 30])] + [(9, None), (10, ""), (None, "one two three")]
    passage = items[1][1].split()
    changed = [*passage]
    for k in (7, 16, 25, 34):
        changed[k] = "zzz"
    noise = " ".join(f"n{k}" for k in range(50))
    texts = [(1, f"{noise} {items[0][1].upper()}, {noise}"), (2, f"{noise} {' '.join(changed)}"), (3, noise), (4, " ".join(passage[:10])),
             (5, f"x {items[3][1]} y"), (6, None), (None, items[2][1]), (7, ""), (7, items[4][1]), (7, items[4][1])]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.matched, r.score) for r in decontaminate.overlaps(frame, bench).collect()}
    assert got == {(1, 0): (20, 20), (2, 1): (36, 28), (5, 3): (5, 5), (None, 2): (14, 14), (7, 4): (30, 30)}
    assert sorted(r.doc_id for r in decontaminate.clean(frame, bench).collect()) == [3, 4, 6]
    assert decontaminate.overlaps(none, bench).count() == 0 and decontaminate.overlaps(frame, none.withColumn("item_id", F.lit(1).cast("long"))).count() == 0


def leaks(doc, item, least=13):
    """The most equal words in a run of aligned words (over all alignments) that is short enough to count, by brute force."""
    need = max(min(least, -(-7 * len(item) // 10)), min(8, len(item)))
    span = need * 10 // 7
    best = 0
    for shift in range(1 - len(item), len(doc)):
        same = [0 <= i + shift < len(doc) and doc[i + shift] == w for i, w in enumerate(item)]
        best = max(best, *(sum(same[i:i + span]) for i in range(len(item))))
    return best >= need


def test_decontamination_finds_substituted_words_in_short_items(spark):
    rnd = random.Random(9)
    items = [[f"q{n}x{k}" for k in range(n)] for n in (5, 8, 9, 12, 15, 18, 40)]
    noise = [f"n{k}" for k in range(30)]
    texts = []
    for item in items:
        n = len(item)
        places = [*itertools.combinations(range(n), 1), *itertools.combinations(range(n), 2)]
        for at in places if n < 40 else rnd.sample(places, 20):
            texts.append([*noise[:5], *("sub" if k in at else w for k, w in enumerate(item)), *noise[5:]])
        for k in (4, 6, 8):
            at = rnd.sample(range(n), min(k, n))
            texts.append([*noise, *("sub" if k in at else w for k, w in enumerate(item))])
    for size, gone in ((12, 0), (13, 0), (14, 1), (15, 2), (20, 8)):
        texts.append([*noise, *("sub" if k in range(4, 4 + gone) else w for k, w in enumerate(items[-1][7:7 + size]))])
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(len(i), " ".join(i)) for i in items], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(frame, bench).collect()}
    want = {(k, len(i)) for k, t in enumerate(texts) for i in items if leaks(t, i)}
    few = {(k, n) for k, n in want if texts[k].count("sub") <= 2}  # more substitutions: as the seeds reach
    assert few <= got <= want and len(few) > 400
    assert not {(k, n) for k, n in got if texts[k].count("sub") and n < 9}


@pytest.mark.parametrize("n", range(5, 19))
def test_a_seed_hits_every_placement_that_counts(n):
    """All places of the most substitutions that still count, in items of up to 18 words; a longer item counts by a run of 18."""
    need = max(min(13, -(-7 * n // 10)), min(8, n))
    masks = [m for m in decontaminate.MASKS if m[-1] < n] + ([tuple(range(n))] if n < 7 else [])
    shapes = [sum(1 << k + p for p in m) for m in masks for k in range(n - m[-1])]
    places = [sum(1 << k for k in c) for c in itertools.combinations(range(n), n - need)]
    assert places and all(any(not gone & shape for shape in shapes) for gone in places)
    assert need * 10 // 7 >= n or n < 9


def test_decontamination_misses_no_alignment_that_counts(spark):
    """Items of 5 to 30 words with as many substitutions as count, and one more, among words that repeat."""
    rnd = random.Random(31)
    items = [[f"q{rnd.randrange(60)}" for _ in range(n)] for n in range(5, 31)]
    texts = []
    for item in items:
        for _ in range(12):
            start = rnd.randrange(max(1, len(item) - 17))
            part = item[start:start + 18]
            need = max(min(13, -(-7 * len(item) // 10)), min(8, len(item)))
            at = rnd.sample(range(len(part)), max(0, min(len(part) - need + rnd.randint(-1, 1), len(part))))
            texts.append([*(f"q{rnd.randrange(60)}" for _ in range(6)), *("sub" if k in at else w for k, w in enumerate(part)), *(f"n{k}" for k in range(rnd.randint(0, 9)))])
    frame = spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    bench = spark.createDataFrame([(len(i), " ".join(i)) for i in items], "item_id long, text string")
    want = {(k, len(i)) for k, t in enumerate(texts) for i in items if leaks(t, i)}
    assert {(r.doc_id, r.item_id) for r in decontaminate.overlaps(frame, bench).collect()} == want and len(want) > 150


def test_clean_keeps_the_clean_rows_without_id(spark):
    passage = " ".join(f"q{k}" for k in range(20))
    texts = [(None, f"a b {passage}"), (None, "clean one"), (None, None), (None, "clean one"), (None, passage.upper()), (3, "clean two"), (4, passage), (5, "clean three")]
    frame = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, h string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    want = Counter(t for t in texts if "q0" not in (t[1] or "").lower())
    kept = decontaminate.clean(frame, bench)
    assert kept.columns == frame.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == want


def test_ordinal_held_out(spark):
    rnd = random.Random(4)
    plain = [f"p{k}" for k in range(300)]
    texts, labels = [], []
    for k in range(900):
        words = [rnd.choice(plain) for _ in range(rnd.randint(5, 80))]
        kind = k % 3
        if kind == 0:
            words[::6] = ["vile"] * len(words[::6])
        if kind == 1:
            words = [w + "###" for w in words]
        texts.append((k, " ".join(words)))
        if k < 600:
            labels.append((k, int(kind != 1), int(kind == 0)))
    texts += [(900, None), (901, ""), (None, "p1 p2"), (5, texts[5][1])]
    frame = spark.createDataFrame(texts, "doc_id long, text string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame(labels + [(None, 1, 0), (5000, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int")
    model = ordinal.fit(frame, ordinal.graded(lab), 3)
    assert model.cuts == sorted(model.cuts)
    held = [r for r in ordinal.scored(frame, model, 2, "p").collect() if r.doc_id is not None and 600 <= r.doc_id < 900]
    assert sum((r.p.tail >= 0.5) == (r.doc_id % 3 == 2) for r in held) / len(held) > 0.97
    kept = ordinal.accepted(frame, lab)
    assert kept.columns == frame.columns and {r.doc_id for r in kept.collect()} >= {2, 5}
    untrained = ordinal.accepted(frame, lab.where("false"))
    assert untrained.count() == len(texts)
    assert ordinal.accepted(frame.where("false"), lab).count() == 0


def test_fit_takes_one_row_of_a_rated_id(spark):
    rnd = random.Random(13)
    texts = [(k, " ".join([rnd.choice(["vile", "calm"][k % 2:][:1]), *(f"p{rnd.randrange(40)}" for _ in range(12))])) for k in range(120)]
    lab = spark.createDataFrame([(k, k % 2, 0) for k in range(120)], "doc_id long, quality int, toxic int")
    hot = [(7, f"calm vile extra{k % 5} p{k % 40} more{k}") for k in range(400)]
    frame = spark.createDataFrame(texts + hot, "doc_id long, text string")
    h = F.xxhash64(F.col("text").cast("binary"))
    single = frame.groupBy("doc_id").agg(F.min_by("text", h).alias("text"))
    got, want = (ordinal.fit(f, ordinal.graded(lab), 3) for f in (frame.repartition(3), single))
    assert got.weights == want.weights and got.cuts == want.cuts and got.weights


def test_pipeline_keeps_columns_and_nulls(spark, tmp_path):
    import corpus_pipeline

    d = spark.createDataFrame([(k, t, "en", s, len(t or "")) for k, (t, s) in enumerate([("a b c d", "x"), ("a b c d", "y"), (None, None), ("e f g h i j", "x"), ("", "y")])],
                              "doc_id long, text string, lang string, source string, n_chars long")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "e f g h i j")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == d.columns, name
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in out.collect()} <= {0, 2} and "start" in out.columns
    assert len(corpus_pipeline.STAGES) == 5


def test_pipeline_stages_against_plain_python(spark, tmp_path):
    """Toxic, near-copy, leaked and clean rows: what each stage keeps, and the index at the end."""
    import corpus_pipeline

    rnd = random.Random(21)
    clean = [" ".join(f"w{rnd.randrange(3000)}" for _ in range(rnd.randint(40, 80))) for _ in range(150)]
    passages = [" ".join(f"bench{k}x{j}" for j in range(n)) for k, n in enumerate((12, 15, 30))]
    rows = [(k, t, f"s{k % 3}") for k, t in enumerate(clean)]
    toxic = [" ".join("vile" if j % 4 == 0 else w for j, w in enumerate(t.split())) for t in clean[:100]]
    rows += [(200 + k, f"{t} bad{k}", f"s{k % 3}") for k, t in enumerate(toxic)]
    rows += [(400 + k, clean[k], "s1") for k in range(0, 40, 4)]  # copies
    rows += [(500 + k, clean[k].upper(), "s2") for k in range(1, 40, 4)]  # the same words in capitals: a near copy
    rows += [(600 + k, f"{clean[100 + k]} more{k} {p}", "s0") for k, p in enumerate(passages)]
    rows += [(610, f"{clean[110]} other " + passages[1].replace("bench1x6", "changed"), "s0")]
    labels = [(k, 1, 0) for k in range(100)] + [(200 + k, 0, 1) for k in range(70)]
    spark.createDataFrame([(i, t, "en", s, len(t)) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(list(enumerate(passages)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = corpus_pipeline.stored(stage(spark, now, str(tmp_path)), f"test-{name}")
        kept[name] = now.select("doc_id", "text", "source").collect()
    got = {name: {r.doc_id for r in r_} for name, r_ in kept.items()}
    text = {i: t for i, t, _ in rows}

    want = {i for i, t, _ in rows if "vile" not in t.split()}
    capitals = set(range(501, 540, 4))  # no rating covers capitals
    assert got["quality_classifier"] - capitals == want - capitals

    fps = {i: naive_fingerprint(text[i]) for i in got["quality_classifier"]}
    root = {i: i for i in fps}
    for a, b in itertools.combinations(sorted(fps), 2):
        if (fps[a] ^ fps[b]).bit_count() <= 2 and root[a] != root[b]:
            root = {i: min(root[a], root[b]) if r in (root[a], root[b]) else r for i, r in root.items()}
    want = set(root.values())
    assert got["simhash_near_dedup"] == want and not want & set(range(400, 600)) and len(want) > 100

    words = {i: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text[i])) for i in want}
    want = {i for i in want if not any(leaks(words[i], p.split()) for p in passages)}
    assert got["benchmark_decontamination"] == want == got["simhash_near_dedup"] - {600, 601, 602, 610}

    sizes, taken = Counter(), Counter()
    for r in kept["benchmark_decontamination"]:
        sizes[r.source] += len(r.text.split())
    for r in kept["source_mixing"]:
        assert r.text == text[r.doc_id]
        taken[r.source] += len(r.text.split())
    order = sorted(sizes, key=mixing.source_key)
    target = mixing.water_fill({s: sizes[s] for s in order}, {s: k % 3 + 1 for k, s in enumerate(order)})
    assert got["source_mixing"] <= want and all(abs(taken[s] - target[s]) <= 160 for s in order)  # two of the longest texts

    library = Tokenizer.from_file(VOCABULARY)
    index = sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    mixed, at = sorted(r.doc_id for r in kept["source_mixing"]), 0
    assert [r.doc_id for r in index] == mixed
    for r in index:
        ids = np.array(library.encode(text[r.doc_id], add_special_tokens=False).ids + [1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


@pytest.mark.parametrize("operator", ["licenses", "syncmers", "decontaminate"])
def test_native_operators_run_no_python(docs, spark, operator):
    """Operators 4, 6 and 9 plan no Python, pandas or Arrow step and scan no RDD of rows made in Python."""
    bench = spark.createDataFrame([(1, " ".join(WORDS))], "item_id long, text string")
    frame = {"licenses": licenses.scan, "syncmers": syncmers.fingerprints, "decontaminate": lambda d: decontaminate.overlaps(d, bench)}[operator](docs)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|InPandas|InArrow", plan)


def test_word_cache_is_bounded_by_bytes():
    from ledgerlens.llm import wordcache

    calls = []
    cache = wordcache.WordCache(lambda words: calls.extend(words) or [w.upper() for w in words], most=100 * wordcache.ENTRY_BYTES)
    long = ["x" * 65 + str(k) for k in range(1000)]
    for k in range(0, 1000, 10):
        get = cache.values([long[k:k + 10], ["again"], []])
        assert [get(w) for w in [*long[k:k + 10], "again"]] == [*(w.upper() for w in long[k:k + 10]), "AGAIN"]
        assert sum(len(w) > wordcache.LONG_WORD for d in (cache.young, cache.old) for w in d) <= 20
    assert calls.count("again") == 1  # moves along from generation to generation
    for k in range(5000):
        cache.values([[f"w{k}"]])
    assert len(cache.young) + len(cache.old) < 250


def test_worker_keeps_one_operator():
    from ledgerlens.llm import wordcache

    first = wordcache.of_worker("a", 1, dict)
    assert wordcache.of_worker("a", 1, dict) is first and wordcache.of_worker("a", 2, list) == []
    wordcache.of_worker("b", 1, dict)
    assert wordcache.of_worker("a", 1, dict) is not first


def test_mixture_with_clashing_columns(spark, tmp_path):
    import corpus_pipeline

    rnd = random.Random(31)
    rows = [(k, " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(1, 40))), f"s{k % 2}") for k in range(80)] + [(None, "no id at all", "s1"), (None, None, "s0"), (3, "", None)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = plain
    for c in ("_id", "_tie", "_times", "own_id", "OWN_TEXT", "times", "tie", "copy", "size", "taken"):
        clash = clash.withColumn(c, F.lit("clash"))
    want = Counter((r.doc_id, r.text) for r in corpus_pipeline.mixture(spark, plain, "").collect())
    got = corpus_pipeline.mixture(spark, clash, "")
    assert got.columns == clash.columns and Counter((r.doc_id, r.text) for r in got.collect()) == want and len(want) > 20


def test_vocabulary_with_another_splitter_is_refused():
    from ledgerlens.llm import wordcache

    assert wordcache.Vocabulary(VOCABULARY).pieces(b"it's") == [b"it", b"'s"]
    with pytest.raises(ValueError, match="pre_tokenizer"):
        wordcache.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))

"""MinHash near-duplicates by HyperMinHash registers (operator 11).

A document's set is its distinct word shingles (A-Z lower-cased). Documents whose sets have a
Jaccard similarity of at least ``percent`` / 100 are linked; groups are the connected parts.

1. Registers: shingle hashes fall into 128 buckets; a bucket keeps its smallest hash as
   the count of leading zeros (6 bits) and the ten bits after the first one (mantissa). An empty
   bucket takes the register of the bucket that a fixed probe order finds first.
2. Bands: 25 bands of 5 registers; sets that agree in a band are candidates. A pair at
   0.85 shares no band with probability (1 - 0.85^5)^25 = 4e-7.
3. Estimate: the share of equal registers, less the share that would agree by chance
   (leading zeros of two sets of these sizes agree and all mantissa bits do), estimates
   the similarity. Pairs more than 4.75 standard deviations below the bound end here.
4. Verification: the full sets of the pair are compared; only that links.

Equal sets collapse first: one row per distinct set enters the index. No band makes all its
pairs: a first pass verifies, per band, a forest of the best estimates alone (at most one pair
a member). Only bands that then still hold sets of different groups are looked at again, with
the full sets at hand: their candidates are verified in place, best estimates first, and pairs
that a link found there has joined are passed over; only links leave. A band of more than
``block`` sets is dealt into blocks, and every pair of blocks is a row of its own, so a large
group is compared by many tasks (the comparisons of registers in it still grow with its square).

Defined results: NULL or word-less text has the empty set (n_shingles 0) and links with nothing,
its component_id is its doc_id; fewer words than a shingle: the whole sequence is the one
shingle; NULL doc_id is kept, a group's id is the smallest known one (NULL if none is), kept
compares NULL-safe; rows that repeat a document are rows of the same group; an empty table
gives no row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import for_python, stored, text_or_empty
from ledgerlens.llm.components import components

SEED = 11
BUCKET_BITS, ZERO_BITS, MANTISSA = 7, 6, 10
M = 1 << BUCKET_BITS
REST = 64 - BUCKET_BITS  # hash bits below the bucket number
BANDS, ROWS = 25, 5
PROBES = 64
BLOCK, BLOCK_SHINGLES = 512, 1 << 20
SIGMAS = 4.75


def shingles(text: bytes, size: int) -> np.ndarray:
    """Distinct shingle hashes, ascending."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends)]
    last = ends[size - 1:] if len(words) >= size else ends[-1:]
    digest = xxhash.xxh3_64_intdigest
    return np.unique(np.array([digest(flat[a:b], SEED) for a, b in zip(starts, last, strict=False)], np.uint64))


def set_name(hashes: np.ndarray) -> bytes:
    """128 bits that stand for the whole set."""
    return xxhash.xxh3_128_digest(hashes.tobytes(), SEED)


def _probes() -> np.ndarray:
    return np.random.default_rng(SEED).integers(0, M, (M, PROBES))


PROBE = _probes()


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 128 registers of an ascending, non-empty set of hashes: leading zeros, then mantissa."""
    bucket = (hashes >> np.uint64(REST)).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
    v = (hashes[first] & np.uint64((1 << REST) - 1)) >> np.uint64(REST - 53)  # 53 bits are exact in a double
    exponent = np.frexp(v.astype(np.float64))[1].astype(np.int64)  # bits of v
    zeros = np.minimum(53 - exponent, (1 << ZERO_BITS) - 1)
    up = np.maximum(exponent - 1 - MANTISSA, 0).astype(np.uint64)
    down = np.maximum(MANTISSA + 1 - exponent, 0).astype(np.uint64)
    mantissa = (v >> up << down).astype(np.int64) & ((1 << MANTISSA) - 1)
    out = np.full(M, -1, np.int64)
    out[bucket[first]] = zeros << MANTISSA | mantissa
    empty = np.flatnonzero(out < 0)
    if len(empty):
        found = out[PROBE[empty]]
        hit = (found >= 0).argmax(axis=1)
        borrowed = found[np.arange(len(empty)), hit]
        out[empty] = np.where(borrowed >= 0, borrowed, out[bucket[first[0]]])
    return out.astype(np.uint16)


def bands(regs: np.ndarray) -> np.ndarray:
    """One signed 64-bit key per row and band; keys of different bands differ."""
    x = regs[:, :BANDS * ROWS].reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    key = x[:, :, 0] | x[:, :, 1] << np.uint64(16) | x[:, :, 2] << np.uint64(32) | x[:, :, 3] << np.uint64(48)
    key = (key ^ key >> np.uint64(31)) * np.uint64(0x9E3779B185EBCA87) + x[:, :, 4] + (np.arange(BANDS, dtype=np.uint64) << np.uint64(16))
    key = (key ^ key >> np.uint64(29)) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (key ^ key >> np.uint64(32)).view(np.int64)


def chance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Probability that registers of unlike sets of a and b elements agree: equal leading zeros, equal mantissa."""
    z = np.arange(REST + 1)
    upper, lower = -np.expm1(-np.log(2) * z), 1 - 2.0 ** -(z + 1)  # P(hash part >= 2^-z), P(>= 2^-(z+1))
    k = lambda n: np.maximum(np.asarray(n, float) / M, 1)[..., None]
    of = lambda n: lower ** k(n) - np.where(z > 0, upper, 0) ** k(n)
    return (of(a) * of(b)).sum(axis=-1) / (1 << MANTISSA)


def estimate(equal: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from the number of equal registers, corrected for chance agreement."""
    c = chance(a, b)
    return np.clip((equal / M - c) / (1 - c), 0, 1)


def lowest(percent: int) -> float:
    """Estimates below this are no candidates."""
    s = percent / 100
    return s - SIGMAS * math.sqrt(s * (1 - s) / M)


def forest(pairs: np.ndarray, score: np.ndarray, label: list, linked: Callable[[int, int], bool] = lambda a, b: True) -> list[int]:
    """Indices of a spanning forest, best scores first, of the pairs that are ``linked``, over the groups
    that ``label`` gives the nodes; a pair inside a group or tree is not asked for."""
    root: dict = {}

    def top(x):
        while root.get(x, x) != x:
            root[x] = x = root.get(root[x], root[x])
        return x

    out, left = [], len(set(label)) - 1
    for k in np.argsort(-score, kind="stable").tolist():
        x, y = pairs[k].tolist()
        a, b = top(label[x]), top(label[y])
        if a != b and linked(x, y):
            root[a] = b
            out.append(k)
            left -= 1
            if not left:
                break
    return out


def candidates(regs: np.ndarray, n: np.ndarray, side: np.ndarray, label: list, percent: int, band: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (of different blocks, where there are two) with different labels whose estimate reaches the
    bound, and the estimates; with ``band`` only pairs for which it is the first band they share."""
    two = side.any() and not side.all()
    mark = np.unique(np.array(label, dtype=object), return_inverse=True)[1]
    pairs, scores = [np.zeros((0, 2), np.int64)], [np.zeros(0)]
    least = lowest(percent)
    for i in range(len(regs) - 1):
        partners = np.arange(i + 1, len(regs))
        ok = mark[i + 1:] != mark[i]
        ok &= np.minimum(n[i + 1:], n[i]) * 100 >= percent * np.maximum(n[i + 1:], n[i])
        if two:
            ok &= side[i + 1:] != side[i]
        partners = partners[ok]
        same = regs[partners] == regs[i]
        equal = same.sum(axis=1)
        ok = equal >= least * M  # the correction only lowers it
        if not ok.any():
            continue
        partners, same, equal = partners[ok], same[ok], equal[ok]
        est = estimate(equal, n[partners], n[i])
        ok = est >= least
        if band is not None:
            ok &= same[:, :BANDS * ROWS].reshape(len(partners), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
        pairs.append(np.column_stack((np.full(ok.sum(), i), partners[ok])))
        scores.append(est[ok])
    return np.concatenate(pairs), np.concatenate(scores)


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Whether two full sets reach the bound."""
    both = len(np.intersect1d(one, two, assume_unique=True))
    return 100 * both >= percent * (len(one) + len(two) - both)


SKETCH = "doc_id long, n long, name binary, regs binary, t binary"


def sketched(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n (set size), name (of the set), regs and the compressed text, written."""
    def run(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            texts = b.column(1).to_pylist()
            sets = [shingles(t, size) for t in texts]
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array([set_name(s) if len(s) else None for s in sets], pa.binary()),
                pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()), pa.array([z.compress(t) for t in texts], pa.binary())],
                names=["doc_id", "n", "name", "regs", "t"])

    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))
    return stored(src.mapInArrow(run, SKETCH), "sketches")


def shared_bands(sets: DataFrame, block: int) -> DataFrame:
    """key, band, name, members, blocks, part: the bands that more than one set has. A block has about
    ``block`` sets and ``BLOCK_SHINGLES`` shingles at most."""
    def run(batches):
        for b in batches:
            regs = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint16).reshape(-1, M)
            each = pa.array(np.repeat(np.arange(len(regs)), BANDS))
            yield pa.RecordBatch.from_arrays([pa.array(bands(regs).ravel()), pa.array(np.tile(np.arange(BANDS, dtype=np.int8), len(regs))),
                                              b.column(0).take(each), b.column(2).take(each)], names=["key", "band", "name", "n"])

    keys = stored(sets.select("name", "regs", "n").mapInArrow(run, "key long, band byte, name binary, n long"), "bands")
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("int")
    again = keys.groupBy("key").agg(F.count(F.lit(1)).alias("members"), parts.alias("blocks")).where("members > 1")
    return stored(keys.drop("n").join(again, "key").withColumn("part", F.pmod(F.xxhash64("name"), F.col("blocks")).cast("int")), "shared-bands")


def blocks_of(shared: DataFrame, sets: DataFrame, *more: str) -> DataFrame:
    """band, members: a row per band and pair of its blocks, with the columns of ``sets`` of up to two blocks of sets."""
    # A member of a block meets every block of the band; in the pair of blocks (i, j) those of j are the second side.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = (shared.select("key", "band", "name", "part", other.alias("q"))
             .select("key", "band", "name", F.least("part", "q").alias("i"), F.greatest("part", "q").alias("j"), "part"))
    member = F.struct("name", "regs", "n", "label", (F.col("part") == F.col("j")).alias("side"), *more)
    return (dealt.join(sets, "name").groupBy("key", "band", "i", "j").agg(F.collect_list(member).alias("members"))  # at most two blocks
            .where(F.size("members") > 1).select("band", "members"))


def _columns(members: list[dict]) -> tuple:
    members.sort(key=lambda m: m["name"])
    regs = np.frombuffer(b"".join(m["regs"] for m in members), np.uint16).reshape(-1, M)
    return regs, np.array([m["n"] for m in members]), np.array([m["side"] for m in members]), [m["label"] for m in members]


def _pairs(names: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    low, high = zip(*(sorted(x) for x in names), strict=True) if names else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(low, pa.binary()), pa.array(high, pa.binary())], names=["a", "b"])


def best_pairs(shared: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: of every band a forest of the best estimates between its sets."""
    def run(batches):
        for b in batches:
            for members in b.column(1).to_pylist():
                regs, n, side, label = _columns(members)
                pairs, score = candidates(regs, n, side, label, percent)
                yield _pairs([tuple(members[x]["name"] for x in pairs[k]) for k in forest(pairs, score, label)])

    return blocks_of(shared, sets).mapInArrow(run, "a binary, b binary").distinct()


def links_between_groups(shared: DataFrame, sets: DataFrame, percent: int, size: int) -> DataFrame:
    """a, b: links that join all sets with a link between different labels. The full sets travel
    with the band (column t), so candidates are verified where they arise and only links leave."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            for band, members in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                regs, n, side, label = _columns(members)
                pairs, score = candidates(regs, n, side, label, percent, band)
                full: dict[int, np.ndarray] = {}

                def whole(x: int, members=members, full=full) -> np.ndarray:
                    if x not in full:
                        full[x] = shingles(z.decompress(members[x]["t"]), size)
                    return full[x]

                kept = forest(pairs, score, label, lambda x, y, whole=whole: similar(whole(x), whole(y), percent))
                yield _pairs([tuple(members[x]["name"] for x in pairs[k]) for k in kept])

    return blocks_of(shared, sets, "t").mapInArrow(run, "a binary, b binary")


def verified(pairs: DataFrame, texts: DataFrame, percent: int, size: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    def run(batches):
        z = zstandard.ZstdDecompressor()
        for b in batches:
            full: dict[bytes, np.ndarray] = {}
            keep = []
            for x, y, tx, ty in zip(*(c.to_pylist() for c in b.columns), strict=True):
                for name, t in ((x, tx), (y, ty)):
                    if name not in full:
                        full[name] = shingles(z.decompress(t), size)
                keep.append(similar(full[x], full[y], percent))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = texts.select(F.col("name").alias("a"), F.col("t").alias("ta"))
    two = texts.select(F.col("name").alias("b"), F.col("t").alias("tb"))
    return pairs.join(one, "a").join(two, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a binary, b binary")


def texts_of(rows: DataFrame, names: DataFrame) -> DataFrame:
    """name, t: one compressed text of each of the sets."""
    return rows.join(names, "name", "left_semi").groupBy("name").agg(F.min("t").alias("t"))


def links(rows: DataFrame, sets: DataFrame, percent: int, size: int, block: int = BLOCK) -> DataFrame:
    """node, root: connected parts of the sets (name, n, regs) that have a link."""
    shared = shared_bands(sets, block)
    # The texts of all sets that share a band, fetched once for both passes.
    texts = stored(texts_of(rows, shared.select("name").distinct()), "shared-texts")
    tried = stored(best_pairs(shared, sets.select("name", "regs", "n", F.col("name").alias("label")), percent), "first-pairs")
    found = stored(verified(tried, texts, percent, size), "first-links")
    roots = stored(components(found), "first-groups")
    labelled = sets.join(roots.withColumnRenamed("node", "name"), "name", "left").select("name", "regs", "n", F.coalesce("root", "name").alias("label"))
    labelled = stored(labelled, "labelled-sets")
    # Only bands that still hold sets of different groups.
    more = shared.where("members > 2")
    differ = (more.select("key", "name").join(labelled.select("name", "label"), "name")
              .groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y").select("key"))
    differ = stored(more.join(differ, "key", "left_semi"), "open-bands")
    between = links_between_groups(differ, labelled.join(texts, "name"), percent, size)
    return components(found.union(between))


def groups(docs: DataFrame, percent: int = 85, size: int = 5, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row."""
    for_python(docs.sparkSession, 128)
    rows = sketched(docs, size)
    sets = stored(rows.where("name is not null").groupBy("name").agg(F.min("n").alias("n"), F.min("doc_id").alias("first"), F.min("regs").alias("regs")), "sets")
    roots = links(rows, sets, percent, size, block)
    named = sets.select("name", "first").join(roots.withColumnRenamed("node", "name"), "name", "left").withColumn("root", F.coalesce("root", "name"))
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    of_set = stored(named.join(smallest, "root").select("name", "component"), "set-groups")
    # A group of copies meets on one name; adaptive skew splitting divides the side of the documents.
    out = rows.select("doc_id", "n", "name").join(of_set.withColumnRenamed("name", "of"), F.col("name") == F.col("of"), "left")
    component = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


#: The same in DuckDB SQL for the default parameters: all pairs that share a shingle, counted.
ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), placed AS (
  SELECT rid, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM docs
), five AS (
  SELECT rid, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o) AS s, lead(word, 4) OVER o AS fifth
  FROM placed WINDOW o AS (PARTITION BY rid ORDER BY i)
), shingles AS (
  SELECT DISTINCT rid, s FROM five WHERE fifth IS NOT NULL
  UNION ALL
  SELECT rid, array_to_string(w, ' ') FROM docs WHERE len(w) BETWEEN 1 AND 4
), sizes AS (
  SELECT rid, count(*) AS n FROM shingles GROUP BY rid
), links AS (
  SELECT a.rid AS x, b.rid AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid <> b.rid
  JOIN sizes p ON p.rid = a.rid JOIN sizes q ON q.rid = b.rid
  GROUP BY a.rid, b.rid, p.n, q.n
  HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
), reached AS (
  SELECT rid AS x, rid AS y FROM docs
  UNION
  SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
), component AS (
  SELECT r.x AS rid, min(d.doc_id) AS component_id FROM reached r JOIN docs d ON d.rid = r.y GROUP BY r.x
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, c.component_id, d.doc_id IS NOT DISTINCT FROM c.component_id AS kept
FROM docs d JOIN component c ON c.rid = d.rid LEFT JOIN sizes s ON s.rid = d.rid
"""

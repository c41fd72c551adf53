"""Candidate search for repeated windows, shared by operators 8 and 10.

A window is ``length`` consecutive units (bytes, or word hashes) of one document. Every
window names an anchor: the place of the smallest seed hash inside it (the leftmost on
ties). The choice depends on the window's content alone, so equal windows name equal seeds
at equal offsets. Consecutive windows with one anchor form a *run*; the units from its first
window's start to its last window's end are its *block*.

* A seed that anchors one run only: none of the run's windows occurs again.
* All runs of a seed have equal blocks: all their windows occur again.
* Otherwise the seed is mixed; one representative of each distinct block goes to the
  operator's own exact method, and its answer holds for all runs with that block.

So whole copies, however many, cost one row of two hashes per run, and only the
surroundings of differences are examined window by window.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import pairwise

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import for_python, stored, text_or_empty

RUNS = "id long, h long, seed long, block long, first int, last int"
HASH_BITS = np.uint64(24)  # low bits of a sort key hold the place inside a chunk
CHUNK = 1 << 23
M1, M2, M3 = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


class Units:
    """How texts become units: ``width`` bytes each in a buffer, and a seed hash per place."""

    def __init__(self, kind: str, length: int, seed: int):
        self.kind, self.length, self.seed = kind, length, seed
        self.width = 1 if kind == "bytes" else 8

    def buffer(self, text: bytes) -> bytes:
        if self.kind == "bytes":
            return text
        digest = xxhash.xxh3_64_intdigest
        return np.array([digest(w) for w in text.split()], "<u8").tobytes()

    def seeds(self, buf: bytes) -> np.ndarray:
        """Hash of the ``seed`` units at each place: spans double, the last two overlap."""
        if self.kind == "bytes":
            x = np.frombuffer(buf, np.uint8).astype(np.uint64)
            for k in (1, 2, 4):
                x = x[:-k] | x[k:] << np.uint64(8 * k)
            have = 8
        else:
            x, have = np.frombuffer(buf, "<u8"), 1
        while have < self.seed:
            step = min(have, self.seed - have)
            x = x[:-step] * M1 + (x[step:] ^ x[step:] >> np.uint64(29)) * M2
            have += step
        x = (x ^ x >> np.uint64(32)) * M2
        return (x ^ x >> np.uint64(29)) * M3


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values: prefix and suffix minima of blocks of w."""
    n = len(x) - w + 1
    blocks = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    blocks[:len(x)] = x
    blocks = blocks.reshape(-1, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n], before[w - 1:w - 1 + n])


def runs(buf: bytes, units: Units) -> list[tuple[int, int, int, int]]:
    """(seed, block, first window, last window) of every run, in order; hashes signed."""
    z, length = units.width, units.length
    n_windows = len(buf) // z - length + 1
    out: list[tuple[int, int, int, int]] = []
    w = length - units.seed + 1
    view = memoryview(buf)
    digest = xxhash.xxh3_64_intdigest
    for at in range(0, max(n_windows, 0), CHUNK):
        here = min(CHUNK, n_windows - at)
        seeds = units.seeds(buf[z * at:z * (at + here + length - 1)])
        key = seeds >> HASH_BITS << HASH_BITS | np.arange(len(seeds), dtype=np.uint64)
        place = (sliding_min(key, w) & np.uint64((1 << 24) - 1)).astype(np.int64)
        cut = np.flatnonzero(place[1:] != place[:-1]) + 1
        firsts = np.concatenate(([0], cut))
        names = seeds[place[firsts]].view(np.int64).tolist()
        firsts = [*(firsts + at).tolist(), at + here]
        for name, (a, b) in zip(names, pairwise(firsts), strict=True):
            block = digest(view[z * a:z * (b - 1 + length)])
            out.append((name, block - (1 << 64) if block >> 63 else block, a, b - 1))
    return out


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id as ``id``, text as bytes, and a hash that tells rows of one id apart."""
    t = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().cast("binary").alias("t"))
    return t.select("id", F.xxhash64("t").alias("h"), "t")


def candidates(docs: DataFrame, units: Units) -> DataFrame:
    """Runs (id, h, seed, block, first, last, mixed) of every seed that anchors more than one run."""
    for_python(docs.sparkSession)

    def extract(batches):
        for b in batches:
            cols: list[list] = [[], [], [], [], [], []]
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found = runs(units.buffer(t), units)
                cols[0] += [i] * len(found)
                cols[1] += [h] * len(found)
                for c, v in zip(cols[2:], zip(*found, strict=True), strict=False):
                    c += v
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (*[pa.int64()] * 4, pa.int32(), pa.int32()), strict=True)],
                                             names=["id", "h", "seed", "block", "first", "last"])

    every = stored(keyed(docs).mapInArrow(extract, RUNS), "runs")
    again = (every.groupBy("seed").agg(F.count(F.lit(1)).alias("n"), F.min("block").alias("a"), F.max("block").alias("b"))
             .where("n > 1").select("seed", (F.col("a") != F.col("b")).alias("mixed")))
    # Written first: sharing the shuffle of its count, the join could not split the runs of a hot seed.
    again = stored(again, "repeated-seeds")
    return stored(every.join(again, "seed").select("id", "h", "seed", "block", "first", "last", "mixed"), "repeated-runs")


def blocks(runs_: DataFrame) -> DataFrame:
    """The distinct blocks of mixed seeds: seed, block, n (runs that have it), one run as (id, h, first, last)."""
    return (runs_.where("mixed").groupBy("seed", "block").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "h", "first", "last")).alias("r"))
            .select("seed", "block", "n", "r.*"))


def packed(docs: DataFrame) -> DataFrame:
    """(id, h, t) with the text compressed, for the shuffles that bring text and findings together."""
    def pack(batches):
        z = zstandard.ZstdCompressor(level=1)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([z.compress(t) for t in b.column(2).to_pylist()], pa.binary())], names=["id", "h", "t"])

    return keyed(docs).mapInArrow(pack, "id long, h long, t binary")


def unpack(texts: pa.Array) -> list[bytes]:
    z = zstandard.ZstdDecompressor()
    return [z.decompress(t) for t in texts.to_pylist()]


def block_texts(docs: DataFrame, blocks_: DataFrame, extract: Callable, schema: str, *more: str) -> DataFrame:
    """``extract(text, [(block, n, first, last, *more)])`` yields record batches for the blocks of one document."""
    fields = ("block", "n", "first", "last", *more)
    own = (blocks_.groupBy("id", "h").agg(F.collect_list(F.struct(*fields)).alias("blocks"))
           .select(F.col("id").alias("b_id"), F.col("h").alias("b_h"), "blocks"))  # at most one a window of the document
    d = packed(docs)
    both = d.join(own, d["id"].eqNullSafe(own["b_id"]) & (d["h"] == own["b_h"])).select("t", "blocks")

    def run(batches):
        for b in batches:
            for t, x in zip(unpack(b.column(0)), b.column(1).to_pylist(), strict=True):
                yield from extract(t, [tuple(r[f] for f in fields) for r in x])

    return both.mapInArrow(run, schema)


def covered(runs_: DataFrame, blocks_: DataFrame, ranges: DataFrame) -> DataFrame:
    """Per document (id, h): the window starts that occur again, as an array of (a, b) ranges.
    ``ranges``: block, a, b (window starts relative to the block's start) of blocks that one run has."""
    whole = runs_.where("mixed").join(blocks_.where("n > 1").select("block"), "block", "left_semi")
    full = runs_.where("not mixed").unionByName(whole).select("id", "h", F.col("first").alias("a"), F.col("last").alias("b"))
    part = (runs_.where("mixed").select("block", "id", "h", "first").join(ranges.select("block", F.col("a").alias("ra"), F.col("b").alias("rb")), "block")
            .select("id", "h", (F.col("first") + F.col("ra")).alias("a"), (F.col("first") + F.col("rb")).alias("b")))
    return (full.union(part).groupBy("id", "h")
            .agg(F.collect_set(F.struct("a", "b")).alias("ranges")))  # at most one a window of the document


def removed_mask(n: int, ranges: list, length: int) -> np.ndarray:
    """Units covered by a window whose start is in one of the ranges."""
    step = np.zeros(n + 1, np.int64)
    if ranges:
        a = np.array([r["a"] for r in ranges])
        b = np.array([r["b"] for r in ranges])
        np.add.at(step, a, 1)
        np.add.at(step, b + length, -1)
    return np.cumsum(step[:n]) > 0


def apply(docs: DataFrame, ranges: DataFrame, digest: Callable[[bytes, list], tuple], schema: str, names: list[str]) -> DataFrame:
    """One row per document: doc_id and what ``digest(text, ranges)`` gives."""
    d = packed(docs)
    r = ranges.select(F.col("id").alias("r_id"), F.col("h").alias("r_h"), "ranges")
    both = d.join(r, d["id"].eqNullSafe(r["r_id"]) & (d["h"] == r["r_h"]), "left").select("id", "t", "ranges")

    def run(batches):
        for b in batches:
            rows = [digest(t, x or []) for t, x in zip(unpack(b.column(1)), b.column(2).to_pylist(), strict=True)]
            cols = list(zip(*rows, strict=True)) or [[] for _ in names]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, pa.string() if k.endswith("sha256") else pa.int64()) for c, k in zip(cols, names, strict=True))],
                                             names=["doc_id", *names])

    return both.mapInArrow(run, schema)

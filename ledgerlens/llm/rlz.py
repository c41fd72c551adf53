"""Substring deduplication by relative Lempel-Ziv parsing (operator 10).

Removes every word that lies in a window of ``length`` words which also starts anywhere
else. The reference is the whole corpus, as the distinct candidate blocks of ``repeats``
(at most 2 * length - seed words each), written as the sequence of their window hashes:

1. Index: the reference in suffix order. Each place of each block is one row, its key the
   hashes of the windows from there to the block's end. Rows are range-partitioned by the
   whole key and the place, so equal keys spread over many tasks, and each task streams its
   sorted rows. What a place shares with the row before or after it is its longest copy in
   any other block: k windows in common are k+length-1 equal words, none is no copy.
   Neighbours in two tasks are compared from the first and last row of each task.
2. Parse: every block is factored greedily from the left. At the first place with a copy the
   factor is the longest copy, contiguous in one reference block from one place on.
3. Factor boundaries: the window after a factor's last one crosses its end. It is looked up
   in the index in turn: if it has a copy, the next factor starts there, else the parse goes
   on to the next place that has one.

All factors have ``length`` words at least, so their words are the duplicates. A window in no
factor is in no reference block but its own. Blocks that several runs have are copies of
themselves as they stand: they are references, but are not parsed.

Defined results: NULL or word-less text has 0 words and keeps nothing (hash of the empty
text); rows that repeat a doc_id or text are documents of their own, so their windows occur
elsewhere; texts of fewer than ``length`` words lose nothing; NULL doc_id is kept; an empty
table gives no row. White space between kept words becomes one space.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import repeats
from ledgerlens.llm.common import stored

SEED = 12  # words of the anchor seeds at windows of 35
NAME = 8  # bytes of a window's hash
# What the streaming pass gives: a place's longest copy; task and key only on the first and last row of each task.
COPY = {"block": pa.int64(), "at": pa.int32(), "k": pa.int32(), "reference": pa.int64(), "place": pa.int32(), "parsed": pa.bool_(), "task": pa.int32(), "key": pa.binary()}
SQL = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}


def window_names(units: repeats.Units):
    """A document's reference blocks, each as the hashes of its windows (big-endian, so that bytes sort like hashes)."""
    def extract(text: bytes, own: list):
        buf = memoryview(units.buffer(text))
        z, size = units.width, units.width * units.length
        digest = xxhash.xxh3_64_digest
        names = [b"".join([digest(buf[z * i:z * i + size]) for i in range(first, last + 1)]) for _, _, first, last in own]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in own], pa.int64()), pa.array([r[1] == 1 for r in own], pa.bool_()), pa.array(names, pa.binary())],
                                         names=["block", "parsed", "names"])
    return extract


def shared(a: bytes, b: bytes) -> int:
    """Windows that two sequences have in common from their start."""
    n = min(len(a), len(b))
    return (8 * n - (int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])).bit_length()) // (8 * NAME)


def longest(row: tuple, before: tuple | None, after: tuple | None) -> tuple[int, int | None, int | None]:
    """(windows, reference block, place in it) of a row's longest copy among its neighbours in suffix order."""
    best: tuple[int, int | None, int | None] = (0, None, None)
    for other in (before, after):
        if other is not None and other[0][:NAME] == row[0][:NAME] and (k := shared(row[0], other[0])) > best[0]:
            best = k, other[1], other[2]
    return best


def copies(names: DataFrame) -> DataFrame:
    """block, at, k, reference, place: the longest copy of every place that has one, for blocks to be parsed."""
    place = F.explode(F.sequence(F.lit(0), (F.length("names") / NAME).cast("int") - 1)).alias("at")
    rows = names.select("block", "parsed", "names", place).select(F.expr(f"substring(names, at * {NAME} + 1)").alias("key"), "block", "at", "parsed")
    order = ("key", "block", "at")
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        task = TaskContext.get().partitionId()
        before = here = None
        for b in chain(batches, [None]):
            found: list[tuple] = []
            for row in [None] if b is None else zip(*(b.column(c).to_pylist() for c in range(4)), strict=True):  # None: the end
                edge = before is None or row is None
                if here is not None and (edge or here[3]):
                    k, reference, at = longest(here, before, row)
                    if edge or k:
                        found.append((here[1], here[2], k, reference, at, here[3], task if edge else None, here[0] if edge else None))
                before, here = here, row
            cols = list(zip(*found, strict=True)) or [[]] * len(COPY)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, COPY.values(), strict=True)], names=list(COPY))

    found = stored(rows.mapInArrow(run, ", ".join(f"{c} {SQL[t]}" for c, t in COPY.items())), "copies")
    edges = [(r.key, r.block, r.at, r.parsed, r.task, (r.k, r.reference, r.place))
             for r in found.where("task is not null").orderBy("task", *order).collect()]  # two rows a task at most
    fixed = []
    for before, row, after in zip([None, *edges], edges, [*edges[1:], None], strict=False):
        across = longest(row, before if before and before[4] != row[4] else None, after if after and after[4] != row[4] else None)
        best = max(row[5], across, key=lambda c: c[0])
        if row[3] and best[0]:
            fixed.append((row[1], row[2], *best))
    columns = ("block", "at", "k", "reference", "place")
    return (found.where("task is null").select(*columns)
            .unionByName(found.sparkSession.createDataFrame(fixed, "block long, at int, k int, reference long, place int")))


def greedy(hits: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Factors (first window, last window, reference, place) of a block from the longest copies (place in the block,
    windows, reference, place) of its places, ascending."""
    out: list[tuple[int, int, int, int]] = []
    free = 0  # the window that crosses the end of the last factor
    for at, k, reference, place in hits:
        if at >= free:
            out.append((at, at + k - 1, reference, place))
            free = at + k
    return out


def factors(names: DataFrame) -> DataFrame:
    """block, a, b, reference, place: greedy factors of every block against all the others."""
    hits = copies(names).groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "k", "reference", "place"))).alias("hits"))  # at most a seed's reach of windows

    def run(batches):
        for b in batches:
            rows = [(block, *f) for block, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)
                    for f in greedy([(h["at"], h["k"], h["reference"], h["place"]) for h in x])]
            cols = list(zip(*rows, strict=True)) or [[]] * 5
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=["block", "a", "b", "reference", "place"])

    return hits.mapInArrow(run, "block long, a int, b int, reference long, place int")


def removed_words(docs: DataFrame, length: int = 35, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    units = repeats.Units("words", length, min(seed, length))
    runs = repeats.candidates(docs, units)
    blocks = stored(repeats.blocks(runs), "reference-blocks")
    names = stored(repeats.block_texts(docs, blocks, window_names(units), "block long, parsed boolean, names binary"), "reference-names")
    ranges = repeats.covered(runs, blocks, factors(names))

    def digest(text: bytes, found: list) -> tuple:
        words = text.split()
        gone = repeats.removed_mask(len(words), found, length)
        kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]) if found else b" ".join(words)
        return len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest()

    return repeats.apply(docs, ranges, digest, "doc_id long, n_words long, n_removed long, kept_sha256 string", ["n_words", "n_removed", "kept_sha256"])

"""Suffix-array deduplication (operator 8).

Removes every byte that lies in a ``length``-byte string which also starts anywhere else.
Candidate blocks (see ``repeats``) are ordered as suffixes that start at their anchor:

1. Spark samples splitters and range-partitions the suffixes by their leading bytes, as many
   as an anchor string has; blocks of one anchor string meet in one bucket.
2. Each bucket sorts its suffixes by multikey quicksort (eight bytes a key; later keys are
   compared among ties only) and the reversed texts before the anchors likewise, and takes
   the common prefix of neighbours in both orders.
3. The window that begins o bytes before the anchor occurs again exactly if another
   block agrees in length-o bytes from the anchor on and in o bytes before it: same group in
   both orders, cut where neighbours share less. This is decided for every o.
4. An anchor string with more than ``largest`` distinct blocks is dealt over several parts,
   which the splitters may put on both sides of a bucket boundary. Its blocks therefore also
   give their windows by hash, one row per distinct window and bucket, and these are
   compared across the boundaries by a grouped count.

Defined results: NULL text = empty text (0 bytes, hash of nothing); rows that repeat a
doc_id or a text are documents of their own, so their strings occur elsewhere; texts shorter
than ``length`` lose nothing; NULL doc_id is kept; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm import repeats
from ledgerlens.llm.common import shuffle_partitions, stored

SEED_SHARE = 0.5  # of the window: longer seeds mean more anchors, but fewer mixed ones
LARGEST = 100_000  # distinct blocks of one anchor string that a bucket takes whole
SUFFIXES = "lead binary, part int, suffix binary, before binary, block long, many boolean, least int, split boolean"
FOUND = "block long, a int, b int, window long, bucket int"


def as_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of big-endian 64-bit keys (zero-padded) and their lengths."""
    lens = np.array([len(t) for t in texts], np.int64)
    width = max(8, -(-int(lens.max(initial=0)) // 8) * 8)
    return np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), ">u8").reshape(len(texts), -1).astype(np.uint64), lens


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """Row order: sort by one key, then only the runs of equal keys by the next."""
    order = np.argsort(keys[:, 0], kind="quicksort")
    out = order
    tied = keys[order[1:], 0] == keys[order[:-1], 0]
    group = np.concatenate(([0], np.cumsum(~tied)))
    for k in range(1, keys.shape[1]):
        if not tied.any():
            break
        open_ = np.concatenate((tied, [False])) | np.concatenate(([False], tied))  # rows in runs longer than one
        at = np.flatnonzero(open_)
        sub = out[at]
        out[at] = sub[np.lexsort((keys[sub, k], group[at]))]
        tied = tied & (keys[out[1:], k] == keys[out[:-1], k])
        group = np.concatenate(([0], np.cumsum(~tied)))
    return out


def neighbour_prefix(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common bytes, padding included, of each row with the one before it in order (first: 0).
    Only rows at least as long as a cut are compared at that cut, so padding never counts."""
    if len(order) < 2:
        return np.zeros(len(order), np.int64)
    a, b = keys[order[1:]], keys[order[:-1]]
    diff = a != b
    first = np.where(diff.any(axis=1), diff.argmax(axis=1), keys.shape[1] - 1)
    x = (a[np.arange(len(first)), first] ^ b[np.arange(len(first)), first])
    lead = np.full(len(x), 8, np.int64)
    for k in range(7, -1, -1):
        lead = np.where(x >> np.uint64(8 * k) == 0, lead, np.minimum(lead, 7 - k))
    return np.concatenate(([0], 8 * first + lead))


def repeated_offsets(suffixes: list[bytes], before: list[bytes], least: np.ndarray, length: int):
    """(block index, o) flags: the window o bytes before the anchor occurs in another block.
    Offsets of block x run from least[x] to len(before[x])."""
    n = len(suffixes)
    right, _ = as_keys(suffixes)
    left, l_len = as_keys([t[::-1] for t in before])
    r_order, l_order = multikey_quicksort(right), multikey_quicksort(left)
    r_lcp, l_lcp = neighbour_prefix(right, r_order), neighbour_prefix(left, l_order)
    most = int(l_len.max(initial=0))
    flags = np.zeros((n, most + 1), bool)
    r_group, l_group = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(most + 1):
        rows = np.flatnonzero((least <= o) & (l_len >= o))
        if len(rows) < 2:
            continue
        r_group[r_order] = np.cumsum(r_lcp < length - o)
        l_group[l_order] = np.cumsum(l_lcp < o) if o else 0
        pair = r_group[rows] * (n + 1) + l_group[rows]
        _, back, counts = np.unique(pair, return_inverse=True, return_counts=True)
        flags[rows, o] = counts[back] > 1
    return flags


def spans(flags: np.ndarray) -> list[tuple[int, int]]:
    """Runs of true values as (first, last)."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), (edge[1::2] - 1).tolist(), strict=True))


def suffix_rows(units: repeats.Units):
    """Blocks of a document as suffixes from their anchors."""
    w = units.length - units.seed + 1

    def extract(text: bytes, own: list):
        rows = []
        for block, n, first, last, part_no, parts in own:
            part = text[first:last + units.length]
            place = int(np.argmin(units.seeds(part[:units.length])[:w] >> repeats.HASH_BITS))
            rows.append((part[place:place + units.seed], part_no, part[place:], part[:place], block, n > 1, place - (last - first), parts > 1))
        for k in range(0, len(rows), 2000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[k:k + 2000], strict=True), (pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.bool_(), pa.int32(), pa.bool_()), strict=True)],
                                             names=["lead", "part", "suffix", "before", "block", "many", "least", "split"])
    return extract


def bucket_rows(length: int):
    """Sort one bucket; give the repeated ranges of its blocks and the windows of dealt anchor strings."""
    def run(batches):
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        suffix, before, block, many = (t.column(k).to_pylist() for k in range(4))
        least, split = t.column(4).to_numpy(), t.column(5).to_numpy()
        bucket = TaskContext.get().partitionId()
        flags = repeated_offsets(suffix, before, least, length)
        out = []
        for x in range(len(block)):
            if not many[x]:
                place = len(before[x])
                out += [(block[x], place - b, place - a, None, bucket) for a, b in spans(flags[x, :place + 1])]
        seen: set[int] = set()
        for x in np.flatnonzero(split).tolist():
            whole = before[x] + suffix[x]
            for o in range(int(least[x]), len(before[x]) + 1):
                at = len(before[x]) - o
                name = xxhash.xxh3_64_intdigest(whole[at:at + length])
                if name not in seen or not (flags[x, o] or many[x]):
                    seen.add(name)
                    open_ = not (flags[x, o] or many[x])
                    out.append((block[x] if open_ else None, at, at, name - (1 << 64) if name >> 63 else name, bucket))
        for k in range(0, len(out), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out[k:k + 10_000], strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()), strict=True)],
                                             names=["block", "a", "b", "window", "bucket"])
    return run


def repeated_ranges(docs: DataFrame, blocks: DataFrame, units: repeats.Units, largest: int = LARGEST) -> DataFrame:
    """block, a, b: window starts (relative to the block) that occur in another block."""
    dealt = blocks.groupBy("seed").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > largest)
    parts = F.coalesce(F.ceil(F.col("members") / largest), F.lit(1)).cast("int")
    own = blocks.join(dealt, "seed", "left").withColumn("parts", parts).withColumn("part", F.pmod("block", "parts").cast("int"))
    rows = repeats.block_texts(docs, own, suffix_rows(units), SUFFIXES, "part", "parts")
    buckets = (rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "lead", "part")
               .select("suffix", "before", "block", "many", "least", "split").mapInArrow(bucket_rows(units.length), FOUND))
    found = stored(buckets, "suffix-buckets")
    inside = found.where("window is null").select("block", "a", "b")
    edge = found.where("window is not null")
    twice = edge.groupBy("window").agg(F.min("bucket").alias("x"), F.max("bucket").alias("y")).where("x < y").select("window")
    across = edge.where("block is not null").join(twice, "window", "left_semi").select("block", "a", "b")
    return inside.union(across)


def removed_bytes(docs: DataFrame, length: int = 400, largest: int = LARGEST) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document."""
    units = repeats.Units("bytes", length, max(8, int(length * SEED_SHARE)))
    runs = repeats.candidates(docs, units)
    blocks = stored(repeats.blocks(runs), "blocks")
    ranges = repeats.covered(runs, blocks, repeated_ranges(docs, blocks, units, largest))

    def digest(text: bytes, found: list) -> tuple:
        gone = repeats.removed_mask(len(text), found, length)
        kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
        return len(text), int(gone.sum()), len(spans(gone)), hashlib.sha256(kept).hexdigest()

    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]
    return repeats.apply(docs, ranges, digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", names)

"""Periodic run detection by seed and extend on diagonals (operator 13).

A run is a stretch of words with smallest period q, at least ``exponent`` x q and ``shortest``
words long, that no neighbouring word extends. Two words q apart stand on the diagonal of
lag q; a run of length L is a stretch of L-q equal words on it.

1. Seeds: lags are taken in classes [2^j, 2^(j+1)). A run of such a lag overlaps itself in
   at least max(shortest - q, (exponent - 1) x q) words, so the smallest of these over the
   class and the longer lags is the length K of the k-grams that are indexed for it: every run holds one.
2. Pairs: each k-gram is paired with its next occurrence in the same document. As K >= q (``exponent`` is 3 or more),
   an occurrence nearer than q would give the run a smaller period (Fine and Wilf), so
   the next occurrence inside a run is q away, and no other pair of occurrences is needed.
   A k-gram that stands n times gives n - 1 pairs, never n^2.
3. Extension: a seed is extended to both sides on its diagonal, words compared themselves.
   A table per document and lag holds how far the diagonal is covered; seeds before that
   place are inside a stretch that was extended already and are passed over.

All is row by row: Spark deals the documents, a task holds one Arrow batch of texts, and the
words of at most ``BYTES_AT_ONCE`` bytes of it (a longer text is taken alone) at a time.

Defined results: NULL, empty or word-less text has no run, four NULLs and the hashes of the
empty text; NULL doc_id is kept as it is; rows that repeat a document get the same result,
one row each; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import for_python, text_or_empty

BYTES_AT_ONCE = 1 << 22
MIX, OTHER = np.uint64(0x9E3779B185EBCA87), np.uint64(0xC2B2AE3D27D4EB4F)
FOUND = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def seed_length(lag: int, shortest: int, exponent: int) -> int:
    """Words that a run of any lag from ``lag`` on overlaps itself in, at least. From ``shortest`` on
    the overlap only grows with the lag."""
    return min(max(shortest - q, (exponent - 1) * q) for q in range(lag, max(2 * lag, shortest)))


def repeated(grams: np.ndarray) -> np.ndarray:
    """Places, ascending, that hold all values standing more than once (and few others): one
    sort of the leading bits with the place in the low bits."""
    bits = np.uint64(max(1, int(len(grams)).bit_length()))
    key = np.sort(grams >> bits << bits | np.arange(len(grams), dtype=np.uint64))
    same = key[1:] >> bits == key[:-1] >> bits
    held = np.concatenate((same, [False])) | np.concatenate(([False], same)) if len(key) else np.zeros(0, bool)
    return np.sort((key[held] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64))


def next_occurrence(grams: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of the ascending places ``at``: those whose value stands at another one of them, and how
    far ahead it stands next (0: nowhere)."""
    values = grams[at]
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    ahead, again = np.zeros(len(at), np.int64), np.zeros(len(at), bool)
    ahead[order[:-1][same]] = (at[order[1:]] - at[order[:-1]])[same]
    again[order[:-1][same]] = again[order[1:][same]] = True
    return at[again], ahead[again]


def reach(equal: Callable[[int, int], np.ndarray], most: int) -> int:
    """How many leading values of ``equal(from, to)`` are true, looked up in growing pieces."""
    at, step = 0, 64
    while at < most:
        part = equal(at, min(most, at + step))
        if not part.all():
            return at + int(np.argmin(part))
        at, step = at + len(part), 2 * step
    return most


def stretch(ids: np.ndarray, i: int, lag: int, low: int, high: int) -> tuple[int, int]:
    """First and end place x of the stretch with ids[x] = ids[x + lag] around place i, inside a
    document that stands at [low, high)."""
    right = reach(lambda a, b: ids[i + a:i + b] == ids[i + a + lag:i + b + lag], high - lag - i)
    left = reach(lambda a, b: (ids[i - b:i - a] == ids[i - b + lag:i - a + lag])[::-1], i - low)
    return i - left, i + right


def runs(ids: np.ndarray, ends: np.ndarray, shortest: int = 6, exponent: int = 4) -> list[tuple[int, int, int, int]]:
    """(document, start, length, period) of all runs of documents that stand one after the other
    in ``ids`` and end at ``ends``; starts count from the document's first word."""
    starts = np.concatenate(([0], ends[:-1]))
    longest = int((ends - starts).max(initial=0))
    doc = np.repeat(np.arange(len(ends)), ends - starts)
    out: list[tuple[int, int, int, int]] = []
    gram, have = (ids.astype(np.uint64) + doc.astype(np.uint64) * OTHER) * MIX, 1  # hash of the document and the `have` words from each place on
    gram ^= gram >> np.uint64(29)
    at = None
    lag = 1
    while exponent * lag <= longest:
        k = seed_length(lag, shortest, exponent)
        while have < k:  # two overlapping shorter grams make a longer one
            step = min(have, k - have)
            gram = gram[:-step] * MIX + (gram[step:] ^ gram[step:] >> np.uint64(31))
            gram ^= gram >> np.uint64(29)
            have += step
        # A longer gram that repeats begins with a shorter one that does, so the places only get fewer.
        at = repeated(gram) if at is None else at[at < len(gram)]
        at, ahead = next_occurrence(gram, at)
        if not len(at):
            break
        # Both k-grams inside one document: a gram over a border is no place of a document.
        own = (ahead >= lag) & (ahead < 2 * lag) & (at + ahead + k <= ends[doc[at]])
        covered: dict[tuple[int, int], int] = {}
        for i, q, d in zip(at[own].tolist(), ahead[own].tolist(), doc[at[own]].tolist(), strict=True):
            if i < covered.get((d, q), 0):
                continue
            first, end = stretch(ids, i, q, int(starts[d]), int(ends[d]))
            covered[d, q] = end
            if end > i and end - first + q >= max(shortest, exponent * q):
                out.append((d, first - int(starts[d]), end - first + q, q))
        lag *= 2
    return sorted(out, key=lambda r: (r[0], r[1], r[3]))


def cyclic(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words, of one document in ten (by the CRC of its id) with a periodic end."""
    h = zlib.crc32(b"%d" % doc_id) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def pieces(lengths: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of documents of at most ``BYTES_AT_ONCE`` together, or one document."""
    first = total = 0
    for k, n in enumerate(lengths):
        if k > first and total + n > BYTES_AT_ONCE:
            yield first, k
            first, total = k, 0
        total += n
    if first < len(lengths):
        yield first, len(lengths)


def collapsed(words: list[bytes], found: list[tuple[int, int, int]]) -> bytes:
    """The words that no run (start, length, period) holds after its first period, joined by spaces."""
    if not found:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    r = np.array(found)
    np.add.at(step, r[:, 0] + r[:, 2], 1)
    np.add.at(step, r[:, 0] + r[:, 1], -1)
    gone = np.cumsum(step[:-1]) > 0
    return b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def digest(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """A result row of a document without its id; ``found``: (start, length, period), ascending."""
    text = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    hashes = (hashlib.sha256(text.encode()).hexdigest(), hashlib.sha256(collapsed(words, found)).hexdigest())
    if not found:
        return (0, None, None, None, None, *hashes)
    s, n, q = min(found, key=lambda r: (-r[1], r[0], r[2]))
    return (len(found), s, n, q, 1000 * n // q, *hashes)


def documents_runs(words: list[list[bytes]], shortest: int = 6, exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each document, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    flat = [w for own in words for w in own]
    if flat:
        ids = pd.factorize(np.array(flat, dtype=object))[0]
        for d, s, n, q in runs(ids, np.cumsum([len(w) for w in words]), shortest, exponent):
            out[d].append((s, n, q))
    return out


def periodic_runs(docs: DataFrame, shortest: int = 6, exponent: int = 4) -> DataFrame:
    """doc_id, runs (array of start, length, period): all runs of every document's own words."""
    return _mapped(docs, lambda i, w: w, lambda i, w, r: (i, [{"start": s, "length": n, "period": q} for s, n, q in r]),
                   "doc_id long, runs array<struct<start:long,length:long,period:long>>", shortest, exponent)


def collapsed_runs(docs: DataFrame, shortest: int = 6, exponent: int = 4, change: Callable = cyclic) -> DataFrame:
    """One row per document: its runs counted and hashed, the longest one, and the hash of the
    text without repetitions. ``change(doc_id, words)`` is applied to the words first."""
    return _mapped(docs, change, lambda i, w, r: (i, *digest(w, r)), FOUND, shortest, exponent)


def _mapped(docs: DataFrame, change: Callable, row: Callable, schema: str, shortest: int, exponent: int) -> DataFrame:
    if exponent < 3 or shortest < 2:
        raise ValueError("k-grams reach over a period only from three periods on; a run has at least two words")
    for_python(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))
    out_type = _arrow(schema)

    def run(batches):
        for b in batches:
            for k, end in pieces(pc.binary_length(b.column(1)).to_pylist()):
                ids, texts = (b.column(c).slice(k, end - k).to_pylist() for c in (0, 1))
                words = [change(i, t.split()) for i, t in zip(ids, texts, strict=True)]
                rows = [row(*x) for x in zip(ids, words, documents_runs(words, shortest, exponent), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), out_type, strict=True)], schema=out_type)

    return src.mapInArrow(run, schema)


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))

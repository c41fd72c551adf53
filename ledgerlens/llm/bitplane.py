"""Token-ID output: bit-plane shuffled shards (operator 2).

Documents are range-partitioned by id, each range is tokenised and written as one
binary shard or, where it is long, as several, and the shards in order are the token stream. A shard holds fixed-size
blocks of ids; a block is transposed into byte planes (plane *p* = byte *p* of every
id) or bit planes (plane *b* = bit *b* of every id, packed), and every plane is
compressed on its own with zstandard: the high planes of ids below 2^16 are nearly
constant and shrink to a few bytes. The footer is the chunk index (offset, ids and
plane lengths of each block) and the document index (ids, lengths), so a reader can
fetch any block without the ones before it.

Layout, little endian::

    magic(8)  block 0: plane 0 | plane 1 | ...   block 1 ...   footer  footer_length(u64)  magic(8)

Recovery: a shard is written under a name of its own attempt and then renamed, and its
bytes depend on its rows alone, so a repeated or speculative task leaves the same file.

Defined results: NULL text = empty text (only the end id); NULL doc_id sorts first;
rows that share a doc_id are separate documents, ordered by the hash of their text;
an empty table gives no shard and no row; other columns are not read.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import compress, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import shuffle_partitions, for_python, stored, text_or_empty
from ledgerlens.llm.wordcache import PLAIN, Vocabulary, WordCache, of_worker
from ledgerlens.session import scratch_path

MAGIC = b"LLPLANE1"
BLOCK_IDS = 1 << 16
SHARD_IDS = 1 << 26  # a shard that reached this many ids is closed and the next part of its range begins
GROUP_BYTES = 1 << 21
WORD_BYTES = 160 << 20  # of one generation of a worker's cache of words
LINES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9\n]|[^a-zß-öø-ÿ0-9\n]+")  # PIECES, and line ends by themselves
NO_ID = b"\xff" * 4  # never within ids below 2^24, at any offset
GAP = re.compile(rb"[ \t-\r]")
PLANES = {"byte": 4, "bit": 32}

SHARDS = T.StructType([
    T.StructField("shard", T.IntegerType()), T.StructField("part", T.IntegerType()), T.StructField("path", T.StringType()),
    T.StructField("n_docs", T.LongType()), T.StructField("n_ids", T.LongType()),
    T.StructField("n_blocks", T.IntegerType()), T.StructField("n_bytes", T.LongType())])
SHARD_ROW = pa.schema([("shard", pa.int32()), ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                       ("n_blocks", pa.int32()), ("n_bytes", pa.int64())])
DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])


# -- planes ------------------------------------------------------------------------------
def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids."""
    by = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4).T
    if kind == "byte":
        return [p.tobytes() for p in by]
    return [np.packbits((by[b >> 3] >> (b & 7)) & 1, bitorder="little").tobytes() for b in range(32)]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    by = np.zeros((n, 4), np.uint8)
    for k, p in enumerate(planes):
        raw = np.frombuffer(p, np.uint8)
        if kind == "byte":
            by[:, k] = raw
        else:
            by[:, k >> 3] |= np.unpackbits(raw, count=n, bitorder="little") << (k & 7)
    return by.reshape(-1).view("<u4")


# -- tokens ------------------------------------------------------------------------------
class WordIds:
    """Little-endian ids of whole texts: each distinct word is split into pre-tokens once
    and each distinct pre-token is encoded by the library once (bounded caches)."""

    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        self.pieces = WordCache(lambda pieces: [array("I", self.vocabulary.ids(p.encode())).tobytes() for p in pieces])
        self.words = WordCache(self._words, WORD_BYTES)

    def _words(self, words: list[bytes]) -> list[bytes]:
        texts = [w.decode("utf-8", "replace") for w in words]
        plain = [PLAIN.fullmatch(t) and "<|" not in t for t in texts]
        pieces = LINES.findall("\n".join(compress(texts, plain)).lower())
        distinct = [*{*pieces}.difference("\n")]
        ids = dict(zip(distinct, self.pieces.of(distinct), strict=True))
        ids["\n"] = NO_ID
        split = iter(b"".join(map(ids.__getitem__, pieces)).split(NO_ID))
        return [next(split) if p else self._word(w) for p, w in zip(plain, words, strict=True)]

    def _word(self, word: bytes) -> bytes:
        return b"".join(array("I", [p] if isinstance(p, int) else self.vocabulary.ids(p)).tobytes() for p in self.vocabulary.pieces(word))

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text; words are looked up once per group of texts of about GROUP_BYTES."""
        group, held = [], 0
        for t in texts:
            if group and held + len(t) > GROUP_BYTES:
                yield from self._group(group)
                group, held = [], 0
            if len(t) > GROUP_BYTES:
                yield b"".join(ids for part in parts_of(t) for ids in self._group([part]))
            else:
                group.append(t)
                held += len(t)
        yield from self._group(group)

    def _group(self, texts: list[bytes]) -> list[bytes]:
        # Split and coded by Arrow byte by byte; only distinct words become Python objects.
        words = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).view(pa.string()))
        coded = words.values.dictionary_encode()
        distinct = strings(coded.dictionary)
        found = self.words.of(distinct)
        flat = np.frombuffer(b"".join(found), "<u4")
        lens = np.fromiter(map(len, found), np.int64, len(found)) >> 2
        word = coded.indices.to_numpy()
        n = lens[word]
        ends = np.cumsum(n)
        places = np.repeat((np.cumsum(lens) - lens)[word] - ends + n, n) + np.arange(n.sum())
        stream = flat[places].tobytes()
        cuts = (4 * np.concatenate([[0], ends])[words.offsets.to_numpy()]).tolist()
        return [stream[at:to] for at, to in pairwise(cuts)]


def strings(a: pa.StringArray) -> list[bytes]:
    """The bytes of each string, cut from the array's buffers (``to_pylist`` makes a scalar of each)."""
    if not len(a):
        return []
    _, offsets, data = a.buffers()
    raw = data.to_pybytes() if data else b""
    ends = np.frombuffer(offsets, np.int32)[a.offset:a.offset + len(a) + 1].tolist()
    return [raw[at:to] for at, to in pairwise(ends)]


def parts_of(text: bytes) -> Iterator[bytes]:
    """A long text cut at white space into parts of GROUP_BYTES or a little more, none within a word."""
    at = 0
    while at < len(text):
        gap = GAP.search(text, at + GROUP_BYTES)
        end = gap.end() if gap else len(text)
        yield text[at:end]
        at = end


def encoder(path: str) -> WordIds:
    return of_worker("bitplane", path, lambda: WordIds(path))


# -- files -------------------------------------------------------------------------------
def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


class ShardWriter:
    """Streams the ids of one shard into blocks; holds one block at a time."""

    def __init__(self, out, kind: str):
        self.out, self.kind, self.at = out, kind, len(MAGIC)
        self.zip = zstandard.ZstdCompressor(level=3)
        self.held: list[bytes] = []
        self.held_bytes = self.n_ids = 0
        self.blocks: list[list] = []
        self.doc_ids, self.known, self.lens = array("q"), bytearray(), array("q")
        out.write(MAGIC)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id or 0)
        self.known.append(doc_id is not None)
        self.lens.append(len(ids) // 4)
        self.held.append(ids)
        self.held_bytes += len(ids)
        if self.held_bytes >= 4 * BLOCK_IDS:
            self._flush(False)

    def _flush(self, last: bool) -> None:
        raw = b"".join(self.held)
        step = 4 * BLOCK_IDS
        cut = len(raw) if last else len(raw) - len(raw) % step
        for k in range(0, cut, step):
            ids = np.frombuffer(raw, "<u4", count=min(step, cut - k) // 4, offset=k)
            planes = [self.zip.compress(p) for p in to_planes(ids, self.kind)]
            self.blocks.append([self.at, len(ids), [len(p) for p in planes]])
            self.out.write(b"".join(planes))
            self.at += sum(map(len, planes))
            self.n_ids += len(ids)
        self.held, self.held_bytes = ([raw[cut:]], len(raw) - cut) if cut < len(raw) else ([], 0)

    def close(self) -> int:
        self._flush(True)
        parts = [json.dumps({"planes": self.kind, "block_ids": BLOCK_IDS, "n_docs": len(self.lens), "blocks": self.blocks}).encode(),
                 np.array(self.doc_ids, "<i8").tobytes(), bytes(self.known), np.array(self.lens, "<i8").tobytes()]
        foot = struct.pack("<4Q", *(len(p) for p in parts)) + self.zip.compress(b"".join(parts))
        self.out.write(foot + struct.pack("<Q", len(foot)) + MAGIC)
        return self.at + len(foot) + 16


def read_footer(f, size: int) -> tuple[dict, list[int | None], np.ndarray]:
    f.seek(size - 16)
    n, magic = struct.unpack("<Q8s", f.read(16))
    if magic != MAGIC:
        raise ValueError("not a bit-plane shard")
    f.seek(size - 16 - n)
    foot = f.read(n)
    lens = struct.unpack("<4Q", foot[:32])
    raw, parts, at = zstandard.ZstdDecompressor().decompress(foot[32:]), [], 0
    for k in lens:
        parts.append(raw[at:at + k])
        at += k
    known = np.frombuffer(parts[2], np.uint8)
    ids = [int(d) if k else None for d, k in zip(np.frombuffer(parts[1], "<i8"), known, strict=True)]
    return json.loads(parts[0]), ids, np.frombuffer(parts[3], "<i8")


def read_blocks(f, head: dict, first: int = 0) -> Iterator[np.ndarray]:
    """The ids block by block, from block ``first`` on (the chunk index gives its place)."""
    unzip = zstandard.ZstdDecompressor()
    for at, n, sizes in head["blocks"][first:]:
        f.seek(at)
        yield from_planes([unzip.decompress(f.read(k)) for k in sizes], n, head["planes"])


# -- jobs --------------------------------------------------------------------------------
def write_shards(docs: DataFrame, root: str, tokenizer: str, end_id: int | None = 1, planes: str = "byte",
                 shard_ids: int = SHARD_IDS) -> DataFrame:
    """Tokenise and write every document, ascending doc_id; returns the shard table
    (range and part ascending = document order, one row per shard). A range's next part begins
    when a shard has ``shard_ids`` ids, so what a task holds of a shard is bounded but for one document."""
    spark = docs.sparkSession
    for_python(spark)
    end = b"" if end_id is None else struct.pack("<I", end_id)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))
    src = src.withColumn("h", F.xxhash64("t"))
    parts = shuffle_partitions(spark)

    def write(batches):
        store, base = _store(root)
        shard, attempt, part = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId(), 0
        mine = f"{base}/_attempt-{shard:06d}-{attempt}"
        out = w = None

        def close() -> pa.RecordBatch:
            name = f"{base}/shard-{shard:06d}-{part:04d}.ids"
            n = w.close()
            out.close()
            store.move(mine, name)
            row = {"shard": shard, "part": part, "path": name, "n_docs": len(w.lens), "n_ids": w.n_ids, "n_blocks": len(w.blocks), "n_bytes": n}
            return pa.RecordBatch.from_pylist([row], schema=SHARD_ROW)

        for b in batches:
            for d, ids in zip(b.column(0).to_pylist(), encoder(tokenizer).encode(b.column(1).to_pylist()), strict=True):
                if w is None:
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(mine)
                    w = ShardWriter(out, planes)
                w.add(d, ids + end)
                if w.n_ids + w.held_bytes // 4 >= shard_ids:
                    yield close()
                    w, part = None, part + 1
        if w is not None:
            yield close()

    return stored(src.repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "t")
                  .mapInArrow(write, SHARDS), "bitplane-shards")


def read_shards(shards: DataFrame, root: str) -> DataFrame:
    """Decode every shard: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The driver adds up one row per shard (one per shuffle partition, or per ``SHARD_IDS`` ids) to get
    each shard's first position; the ids themselves are read by tasks, block by block.
    """
    spark = shards.sparkSession
    base, rows = 0, []
    for r in shards.orderBy("shard", "part").select("path", "n_ids").toLocalIterator():
        rows.append((r.path, base))
        base += r.n_ids
    out = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def read(batches):
        store, _ = _store(root)
        for b in batches:
            for path, first in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with store.open_input_file(path) as f:
                    head, doc_ids, lens = read_footer(f, f.size())
                    blocks = read_blocks(f, head)
                    held, crcs, left = b"", [], 0
                    for n in lens.tolist():
                        crc, want = 0, 4 * n
                        while want:
                            if left == len(held):
                                held, left = next(blocks).tobytes(), 0
                            part = held[left:left + want]
                            crc = zlib.crc32(part, crc)
                            left += len(part)
                            want -= len(part)
                        crcs.append(crc)
                starts = first + np.cumsum(lens) - lens
                for k in range(0, len(lens), 10_000):
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[k:k + 10_000], pa.int64()), pa.array(starts[k:k + 10_000], pa.int64()),
                                                      pa.array(lens[k:k + 10_000], pa.int64()), pa.array(crcs[k:k + 10_000], pa.int64())], schema=out)

    paths = spark.createDataFrame(rows, "path string, first long")
    return paths.repartition(max(1, len(rows))).mapInArrow(read, DOCS)


def encode_corpus(docs: DataFrame, tokenizer: str, end_id: int | None = 1, planes: str = "byte", root: str | None = None) -> DataFrame:
    """Write the shards below ``root`` (default: the shared scratch folder) and read them back."""
    if planes not in PLANES:
        raise ValueError(f"planes must be one of {sorted(PLANES)}")
    root = root or scratch_path(docs.sparkSession, "bitplane")
    return read_shards(write_shards(docs, root, tokenizer, end_id, planes), root)

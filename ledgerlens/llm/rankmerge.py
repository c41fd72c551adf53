"""Token counts by rank-synchronous merging (operator 5).

Counts the tokens that a byte-pair tokenizer would give, without building them: the
distinct pre-tokens of a batch lie side by side in one ragged numpy array of symbols;
in every round each sequence finds its lowest-rank adjacent pair and all its places are
merged at once, for all sequences together; finished sequences leave the array. What
survives is counted.

Merging every place of the lowest-rank pair at once equals the library's one-by-one
order because a merge can only make pairs of higher rank than its own (each symbol is
made by one rule, and rules that use it come later); runs like ``aaa`` merge from the left.

Defined results: NULL text counts as empty (0 bytes, 0 tokens); repeated rows and
doc_ids give one row each; special strings inside a text count as one token each, the
library's default; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import for_python, text_or_empty
from ledgerlens.llm.wordcache import Vocabulary, WordCache, of_worker

NONE = np.int32(2**31 - 1)
COUNTS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])


class RankCounter:
    def __init__(self, path: str):
        self.vocabulary = Vocabulary(path)
        model = self.vocabulary.spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"] or ""
        self.inner = np.array([vocab[c] for c in self.vocabulary.letters], np.int64)
        self.final = np.array([vocab[c + suffix] for c in self.vocabulary.letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.pieces = WordCache(lambda pieces: self.merge(pieces).tolist())
        self.words = WordCache(self._words)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def merge(self, tokens: list[bytes]) -> np.ndarray:
        """Surviving symbols of each (non-empty) pre-token."""
        out = np.zeros(len(tokens), np.int64)
        lens = np.array([len(t) for t in tokens], np.int64)
        raw = np.frombuffer(b"".join(tokens), np.uint8)
        sym, last = self.inner[raw], np.zeros(len(raw), bool)
        last[np.cumsum(lens) - 1] = True
        sym[last] = self.final[raw[last]]
        ranks = np.full(len(sym), NONE, np.int32)
        if len(sym) > 1:
            ranks[:-1] = self.rank(sym[:-1], sym[1:])
        ranks[last] = NONE
        who = np.arange(len(tokens))
        while len(who):
            starts = np.cumsum(lens) - lens
            low = np.minimum.reduceat(ranks, starts)
            done = low == NONE
            if done.any():
                out[who[done]] = lens[done]
                stay = np.repeat(~done, lens)
                sym, ranks, last = sym[stay], ranks[stay], last[stay]
                who, lens, low = who[~done], lens[~done], low[~done]
                if not len(who):
                    break
            at = np.flatnonzero(ranks == np.repeat(low, lens))
            if len(at) > 1:  # neighbouring places overlap: take every other one from the left
                new_run = np.ones(len(at), bool)
                new_run[1:] = at[1:] != at[:-1] + 1
                run_start = np.maximum.accumulate(np.where(new_run, np.arange(len(at)), 0))
                at = at[(np.arange(len(at)) - run_start) % 2 == 0]
            sym[at] = self.made[ranks[at]]
            last[at] = last[at + 1]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            seq = np.repeat(np.arange(len(who)), lens)
            lens = lens - np.bincount(seq[at], minlength=len(who))
            place = np.cumsum(keep) - 1
            sym, ranks, last = sym[keep], ranks[keep], last[keep]
            here = place[at]
            again = np.concatenate((here, here[here > 0] - 1))
            inside = again[~last[again]]
            ranks[again] = NONE
            ranks[inside] = self.rank(sym[inside], sym[inside + 1])
        return out

    def _words(self, words: list[bytes]) -> list[int]:
        split = [self.vocabulary.pieces(w) for w in words]
        n = self.pieces.values([[p for p in parts if isinstance(p, bytes)] for parts in split])
        return [sum([n(p) if isinstance(p, bytes) else 1 for p in parts]) for parts in split]

    def count(self, texts: list[bytes]) -> list[int]:
        words = [t.split() for t in texts]
        n = self.words.values(words)
        return [sum(map(n, w)) for w in words]


def counter(path: str) -> RankCounter:
    return of_worker("rankmerge", path, lambda: RankCounter(path))


def token_counts(docs: DataFrame, tokenizer: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit of every whole text."""
    for_python(docs.sparkSession)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("t"))

    def count(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            n = counter(tokenizer).count(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(t) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([k > limit for k in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return src.mapInArrow(count, COUNTS)

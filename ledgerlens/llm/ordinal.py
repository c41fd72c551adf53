"""Quality classifier: ordinal cumulative-link regression (operator 1).

Graded ratings 0 < 1 < ... < K-1 are modelled with one weight vector w over hashed text
features, shared by all grades, and K-1 ordered thresholds: P(grade >= k) = sigmoid(w.x - t_k),
with t_1 <= t_2 <= ... kept ordered by construction (t_k = t_1 + sums of squares).
A document's expected grade is the sum of its tail probabilities; selection keeps a
document when the tail probability of the wanted grade reaches a cut.

Features: for each white-space word, its letters and digits in lower case, and its shape
(punctuation around it, all capitals), and for the text the shares of distinct and of
shaped words in quarters; all hashed into ``bits`` buckets, present or absent per
document, so that length does not dilute a few telling words. Buckets seen in fewer than
``min_docs`` rated documents are not used, and an L1 penalty keeps the telling ones.

Fit: on at most ``max_rated`` rated documents, the first by a seeded hash of doc_id (the
documented bound): Spark finds them and extracts their features, the driver gets bucket
ids only (a few hundred numbers a document) and fits the parameter vector.
Scoring covers every whole text, in parallel.

Defined results: NULL or empty text has no features and is scored by the thresholds
alone; rated ids without a document are ignored; NULL ratings are ignored; repeated
ratings of a doc_id count by the lowest grade; with fewer than two distinct grades there
is nothing to learn and every document is scored 1 and kept; repeated documents score alike; of the rows
that repeat a rated doc_id, the one with the smallest text hash is fitted.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import fresh, for_python, stored, text_or_empty
from ledgerlens.llm.wordcache import WordCache, of_worker

SEED = 7
CORE = re.compile(r"[\W_]+")


class Features:
    """Bucket ids of a text's distinct features."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.words = WordCache(lambda words: [self._of(w) for w in words])

    def _bucket(self, name: str) -> int:
        return xxhash.xxh64_intdigest(name.encode(), SEED) & self.mask

    def _of(self, word: bytes) -> tuple[int, ...]:
        text = word.decode("utf-8", "replace")
        core = CORE.sub("", text).lower()
        shape = CORE.findall(text)
        out = []
        if core:
            out.append(self._bucket(core))
        if shape or (len(core) > 1 and text.isupper()):
            kind = "\0" + "\0".join(shape) + ("\0A" if len(core) > 1 and text.isupper() else "")
            out.append(self._bucket(kind))
        return tuple(out)

    def of(self, texts: list[bytes]) -> list[set[int]]:
        out: list[set[int]] = []
        for k in range(0, len(texts), 64):
            words = [t.split() for t in texts[k:k + 64]]
            ids = self.words.values(words)
            for w in words:
                own = set(w)
                found = set().union(*map(ids, own))
                if len(w) >= 10:
                    shaped = sum(len(ids(x)) > 1 for x in own)
                    found.add(self._bucket(f"\1distinct{4 * len(own) // len(w)}"))
                    found.add(self._bucket(f"\1shaped{4 * shaped // len(own)}"))
                out.append(found)
        return out


def features(bits: int) -> Features:
    return of_worker("ordinal", bits, lambda: Features(bits))


def sigmoid(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def thresholds(free: np.ndarray) -> np.ndarray:
    """Ordered thresholds from free parameters."""
    return free[0] + np.concatenate(([0.0], np.cumsum(free[1:] ** 2)))


def loss_and_gradient(grades: np.ndarray, owner: np.ndarray, cols: np.ndarray, w: np.ndarray, free: np.ndarray):
    """Sum over documents of the binary log losses of "grade >= k", and its gradient."""
    s = np.bincount(owner, weights=w[cols], minlength=len(grades))
    t = thresholds(free)
    above = (grades[:, None] >= np.arange(1, len(t) + 1)).astype(float)
    p = sigmoid(s[:, None] - t)
    loss = -(above * np.log(p + 1e-12) + (1 - above) * np.log(1 - p + 1e-12)).sum()
    err = p - above
    gw = np.bincount(cols, weights=err.sum(axis=1)[owner], minlength=len(w))
    per = -err.sum(axis=0)
    gt = np.array([per.sum(), *(2 * free[k] * per[k:].sum() for k in range(1, len(free)))])
    return loss, gw, gt


class Model:
    def __init__(self, bits: int, weights: dict[int, float], cuts: list[float]):
        self.bits, self.weights, self.cuts = bits, weights, cuts

    def scores(self, texts: list[bytes]) -> np.ndarray:
        get = self.weights.get
        return np.array([sum(get(f, 0.0) for f in ids) for ids in features(self.bits).of(texts)], float)

    def tails(self, texts: list[bytes]) -> np.ndarray:
        """P(grade >= k) for k = 1..K-1, one row per text."""
        s = self.scores(texts)
        return np.ones((len(texts), 0)) if not self.cuts else sigmoid(s[:, None] - np.array(self.cuts))


def fit(docs: DataFrame, ratings: DataFrame, grades: int, max_rated: int = 20_000, bits: int = 18, min_docs: int = 15,
        steps: int = 200, rate: float = 0.15, l1: float = 2e-3) -> Model:
    """``ratings``: doc_id, grade (0..grades-1). Proximal gradient steps scaled per parameter."""
    for_python(docs.sparkSession)
    rated = (ratings.select(F.col("doc_id").cast("long").alias("id"), F.col("grade").cast("int").alias("grade"))
             .where("id is not null and grade is not null").groupBy("id").agg(F.min("grade").alias("grade")))
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), text_or_empty().cast("binary").alias("t"))
    known = rated.join(texts.select("id").distinct(), "id", "left_semi")
    sample = stored(known.orderBy(F.xxhash64(F.lit(SEED), "id"), "id").limit(max_rated), "rated")  # two numbers a row

    def extract(batches):
        for b in batches:
            ids = [sorted(x) for x in features(bits).of(b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["id", "grade", "f"])

    # One row per rated id, so that max_rated bounds the rows on the driver.
    one = texts.join(sample, "id").groupBy("id", "grade").agg(F.min_by("t", F.xxhash64("t")).alias("t"))
    rows = one.select("id", "grade", "t").mapInArrow(extract, "id long, grade int, f array<int>").toArrow()
    rows = rows.sort_by([("id", "ascending")])
    g = rows["grade"].to_numpy()
    if len(np.unique(g)) < 2:
        return Model(bits, {}, [])
    lists = rows["f"].combine_chunks()
    owner = np.repeat(np.arange(len(g)), lists.value_lengths().to_numpy())
    cols = lists.flatten().to_numpy()
    used = np.flatnonzero(np.bincount(cols, minlength=1 << bits) >= min(min_docs, max(1, len(g) // 100)))
    place = np.full(1 << bits, -1)
    place[used] = np.arange(len(used))
    inside = place[cols] >= 0
    owner, cols = owner[inside], place[cols[inside]]
    w, free = np.zeros(len(used)), np.concatenate(([-1.0], np.ones(grades - 2)))
    m, v = np.zeros(len(w) + len(free)), np.zeros(len(w) + len(free))
    for step in range(1, steps + 1):
        _, gw, gt = loss_and_gradient(g, owner, cols, w, free)
        d = np.concatenate((gw, gt)) / len(g)
        m, v = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
        pace = rate * (1 - step / (steps + 1)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        at = np.concatenate((w, free)) - pace * m / (1 - 0.9**step)
        w, free = at[:len(w)], at[len(w):]
        w = np.sign(w) * np.maximum(np.abs(w) - l1 * pace[:len(w)], 0)
    return Model(bits, {int(b): float(x) for b, x in zip(used, w, strict=True) if x}, thresholds(free).tolist())


def scored(docs: DataFrame, model: Model, grade: int, name: str = "score") -> DataFrame:
    """``docs`` with one more column ``name``: struct(expected_grade, tail), where tail is
    the probability of ``grade`` or more. All rows and columns stay."""
    for_python(docs.sparkSession)

    @F.pandas_udf("expected_grade double, tail double")
    def score(texts: pd.Series) -> pd.DataFrame:
        p = model.tails(texts.tolist())
        return pd.DataFrame({"expected_grade": p.sum(axis=1), "tail": p[:, grade - 1] if model.cuts else np.ones(len(p))})

    return docs.withColumn(name, score(text_or_empty().cast("binary")))


def graded(labels: DataFrame) -> DataFrame:
    """Ratings of the labels table: toxic 0, poor quality 1, good 2."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2).alias("grade"))


def accepted(docs: DataFrame, labels: DataFrame, cut: float = 0.5) -> DataFrame:
    """The documents whose probability of the best grade reaches ``cut``."""
    name = fresh(docs, "score")
    return scored(docs, fit(docs, graded(labels), 3), 2, name).where(F.col(f"`{name}`.tail") >= cut).drop(name)

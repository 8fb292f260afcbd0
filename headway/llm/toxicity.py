"""Toxicity scores from FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the words of a text, its word pairs and pairs with one or two words
between, each as a bucket of a hash; a text either has a feature or not. Learning
rates are per coordinate, L1 keeps only buckets that matter, so the weights sent
to the executors are few. The weights are fitted in one task on a bounded sample of
the labelled rows; each further pass starts from the weights of the one before.

Defined results: a null or empty text has the bias alone and gets its score;
without labels of both kinds every score is the share of toxic labels (0.5
without labels). Only labels of documents outside the held-out part are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import WordHashes, add_columns, flat_map, mixed
from headway.llm.langid import held_out

BUCKETS = 1 << 20
#: Rows the weights are fitted on, at most, of either label: a sample by hash.
FIT_ROWS_PER_LABEL = 6_000
PASSES = 3
ALPHA, BETA, L1, L2 = 1.0, 1.0, 6.0, 0.0


def features(hashed: WordHashes, text: str | None) -> np.ndarray:
    """Distinct buckets of words, word pairs and skip-grams; case and punctuation at the ends of words do not count."""
    if not text:
        return np.zeros(0, np.int64)
    words = text.lower().encode().translate(_FOLD).split()
    if not words:
        return np.zeros(0, np.int64)
    h = hashed(words)
    parts = [mixed(h)]
    for gap in (1, 2, 3):
        if len(h) > gap:
            parts.append(mixed(h[:-gap] * np.uint64(0x9E3779B97F4A7C15) + h[gap:] + np.uint64(gap)))
    return np.unique(np.concatenate(parts) & np.uint64(BUCKETS - 1)).astype(np.int64)


_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


class Ftrl:
    """Per-coordinate FTRL-proximal; the bias is the last coordinate and has no penalty."""

    def __init__(self, start: np.ndarray):
        self.n = np.zeros(BUCKETS + 1)
        # z such that the weights start at the given ones
        self.z = np.where(start != 0, -start * (BETA / ALPHA + L2) - np.sign(start) * L1, 0.0)
        self.z[-1] = -start[-1] * BETA / ALPHA

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        w[np.abs(z) <= L1] = 0.0
        return w

    def bias(self) -> float:
        return float(-self.z[-1] / ((BETA + np.sqrt(self.n[-1])) / ALPHA))

    def learn(self, at: np.ndarray, label: int) -> None:
        w, b = self.weights(at), self.bias()
        p = 1 / (1 + np.exp(-np.clip(w.sum() + b, -35, 35)))
        g = p - label
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - sigma * w
        self.n[at] += g * g
        sigma = (np.sqrt(self.n[-1] + g * g) - np.sqrt(self.n[-1])) / ALPHA
        self.z[-1] += g - sigma * b
        self.n[-1] += g * g


def fit(docs: DataFrame, labels: DataFrame, parts: int, part: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) from the labels outside the held-out part."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"), parts, part))
    own = own.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in own.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        share = 0.5 if not counts else float(next(iter(counts)))
        return np.zeros(0, np.int64), np.zeros(0), float(np.log((share + 0.01) / (1.01 - share)))
    slot = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1_000_000))
    limit = F.when(F.col("toxic") == 1, min(1.0, FIT_ROWS_PER_LABEL / counts[1])).otherwise(min(1.0, FIT_ROWS_PER_LABEL / counts[0]))
    chosen = own.where(slot < limit * 1_000_000)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most twice FIT_ROWS_PER_LABEL ids
    rows = rows.select("text", "toxic", F.xxhash64("doc_id", "text").alias("turn"))

    def make():
        hashed, kept = WordHashes(), []

        def work(batch):
            for text, toxic, turn in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                kept.append((turn, features(hashed, text), toxic))
            return ()

        def finish():
            weights = np.zeros(BUCKETS + 1)
            for turn in range(PASSES):
                model = Ftrl(weights)
                for _, x, y in sorted(kept, key=lambda r: r[0] * (2 * turn + 1) % 1_000_003):
                    model.learn(x, y)
                weights = np.append(model.weights(np.arange(BUCKETS)), model.bias())
            nonzero = np.append(np.flatnonzero(weights[:-1]), BUCKETS)
            yield {"bucket": nonzero, "weight": weights[nonzero]}

        work.finish = finish
        return work

    # at most twice FIT_ROWS_PER_LABEL rows, or a little more as the sample is by hash: one task may hold their features
    found = flat_map(rows.repartition(1).sortWithinPartitions("turn"), make, "bucket bigint, weight double").toPandas()
    weights = np.zeros(BUCKETS + 1)
    weights[found["bucket"].to_numpy()] = found["weight"].to_numpy()
    nonzero = np.flatnonzero(weights[:-1])
    return nonzero, weights[nonzero], float(weights[-1])


def toxicity(docs: DataFrame, labels: DataFrame, parts: int = 5, part: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    at, value, bias = fit(docs, labels, parts, part)
    sent = docs.sparkSession.sparkContext.broadcast((at, value, bias))

    def make():
        at, value, bias = sent.value
        dense, hashed = np.zeros(BUCKETS, np.float64), WordHashes()
        dense[at] = value

        def run(texts):
            sums = [float(dense[features(hashed, t)].sum()) + bias for t in texts]
            return [1 / (1 + np.exp(-np.clip(sums, -35, 35)))]
        return run

    scored = add_columns(docs.select("doc_id", "text"), make, {"score": "double"}, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))

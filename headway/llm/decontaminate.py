"""Benchmark decontamination with a BM25 index of the test items and block-max pruning.

The items are cut into units of at most UNIT words and indexed by term. Every
document is cut into overlapping passages, and each passage is a query. Units are
held in blocks, and a block keeps the largest impact of each term in it: a
passage adds up those bounds for its rare words, grants every block the most that
one of its units has in frequent words, skips the blocks that cannot reach the
threshold, and scores only the units of the others. Nothing above the
threshold is lost, as the bounds are upper bounds. Impacts are divided by a
unit's score for itself, so one threshold, a share of the possible score, serves
short and long items. Questions and whole items are indexed once more as units of
their own, searched with all words of a document; their thresholds are what a
document has of them at least if it holds the needed share of their shingles, so
no item is lost, wherever its parts stand. Items found either way are then verified
on the whole text: five-word shingles of the question and of the answer (the last
sentence) have to occur in the document.

The benchmark is read in shards of bounded size, so a large one takes more passes
over the documents and no more memory.

Defined results: null and empty texts or items match nothing; items with fewer
than five words are one shingle; repeated rows are judged alike; rows without a
doc_id are judged too; other columns are not read.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import add_columns, ready_workers

UNIT, STRIDE = 64, 64
#: A passage holds two strides, so any run of STRIDE words lies in one passage whole.
PASSAGE = 2 * STRIDE
#: Share of a unit's own score that a passage has to reach.
THRESHOLD = 0.5
#: Share of the shingles that has to be found.
OVERLAP = 0.8
WIDTH, BLOCK = 5, 2
#: Terms in more than this share of the items count as frequent.
FREQUENT = 0.05
#: Characters of the items of one shard, and the shards that are sent to the executors for one pass over the documents.
SHARD_CHARS, SHARDS_PER_PASS = 200_000, 16
K1, B = 1.2, 0.75

_FOLD = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
#: Punctuation outside ASCII.
_MARKS = "“”‘’„«»–—…¿¡·•"


def normal_words(text: str | None) -> list[bytes]:
    """Lower-cased words without punctuation, as UTF-8."""
    if not text:
        return []
    text = text.lower()
    if not text.isascii():
        for mark in _MARKS:
            if mark in text:
                text = text.replace(mark, " ")
    return text.encode().translate(_FOLD).split()


def question_and_answer(text: str) -> tuple[str, str]:
    """The last sentence answers what stands before it; a single sentence is a question alone."""
    ends = [m.end() for m in re.finditer(r"[.!?]+[\s]+|\n+", text.rstrip())]
    return (text[:ends[-1]], text[ends[-1]:]) if ends else (text, "")


def grams(words: list[bytes]) -> set:
    return {tuple(words[i:i + WIDTH]) for i in range(max(1, len(words) - WIDTH + 1))} if words else set()


def impacts(words: list[bytes], frequency: dict[bytes, int], n_items: int, mean: float) -> dict[bytes, float]:
    """BM25 weights of the words of a unit, as shares of its score for itself."""
    counts, weights = {}, {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    for w, n in counts.items():
        df = frequency.get(w, 1)
        weights[w] = np.log(1 + (n_items - df + 0.5) / (df + 0.5)) * n * (K1 + 1) / (n + K1 * (1 - B + B * len(words) / mean))
    own = sum(weights.values()) or 1.0
    return {w: x / own for w, x in weights.items()}


def least_share(weights: dict[bytes, float], shingles: list[tuple]) -> float:
    """The least that the words of a text weigh if it holds OVERLAP of these shingles.

    A word can only be absent if all its shingles are: with its weight dealt out evenly over them, the absent words weigh
    at most what the heaviest shingles do that may be absent.
    """
    holders: dict[bytes, int] = {}
    for g in shingles:
        for w in set(g):
            holders[w] = holders.get(w, 0) + 1
    dealt = sorted((sum(weights[w] / holders[w] for w in set(g)) for g in shingles), reverse=True)
    absent = int((1 - OVERLAP) * len(shingles) + 1e-9)
    return (1 - sum(dealt[:absent])) * 0.9999


class Parts:
    """Questions and whole items as units, for a search with all words of a document."""

    def __init__(self, items: list[tuple[int, set, set]], words: list[tuple[list, list]], rare: dict[bytes, int], weigh):
        units = []  # (position of the item, least share, weights)
        for at, ((_, question, answer), (asked, answered)) in enumerate(zip(items, words, strict=True)):
            for own, shingles in ((asked, [*question]), (asked + answered, [*question, *answer])):
                if own and (own is asked or answered):
                    weights = weigh(own)
                    units.append((at, least_share(weights, shingles), weights))
        self.rare = rare
        self.blocks = [units[i:i + BLOCK] for i in range(0, len(units), BLOCK)]
        self.bounds = np.zeros((len(rare), len(self.blocks)), np.float32)
        self.needed = np.zeros(len(self.blocks), np.float32)
        for b, block in enumerate(self.blocks):
            for _, _, weights in block:
                for w, x in weights.items():
                    if w in rare:
                        self.bounds[rare[w], b] = max(self.bounds[rare[w], b], x)
            self.needed[b] = min(least - sum(x for w, x in weights.items() if w not in rare) for _, least, weights in block) - 1e-4

    def search(self, words: set[bytes]) -> set[int]:
        """Positions of the items of which a text of these words can hold enough."""
        rows = [self.rare[w] for w in words if w in self.rare]
        total = self.bounds[rows].sum(axis=0) if rows else np.zeros(len(self.blocks), np.float32)
        return {at for b in np.flatnonzero(total >= self.needed).tolist() for at, least, weights in self.blocks[b]
                if sum(x for w, x in weights.items() if w in words) >= least}


class Index:
    """Units, impacts and block bounds of one shard of the benchmark."""

    def __init__(self, items: list[tuple[int, str]], frequency: dict[bytes, int], n_items: int):
        parts = [tuple(normal_words(part) for part in question_and_answer(t)) for _, t in items]
        self.items = [(i, grams(q), grams(a)) for (i, _), (q, a) in zip(items, parts, strict=True)]
        units, self.owner = [], []
        for at, (_, text) in enumerate(items):
            words = normal_words(text)
            for start in range(0, len(words), UNIT):
                units.append(words[start:start + UNIT])
                self.owner.append(at)
        self.terms = {t: k for k, t in enumerate(dict.fromkeys(w for u in units for w in u))}
        self.mean = max(1.0, sum(map(len, units)) / max(1, len(units)))
        self.blocks = -(-len(units) // BLOCK)
        # postings: for every block, the impacts of each term in its units
        self.postings = [dict() for _ in range(self.blocks)]
        for u, words in enumerate(units):
            for w, x in impacts(words, frequency, n_items, self.mean).items():
                self.postings[u // BLOCK].setdefault(self.terms[w], []).append((u % BLOCK, x))
        # block maxima, one row per rare term; frequent terms together never exceed what the best unit has of them
        rare = [t for t, k in self.terms.items() if frequency.get(t, 1) <= FREQUENT * n_items + 1]
        self.rare = {t: row for row, t in enumerate(rare)}
        rows = {self.terms[t]: row for t, row in self.rare.items()}
        self.bounds = np.zeros((len(rare), self.blocks), np.float32)
        frequent = np.zeros((self.blocks, BLOCK))
        for b, block in enumerate(self.postings):
            for t, entries in block.items():
                if t in rows:
                    self.bounds[rows[t], b] = max(x for _, x in entries)
                else:
                    for u, x in entries:
                        frequent[b, u] += x
        self.needed = (THRESHOLD * 0.9999 - frequent.max(axis=1, initial=0.0)).astype(np.float32)
        self.parts = Parts(self.items, parts, self.rare, lambda words: impacts(words, frequency, n_items, self.mean))

    def search(self, words: list[bytes]) -> list[tuple[int, float]]:
        """(position of an item, best share of its score) for all passages of a document that reach the threshold."""
        rare = np.fromiter(map(self.rare.get, words, repeat(-1)), np.int32, len(words))
        at = np.flatnonzero(rare >= 0)
        # each passage's bound for each block, from the rare words in its two strides
        sums = np.zeros((len(words) // STRIDE + 2, self.blocks), np.float32)
        if len(at):
            strides, starts = np.unique(at // STRIDE, return_index=True)
            sums[strides] = np.add.reduceat(self.bounds[rare[at]], starts, axis=0)
        passages = sums[:-1] + sums[1:]
        best: dict[int, float] = {}
        for p, b in zip(*(x.tolist() for x in np.nonzero(passages >= self.needed)), strict=True):
            scores = np.zeros(BLOCK)
            block = self.postings[b]
            for w in set(words[p * STRIDE:p * STRIDE + PASSAGE]):
                for u, x in block.get(self.terms.get(w, -1), ()):
                    scores[u] += x
            for u in np.flatnonzero(scores >= THRESHOLD).tolist():
                item = self.owner[b * BLOCK + u]
                best[item] = max(best.get(item, 0.0), float(scores[u]))
        return sorted(best.items())

    def best(self, item: int, words: list[bytes]) -> float:
        """The best share of its score that a passage has of one unit of an item."""
        passages = [{self.terms.get(w) for w in words[p:p + PASSAGE]} for p in range(0, len(words), STRIDE)]
        out = 0.0
        for u in (u for u, owner in enumerate(self.owner) if owner == item):
            own = [(t, x) for t, entries in self.postings[u // BLOCK].items() for v, x in entries if v == u % BLOCK]
            out = max(out, *(float(sum(x for t, x in own if t in passage)) for passage in passages))
        return out

    def verified(self, words: list[bytes]) -> list[tuple[int, float, float, float]]:
        """(item_id, score, question overlap, answer overlap) of the items that a text of these words holds."""
        if not words or not self.terms:
            return []
        found: dict[int, float | None] = dict.fromkeys(self.parts.search(set(words)))
        found.update(self.search(words))
        if not found:
            return []
        runs: dict[int, set] = {}

        def share(needed: set) -> float:
            if not needed:
                return 0.0
            hit = 0
            for g in needed:
                size = len(g)
                if size not in runs:
                    runs[size] = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}
                hit += g in runs[size]
            return hit / len(needed)

        out = []
        for at, score in sorted(found.items(), key=lambda x: x[0]):
            item, question, answer = self.items[at]
            q, a = share(question), share(answer)
            whole = (q * len(question) + a * len(answer)) / max(1, len(question) + len(answer))
            if q >= OVERLAP or whole >= OVERLAP:
                out.append((item, self.best(at, words) if score is None else score, q, a))
        return out


def shards(benchmark: DataFrame) -> list[Index]:
    """Indexes of bounded size over all items; document frequencies are counted over the whole benchmark."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("text IS NOT NULL AND item_id IS NOT NULL")
    ready_workers(items.sparkSession)
    n, chars = items.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()

    def terms(batches):
        import pyarrow as pa

        for batch in batches:
            for text in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(list(set(normal_words(text))), pa.binary())], ["term"])

    parts = max(1, -(-chars // SHARD_CHARS))
    where = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    frequency = items.select("text").mapInArrow(terms, "term binary").groupBy("term").agg(F.count("*").alias("df"))
    out = []
    for part in range(parts):
        own = items.where(where == part)
        needed = own.select("text").mapInArrow(terms, "term binary").distinct() if parts > 1 else None
        table = frequency if needed is None else frequency.join(needed, "term", "left_semi")
        counted = {bytes(r["term"]): r["df"] for r in table.collect()}
        rows = sorted((r["item_id"], r["text"]) for r in own.collect())
        if rows:
            out.append(Index(rows, counted, n))
    return out


def passes(benchmark: DataFrame) -> list[list[Index]]:
    all_shards = shards(benchmark)
    return [all_shards[i:i + SHARDS_PER_PASS] for i in range(0, len(all_shards), SHARDS_PER_PASS)]


def _flagged(docs: DataFrame, indexes: list[Index], keep: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(indexes)

    def make():
        indexes = sent.value

        def run(texts):
            worded = map(normal_words, texts)
            found = [[hit for index in indexes for hit in index.verified(w)] for w in worded]
            return [[[x[i] for x in f] for f in found] for i in range(4)]
        return run

    columns = {"__item": "array<bigint>", "__score": "array<double>", "__question": "array<double>", "__answer": "array<double>"}
    return add_columns(docs, make, columns, keep=keep)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item that it holds."""
    schema = "doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"
    out = docs.sparkSession.createDataFrame([], schema)
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    for indexes in passes(benchmark):
        hits = _flagged(base, indexes, ["doc_id"]).where(F.size("__item") > 0)
        hits = hits.select("doc_id", F.explode(F.arrays_zip("__item", "__score", "__question", "__answer")).alias("h"))
        out = out.unionByName(hits.select("doc_id", F.col("h.__item").alias("item_id"), F.col("h.__score").alias("score"),
                                          F.col("h.__question").alias("question_overlap"), F.col("h.__answer").alias("answer_overlap")))
    return out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no item."""
    out = docs
    for indexes in passes(benchmark):
        out = _flagged(out, indexes, docs.columns).where(F.size("__item") == 0).select(*docs.columns)
    return out

"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram binds the vectors of
its letters, permuted by their position; a text bundles its trigrams; a language
bundles its texts. A document goes to the language with the largest cosine.

The bundle of a document is a sum, so its product with a prototype is the sum of
the products of its trigrams. A worker therefore computes each trigram's product
with all prototypes once, from the bound vectors, and adds those numbers up. The
length of a document's bundle is taken as that of its independent trigrams,
sqrt(dimensions * sum of squared counts); it is the same for all languages.

Prototypes are centred on their mean, as the trigrams that all languages share say nothing.

Defined results: null texts and texts without a letter give ``und`` and score 0;
equal cosines go to the alphabetically first language; without learnt languages
every row is ``und``. Columns other than doc_id, text and lang are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import add_columns, flat_map

DIMENSIONS = 4096
#: Rows that the prototypes are fitted on, at most: a sample by hash of the rows that may be learnt from.
FIT_ROWS = 40_000
#: How sharply cosines turn into a score.
SHARPNESS = 30.0
#: Trigrams whose products a worker remembers.
KEEP_TRIGRAMS = 200_000
UNKNOWN = "und"


def held_out(doc_id: Column, parts: int, part: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == part, F.lit(False))


class Letters:
    """Random letter vectors and their bound trigrams, made from a code point alone."""

    def __init__(self):
        self.vectors = {}
        self.is_letter = np.zeros(0x110000, bool)
        for start in range(0, 0x110000, 4096):
            self.is_letter[start:start + 4096] = [chr(c).isalpha() for c in range(start, start + 4096)]

    def letter(self, code: int) -> np.ndarray:
        if code not in self.vectors:
            bits = np.random.default_rng([7, code]).integers(0, 2, DIMENSIONS)
            self.vectors[code] = (bits * 2 - 1).astype(np.float32)
        return self.vectors[code]

    def bound(self, trigram: int) -> np.ndarray:
        a, b, c = trigram >> 42, trigram >> 21 & 0x1FFFFF, trigram & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def trigrams(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Distinct trigrams of lower-cased letters, with one space for whatever stands between words, and their counts."""
        codes = np.frombuffer((" " + (text or "").lower() + " ").encode("utf-32-le"), np.uint32).astype(np.int64)
        letters = self.is_letter[codes]
        if not letters.any():
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes = np.where(letters, codes, 32)
        codes = codes[(codes != 32) | np.concatenate([[True], codes[:-1] != 32])]
        return np.unique(codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:], return_counts=True)


def prototypes(docs: DataFrame, learn_from: Column) -> tuple[list[str], np.ndarray]:
    """The learnt languages in alphabetical order and one centred prototype of unit length each."""
    rows = docs.where(learn_from & F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    total = rows.count()
    if total > FIT_ROWS:
        rows = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < int(1_000_000 * FIT_ROWS / total))

    def make():
        letters, sums = Letters(), {}

        def work(batch):
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen = sums.setdefault(lang, {})
                for g, n in zip(*(x.tolist() for x in letters.trigrams(text)), strict=True):
                    seen[g] = seen.get(g, 0) + n
            return ()

        def finish():
            for lang, seen in sums.items():
                total = np.zeros(DIMENSIONS)
                for g, n in seen.items():
                    total += n * letters.bound(g)
                yield {"lang": [lang] * DIMENSIONS, "at": list(range(DIMENSIONS)), "value": total.astype(np.int64)}

        work.finish = finish
        return work

    parts = flat_map(rows.select("lang", "text"), make, "lang string, at bigint, value bigint")
    # one number per language and dimension comes back, however many rows were read
    values = parts.groupBy("lang", "at").agg(F.sum("value").alias("value")).toPandas()
    names = sorted(values["lang"].unique())
    out = np.zeros((len(names), DIMENSIONS))
    for i, name in enumerate(names):
        own = values[values["lang"] == name]
        out[i, own["at"].to_numpy()] = own["value"].to_numpy()
        out[i] /= max(1.0, np.linalg.norm(out[i]))
    if len(names) > 1:
        out -= out.mean(axis=0)
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)
    return names, out.astype(np.float32)


def language_id(docs: DataFrame, parts: int = 3, part: int = 1) -> DataFrame:
    """doc_id, held_out, lang_pred, score and the margin over the second language."""
    names, profiles = prototypes(docs, ~held_out(F.col("doc_id"), parts, part))
    sent = docs.sparkSession.sparkContext.broadcast((names, profiles))

    def make():
        names, profiles = sent.value
        letters, known = Letters(), {}

        def product(trigrams):
            if len(known) > KEEP_TRIGRAMS:
                known.clear()
            for g in trigrams:
                if g not in known:
                    known[g] = profiles @ letters.bound(g)
            return np.array([known[g] for g in trigrams])

        def run(texts):
            out = [], [], []
            for text in texts:
                grams, counts = letters.trigrams(text)
                if not names or not len(grams):
                    row = (UNKNOWN, 0.0, 0.0)
                else:
                    cosines = counts @ product(grams.tolist()) / np.sqrt(DIMENSIONS * float((counts * counts).sum()))
                    best = int(cosines.argmax())
                    shares = np.exp(SHARPNESS * (cosines - cosines[best]))
                    rest = np.delete(cosines, best)
                    row = (names[best], float(1 / shares.sum()), float(cosines[best] - rest.max()) if len(rest) else 1.0)
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return out
        return run

    scored = add_columns(docs.select("doc_id", "text"), make, {"lang_pred": "string", "score": "double", "margin": "double"}, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id"), parts, part).alias("held_out"), "lang_pred", "score", "margin")

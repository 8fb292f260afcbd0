"""Cross-entropy difference between a target and a background language model.

Both are interpolated bigram models of the same order, smoothing and vocabulary,
one counted on the target documents and one on all others. A document's score is
the mean over its tokens of target loss minus background loss; the lower, the
more it looks like the target.

All documents, all words and all bigrams are counted; there is no least count and
no most. Documents are dealt into blocks. A block counts its own words and bigrams
and asks for the counts of the others: each of its grams goes, once, to the part
of the hash range it falls into. There the blocks' counts are added up, and only
grams of several blocks are answered; for any other the block's own count is the
whole one. A gram is one entry of a block however often it occurs there, so a
frequent one is no heavier than a rare one.

Defined results: null and empty texts have no tokens and score 0; without target
documents the target model is uniform; rows without an id count as background;
repeated rows count each time; other columns are not read. Words and bigrams
stand as hashes of 63 bits. Rows equal in id and text are in one block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import WordHashes, ascii_words, mixed, ready_workers

#: Weight of the bigram part.
BIGRAM = 0.6
#: Target ids up to this number (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
#: Tokens of a block, and the bytes that a token is taken to have. A gram that occurs more often meets several blocks.
HOT, TOKEN_BYTES = 1_250_000, 6
#: What stands before the first word of a text.
START = 0
#: The bit of a hash that marks an occurrence in a target document.
OWN = np.uint64(1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
KINDS = ("words", "pairs")


def _flagged(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    ids = target_ids.select(F.col("doc_id").alias("__target")).where("__target IS NOT NULL").distinct()
    if ids.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    return docs.select("doc_id", "text").join(ids, F.col("doc_id") == F.col("__target"), "left").select(
        "doc_id", "text", F.col("__target").isNotNull().alias("target"))


def _tokens(block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, pair) of each token of a block, with the target bit, then (tokens, target) of each document."""
    hashes = WordHashes()
    texts = [hashes(words) if words else np.zeros(0, np.uint64) for words in map(ascii_words, block["text"].to_pylist())]
    sizes = np.array([len(x) for x in texts], np.int64)
    own = block["target"].to_numpy()
    word = np.concatenate([np.zeros(0, np.uint64), *texts])
    context = np.roll(word, 1)
    context[_starts(sizes)] = START
    mark = np.repeat(own, sizes).astype(np.uint64)
    return *(x & ~OWN | mark for x in (word, mixed(context * _ODD + word))), sizes, own


def _starts(sizes: np.ndarray) -> np.ndarray:
    """Where the documents with tokens begin."""
    return (np.cumsum(sizes) - sizes)[sizes > 0]


def _firsts(ordered: np.ndarray) -> np.ndarray:
    """Where the runs of equal values begin."""
    return np.flatnonzero(np.r_[np.ones(min(1, len(ordered)), bool), ordered[1:] != ordered[:-1]])


def _counted(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Grams of sorted marked occurrences, and their counts in background and target (two rows)."""
    grams = ordered & ~OWN
    first = _firsts(grams)
    target = np.add.reduceat(ordered & OWN, first) if len(first) else np.zeros(0, np.uint64)
    n = np.diff(np.r_[first, len(grams)]).astype(np.uint64)
    return grams[first], np.stack([n - target, target])


def _bounds(grams: np.ndarray, parts: int) -> np.ndarray:
    """Where the parts of the hash range begin in sorted grams, and where the last one ends."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], np.uint64)
    return np.r_[0, np.searchsorted(grams, edges), len(grams)]


def _packed(values: np.ndarray) -> bytes:
    """Numbers byte by byte, all lowest ones first: the empty upper bytes of small numbers compress to nothing."""
    return np.ascontiguousarray(values.astype("<u8").reshape(-1, 1).view(np.uint8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def _ask(parts: int):
    """A block's grams and counts, one row for each part of the hash range."""
    def run(block):
        import pyarrow as pa

        *kinds, sizes, own = _tokens(block)
        totals = [int(x) for value in (sizes > 0, sizes) for x in (value[~own].sum(), value[own].sum())]
        out = {"part": np.arange(parts, dtype=np.int32), "block": np.full(parts, block["block"][0].as_py(), np.int32), "totals": [totals] * parts}
        for kind, marked in zip(KINDS, kinds, strict=True):
            grams, n = _counted(np.sort(marked))
            at = _bounds(grams, parts).tolist()
            out[kind] = [_packed(np.diff(grams[a:b], prepend=np.uint64(0))) for a, b in zip(at, at[1:], strict=False)]
            out[f"{kind}_n"] = [_packed(n[:, a:b].ravel()) for a, b in zip(at, at[1:], strict=False)]
        return pa.table({name: pa.array(out[name], kind) for name, kind in _types("totals", *_columns()).items()})

    return run


def _columns() -> list[str]:
    return [name for kind in KINDS for name in (kind, f"{kind}_n")]


def _types(numbers: str, *binaries: str) -> dict:
    import pyarrow as pa

    return {"part": pa.int32(), "block": pa.int32(), numbers: pa.list_(pa.int64()), **dict.fromkeys(binaries, pa.binary())}


def _answer(part):
    """For each block that asks: which of its grams (as bits) other blocks have too, and the counts of those in all blocks."""
    import pyarrow as pa

    part = part.sort_by("block")
    out = {"part": part["part"], "block": part["block"]}
    totals = np.sum(part["totals"].to_pylist(), axis=0, dtype=np.int64).tolist()
    for kind in KINDS:
        grams = [np.cumsum(_unpacked(x.as_py()), dtype=np.uint64) for x in part[kind]]
        ends = np.cumsum([0, *map(len, grams)]).tolist()
        n = np.concatenate([_unpacked(x.as_py()).reshape(2, -1) for x in part[f"{kind}_n"]], axis=1)
        grams = np.concatenate(grams)
        order = np.argsort(grams, kind="stable")
        first = _firsts(grams[order])
        if kind == "words":
            totals.append(len(first))
        blocks = np.diff(np.r_[first, len(grams)])
        several = np.empty(len(grams), bool)
        several[order] = np.repeat(blocks > 1, blocks)
        if len(first):
            for row in n:
                row[order] = np.repeat(np.add.reduceat(row[order], first), blocks)
        out[kind] = [np.packbits(several[a:b]).tobytes() for a, b in zip(ends, ends[1:], strict=False)]
        out[f"{kind}_n"] = [_packed(n[:, a:b][:, several[a:b]].ravel()) for a, b in zip(ends, ends[1:], strict=False)]
    out["totals"] = [totals] * len(part)
    return pa.table({name: pa.array(out[name], kind) if isinstance(out[name], list) else out[name] for name, kind in _types("totals", *_columns()).items()})


def _score(parts: int, id_type):
    """The documents of a block with their losses, from the block's own counts and the answers to it."""
    def run(block, answers):
        import pyarrow as pa

        *kinds, sizes, own = _tokens(block)
        if len(block) and len(answers) != parts:
            raise ValueError(f"{len(answers)} answers of {parts} parts")
        answers = answers.sort_by("part")
        totals = answers["totals"].to_pylist()
        texts, tokens = np.array(totals[0][:2], np.float64), totals[0][2:4]
        vocabulary = sum(x[4] for x in totals)
        counts = []  # of each token's word and pair: background, target
        for kind, marked in zip(KINDS, kinds, strict=True):
            order = np.argsort(marked)
            grams, n = _counted(marked[order])
            at = np.diff(_bounds(grams, parts)).tolist()
            bits = [np.unpackbits(np.frombuffer(x.as_py(), np.uint8), count=size) for x, size in zip(answers[kind], at, strict=True)]
            n[:, np.concatenate(bits).astype(bool)] = np.concatenate([_unpacked(x.as_py()).reshape(2, -1) for x in answers[f"{kind}_n"]], axis=1)
            own_n = np.diff(np.r_[_firsts(marked[order] & ~OWN), len(order)])
            each = np.empty((2, len(order)))
            each[:, order] = np.repeat(n, own_n, axis=1)
            counts.append(each)
        means = []
        for word, pair, begun, size in zip(*counts, texts, tokens, strict=True):
            context = np.roll(word, 1)
            context[_starts(sizes)] = begun
            unigram = (word + 1) / float(size + vocabulary + 1)
            loss = -np.log(BIGRAM * pair / np.maximum(context, 1) + (1 - BIGRAM) * unigram)
            mean = np.zeros(len(sizes))
            mean[sizes > 0] = np.add.reduceat(loss, _starts(sizes)) / sizes[sizes > 0] if len(loss) else 0.0
            means.append(mean)
        background, target = means
        return pa.table({
            "doc_id": block["doc_id"].cast(id_type), "n_tokens": pa.array(sizes), "target_loss": pa.array(target),
            "background_loss": pa.array(background), "score": pa.array(target - background)})

    return run


def cross_entropy_difference(docs: DataFrame, target_ids: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and score, the losses per token."""
    from pyspark.sql.pandas.types import to_arrow_type

    ready_workers(docs.sparkSession)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 + size // (HOT * TOKEN_BYTES)
    blocks = _flagged(docs, target_ids).withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)).cast("int"))
    rows = "part int, block int, totals array<bigint>, words binary, words_n binary, pairs binary, pairs_n binary"
    asked = blocks.groupBy("block").applyInArrow(_ask(parts), rows)
    answers = asked.groupBy("part").applyInArrow(_answer, rows)
    kind = docs.schema["doc_id"].dataType
    # the blocks are dealt once: Spark takes the exchange of the counting for the scoring too
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        _score(parts, to_arrow_type(kind)),
        f"doc_id {kind.simpleString()}, n_tokens bigint, target_loss double, background_loss double, score double")

"""Lempel-Ziv phrase fingerprints: how much of its phrases a document shares with its edited text and its neighbour.

A text's UTF-8 bytes are parsed into dictionary phrases: each phrase is the
longest one known so far and one byte more. The phrases are hashed, and the
smallest values of ``SLOTS`` universal hash functions over the phrase set are the
fingerprint; the share of equal slots estimates the similarity of the sets. The
edited text begins like the document, so it is parsed from where the two part,
with the phrases known there.

Documents are ordered by id in ranges, so a document meets the next one in its
own task; only the first and last texts of the ranges meet afterwards.

Defined results: a null text counts as empty; an empty text has no phrases, a
fingerprint of its own, likeness 1 to an empty text and 0 to others; a document
whose edit replaces nothing equals its edited text (likeness 1); rows that repeat
a ``doc_id`` are ordered by a hash of their texts, null ids come first; a single
document is its own next one; no documents, no rows. Other columns are never read.
"""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headway.llm.common import ready_workers, stored

#: Hash functions of a fingerprint; each slot keeps 16 bits of its minimum.
SLOTS = 128
#: Phrases hashed at once, which bounds memory for long texts.
BLOCK = 4096
_MASK = (1 << 64) - 1
_BYTES = [bytes([b]) for b in range(256)]
_EMPTY = np.full(SLOTS, 0xFFFFFFFF, np.uint32)


def _functions() -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the universal hash functions, from a fixed rule."""
    state, out = 0x9E3779B97F4A7C15, []
    for _ in range(2 * SLOTS):
        state = (state * 6364136223846793005 + 1442695040888963407) & _MASK
        out.append(state >> 32)
    return np.array(out[:SLOTS], np.uint32)[:, None] | np.uint32(1), np.array(out[SLOTS:], np.uint32)[:, None]


TIMES, PLUS = _functions()


def extend(data: bytes, known: dict[int, int], node: int, count: int, before: dict[int, int] | None = None, limit: int = 0):
    """Parse ``data`` onwards from a node; returns the new phrases as keys (parent << 8 | byte) and the last node.

    Nodes are numbered by their order, shifted by eight bits; ``known`` maps a key to its node and grows. Where
    ``before`` is given, its nodes up to ``limit`` are known too and it stays as it is.
    """
    keys, top = [], count << 8
    add, get = keys.append, known.get
    if before is None:
        for byte in data:
            key = node | byte
            node = get(key)
            if node is None:
                top += 256
                known[key] = top
                add(key)
                node = 0
        return keys, node
    old, limit = before.get, limit << 8
    for byte in data:
        key = node | byte
        node = old(key)
        if node is None or node > limit:
            node = get(key)
            if node is None:
                top += 256
                known[key] = top
                add(key)
                node = 0
    return keys, node


def hashed(keys: list[int], hashes: list[int]) -> np.ndarray:
    """Mixed hashes of new phrases; ``hashes`` (checksums by node number) grows, each from its parent's."""
    first, add = len(hashes), hashes.append
    for key in keys:
        add(crc32(_BYTES[key & 255], hashes[key >> 8]))
    x = np.array(hashes[first:], np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    return x ^ (x >> np.uint32(13))


def minima(values: np.ndarray, least: np.ndarray) -> np.ndarray:
    """The slots' minima over more phrase hashes."""
    for i in range(0, len(values), BLOCK):
        least = np.minimum(least, (TIMES * values[i:i + BLOCK] + PLUS).min(axis=1))
    return least


def slots(least: np.ndarray, empty: bool) -> bytes:
    """Sixteen mixed bits of each minimum; a text without phrases has all bits set."""
    if empty:
        return b"\xff" * (2 * SLOTS)
    x = least * np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    return ((x * np.uint32(0xC2B2AE35)) >> np.uint32(16)).astype(">u2").tobytes()


def likeness(a: bytes, b: bytes) -> float:
    return float(np.mean(np.frombuffer(a, ">u2") == np.frombuffer(b, ">u2")))


class Parsed:
    """A document's fingerprint, and what its edited text needs."""

    def __init__(self, doc_id, text: str | None):
        self.doc_id, self.text = doc_id, text or ""
        cut = len(self.text) - len(self.text) // 4
        self.kept = self.text[:cut]
        head, tail = self.kept.encode(), self.text[cut:].encode()
        self.known, self.hashes = {}, [0]
        keys, self.node = extend(head, self.known, 0, 0)
        self.count = len(keys)
        self.head = minima(hashed(keys, self.hashes), _EMPTY)
        more, _ = extend(tail, self.known, self.node, self.count)
        self.print = slots(minima(hashed(more, self.hashes), self.head), not self.text)

    def against(self, following: "Parsed") -> tuple:
        """The row of this document, given the next one."""
        added = following.text[:len(self.text) // 4]
        more, _ = extend(added.encode(), {}, self.node, self.count, self.known, self.count)
        hashes = self.hashes[:self.count + 1]
        edited = slots(minima(hashed(more, hashes), self.head), not self.kept and not added)
        digest = hashlib.sha256((self.kept + added).encode()).hexdigest()
        return (self.doc_id, len(self.text), digest, self.print, edited, likeness(self.print, edited),
                likeness(self.print, following.print))


_ROW = ("doc_id BIGINT, n_chars BIGINT, edited_sha256 STRING, print BINARY, edited_print BINARY, near_edited DOUBLE, "
        "near_next DOUBLE")
_ARROW = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("print", pa.binary()),
          ("edited_print", pa.binary()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_EDGE = [("edge", pa.string()), ("edge_text", pa.string())]


def _batch(rows: list[tuple], fields) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], [n for n, _ in fields])


def _in_order(batches):
    """Rows of a sorted range; its first and last documents come out as edges, whose neighbours other tasks hold."""
    last = None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            this = Parsed(doc_id, text)
            rows.append((doc_id, *[None] * 6, "first", this.text) if last is None else (*last.against(this), None, None))
            last = this
        yield _batch(rows, _ARROW + _EDGE)
    if last is not None:
        yield _batch([(last.doc_id, *[None] * 6, "last", last.text)], _ARROW + _EDGE)


def _in_pairs(batches):
    """Rows of documents that come with the next text."""
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(3)]
        yield _batch([Parsed(i, text).against(Parsed(None, after)) for i, text, after in zip(*columns)], _ARROW)


def phrase_fingerprints(docs: DataFrame) -> DataFrame:
    """One row per document: fingerprints of its text and edited text, and their likeness to each other and to the next."""
    ready_workers(docs.sparkSession)
    ordered = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = ordered.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text")
    found = ordered.mapInArrow(_in_order, _ROW + ", edge STRING, edge_text STRING")
    found = stored(found.withColumn("part", F.spark_partition_id()), "phrases")
    first = found.where("edge = 'first'").select("part", F.col("edge_text").alias("after"))
    # a row per range, without its text
    order = Window.orderBy("part")
    chain = first.select("part").withColumns({"next_part": F.lead("part").over(order), "start": F.min("part").over(Window.partitionBy())})
    chain = chain.select("part", F.coalesce("next_part", "start").alias("next_part"))
    pairs = found.where("edge = 'last'").select("doc_id", "edge_text", "part").join(chain, "part").join(
        first.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "edge_text", "after")
    rows = found.where("edge IS NULL").select(*[n for n, _ in _ARROW]).unionByName(pairs.mapInArrow(_in_pairs, _ROW))
    text = lambda c: F.lower(F.hex(c))
    return rows.select("doc_id", "n_chars", "edited_sha256", text("print").alias("fingerprint"),
                       text("edited_print").alias("edited_fingerprint"), "near_edited", "near_next")

"""Repeated byte strings across documents, by merging Burrows-Wheeler transforms of shards.

A string of LENGTH bytes is found from an anchor in it: the position with the
least hash among its first SPAN. Equal strings have equal anchors, so they meet
under the hash of the CORE bytes behind the anchor. What is left to compare are
the bytes around the core. Occurrences with equal surroundings collapse. The
different surroundings of one core form a collection of short strings, cut into
shards: each shard is suffix-sorted by itself and gives a Burrows-Wheeler
transform, and two shards at a time are merged by refining their interleave
symbol by symbol. The refinement splits the merged order into blocks; the step
that splits two suffixes is their common prefix, and blocks that hold several
suffixes after LENGTH - CORE steps are the repeated intervals. Blocks of one
suffix are left alone, and suffixes are never sorted again. A core with very many surroundings has more shards, every pair of which
meets in some task, so a task's input stays bounded.

Defined results: null texts count as empty; documents shorter than LENGTH keep
all bytes; equal rows repeat each other; rows without an id are treated alike;
other columns of the input are not read. Hashes of 64 bits stand for cores and
for whole surroundings.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import add_columns, flat_map, mixed, stored

LENGTH, SPAN, GRAM = 400, 200, 16
CORE = LENGTH - SPAN + 1
DEPTH = LENGTH - CORE
#: Bytes of one document that are hashed at a time; neighbouring pieces overlap, so nothing is lost between them.
PIECE = 4 << 20
#: Surroundings of one shard, and bytes of surroundings that a worker merges at a time.
SHARD_STRINGS, MERGE_BYTES = 4_000, 2 << 20
#: Keys up to this number (8 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_KEYS = 2_000_000


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first start, last start) of the runs of LENGTH-byte strings with one anchor, in text order."""
    found = []
    for begin in range(0, max(0, len(data) - LENGTH + 1), PIECE):
        part = np.frombuffer(data, np.uint8, min(len(data), begin + PIECE + LENGTH - 1) - begin, begin).astype(np.uint64)
        n = len(part) - LENGTH + 1
        # the polynomial hash of GRAM bytes from those of half as many
        h, width, power = part, 1, 0x100000001B3
        while width < GRAM:
            h = h[:-width] * np.uint64(power) + h[width:]
            width, power = 2 * width, power * power % 2**64
        # hash above, position below: the least value is the leftmost least hash
        h = mixed(h) & np.uint64(0xFFFFFFFFFF000000) | np.arange(len(h), dtype=np.uint64)
        padded = np.full(-(-len(h) // SPAN) * SPAN, np.uint64(0xFFFFFFFFFFFFFFFF))
        padded[:len(h)] = h
        blocks = padded.reshape(-1, SPAN)
        ahead = np.minimum.accumulate(blocks, axis=1).ravel()
        behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        at = (np.minimum(behind[:n], ahead[SPAN - 1:SPAN - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        last = np.append(first[1:], n) - 1
        found.append((at[first] + begin, first + begin, last + begin))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _emit_anchors():
    import xxhash

    hash64 = xxhash.xxh3_64_intdigest

    def work(batch):
        out = {"key": [], "core": [], "around": [], "low": [], "high": [], "anchor": []}
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            data = text.encode() if text else b""
            for at, low, high in zip(*(x.tolist() for x in anchors(data)), strict=True):
                out["key"].append(key)
                out["core"].append(hash64(data[at:at + CORE]) - (1 << 63))
                out["around"].append(hash64(data[low:high + LENGTH], at - low) - (1 << 63))
                out["low"].append(low)
                out["high"].append(high)
                out["anchor"].append(at)
        yield out
    return work


def _surroundings(data: bytes, low: int, high: int, anchor: int) -> bytes:
    """The bytes of all strings of one anchor without its core."""
    return data[low:anchor] + data[anchor + CORE:high + LENGTH]


class Shard:
    """Burrows-Wheeler transform of a collection of strings; 0 ends a string, byte b is b + 1."""

    def __init__(self, strings: list[bytes]):
        m = len(strings)
        sizes = np.array([len(s) + 1 for s in strings], np.int64)
        ends = np.cumsum(sizes)
        text = np.frombuffer(b"".join(s + b"\0" for s in strings), np.uint8).astype(np.int64) + 1
        text[ends - 1] = 0
        owner = np.repeat(np.arange(m), sizes)
        left_over = ends[owner] - np.arange(len(text))  # symbols up to and with the end
        # ranks by the first seven symbols, then doubled; nothing behind an end is looked at, equal suffixes keep text order
        def joined(first, size, then, places):
            """Ranks by ``size`` symbols and then by those that follow, as many as ``places`` is a power of 257."""
            out = first * places
            out[:max(0, len(text) - size)] += np.where(left_over[:-size] > size, then[size:], 0)
            return out

        two = joined(text, 1, text, 257)
        rank = joined(joined(two, 2, two, 257**2), 4, joined(two, 2, text, 257), 257**3)
        step = 7
        order = np.argsort(rank)
        while True:
            in_order = rank[order]
            dense = np.concatenate([[0], np.cumsum(in_order[1:] != in_order[:-1])]) if m else rank
            rank = np.empty(len(text), np.int64)
            rank[order] = dense
            if len(text) and dense[-1] == len(text) - 1:
                break
            if step >= sizes.max(initial=0):
                order = np.argsort(rank * len(text) + np.arange(len(text)))
                break
            follow = np.zeros(len(text), np.int64)
            follow[:-step] = rank[step:] + 1
            rank = rank * (len(text) + 1) + np.where(left_over > step, follow, 0)
            order = np.argsort(rank)
            step *= 2
        before = np.concatenate([[0], text[:-1]])[:len(text)]
        before[ends - sizes] = 0  # what stands before a string's first byte is an end
        self.transform = before[order].astype(np.int16)
        self.owner, self.offset = owner[order], (np.arange(len(text)) - (ends - sizes)[owner])[order]

    def previous(self) -> np.ndarray:
        """From the transform alone: the rank of the suffix that is one symbol longer than the one of a rank."""
        out = np.empty(len(self.transform), np.int64)
        out[np.argsort(self.transform, kind="stable")] = np.arange(len(out))
        return out


def merged_blocks(a: Shard, b: Shard, blocks: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merge two transforms by interleave refinement for ``depth`` symbols.

    ``blocks`` is the block each suffix starts in, first of ``a`` and then of ``b``; -1 leaves a suffix out. Each step
    reads one symbol of the transforms and splits the blocks by it, keeping the order inside. A block of one suffix is
    final: whatever precedes it is alone as well, so only blocks of several go on. Returns the suffixes (ranks in ``a``,
    then in ``b``) that are in blocks of several after the last step, their blocks, and for each suffix of the start the
    common prefix with another one of its block.
    """
    kind = np.int32 if 257 * (len(blocks) + 1) < 2**31 else np.int64
    symbols = np.concatenate([a.transform, b.transform])
    previous = np.concatenate([a.previous(), b.previous() + len(a.transform)]).astype(kind)
    active = np.flatnonzero(blocks >= 0).astype(kind)
    block, prefix, begun = np.unique(blocks[active], return_inverse=True)[1].astype(kind), np.zeros(len(blocks), np.int64), active
    for step in range(depth + 1):
        alive = np.bincount(block)[block] > 1 if len(block) else np.zeros(0, bool)
        if not alive.all():
            prefix[begun[~alive]] = max(step - 1, 0)
            active, block, begun = active[alive], block[alive], begun[alive]
        if step == depth or not len(active):
            prefix[begun] = step
            break
        symbol = symbols[active]
        inside = symbol > 0
        if not inside.all():
            prefix[begun[~inside]] = step
            active, block, begun, symbol = active[inside], block[inside], begun[inside], symbol[inside]
        key = block * kind(257) + symbol
        later = key[1:] < key[:-1]
        if later.any():
            order = np.argsort(key, kind="stable")
            key, active, begun = key[order], active[order], begun[order]
        block = np.zeros(len(key), kind)
        np.cumsum(key[1:] != key[:-1], out=block[1:])
        active = previous[active]
    return active, block, prefix


def repeated_starts(shards: tuple[list, list]) -> list[list[int]]:
    """For the strings (core, left, starts, bytes) of two shards in turn: starts of DEPTH bytes that another string has.

    ``left`` is the length of the part before the core. Equal bytes count between strings of one core at the same
    distance from it, so suffixes start in blocks by core and distance.
    """
    a, b = (Shard([s[3] for s in shard]) for shard in shards)
    strings = [*shards[0], *shards[1]]
    owner = np.concatenate([a.owner, b.owner + len(shards[0])])
    offset = np.concatenate([a.offset, b.offset])
    core = np.unique([s[0] for s in strings], return_inverse=True)[1]
    left, starts = (np.array([s[i] for s in strings], np.int64) for i in (1, 2))
    distance = left[owner] - offset + LENGTH
    wanted = (offset >= DEPTH) & (offset < DEPTH + starts[owner])
    blocks = np.where(wanted, core[owner] * (4 * LENGTH) + distance, -1)
    used = np.flatnonzero(wanted)
    blocks[used] = np.unique(blocks[used], return_inverse=True)[1]
    out: list[list[int]] = [[] for _ in strings]
    for i in merged_blocks(a, b, blocks, DEPTH)[0].tolist():
        out[owner[i]].append(int(offset[i]))
    return out


def _merge():
    """Rows (core, pair, side, around, left, starts, bytes) sorted by core and pair; whole buckets are merged together."""
    held: list[tuple] = []
    total = [0]

    def solve(rows):
        shards = [r for r in rows if r[2] == 0], [r for r in rows if r[2] == 1]
        found = repeated_starts(tuple([(r[0], r[4], r[5], r[6]) for r in shard] for shard in shards))
        out = {"core": [], "around": [], "first": [], "last": []}
        for row, starts in zip([*shards[0], *shards[1]], found, strict=True):
            if starts:
                values = np.sort(np.array(starts))
                breaks = np.flatnonzero(np.diff(values) > 1)
                out["core"].append(row[0])
                out["around"].append(row[3])
                out["first"].append(values[np.concatenate([[0], breaks + 1])])
                out["last"].append(values[np.append(breaks, len(values) - 1)])
        yield out

    def work(batch):
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if total[0] > MERGE_BYTES and row[:2] != held[-1][:2]:
                yield from solve(held)
                held.clear()
                total[0] = 0
            held.append(row)
            total[0] += len(row[6])

    def finish():
        if held:
            yield from solve(held)

    work.finish = finish
    return work


def _few(keys: DataFrame) -> DataFrame:
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def repeated_spans(base: DataFrame) -> DataFrame:
    """(key, start, stop) of byte ranges covered by repeated strings, for rows (key, text)."""
    found = flat_map(base.select("key", "text"), _emit_anchors, "key bigint, core bigint, around bigint, low int, high int, anchor int")
    found = stored(found, "anchors")
    twice = found.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    found = stored(found.join(twice, "core"), "anchors-repeated")
    kinds = found.groupBy("core", "around").agg(
        F.count("*").alias("n"), F.min(F.struct("key", "low", "high", "anchor")).alias("one"))
    kinds = stored(kinds, "surroundings")
    several = kinds.groupBy("core").agg(F.count("*").alias("strings")).where("strings > 1")
    kinds_of = kinds.join(several, "core").select("core", "around", "strings", "one.*")
    wanted = stored(kinds_of, "surroundings-different")

    # one document of each kind gives the bytes; a document is asked for as many as it has anchors at most
    asked = wanted.groupBy("key").agg(F.collect_list(F.struct("core", "around", "low", "high", "anchor", "strings")).alias("asked"))
    texts = base.join(_few(wanted.select("key").distinct()), "key", "left_semi").dropDuplicates(["key"])
    joined = texts.join(asked, "key").select(F.struct("text", "asked").alias("input"))

    def cut():
        def work(batch):
            for row in batch.column(0).to_pylist():
                data = row["text"].encode()
                asked = row["asked"]
                yield {
                    "core": [x["core"] for x in asked], "around": [x["around"] for x in asked], "strings": [x["strings"] for x in asked],
                    "left": [x["anchor"] - x["low"] for x in asked], "starts": [x["high"] - x["low"] + 1 for x in asked],
                    "bytes": [_surroundings(data, x["low"], x["high"], x["anchor"]) for x in asked]}
        return work

    strings = flat_map(joined, cut, "core bigint, around bigint, strings bigint, left int, starts int, bytes binary")
    # every pair of shards of a core is one bucket; most cores have two shards and one bucket
    shards = F.greatest(F.lit(2), F.ceil(F.col("strings") / SHARD_STRINGS)).cast("int")
    strings = strings.withColumn("shards", shards).withColumn("own", F.pmod(F.xxhash64("around"), F.col("shards")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("shards") - 1), lambda i: i != F.col("own"))
    paired = strings.withColumn("other", F.explode(others)).select(
        "core", (F.least("own", "other") * F.lit(1 << 20).cast("bigint") + F.greatest("own", "other")).alias("pair"),
        (F.col("own") > F.col("other")).cast("int").alias("side"), "around", "left", "starts", "bytes")
    size = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sorted_rows = paired.repartition(size, "core", "pair").sortWithinPartitions("core", "pair")
    ranges = flat_map(sorted_rows, _merge, "core bigint, around bigint, first array<int>, last array<int>")
    ranges = ranges.unionByName(kinds.where("n > 1").select(
        "core", "around", F.array(F.lit(0)).alias("first"), F.array(F.col("one.high") - F.col("one.low")).alias("last")))
    solved = ranges.groupBy("core", "around").agg(
        F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("first", "last")))).alias("ranges"))
    return found.join(solved, ["core", "around"]).select("key", "low", F.explode("ranges").alias("r")).select(
        "key", (F.col("low") + F.col("r.first")).alias("start"), (F.col("low") + F.col("r.last") + LENGTH).alias("stop"))


def covered(spans: list) -> list[tuple[int, int]]:
    """Disjoint maximal runs of sorted or unsorted (start, stop) ranges; touching ranges are one run."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row."""
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("doc_id", "text"))
    spans = repeated_spans(base).groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    spans = stored(spans, "spans")
    keys = _few(spans.select("key"))
    touched = base.join(keys, "key", "left_semi").join(spans, "key").select("doc_id", F.struct("text", "spans").alias("input"))

    def make():
        def run(rows):
            out = [], [], [], []
            for row in rows:
                data, at, kept, removed = row["text"].encode(), 0, hashlib.sha256(), 0
                runs = covered([(s["start"], s["stop"]) for s in row["spans"]])
                for start, stop in runs:
                    kept.update(data[at:start])
                    removed += stop - start
                    at = stop
                kept.update(data[at:])
                for column, value in zip(out, (len(data), removed, len(runs), kept.hexdigest()), strict=True):
                    column.append(value)
            return out
        return run

    cut = add_columns(touched, make, {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"},
                      text="input", keep=["doc_id"])
    whole = base.join(keys, "key", "left_anti").select(
        "doc_id", F.octet_length("text").cast("bigint").alias("n_bytes"), F.lit(0).cast("bigint").alias("n_removed"),
        F.lit(0).cast("bigint").alias("n_spans"), F.sha2("text", 256).alias("kept_sha256"))
    return cut.unionByName(whole)

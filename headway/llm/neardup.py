"""Near-duplicate groups by MinHash.

Texts with equal shingle sets collapse into one class first. Each class gets
universal hash minima, the minima are banded, and bands meet in buckets. A
bucket never emits all its pairs: in the first round every member is compared
with the one that meets most others in all its buckets, verified pairs are joined
into components, and only buckets that still hold several components go on. Each
round takes about 64 times as many members of the smaller components as the
last one and compares them with the rest, until every pair of different
components that shares a bucket has been compared. Members carry a sketch, their
minima and how many of their shingles fall into each of 128 parts of the hash
range. Sketches are compared inside a bucket; a pair becomes a row only where they
allow it, and its full shingle sets decide. Components come from alternating
large-star and small-star.

Defined results: a null, empty or blank text has no shingles and is linked with
nothing; a row without an id is grouped with nothing and is its own component
(null) and kept; rows that repeat an id are one document; ties go to the
smallest id; other columns of the input are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import Steps, WordHashes, add_columns, ascii_words, mixed, shingles, stored

BANDS, ROWS = 24, 4
#: Pairs whose share of equal minima falls this far below the limit are not confirmed; with 96 minima that is more than
#: six standard deviations.
MARGIN = 0.25
#: Parts of the hash range whose shingles are counted: two sets share at most the sum of the smaller counts.
PARTS = 128
#: Fineness of the share of members that a round takes, and growth of that share.
_SHARES, GROWTH = 1 << 30, 64
#: Members of a bucket that are compared in one task; larger buckets are cut into shards, each of which meets every other.
SHARD = 4_096
#: Members that a task holds before it compares them, and pairs that it compares at a time.
HELD, AT_ONCE = 20_000, 1 << 15
#: Ids up to this number (24 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_IDS = 2_000_000
_rng = np.random.default_rng(20240117)
_A = _rng.integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)


def signature(x: np.ndarray) -> np.ndarray:
    """The minimum of each universal hash (a*x + b mod 2^64, upper half) over a set."""
    out = np.empty(len(_A), np.uint64)
    for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
        out[i] = (x * a + b).min()
    return (out >> np.uint64(33)).astype(np.int32)


def band_keys(minima: np.ndarray) -> np.ndarray:
    parts = minima.astype(np.uint64).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for i in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, i])
    return key.astype(np.int64)


def sketch(shingle_set: np.ndarray, minima: np.ndarray) -> bytes:
    """One byte of each minimum, then the counts of the parts; a count of 255 stands for any larger one too.

    Unequal minima may look equal, which only lets a pair go on to the sets.
    """
    counts = np.bincount((shingle_set >> np.uint64(57)).astype(np.int64), minlength=PARTS)
    return minima.astype(np.uint8).tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def _signatures(width: int):
    def make():
        import xxhash

        hashed = WordHashes()

        def run(texts):
            n, digest, keys, sketches = [], [], [], []
            for text in texts:
                s = shingles(hashed(ascii_words(text)), width)
                minima = signature(s) if len(s) else None
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(minima) if len(s) else None)
                sketches.append(sketch(s, minima) if len(s) else None)
            return [n, digest, keys, sketches]
        return run
    return make


def _sets(width: int):
    def make():
        import xxhash

        hashed = WordHashes()

        def run(texts):
            sets = [shingles(hashed(ascii_words(t)), width).tobytes() for t in texts]
            return [[xxhash.xxh3_128_digest(s) for s in sets], sets]
        return run
    return make


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) for every node of the edges (a, b): the smallest node that is reachable.

    Large-star links every larger neighbour of a node to its smallest neighbour, small-star does so with the smaller
    ones; both in turn until the edges stay as they are. Each step is written to the shared folder.
    """
    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b").union(e.select(F.col("b"), F.col("a"))) if large else e.select(
            F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = both.groupBy("a").agg(F.min("b").alias("low")).select(F.col("a").alias("n"), F.least("low", "a").alias("low"))
        linked = both.join(low, F.col("a") == F.col("n"))
        if large:
            out = linked.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            out = linked.select(F.col("b").alias("a"), F.col("low").alias("b")).union(linked.select("a", F.col("low").alias("b")))
        return out.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    steps = Steps(label)
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
    while True:
        edges = steps.write(star(star(edges, True), False))
        # done when every larger node has one edge and no smaller node has a smaller one itself
        if _is_forest_of_stars(edges):
            break
    roots = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
    return roots.union(roots.select(F.col("component").alias("node"), "component").distinct())


def _is_forest_of_stars(edges: DataFrame) -> bool:
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("n").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where(
        "up > 1 OR (up > 0 AND down > 0)").isEmpty()


def allowed_pairs(n: np.ndarray, sketches: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
    """Which pairs of positions may be alike: an upper bound of the intersection, and the share of equal minima."""
    small, total = np.minimum(n[left], n[right]), n[left] + n[right]
    at = np.flatnonzero((100 + percent) * small >= percent * total)
    for columns in (slice(BANDS * ROWS, None), slice(0, BANDS * ROWS)):
        x, y = sketches[left[at], columns], sketches[right[at], columns]
        if columns.start:
            both = np.minimum(x, y)
            shared = np.where((both == 255).any(axis=1), small[at], both.sum(axis=1, dtype=np.int64))
            at = at[(100 + percent) * shared >= percent * total[at]]
        else:
            at = at[(x == y).mean(axis=1) >= percent / 100 - MARGIN]
    return at


def _compared(percent: int):
    """Rows (key, p, m, node, component, n, sketch, pivot, member) sorted by block (key, p, m): pairs that sketches allow."""
    def run(batches):
        import pyarrow as pa

        def solve(held):
            key, p, m, node, component, n, pivot, member = (np.concatenate([h[i] for h in held]) for i in range(8))
            sketches = np.concatenate([h[8] for h in held])
            first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (p[1:] != p[:-1]) | (m[1:] != m[:-1])])
            stops = np.r_[first[1:], len(key)]
            block = np.repeat(np.arange(len(first)), stops - first)
            pivots = np.flatnonzero(pivot)
            sizes = (stops - first)[block[pivots]]
            ends = np.cumsum(sizes)
            low = 0
            while low < len(pivots):
                high = max(low + 1, int(np.searchsorted(ends, (ends[low - 1] if low else 0) + AT_ONCE, "right")))
                some, size = pivots[low:high], sizes[low:high]
                left = np.repeat(some, size)
                right = np.arange(len(left)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[block[some]], size)
                keep = member[right] & (component[left] != component[right])
                left, right = left[keep], right[keep]
                at = allowed_pairs(n, sketches, left, right, percent)
                a, b = node[left[at]], node[right[at]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])
                low = high

        held, size, last = [], 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
            columns.append(np.frombuffer(b"".join(batch.column(8).to_pylist()), np.uint8).reshape(batch.num_rows, -1))
            if size > HELD:
                # the rows of the last block so far wait for the rest of it
                same = (columns[0] == last[0]) & (columns[1] == last[1]) & (columns[2] == last[2])
                rest = int(np.argmin(same)) if not same.all() else len(same)
                held.append([c[:rest] for c in columns])
                if rest < len(same):
                    yield from solve(held)
                    held, size = [], 0
                columns = [c[rest:] for c in columns]
            if len(columns[0]):
                held.append(columns)
                size += len(columns[0])
                last = tuple(c[-1] for c in columns[:3])
        if held:
            yield from solve(held)
    return run


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike: 100 * intersection >= percent * union."""
    for end in ("a", "b"):
        pairs = pairs.join(sets.select(F.col("node").alias(end), F.col("hashes").alias(f"hashes_{end}")), end)

    def same(x, y):
        x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        at = np.searchsorted(y, x)
        at[at == len(y)] = 0
        both = int((y[at] == x).sum())
        return 100 * both >= percent * (len(x) + len(y) - both)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            a, b, ours, theirs = batch.columns
            keep = pa.array([i for i, (x, y) in enumerate(zip(ours, theirs, strict=True)) if same(x.as_buffer(), y.as_buffer())], pa.int64())
            yield pa.RecordBatch.from_arrays([a.take(keep), b.take(keep)], ["a", "b"])

    return pairs.select("a", "b", "hashes_a", "hashes_b").mapInArrow(run, "a bigint, b bigint")


def _blocks(turned: DataFrame) -> DataFrame:
    """A row for each block (key, p, m) of a bucket that a member takes part in: pivots of shard p meet members of shard m."""
    shards = F.ceil(F.col("members") / SHARD).cast("int")
    own = F.pmod(F.xxhash64("node"), shards.cast("bigint")).cast("int")
    every = F.sequence(F.lit(0), F.col("shards") - 1)
    block = lambda p, m: F.struct(p.alias("p"), m.alias("m"))
    as_member = F.transform(every, lambda i: block(i, F.col("own")))
    as_pivot = F.transform(every, lambda i: block(F.col("own"), i))
    both = F.when(F.col("pivot"), F.array_union(as_member, as_pivot)).otherwise(as_member)
    dealt = turned.withColumn("shards", shards).withColumn("own", own).withColumn("block", F.explode(both))
    return dealt.select("key", "block.p", "block.m", "node", "component", "n", (F.col("pivot") & (F.col("block.p") == F.col("own"))).alias("pivot"),
                        (F.col("block.m") == F.col("own")).alias("member"), "sketch")


def near_duplicates(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    columns = {"n": "bigint", "digest": "binary", "keys": "array<bigint>", "sketch": "binary"}
    rows = stored(add_columns(base, _signatures(width), columns, keep=["doc_id"]), "signatures")
    # one head for each class of equal sets; an id with several texts may be the head of several
    head = F.min_by(F.struct(F.col("doc_id").alias("node"), "n", "keys", "sketch"), "doc_id").alias("head")
    classes = stored(rows.where("digest IS NOT NULL AND doc_id IS NOT NULL").groupBy("digest").agg(head).select("digest", "head.*"), "classes")
    bands = classes.select("node", F.explode("keys").alias("key"))
    shared = bands.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    met = stored(bands.join(shared, "key").dropDuplicates(["key", "node"]), "buckets")
    # the more rows of others the buckets of a node have, the more copies it is likely to link
    weights = met.groupBy("node").agg(F.sum("members").alias("weight"))
    members = stored(met.select("key", "node").join(classes.select("node", "n", "sketch").join(weights, "node"), "node"), "members")

    inside = classes.select("node", "digest").join(weights, "node", "left_semi")
    wanted = F.broadcast(inside) if weights.count() <= BROADCAST_IDS else inside
    texts = base.withColumnRenamed("doc_id", "node").join(wanted.select("node"), "node", "left_semi")
    sets = add_columns(texts, _sets(width), {"digest": "binary", "hashes": "binary"}, keep=["node"])
    # an id with several texts has a set of each that is the head of its class
    sets = stored(sets.join(wanted, ["node", "digest"], "left_semi").dropDuplicates(["node", "digest"]).drop("digest"), "sets")

    left, labels = members, met.select("node").distinct().withColumn("component", F.col("node"))
    turns, named_nodes, turn = Steps("turn"), Steps("labels"), 0
    while True:
        labelled = left.join(labels, "node") if turn else left.withColumn("component", F.col("node"))
        buckets = labelled.groupBy("key", "component").agg(
            F.count("*").alias("size"), F.max(F.struct("weight", F.bitwise_not("node").alias("flipped"))).alias("top")).groupBy("key").agg(
            F.sum("size").alias("members"), F.count("*").alias("parts"), F.max("top").alias("top"),
            F.max("size").alias("most"), F.max_by("component", F.struct("size", "component")).alias("largest"))
        if turn == 0:
            pivot = F.col("node") == F.bitwise_not(F.col("top.flipped"))
        else:
            # the largest component waits; about 64 ** turn members of the others are compared with all the rest. The same
            # members are taken in all their buckets, so that pairs which share several are verified once
            place = F.pmod(F.xxhash64("node", F.lit(turn)), F.lit(_SHARES))
            pivot = (F.col("component") != F.col("largest")) & (place * (F.col("members") - F.col("most")) < F.lit(_SHARES * float(GROWTH) ** turn))
        turned = turns.write(labelled.join(buckets.where("parts > 1"), "key").select(
            "key", "node", "component", "n", "weight", "sketch", "members", pivot.alias("pivot")))
        if turned.isEmpty():
            break
        blocks = _blocks(turned).repartition("key", "p", "m").sortWithinPartitions("key", "p", "m")
        blocks = blocks.select("key", "p", "m", "node", "component", "n", "pivot", "member", "sketch")
        pairs = blocks.mapInArrow(_compared(percent), "a bigint, b bigint").distinct()
        found = stored(_verified(pairs, sets, percent), "links")
        if not found.isEmpty():
            # the stars of the components so far stand for the links that made them
            links = found.unionByName(labels.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b")))
            labels = named_nodes.write(met.select("node").distinct().join(components(links), "node", "left").select(
                "node", F.coalesce("component", "node").alias("component")))
        # a pivot has now been compared with every other component of its bucket
        left = turned.where("NOT pivot").select("key", "node", "n", "weight", "sketch")
        turn += 1
    turns.clear(docs.sparkSession)

    named = classes.join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    out = rows.select("doc_id", "n", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                      component.eqNullSafe(F.col("doc_id")).alias("kept"))


def deduplicated(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The documents of the smallest id of each group.

    A row that repeats id and text stays once, a row without an id stays. Groups are made of ids, so different texts
    under one id all stay: none of them can be named as the copy.
    """
    named = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id", "text"])
    kept = near_duplicates(docs, width, percent).where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__kept"))
    texts = docs.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__kept")).agg(
        (F.min(F.xxhash64("text")) != F.max(F.xxhash64("text"))).alias("several"))
    ids = kept.unionByName(texts.where("several").select("__kept"))
    return named.join(ids, named.doc_id == F.col("__kept"), "left_semi").unionByName(docs.where("doc_id IS NULL"))

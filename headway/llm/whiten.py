"""Embedding whitening from spectra that partitions grow vector by vector.

Each task keeps the eigendecomposition of its own vectors' scatter and updates it
by one centred rank-one term per vector (``spectra.py``). The tasks' spectra are
combined, again by rank-one updates, in rounds of ``FAN_IN``. The result is an
orthonormal basis; a last pass over all vectors refines it by Rayleigh-Ritz: the
centred vectors are projected on the basis, the small matrix of their products
is summed up by Spark and diagonalised, and the basis is turned accordingly. The
pass makes the components exact to double precision, whatever the order in which
vectors were added.

Defined results: vectors that are null, or hold null, NaN or infinite entries,
are dropped; so are vectors of another length than most (of two equally common
lengths the larger one stays); rows that repeat an id or a vector all count;
entries are cut to +-2^52 after scaling; a component without variance has a NULL
``whitened`` and is left out of ``identity_error``, which is NULL if no component
has any; ``deviation`` is NULL where it does not fit a long; other columns are
never read; no vectors, no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.common import ready_workers, stored
from headway.llm.spectra import Spectrum

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Spectra that one task combines.
FAN_IN = 16
#: Vectors of one Arrow batch.
ROWS = 4096
#: Eigenvalues below this part of the trace count as none.
NOTHING = 1e-13
_LARGEST = float(1 << 52)
_SPECTRUM = "n BIGINT, sums ARRAY<BIGINT>, count DOUBLE, mean ARRAY<DOUBLE>, vals ARRAY<DOUBLE>, vecs ARRAY<DOUBLE>"


def finite_vectors(embeddings: DataFrame) -> DataFrame:
    """``vec_id`` and ``v``, the vectors that count, as doubles."""
    v = F.col("v")
    entry_ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).where(
        v.isNotNull() & F.forall(v, entry_ok))
    common = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return rows.where(F.size("v") == (common["size"] if common else -1))


def whole(batch, column: int, size: int) -> np.ndarray:
    """The vectors of an Arrow batch as the contract's whole numbers."""
    entries = batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
    return np.clip(np.floor(SCALE * entries), -_LARGEST, _LARGEST).astype(np.int64) + OFFSET


def _packed(n: int, sums: np.ndarray, s: Spectrum) -> pa.RecordBatch:
    row = {"n": n, "sums": sums.tolist(), "count": s.count, "mean": s.mean, "vals": s.values, "vecs": s.vectors.ravel()}
    return pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=_SCHEMA)


_SCHEMA = pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.int64())), ("count", pa.float64()), ("mean", pa.list_(pa.float64())),
                     ("vals", pa.list_(pa.float64())), ("vecs", pa.list_(pa.float64()))])


def _unpacked(row: dict) -> Spectrum:
    size = len(row["mean"])
    return Spectrum(size, row["count"], np.array(row["mean"]), np.array(row["vals"]), np.array(row["vecs"]).reshape(size, size))


def _grow(size: int):
    def run(batches):
        n, sums, spectrum = 0, np.zeros(size, np.int64), Spectrum(size)
        for batch in batches:
            x = whole(batch, 0, size)
            n, sums = n + len(x), sums + x.sum(axis=0)
            for row in (x - OFFSET).astype(float):
                spectrum.add(row)
        if n:
            yield _packed(n, sums, spectrum)
    return run


def _combine(table: pa.Table) -> pa.Table:
    rows = table.to_pylist()
    spectrum = _unpacked(rows[0])
    for row in rows[1:]:
        spectrum = spectrum.combine(_unpacked(row))
    sums = sum(np.array(r["sums"], np.int64) for r in rows)
    return pa.Table.from_batches([_packed(sum(r["n"] for r in rows), sums, spectrum)])


def combined_spectrum(vectors: DataFrame, size: int):
    """Number, sums and spectrum of all vectors as one row, or None without vectors.

    A round combines groups of ``FAN_IN`` spectra; each is written, so a lost executor repeats one round at most.
    """
    spectra = vectors.select("v").mapInArrow(_grow(size), _SPECTRUM)
    left = max(vectors.rdd.getNumPartitions(), 1)
    spectra = spectra.withColumn("group", F.spark_partition_id())
    while True:
        spectra = stored(spectra.withColumn("group", F.floor(F.col("group") / FAN_IN).cast("int")), "spectra")
        left = -(-left // FAN_IN)
        numbers = spectra.schema.fieldNames()[:-1]
        merged = spectra.groupBy("group").applyInArrow(_with_group, _SPECTRUM + ", group INT")
        if left == 1:
            return merged.select(*numbers).first()
        spectra = merged


def _with_group(key: tuple, table: pa.Table) -> pa.Table:
    out = _combine(table.drop_columns(["group"]))
    return out.append_column("group", pa.array([key[0].as_py()], pa.int32()))


def centre(n: int, sums) -> tuple[np.ndarray, np.ndarray]:
    """The mean as whole numbers and a rest, so that centring loses no digits."""
    near = np.array([s // n for s in sums], np.int64)
    return near, np.array([(s - int(c) * n) / n for s, c in zip(sums, near)])


def summed_products(vectors: DataFrame, size: int, project) -> tuple[int, np.ndarray, np.ndarray]:
    """Number, sums and products of the projected vectors, added up by Spark entry by entry."""
    def run(batches):
        n, sums, products = 0, 0.0, 0.0
        for batch in batches:
            y = project(whole(batch, 0, size))
            n, sums, products = n + len(y), sums + y.sum(axis=0), products + y.T @ y
        if n:
            values = np.concatenate([[n], sums, products.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["at", "value"])

    found = vectors.select("v").mapInArrow(run, "at INT, value DOUBLE").groupBy("at").agg(F.sum("value").alias("value"))
    flat = np.array([r["value"] for r in found.orderBy("at").collect()])  # the square of the components, whatever the input
    k = int(np.sqrt(len(flat)))
    k = next(x for x in (k, k - 1) if 1 + x + x * x == len(flat))
    return int(flat[0]), flat[1:1 + k], flat[1 + k:].reshape(k, k)


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component."""
    spark = embeddings.sparkSession
    ready_workers(spark, ROWS)
    ddl = "vec_id BIGINT, component INT, n BIGINT, deviation BIGINT, whitened DOUBLE, explained DOUBLE, identity_error DOUBLE"
    vectors = finite_vectors(embeddings)
    head = vectors.select(F.size("v").alias("size")).first()
    size = head["size"] if head else 0
    if size <= 0:
        return spark.createDataFrame([], ddl)
    # the first guess, from rank-one updates
    row = combined_spectrum(vectors, size).asDict()
    n, sums, basis = row["n"], [int(x) for x in row["sums"]], _unpacked(row).vectors
    near, rest = centre(n, sums)
    # Rayleigh-Ritz on all vectors
    _, _, products = summed_products(vectors, size, lambda x: ((x - near) - rest) @ basis)
    values, turn = np.linalg.eigh((products + products.T) / (2 * n))
    values, basis = values[::-1], basis @ turn[:, ::-1]
    trace, used = max(values.sum(), 0.0), min(components, size)
    live = values[:used] > NOTHING * trace
    scaled = basis[:, :used] / np.sqrt(np.where(live, values[:used], 1.0))
    explained = [float(v / trace) if trace > 0 else None for v in np.where(live, values[:used], 0.0)]
    # what the whitened vectors' covariance is, measured on them
    error = None
    if live.any():
        m, total, products = summed_products(vectors, size, lambda x: ((x - near) - rest) @ scaled[:, live])
        error = float(np.abs(products / m - np.outer(total / m, total / m) - np.eye(live.sum())).max())
    exact = np.array(sums, object)

    def run(batches):
        for batch in batches:
            x = whole(batch, 1, size)
            found = pa.array(list(np.where(live, ((x - near) - rest) @ scaled, np.nan)), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviations(x, n, exact), found], ["vec_id", "deviation", "w"])

    rows = vectors.mapInArrow(run, "vec_id BIGINT, deviation BIGINT, w ARRAY<DOUBLE>")
    rows = rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "w"))
    return rows.select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation",
        F.when(~F.isnan("w"), F.col("w")).alias("whitened"),
        F.element_at(F.array(*[F.lit(x).cast("double") for x in explained]), F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"))


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum over the dimensions of (n x - S) squared, exactly; NULL beyond a long."""
    if not len(x):
        return pa.array([], pa.int64())
    bound = n * max(int(np.abs(x).max()), 1)
    if bound < 1 << 62 and max(abs(s) for s in sums) < 1 << 62:
        away = n * x - sums.astype(np.int64)
        if int(np.abs(away).max()) ** 2 * x.shape[1] < 1 << 63:
            return pa.array((away * away).sum(axis=1), pa.int64())
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x]
    return pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())

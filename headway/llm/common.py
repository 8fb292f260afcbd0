"""Helpers shared by the text operators: scratch tables, Arrow column maps, word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.session import delete_folder, scratch_dir

#: Rows of one Arrow batch. Texts are whole, so the batch size is what bounds a Python worker's memory.
BATCH_ROWS = 256
#: Entries of a worker's word caches; a full cache is emptied, which changes speed and no result.
CACHE_WORDS = 300_000

ARROW = {
    "bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()), "array<double>": pa.list_(pa.float64()),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_workers(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Make Python workers ready: the package is there, and the rows that one holds at a time are bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application; they need not have the repository on their path."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="headway-code-")) / "headway_package.zip"
    with zipfile.ZipFile(target, "w") as z:
        for path in sorted(root.rglob("*.py")):
            z.write(path, path.relative_to(root.parent))
    context.addPyFile(str(target))
    _SHIPPED.add(context.applicationId)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it back: lineage ends there, and a lost executor costs nothing."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Steps:
    """A table that a loop writes anew in each step: once the next one is whole, the one before it goes."""

    def __init__(self, label: str):
        self.label, self.path = label, None

    def write(self, df: DataFrame) -> DataFrame:
        spark, before = df.sparkSession, self.path
        path = scratch_dir(spark, self.label)
        df.write.parquet(path)
        self.path = path
        if before:
            delete_folder(spark, before)
        return spark.read.schema(df.schema).parquet(path)

    def clear(self, spark: SparkSession) -> None:
        """Remove the last table too; nothing may read it any more."""
        if self.path:
            delete_folder(spark, self.path)
            self.path = None


def add_columns(df: DataFrame, make, columns: dict[str, str], text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Append columns computed from one column, task by task.

    ``make()`` runs once per task and returns a function from a list of values to
    one list per new column. The kept columns pass through as Arrow arrays, so
    nulls and 64-bit ids stay as they are.
    """
    ready_workers(df.sparkSession)
    keep = df.columns if keep is None else keep
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in columns.items())
    schema = T.StructType([*df.select(*map(quoted, keep)).schema.fields, *T.StructType.fromDDL(ddl).fields])
    kinds, names = [ARROW[k] for k in columns.values()], [*keep, *columns]
    source = df.select(*map(quoted, keep), F.col(quoted(text)).alias("__input"))
    at = len(keep)

    def run(batches):
        compute = make()
        for batch in batches:
            made = compute(batch.column(at).to_pylist())
            arrays = [*batch.columns[:at], *(pa.array(x, kind) for x, kind in zip(made, kinds, strict=True))]
            yield pa.RecordBatch.from_arrays(arrays, names)

    return source.mapInArrow(run, schema)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def flat_map(df: DataFrame, make, ddl: str) -> DataFrame:
    """``make()`` runs once per task and returns a function from an Arrow batch to an iterable of dicts of lists."""
    ready_workers(df.sparkSession)
    schema = T.StructType.fromDDL(ddl)
    kinds = [(f.name, ARROW[f.dataType.simpleString()]) for f in schema.fields]

    def run(batches):
        work = make()
        for batch in [*[None]] if batches is None else batches:
            for out in work(batch):
                yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in kinds], [n for n, _ in kinds])
        if hasattr(work, "finish"):
            for out in work.finish():
                yield pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in kinds], [n for n, _ in kinds])

    return df.mapInArrow(run, schema)


class WordHashes:
    """64-bit hashes of words, remembered while they fit."""

    def __init__(self, seed: int = 0):
        self.seed, self.seen = seed, {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        seen, seed = self.seen, self.seed
        try:
            return np.array([seen[w] for w in words], np.uint64)
        except KeyError:
            pass
        if len(seen) > CACHE_WORDS:
            seen.clear()
        one = xxhash.xxh3_64_intdigest
        for w in set(words):
            if w not in seen:
                seen[w] = one(w, seed)
        return np.array([seen[w] for w in words], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ascii_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8."""
    return text.encode().lower().split() if text else []


_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9),
        np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Distinct hashes of the windows of ``width`` words, sorted; a shorter text is one shingle, an empty one none."""
    n = len(hashes)
    if n == 0:
        return hashes
    if n < width:
        total = np.array([n], np.uint64)
        for i in range(n):
            total = mixed(total * _ODD[0] + hashes[i:i + 1])
        return total
    total = np.zeros(n - width + 1, np.uint64)
    for i in range(width):
        total = mixed(total + hashes[i:n - width + 1 + i] * _ODD[i % 5]) if i else hashes[:n - width + 1] * _ODD[0]
    return np.unique(total)

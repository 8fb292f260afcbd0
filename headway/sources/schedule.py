"""Schedule files: CSV with a header row, one folder per feed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import contracts as C


def scan_gtfs_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A schedule file as it is; give a schema where known, as inference reads the file twice.

    The schema lists the columns of the file in their order.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def _load(spark: SparkSession, path: str, columns: dict[str, tuple]) -> DataFrame:
    """Project a file to the contract's columns, whatever its column order.

    Only the header is read here. An absent optional column gets its default,
    an empty optional field is the empty text, and a value that is no number
    fails the job when it is read.
    """
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    missing = [n for n, (_, required, _) in columns.items() if required and n not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    projected = []
    for name, (kind, required, default) in columns.items():
        if name not in raw.columns:
            projected.append(F.lit(default).cast(kind).alias(name))
        elif kind == "STRING":
            # the CSV reader turns an empty field into NULL; here it is text
            projected.append(F.coalesce(F.col(name), F.lit("")).alias(name))
        else:
            projected.append(F.col(name).cast(kind).alias(name))
    return raw.select(*projected)


def load_stops(spark: SparkSession, folder: str) -> DataFrame:
    return _load(spark, f"{folder}/stops.txt", C.STOP_COLUMNS)


def load_routes(spark: SparkSession, folder: str) -> DataFrame:
    return _load(spark, f"{folder}/routes.txt", C.ROUTE_COLUMNS)


def load_trips(spark: SparkSession, folder: str) -> DataFrame:
    return _load(spark, f"{folder}/trips.txt", C.TRIP_COLUMNS)


def load_stop_times(spark: SparkSession, folder: str) -> DataFrame:
    return _load(spark, f"{folder}/stop_times.txt", C.STOP_TIME_COLUMNS)


def load_schedule_bundle(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three tables of a schedule folder, by name."""
    return {
        "stops": load_stops(spark, folder),
        "routes": load_routes(spark, folder),
        "trips": load_trips(spark, folder),
    }


def bundle_counts(bundle: dict[str, DataFrame]) -> DataFrame:
    """Rows per table of a bundle."""
    counts = None
    for name, table in bundle.items():
        one = table.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table_name"), "records")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def preview(table: DataFrame, *, by: str, top: int = 10) -> DataFrame:
    """The first rows of a table in key order."""
    return table.orderBy(by).limit(top)

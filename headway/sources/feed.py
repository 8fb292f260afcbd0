"""Landed feed snapshots, decoded into the nested message schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.contracts import FEED_MESSAGE


# the column that takes a message that does not parse
UNREADABLE = "unreadable"
_WITH_UNREADABLE = f"{FEED_MESSAGE}, {UNREADABLE} STRING"


def _parsed(lines: DataFrame) -> DataFrame:
    """Lines of text as messages; a line that is no message has its text in ``unreadable`` and nothing else."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": UNREADABLE}
    message = F.from_json("value", _WITH_UNREADABLE, options)
    rows = lines.where(F.trim("value") != "").select("value", message.alias("m"))
    # an array is no message, though Spark would take its elements for rows
    bad = F.col("m").isNull() | F.col(f"m.{UNREADABLE}").isNotNull() | ~F.trim("value").startswith("{")
    fields = [F.when(~bad, F.col(f"m.{name}")).alias(name) for name in ("header", "entity")]
    return rows.select(*fields, F.when(bad, F.col("value")).alias(UNREADABLE))


def _must_be_lines(file_format: str) -> None:
    if file_format != "json":
        raise ValueError("only JSON lines can be unreadable one by one")


def scan_feed(spark: SparkSession, path: str, *, file_format: str = "parquet", keep_unreadable: bool = False) -> DataFrame:
    """All landed messages; files of JSON lines or Parquet.

    With ``keep_unreadable`` a line that is no message has its text in ``unreadable`` and nothing else.
    """
    if keep_unreadable:
        _must_be_lines(file_format)
        return _parsed(spark.read.text(path))
    return spark.read.schema(FEED_MESSAGE).format(file_format).load(path)


def stream_feed(spark: SparkSession, path: str, *, file_format: str = "parquet",
                max_files_per_trigger: int | None = None, keep_unreadable: bool = False) -> DataFrame:
    """Messages as they land; ``keep_unreadable`` as for `scan_feed`."""
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if keep_unreadable:
        _must_be_lines(file_format)
        return _parsed(reader.text(path))
    return reader.schema(FEED_MESSAGE).format(file_format).load(path)


def readable(messages: DataFrame) -> DataFrame:
    """Messages that parsed whole: a field of another type than the contract's makes a line unreadable too."""
    return messages.where(F.col(UNREADABLE).isNull()).drop(UNREADABLE)


def dead_letters(messages: DataFrame) -> DataFrame:
    """Lines that did not parse, with the time they were read, for `bronze.dead_letters`."""
    return messages.where(F.col(UNREADABLE).isNotNull()).select(
        F.current_timestamp().alias("received_at"), F.col(UNREADABLE).alias("message"))

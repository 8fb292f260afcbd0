"""The layered tables: creation, idempotent appends and gold refresh."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from headway import contracts as C
from headway.operators.fleet import (
    hourly_from_partials, hourly_partials, merged_hourly_partials, merged_route_partials, route_from_partials, route_partials,
)
from headway.operators.medallion import first_batch_only, first_per_event, layer_metrics, silver_filter, upsert
from headway.session import configure, delete_folder, observed

# table -> (columns, time column whose date partitions it, has a batch partition)
TABLES = {
    "bronze.vehicle_positions": (f"ingestion_timestamp TIMESTAMP, {C.VEHICLE_POSITION}", "feed_timestamp", True),
    "bronze.trip_updates": (f"ingestion_timestamp TIMESTAMP, {C.TRIP_UPDATE}", "timestamp", True),
    "bronze.weather_observations": (
        f"ingestion_timestamp TIMESTAMP, {C.WEATHER_OBSERVATION}", "observation_time", True),
    "bronze.quality_alerts": (C.QUALITY_ALERT, "detected_at", True),
    "bronze.weather_alerts": (C.QUALITY_ALERT, "detected_at", True),
    "bronze.dead_letters": ("received_at TIMESTAMP, message STRING", "received_at", True),
    "silver.vehicle_positions": (f"ingestion_timestamp TIMESTAMP, {C.VEHICLE_POSITION}", "timestamp", True),
    "silver.trip_updates": (f"ingestion_timestamp TIMESTAMP, {C.TRIP_UPDATE}", "timestamp", True),
    "silver.weather_observations": (
        f"ingestion_timestamp TIMESTAMP, {C.WEATHER_OBSERVATION}", "observation_time", True),
    "silver.seen_vehicles": ("vehicle_id STRING", None, True),
    "silver.outbox": (C.MESSAGE, None, True),
    "silver.weather_outbox": (C.MESSAGE, None, True),
    "silver.deliveries": ("messages BIGINT, delivered_at TIMESTAMP", None, True),
    "silver.weather_deliveries": ("messages BIGINT, delivered_at TIMESTAMP", None, True),
    "gold.hourly_partials": (C.HOURLY_PARTIALS, "hour_timestamp", True),
    "gold.route_partials": (C.ROUTE_PARTIALS, "date", True),
    "gold.hourly_vehicle_metrics": (C.HOURLY_METRICS, "hour_timestamp", False),
    "gold.route_performance": (C.ROUTE_PERFORMANCE, "date", False),
    "gold.feed_progress": (
        "processed_rows BIGINT, valid_rows BIGINT, invalid_rows BIGINT, silver_rows BIGINT, as_of TIMESTAMP", None, True),
}
# table -> the column whose hash buckets it
BUCKETED = {"silver.seen_vehicles": "vehicle_id"}
# tables whose rows of several batches add up to one when they are compacted
MERGEABLE = {"gold.hourly_partials": merged_hourly_partials, "gold.route_partials": merged_route_partials}
# tables whose batches are numbered by the weather stream; all others follow the feed
WEATHER_TABLES = ("bronze.weather_observations", "bronze.weather_alerts", "silver.weather_observations",
                  "silver.weather_outbox", "silver.weather_deliveries")

# what Spark names the partition of rows without a date
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
# batches between two full copies of the promoted ids
SEEN_FOLD = 100
SEEN_BUCKETS = 16
# batches that can still be replayed after a compaction: a day of them, at two a minute
REPLAY_WINDOW = 2880


class RetiredBatch(ValueError):
    """A batch whose rows were compacted cannot be written again."""


@dataclass(frozen=True)
class StagedUpsert:
    """New content of the touched dates, written but not visible until `commit`."""

    layers: "Layers"
    table: str
    folder: str
    dates: tuple[str, ...]
    filled: frozenset[str]

    def commit(self) -> None:
        """Point the table's dates to the new files; each date changes in one catalog step, and again is no harm."""
        spark, name = self.layers.spark, self.layers.name(self.table)
        known = {date for date, _ in self.layers.partitions(self.table)}
        for date in self.dates:
            part = f"PARTITION (event_date = {_date_value(date)})"
            place = f"LOCATION '{self.folder}/event_date={date}'"
            if date in self.filled:
                verb = f"{part} SET {place}" if date in known else f"ADD {part} {place}"
                spark.sql(f"ALTER TABLE {name} {verb}")
            elif date in known:
                spark.sql(f"ALTER TABLE {name} DROP {part}")
        spark.catalog.refreshTable(name)


def _date_value(date: str) -> str:
    return "NULL" if date == NO_DATE else f"DATE '{date}'"


def _date_text(date) -> str:
    return NO_DATE if date is None else str(date)


def replace_table(df: DataFrame, name: str) -> None:
    """Create the table from a query, or replace it."""
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


class Layers:
    """Bronze, silver and gold tables below one root folder.

    Every append is the content of a batch: it takes the place of all that the
    batch wrote before, under any date, so a repeated batch leaves the tables as
    one run would.
    Time-keyed tables are also partitioned by date, which prunes the scans of
    the silver and gold steps. Gold is kept by upserts of partial sums.
    """

    def __init__(self, spark: SparkSession, root: str, prefix: str = ""):
        # without dynamic overwrite a batch would replace the whole table
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        self.prefix = prefix

    def name(self, table: str) -> str:
        schema, short = table.split(".")
        return f"{self.prefix}{schema}.{short}"

    def table(self, table: str) -> DataFrame:
        """The table with the columns of its contract."""
        return self.with_partitions(table).select(*C.column_names(TABLES[table][0]))

    def with_partitions(self, table: str) -> DataFrame:
        """The table with its partition columns too, without files that a compaction has replaced or not finished."""
        rows = self.spark.table(self.name(table))
        if not TABLES[table][2]:
            return rows
        low, generation = self.marks(table)
        if generation == 0:
            return rows.where(F.col("batch_id") >= 0)
        batch = F.col("batch_id")
        return rows.where((batch > low) | ((batch < 0) & (batch >= -generation)))

    def init(self) -> "Layers":
        """Create what does not exist yet; tables that exist are left alone."""
        for schema in ("bronze", "silver", "gold"):
            self.spark.sql(
                f"CREATE SCHEMA IF NOT EXISTS {self.prefix}{schema} LOCATION '{self.root}/{schema}'"
            )
        for table, (columns, time_column, batched) in TABLES.items():
            parts = (["event_date"] if time_column else []) + (["batch_id"] if batched else [])
            extra = (", event_date DATE" if time_column else "") + (", batch_id BIGINT" if batched else "")
            buckets = f"CLUSTERED BY ({BUCKETED[table]}) INTO {SEEN_BUCKETS} BUCKETS " if table in BUCKETED else ""
            schema, short = table.split(".")
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({columns}{extra}) USING parquet "
                f"PARTITIONED BY ({', '.join(parts)}) {buckets}LOCATION '{self.root}/{schema}/{short}'"
            )
        return self

    def partitions(self, table: str, batch_id: int | None = None) -> list[tuple[str | None, int | None]]:
        """Date and batch of the table's partitions, from the catalog alone."""
        part = "" if batch_id is None else f" PARTITION (batch_id = {batch_id})"
        found = []
        for row in self.spark.sql(f"SHOW PARTITIONS {self.name(table)}{part}").collect():
            values = dict(x.split("=", 1) for x in row[0].split("/"))
            found.append((values.get("event_date"), int(values["batch_id"]) if "batch_id" in values else None))
        return found

    def write_batch(self, table: str, df: DataFrame, batch_id: int | None = None, *, measures: dict | None = None) -> dict:
        """Put rows in place of all that the batch has in the table, or else of the dates they belong to.

        Returns the number of ``rows`` and the ``measures`` (name to aggregate), observed while the rows are written.
        The rows come first, then the dates that only an earlier try had are emptied; a batch has one writer.
        """
        columns, time_column, batched = TABLES[table]
        before = []
        if batched and batch_id >= 0:
            low = self.marks(table)[0]
            if batch_id <= low:
                raise RetiredBatch(f"batch {batch_id} of {table} is compacted; only batches after {low} can be written")
            before = self.partitions(table, batch_id)
        seen = Observation(f"{table} {uuid.uuid4().hex}")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in (measures or {}).items()])
        rows = df.select(
            *C.column_names(columns),
            *([F.to_date(time_column).alias("event_date")] if time_column else []),
            *([F.lit(batch_id).cast("bigint").alias("batch_id")] if batched else []),
        )
        if before:
            self._empty_other_dates(table, rows, batch_id, before)
        if time_column:
            # gather each date into few files; AQE splits a large date and joins small ones
            rows = rows.hint("rebalance", "event_date")
        elif table in BUCKETED:
            rows = rows.repartition(SEEN_BUCKETS, BUCKETED[table])  # one file to a bucket
        rows.write.mode("overwrite").insertInto(self.name(table))
        # a stream writes through a session of its own, whose refresh this one does not see
        self.spark.catalog.refreshTable(self.name(table))
        return observed(seen, "rows", *(measures or {}))

    def _empty_other_dates(self, table: str, rows: DataFrame, batch_id: int, before: list) -> None:
        """Empty what an earlier try of the batch wrote and the new rows do not overwrite; usually nothing."""
        name = self.name(table)
        if TABLES[table][1]:
            now = {_date_text(r["event_date"]) for r in rows.select("event_date").distinct().collect()}
            left = [date for date, _ in before if date not in now]
        else:
            left = [] if rows.limit(1).count() else [None]
        for date in left:
            day = f"event_date = {_date_value(date)}, " if date else ""
            nulls = ", ".join(["NULL"] * len(C.column_names(TABLES[table][0])))
            self.spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({day}batch_id = {batch_id}) SELECT {nulls} WHERE false")

    # --- upsert -------------------------------------------------------------------

    def stage_upsert(self, table: str, changes: DataFrame, keys: list[str], *, order_by: str | None = None,
                     replace: DataFrame | None = None) -> StagedUpsert:
        """Write the touched dates of a table without batches anew, with the changes put in by key.

        ``replace`` (values of the time column) names rows that go even if no change has their key. Nothing is visible
        before `StagedUpsert.commit`; files of an abandoned stage are never read. The touched dates are listed on the
        driver: days of the calendar, however many rows they have.
        """
        columns, time_column, _ = TABLES[table]
        names = C.column_names(columns)
        with_date = F.to_date(time_column).alias("event_date")
        touched = changes.select(with_date) if replace is None else changes.select(with_date).unionByName(replace.select(with_date))
        dates = [r["event_date"] for r in touched.distinct().collect()]
        current = self.spark.table(self.name(table))
        in_dates = F.col("event_date").isin([d for d in dates if d is not None])
        current = current.where(in_dates | F.col("event_date").isNull() if None in dates else in_dates).select(*names)
        if replace is not None:
            current = current.join(replace.select(time_column).distinct(), time_column, "left_anti")
        typed = [F.col(f.name).cast(f.dataType) for f in current.schema]
        rows = upsert(current, changes.select(*typed), keys, order_by=order_by).select(*names, with_date)
        schema, short = table.split(".")
        folder = f"{self.root}/{schema}/{short}_versions/{uuid.uuid4().hex}"
        rows.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder).select("event_date").distinct().collect()
        return StagedUpsert(self, table, folder, tuple(map(_date_text, dates)), frozenset(_date_text(r[0]) for r in written))

    def upsert(self, table: str, changes: DataFrame, keys: list[str], **options) -> None:
        """Insert rows or put them in place of those with their key, in the table itself."""
        self.stage_upsert(table, changes, keys, **options).commit()

    # --- compaction ---------------------------------------------------------------

    def marks(self, table: str) -> tuple[int, int]:
        """The last batch that is compacted and the number of compactions, both in one property of the table."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").where("key = 'headway.compacted'").first()
        low, generation = found["value"].split("/") if found else (-1, 0)
        return int(low), int(generation)

    def compact(self, *, keep: int = REPLAY_WINDOW, tables: list[str] | None = None) -> dict[str, int]:
        """Rewrite all batches but the last ``keep`` of each table into one partition per date; returns the low marks.

        Compacted batches are retired: `write_batch` refuses them. A compaction writes only rows that no earlier one
        wrote, under a negative batch number, and one table property then hides the old partitions and shows the new
        ones, so a reader of this class meets each row once at any time. The old files are dropped afterwards, and an
        interrupted compaction is simply run again.
        """
        newest = {False: self._newest("gold.feed_progress"), True: self._newest("bronze.weather_observations")}
        done = {}
        for table, (columns, time_column, batched) in TABLES.items():
            if not batched or (tables is not None and table not in tables):
                continue
            if table in BUCKETED:
                self._drop_folded(table, newest[False] - keep)
                continue
            (low, generation), target = self.marks(table), newest[table in WEATHER_TABLES] - keep
            self._drop_batches(table, low)  # what a compaction that was cut short left
            done[table] = max(low, target)
            if target <= low:
                continue
            names = C.column_names(columns)
            rows = self.with_partitions(table).where((F.col("batch_id") > low) & (F.col("batch_id") <= target))
            if table in MERGEABLE:
                rows = MERGEABLE[table](rows)
            self._empty_batch(table, -generation - 1)
            self.write_batch(table, rows.select(*names), -generation - 1)
            self.spark.sql(f"ALTER TABLE {self.name(table)} SET TBLPROPERTIES ('headway.compacted' = '{target}/{generation + 1}')")
            self._drop_batches(table, target)
        return done

    def _newest(self, table: str) -> int:
        return max((batch for _, batch in self.partitions(table)), default=-1)

    def _empty_batch(self, table: str, batch_id: int) -> None:
        """Drop the partitions of a compaction that was cut short before it counted."""
        for date, _ in self.partitions(table, batch_id):
            self._drop(table, date, batch_id)

    def _drop_batches(self, table: str, low: int) -> None:
        for date, batch in self.partitions(table):
            if 0 <= batch <= low:
                self._drop(table, date, batch)

    def _drop_folded(self, table: str, low: int) -> None:
        """Drop ids that the last full copy before the replay window holds too."""
        start = max(low, 0) // SEEN_FOLD * SEEN_FOLD
        if self.partitions(table, start):
            self._drop_batches(table, start - 1)

    def _drop(self, table: str, date: str | None, batch_id: int) -> None:
        day = f"event_date = {_date_value(date)}, " if date else ""
        self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS PARTITION ({day}batch_id = {batch_id})")
        schema, short = table.split(".")
        path = f"{self.root}/{schema}/{short}/" + (f"event_date={date}/" if date else "") + f"batch_id={batch_id}"
        delete_folder(self.spark, path)

    # --- bronze -------------------------------------------------------------------

    def store_bronze(self, table: str, df: DataFrame, batch_id: int, *, ingested_at=None, measures: dict | None = None) -> dict:
        stamp = F.current_timestamp() if ingested_at is None else ingested_at
        return self.write_batch(table, df.withColumn("ingestion_timestamp", stamp), batch_id, measures=measures)

    def append_bronze(self, table: str, df: DataFrame, batch_id: int, *, ingested_at=None) -> int:
        """Append records as they came, stamped with the ingestion time; returns their number, observed by the write."""
        return self.store_bronze(table, df, batch_id, ingested_at=ingested_at)["rows"]

    def append_positions(self, df: DataFrame, batch_id: int, **stamp) -> int:
        return self.append_bronze("bronze.vehicle_positions", df, batch_id, **stamp)

    def append_trip_updates(self, df: DataFrame, batch_id: int, **stamp) -> int:
        return self.append_bronze("bronze.trip_updates", df, batch_id, **stamp)

    def append_weather(self, df: DataFrame, batch_id: int, **stamp) -> int:
        return self.append_bronze("bronze.weather_observations", df, batch_id, **stamp)

    def batch(self, table: str, batch_id: int) -> DataFrame:
        """The rows a batch wrote, read back from storage."""
        columns = C.column_names(TABLES[table][0])
        return self.with_partitions(table).where(F.col("batch_id") == batch_id).select(*columns)

    # --- silver and gold -----------------------------------------------------------

    def seen_before(self, batch_id: int) -> DataFrame:
        """Ids promoted by batches before this one.

        Every ``SEEN_FOLD``-th batch stores all ids so far, so at most that many
        small partitions are read, however long the stream has run.
        """
        seen = self.with_partitions("silver.seen_vehicles").where(F.col("batch_id") < batch_id)
        start = max(batch_id - 1, 0) // SEEN_FOLD * SEEN_FOLD
        if not self.partitions("silver.seen_vehicles", start):
            return seen  # nothing promoted at that batch, or batch ids with holes
        return seen.where(F.col("batch_id") >= start)

    def promote(self, rows: DataFrame, batch_id: int, *, as_of=None, history: bool = False) -> int:
        """Move fit rows to silver, store the sums they add to gold and return their number: those of vehicles that no
        earlier batch promoted, or with ``history`` those whose vehicle and time are new.

        The ids promoted so far are kept in their own small table, bucketed by id, so a batch never scans silver; the
        history rule reads silver's rows of the batch's dates.
        """
        fit = silver_filter(rows, as_of=as_of)
        if history:
            dates = fit.select(F.to_date("timestamp").alias("event_date")).distinct()
            earlier = self.with_partitions("silver.vehicle_positions").where(F.col("batch_id") < batch_id)
            fresh = first_per_event(fit, earlier.join(dates, "event_date", "left_semi"))
            written = self.write_batch("silver.vehicle_positions", fresh.select(*rows.columns), batch_id)["rows"]
            self.add_partials("gold.hourly_partials", batch_id)
            return written
        seen = self.seen_before(batch_id)
        written = self.write_batch("silver.vehicle_positions", first_batch_only(fit, seen), batch_id)["rows"]
        promoted = self.batch("silver.vehicle_positions", batch_id).select("vehicle_id")
        if batch_id and batch_id % SEEN_FOLD == 0:
            promoted = promoted.unionByName(seen.select("vehicle_id"))
        self.write_batch("silver.seen_vehicles", promoted.distinct(), batch_id)
        self.add_partials("gold.hourly_partials", batch_id)
        return written

    def add_partials(self, table: str, batch_id: int) -> None:
        """Store the sums that a batch adds to gold; gold follows with the next refresh.

        Hours and dates that an earlier try of the batch touched and this one does not are refreshed at once, as no
        later refresh would know of them.
        """
        source, sums, refresh = {
            "gold.hourly_partials": ("silver.vehicle_positions", hourly_partials, self._refresh_hours),
            "gold.route_partials": ("silver.trip_updates", route_partials, self._refresh_dates)}[table]
        time_column = TABLES[table][1]
        old = set(self._marked(self.batch(table, batch_id), time_column)) if self.partitions(table, batch_id) else set()
        self.write_batch(table, sums(self.batch(source, batch_id)), batch_id)
        if old:
            refresh(sorted(old - set(self._marked(self.batch(table, batch_id), time_column))))

    @staticmethod
    def _marked(rows: DataFrame, time_column: str) -> list[tuple]:
        """Hours or dates of rows, as (number, date), on the driver: marks of the calendar, however many rows they have.

        Both rules before gold refuse rows without a time, so none is NULL.
        """
        kind = rows.schema[time_column].dataType.simpleString()
        number = F.unix_date(time_column) if kind == "date" else F.unix_micros(time_column)
        found = rows.where(F.col(time_column).isNotNull()).select(number.alias("n"), F.to_date(time_column).alias("d")).distinct()
        return [(r["n"], r["d"]) for r in found.collect()]

    @staticmethod
    def _moment(number, kind: str):
        return F.date_from_unix_date(F.lit(number)) if kind == "date" else F.timestamp_micros(F.lit(number))

    def _touched(self, table: str, since_batch: int | None) -> list[tuple]:
        rows = self.with_partitions(table)
        if since_batch is not None and since_batch > self.marks(table)[0]:
            rows = rows.where(F.col("batch_id") >= since_batch)
        return self._marked(rows, TABLES[table][1])

    def partials_of(self, table: str, marks: list[tuple]) -> DataFrame:
        """Partial sums of some hours or dates: other dates' partitions are not listed, other hours' row groups not read."""
        time_column = TABLES[table][1]
        rows = self.with_partitions(table)
        kind = rows.schema[time_column].dataType.simpleString()
        return rows.where(F.col("event_date").isin(sorted({d for _, d in marks}))
                          & F.col(time_column).isin([self._moment(n, kind) for n, _ in marks]))

    def _refresh_hours(self, hours: list[tuple]) -> None:
        if hours:
            rows = hourly_from_partials(self.partials_of("gold.hourly_partials", hours))
            self._replace("gold.hourly_vehicle_metrics", rows, hours, ["hour_timestamp", "agency_id", "route_id"])

    def _refresh_dates(self, dates: list[tuple]) -> None:
        if dates:
            rows = route_from_partials(self.partials_of("gold.route_partials", dates))
            self._replace("gold.route_performance", rows, dates, ["date", "agency_id", "route_id"])

    def _replace(self, table: str, rows: DataFrame, marks: list[tuple], keys: list[str]) -> None:
        kind = self.spark.table(self.name(table)).schema[keys[0]].dataType.simpleString()
        scope = self.spark.createDataFrame([(n,) for n, _ in marks], f"n {'INT' if kind == 'date' else 'BIGINT'}")
        made = F.date_from_unix_date("n") if kind == "date" else F.timestamp_micros("n")
        self.upsert(table, rows, keys, replace=scope.select(made.alias(keys[0])))

    def refresh_hourly(self, since_batch: int | None = None) -> None:
        """Bring the hourly metrics of the hours that batches since ``since_batch`` touched up to date, and no others."""
        self._refresh_hours(self._touched("gold.hourly_partials", since_batch))

    def refresh_route_performance(self, since_batch: int | None = None) -> None:
        """Bring the delays of the dates that batches since ``since_batch`` touched up to date."""
        self._refresh_dates(self._touched("gold.route_partials", since_batch))

    def metrics(self) -> DataFrame:
        return layer_metrics(
            self.table("bronze.vehicle_positions"), self.table("bronze.trip_updates"),
            self.table("bronze.weather_observations"), self.table("silver.vehicle_positions"),
            self.table("gold.hourly_vehicle_metrics"),
        )

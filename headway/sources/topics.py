"""Messages on topics: key, JSON value, and the connector options to move them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway import contracts as C
from headway.functions.times import iso_utc

# fixed values: delivery settings of the producer and consumer
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "snappy", "kafka.retries": "3",
                    "kafka.max.in.flight.requests.per.connection": "5"}
CONSUMER_GROUP = "headway-consumer"


def to_messages(df: DataFrame, *, key: str, topic: str) -> DataFrame:
    """Rows as messages: the key column, all columns as a JSON object, the topic.

    Absent values stay in the object as null, and times are ISO-8601 in UTC.
    """
    def field(name: str, kind: str) -> Column:
        return (iso_utc(F.col(name)) if kind.startswith("timestamp") else F.col(name)).alias(name)

    record = F.struct(*[field(name, kind) for name, kind in df.dtypes])
    return df.select(
        F.col(key).cast("string").alias("key"),
        F.to_json(record, {"ignoreNullFields": "false"}).alias("value"),
        F.lit(topic).alias("topic"),
    )


def vehicle_messages(positions: DataFrame, topic: str = C.TOPIC_VEHICLES) -> DataFrame:
    return to_messages(positions, key="vehicle_id", topic=topic)


def trip_update_messages(updates: DataFrame, topic: str = C.TOPIC_TRIP_UPDATES) -> DataFrame:
    return to_messages(updates, key="trip_id", topic=topic)


def weather_messages(observations: DataFrame, topic: str = C.TOPIC_WEATHER) -> DataFrame:
    return to_messages(observations, key="agency_id", topic=topic)


def alert_messages(alerts: DataFrame, topic: str = C.TOPIC_ALERTS) -> DataFrame:
    return to_messages(alerts, key="entity_id", topic=topic)


def publish(messages: DataFrame, *, servers: str, file_format: str = "kafka") -> None:
    """Write messages to their topics; the connector package has to be on the class path."""
    messages.write.format(file_format).options(
        **{"kafka.bootstrap.servers": servers, **PRODUCER_OPTIONS}
    ).save()


def to_folder(path: str, file_format: str = "json"):
    """A publishing function that writes each batch of messages to a folder of its own, replacing an earlier try."""
    def write(messages: DataFrame, batch_id: int) -> None:
        messages.write.mode("overwrite").format(file_format).save(f"{path.rstrip('/')}/batch={batch_id}")

    return write


def to_topics(servers: str):
    """A publishing function that sends each batch to its topics; consumers see a batch again if a try failed half-way."""
    def send(messages: DataFrame, batch_id: int) -> None:
        publish(messages, servers=servers)

    return send


def publish_stream(messages: DataFrame, *, servers: str, checkpoint: str, file_format: str = "kafka"):
    """A stream writer for messages; call ``start()`` on it."""
    return messages.writeStream.format(file_format).options(
        **{"kafka.bootstrap.servers": servers, **PRODUCER_OPTIONS}
    ).option("checkpointLocation", checkpoint)


def consumer_options(topics: list[str], *, servers: str, starting: str = "latest",
                     max_records: int | None = None, group: str = CONSUMER_GROUP) -> dict[str, str]:
    """Options of the connector; ``max_records`` bounds a micro-batch only where a caller asks for it."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
        "groupIdPrefix": group,
    }
    return options if max_records is None else options | {"maxOffsetsPerTrigger": str(max_records)}


def consume_topics(spark: SparkSession, topics: list[str], **options) -> DataFrame:
    """Stream of message envelopes from topics; progress lives in the query's checkpoint."""
    raw = spark.readStream.format("kafka").options(**consumer_options(topics, **options)).load()
    return envelope(raw)


def envelope(raw: DataFrame) -> DataFrame:
    """Connector rows (binary key and value, timestamp) as text envelopes with milliseconds."""
    return raw.select(
        "topic", "partition", "offset",
        F.unix_millis(F.col("timestamp")).alias("timestamp"),
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
    )


def parse_envelope(messages: DataFrame, schema: str) -> DataFrame:
    """Envelope columns next to the fields of the JSON value, all under ``record``."""
    return messages.withColumn("record", F.from_json("value", schema))

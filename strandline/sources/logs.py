"""Logs as directories of files, key/value records, and sinks with the guarantees the pipelines rely on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import state
from strandline.schemas import OPERATIONAL, topic_schema
from strandline.sources import avro


def read_topic(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """All records of a topic, with its declared schema."""
    return spark.read.schema(topic_schema(topic)).parquet(f"{root.rstrip('/')}/{topic}")


def stream_topic(spark: SparkSession, root: str, topic: str, files_per_trigger: int = 1000) -> DataFrame:
    """The records of a topic as a stream, from the earliest on."""
    return spark.readStream.schema(topic_schema(topic)).option("maxFilesPerTrigger", files_per_trigger).parquet(f"{root.rstrip('/')}/{topic}")


def read_feeds(spark: SparkSession, folder: str) -> DataFrame:
    """(value): one row per file that a poller dropped into the folder."""
    return spark.read.text(folder, wholetext=True)


def stream_feeds(spark: SparkSession, folder: str, files_per_trigger: int = 1) -> DataFrame:
    """The files dropped into the folder as a stream, each poll's file a batch of its own by default."""
    return spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(folder, wholetext=True)


#: options of a Kafka sink that writes each record once per batch and waits for all replicas
PRODUCER = {"kafka.enable.idempotence": "true", "kafka.acks": "all", "kafka.compression.type": "zstd", "kafka.linger.ms": "20"}


def kafka_topic(spark: SparkSession, servers: str, topic: str) -> DataFrame:
    """The records of a Kafka topic from the earliest offset, decoded by the topic's schema; needs the Kafka connector on the class
    path, and isn't tested for want of it (`avro.decoded` is)."""
    raw = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", "earliest").load()
    return avro.decoded(raw, topic_schema(topic))


def kafka_sink(rows: DataFrame, servers: str, topic: str, key: str, schema_id: int):
    """A stream writer of keyed Avro records with headers; needs the Kafka connector (`avro.encoded` is tested without)."""
    records = avro.encoded(rows, topic_schema(topic), key, schema_id)
    return records.writeStream.format("kafka").options(**PRODUCER, **{"kafka.bootstrap.servers": servers, "topic": topic, "includeHeaders": "true"})


def change_feed(messages: DataFrame, table: str) -> DataFrame:
    """Changes of an operational table from its change messages (value: JSON, seq): the key columns, deleted, after, ts_ms, seq. A
    feed starts with a snapshot, whose rows have op r; a message that can't be read fails the query."""
    image, key = OPERATIONAL[table]
    return state.unwrapped(messages, image, key)


def stream_changes(spark: SparkSession, root: str, table: str, files_per_trigger: int = 1000) -> DataFrame:
    """The change feed of a table as a stream over <root>/<table> (parquet of value, seq), from the snapshot on; the row's columns at
    the top, as state tables take them."""
    messages = spark.readStream.schema("value string, seq long").option("maxFilesPerTrigger", files_per_trigger).parquet(f"{root.rstrip('/')}/{table}")
    image, key = OPERATIONAL[table]
    return change_feed(messages, table).select(*key, *[f"after.{c}" for c in image.names if c not in key], "deleted", "seq")


def append_keyed(df: DataFrame, path: str, key: str, partition_by: str | None = None) -> None:
    """Append records to a log; a null key fails the write."""
    checked = df.withColumn(key, F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a record has no key ({key})")).cast(df.schema[key].dataType)).otherwise(F.col(key)))
    writer = checked.write.mode("append").option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def lakehouse(df: DataFrame, path: str, time: str = "event_time") -> None:
    """Append records in directories by UTC date of `time`, each task's rows of a date in one file."""
    df.withColumn("event_date", F.to_date(time)).write.mode("append").option("compression", "zstd").partitionBy("event_date").parquet(path)


def facility_records(records: DataFrame) -> DataFrame:
    """(facility_id, supplier_id, latitude, longitude, status, deleted) of key/value JSON records (key, value).

    The id comes from the key, else from the value; records without one are skipped; a null value deletes. A coordinate that is
    missing or no number is 0.0.
    """
    field = lambda name: F.get_json_object("value", f"$.{name}")
    there = F.col("value").isNotNull()
    number = lambda name: F.when(there, F.coalesce(field(name).try_cast("double"), F.lit(0.0)))
    rows = records.withColumn("facility_id", F.coalesce(F.get_json_object("key", "$.facility_id"), field("facility_id")))
    return rows.where("facility_id is not null").select("facility_id", field("supplier_id").alias("supplier_id"), number("latitude").alias("latitude"), number("longitude").alias("longitude"), field("status").alias("status"), (~there).alias("deleted"))

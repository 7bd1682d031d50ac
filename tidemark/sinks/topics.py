"""Rows to topics.

Bounded DataFrames are written at once.  Streams are started and returned as
running queries; each needs its own checkpoint folder, by default one named
after the topic under the session's shared folder.  Batches are written to a
place of their own, so a batch that is run again after a failure replaces what
it wrote before (folders) or is delivered again (Kafka, at least once).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructType

from tidemark.functions.records import decode, encode, good
from tidemark.operators.firsts import first_rows
from tidemark.sinks import loads
from tidemark.sinks.loads import FolderStore
from tidemark.streaming.runner import start_batches
from tidemark.topics import Topic

#: Lines of one file of a topic that is a folder.
FILE_LINES = 1_000_000
KEYED = StructType().add("key", StringType()).add("value", StringType())


def put_batch(rows: DataFrame, topic: Topic, batch: int = 0, load: str | None = None) -> None:
    """Write one bounded batch of a load; in a folder, one that is complete is never written twice.

    Streams that follow the folder know its files by name, so they see a batch
    that is run again once.  Without a load the batch stands for itself.
    """
    if topic.on_kafka:
        options = {"kafka.bootstrap.servers": topic.servers, "topic": topic.name, **topic.options}
        rows.write.format("kafka").options(**options).save()
        return
    place = f"{topic.path}/{loads.LOAD}={loads.checked(load) if load else loads.fresh_load()}/{loads.BATCH}={batch}"
    if load is None or not loads.is_complete(rows.sparkSession, place):
        # a compressed file is read by one task, so none becomes large
        options = {"compression": "gzip", "maxRecordsPerFile": FILE_LINES}
        rows.select("value").write.mode("overwrite").options(**options).text(place)


def write_topic(rows: DataFrame, topic: Topic, checkpoint: str | None = None, **trigger) -> StreamingQuery | None:
    """Write the ``value`` column (and ``key``, on Kafka)."""
    if not rows.isStreaming:
        return put_batch(rows, topic)

    def put(batch: DataFrame, number: int) -> None:
        put_batch(batch, topic, number, loads.stream_load(batch))

    return start_batches(rows, put, topic.name, checkpoint, **trigger)


def write_json_topic(rows: DataFrame, topic: Topic, checkpoint: str | None = None, **trigger) -> StreamingQuery | None:
    """Write whole rows as JSON, NULL fields included."""
    return write_topic(rows.select(encode("*").alias("value")), topic, checkpoint, **trigger)


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    return first_rows(rows, keys, [F.col(name).desc_nulls_last() for name in order])


def upsert_store(spark: SparkSession, topic: Topic) -> FolderStore:
    """The parts of an upsert topic that is a folder."""
    return FolderStore(spark, topic.path, KEYED)


def write_upsert_topic(
    rows: DataFrame,
    topic: Topic,
    keys: list[str],
    order: list[str],
    checkpoint: str | None = None,
    load: str | None = None,
    **trigger,
) -> StreamingQuery | None:
    """Write rows under their key; within a batch only the last row of a key is written.

    In folders each batch of each load has its own place (see ``loads``): a
    bounded write comes after all that is there, or, if its ``load`` has been
    written before, replaces that.
    """

    def put(batch: DataFrame, number: int, load: str | None) -> None:
        last = latest_per_key(batch, keys, order)
        keyed = last.select(encode(*keys).alias("key"), encode("*").alias("value"))
        if topic.on_kafka:
            put_batch(keyed, topic, number)
        else:
            loads.add(upsert_store(rows.sparkSession, topic), keyed, load, number)

    if not rows.isStreaming:
        return put(rows, 0, load)
    return start_batches(rows, lambda batch, number: put(batch, number, loads.stream_load(batch)), topic.name, checkpoint, **trigger)


def _newest(rows: DataFrame) -> DataFrame:
    return first_rows(rows, ["key"], [loads.at().desc()]).select("key", "value")


def read_upsert_topic(spark: SparkSession, topic: Topic, schema: StructType) -> DataFrame:
    """The current row of each key of an upsert topic."""
    if topic.on_kafka:
        options = {"kafka.bootstrap.servers": topic.servers, "subscribe": topic.name, "startingOffsets": "earliest"}
        raw = spark.read.format("kafka").options(**options, **topic.options).load()
        rows = raw.select(F.col("key").cast("string"), F.col("value").cast("string"), "offset")
        newest = first_rows(rows, ["key"], [F.col("offset").desc()])
    else:
        newest = _newest(upsert_store(spark, topic).read())
    return good(decode(newest.filter(F.col("value").isNotNull()), schema))


def compact_upsert_topic(spark: SparkSession, topic: Topic, scratch: str) -> None:
    """Fold an upsert topic that is a folder into one part with the current row of each key."""
    loads.fold(upsert_store(spark, topic), _newest, scratch)


def fan_out(rows: DataFrame, topics: dict[str, Topic], name: str, checkpoint: str | None = None, **trigger):
    """Write (tag, value) rows to the topic of their tag, reading the input once."""

    def put(batch: DataFrame, number: int = 0, load: str | None = None) -> None:
        held = batch.persist()
        try:
            for tag, topic in topics.items():
                put_batch(held.filter(F.col("tag") == tag).select("value"), topic, number, load)
        finally:
            held.unpersist()

    if not rows.isStreaming:
        return put(rows)
    return start_batches(rows, lambda batch, number: put(batch, number, loads.stream_load(batch)), name, checkpoint, **trigger)


def tagged_lines(tag: str, value: Column | str) -> list[Column]:
    """Columns that make plain lines part of a fan-out."""
    return [F.lit(tag).alias("tag"), (F.col(value) if isinstance(value, str) else value).alias("value")]

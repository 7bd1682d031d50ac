"""Topics as DataFrames, always from the earliest record.

Every reader adds ``seq``, which orders records of the same time: the offset on
Kafka, a hash of the text in files, so that a rerun orders them alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructType

from tidemark import schemas as s
from tidemark.functions import times
from tidemark.functions.records import decode, good
from tidemark.topics import Topic

#: What a line of a topic is to its readers.
TEXT = StructType().add("value", StringType())

FILE_OPTIONS = {"maxFilesPerTrigger", "maxBytesPerTrigger", "latestFirst", "maxFileAge", "recursiveFileLookup"}


def read_topic(spark: SparkSession, topic: Topic, streaming: bool = False) -> DataFrame:
    """(value, seq): the text of each record; records without text go."""
    reader = spark.readStream if streaming else spark.read
    if topic.on_kafka:
        raw = (
            reader.format("kafka")
            .option("kafka.bootstrap.servers", topic.servers)
            .option("subscribe", topic.name)
            .option("startingOffsets", "earliest")
            .options(**topic.options)
            .load()
        )
        rows = raw.select(F.col("value").cast("string").alias("value"), F.col("offset").alias("seq"))
    else:
        options = {key: value for key, value in topic.options.items() if key in FILE_OPTIONS}
        text = reader.format("text").schema("value STRING").options(**options).load(topic.path)
        rows = text.select("value", F.xxhash64("value").alias("seq"))
    return rows.filter(F.col("value").isNotNull())


def read_json_topic(
    spark: SparkSession, topic: Topic, schema: StructType, streaming: bool = False, with_pt: bool = True
) -> DataFrame:
    """Records of a declared schema, ``seq`` and, as ``pt``, the time they were read at; unreadable ones go."""
    rows = good(decode(read_topic(spark, topic, streaming), schema, keep=["seq"]))
    return rows.withColumn("pt", F.current_timestamp()) if with_pt else rows


def read_changelog(spark: SparkSession, topic: Topic, streaming: bool = False) -> DataFrame:
    """Database change records with their payload maps and processing time ``pt``."""
    return read_json_topic(spark, topic, s.CHANGE, streaming)


def read_page_log(spark: SparkSession, topic: Topic, streaming: bool = False, delay: str | None = None) -> DataFrame:
    """Page-log records; with ``delay`` also ``rt``, their event time in whole seconds, under a watermark."""
    rows = read_json_topic(spark, topic, s.PAGE_LOG, streaming, with_pt=False)
    if delay is None:
        return rows
    timed = rows.withColumn("rt", times.from_millis_in_seconds("ts"))
    return timed.withWatermark("rt", delay) if streaming else timed


def read_order_pre(spark: SparkSession, topic: Topic, streaming: bool = False) -> DataFrame:
    """The 44-column pre-processed order lines."""
    return read_json_topic(spark, topic, s.ORDER_PRE_SCHEMA, streaming)


def read_order_detail(spark: SparkSession, topic: Topic, streaming: bool = False) -> DataFrame:
    """The 19-column placed order lines."""
    return read_json_topic(spark, topic, s.ORDER_DETAIL_SCHEMA, streaming)


def read_pay_order_detail(spark: SparkSession, topic: Topic, streaming: bool = False) -> DataFrame:
    """The 21-column paid order lines."""
    return read_json_topic(spark, topic, s.PAY_ORDER_DETAIL_SCHEMA, streaming)

"""Split stores: a topic is read and parsed once, and jobs read only their part of it.

Rows are written in one pass, divided by a column (the table of a change, the
tag of a log record).  Its values are folders, so a reader that asks for some of
them opens no other files: any filter on the column does that.  Each batch of
each load has its own place (see ``loads``); one that is complete is never
written again, so a stream that follows the store sees every row once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark import schemas as s
from tidemark.functions.records import BAD, decode
from tidemark.operators import firsts, logsplit
from tidemark.sinks import loads
from tidemark.streaming.runner import start_batches

KIND, TABLE, TAG = "kind", "table", "tag"
RECORD, DIRTY = "record", "dirty"

#: Parsed log lines: records with what the repair needs, and the text of dirty lines.
LOG_PARTS = "mid STRING, is_new STRING, ts BIGINT, seq BIGINT, record MAP<STRING, VARIANT>, value STRING, kind STRING"
TAGGED = "value STRING, tag STRING"


def _without_key(schema: StructType, by: str) -> StructType:
    # the dividing column is known from the folder and comes last
    return StructType([field for field in schema.fields if field.name != by] + [StructField(by, StringType())])


CHANGES = _without_key(StructType([*s.CHANGE.fields, StructField("seq", LongType())]), TABLE)


def split_store(spark: SparkSession, path: str, columns: StructType | str, by: str) -> loads.FolderStore:
    schema = StructType.fromDDL(columns) if isinstance(columns, str) else columns
    return loads.FolderStore(spark, path, _without_key(schema, by), (by,))


def write_split(
    rows: DataFrame, store: loads.FolderStore, name: str, load: str | None = None, checkpoint: str | None = None, **trigger
) -> StreamingQuery | None:
    """Write rows into their parts in one pass over them."""
    columns = [field.name for field in store.schema if field.name not in loads.PART_COLUMNS]

    def put(batch: DataFrame, number: int, load: str | None) -> None:
        loads.add(store, batch.select(*columns), load, number, keep=True)

    if not rows.isStreaming:
        return put(rows, 0, load)
    return start_batches(rows, lambda batch, number: put(batch, number, loads.stream_load(batch)), name, checkpoint, **trigger)


def read_split(store: loads.FolderStore, *parts: str, streaming: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Rows of some parts, or of all, without the store's own columns."""
    if streaming:
        rows = store.spark.readStream.schema(store.schema).options(**(options or {})).parquet(store.path)
    else:
        rows = store.read()
    rows = rows.drop(*loads.PART_COLUMNS)
    return rows.filter(F.col(store.by[0]).isin(list(parts))) if parts else rows


# --- change records ----------------------------------------------------------
def change_store(spark: SparkSession, path: str) -> loads.FolderStore:
    """Change records by table."""
    return split_store(spark, path, CHANGES, TABLE)


def split_changes(lines: DataFrame, store: loads.FolderStore, **options) -> StreamingQuery | None:
    """Change records (``value``, ``seq``), parsed once; text that is no record goes."""
    records = decode(lines, s.CHANGE, keep=["seq"]).filter(F.col(BAD).isNull() & F.col(TABLE).isNotNull())
    return write_split(records, store, "split_changes", **options)


def read_changes(store: loads.FolderStore, *tables: str, streaming: bool = False, options: dict[str, str] | None = None) -> DataFrame:
    """Change records of some tables, with the time they were read at."""
    return read_split(store, *tables, streaming=streaming, options=options).withColumn("pt", F.current_timestamp())


# --- the log -----------------------------------------------------------------
def log_store(spark: SparkSession, path: str) -> loads.FolderStore:
    """Parsed log lines: records and dirty lines."""
    return split_store(spark, path, LOG_PARTS, KIND)


def tag_store(spark: SparkSession, path: str) -> loads.FolderStore:
    """Log records by stream, dirty lines as the sixth one."""
    return split_store(spark, path, TAGGED, TAG)


def split_lines(lines: DataFrame, store: loads.FolderStore, **options) -> StreamingQuery | None:
    """Log lines (``value``, ``seq``), parsed once: records, and lines that are no JSON objects or have no time."""
    return write_split(parsed_lines(lines), store, "split_lines", **options)


def parsed_lines(lines: DataFrame) -> DataFrame:
    # a generator keeps the parse apart: it is used for five columns
    read = lines.select("seq", "value", F.explode(F.array(logsplit.known_fields("value"))).alias("record"))
    text = F.try_variant_get(F.col("record")["ts"], "$", "string")
    common = F.col("record")["common"]
    timed = read.withColumn("ts", text.try_cast("decimal(38, 6)").try_cast("bigint"))
    dirty = F.col("record").isNull() | F.col("ts").isNull()
    return timed.select(
        F.try_variant_get(common, "$.mid", "string").alias("mid"),
        F.try_variant_get(common, "$.is_new", "string").alias("is_new"),
        "ts",
        "seq",
        F.when(~dirty, F.col("record")).alias("record"),
        F.when(dirty, F.col("value")).alias("value"),
        F.when(dirty, DIRTY).otherwise(RECORD).alias(KIND),
    )


def tagged_log(store: loads.FolderStore, tie: list[str] = ["seq"], common_as_string: bool = False) -> DataFrame:  # noqa: B006
    """(tag, value) rows of all parsed lines: the five streams with repaired marks, and dirty lines."""
    records = read_split(store, RECORD).select(F.struct("is_new", "mid").alias("common"), "ts", *tie, "record")
    repaired = firsts.repair_is_new(records, tie)
    streams = logsplit.tagged_fields(repaired.select(F.col("common.is_new").alias("_mark"), F.col("record").alias("_given")), common_as_string)
    dirty = read_split(store, DIRTY).select(F.lit(DIRTY).alias(TAG), "value")
    return streams.unionByName(dirty)


def split_log(store: loads.FolderStore, tags: loads.FolderStore, load: str | None = None, **options) -> None:
    """Write the streams of all parsed lines to their parts; named, the load replaces what it wrote before."""
    loads.add(tags, tagged_log(store, **options).select("value", TAG), load)


def lines_of(tags: loads.FolderStore, tag: str) -> DataFrame:
    """JSON lines of one stream, as ``read_topic`` gives those of a topic."""
    return read_split(tags, tag).select("value", F.xxhash64("value").alias("seq"))

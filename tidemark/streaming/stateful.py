"""Stateful operators on streams, as DataFrame to DataFrame functions.

Rows travel through the Python workers as one JSON text each, next to the few
values the rules look at; their columns are taken apart and put together again
in the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from tidemark.functions import times
from tidemark.streaming import processors as p

EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}
# How long the daily marks are kept after they were set.
DAY = "1 day"
#: Groups of keys that share one state, which is read and written once a batch.
BUCKETS = 4096


def millis(interval: str) -> int:
    """``'5 seconds'`` to 5000."""
    number, unit = interval.split()
    sizes = {"second": 1_000, "minute": 60_000, "hour": 3_600_000, "day": 86_400_000}
    return int(float(number) * sizes[unit.rstrip("s")])


def _result(**more) -> StructType:
    return StructType([StructField("_row", StringType()), *[StructField(n, kind) for n, kind in more.items()]])


def _place(rows: DataFrame, order: list[str]) -> Column:
    """Order values as a JSON array; times as numbers."""
    parts = []
    for name in order:
        timed = rows.select(name).schema[0].dataType.typeName() == "timestamp"
        value = F.unix_micros(name).cast("string") if timed else _json_value(rows, name)
        parts.append(F.coalesce(value, F.lit("null")))
    return F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))


def _json_value(rows: DataFrame, name: str) -> Column:
    if rows.select(name).schema[0].dataType.typeName() in ("long", "integer", "short", "byte", "double", "float"):
        return F.col(name).cast("string")
    # an array of one is the only way to have a bare text encoded
    return F.regexp_replace(F.to_json(F.array(F.col(name).cast("string"))), r"^\[|\]$", "")


def _packed(rows: DataFrame, key: Column, order: list[str], columns: list[str] | None = None, **more: Column) -> DataFrame:
    fields = [value.alias(name) for name, value in more.items()]
    row = F.to_json(F.struct(*(columns or rows.columns)), EXACT)
    return rows.select(key.alias("_key"), _place(rows, order).alias("_place"), row.alias("_row"), *fields)


def _unpacked(found: DataFrame, rows: DataFrame) -> DataFrame:
    schema = StructType([StructField(field.name, field.dataType) for field in rows.schema])
    others = [name for name in found.columns if name != "_row"]
    return found.select(F.from_json("_row", schema, EXACT).alias("_row"), *others).select("_row.*", *others)


def _run(packed: DataFrame, processor, output: StructType, mode: str, event_time: str = "", frames: bool = False) -> DataFrame:
    grouped = packed.groupBy("_key")
    return (grouped.transformWithStateInPandas if frames else grouped.transformWithState)(
        statefulProcessor=processor,
        outputStructType=output,
        outputMode="Append",
        timeMode=mode,
        eventTimeColumnName=event_time,
    )


def _earliest(rows: DataFrame, key: Column, time: str, tie: list[str]) -> DataFrame:
    """Packed rows of which each task sends on only a key's earliest of a day.

    Rules that look at nothing but the first row of a day need no others, so a
    key with very many rows costs the shuffle and its processor one row (or
    those of one instant) for each day and Arrow batch.
    """
    packed = _packed(rows, key, [time, *tie], _day=_day(time), _time=F.unix_micros(time))
    return packed.mapInArrow(earliest_of_day, packed.schema).drop("_time")


def earliest_of_day(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose ``_time`` is the least of their ``_key`` and ``_day`` in the batch."""
    for batch in batches:
        if batch.num_rows:
            frame = batch.select(["_key", "_day", "_time"]).to_pandas()
            least = frame.groupby(["_key", "_day"], dropna=False, sort=False)["_time"].transform("min")
            yield batch.filter(pa.array(frame["_time"].eq(least)))


def _day(time: str) -> Column:
    return F.date_format(time, "yyyy-MM-dd")


def first_of_day(rows: DataFrame, key: Column, time: str, tie: list[str]) -> DataFrame:
    """The first row of each key and day; the memory of a key ends a day after its last pass."""
    packed = _earliest(rows, key, time, tie)
    return _unpacked(_run(packed, p.FirstOfDay(millis(DAY)), _result(), "ProcessingTime"), rows)


def returning_users(rows: DataFrame, user: str, time: str, gap_days: int) -> DataFrame:
    plain = rows.select(user, time)
    packed = _earliest(plain, F.col(user), time, [])
    output = _result(uu=IntegerType(), back=IntegerType())
    return _unpacked(_run(packed, p.ReturningUsers(gap_days), output, "None"), plain)


def mark_unique_users(rows: DataFrame, user: str, time: str, tie: list[str], only_unique: bool) -> DataFrame:
    """All rows, or only unique ones, with ``unique_user`` and ``new_user`` marks."""
    if only_unique:
        packed = _earliest(rows, F.col(user), time, tie)
    else:
        packed = _packed(rows, F.col(user), [time, *tie], _day=_day(time))
    output = _result(unique_user=IntegerType(), new_user=IntegerType())
    return _unpacked(_run(packed, p.MarkUnique(only_unique), output, "None"), rows)


def repair_is_new(records: DataFrame, tie: list[str]) -> DataFrame:
    """Records without a device or a time pass by; the state is kept per device."""
    device = F.col("common.mid")
    judgeable = device.isNotNull() & F.col("ts").isNotNull()
    claims = F.coalesce(F.col("common.is_new") == "1", F.lit(False))
    at = times.from_millis("ts")
    known = records.filter(judgeable)
    before = F.date_format(F.date_sub(F.to_date(at), 1), "yyyy-MM-dd")
    day = F.date_format(at, "yyyy-MM-dd")
    packed = _packed(known, device, ["ts", *tie], _day=day, _before=before, _claims=claims)
    judged = _unpacked(_run(packed, p.RepairIsNew(), _result(_keep=BooleanType()), "None"), known)
    flag = F.when(claims & ~F.col("_keep"), "0").otherwise(F.col("common.is_new"))
    repaired = judged.withColumn("common", F.col("common").withField("is_new", flag)).select(*records.columns)
    return repaired.unionByName(records.filter(~judgeable))


def _bucket(name: Column) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS)).cast("string")


def _bucketed(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Packed rows under the bucket of their key, with the key as ``_id``.

    A state of its own for each key costs several calls from the worker to its
    task; a bucket costs them once for all of its keys.  Rows are shuffled as
    they are and packed by their bucket's task: as text they are twice the size.
    """
    name = F.to_json(F.struct(*keys))
    columns = rows.columns
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lying = rows.withColumn("_bucket", _bucket(name)).repartition(tasks, "_bucket")
    return _packed(lying, F.col("_bucket"), order, columns, _id=name)


def first_wins(rows: DataFrame, keys: list[str], order: list[str], ttl: str) -> DataFrame:
    return _unpacked(_run(_bucketed(rows, keys, order), p.FirstWins(millis(ttl)), _result(), "ProcessingTime", frames=True), rows)


def latest_wins(rows: DataFrame, keys: list[str], by: str, tie: list[str], wait: str) -> DataFrame:
    return _unpacked(_run(_bucketed(rows, keys, [by, *tie]), p.LatestWins(millis(wait)), _result(), "ProcessingTime"), rows)


def followed_by_within(
    events: DataFrame, key: str, time: str, tie: list[str], start: str, following: str, within: str
) -> DataFrame:
    """``time`` must carry a watermark; a key's last start event comes out once it has timed out."""
    rows = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull())
    name = F.col(key).cast("string")
    packed = rows.select(
        time,
        _bucket(name).alias("_key"),
        name.alias("_id"),
        F.unix_millis(time).alias("_at"),
        _place(rows, tie).alias("_place"),
        F.coalesce(F.expr(following), F.lit(False)).alias("_follows"),
        F.when(F.coalesce(F.expr(start), F.lit(False)), F.to_json(F.struct(*rows.columns), EXACT)).alias("_row"),
    )
    return _unpacked(_run(packed, p.FollowedBy(millis(within)), _result(), "EventTime", ""), rows)

"""Daily-unique, returning and new users, and duplicate removal.

Bounded inputs never gather the rows of one key in one task.  What a job needs
from a key is its earliest time per day, which Spark aggregates before the
shuffle, or its first row, which ``row_number() = 1`` cuts down to one row per
key and map task before the shuffle.  A key with a third of all rows costs
therefore no more than any other.

Unbounded inputs go through the stateful forms in ``tidemark.streaming``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import times
from tidemark.operators.windows import SIZE
from tidemark.streaming import stateful


def first_rows(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    # row_number with "= 1" makes Spark keep one row per key in each map task
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") == 1).drop("_rank")


def _timed(rows: DataFrame, time: str) -> DataFrame:
    """Rows without a time belong to no day."""
    return rows.filter(F.col(time).isNotNull())


def first_of_day(rows: DataFrame, key: str, time: str, tie: list[str]) -> DataFrame:
    """The first row of each key and calendar day."""
    known = _timed(rows, time).filter(F.col(key).isNotNull())
    if rows.isStreaming:
        return stateful.first_of_day(known, F.col(key), time, tie)
    marked = known.withColumns({"_key": F.col(key), "_day": F.to_date(time)})
    return first_rows(marked, ["_key", "_day"], [time, *tie]).drop("_key", "_day")


def daily_starts(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    """One row per key and calendar day: the keys and the earliest ``time`` of that day."""
    rows = _timed(rows, time)
    if rows.isStreaming:
        return stateful.first_of_day(rows.select(*keys, time), F.to_json(F.struct(*keys)), time, [])
    return _days(rows, keys, time).drop("_day")


def _days(rows: DataFrame, keys: list[str], time: str) -> DataFrame:
    return rows.groupBy(*keys, F.to_date(time).alias("_day")).agg(F.min(time).alias(time))


def returning_users(rows: DataFrame, user: str, time: str, gap_days: int = 8) -> DataFrame:
    """One row per user and day: ``uu`` = 1 and ``back`` = 1 after ``gap_days`` or more without a login."""
    rows = _timed(rows, time)
    if rows.isStreaming:
        return stateful.returning_users(rows, user, time, gap_days)
    days = _days(rows, [user], time)
    before = F.lag("_day").over(Window.partitionBy(user).orderBy("_day"))
    back = times.day_gap("_day", before) >= gap_days
    return days.select(user, time, F.lit(1).alias("uu"), F.when(back, 1).otherwise(0).alias("back"))


def unique_users(rows: DataFrame, user: str, time: str, tie: list[str]) -> DataFrame:
    """One row per user and day with ``unique_user`` = 1, and ``new_user`` = 1 on the user's first day."""
    rows = _timed(rows, time)
    if rows.isStreaming:
        return stateful.mark_unique_users(rows, user, time, tie, only_unique=True)
    earliest = F.min(time).over(Window.partitionBy(user))
    return _days(rows, [user], time).select(
        user,
        time,
        F.lit(1).alias("unique_user"),
        F.when(F.col(time) == earliest, 1).otherwise(0).alias("new_user"),
    )


def mark_unique_users(
    rows: DataFrame, user: str, time: str, tie: list[str], amounts: list[str], size: str = SIZE
) -> DataFrame:
    """Rows to be summed by time window: ``time``, ``unique_user``, ``new_user`` and the amounts.

    ``unique_user`` falls on the first row of a user and day, ``new_user`` on
    the user's first row.  Bounded inputs are first summed per user and window:
    what a user then has is bounded by time, not by the number of rows, and the
    marks come from that without going back to the input.
    """
    rows = _timed(rows, time)
    if rows.isStreaming:
        kept = rows.select(*dict.fromkeys([user, time, *tie, *amounts]))
        marked = stateful.mark_unique_users(kept, user, time, tie, only_unique=False)
        return marked.select(time, "unique_user", "new_user", *amounts)
    sums = [F.sum(name).alias(name) for name in amounts]
    slots = rows.groupBy(user, F.window(time, size).alias("_slot")).agg(F.min(time).alias(time), *sums)
    days = slots.withColumn("_day", F.to_date(time))
    ever = F.min(time).over(Window.partitionBy(user))
    today = F.min(time).over(Window.partitionBy(user, "_day"))
    return days.select(
        time,
        F.when(F.col(time) == today, 1).otherwise(0).alias("unique_user"),
        F.when(F.col(time) == ever, 1).otherwise(0).alias("new_user"),
        *amounts,
    )


def repair_is_new(records: DataFrame, tie: list[str], flag: str = "common.is_new", device: str = "common.mid") -> DataFrame:
    """Take back the new-visitor mark from devices that were seen before.

    The first record of a device settles it: marked new, its day is the only
    day on which the mark may stay; not marked, the mark never holds.  Records
    without a device, a time or the mark pass as they are and settle nothing.
    """
    if records.isStreaming:
        return stateful.repair_is_new(records, tie)
    known = F.col(device).isNotNull() & F.col("ts").isNotNull()
    claims = F.coalesce(F.col(flag) == "1", F.lit(False)) & known
    first = F.min_by(F.struct(F.col(flag).alias("flag"), F.col("ts").alias("ts")), F.struct("ts", *tie))
    truly_new = (
        records.filter(known)
        .groupBy(F.col(device).alias("_mid"))
        .agg(first.alias("_first"))
        .filter(F.col("_first.flag") == "1")
        .select("_mid", F.to_date(times.from_millis("_first.ts")).alias("_day"))
    )
    # only marked records are shuffled to meet their device's first day
    marked = records.filter(claims)
    same = (F.col(device) == F.col("_mid")) & (F.to_date(times.from_millis("ts")) == F.col("_day"))
    judged = marked.join(truly_new, same, "left")
    parent, field = flag.rsplit(".", 1)
    kept = F.when(F.col("_mid").isNotNull(), F.col(flag)).otherwise("0")
    repaired = judged.withColumn(parent, F.col(parent).withField(field, kept)).drop("_mid", "_day")
    return records.filter(~claims).unionByName(repaired)


def first_wins(rows: DataFrame, keys: list[str], order: list[str], ttl: str = "5 seconds") -> DataFrame:
    """One row per key: the first in arrival ``order``; streams forget a key ``ttl`` after its last row."""
    if rows.isStreaming:
        return stateful.first_wins(rows, keys, order, ttl)
    return first_rows(rows, keys, order)


def latest_wins(rows: DataFrame, keys: list[str], by: str, tie: list[str], wait: str = "5 seconds") -> DataFrame:
    """One row per key: the one with the greatest ``by``, the later arrival among equals."""
    if rows.isStreaming:
        return stateful.latest_wins(rows, keys, by, tie, wait)
    return first_rows(rows, keys, [F.col(by).desc_nulls_last(), *[F.col(name).desc_nulls_last() for name in tie]])

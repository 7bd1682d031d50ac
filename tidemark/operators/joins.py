"""Dictionary look-ups and time-bounded joins of two streams."""

from __future__ import annotations

from functools import reduce
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.sources.lookup import KeyedLookup, Lookup


def lookup_join(
    facts: DataFrame,
    dictionary: DataFrame | Lookup | KeyedLookup,
    on: str,
    name: str,
    code: str = "dic_code",
    label: str = "dic_name",
) -> DataFrame:
    """Add ``name``, the label of the code in column ``on``; facts with an unknown code go.

    A ``Lookup`` has counted its rows and asks for a broadcast only while it is
    small.  A plain DataFrame carries no such promise and gets no hint: Spark
    broadcasts it when its own size estimate is under the threshold and
    shuffles otherwise.  A ``KeyedLookup`` reads the codes of these facts only;
    it needs a bounded batch (``runner.start_job``).
    """
    known = dictionary
    if isinstance(dictionary, KeyedLookup):
        if facts.isStreaming:
            raise ValueError("a keyed look-up is made batch by batch: run the job through start_job")
        known = dictionary.needed(facts, on)
    if isinstance(dictionary, Lookup):
        known = dictionary.live() if facts.isStreaming else dictionary.current()
    codes = known.select(F.col(code).alias("_code"), F.col(label).alias(name))
    return facts.join(codes, F.col(on) == F.col("_code"), "inner").drop("_code")


def ttl_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    how: str = "inner",
    ttl: str | None = None,
    time: str = "pt",
) -> DataFrame:
    """Equi join of two streams whose rows wait ``ttl`` for each other.

    ``on`` pairs left with right columns; the right key columns and the right
    time column are dropped, except in right and full joins, where the key
    columns take the value of whichever side has one.  Other right columns
    must not clash with left ones.

    Streams: both sides get a watermark of ``ttl`` on ``time`` and rows match
    when their times are at most ``ttl`` apart; this is what lets Spark forget
    old rows.  Bounded inputs without ``ttl`` join without time limit.  Bounded
    inputs with ``ttl`` match under the same range, through time slots, so that
    a key with very many rows is spread over its slots and rows far apart in
    time are never paired.
    """
    if left.isStreaming or right.isStreaming:
        if ttl is None:
            raise ValueError("joining streams needs a ttl")
        return _stream_join(left, right, on, how, ttl, time)
    if ttl is None:
        plain = right.drop(time) if time in left.columns and time in right.columns else right
        return _tidy(_equi(left, _prefixed(plain, on), on, how), on, how)
    return _slot_join(left, right, on, how, ttl, time)


def _prefixed(right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    for _, key in on:
        right = right.withColumnRenamed(key, f"_r_{key}")
    return right


def _equi(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str, *more: Column) -> DataFrame:
    return left.join(right, _conditions(on, *more), how)


def _conditions(on: list[tuple[str, str]], *more: Column) -> Column:
    same = [F.col(mine) == F.col(f"_r_{theirs}") for mine, theirs in on]
    return reduce(lambda a, b: a & b, [*same, *more])


def _tidy(joined: DataFrame, on: list[tuple[str, str]], how: str) -> DataFrame:
    if how in ("right", "full"):
        filled = {mine: F.coalesce(F.col(mine), F.col(f"_r_{theirs}")) for mine, theirs in on}
        joined = joined.withColumns(filled)
    return joined.drop(*[f"_r_{theirs}" for _, theirs in on])


def _stream_join(left, right, on, how, ttl, time):
    left = _watermarked(left, time, ttl)
    right = _watermarked(_prefixed(right, on).withColumnRenamed(time, "_r_time"), "_r_time", ttl)
    span = F.expr(f"INTERVAL {ttl}")
    near = (F.col(time) >= F.col("_r_time") - span) & (F.col(time) <= F.col("_r_time") + span)
    joined = _equi(left, right, on, how, near)
    # one event-time column may leave the join, or the next join rejects the plan
    if how in ("right", "full"):
        joined = joined.withColumn(time, F.coalesce(F.col(time), F.col("_r_time")))
    return _tidy(joined, on, how).drop("_r_time")


def _watermarked(rows: DataFrame, time: str, ttl: str) -> DataFrame:
    # the result of a join before keeps that join's watermark; a second one is not allowed
    return rows if "spark.watermarkDelayMs" in rows.schema[time].metadata else rows.withWatermark(time, ttl)


def _slot_join(left, right, on, how, ttl, time):
    span = F.expr(f"INTERVAL {ttl}")
    width = F.unix_micros(F.timestamp_seconds(F.lit(0)) + span)

    def own(rows: DataFrame, at: str, name: str) -> DataFrame:
        return rows.withColumn(name, F.floor(F.unix_micros(at) / width))

    def around(rows: DataFrame, at: str, name: str) -> DataFrame:
        # all partners of a row lie in its own slot or in a neighbouring one
        slot = F.floor(F.unix_micros(at) / width)
        return rows.withColumn(name, F.explode(F.sequence(slot - 1, slot + 1)))

    other = _prefixed(right, on).withColumnRenamed(time, "_r_time")
    near = (F.col(time) >= F.col("_r_time") - span) & (F.col(time) <= F.col("_r_time") + span)
    pairs = [*on, ("_slot", "slot")]
    if how == "right":
        joined = _equi(around(left, time, "_slot"), own(other, "_r_time", "_r_slot"), pairs, "right", near)
        joined = joined.withColumn(time, F.coalesce(time, "_r_time"))
        return _tidy(joined, pairs, how).drop("_slot", "_r_time")
    if how not in ("inner", "left", "full"):
        raise ValueError(f"unknown join kind {how!r}")
    kind = "inner" if how == "inner" else "left"
    joined = _equi(own(left, time, "_slot"), around(other, "_r_time", "_r_slot"), pairs, kind, near)
    joined = _tidy(joined, pairs, kind).drop("_slot", "_r_time")
    if how != "full":
        return joined
    # right rows without a partner, found by the same match as an anti join
    keys_only = left.select(time, *[mine for mine, _ in on])
    match = _conditions(pairs, near)
    alone = own(other, "_r_time", "_r_slot").join(around(keys_only, time, "_slot"), match, "left_anti")
    names = {f"_r_{theirs}": mine for mine, theirs in on} | {"_r_time": time}
    return joined.unionByName(alone.drop("_r_slot").withColumnsRenamed(names), allowMissingColumns=True)

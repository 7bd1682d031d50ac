"""Event patterns: a start event judged by the event that directly follows it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.streaming import stateful

# Time slots are this many times the pattern's limit: one row in eight is read twice.
SLOT_FACTOR = 8


def followed_by_within(
    events: DataFrame, key: str, time: str, tie: list[str], start: str, following: str, within: str
) -> DataFrame:
    """Start events whose next event matches in time, or that time out.

    ``start`` and ``following`` are SQL conditions.  A start event is returned
    when the next event of its key matches ``following`` less than ``within``
    later, and also when nothing follows in that time.  It is not returned when
    a non-matching event comes first.  Every start event is judged on its own.

    Bounded inputs are cut into time slots per key, so that no task holds all
    events of a key.  The rows at the beginning of a slot are read by the slot
    before as well, which shows each row its next event whenever that event is
    near enough to matter.
    """
    if events.isStreaming:
        return stateful.followed_by_within(events, key, time, tie, start, following, within)
    limit = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {within}"))
    width = limit * SLOT_FACTOR
    at = F.unix_micros(time)
    slot = F.floor(at / width)
    starts = F.coalesce(F.expr(start), F.lit(False))
    follows = F.coalesce(F.expr(following), F.lit(False))
    peeked = F.when(at - slot * width < limit, F.array(slot, slot - 1)).otherwise(F.array(slot))
    order = [name for name in tie if name != time]
    # as in the stream, events without a key or a time belong to nobody
    rows = events.filter(F.col(key).isNotNull() & F.col(time).isNotNull()).select(
        F.col(key).alias("_key"),
        at.alias("_at"),
        *[F.col(name).alias(f"_tie{n}") for n, name in enumerate(order)],
        follows.alias("_follows"),
        # only start events can be returned, so only they carry their columns
        F.when(starts, F.struct(*events.columns)).alias("_event"),
        slot.alias("_own"),
        F.explode(peeked).alias("_slot"),
    )
    # a copy that only serves as the next event does not need its columns either
    rows = rows.withColumn("_event", F.when(F.col("_own") == F.col("_slot"), F.col("_event")))
    line = Window.partitionBy("_key", "_slot").orderBy("_at", *[f"_tie{n}" for n in range(len(order))])
    rows = rows.withColumn("_next_at", F.lead("_at").over(line)).withColumn("_next_follows", F.lead("_follows").over(line))
    broken = F.col("_next_at").isNotNull() & (F.col("_next_at") - F.col("_at") < limit) & ~F.col("_next_follows")
    return rows.filter(F.col("_event").isNotNull() & ~broken).select("_event.*")

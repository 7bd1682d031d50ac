"""Dates, epochs and event time."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tidemark.schemas import DAY_FORMAT, TIME_FORMAT


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def from_millis(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp."""
    return F.timestamp_millis(_col(ms))


def from_millis_in_seconds(ms: Column | str) -> Column:
    """Epoch milliseconds to a timestamp cut to whole seconds."""
    return F.timestamp_seconds(F.floor(_col(ms) / 1000))


def from_text(text: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in the session zone to a timestamp, NULL if malformed."""
    return F.try_to_timestamp(_col(text), F.lit(TIME_FORMAT))


def day_text(value: Column | str) -> Column:
    """Timestamp or timestamp text to ``yyyy-MM-dd``, NULL if malformed."""
    return F.date_format(F.try_to_timestamp(_col(value).cast("string")), DAY_FORMAT)


def first_token(text: Column | str) -> Column:
    """The part of a date-time text before the first blank."""
    return F.substring_index(_col(text), " ", 1)


def time_text(value: Column | str) -> Column:
    """Timestamp to ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(_col(value), TIME_FORMAT)


def to_millis(text: Column | str) -> Column:
    """Date or date-time text to epoch milliseconds."""
    return F.unix_millis(F.try_to_timestamp(_col(text)))


def now_millis() -> Column:
    """Wall clock of the running batch in milliseconds."""
    return F.unix_millis(F.current_timestamp())


def now_seconds_in_millis() -> Column:
    """Wall clock of the running batch, whole seconds expressed in milliseconds."""
    return F.unix_timestamp() * 1000


def op_time(text: Column | str) -> Column:
    """``2022-04-01 10:20:47.41Z`` to a timestamp with millisecond precision."""
    return F.date_trunc("MILLISECOND", F.try_to_timestamp(_col(text)))


def compare_op_times(left: Column | str, right: Column | str) -> Column:
    """-1, 0 or 1 as the left operation time is before, at or after the right one."""
    gap = F.unix_millis(op_time(left)) - F.unix_millis(op_time(right))
    return F.signum(gap).cast("int")


def day_gap(later: Column | str, earlier: Column | str) -> Column:
    """Whole days between two dates."""
    return F.datediff(_col(later), _col(earlier))

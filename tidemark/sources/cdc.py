"""Change-data-capture envelopes of the routing configuration."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import schemas as s
from tidemark.functions.records import decode, good

SNAPSHOT, CREATED, UPDATED, DELETED = "r", "c", "u", "d"


def read_debezium(lines: DataFrame) -> DataFrame:
    """Envelope lines (``value``) to ``before``, ``after``, ``op`` and ``ts_ms``; other operations go."""
    records = good(decode(lines, s.ENVELOPE))
    return records.filter(F.col("op").isin(SNAPSHOT, CREATED, UPDATED, DELETED))

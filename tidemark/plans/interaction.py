"""Favourites and comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark import schemas as s
from tidemark.functions import times
from tidemark.operators import changes as c
from tidemark.operators.joins import lookup_join
from tidemark.sources.lookup import Lookup


def favor_add(changes: DataFrame) -> DataFrame:
    return c.favours_added(changes)


def comment(changes: DataFrame, dictionary: DataFrame | Lookup) -> DataFrame:
    """Comments with the name of their rating."""
    named = lookup_join(c.comments(changes), dictionary, "appraise", "appraise_name")
    dated = named.withColumn("date_id", times.day_text(F.col("create_time")))
    return dated.withColumnRenamed("appraise", "appraise_code").select(*s.COMMENT)

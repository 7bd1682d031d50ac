"""Decoding JSON text and encoding rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

BAD = "_corrupt_record"


def decode(lines: DataFrame, schema: StructType, value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Parse JSON lines; those that are no JSON objects keep their text in ``_corrupt_record``.

    A value of another type than its field's is NULL; the rest of the record stays.
    """
    wide = StructType([*schema.fields, StructField(BAD, StringType())])
    record = F.from_json(F.col(value), wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD})
    kept = [F.col(name) for name in (keep or []) if name in lines.columns]
    # a generator keeps the parse apart: filters on its fields do not pull a second parse below it
    parsed = lines.select(*kept, F.col(value).alias("_text"), F.explode(F.array(record)).alias("_record"))
    # the parse also complains of single values, so what it complains of is looked at again
    suspect = F.col("_record").isNull() | F.col(f"_record.{BAD}").isNotNull()
    unread = suspect & fields_of(F.col("_text")).isNull()
    fields = [F.col(f"_record.`{field.name}`").alias(field.name) for field in schema.fields]
    return parsed.select(*kept, *fields, F.when(unread, F.coalesce("_text", F.lit(""))).alias(BAD))


def fields_of(text: Column) -> Column:
    """The fields of a JSON object as they are, by name; NULL for all other text."""
    return F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")


def good(records: DataFrame) -> DataFrame:
    """Records that could be parsed."""
    return records.filter(F.col(BAD).isNull()).drop(BAD)


def bad(records: DataFrame) -> DataFrame:
    """The text of records that could not be parsed."""
    return records.filter(F.col(BAD).isNotNull()).select(F.col(BAD).alias("value"))


def encode(*columns: Column | str) -> Column:
    """Row to JSON text, keeping NULL fields."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})

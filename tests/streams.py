"""Helpers that play bounded rows as a stream of files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.streaming.runner import run_available


def write_parts(rows: DataFrame, order: str, parts: int, folder: str) -> str:
    """One file per part, in the order of ``order``."""
    edges = rows.approxQuantile(order, [n / parts for n in range(1, parts)], 0.0) if parts > 1 else []
    bounds = [None, *edges, None]
    for number, (low, high) in enumerate(zip(bounds, bounds[1:])):
        part = rows
        if low is not None:
            part = part.filter(part[order] > low)
        if high is not None:
            part = part.filter(part[order] <= high)
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    return f"{folder}/in"


def as_stream(spark, path: str, schema, one_by_one: bool = True) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if one_by_one:
        reader = reader.option("maxFilesPerTrigger", 1)
    return reader.parquet(path)


def play(stream: DataFrame, folder: str, name: str = "out", idle_batches: bool = True) -> DataFrame:
    """Run the stream over all files that are there and read back what it wrote."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/{name}/part={number}")

    run_available(stream, put, name, f"{folder}/checkpoint-{name}", idle_batches)
    written = stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/{name}")
    return written.select(*stream.columns)

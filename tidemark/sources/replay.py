"""Bounded rows played as a stream: splits written in a given order and read one after another."""

from __future__ import annotations

import time
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructType

from tidemark.sinks.loads import file_sizes, remove_folder
from tidemark.streaming.runner import run_available

#: A stream reads files in the order of their times, which are kept in milliseconds.
APART = 0.01
#: Bytes of a split that one file holds, and so one task writes and one reads.
FILE_BYTES = 4 << 20
READ_BYTES = "spark.sql.files.maxPartitionBytes"


def time_bounds(rows: DataFrame, at: str, splits: int) -> list[float]:
    """Values of a number column that cut the rows into about equal splits."""
    return rows.approxQuantile(at, [n / splits for n in range(1, splits)], 0.001)


def split_of(at: Column | str, bounds: list[float]) -> Column:
    """The split a value falls into, from 0."""
    value = F.col(at) if isinstance(at, str) else at
    passed = F.lit(0)
    for bound in bounds:
        passed = passed + F.when(value > bound, 1).otherwise(0)
    return passed


def write_splits(rows: DataFrame, split: Column, splits: int, folder: str, files: int | None = None) -> int:
    """Write splits in order, rows without a split go; gives the files of each split, for ``read_splits``.

    The rows are computed once, and written aside first.  Every split has the
    same number of files, by the size of the largest one if ``files`` is not
    given, so that this many files make up one split.  Files written aside are
    put together as they are read, never shuffled.
    """
    spark = rows.sparkSession
    aside = f"{folder.rstrip('/')}-{uuid4().hex}"
    numbered = rows.withColumn("_split", split.cast("int")).filter(F.col("_split").between(0, splits - 1))
    numbered.write.partitionBy("_split").parquet(aside)
    schema = StructType([*rows.schema.fields]).add("_split", IntegerType())
    staged = spark.read.schema(schema).parquet(aside)
    if files is None:
        sizes = [file_sizes(spark, f"{aside}/_split={number}") for number in range(splits)]
        files = max(1, *[min(len(some), -(-sum(some) // FILE_BYTES)) for some in sizes])
    before = spark.conf.get(READ_BYTES)
    spark.conf.set(READ_BYTES, str(FILE_BYTES))
    try:
        for number in range(splits):
            part = staged.filter(F.col("_split") == number).drop("_split")
            there = len(file_sizes(spark, folder))
            part.coalesce(files).write.mode("append").parquet(folder)
            # a task without rows writes no file
            for _ in range(files - (len(file_sizes(spark, folder)) - there)):
                part.limit(0).coalesce(1).write.mode("append").parquet(folder)
            time.sleep(APART)
    finally:
        spark.conf.set(READ_BYTES, before)
    remove_folder(spark, aside)
    return files


def read_splits(spark: SparkSession, folder: str, schema: StructType, files: int = 1) -> DataFrame:
    """A stream that takes one split of so many files a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)


def played(stream: DataFrame, folder: str, idle_batches: bool = True, run=run_available, **options) -> DataFrame:
    """Run a stream over all that is there and read back what it gave, batch by batch."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/_batch={number}")

    if run is run_available:
        options["idle_batches"] = idle_batches
    run(stream, put, "played", f"{folder}/checkpoint", **options)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out").select(*stream.columns)

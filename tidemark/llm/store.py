"""Written stages: tables in the folder that all executors share, which cut lineage and survive a lost executor."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.session import shared_dir


#: Lets Spark delete a stage's shuffle files as soon as its table is written.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into a new folder of the shared place and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)

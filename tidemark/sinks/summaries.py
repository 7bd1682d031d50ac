"""Summary rows to an analytical store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.windows import stamped
from tidemark.sinks.loads import BATCH, LOAD, stream_load
from tidemark.streaming.runner import start_batches

BATCH_ROWS = "10000"


def write_summary(
    summary: DataFrame,
    columns: list[str],
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    exclude: list[str] | None = None,
    name: str | None = None,
    checkpoint: str | None = None,
    clock: Column | None = None,
    **trigger,
) -> StreamingQuery | None:
    """Stamp rows with the wall clock and append them in the store's column order.

    JDBC inserts go in batches (``batchsize`` option) and are repeated when a
    batch is run again; parquet folders are replaced batch by batch.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either a path or jdbc options")
    left_out = set(exclude or [])

    def put(batch: DataFrame, number: int | None, load: str | None = None) -> None:
        rows = stamped(batch, columns, clock).drop(*left_out)
        if jdbc is not None:
            options = {"batchsize": BATCH_ROWS, **jdbc}
            rows.write.format("jdbc").options(**options).mode("append").save()
        elif number is None:
            rows.write.mode("append").parquet(path)
        else:
            rows.write.mode("overwrite").parquet(f"{path}/{LOAD}={load}/{BATCH}={number}")

    if not summary.isStreaming:
        return put(summary, None)
    label = name or (path or jdbc["dbtable"]).rstrip("/").rsplit("/", 1)[-1]
    return start_batches(summary, lambda batch, number: put(batch, number, stream_load(batch)), label, checkpoint, **trigger)

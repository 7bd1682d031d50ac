"""Starting streaming queries with their own checkpoint folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tidemark.session import shared_dir

IDLE = "spark.sql.streaming.noDataMicroBatches.enabled"


def checkpoint_of(rows: DataFrame, name: str, given: str | None = None) -> str:
    return given or f"{shared_dir(rows.sparkSession)}/checkpoints/{name}"


def _trigger(rows, trigger: dict) -> dict:
    return trigger or {"processingTime": "1 second"}


def start_batches(
    rows: DataFrame,
    put: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Run ``put(batch, number)`` on every micro-batch; one checkpoint per query, never shared."""
    return (
        rows.writeStream.foreachBatch(put)
        .option("checkpointLocation", checkpoint_of(rows, name, checkpoint))
        .trigger(**_trigger(rows, trigger))
        .start()
    )


def start_job(
    rows: DataFrame,
    job: Callable[[DataFrame], DataFrame],
    put: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Run a job without state on every micro-batch, planned anew each time, so that look-ups stay fresh."""
    return start_batches(rows, lambda batch, number: put(job(batch), number), name, checkpoint, **trigger)


def run_available(
    rows: DataFrame,
    put: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str | None = None,
    idle_batches: bool = True,
) -> StreamingQuery:
    """Process everything that is there and stop.

    ``idle_batches`` allows batches without input, which emit what the last
    watermark has closed.  Operators with processing-time state ask for such
    batches without end, so queries with them must turn this off.
    """
    conf = rows.sparkSession.conf
    before = conf.get(IDLE)
    conf.set(IDLE, str(idle_batches).lower())
    try:
        query = start_batches(rows, put, name, checkpoint, availableNow=True)
    finally:
        conf.set(IDLE, before)
    query.awaitTermination()
    return query


def late_rows(query: StreamingQuery) -> int:
    """Rows dropped because the watermark had passed them, as far back as progress is kept; ``LateRows`` counts all."""
    return sum(int(state.numRowsDroppedByWatermark) for p in query.recentProgress for state in p.stateOperators)


def run_clocked(
    rows: DataFrame,
    put: Callable[[DataFrame, int], None],
    name: str,
    checkpoint: str | None = None,
    clock: str = "1 second",
    drain: bool = True,
) -> StreamingQuery:
    """Run on a clock until the input is used up and, with ``drain``, no state is left that a timer would clear.

    For operators with processing-time state, whose timers fire only while batches run.
    """
    query = start_batches(rows, put, name, checkpoint, processingTime=clock)
    try:
        while not query.awaitTermination(0.25):
            if _is_quiet(query, drain):
                break
    finally:
        query.stop()
    return query


def _is_quiet(query: StreamingQuery, drain: bool) -> bool:
    last = query.lastProgress
    if last is None or last.numInputRows or query.status["isDataAvailable"]:
        return False
    return not drain or all(state.numRowsTotal == 0 for state in last.stateOperators)


class LateRows(StreamingQueryListener):
    """Counts the rows that watermarks drop, for as long as the store is kept.

    Register with ``spark.streams.addListener``.  Each batch that dropped rows
    has a small file of its own under ``path``, named by query and batch, so a
    batch reported twice counts once and a restart goes on counting.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        dropped = sum(int(state.numRowsDroppedByWatermark) for state in progress.stateOperators)
        if dropped:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{progress.id}/{progress.batchId}")
            out = place.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(place, True)
            try:
                out.write(f"{dropped}\n".encode())
            finally:
                out.close()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def total(self, query: StreamingQuery | None = None) -> int:
        """Rows dropped so far, of one query or of all."""
        # progress is reported a little after the batch
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        folder = f"{self.path}/{query.id if query else '*'}"
        try:
            counts = self.spark.read.schema("dropped BIGINT").csv(f"{folder}/*")
            return counts.agg(F.sum("dropped")).first()[0] or 0
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

"""Session defaults and the shared working folder."""

from __future__ import annotations

import tempfile
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings that may change while a session runs.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # sides that prove small enough in every partition are hashed, so that nothing is sorted for their join
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # split a hot key even where two joins in a row share one shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows written by table or tag go to one open file of each, without a sort of all rows before
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    "spark.sql.parquet.compression.codec": "zstd",
    # of a JSON name that is given twice the last value counts
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session; ``conf`` keys use ``__`` for dots or are given as a dict."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME_DEFAULTS, "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    settings.update({key.replace("__", "."): value for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def shuffle_partitions(input_bytes: int, per_task: int = 192 << 20, at_least: int = 8) -> str:
    """Value for ``spark.sql.shuffle.partitions`` that lets a shuffle of the whole input fit in memory per task.

    Adaptive execution joins partitions that turn out small, so the number may
    be generous; a stream keeps the number it was first started with.
    """
    return str(max(at_least, -(-input_bytes // per_task)))


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the defaults the operators rely on to a session made elsewhere."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package's source to the executors, once per application.

    Processors and Arrow functions name their module; workers can import it
    from any working folder only if the source has been sent.
    """
    _ship(spark.sparkContext.applicationId)


@lru_cache
def _ship(application: str) -> None:
    from pyspark import SparkContext

    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="run-")) / f"{package.name}-{application}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    SparkContext._active_spark_context.addPyFile(str(archive))


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and written stages.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session,
    where driver and executors share one machine, may fall back to a fresh
    temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_folder(context.applicationId)


@lru_cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")

"""Stores that are filled by many loads: which rows came from whom, and after which.

Every write belongs to a load (a streaming query, or one bounded run) and has a
batch number within it.  The store keeps what a batch wrote in a partition of
its own and gives it a place: one after all places that are there.  A batch
that is written again finds its own partition and replaces that, at its old
place, and nothing else, whatever other loads wrote before, between or after.
Readers order rows by ``AT``; the last place wins.

``fold`` joins the partitions into one at the last of their places.  The last
batch of each stream or named load, the only one that may still be repeated,
stays behind as an empty partition, so that a repetition finds its old place.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple, Protocol
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructType

PLACE, LOAD, BATCH = "_place", "_load", "_batch"
PART_COLUMNS = [PLACE, LOAD, BATCH]
PART_DDL = f"{PLACE} BIGINT, {LOAD} STRING, {BATCH} BIGINT"
FOLDED = "folded"
ONCE = "once-"

_NAME = re.compile(r"[A-Za-z0-9_.-]+")
_PART = re.compile(rf"{PLACE}=(-?\d+)/{LOAD}=([A-Za-z0-9_.-]+)/{BATCH}=(-?\d+)")


class Part(NamedTuple):
    """One batch of one load and its place in the store."""

    place: int
    load: str
    batch: int

    @property
    def folder(self) -> str:
        return f"{PLACE}={self.place}/{LOAD}={self.load}/{BATCH}={self.batch}"

    @property
    def clause(self) -> str:
        return f"PARTITION ({PLACE} = {self.place}, {LOAD} = '{self.load}', {BATCH} = {self.batch})"


def parse(text: str) -> Part | None:
    found = _PART.search(text)
    return Part(int(found[1]), found[2], int(found[3])) if found else None


def checked(load: str) -> str:
    if not _NAME.fullmatch(load) or load == FOLDED:
        raise ValueError(f"a load is named by letters, digits, points, dashes and underscores, not {load!r}")
    return load


def fresh_load() -> str:
    """The name of a bounded load that is never repeated under this name."""
    return ONCE + uuid4().hex


def stream_load(batch: DataFrame) -> str:
    """The running query a micro-batch belongs to: the same after a restart, another with a new checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def at() -> F.Column:
    """Where in the order of all writes a row stands."""
    return F.struct(*PART_COLUMNS)


def placed(parts: list[Part], load: str, batch: int) -> Part:
    """The part a batch writes: its own if it is there, else one after all others."""
    for part in parts:
        if (part.load, part.batch) == (load, batch):
            return part
    return Part(max((part.place for part in parts), default=-1) + 1, load, batch)


class Store(Protocol):
    """What ``add`` and ``fold`` need of a store."""

    def parts(self) -> list[Part]: ...

    def put(self, rows: DataFrame, part: Part) -> None: ...

    def read(self) -> DataFrame: ...

    def remove(self, part: Part) -> None: ...

    def complete(self, part: Part) -> bool: ...


class FolderStore:
    """Parquet files below a folder; ``by`` names columns that divide each part into folders of their own."""

    def __init__(self, spark: SparkSession, path: str, columns: StructType, by: tuple[str, ...] = ()):
        self.spark, self.path, self.by = spark, path, by
        self.schema = StructType([*columns.fields]).add(PLACE, LongType()).add(LOAD, StringType()).add(BATCH, LongType())

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def parts(self) -> list[Part]:
        return parts_under(self.spark, self.path)

    def put(self, rows: DataFrame, part: Part) -> None:
        rows.write.mode("overwrite").partitionBy(*self.by).parquet(f"{self.path}/{part.folder}")

    def remove(self, part: Part) -> None:
        remove_folder(self.spark, f"{self.path}/{part.folder}")

    def complete(self, part: Part) -> bool:
        return is_complete(self.spark, f"{self.path}/{part.folder}")


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def parts_under(spark: SparkSession, path: str) -> list[Part]:
    """The parts that have a folder under ``path``, with rows or without."""
    place, files = _file_system(spark, f"{path}/{PLACE}=*/{LOAD}=*/{BATCH}=*")
    found = files.globStatus(place) or []
    return sorted(part for part in (parse(status.getPath().toString()) for status in found) if part)


def make_folder(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.mkdirs(place)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write into this folder has been committed."""
    mark, files = _file_system(spark, f"{path}/_SUCCESS")
    return files.exists(mark)


def file_sizes(spark: SparkSession, path: str) -> list[int]:
    """Bytes of the data files of a folder, none if it is not there."""
    place, files = _file_system(spark, f"{path}/part-*")
    return [status.getLen() for status in files.globStatus(place) or []]


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever file system it is."""
    place, files = _file_system(spark, path)
    files.delete(place, True)


def add(store: Store, rows: DataFrame, load: str | None = None, batch: int = 0, keep: bool = False) -> Part:
    """Write a batch of a load; without a name it is a load of its own, after all that is there.

    With ``keep`` a batch that is complete stays as it is: streams that follow
    the store know its files by name.
    """
    part = placed(store.parts(), checked(load) if load else fresh_load(), batch)
    if not (keep and store.complete(part)):
        store.put(rows, part)
    return part


def fold(store: Store, latest: Callable[[DataFrame], DataFrame], scratch: str) -> None:
    """Join all parts into one that holds ``latest`` of their rows.

    The rows are written aside first.  After whatever step a failure comes,
    readers see the same rows, because the folded part stands at the last of
    their places; a load that goes on meanwhile takes a later place.
    """
    spark = store.read().sparkSession
    parts = store.parts()
    before = max((part.place for part in parts if part.load == FOLDED), default=-1)
    last = max((part.place for part in parts), default=-1)
    if last <= before or len(parts) < 2:
        return  # what stands at or before the folded part's place is in it
    aside = f"{scratch.rstrip('/')}/fold-{uuid4().hex}"
    latest(store.read().filter(F.col(PLACE) <= last)).write.parquet(aside)
    folded = spark.read.parquet(aside)
    store.put(folded, Part(last, FOLDED, 0))
    newest = {load: max(part.batch for part in parts if part.load == load) for load in {part.load for part in parts}}
    for part in parts:
        if part.load == FOLDED or part.load.startswith(ONCE) or part.batch < newest[part.load]:
            store.remove(part)
        else:
            store.put(folded.limit(0), part)
    remove_folder(spark, aside)

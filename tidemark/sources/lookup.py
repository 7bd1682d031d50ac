"""Look-up dimensions that are read again once they are old."""

from __future__ import annotations

import time
from collections import OrderedDict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

# Rows of (code, label) up to which a dimension is sent to every executor.
BROADCAST_ROWS = 200_000


class Lookup:
    """A dimension table kept in executor memory and reloaded after ``ttl`` seconds.

    ``current()`` is called while a batch is planned; a job that is planned
    anew for every micro-batch (``runner.start_job``) sees changes of the table
    at most ``ttl`` seconds late.  Where a stream itself is joined, ``live()``
    is used: it is not kept in memory, and Spark reads it again in every
    micro-batch, a database table as it then is and a folder as listed at the
    start.  The row count is taken on each load; only a table of at most
    ``broadcast_rows`` is hinted for broadcast, a larger one is joined by
    shuffle.
    """

    def __init__(self, load: Callable[[], DataFrame], ttl: float = 60.0, broadcast_rows: int = BROADCAST_ROWS):
        self._load = load
        self._ttl = ttl
        self._broadcast_rows = broadcast_rows
        self._table: DataFrame | None = None
        self._loaded_at = 0.0
        self.rows = 0
        self.loads = 0

    def current(self) -> DataFrame:
        if self._table is None or time.monotonic() - self._loaded_at >= self._ttl:
            fresh = self._load().persist()
            self.rows = fresh.count()
            self.loads += 1
            if self._table is not None:
                self._table.unpersist()
            self._table, self._loaded_at = fresh, time.monotonic()
        return F.broadcast(self._table) if self.small else self._table

    def live(self) -> DataFrame:
        table = self._load()
        self.rows = table.count()
        return F.broadcast(table) if self.small else table

    @property
    def small(self) -> bool:
        return self.rows <= self._broadcast_rows


class KeyedLookup:
    """A dimension table of which only the codes a batch needs are read, and kept for ``ttl`` seconds.

    The codes of a batch are looked at first.  Those that are not known, or
    too old, are fetched with a filter on the code, which reaches the files or
    the database.  Nothing is broadcast but fetched rows: at most ``most_rows``
    and ``most_bytes`` of them.  A batch that needs more is joined by shuffle
    with the table as it is, without any hint.
    """

    def __init__(
        self,
        load: Callable[[], DataFrame],
        code: str = "dic_code",
        ttl: float = 60.0,
        most_rows: int = 10_000,
        most_bytes: int = 8 << 20,
    ):
        self._load, self.code, self.ttl = load, code, ttl
        self.most_rows, self.most_bytes = most_rows, most_bytes
        self._known: OrderedDict[object, tuple[float, list]] = OrderedDict()
        self.fetches = 0

    def needed(self, facts: DataFrame, on: str) -> DataFrame:
        """The rows of the codes in column ``on`` of a bounded batch."""
        codes = [row[0] for row in facts.select(on).filter(F.col(on).isNotNull()).distinct().limit(self.most_rows + 1).collect()]
        table = self._load()
        if len(codes) > self.most_rows or not self._fetch(table, codes):
            return table
        rows = [row for code in codes for row in self._known[code][1]]
        if sum(len(str(value)) + 16 for row in rows for value in row) > self.most_bytes:
            return table.filter(F.col(self.code).isin(codes))
        return F.broadcast(facts.sparkSession.createDataFrame(rows, table.schema))

    def _fetch(self, table: DataFrame, codes: list) -> bool:
        """Make the codes known; not if they have too many rows."""
        now = time.monotonic()
        missing = [code for code in codes if code not in self._known or now - self._known[code][0] >= self.ttl]
        if missing:
            rows = self.wanted(table, missing).limit(self.most_rows + 1).collect()
            self.fetches += 1
            if len(rows) > self.most_rows:
                return False
            found: dict[object, list] = {code: [] for code in missing}
            for row in rows:
                found[row[self.code]].append(row)
            for code, its_rows in found.items():
                self._known[code] = (now, its_rows)
                self._known.move_to_end(code)
            needed = set(codes)
            while len(self._known) > self.most_rows and next(iter(self._known)) not in needed:
                self._known.popitem(last=False)
        return True

    def wanted(self, table: DataFrame, codes: list) -> DataFrame:
        """The rows of some codes only."""
        return table.filter(F.col(self.code).isin(codes))


def read_lookup(
    spark: SparkSession,
    path: str | None = None,
    jdbc: dict[str, str] | None = None,
    ttl: float = 60.0,
    columns: tuple[str, ...] = ("dic_code", "dic_name"),
    keyed: str | None = None,
) -> Lookup | KeyedLookup:
    """Dictionary from a parquet folder or, with ``jdbc`` options, from a database table.

    ``keyed`` names the code column of a table of which only needed codes are read.
    """
    if (path is None) == (jdbc is None):
        raise ValueError("give either a path or jdbc options")

    def load() -> DataFrame:
        reader = spark.read.format("jdbc").options(**jdbc) if jdbc else spark.read.format("parquet").option("path", path)
        return reader.load().select(*columns)

    return KeyedLookup(load, keyed, ttl) if keyed else Lookup(load, ttl)

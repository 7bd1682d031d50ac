"""Dimension tables from change records and a live configuration.

``dim_sink`` looks a configuration table up in every batch.  ``live_dim_sink``
follows the configuration's own changes next to those of the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators import changes as c
from tidemark.operators.routing import ROUTE_FIELDS, as_of, pruned, route_dimensions, route_versions
from tidemark.sinks import loads
from tidemark.sinks.dimensions import columns_of, routes_as_rows, upsert_dim
from tidemark.sinks.loads import FolderStore, stream_load
from tidemark.sources.lookup import Lookup
from tidemark.streaming.runner import start_batches

VERSIONS = "source_table STRING, since BIGINT, changed BOOLEAN, alive BOOLEAN, sink_table STRING, sink_columns STRING, sink_pk STRING, sink_extend STRING"
WAITING = "type STRING, ts STRING, data MAP<STRING, STRING>, seq BIGINT, table STRING"


def routed(changes: DataFrame, routes: DataFrame | Lookup, on_missing: str = "drop") -> DataFrame:
    """Inserts, updates and snapshot rows with their dimension table and its columns."""
    return route_dimensions(c.of_known_types(changes), routes, on_missing)


def dim_sink(
    changes: DataFrame,
    routes: DataFrame | Lookup,
    database: str,
    root: str,
    order: list[str] | None = None,
    checkpoint: str | None = None,
    load: str | None = None,
    **trigger,
) -> StreamingQuery | None:
    """Fill the dimension tables; a stream looks at the configuration again in every batch.

    A bounded load comes after what is there, or, if its name ``load`` has been
    loaded before, replaces that.
    """

    def put(batch: DataFrame, number: int, load: str | None) -> None:
        table = routes.current() if isinstance(routes, Lookup) else routes
        known = routes_as_rows(table)
        # named outright, the tables can be skipped where records are stored
        wanted = batch.filter(F.col("table").isin([route.source_table for route in known]))
        upsert_dim(routed(wanted, table), known, database, root, number, order, load)

    if not changes.isStreaming:
        return put(changes, 0, load)
    return start_batches(changes, lambda batch, number: put(batch, number, stream_load(batch)), "dim_sink", checkpoint, **trigger)


def route_store(spark: SparkSession, root: str) -> FolderStore:
    """All versions of the configuration that have arrived."""
    return FolderStore(spark, f"{root.rstrip('/')}/_routes", StructType.fromDDL(VERSIONS))


def waiting_store(spark: SparkSession, root: str) -> FolderStore:
    """Changes of tables that had no route yet, a folder for each table."""
    return FolderStore(spark, f"{root.rstrip('/')}/_waiting", StructType.fromDDL(WAITING), ("table",))


def sink_routes(versions: list[Row]) -> list[Row]:
    """One route for each dimension table: all columns that its versions name, key and extension of the last one."""
    merged: dict[str, dict] = {}
    for version in sorted(versions, key=lambda v: (v.since, v.changed)):
        if version.alive:
            before = merged.get(version.sink_table, {"columns": {}})
            before["columns"].update(dict.fromkeys(columns_of(version)))
            merged[version.sink_table] = {**before, "last": version}
    return [
        Row(*ROUTE_FIELDS)(known["last"].source_table, table, ",".join(known["columns"]), known["last"].sink_pk, known["last"].sink_extend)
        for table, known in merged.items()
    ]


def live_routes(spark: SparkSession, root: str) -> list[Row]:
    """The routes of all dimension tables under ``root``, for ``read_dim``."""
    return sink_routes(route_store(spark, root).read().collect())


def live_dim_sink(
    envelopes: DataFrame,
    changes: DataFrame,
    database: str,
    root: str,
    on_missing: str = "drop",
    wait_for: list[str] | None = None,
    order: list[str | Column] | None = None,
    checkpoint: str | None = None,
    **trigger,
) -> StreamingQuery:
    """Fill the dimension tables while their configuration changes, both as streams of one query.

    ``envelopes`` are the configuration's changes (``read_debezium``); all
    versions that have arrived are kept under ``root``.  A change of a table is
    routed by the version that held when it happened.  From a version's time on,
    its columns are written (the table gets new ones); after a deletion nothing
    is.  Configuration of a micro-batch counts before its changes.

    A change of a table without any version goes, or with
    ``on_missing='replay'`` waits in a folder of its table (only tables named by ``wait_for``,
    if given: all others would wait for ever).  The batch that brings the first version
    takes them along; they are removed when a later batch changes the configuration.
    A batch that is run again finds the same versions and the same waiting
    changes, and replaces what it wrote.
    """
    if on_missing not in ("drop", "replay"):
        raise ValueError("on_missing is 'drop' or 'replay'")
    spark = changes.sparkSession
    routes, waiting = route_store(spark, root), waiting_store(spark, root)
    names = [name for name in ("table", "type", "ts", "data", "seq") if name in changes.columns]
    facts = c.of_known_types(changes).select(*names, F.lit(False).alias("_config"))
    config = route_versions(envelopes).select(F.struct("*").alias("_version"), F.lit(True).alias("_config"))

    def put(batch: DataFrame, number: int) -> None:
        load = stream_load(batch)
        held = batch.persist()
        try:
            fresh = held.filter("_config").select("_version.*")
            arrived = None if fresh.isEmpty() else loads.add(routes, fresh, load, number)
            known = routes.read().collect()  # the configuration, never changes of tables
            rows = held.filter("NOT _config").select(*names)
            if on_missing == "replay":
                rows = rows.unionByName(_released(known, arrived), allowMissingColumns=True)
            versions = spark.createDataFrame(known, routes.schema)
            routed = as_of(rows, versions)
            if on_missing == "replay":
                left = routed.filter(F.col("_route").isNull() & F.col("table").isNotNull())
                if wait_for is not None:
                    left = left.filter(F.col("table").isin(wait_for))
                if not left.isEmpty():
                    columns = [F.col(f.name) if f.name in left.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in waiting.schema[:5]]
                    loads.add(waiting, left.select(*columns), load, number)
            upsert_dim(pruned(routed), sink_routes(known), database, root, number, order, load, keep=False)
            if arrived:
                _forget(known, arrived)
        finally:
            held.unpersist()

    def first_parts(known: list[Row]) -> dict[str, loads.Part]:
        """Which part brought the first version of each table."""
        found: dict[str, loads.Part] = {}
        for version in sorted(known, key=lambda v: v[loads.PLACE]):
            found.setdefault(version.source_table, loads.Part(*[version[name] for name in loads.PART_COLUMNS]))
        return found

    def _released(known: list[Row], arrived: loads.Part | None) -> DataFrame:
        # the folder's name is the table, so only what is released is read
        tables = [table for table, part in first_parts(known).items() if part == arrived]
        return waiting.read().filter(F.col("table").isin(tables)).select(*names)

    def _forget(known: list[Row], arrived: loads.Part) -> None:
        done = {table for table, part in first_parts(known).items() if part.place < arrived.place}
        for part in waiting.parts():
            for table in done:
                loads.remove_folder(spark, f"{waiting.path}/{part.folder}/table={table}")

    both = facts.unionByName(config, allowMissingColumns=True)
    return start_batches(both, put, "live_dim_sink", checkpoint, **trigger)

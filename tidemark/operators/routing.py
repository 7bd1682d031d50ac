"""Change records routed to dimension tables by a configuration table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.sources.cdc import DELETED, SNAPSHOT
from tidemark.sources.lookup import Lookup

ROUTE_FIELDS = ["source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend"]


def latest_routes(envelopes: DataFrame) -> DataFrame:
    """The route of each source table after its last change; a deleted one has none."""
    table = F.coalesce("after.source_table", "before.source_table").alias("source_table")
    # the snapshot comes before changes of the same millisecond
    newest = F.max_by(F.struct("op", "after"), F.struct("ts_ms", (F.col("op") != "r").alias("_change")))
    last = envelopes.groupBy(table).agg(newest.alias("_last")).filter(F.col("_last.op") != DELETED)
    return last.select(*[F.col(f"_last.after.{field}").alias(field) for field in ROUTE_FIELDS])


def route_versions(envelopes: DataFrame) -> DataFrame:
    """Every version of every route: from when on it holds, and whether it is ``alive`` or deleted."""
    return envelopes.select(
        F.coalesce("after.source_table", "before.source_table").alias("source_table"),
        F.col("ts_ms").alias("since"),
        # the snapshot comes before changes of the same millisecond
        (F.col("op") != SNAPSHOT).alias("changed"),
        (F.col("op") != DELETED).alias("alive"),
        *[F.col(f"after.{field}").alias(field) for field in ROUTE_FIELDS[1:]],
    ).filter(F.col("source_table").isNotNull())


def as_of(changes: DataFrame, versions: DataFrame) -> DataFrame:
    """Add ``_route``, the version of its table's route that held when a change happened; NULL if there is none at all.

    A change that came before the first version, or has no time, takes the
    first one.  A table has one row of versions here, so no change is repeated.
    The versions are configuration and are broadcast: most changes may be of one
    table, which a shuffle by table would give to one task.
    """
    fields = ["since", "changed", "alive", *ROUTE_FIELDS[1:]]
    # names are cut out once for a version, not once for a change
    known = versions.groupBy(F.col("source_table").alias("_source")).agg(
        F.array_sort(F.collect_list(F.struct(*fields, column_list().alias("columns")))).alias("_versions")
    )
    joined = changes.join(F.broadcast(known), F.col("table") == F.col("_source"), "left")
    time = F.col("ts").try_cast("bigint") * 1000
    held = F.filter("_versions", lambda version: version["since"] <= time)
    route = F.when(F.size(held) > 0, F.get(held, F.size(held) - 1)).otherwise(F.get("_versions", F.lit(0)))
    # a generator keeps the choice apart: it is made once for a change, not once for each use of the route
    return joined.withColumn("_route", F.explode(F.array(route))).drop("_source", "_versions")


def pruned(routed: DataFrame) -> DataFrame:
    """Changes whose route is alive, with ``sink_table`` and the columns that their version of the route names."""
    names = F.col("_route.columns")
    return (
        routed.filter(F.col("_route.alive"))
        .withColumn("sink_table", F.col("_route.sink_table"))
        .withColumn("data", F.map_filter("data", lambda name, _: F.array_contains(names, name)))
        .drop("_route")
    )


def column_list(names: str = "sink_columns"):
    return F.transform(F.split(names, ","), lambda name: F.trim(name))


def route_dimensions(changes: DataFrame, routes: DataFrame | Lookup, on_missing: str = "drop") -> DataFrame:
    """Add ``sink_table`` and cut ``data`` down to the configured columns.

    Records of tables without a route go, or with ``on_missing='replay'`` stay
    with a NULL ``sink_table``; ``plans.dim.live_dim_sink`` keeps such records
    until their route comes.
    """
    if on_missing not in ("drop", "replay"):
        raise ValueError("on_missing is 'drop' or 'replay'")
    table = routes.current() if isinstance(routes, Lookup) else routes
    known = table.select(F.col("source_table").alias("_source"), "sink_table", column_list().alias("_columns"))
    joined = changes.join(known, F.col("table") == F.col("_source"), "inner" if on_missing == "drop" else "left")
    pruned = F.map_filter("data", lambda name, _: F.array_contains(F.col("_columns"), name))
    kept = F.when(F.col("_columns").isNull(), F.col("data")).otherwise(pruned)
    return joined.withColumn("data", kept).drop("_source", "_columns")

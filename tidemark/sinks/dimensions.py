"""Dimension tables: created from the configuration, filled by upserts.

A table keeps what each batch of each load wrote in a partition of its own (see
``loads``).  No batch rewrites what is there; readers take, per key and
column, the last value that was given.  ``compact_dim`` folds partitions into
one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from tidemark.operators.routing import ROUTE_FIELDS
from tidemark.sinks import loads

DEFAULT_KEY = "id"


def routes_as_rows(routes: DataFrame) -> list[Row]:
    """The configuration on the driver: one row per dimension table, never facts."""
    return routes.select(*ROUTE_FIELDS).collect()


def key_of(route: Row) -> str:
    return (route.sink_pk or "").strip() or DEFAULT_KEY


def columns_of(route: Row) -> list[str]:
    return [name.strip() for name in route.sink_columns.split(",")]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_name(route: Row, database: str) -> str:
    return f"{_quoted(database)}.{_quoted(route.sink_table)}"


class DimStore:
    """The partitions of one dimension table."""

    def __init__(self, spark: SparkSession, table: str, path: str):
        self.spark, self.table, self.path = spark, table, path

    def read(self) -> DataFrame:
        # another session, such as that of a stream's batches, may have replaced files
        self.spark.catalog.refreshTable(self.table)
        return self.spark.table(self.table)

    def parts(self) -> list[loads.Part]:
        listed = self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()
        return sorted(part for part in (loads.parse(row[0]) for row in listed) if part)

    def put(self, rows: DataFrame, part: loads.Part) -> None:
        # columns the table has from other versions of the route stay without a value
        names = [name for name in self.read().columns if name not in loads.PART_COLUMNS]
        given = [_quoted(name) if name in rows.columns else f"CAST(NULL AS STRING) AS {_quoted(name)}" for name in names]
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} {part.clause} SELECT {', '.join(given)} FROM {{rows}}", rows=rows)
        # a part without rows has no files, but another catalog has to find it too
        loads.make_folder(self.spark, f"{self.path}/{part.folder}")

    def remove(self, part: loads.Part) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS {part.clause}")
        # the table is only named by the catalog, so its files are removed apart from it
        loads.remove_folder(self.spark, f"{self.path}/{part.folder}")


    def complete(self, part: loads.Part) -> bool:
        return loads.is_complete(self.spark, f"{self.path}/{part.folder}")


def dim_path(route: Row, root: str) -> str:
    return f"{root.rstrip('/')}/{route.sink_table}"


def ensure_dim_table(spark: SparkSession, route: Row, database: str, root: str) -> DimStore:
    """Create the table unless it exists: text columns, the key and the extension clause as properties.

    An existing table gets the columns that a new version of the route adds; a
    table that the catalog does not know yet takes over the files in its folder.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)} LOCATION {_text(root)}")
    table, path = table_name(route, database), dim_path(route, root)
    store = DimStore(spark, table, path)
    columns = ", ".join(f"{_quoted(name)} STRING" for name in columns_of(route))
    if not spark.catalog.tableExists(table):
        properties = {"primary.key": key_of(route)}
        if (route.sink_extend or "").strip():
            properties["extend"] = route.sink_extend.strip()
        listed = ", ".join(f"{_text(key)} = {_text(value)}" for key, value in properties.items())
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {loads.PART_DDL}) USING parquet "
            f"PARTITIONED BY ({', '.join(loads.PART_COLUMNS)}) LOCATION {_text(path)} TBLPROPERTIES ({listed})"
        )
        if loads.parts_under(spark, path):
            spark.sql(f"MSCK REPAIR TABLE {table}")
    known = {name.lower() for name in spark.table(table).columns}
    missing = [f"{_quoted(name)} STRING" for name in columns_of(route) if name.lower() not in known]
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(missing)})")
    return store


def upsert_dim(
    routed: DataFrame,
    routes: Iterable[Row],
    database: str,
    root: str,
    batch: int = 0,
    order: list[str | Column] | None = None,
    load: str | None = None,
    keep: bool = True,
) -> None:
    """Write a batch of routed change records to their tables.

    ``load`` and ``batch`` name the batch: written again, it replaces itself.
    Without a load it comes after all that is there.  The batch is kept while
    it is written to several tables, unless its rows are kept already (``keep``).
    """
    routes, load = list(routes), load or loads.fresh_load()
    keep = keep and len(routes) > 1
    held = routed.persist() if keep else routed
    try:
        for route in routes:
            store = ensure_dim_table(routed.sparkSession, route, database, root)
            own = held.filter(F.col("sink_table") == route.sink_table)
            if own.select("sink_table").isEmpty():
                continue
            loads.add(store, merged(own, route, order), load, batch)
    finally:
        if keep:
            held.unpersist()


def merged(rows: DataFrame, route: Row, order: list[str | Column] | None = None) -> DataFrame:
    """One row per key from payload maps: the last value given for each column.

    ``order`` is the order of changes, by default their time and read position.
    """
    key, columns = key_of(route), columns_of(route)
    # a generator keeps the pruned payload apart: it is used for every column
    rows = rows.withColumn("data", F.explode(F.array("data")))
    usual = [F.col("ts").try_cast("bigint").alias("at"), *[name for name in ("seq",) if name in rows.columns]]
    flat = rows.select(F.struct(*(order or usual)).alias("_at"), *[F.col("data")[name].alias(name) for name in columns])
    return _last_values(flat, key, columns, F.col("_at"))


def _last_values(rows: DataFrame, key: str, columns: list[str], at: Column) -> DataFrame:
    known = rows.filter(F.col(key).isNotNull())
    values = [F.max_by(name, F.when(F.col(name).isNotNull(), at)).alias(name) for name in columns if name != key]
    if not values:
        return known.select(key).distinct()
    return known.groupBy(key).agg(*values).select(*columns)


def read_dim(spark: SparkSession, route: Row, database: str) -> DataFrame:
    """The current rows of a dimension table."""
    rows = DimStore(spark, table_name(route, database), "").read()
    return _last_values(rows, key_of(route), columns_of(route), loads.at())


def compact_dim(spark: SparkSession, route: Row, database: str, root: str, scratch: str) -> None:
    """Fold the partitions of a dimension table into one, with all columns that the table has."""
    store = ensure_dim_table(spark, route, database, root)
    columns = [name for name in store.read().columns if name not in loads.PART_COLUMNS]
    loads.fold(store, lambda rows: _last_values(rows, key_of(route), columns, loads.at()), scratch)

"""Topics, upserts, fan-out, dimension tables, summaries and restarts."""

from __future__ import annotations

import json
import pathlib
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as s, topics as t
from tidemark.functions.records import good
from tidemark.operators import windows as w
from tidemark.plans import dim, traffic, user
from tidemark.session import shared_dir
from tidemark.sinks import dimensions as d, loads, summaries, topics as out
from tidemark.sources import sample, topics as src
from tidemark.topics import Topic


def drain(query):
    query.awaitTermination()


def once(**options):
    return {"availableNow": True, **options}


def test_a_topic_is_on_servers_or_in_a_folder():
    assert Topic("x", servers="h:1").on_kafka and Topic("x", root="/r/").path == "/r/x"
    with pytest.raises(ValueError):
        Topic("x")


def test_json_topic_keeps_nulls_and_round_trips(spark, folder):
    topic = Topic(t.CART_ADD, root=folder)
    rows = spark.createDataFrame([("1", None), ("2", "x")], "id STRING, user_id STRING")
    out.write_json_topic(rows, topic)
    lines = sorted(r.value for r in src.read_topic(spark, topic).collect())
    assert lines == ['{"id":"1","user_id":null}', '{"id":"2","user_id":"x"}']
    back = src.read_json_topic(spark, topic, s.record("id user_id"))
    assert sorted((r.id, r.user_id) for r in back.collect()) == [("1", None), ("2", "x")]
    assert "pt" in back.columns and "seq" in back.columns


def test_changelog_topic(spark, folder):
    topic = Topic(t.CHANGES, root=folder)
    record = {"database": "g", "table": "a", "type": "insert", "ts": 5, "data": {"id": "1", "x": {"y": 1}}, "old": None}
    lines = spark.createDataFrame([(json.dumps(record),), ("junk",)], "value STRING")
    out.write_topic(lines, topic)
    row = src.read_changelog(spark, topic).collect()
    assert len(row) == 1 and row[0].data == {"id": "1", "x": '{"y":1}'} and row[0].ts == "5" and row[0].old is None


def test_page_log_reader_has_event_time(spark, folder):
    topic = Topic(t.PAGE, root=folder)
    out.write_topic(spark.createDataFrame([('{"common":{"mid":"m"},"page":{},"ts":1704890096789}',)], "value STRING"), topic)
    row = src.read_page_log(spark, topic, delay="2 seconds").collect()[0]
    assert row.rt.microsecond == 0 and row.common.mid == "m"
    stream = src.read_page_log(spark, topic, streaming=True, delay="2 seconds")
    assert stream.isStreaming and "spark.watermarkDelayMs" in stream.schema["rt"].metadata


def test_typed_readers(spark, folder):
    columns = {"pre": (src.read_order_pre, 44), "detail": (src.read_order_detail, 19), "pay": (src.read_pay_order_detail, 21)}
    for name, (reader, count) in columns.items():
        topic = Topic(name, root=folder)
        out.write_topic(spark.createDataFrame([('{"id":"1","row_op_ts":"2024-01-10T00:00:00.000Z"}',)], "value STRING"), topic)
        rows = reader(spark, topic)
        assert len(rows.columns) == count + 2 and rows.count() == 1
        assert rows.collect()[0].row_op_ts.year == 2024


def test_upsert_topic_keeps_the_last_row_per_key(spark, folder):
    topic = Topic(t.ORDER_PRE, root=folder)
    rows = spark.createDataFrame([("1", 1, "a"), ("1", 2, "b"), ("2", 1, "c")], "id STRING, n INT, v STRING")
    out.write_upsert_topic(rows, topic, ["id"], ["n"])
    schema = s.record("id v")
    assert sorted((r.id, r.v) for r in out.read_upsert_topic(spark, topic, schema).collect()) == [("1", "b"), ("2", "c")]


def test_bounded_upserts_follow_each_other(spark, folder):
    topic, schema = Topic("up", root=folder), "id STRING, n INT, v STRING"
    for rows in ([("1", 1, "a"), ("2", 1, "x")], [("1", 2, "b")], [("3", 1, "y")]):
        out.write_upsert_topic(spark.createDataFrame(rows, schema), topic, ["id"], ["n"])
    found = out.read_upsert_topic(spark, topic, s.record("id v")).collect()
    assert sorted((r.id, r.v) for r in found) == [("1", "b"), ("2", "x"), ("3", "y")]


def test_upsert_stream_and_restart(spark, folder):
    """A second run with the same checkpoint reads only what is new."""
    topic, schema = Topic("up", root=f"{folder}/out"), "id STRING, n INT, v STRING"

    def add(*rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        drain(out.write_upsert_topic(stream, topic, ["id"], ["n"], f"{folder}/cp", **once()))

    add(("1", 1, "a"), ("2", 1, "x"))
    run()
    add(("1", 2, "b"))
    run()
    run()
    found = out.read_upsert_topic(spark, topic, s.record("id v")).collect()
    assert sorted((r.id, r.v) for r in found) == [("1", "b"), ("2", "x")]
    assert spark.read.parquet(topic.path).count() == 3


def test_fan_out_of_the_log_stream(spark, sf, folder):
    """Log lines as a stream of two files, split into five topics, restarted in between."""
    lines = sample.raw_log(spark, sf)
    schema = lines.schema
    topics = {tag: Topic(name, root=folder) for tag, name in t.LOG_TOPICS.items()}
    half = lines.filter("seq < 500"), lines.filter("seq >= 500")
    for part in half:
        part.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
        drain(out.fan_out(traffic.base_log(stream), topics, "base_log", f"{folder}/cp", **once()))
        drain(out.write_topic(traffic.dirty_log(stream), Topic(t.DIRTY, root=folder), f"{folder}/cp2", **once()))
    expected = {r.tag: r["count"] for r in traffic.base_log(lines).groupBy("tag").count().collect()}
    found = {tag: src.read_topic(spark, topic).count() for tag, topic in topics.items()}
    assert found == expected
    assert src.read_topic(spark, Topic(t.DIRTY, root=folder)).count() == traffic.dirty_log(lines).count()
    pages = good(src.decode(src.read_topic(spark, topics["page"]), s.PAGE_LOG))
    split = traffic.base_log(lines).filter("tag = 'page'")
    expected_new = split.filter(F.get_json_object("value", "$.common.is_new") == "1").count()
    assert pages.filter("common.is_new = '1'").count() == expected_new


def test_bounded_fan_out(spark, sf, folder):
    rows = traffic.base_log(sample.raw_log(spark, sf))
    out.fan_out(rows, {"start": Topic(t.START, root=folder)}, "x")
    assert src.read_topic(spark, Topic(t.START, root=folder)).count() == rows.filter("tag = 'start'").count()


# --- dimensions --------------------------------------------------------------
ROUTES = "SELECT 'a' source_table, 'dim_a' sink_table, 'id,x,y' sink_columns, '' sink_pk, 'SALT_BUCKETS = 3' sink_extend"
CHANGE = "table STRING, type STRING, ts STRING, data MAP<STRING,STRING>"


def change(spark, *rows):
    return spark.createDataFrame([("a", kind, ts, data) for kind, ts, data in rows], CHANGE)


def test_dimension_upserts_column_by_column(spark, folder):
    routes = spark.sql(ROUTES)
    route = d.routes_as_rows(routes)[0]
    rows = change(
        spark,
        ("bootstrap-insert", "1", {"id": "1", "x": "it's", "y": "p", "z": "unused"}),
        ("update", "10", {"id": "1", "x": "new"}),
        ("update", "9", {"id": "1", "x": "older"}),
        ("delete", "11", {"id": "1", "x": "gone"}),
        ("insert", "2", {"id": "2", "y": 'q"'}),
    )
    dim.dim_sink(rows, routes, "dims", folder)
    assert sorted(map(tuple, d.read_dim(spark, route, "dims").collect())) == [("1", "new", "p"), ("2", None, 'q"')]
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES dims.dim_a").collect()}
    assert properties["primary.key"] == "id" and properties["extend"] == "SALT_BUCKETS = 3"
    types = {f.name: f.dataType.typeName() for f in spark.table("dims.dim_a").schema}
    assert types == {"id": "string", "x": "string", "y": "string", "_place": "long", "_load": "string", "_batch": "long"}
    # later batches, one of them run twice
    for _ in range(2):
        later = dim.routed(change(spark, ("update", "20", {"id": "2", "x": "k"})), routes)
        d.upsert_dim(later, [route], "dims", folder, 1, load="later")
    assert sorted(map(tuple, d.read_dim(spark, route, "dims").collect())) == [("1", "new", "p"), ("2", "k", 'q"')]
    d.compact_dim(spark, route, "dims", folder, f"{folder}/aside")
    # the batch that may be repeated keeps its place, so a repetition replaces only itself
    assert [(r._load, r["count"]) for r in spark.table("dims.dim_a").groupBy("_load").count().collect()] == [("folded", 2)]
    d.upsert_dim(later, [route], "dims", folder, 1, load="later")
    assert sorted(map(tuple, d.read_dim(spark, route, "dims").collect())) == [("1", "new", "p"), ("2", "k", 'q"')]
    # two bounded loads, the second after the first
    dim.dim_sink(change(spark, ("insert", "30", {"id": "3", "x": "a"})), routes, "dims", folder)
    dim.dim_sink(change(spark, ("insert", "31", {"id": "4", "x": "b"})), routes, "dims", folder)
    held = sorted(map(tuple, d.read_dim(spark, route, "dims").collect()))
    assert held == [("1", "new", "p"), ("2", "k", 'q"'), ("3", "a", None), ("4", "b", None)]
    spark.sql("DROP DATABASE dims CASCADE")


class DimRuns:
    """Loads of one dimension table: bounded ones, and streams with one change a batch."""

    def __init__(self, spark, folder, database):
        self.spark, self.folder, self.database = spark, folder, database
        self.routes = spark.sql(ROUTES)
        self.route = d.routes_as_rows(self.routes)[0]

    def load(self, key, value, ts="1", **named):
        dim.dim_sink(change(self.spark, ("insert", ts, {"id": key, "x": value})), self.routes, self.database, f"{self.folder}/dims", **named)

    def stream(self, name, *changes):
        """Goes on with the stream of this name: one batch for each change."""
        for key, value in changes:
            row = change(self.spark, ("insert", "1", {"id": key, "x": value})).coalesce(1)
            row.write.mode("append").parquet(f"{self.folder}/{name}")
        rows = self.spark.readStream.schema(CHANGE).option("maxFilesPerTrigger", 1).parquet(f"{self.folder}/{name}")
        drain(dim.dim_sink(rows, self.routes, self.database, f"{self.folder}/dims", checkpoint=f"{self.folder}/cp-{name}", **once()))

    def again(self, name):
        """The last batch of a stream is run again, as after a failure before its commit."""
        last = max(int(f.name) for f in pathlib.Path(f"{self.folder}/cp-{name}/commits").iterdir() if f.name.isdigit())
        for file in pathlib.Path(f"{self.folder}/cp-{name}/commits").glob(f"*{last}*"):
            if file.name in (str(last), f".{last}.crc"):
                file.unlink()
        self.stream(name)

    def fold(self):
        d.compact_dim(self.spark, self.route, self.database, f"{self.folder}/dims", f"{self.folder}/aside")

    def rows(self):
        return {r.id: r.x for r in d.read_dim(self.spark, self.route, self.database).collect()}


@pytest.fixture
def runs(spark, folder):
    database = f"runs_{uuid4().hex}"
    yield DimRuns(spark, folder, database)
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_a_stream_follows_a_bounded_load(runs):
    runs.load("1", "a")
    runs.stream("s", ("2", "b"))
    assert runs.rows() == {"1": "a", "2": "b"}


def test_a_bounded_load_between_batches_of_a_stream(runs):
    runs.stream("s", ("0", "a"), ("1", "b"), ("2", "c"))
    runs.load("9", "z")
    runs.load("2", "y")
    runs.stream("s", ("3", "d"), ("0", "e"))
    assert runs.rows() == {"0": "e", "1": "b", "2": "y", "3": "d", "9": "z"}


def test_a_new_checkpoint_comes_after_the_old_stream(runs):
    runs.stream("s", *[("1", f"old{n}") for n in range(3)])
    runs.stream("t", ("1", "new"))
    assert runs.rows() == {"1": "new"}


def test_a_repeated_batch_replaces_itself_only(runs):
    runs.stream("s", ("1", "a"), ("2", "b"))
    runs.load("2", "later")
    runs.again("s")
    assert runs.rows() == {"1": "a", "2": "later"}


def test_a_batch_repeated_after_folding_keeps_its_place(runs):
    runs.stream("s", ("7", "a"), ("8", "b"))
    runs.fold()
    runs.load("7", "x")
    runs.load("8", "y")
    runs.again("s")
    assert runs.rows() == {"7": "x", "8": "y"}
    runs.fold()
    runs.again("s")
    runs.stream("s", ("7", "last"))
    runs.fold()
    runs.fold()
    assert runs.rows() == {"7": "last", "8": "y"}
    parts = loads.parts_under(runs.spark, f"{runs.folder}/dims/dim_a")
    assert len(parts) == 2 and {part.load == loads.FOLDED for part in parts} == {True, False}


def test_a_named_load_replaces_itself(runs):
    runs.load("1", "a", load="monday")
    runs.load("1", "b", load="tuesday")
    runs.load("1", "c", load="monday")
    assert runs.rows() == {"1": "b"}
    with pytest.raises(ValueError):
        runs.load("1", "c", load="no/name")


def test_a_table_unknown_to_the_catalog_takes_its_files_over(runs, spark):
    runs.load("1", "a")
    spark.sql(f"DROP TABLE {runs.database}.dim_a")
    runs.load("2", "b")
    assert runs.rows() == {"1": "a", "2": "b"}
    runs.stream("s", ("1", "c"))
    runs.fold()
    spark.sql(f"DROP TABLE {runs.database}.dim_a")
    runs.load("1", "d")
    runs.again("s")
    assert runs.rows() == {"1": "d", "2": "b"}


def test_upsert_loads_and_streams_follow_each_other(spark, folder):
    topic, schema = Topic("up", root=f"{folder}/out"), "id STRING, n INT, v STRING"

    def load(*rows, **named):
        out.write_upsert_topic(spark.createDataFrame(list(rows), schema), topic, ["id"], ["n"], **named)

    def stream(name, *rows):
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        source = spark.readStream.schema(schema).parquet(f"{folder}/{name}")
        drain(out.write_upsert_topic(source, topic, ["id"], ["n"], f"{folder}/cp-{name}", **once()))

    def held():
        return {r.id: r.v for r in out.read_upsert_topic(spark, topic, s.record("id v")).collect()}

    assert out.read_upsert_topic(spark, topic, s.record("id v")).count() == 0
    load(("1", 1, "a"))
    stream("s", ("2", 1, "b"))
    assert held() == {"1": "a", "2": "b"}
    load(("2", 2, "c"), load="fix")
    stream("s", ("3", 1, "d"))
    out.compact_upsert_topic(spark, topic, f"{folder}/aside")
    load(("3", 2, "e"))
    load(("2", 3, "again"), load="fix")
    stream("t", ("1", 2, "f"))
    assert held() == {"1": "f", "2": "c", "3": "e"}


def test_dimension_stream_sees_a_new_route(spark, folder):
    """The configuration is looked at in every batch."""
    from tidemark.sources.lookup import Lookup

    tables = ["a"]
    routes = Lookup(
        lambda: spark.sql(" UNION ALL ".join(ROUTES.replace("'a'", f"'{x}'").replace("dim_a", f"dim_{x}") for x in tables)), 0.0
    )

    def run():
        stream = spark.readStream.schema(CHANGE).parquet(f"{folder}/in")
        drain(dim.dim_sink(stream, routes, "dims2", f"{folder}/dims", checkpoint=f"{folder}/cp", **once()))

    def add(table, number):
        rows = spark.createDataFrame([(table, "insert", "1", {"id": number})], CHANGE)
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")

    add("a", "1")
    add("b", "1")
    run()
    tables.append("b")
    add("b", "2")
    run()
    rows = {r.sink_table: [x.id for x in d.read_dim(spark, r, "dims2").collect()] for r in d.routes_as_rows(routes.current())}
    assert rows == {"dim_a": ["1"], "dim_b": ["2"]}
    spark.sql("DROP DATABASE dims2 CASCADE")


# --- summaries ---------------------------------------------------------------
def test_summary_columns_and_exclusion(spark, sf, folder):
    pages = sample.page_log(spark, sf)
    summary = traffic.page_view_window(pages)
    summaries.write_summary(summary, s.PAGE_VIEW_SUMMARY, path=f"{folder}/full")
    summaries.write_summary(summary, s.PAGE_VIEW_SUMMARY, path=f"{folder}/less", exclude=["ts"])
    full = spark.read.parquet(f"{folder}/full")
    assert full.columns == s.PAGE_VIEW_SUMMARY and full.filter("ts IS NULL").count() == 0
    assert spark.read.parquet(f"{folder}/less").columns == s.PAGE_VIEW_SUMMARY[:-1]
    assert full.count() == summary.count()


def test_all_summaries_have_the_stores_columns(spark, sf):
    import warehouse_queries as q

    expected = {
        "dws_keyword_window": s.KEYWORD_SUMMARY, "dws_traffic_window": s.TRAFFIC_SUMMARY,
        "dws_page_view_window": s.PAGE_VIEW_SUMMARY, "dws_login_window": s.LOGIN_SUMMARY,
        "dws_register_window": s.REGISTER_SUMMARY, "dws_cart_add_window": s.CART_ADD_SUMMARY,
        "dws_payment_window": s.PAYMENT_SUMMARY, "dws_order_window": s.ORDER_SUMMARY,
    }
    for name, columns in expected.items():
        assert w.stamped(q.QUERIES[name](spark, sf), columns).columns == columns


def test_summary_stream_restarts_without_repeating(spark, folder):
    def add(*seconds):
        rows = [(f"2024-01-10 12:00:{n:02d}",) for n in seconds]
        spark.createDataFrame(rows, "create_time STRING").coalesce(1).write.mode("append").parquet(f"{folder}/in")

    def run():
        stream = spark.readStream.schema("create_time STRING").parquet(f"{folder}/in")
        drain(
            summaries.write_summary(
                user.register_window(stream), s.REGISTER_SUMMARY, path=f"{folder}/out", checkpoint=f"{folder}/cp", **once()
            )
        )

    add(1, 2)
    run()
    add(9, 15, 40)
    run()
    run()
    found = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.stt[-2:], r.registerCt) for r in found) == [("00", 3), ("10", 1)]


def test_shared_folder_comes_from_the_session(spark, folder):
    class Named:
        class conf:
            @staticmethod
            def get(key, default):
                return folder + "/" if key == "spark.checkpoint.dir" else default

    assert shared_dir(Named) == folder
    named = spark.conf.get("spark.checkpoint.dir", None)
    chosen = shared_dir(spark)
    assert chosen == named or (named is None and chosen.startswith("/tmp/run-"))
    assert shared_dir(spark) == chosen


def test_a_cluster_must_name_its_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master, applicationId = "yarn", "a"

    with pytest.raises(ValueError):
        shared_dir(Cluster)

"""Split stores, a configuration that changes during a run, counted late rows, clocked runs."""

from __future__ import annotations

import json
import pathlib
import time
from datetime import datetime, timedelta
from uuid import uuid4

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as s, topics as t
from tidemark.operators import firsts, routing, windows as w
from tidemark.plans import dim, traffic
from tidemark.sinks import dimensions as d, loads, split, topics as out
from tidemark.sources import sample, topics as src
from tidemark.sources.cdc import read_debezium
from tidemark.sources.replay import played, read_splits, split_of, write_splits
from tidemark.streaming import stateful
from tidemark.streaming.runner import LateRows, run_available, run_clocked, start_batches
from tidemark.topics import Topic

LINES = [
    '{"database":"g","table":"a","type":"insert","ts":"1","data":{"id":"1","x":null},"old":null}',
    '{"database":"g","table":"b","type":"update","ts":"2","data":{"id":"2"},"old":{"x":"y"}}',
    '{"database":"g","table":"a","type":"insert","ts":{"odd":1},"data":{"id":"3"}}',
    '{"database":"g","type":"insert"}',
    "no json",
    "",
]


def lines(spark, *texts):
    return spark.createDataFrame([(text, n) for n, text in enumerate(texts)], "value STRING, seq BIGINT")


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


# --- split stores --------------------------------------------------------------
def test_changes_are_parsed_once_and_read_by_table(spark, folder):
    store = split.change_store(spark, f"{folder}/by_table")
    assert split.read_changes(store).count() == 0
    split.split_changes(lines(spark, *LINES), store)
    rows = split.read_changes(store, "a")
    assert sorted((r.ts or "", r.data["id"], r.type) for r in rows.collect()) == [("1", "1", "insert"), ('{"odd":1}', "3", "insert")]
    assert [r.old for r in split.read_changes(store, "b").collect()] == [{"x": "y"}]
    assert set(s.CHANGE.fieldNames()) | {"seq", "pt"} == set(rows.columns)
    # only the folder of the table is listed, and no JSON is read again
    for pruned in (rows, split.read_changes(store).filter("table = 'a'")):
        plan = plan_of(pruned)
        assert plan.count("Scan parquet") == 1 and "from_json" not in plan and "table" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_one_scan_and_one_parse_of_the_text(spark, folder):
    """Writing a split store reads its text once; each job then reads only what it needs of it."""
    topic = Topic(t.CHANGES, root=folder)
    out.write_topic(lines(spark, *LINES), topic)
    text = src.read_topic(spark, topic)
    for rows, parse in ((split.decode(text, s.CHANGE, keep=["seq"]), "from_json"), (split.parsed_lines(text), "parsejson")):
        plan = plan_of(rows)
        assert plan.count("FileScan text") == 1 and plan.lower().count(parse) == 1


def test_log_lines_by_tag(spark, sf, folder):
    raw = sample.raw_log(spark, sf)
    store, tags = split.log_store(spark, f"{folder}/parsed"), split.tag_store(spark, f"{folder}/tags")
    odd = lines(spark, "[1]", '{"common":{"mid":"m"}}', '{"ts":"x"}', '{"ts":1.5,"page":{},"common":{"mid":"n","is_new":"1"}}', '{"ts":7,"x":null,"start":{}}')
    split.split_lines(raw.unionByName(odd.withColumn("seq", -F.col("seq") - 1)), store)
    split.split_log(store, tags, load="all")
    split.split_log(store, tags, load="all")  # run again, it replaces itself
    expected = {r.tag: r["count"] for r in traffic.base_log(raw).groupBy("tag").count().collect()}
    expected |= {"dirty": traffic.dirty_log(raw).count() + 3, "page": expected["page"] + 1, "start": expected["start"] + 1}
    for tag, count in expected.items():
        assert split.read_split(tags, tag).count() == count
    assert {"[1]", '{"ts":"x"}'} <= {r.value for r in split.read_split(tags, "dirty").collect()}
    wanted = sorted(r.value for r in traffic.base_log(raw).filter("tag = 'page'").collect())
    found = sorted(r.value for r in split.lines_of(tags, "page").collect())
    assert found == sorted([*wanted, '{"common":{"is_new":"1","mid":"n"},"page":{},"ts":1.5}'])


def test_a_stream_follows_a_split_store(spark, folder):
    """Written by a stream and read by another; a batch that is run again is seen once."""
    topic, store = Topic(t.CHANGES, root=folder), split.change_store(spark, f"{folder}/by_table")
    out.write_topic(lines(spark, *LINES[:2]), topic)

    def feed():
        text = src.read_topic(spark, topic, streaming=True)
        split.split_changes(text, store, checkpoint=f"{folder}/cp", availableNow=True).awaitTermination()

    def follow():
        rows = split.read_changes(store, "a", streaming=True).select("table", F.col("data")["id"].alias("id"))
        return sorted(r.id for r in played(rows, f"{folder}/follow").collect())

    feed()
    assert follow() == ["1"]
    for file in pathlib.Path(f"{folder}/cp/commits").glob("*0*"):
        file.unlink()
    feed()
    assert follow() == ["1"]
    out.write_topic(lines(spark, LINES[2]), topic)
    feed()
    assert follow() == ["1", "3"] and split.read_changes(store).count() == 3


def test_bounded_and_streamed_batches_of_a_topic_stand_beside_each_other(spark, folder):
    topic = Topic("x", root=folder)
    out.write_topic(lines(spark, "a"), topic)
    for name in ("p", "q"):
        lines(spark, name).coalesce(1).write.parquet(f"{folder}/{name}")
        rows = spark.readStream.schema("value STRING, seq BIGINT").parquet(f"{folder}/{name}")
        out.write_topic(rows, topic, f"{folder}/cp-{name}", availableNow=True).awaitTermination()
    out.write_topic(lines(spark, "b"), topic)
    assert sorted(r.value for r in src.read_topic(spark, topic).collect()) == ["a", "b", "p", "q"]


# --- a live configuration --------------------------------------------------------
def envelope(op, at, columns=None, before=None, table="a", sink="dim_a", key="id"):
    def route(names):
        return names and {"source_table": table, "sink_table": sink, "sink_columns": names, "sink_pk": key, "sink_extend": ""}

    return json.dumps({"op": op, "ts_ms": at * 1000, "before": route(before), "after": route(columns)})


CHANGE = "table STRING, type STRING, ts STRING, data MAP<STRING,STRING>"


class Live:
    """A run with one file of configuration and one of changes in each batch."""

    def __init__(self, spark, folder, **options):
        self.spark, self.folder, self.options = spark, folder, options
        self.database = f"live_{uuid4().hex}"
        self.number = 0

    def batch(self, envelopes=(), changes=()):
        texts = self.spark.createDataFrame([(text,) for text in envelopes], "value STRING")
        texts.coalesce(1).write.mode("append").parquet(f"{self.folder}/routes")
        rows = [(table, "insert", str(at), data) for table, at, data in changes]
        self.spark.createDataFrame(rows, CHANGE).coalesce(1).write.mode("append").parquet(f"{self.folder}/in")
        time.sleep(0.02)
        self.run()

    def run(self):
        query = dim.live_dim_sink(
            read_debezium(read_splits(self.spark, f"{self.folder}/routes", src.TEXT)),
            read_splits(self.spark, f"{self.folder}/in", self.spark.createDataFrame([], CHANGE).schema),
            self.database, f"{self.folder}/dims", checkpoint=f"{self.folder}/cp", availableNow=True, **self.options,
        )
        query.awaitTermination()

    def again(self):
        last = max(int(f.name) for f in pathlib.Path(f"{self.folder}/cp/commits").iterdir() if f.name.isdigit())
        for name in (f"{last}", f".{last}.crc"):
            pathlib.Path(f"{self.folder}/cp/commits/{name}").unlink(missing_ok=True)
        self.run()

    def rows(self, sink="dim_a"):
        route = next(route for route in dim.live_routes(self.spark, f"{self.folder}/dims") if route.sink_table == sink)
        return sorted(tuple(row) for row in d.read_dim(self.spark, route, self.database).collect())

    def waiting(self):
        return dim.waiting_store(self.spark, f"{self.folder}/dims").read().count()


@pytest.fixture
def live(spark, folder):
    made = []

    def make(**options):
        made.append(Live(spark, folder, **options))
        return made[-1]

    yield make
    for run in made:
        spark.sql(f"DROP DATABASE IF EXISTS {run.database} CASCADE")


def test_a_route_comes_changes_and_goes_during_a_run(live):
    run = live(on_missing="replay", wait_for=["a"])
    run.batch([], [("a", 1, {"id": "1", "x": "p", "y": "q"}), ("other", 1, {"id": "9"}), (None, 1, {"id": "8"})])
    assert run.waiting() == 1
    run.batch([], [("a", 2, {"id": "2", "x": "r", "y": "s"})])
    run.batch([envelope("c", 3, "id,x")], [("a", 4, {"id": "3", "x": "t", "y": "u"})])
    assert run.rows() == [("1", "p"), ("2", "r"), ("3", "t")]
    run.again()
    assert run.rows() == [("1", "p"), ("2", "r"), ("3", "t")]
    # a new column holds from its version's time on, also for changes that come in the version's batch
    run.batch([envelope("u", 10, "id,x,y", "id,x")], [("a", 9, {"id": "4", "x": "v", "y": "early"}), ("a", 10, {"id": "1", "x": "w", "y": "z"})])
    assert run.rows() == [("1", "w", "z"), ("2", "r", None), ("3", "t", None), ("4", "v", None)]
    assert run.waiting() == 0
    run.again()
    run.batch([envelope("d", 20, None, "id,x,y")], [("a", 20, {"id": "1", "x": "gone"}), ("a", 19, {"id": "5", "x": "kept"})])
    run.batch([], [("a", 25, {"id": "6", "x": "gone"})])
    run.batch([envelope("c", 30, "id,y")], [("a", 30, {"id": "2", "x": "not named", "y": "back"})])
    run.again()
    assert run.rows() == [("1", "w", "z"), ("2", "r", "back"), ("3", "t", None), ("4", "v", None), ("5", "kept", None)]


def test_without_replay_early_changes_go(live):
    run = live()
    run.batch([], [("a", 1, {"id": "1", "x": "p"})])
    run.batch([envelope("r", 3, "id,x")], [("a", 4, {"id": "2", "x": "q"})])
    run.batch([envelope("c", 5, "id,k", table="b", sink="dim_b", key="k")], [("b", 6, {"id": "1", "k": "z"}), ("a", 6, {"id": "2"})])
    assert run.rows() == [("2", "q")] and run.rows("dim_b") == [("1", "z")] and run.waiting() == 0
    with pytest.raises(ValueError):
        live(on_missing="keep").batch()


def test_versions_in_force(spark):
    texts = [envelope("r", 0, "id"), envelope("u", 0, "id,x", "id"), envelope("d", 9, None, "id,x"), envelope("c", 5, "id", table="b")]
    versions = routing.route_versions(read_debezium(spark.createDataFrame([(x,) for x in texts], "value STRING")))
    rows = spark.createDataFrame([("a", "1", 1), ("a", "9", 2), ("a", None, 3), ("b", "1", 4), ("c", "1", 5), (None, "1", 6)], "table STRING, ts STRING, n INT")
    held = {r.n: r._route and (r._route.alive, r._route.sink_columns) for r in routing.as_of(rows, versions).collect()}
    assert held == {1: (True, "id,x"), 2: (False, None), 3: (True, "id"), 4: (True, "id"), 5: None, 6: None}


# --- late rows --------------------------------------------------------------------
def test_late_rows_are_counted_beyond_what_progress_keeps(spark, folder):
    start = datetime(2024, 1, 10)
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    listener = LateRows(spark, f"{folder}/late")
    spark.streams.addListener(listener)
    try:
        assert listener.total() == 0
        # every batch after the second has two rows that the watermark has passed
        for n in range(7):
            rows = [(start + timedelta(minutes=n),), (start - timedelta(days=1),), (start - timedelta(days=2),)]
            spark.createDataFrame(rows if n else rows[:1], "rt TIMESTAMP").coalesce(1).write.mode("append").parquet(f"{folder}/in")
            time.sleep(0.02)
        schema = spark.createDataFrame([], "rt TIMESTAMP").schema

        def run():
            counted = w.tumbling(w.with_delay(read_splits(spark, f"{folder}/in", schema), "rt"), "rt", {"n": F.count(F.lit(1))})
            return run_available(counted, lambda batch, number: batch.collect() and None, "late", f"{folder}/cp")

        query = run()
        total = listener.total(query)
        assert len(query.recentProgress) <= 2 and total == 10
        late = spark.createDataFrame([(start - timedelta(days=3),)], "rt TIMESTAMP")
        late.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        assert listener.total(run()) == 11 == listener.total()
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set(kept, before)


# --- clocks --------------------------------------------------------------------------
def test_a_clocked_run_ends_when_timers_have_fired(spark, folder):
    schema = "id STRING, v STRING, at INT"
    rows = spark.createDataFrame([("1", "a", 1), ("1", "b", 3), ("2", "c", 1), ("1", "d", 2)], schema)
    write_splits(rows, F.col("at") - 1, 3, f"{folder}/in")
    latest = firsts.latest_wins(read_splits(spark, f"{folder}/in", rows.schema), ["id"], "at", [], "15 seconds")
    found = played(latest, folder, run=run_clocked)
    assert sorted((r.id, r.v) for r in found.collect()) == [("1", "b"), ("2", "c")]


def test_a_clocked_run_reports_failures(spark, folder):
    spark.createDataFrame([("1",)], "id STRING").write.parquet(f"{folder}/in")
    rows = read_splits(spark, f"{folder}/in", spark.createDataFrame([], "id STRING").schema)
    with pytest.raises(Exception, match="no batch is wanted"):
        run_clocked(rows, lambda batch, number: 1 / 0 if batch is None else (_ for _ in ()).throw(ValueError("no batch is wanted")), "fails", f"{folder}/cp")


def test_splits(spark):
    rows = spark.range(10).select(split_of(F.col("id").cast("double"), [2.0, 5.0]).alias("part"), "id")
    assert [r.part for r in rows.orderBy("id").collect()] == [0, 0, 0, 1, 1, 1, 2, 2, 2, 2]


def test_a_stream_knows_its_load(spark, folder):
    spark.createDataFrame([("1",)], "id STRING").write.parquet(f"{folder}/in")
    schema = spark.createDataFrame([], "id STRING").schema
    seen = []

    def run(checkpoint):
        rows = spark.readStream.schema(schema).parquet(f"{folder}/in")
        query = start_batches(rows, lambda batch, number: seen.append(loads.stream_load(batch)), "q", checkpoint, availableNow=True)
        query.awaitTermination()
        return query.id

    first = run(f"{folder}/cp")
    spark.createDataFrame([("2",)], "id STRING").write.mode("append").parquet(f"{folder}/in")
    assert run(f"{folder}/cp") == first and run(f"{folder}/cp2") != first
    assert seen[:2] == [first, first] and len(set(seen)) == 2


def test_a_hot_key_sends_its_earliest_rows_to_the_processor(spark, folder):
    """Each task keeps one row of a key and day before the shuffle; what the rules give stays the same."""
    start = datetime(2024, 1, 10)
    rows = [("hot", start + timedelta(minutes=(n * 37) % 2880), n) for n in range(3000)] + [("cold", start, 1), ("cold", start, 2), (None, start, 3)]
    frame = spark.createDataFrame(rows, "mid STRING, at TIMESTAMP, n INT").repartition(4)
    packed = stateful._earliest(frame, F.col("mid"), "at", ["n"])
    counts = {(r._key, r._day): r["count"] for r in packed.groupBy("_key", "_day").count().collect()}
    assert counts.pop(("cold", "2024-01-10")) == 2 and counts.pop((None, "2024-01-10")) == 1
    assert set(counts) == {("hot", "2024-01-10"), ("hot", "2024-01-11")} and max(counts.values()) <= 4 * 2
    write_splits(frame, F.col("n") % 3, 3, f"{folder}/in")
    stream = read_splits(spark, f"{folder}/in", frame.schema)
    for job in (lambda r: firsts.daily_starts(r, ["mid"], "at"), lambda r: firsts.returning_users(r, "mid", "at", 1), lambda r: firsts.unique_users(r, "mid", "at", ["n"])):
        query = job(stream)
        plan = query._jdf.queryExecution().analyzed().toString()
        assert plan.index("TransformWithState") < plan.index("MapInArrow")
    found = played(firsts.first_of_day(stream, "mid", "at", ["n"]), f"{folder}/first", idle_batches=False)
    days = {(r.mid, r.at.day) for r in found.collect()}
    assert days == {("hot", 10), ("hot", 11), ("cold", 10)}

"""What keeps work and storage in proportion to the input."""

from __future__ import annotations

import pathlib
from uuid import uuid4

import pytest
from pyspark.sql import Row, functions as F

import warehouse_queries
from tidemark import topics as t
from tidemark.operators import firsts, logsplit, patterns, routing
from tidemark.plans import dim as plans_dim, trade, traffic
from tidemark.session import prepare
from tidemark.sinks import dimensions, loads, split, topics as out
from tidemark.sources import replay, sample, topics as src
from tidemark.streaming import stateful
from tidemark.streaming.runner import run_available
from tidemark.topics import Topic


def test_topics_in_folders_are_compressed_and_read_whole(spark, folder):
    topic = Topic(t.CHANGES, root=folder)
    lines = spark.range(3000).select(F.format_string('{"table":"a","type":"insert","ts":"1","data":{"id":"%d"}}', "id").alias("value"))
    out.write_topic(lines, topic)
    files = [file for file in pathlib.Path(topic.path).rglob("part-*")]
    assert files and all(file.suffix == ".gz" for file in files)
    assert src.read_topic(spark, topic).exceptAll(src.read_topic(spark, topic).limit(0)).count() == 3000
    assert sum(file.stat().st_size for file in files) < 3000 * 20


def test_split_stores_are_written_without_a_sort(spark, folder):
    store = split.split_store(prepare(spark), folder, "n BIGINT, kind STRING", "kind")
    rows = spark.range(100).select(F.col("id").alias("n"), F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"))
    loads.add(store, rows, "one")
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "32"
    assert split.read_split(store, "k1").agg(F.count("n"), F.sum("n")).first()[:] == (33, sum(range(1, 100, 3)))


def test_splits_of_many_files_are_one_batch_each(spark, folder, monkeypatch):
    monkeypatch.setattr(replay, "FILE_BYTES", 60_000)
    rows = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    # splits of very different sizes, one without rows, and rows without a split
    number = F.when(F.col("id") < 5, 0).when(F.col("id") < 5000, 1).when(F.col("id") < 5900, 3)
    files = replay.write_splits(rows, number, 4, f"{folder}/in")
    assert files > 2
    replay.write_splits(rows.filter("id = 5950"), F.lit(0), 1, f"{folder}/in", files)
    assert len(list(pathlib.Path(f"{folder}/in").glob("part-*.parquet"))) == 5 * files
    stream = replay.read_splits(spark, f"{folder}/in", rows.schema, files)
    replay.played(stream, folder)
    batches = spark.read.parquet(f"{folder}/out").groupBy("_batch").agg(F.count("id"), F.min("id"), F.max("id")).collect()
    assert sorted(tuple(row) for row in batches) == [(0, 5, 0, 4), (1, 4995, 5, 4999), (3, 900, 5000, 5899), (4, 1, 5950, 5950)]
    assert [path for path in pathlib.Path(folder).iterdir() if path.name.startswith("in-")] == []


def test_splits_are_not_shuffled(spark, folder, monkeypatch):
    monkeypatch.setattr(replay, "FILE_BYTES", 60_000)
    rows = spark.range(6000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"))
    monkeypatch.setattr(type(rows), "repartition", lambda *_: pytest.fail("shuffled"))
    reads = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert replay.write_splits(rows, (F.col("id") % 2).cast("int"), 2, f"{folder}/in") > 1
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == reads
    assert spark.read.parquet(f"{folder}/in").exceptAll(rows).count() == 0
    assert spark.read.parquet(f"{folder}/in").count() == 6000


def test_rows_are_shuffled_before_they_are_text(spark, folder):
    rows = spark.range(100).select(F.concat(F.lit("k"), F.col("id") % 50).alias("key"), F.col("id").alias("at"), F.lit("x").alias("text"))
    replay.write_splits(rows, F.lit(0), 1, f"{folder}/in")
    found = firsts.first_wins(replay.read_splits(spark, f"{folder}/in", rows.schema), ["key"], ["at"], "1 hour")
    given = []
    query = run_available(found, lambda batch, number: given.extend(batch.collect()), "t", f"{folder}/cp", idle_batches=False)
    assert sorted(row.at for row in given) == list(range(50))
    plan = query._jsq.explainInternal(False)
    assert plan.count("Exchange") == 1
    # of all that is packed only the key is a text already, for its bucket
    above, below = plan.split("Exchange")
    assert "timestampFormat" in above[above.index("Sort [_key") :] and "timestampFormat" not in below


def test_rows_of_splits_are_computed_once(spark, folder):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(100).mapInArrow(counted, "id long")
    assert replay.write_splits(rows, (F.col("id") % 5).cast("int"), 5, f"{folder}/in") == 1
    assert seen.value == 100
    assert spark.read.parquet(f"{folder}/in").count() == 100


def test_keys_of_a_bucket_share_a_state(spark, folder, monkeypatch):
    monkeypatch.setattr(stateful, "BUCKETS", 4)
    # two rows of each key in each of two batches, a null key too, and keys that are new in the second one
    ids = F.when(F.col("id") % 50 > 0, F.concat(F.lit('k"ü'), (F.col("id") % 50 + 20 * F.col("batch")).cast("string")))
    rows = spark.range(100).crossJoin(spark.range(2).select(F.col("id").alias("batch")))
    rows = rows.select(ids.alias("key"), (-F.col("id")).alias("at"), "batch")
    replay.write_splits(rows, F.col("batch"), 2, f"{folder}/in")
    stream = replay.read_splits(spark, f"{folder}/in", rows.schema)
    found = firsts.first_wins(stream, ["key"], ["at"], "1 hour")
    given = []
    query = run_available(found, lambda batch, number: given.extend(map(tuple, batch.collect())), "b", f"{folder}/cp", idle_batches=False)
    first = {(row.key): row.at for row in rows.filter("batch = 0").groupBy("key").agg(F.min("at").alias("at")).collect()}
    later = rows.filter("batch = 1").groupBy("key").agg(F.min("at").alias("at")).collect()
    expected = [(key, at, 0) for key, at in first.items()] + [(row.key, row.at, 1) for row in later if row.key not in first]
    assert sorted(given, key=repr) == sorted(expected, key=repr)
    # 70 keys
    assert query.lastProgress.stateOperators[0].numRowsTotal <= 3 * 4


def test_patterns_keep_one_state_and_one_timer_for_a_bucket_of_keys(spark, folder, monkeypatch):
    monkeypatch.setattr(stateful, "BUCKETS", 4)
    # 50 keys with several events a second, also of one time, in batches that overlap by less than the delay, a null key too
    number = F.col("id")
    rows = spark.range(600).select(
        F.when(number % 51 > 0, F.concat(F.lit('k"ü'), (number % 51).cast("string"))).alias("key"),
        F.timestamp_millis(F.lit(1_700_000_000_000) + number * 50 - F.pmod(F.hash("id"), F.lit(900))).cast("timestamp").alias("at"),
        number.alias("seq"),
        (F.pmod(F.xxhash64("id"), F.lit(3)) > 0).alias("entry"),
    )
    ends = spark.range(2).select(F.lit("end").alias("key"), F.timestamp_seconds(F.lit(1_700_001_000) + F.col("id") * 1000).alias("at"), F.lit(-1).cast("bigint").alias("seq"), F.lit(False).alias("entry"))
    split = F.floor(F.when(F.col("seq") >= 0, F.col("seq") / 150).otherwise(F.unix_seconds("at") / 1000 - 1_700_001 + 4))
    files = replay.write_splits(rows.unionByName(ends), split, 6, f"{folder}/in")

    def found(events):
        return patterns.followed_by_within(events, "key", "at", ["seq"], "entry", "entry", "3 seconds")

    progress = []

    def run(stream, put, name, checkpoint, idle_batches):
        progress.extend(run_available(stream, put, name, checkpoint, idle_batches).recentProgress)

    stream = replay.read_splits(spark, f"{folder}/in", rows.schema, files).withWatermark("at", "2 seconds")
    given = replay.played(found(stream), folder, run=lambda *parts, **named: run(*parts, idle_batches=True))
    expected = sorted(map(tuple, found(rows).collect()))
    assert sorted(map(tuple, given.collect())) == expected and 100 < len(expected) < 400
    # a state, and a timer under its key and under its time; 51 keys of which most hold rows
    assert max(p.stateOperators[0].numRowsTotal for p in progress if p.stateOperators) <= 3 * 5
    assert progress[-1].stateOperators[0].numRowsTotal <= 3


def test_streams_that_are_asked_for_are_the_same_rows(spark):
    lines = spark.createDataFrame(
        [('{"common":{"mid":"1","is_new":"1"},"page":{"page_id":"p"},"displays":[{"item":"1"},3],"actions":[{"ts":7}],"err":{"c":1},"ts":1}', 1),
         ('{"common":{"mid":"1","is_new":"1"},"start":{"entry":"x"},"ts":99999999999}', 2), ("no json", 3), ('{"ts":5}', 4)],
        "value STRING, seq BIGINT",
    )
    whole = sorted(map(tuple, traffic.base_log(lines).collect()))
    assert {tag for tag, _ in whole} == set(logsplit.TAGS)
    for tag in logsplit.TAGS:
        assert sorted(map(tuple, traffic.base_log(lines, tags=[tag]).collect())) == [row for row in whole if row[0] == tag]
    plan = traffic.base_log(lines, tags=["page"])._jdf.queryExecution().optimizedPlan().toString()
    assert "displays" in plan and "action_id" not in plan and "transform(" not in plan


def test_large_inputs_start_with_more_partitions(spark, sf, monkeypatch):
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    monkeypatch.setattr(sample, "PARTITION_BYTES", 1000)
    try:
        rows = sample.table(spark, sf, "lineitem")
        assert int(spark.conf.get(name)) > 100
        assert rows.groupBy("l_orderkey").count().agg(F.sum("count")).first()[0] == rows.count()
    finally:
        spark.conf.unset(name)


# --- dimensions -------------------------------------------------------------------
def test_changes_of_one_table_are_not_gathered_to_meet_their_route(spark):
    versions = spark.createDataFrame([("a", 0, False, True, "dim_a", " id, x ", "id", "")], plans_dim.VERSIONS)
    rows = spark.createDataFrame([("a", "1", {"id": "1", "x": "p", "y": "q"}), ("b", "1", {"id": "2"})], "table STRING, ts STRING, data MAP<STRING, STRING>")
    routed = routing.as_of(rows, versions)
    plan = routed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert [r.data for r in routing.pruned(routed).collect()] == [{"id": "1", "x": "p"}]


def test_a_pruned_payload_is_made_once(spark):
    route = Row(source_table="a", sink_table="dim_a", sink_columns="id,x,y", sink_pk="id", sink_extend="")
    rows = spark.createDataFrame([("a", "1", {"id": "1", "x": "p"}), ("a", "2", {"id": "1", "y": "q", "z": "r"})], "table STRING, ts STRING, data MAP<STRING, STRING>")
    found = dimensions.merged(routing.route_dimensions(rows, spark.createDataFrame([route])), route)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("map_filter(") == 1
    assert [tuple(r) for r in found.collect()] == [("1", "p", "q")]


def test_a_batch_for_one_table_is_not_kept(spark, folder, monkeypatch):
    route = Row(source_table="a", sink_table=f"dim_{uuid4().hex}", sink_columns="id,x", sink_pk="id", sink_extend="")
    rows = spark.createDataFrame([("1", {"id": "1", "x": "p"}, route.sink_table)], "ts STRING, data MAP<STRING, STRING>, sink_table STRING")
    monkeypatch.setattr(type(rows), "persist", lambda *_: pytest.fail("kept for a single pass"))
    dimensions.upsert_dim(rows, [route], "kept", folder)
    assert [tuple(r) for r in dimensions.read_dim(spark, route, "kept").collect()] == [("1", "p")]


def test_what_records_of_a_log_line_share_is_written_once(spark):
    line = (
        '{"common":{"mid":"a\\"b","is_new":"1"},"page":{"page_id":"p"},"displays":[{"item":"é","ts":1},{},3],'
        '"actions":[{"action_id":"x"}],"ts":5,"other":[1,{}]}'
    )
    rows = spark.createDataFrame([(line,), ('{"displays":[{}]}',)], "value string")
    made = logsplit.tagged(rows.select("value", F.struct(F.lit("0").alias("is_new")).alias("common")))
    common = '"common":{"is_new":"0","mid":"a\\"b"}'
    tail = f'{common},"page_id":"p","ts":5}}'
    assert sorted((row.tag, row.value) for row in made.collect()) == sorted([
        ("display", "{}"), ("page", "{}"),
        ("display", '{"item":"é",' + tail), ("display", "{" + tail), ("display", "{" + tail),
        ("action", '{"action_id":"x",' + common + ',"page_id":"p"}'),
        ("page", '{"other":[1,{}],"page":{"page_id":"p"},"ts":5,' + common + "}"),
    ])
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    # rows are generated by the parse and by the split only; all between is projected
    assert plan.count("Generate ") == 2
    assert "_texts" in plan and "_shared" in plan


def test_small_sides_are_hashed_for_their_joins(spark, sf):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "-1")
    try:
        rows = warehouse_queries.QUERIES["dwd_order_pre_process"](spark, sf)
        assert rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    final = plan[: plan.index("Initial Plan")]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final


def _order_changes(spark):
    """Changes of lines that repeat, have no id, no order or several orders, of orders that change or repeat, and extras of each."""

    def of(table, kind, ts, old=None, **data):
        return table, kind, str(ts), data, old

    rows = [
        of("order_detail", "insert", 1, id=line, order_id=order, sku_id=sku, source_type="2401", create_time="t")
        for line, order, sku in [
            ("1", "a", "x"), ("1", "a", "y"), ("1", "b", "x"), ("2", "a", "x"), ("2", "a", "x"), (None, "a", "x"),
            (None, "c", "y"), ("3", None, "x"), ("4", "none", "x"), ("", "b", "x"), ("5", "b", "x"), ("6", "", "x"),
        ]
    ]
    for order in ("a", "b", "c", None, "", "other"):
        rows.append(of("order_info", "insert", 2, id=order, order_status="1001", user_id="u"))
        rows.append(of("order_info", "update", 3, {"order_status": "1001"}, id=order, order_status="1002", user_id="u"))
    rows.append(rows[-12])
    for line in ("1", "1", "2", None, "", "9"):
        rows.append(of("order_detail_activity", "insert", 1, id="7", order_detail_id=line, activity_id="p"))
        rows.append(of("order_detail_coupon", "insert", 1, id="8", order_detail_id=line, coupon_id="q"))
    made = spark.createDataFrame(rows, "table STRING, type STRING, ts STRING, data MAP<STRING, STRING>, old MAP<STRING, STRING>")
    return made.withColumns({"database": F.lit("shop"), "pt": F.current_timestamp()})


def test_changes_brought_to_their_lines_are_the_same_rows(spark):
    changes, clock = _order_changes(spark), F.timestamp_seconds(F.col("order_ts").cast("bigint"))
    usual, by_line = (
        trade.order_pre_process(changes, sample.dictionary(spark), clock=clock, by_line=way).withColumn("old", F.to_json("old"))
        for way in (False, True)
    )
    assert usual.columns == by_line.columns
    rows = sorted(map(str, usual.collect()))
    assert sorted(map(str, by_line.collect())) == rows
    lines = [row.id for row in usual.collect()]
    assert lines.count(None) == 4 + 1 and lines.count("2") == 2 * 3 and "" in lines and "3" not in lines


def test_latest_rows_of_lines_are_taken_where_their_join_left_them(spark, sf):
    limit = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "4KB")
    try:
        rows = warehouse_queries.QUERIES["dwd_order_pre_process_latest"](spark, sf)
        assert rows.collect()
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(limit, before)
    final = plan[: plan.index("Initial Plan")]
    above = final[final.index("Window [") : final.index("Join [id")]
    assert "Exchange" not in above and "ShuffleQueryStage" not in above

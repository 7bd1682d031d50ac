"""Streams played file by file give what the bounded form gives.

Two last files hold only sentinel rows of a later time; they move the
watermark past everything else, so that no result is held back.
"""

from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.streams import as_stream, play, write_parts
from tidemark.operators import firsts
from tidemark.operators.joins import ttl_join
from tidemark.plans import trade, traffic, user
from tidemark.sources import sample
from tidemark.streaming.runner import late_rows, run_available, start_batches

SENTINEL = "sentinel"


@pytest.fixture(scope="module")
def paged(spark, sf):
    import tempfile

    pages = sample.page_log(spark, sf)
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    path = write_parts(pages, "ts", 3, folder)
    last = pages.agg(F.max("ts")).collect()[0][0]
    for days in (3, 6):
        late = pages.limit(1).withColumns(
            {
                "common": F.col("common").withField("mid", F.lit(SENTINEL)).withField("uid", F.lit(SENTINEL)),
                "page": F.col("page")
                .withField("last_page_id", F.lit(None).cast("string"))
                .withField("page_id", F.lit("home")),
                "ts": F.lit(last + days * 86_400_000),
                "seq": F.lit(-days).cast("bigint"),
            }
        )
        search = F.col("page").withField("last_page_id", F.lit("search")).withField("item_type", F.lit("keyword"))
        late = late.unionByName(late.withColumn("page", search.withField("item", F.lit(SENTINEL))))
        time.sleep(0.02)  # files are read in the order of their times
        late.coalesce(1).write.mode("append").parquet(path)
    return pages, path, last


def same(spark, paged, job, folder, idle_batches=True):
    pages, path, last = paged
    found = play(job(as_stream(spark, path, pages.schema)), folder, idle_batches=idle_batches)
    if "common" in found.columns:
        found = found.filter(F.col("common.mid") != SENTINEL)
    elif "stt" in found.columns:
        found = found.filter(F.col("stt") <= F.date_format(F.timestamp_millis(F.lit(last)), "yyyy-MM-dd HH:mm:ss"))
    expected = job(pages)
    assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
    assert expected.count() > 0


def test_unique_visitor(spark, paged, folder):
    same(spark, paged, traffic.unique_visitor, folder, idle_batches=False)


def test_user_jump(spark, paged, folder):
    same(spark, paged, lambda rows: traffic.user_jump(rows, "1 hour"), folder)


def test_repair_is_new(spark, paged, folder):
    same(spark, paged, lambda rows: firsts.repair_is_new(rows, ["seq"]), folder)


def test_login_window(spark, paged, folder):
    same(spark, paged, user.login_window, folder)


def test_page_view_window(spark, paged, folder):
    same(spark, paged, traffic.page_view_window, folder, idle_batches=False)


def test_keyword_window(spark, paged, folder):
    same(spark, paged, traffic.keyword_window, folder)


def test_traffic_window_of_three_streams(spark, paged, folder):
    """The jobs before write their streams; this one reads them, as when every job runs on its own."""
    pages, path, last = paged
    stream = as_stream(spark, path, pages.schema)
    visitors = play(traffic.unique_visitor(stream), folder, "uv", idle_batches=False)
    jumps = play(traffic.user_jump(as_stream(spark, path, pages.schema), "1 hour"), folder, "uj")
    inputs = []
    for name, rows in (("uv2", visitors), ("uj2", jumps)):
        rows.coalesce(1).write.parquet(f"{folder}/{name}")
        inputs.append(as_stream(spark, f"{folder}/{name}", pages.schema))
    job = traffic.traffic_window(*inputs, spark.readStream.schema(pages.schema).parquet(path))
    found = play(job, folder, "out")
    bound = F.date_format(F.timestamp_millis(F.lit(last)), "yyyy-MM-dd HH:mm:ss")
    expected = traffic.traffic_window(traffic.unique_visitor(pages), traffic.user_jump(pages, "1 hour"), pages)
    assert sorted(map(str, found.filter(F.col("stt") <= bound).collect())) == sorted(map(str, expected.collect()))


# --- trade -------------------------------------------------------------------
ORDER_LINES = (
    "id STRING, user_id STRING, create_time STRING, sku_num STRING, order_price STRING, "
    "split_activity_amount STRING, split_coupon_amount STRING, row_op_ts TIMESTAMP"
)


def parts(spark, folder, schema, *files):
    path = f"{folder}/in"
    for rows in files:
        spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    return as_stream(spark, path, spark.createDataFrame([], schema).schema)


def test_order_window(spark, folder):
    at = datetime(2024, 1, 10)
    first = [
        ("1", "u", "2024-01-10 12:00:00", "2", "10.50", "1.25", None, at),
        ("2", "u", "2024-01-10 12:00:01", "1", "5.00", None, "0.10", at),
        ("4", "w", "2024-01-10 12:00:02", "1", "3.00", None, None, at),
    ]
    again = [("1", "u", "2024-01-10 12:00:00", "9", "99.00", "9.00", "9.0", at + timedelta(seconds=1))]
    next_day = [("3", "u", "2024-01-11 12:00:00", "1", "1.00", None, None, at)]
    ends = [[(f"s{n}", "s", f"2024-02-0{n} 00:00:00", "1", "1", None, None, at)] for n in (1, 2)]
    stream = parts(spark, folder, ORDER_LINES, [*first, *again], next_day, *ends)
    found = play(trade.order_window(stream), folder, idle_batches=False)
    rows = found.filter("stt < '2024-02-01'").orderBy("stt").collect()
    assert [tuple(r)[2:] for r in rows] == [(2, 2, 1.25, 0.1, 29.0), (1, 0, 0.0, 0.0, 1.0)]


def test_cart_add_window(spark, folder):
    schema = "user_id STRING, create_time STRING, operate_time STRING"
    stream = parts(
        spark, folder, schema,
        [("u", "2024-01-10 00:00:00", "2024-01-10 12:00:03"), ("u", "2024-01-10 12:00:01", None)],
        [("u", "2024-01-10 13:00:00", None), ("w", "2024-01-10 13:00:00", None)],
        [("s", "2024-02-01 00:00:00", None)], [("s", "2024-02-02 00:00:00", None)],
    )
    found = play(trade.cart_add_window(stream), folder, idle_batches=False).filter("stt < '2024-02-01'")
    assert sorted((r.stt, r.cartAddUuCt) for r in found.collect()) == [
        ("2024-01-10 12:00:00", 1), ("2024-01-10 13:00:00", 1),
    ]


def test_late_rows_are_dropped(spark, folder):
    schema = "create_time STRING"
    # a batch drops what the watermark known before the batch ahead of it has passed
    times = ["12:00:05", "12:01:00", "12:02:00", "12:00:06"]
    stream = parts(spark, folder, schema, *[[(f"2024-01-10 {at}",)] for at in times])
    windows = user.register_window(stream)

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/part={number}")

    query = run_available(windows, put, "late", f"{folder}/cp")
    found = spark.read.schema(windows.schema).parquet(f"{folder}/out").collect()
    assert sorted((r.stt[11:], r.registerCt) for r in found) == [("12:00:00", 1), ("12:01:00", 1)]
    assert late_rows(query) == 1


def test_latest_wins_after_its_wait(spark, folder):
    """The held row comes out once, by a timer of processing time."""
    schema = "order_detail_id STRING, user_id STRING, row_op_ts TIMESTAMP, callback_time STRING"
    at = datetime(2024, 1, 10)
    stream = parts(
        spark, folder, schema,
        [("d", "u", at, "1"), ("d", "u", at + timedelta(seconds=2), "3"), ("e", "u", at, "x")],
        [("d", "u", at + timedelta(seconds=1), "2")],
    )
    held = firsts.latest_wins(stream, ["order_detail_id"], "row_op_ts", ["callback_time"], wait="3 seconds")

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/part={number}")

    query = start_batches(held, put, "latest", f"{folder}/cp", processingTime="1 second")
    try:
        rows, limit = [], time.time() + 90
        while len(rows) < 2 and time.time() < limit:
            time.sleep(2)
            if query.lastProgress is not None:
                rows = spark.read.schema(held.schema).parquet(f"{folder}/out").collect()
    finally:
        query.stop()
    assert sorted(r.callback_time for r in rows) == ["3", "x"]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_time_bounded_join(spark, folder, how):
    base = datetime(2024, 1, 10)

    def side(name, rows):
        return parts(spark, f"{folder}/{name}", f"id STRING, {name} INT, pt TIMESTAMP", *rows)

    def row(key, n, seconds):
        return (key, n, base + timedelta(seconds=seconds))

    left = [[row("a", 1, 0), row("b", 2, 0), row("c", 3, 0)], [row("a", 4, 30)]]
    right = [[row("a", 1, 5), row("d", 2, 0)], [row("b", 3, 30), row("a", 4, 28)]]
    ends = [[row("z", 8, 3600)], [row("z", 9, 7200)], [row("z", 10, 10800)]]
    one, two = side("n", left + ends), side("m", right + ends)
    found = play(ttl_join(one, two, [("id", "id")], how, "10 seconds"), folder)
    bounded = ttl_join(
        spark.createDataFrame(sum(left, []), "id STRING, n INT, pt TIMESTAMP"),
        spark.createDataFrame(sum(right, []), "id STRING, m INT, pt TIMESTAMP"),
        [("id", "id")], how, "10 seconds",
    )
    rows = sorted(str((r.id, r.n, r.m)) for r in found.filter("id <> 'z'").collect())
    assert rows == sorted(str((r.id, r.n, r.m)) for r in bounded.collect())
    assert len(rows) == {"inner": 2, "left": 4, "right": 4, "full": 6}[how]


def test_order_lines_meet_their_order_in_a_later_batch(spark, folder):
    """Five inputs: detail, order, activity, coupon, dictionary; unmatched extras come out as NULL."""
    schema = "database STRING, `table` STRING, type STRING, ts STRING, data MAP<STRING,STRING>, old MAP<STRING,STRING>, pt TIMESTAMP"
    base = datetime(2024, 1, 10)

    def change(seconds, table, kind="insert", old=None, **data):
        return ("shop", table, kind, "1", data, old, base + timedelta(seconds=seconds))

    def everything(seconds, key):
        return [
            change(seconds, "order_detail", id=key, order_id=key, source_type="2401"),
            change(seconds, "order_info", id=key, user_id="s"),
            change(seconds, "order_detail_activity", id=key, order_detail_id=key),
            change(seconds, "order_detail_coupon", id=key, order_detail_id=key),
        ]

    stream = parts(
        spark, folder, schema,
        [
            change(0, "order_detail", id="1", order_id="o", source_type="2401", sku_num="2"),
            change(0, "order_detail", id="2", order_id="o", source_type="2404"),
            change(0, "order_detail_activity", id="a", order_detail_id="1", activity_id="7"),
        ],
        [
            change(5, "order_info", id="o", user_id="u", order_status="1001"),
            change(6, "order_info", "update", {"order_status": "1001"}, id="o", user_id="u", order_status="1003"),
        ],
        everything(3600, "s1"), everything(7200, "s2"), everything(10800, "s3"),
    )
    job = trade.order_pre_process(stream, sample.dictionary(spark)).drop("row_op_ts")
    found = play(job, folder).filter("user_id = 'u'").orderBy("type").collect()
    assert [(r.id, r.type, r.order_status, r.activity_id, r.coupon_id) for r in found] == [
        ("1", "insert", "1001", "7", None),
        ("1", "update", "1003", "7", None),
    ]


@pytest.mark.parametrize("first_marked", ["1", "0"])
def test_repair_of_a_new_device_with_days_out_of_order(spark, folder, first_marked):
    from tests.test_rules import DAY, NOON, PAGE, page

    rows = [
        page(5, NOON + 2 * DAY, is_new="1"), page(3, NOON + DAY, is_new="1"), page(4, NOON + DAY + 1, is_new="1"),
        page(1, NOON, is_new=first_marked), page(2, NOON + 1, is_new="1"), page(6, NOON, mid=None, is_new="1"),
    ]
    later = [page(7, NOON + 2, is_new="1"), page(8, NOON + 3 * DAY, is_new="1")]
    stream = parts(spark, folder, PAGE, rows, later)
    found = play(firsts.repair_is_new(stream, ["seq"]), folder).select("seq", "common.is_new").collect()
    stays = {1, 2, 6, 7} if first_marked == "1" else {6}
    assert {r.seq for r in found if r.is_new == "1"} == stays and len(found) == 8


@pytest.mark.parametrize(
    "job, idle",
    [
        (traffic.unique_visitor, False),
        (traffic.user_jump, True),
        (lambda rows: firsts.repair_is_new(rows, ["seq"]), True),
        (lambda rows: firsts.returning_users(rows.selectExpr("common.mid AS mid", "timestamp_millis(ts) AS at"), "mid", "at"), True),
    ],
)
def test_rows_without_a_time_do_not_stop_a_stream(spark, folder, job, idle):
    from tests.test_rules import DAY, NOON, PAGE, page

    rows = [page(1, None, is_new="1"), page(2, NOON, is_new="1"), page(3, None, mid=None)]
    later = [page(4, None), page(5, NOON + 5 * DAY, is_new="1")]
    last = [page(6, NOON + 10 * DAY)]
    stream = parts(spark, folder, PAGE, rows, later, last)
    found = play(job(stream), folder, idle_batches=idle).collect()
    expected = job(spark.createDataFrame(rows + later + last, PAGE)).collect()
    held = {5, 6} if job is traffic.user_jump else set()  # the last start events wait for the watermark
    assert sorted(map(str, found)) == sorted(str(r) for r in expected if getattr(r, "seq", None) not in held)

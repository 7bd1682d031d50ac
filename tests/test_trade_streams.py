"""Joins of several streams in the trade jobs, and look-ups that change while a stream runs."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest

from tests.streams import play
from tests.test_streams import parts
from tidemark.plans import interaction, trade
from tidemark.sources import sample
from tidemark.sources.lookup import Lookup
from tidemark.streaming.runner import start_job

CHANGES = (
    "database STRING, `table` STRING, type STRING, ts STRING, data MAP<STRING,STRING>, old MAP<STRING,STRING>, "
    "pt TIMESTAMP"
)
BASE = datetime(2024, 1, 10)


def change(seconds, table, kind="insert", old=None, **data):
    return ("shop", table, kind, str(1700000000 + seconds), data, old, BASE + timedelta(seconds=seconds))


def refund(seconds, key, payment="1101"):
    return [
        change(seconds, "order_refund_info", id=key, order_id=key, sku_id="s", refund_type="1501",
               refund_reason_type="1300", create_time="2024-01-10 01:02:03", refund_num="2"),
        change(seconds, "refund_payment", id=key, order_id=key, sku_id="s", payment_type=payment, total_amount="9.50",
               callback_time="2024-01-11 01:02:03"),
    ]


def status(seconds, key, code):
    return change(seconds, "order_info", "update", {"order_status": "1001"}, id=key, user_id="u", province_id="p", order_status=code)


@pytest.mark.parametrize("job", [trade.order_refund, trade.refund_pay])
def test_refunds_meet_their_order_within_the_wait(spark, folder, job):
    """Orders come four seconds later (in time) or an hour later (too late, and the only difference to bounded input)."""
    rows = [
        [*refund(0, "1"), *refund(0, "2"), *refund(0, "3", payment="1105")],
        [status(4, key, code) for key in ("1", "3") for code in ("1005", "1006")],
        [status(3600, "2", "1005"), status(3600, "2", "1006"), *refund(3600, "z")],
    ]
    dictionary = sample.dictionary(spark)
    stream = parts(spark, folder, CHANGES, *rows)
    found = play(job(stream, dictionary).drop("row_op_ts"), folder)
    bounded = job(spark.createDataFrame(sum(rows, []), CHANGES), dictionary, ttl="5 seconds").drop("row_op_ts")
    assert sorted(map(str, found.collect())) == sorted(map(str, bounded.collect()))
    assert {row.id for row in found.collect()} == ({"1", "3"} if job is trade.order_refund else {"1"})


def test_payments_meet_their_order_lines(spark, folder):
    line = "id STRING, order_id STRING, user_id STRING, row_op_ts TIMESTAMP, pt TIMESTAMP"
    others = [name for name in trade.s.ORDER_DETAIL if name not in ("id", "order_id", "user_id")]
    schema = line + "".join(f", {name} STRING" for name in others)

    def placed(key, order, seconds):
        return (key, order, "u", BASE, BASE + timedelta(seconds=seconds), *[None] * len(others))

    def paid(seconds, order, kind="1101"):
        return change(seconds, "payment_info", "update", order_id=order, payment_status="1602", payment_type=kind,
                      callback_time="2024-01-10 05:00:00")

    details = parts(spark, f"{folder}/d", schema, [placed("1", "o", 0), placed("2", "o", 0)], [placed("3", "q", 5)])
    changes = parts(spark, f"{folder}/c", CHANGES, [paid(900, "o"), paid(901, "x")], [paid(5000, "q"), paid(902, "o", "1105")])
    found = play(trade.pay_order_detail(changes, details, sample.dictionary(spark)), folder).collect()
    assert sorted((r.order_detail_id, r.payment_type_name, r.user_id) for r in found) == [
        ("1", "alipay", "u"), ("2", "alipay", "u"),
    ]


def test_payment_window_on_a_stream_of_order_lines(spark, folder):
    """Waits for the held rows by a timer, so it runs on a clock and is stopped once the windows are there."""
    import time

    from tidemark.streaming.runner import start_batches

    schema = "order_detail_id STRING, user_id STRING, row_op_ts TIMESTAMP, callback_time STRING"
    stream = parts(
        spark, folder, schema,
        [("1", "u", BASE, "2024-01-10 05:00:00"), ("2", "u", BASE, "2024-01-10 05:00:01"), ("3", "w", BASE, "2024-01-10 05:00:02")],
        [("s", "s", BASE, "2024-02-01 00:00:00")],
    )
    windows = trade.payment_window(stream)

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/part={number}")

    query = start_batches(windows, put, "payments", f"{folder}/cp", processingTime="1 second")
    try:
        rows, limit = [], time.time() + 100
        while not rows and time.time() < limit:
            time.sleep(3)
            if query.lastProgress is not None:
                rows = spark.read.schema(windows.schema).parquet(f"{folder}/out").collect()
    finally:
        query.stop()
    assert [tuple(r)[:4] for r in rows] == [("2024-01-10 05:00:00", "2024-01-10 05:00:10", 2, 2)]


def test_a_changed_dictionary_is_seen_by_a_running_job(spark, folder):
    names = iter(["before", "after"])
    lookup = Lookup(lambda: spark.sql(f"SELECT '1201' AS dic_code, '{next(names)}' AS dic_name"), ttl=0.0)
    stream = parts(
        spark, folder, CHANGES,
        [change(0, "comment_info", id="1", appraise="1201", create_time="2024-01-10 01:02:03")],
        [change(1, "comment_info", id="2", appraise="1201", create_time="2024-01-10 01:02:03")],
    )

    def put(batch, number):
        batch.write.mode("overwrite").parquet(f"{folder}/out/part={number}")

    job = lambda batch: interaction.comment(batch, lookup)
    start_job(stream, job, put, "comment", f"{folder}/cp", availableNow=True).awaitTermination()
    found = spark.read.parquet(f"{folder}/out").collect()
    assert sorted((r.id, r.appraise_name) for r in found) == [("1", "before"), ("2", "after")]


def test_a_live_lookup_joins_a_stream(spark, folder):
    lookup = Lookup(lambda: sample.dictionary(spark))
    stream = parts(spark, folder, CHANGES, [change(0, "cart_info", id="1", sku_num="2", source_type="2401")])
    found = play(trade.cart_add(stream, lookup), folder).collect()
    assert [(r.id, r.source_type_name) for r in found] == [("1", "promotion")]

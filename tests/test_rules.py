"""Hand-made rows for each rule, bounded form."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import schemas as s
from tidemark.functions import texts, times
from tidemark.functions.records import bad, decode, good
from tidemark.operators import changes as c, firsts, logsplit
from tidemark.operators.joins import lookup_join, ttl_join
from tidemark.operators.routing import latest_routes, route_dimensions
from tidemark.plans import trade, traffic, user
from tidemark.sources import sample
from tidemark.sources.cdc import read_debezium
from tidemark.sources.lookup import Lookup

PAGE = (
    "common STRUCT<ar: STRING, ch: STRING, is_new: STRING, mid: STRING, uid: STRING, vc: STRING>, "
    "page STRUCT<during_time: BIGINT, item: STRING, item_type: STRING, last_page_id: STRING, page_id: STRING>, "
    "ts BIGINT, seq BIGINT"
)
DAY = 86_400_000
NOON = int(datetime(2024, 1, 10, 12).timestamp() * 1000) // 1000 * 1000


def page(seq, ts, mid="m", last=None, page_id="home", is_new="0", uid=None, item=None, item_type=None):
    return (("a", "c", is_new, mid, uid, "v"), (10, item, item_type, last, page_id), ts, seq)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), PAGE)


def seqs(rows):
    return sorted(row.seq for row in rows.select("seq").collect())


def lines(spark, *values):
    return spark.createDataFrame([(v, n) for n, v in enumerate(values)], "value STRING, seq BIGINT")


def changes(spark, *rows):
    """(table, type, data, old) tuples; ts counts up."""
    built = [("shop", t, k, str(1700000000 + n), d, o) for n, (t, k, d, o) in enumerate(rows)]
    schema = "database STRING, table STRING, type STRING, ts STRING, data MAP<STRING,STRING>, old MAP<STRING,STRING>"
    return spark.createDataFrame(built, schema).withColumn("pt", F.current_timestamp())


# --- parsing -----------------------------------------------------------------
def test_unreadable_lines_are_kept_apart(spark):
    rows = lines(spark, '{"ts": 1}', "not json", '{"ts": ', "", None)
    records = traffic.parsed_log(rows)
    assert [r.ts for r in good(records).collect()] == [1]
    assert sorted(r.value for r in bad(records).collect()) == ["", "", "not json", '{"ts": ']


def test_unknown_fields_do_not_make_a_line_unreadable(spark):
    records = traffic.parsed_log(lines(spark, '{"ts": 1, "other": {"a": [1]}}'))
    assert good(records).count() == 1


def test_a_line_is_parsed_once(spark):
    plan = good(traffic.parsed_log(lines(spark, "{}")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_a_mistyped_value_costs_only_itself(spark):
    rows = lines(spark, '{"ts": 1, "page": {"during_time": 1.5, "page_id": "p"}}', "[1]", '"text"', "5")
    records = decode(rows, s.PAGE_LOG, keep=["seq"])
    assert [(r.ts, r.page.during_time, r.page.page_id) for r in good(records).collect()] == [(1, None, "p")]
    assert bad(records).count() == 3


def test_log_lines_without_a_time_are_dirty(spark):
    rows = lines(spark, '{"ts": "12"}', '{"ts": 13.0}', '{"ts": null}', '{"common": {}}', '{"ts": "soon"}')
    assert sorted(r.ts for r in good(traffic.parsed_log(rows)).collect()) == [12, 13]
    assert traffic.dirty_log(rows).count() == 3


# --- log split ---------------------------------------------------------------
def split(spark, record, **options):
    rows = good(traffic.parsed_log(lines(spark, json.dumps(record))))
    found = logsplit.tagged(rows, **options).collect()
    return sorted(((r.tag, json.loads(r.value)) for r in found), key=lambda pair: (pair[0], str(pair[1])))


def test_error_with_page_goes_to_both(spark):
    found = split(spark, {"common": {"mid": "m"}, "page": {"page_id": "p"}, "err": {"error_code": 7}, "ts": 5})
    assert [tag for tag, _ in found] == ["error", "page"]
    assert found[0][1]["err"] == {"error_code": 7} and "err" not in found[1][1]


def test_error_with_start_gives_no_page(spark):
    record = {"common": {"mid": "m"}, "start": {"entry": "icon"}, "err": {"error_code": 7}, "ts": 5,
              "displays": [{"item": "1"}], "actions": [{"action_id": "x", "ts": 6}]}
    found = split(spark, record)
    assert [tag for tag, _ in found] == ["error", "start"]
    assert "err" not in found[1][1] and found[0][1]["displays"] == [{"item": "1"}]


def test_displays_take_the_page_time_and_actions_keep_theirs(spark):
    record = {"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": 5,
              "displays": [{"item": "1"}, {"item": "2"}], "actions": [{"action_id": "x", "ts": 6}]}
    found = split(spark, record)
    assert [tag for tag, _ in found] == ["action", "display", "display", "page"]
    assert found[0][1] == {"action_id": "x", "ts": 6, "page_id": "p", "common": {"mid": "m"}}
    assert {v["ts"] for t, v in found if t == "display"} == {5}
    assert found[3][1] == {"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": 5}


def test_empty_lists_and_a_missing_page_still_give_a_page_record(spark):
    found = split(spark, {"common": {"mid": "m"}, "displays": [], "actions": None, "ts": 5})
    assert found == [("page", {"common": {"mid": "m"}, "ts": 5})]


def test_common_as_text(spark):
    record = {"common": {"mid": "m"}, "page": {"page_id": "p"}, "ts": 5, "displays": [{"item": "1"}]}
    found = split(spark, record, common_as_string=True)
    assert found[0][1]["common"] == '{"mid":"m"}'


def test_fields_of_any_name_and_type_go_along(spark):
    more = {"sid": 7, "deep": {"a": [1, {"b": None}]}}
    record = {"common": {"mid": "m", **more}, "page": {"page_id": 3, "during_time": 1.5, **more}, "ts": 5, "extra": more,
              "err": more, "displays": [{"item": 1, **more}, 8], "actions": [{"ts": 6, **more}]}
    found = dict(split(spark, record)[:1] + split(spark, record)[2:])
    rest = {"common": record["common"], "page": record["page"], "ts": 5, "extra": more}
    assert found["page"] == rest and found["error"] == record
    assert found["display"] == {"item": 1, **more, "common": record["common"], "page_id": 3, "ts": 5}
    assert found["action"] == {"ts": 6, **more, "common": record["common"], "page_id": 3}


def test_a_mark_that_is_taken_back_changes_nothing_else(spark):
    first = {"common": {"mid": "m", "is_new": "0", "x": 1}, "ts": 5}
    later = {"common": {"mid": "m", "is_new": "1", "x": 1}, "ts": 6, "more": [2]}
    found = traffic.base_log(lines(spark, json.dumps(first), json.dumps(later))).collect()
    assert [json.loads(r.value) for r in found if "more" in r.value] == [
        {"common": {"mid": "m", "is_new": "0", "x": 1}, "ts": 6, "more": [2]}
    ]


# --- new-visitor repair ------------------------------------------------------
def test_records_without_a_time_pass_and_settle_nothing(spark):
    rows = [page(1, None, is_new="1"), page(2, NOON, is_new="1"), page(3, NOON + DAY, is_new="1")]
    assert repaired(spark, *rows) == {1: "1", 2: "1", 3: "0"}


def repaired(spark, *rows):
    found = firsts.repair_is_new(pages(spark, *rows), ["seq"])
    return {r.seq: r.is_new for r in found.select("seq", "common.is_new").collect()}


def test_mark_stays_on_the_first_day_only(spark):
    rows = [page(1, NOON, is_new="1"), page(2, NOON + 1, is_new="1"), page(3, NOON + DAY, is_new="1")]
    assert repaired(spark, *rows) == {1: "1", 2: "1", 3: "0"}


def test_a_device_first_seen_without_mark_is_never_new(spark):
    rows = [page(1, NOON, is_new="0"), page(2, NOON + 1, is_new="1"), page(3, NOON + DAY, is_new="1")]
    assert repaired(spark, *rows) == {1: "0", 2: "0", 3: "0"}


def test_equal_times_are_settled_by_the_tie(spark):
    assert repaired(spark, page(1, NOON, is_new="1"), page(2, NOON, is_new="0")) == {1: "1", 2: "0"}
    assert repaired(spark, page(2, NOON, is_new="1"), page(1, NOON, is_new="0")) == {1: "0", 2: "0"}


def test_missing_device_passes(spark):
    assert repaired(spark, page(1, NOON, mid=None, is_new="1"), page(2, NOON + DAY, mid=None, is_new="1")) == {1: "1", 2: "1"}


# --- visitors and users ------------------------------------------------------
def test_first_entry_page_per_device_and_day(spark):
    rows = [page(1, NOON, last="search"), page(3, NOON + 2), page(2, NOON + 2), page(4, NOON + DAY), page(5, NOON, "n")]
    assert seqs(traffic.unique_visitor(pages(spark, *rows))) == [2, 4, 5]


def test_home_and_detail_count_apart(spark):
    rows = [page(1, NOON), page(2, NOON + 1), page(3, NOON + 2, page_id="good_detail"), page(4, NOON, page_id="mine")]
    found = traffic.page_view_window(pages(spark, *rows)).collect()
    assert [(r.homeUvCt, r.goodDetailUvCt) for r in found] == [(1, 1)]


@pytest.mark.parametrize("gap, back", [(7, 0), (8, 1), (9, 1)])
def test_user_is_back_after_eight_days(spark, gap, back):
    rows = [page(1, NOON, uid="u"), page(2, NOON + 5, uid="u"), page(3, NOON + gap * DAY, uid="u", last="login")]
    rows += [page(4, NOON, uid="u", last="search"), page(5, NOON + DAY, uid=None)]
    found = user.login_window(pages(spark, *rows)).orderBy("stt").collect()
    assert [(r.backCt, r.uuCt) for r in found] == [(0, 1), (back, 1)]


def test_unique_and_new_buyers_and_amounts(spark):
    fields = "id STRING, user_id STRING, create_time STRING, sku_num STRING, order_price STRING, split_activity_amount STRING, split_coupon_amount STRING, row_op_ts STRING"
    rows = [
        ("1", "u", "2024-01-10 12:00:00", "2", "10.50", "1.25", None, "1"),
        ("1", "u", "2024-01-10 12:00:00", "9", "99.00", "9.00", "9.0", "2"),  # same line again: first wins
        ("2", "u", "2024-01-10 12:00:01", "1", "5.00", None, "0.10", "1"),
        ("3", "u", "2024-01-11 12:00:00", "1", "1.00", None, None, "1"),
        ("4", "w", "2024-01-10 12:00:02", "1", "3.00", None, None, "1"),
    ]
    found = trade.order_window(spark.createDataFrame(rows, fields)).orderBy("stt").collect()
    assert [tuple(r)[2:] for r in found] == [(2, 2, 1.25, 0.1, 29.0), (1, 0, 0.0, 0.0, 1.0)]
    assert found[0].stt == "2024-01-10 12:00:00" and found[0].edt == "2024-01-10 12:00:10"


def test_latest_payment_row_wins_and_ties_take_the_later(spark):
    rows = [("d", 1, 1, "a"), ("d", 3, 1, "b"), ("d", 3, 2, "c"), ("e", 1, 1, "x")]
    frame = spark.createDataFrame(rows, "id STRING, op BIGINT, arrival BIGINT, v STRING")
    assert sorted(r.v for r in firsts.latest_wins(frame, ["id"], "op", ["arrival"]).collect()) == ["c", "x"]


# --- jumps -------------------------------------------------------------------
def jumps(spark, *rows, within="10 seconds"):
    return seqs(traffic.user_jump(pages(spark, *rows), within))


def test_jump_gaps_under_at_and_over_the_limit(spark):
    for gap, expected in ((9_999, []), (10_000, [1]), (10_001, [1])):
        assert jumps(spark, page(1, NOON), page(2, NOON + gap, last="search")) == expected


def test_a_run_of_entries_gives_each_and_the_last_times_out(spark):
    assert jumps(spark, page(1, NOON), page(2, NOON + 1), page(3, NOON + 2)) == [1, 2, 3]


def test_only_the_directly_following_page_counts(spark):
    rows = [page(1, NOON), page(2, NOON + 1, last="search"), page(3, NOON + 2)]
    assert jumps(spark, *rows) == [3]


def test_equal_times_follow_the_tie(spark):
    assert jumps(spark, page(1, NOON), page(2, NOON, last="x")) == []
    assert jumps(spark, page(2, NOON), page(1, NOON, last="x")) == [2]


def test_slots_do_not_change_the_result(spark):
    """One key with nearly all rows, gaps around the limit and around slot borders: same as a walk."""
    import random

    random.seed(5)
    rows, at = [], NOON
    for seq in range(3000):
        at += random.choice([0, 1, 500, 4_999, 9_999, 10_000, 10_001, 79_000])
        rows.append(page(seq, at, "hot" if seq % 7 else f"m{seq % 3}", random.choice([None, None, "s"])))
    expected, per_key = [], {}
    for row in rows:
        per_key.setdefault(row[0][3], []).append(row)
    for events in per_key.values():
        for one, after in zip(events, [*events[1:], None]):
            if one[1][3] is None and not (after and after[2] - one[2] < 10_000 and after[1][3] is not None):
                expected.append(one[3])
    assert jumps(spark, *rows) == sorted(expected)


# --- change records ----------------------------------------------------------
def test_cart_adds(spark):
    rows = changes(
        spark,
        ("cart_info", "insert", {"id": "1", "sku_num": "2"}, None),
        ("cart_info", "update", {"id": "2", "sku_num": "5"}, {"sku_num": "3"}),
        ("cart_info", "update", {"id": "3", "sku_num": "3"}, {"sku_num": "5"}),
        ("cart_info", "update", {"id": "4", "sku_num": "3"}, {"is_checked": "1"}),
        ("cart_info", "update", {"id": "5", "sku_num": "x"}, {"sku_num": "1"}),
        ("cart_info", "delete", {"id": "6", "sku_num": "9"}, None),
    )
    assert {r.id: r.sku_num for r in c.cart_adds(rows).collect()} == {"1": "2", "2": "2"}


def test_database_filter_is_optional(spark):
    rows = changes(spark, ("cart_info", "insert", {"id": "1"}, None))
    assert c.cart_adds(rows, "other").count() == 0 and c.cart_adds(rows, "shop").count() == 1


def test_refund_payments_strict(spark):
    rows = changes(
        spark,
        ("refund_payment", "insert", {"id": "1"}, None),
        ("refund_payment", "update", {"id": "2", "refund_status": "0702"}, {"refund_status": "0701"}),
        ("refund_payment", "update", {"id": "3", "refund_status": "0702"}, {}),
    )
    assert c.refund_payments(rows).count() == 3
    assert [r.id for r in c.refund_payments(rows, strict=True).collect()] == ["2"]


def test_coupon_steps(spark):
    rows = changes(
        spark,
        ("coupon_use", "insert", {"id": "1", "get_time": "2024-01-10 01:02:03"}, None),
        ("coupon_use", "update", {"id": "2", "coupon_status": "1402", "using_time": "2024-01-11 01:02:03"}, {"coupon_status": "1401"}),
        ("coupon_use", "update", {"id": "3", "coupon_status": "1402"}, {"coupon_status": "1400"}),
        ("coupon_use", "update", {"id": "4", "used_time": "2024-01-12 01:02:03"}, {"coupon_status": "1402"}),
    )
    assert [(r.id, r.date_id) for r in c.coupons_received(rows).collect()] == [("1", "2024-01-10")]
    assert [(r.id, r.order_time) for r in c.coupons_used_in_order(rows).collect()] == [("2", "2024-01-11 01:02:03")]
    assert [(r.id, r.payment_time) for r in c.coupons_paid(rows).collect()] == [("4", "2024-01-12 01:02:03")]


def test_order_lines_without_extras_keep_their_nulls(spark):
    rows = changes(
        spark,
        ("order_detail", "insert", {"id": "1", "order_id": "o", "source_type": "2401"}, None),
        ("order_detail", "insert", {"id": "2", "order_id": "o", "source_type": "2404"}, None),
        ("order_info", "insert", {"id": "o", "user_id": "u", "order_status": "1001"}, None),
        ("order_info", "update", {"id": "o", "user_id": "u", "order_status": "1003", "operate_time": "t"}, {"order_status": "1001"}),
        ("order_detail_activity", "insert", {"id": "a", "order_detail_id": "1", "activity_id": "7"}, None),
    )
    pre = trade.order_pre_process(rows, sample.dictionary(spark))
    assert len(pre.columns) == 44
    assert [(r.id, r.type, r.activity_id, r.coupon_id) for r in pre.orderBy("type").collect()] == [
        ("1", "insert", "7", None),
        ("1", "update", "7", None),
    ]
    assert trade.order_detail(pre).count() == 1
    assert [r.cancel_time for r in trade.cancel_order_detail(pre).collect()] == ["t"]


# --- joins -------------------------------------------------------------------
def test_unknown_codes_are_dropped(spark):
    facts = spark.createDataFrame([("1", "2401"), ("2", "2404"), ("3", None)], "id STRING, code STRING")
    found = lookup_join(facts, sample.dictionary(spark), "code", "name").collect()
    assert [(r.id, r.name) for r in found] == [("1", "promotion")]


def test_lookup_is_read_again_when_old(spark):
    versions = iter(["old", "new"])
    lookup = Lookup(lambda: spark.sql(f"SELECT '1' AS dic_code, '{next(versions)}' AS dic_name"), ttl=0.0)
    facts = spark.createDataFrame([("1",)], "code STRING")
    names = [lookup_join(facts, lookup, "code", "name").collect()[0].name for _ in range(2)]
    assert names == ["old", "new"] and lookup.loads == 2


def test_only_small_lookups_are_broadcast(spark):
    def plan(limit):
        lookup = Lookup(lambda: spark.range(100).selectExpr("string(id) dic_code", "'x' dic_name"), 60, limit)
        facts = spark.range(10).selectExpr("string(id) AS code")
        return lookup_join(facts, lookup, "code", "name")._jdf.queryExecution().analyzed().toString()

    assert "broadcast" in plan(100).lower() and "broadcast" not in plan(99).lower()


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_time_bounded_join_equals_brute_force(spark, how):
    """One key holds most rows; unmatched rows, NULL keys and exact limits on both sides."""
    base = datetime(2024, 1, 10)
    left = [(k, n, base + timedelta(seconds=7 * n)) for n, k in enumerate(["hot"] * 60 + ["a", None, "b"])]
    right = [(k, n, base + timedelta(seconds=11 * n - 50)) for n, k in enumerate(["hot"] * 40 + ["b", None, "c"])]
    expected = []
    matched = set()
    for key, n, at in left:
        partners = [m for other, m, then in right if key == other and key and abs((at - then).total_seconds()) <= 20]
        matched.update(partners)
        expected += [(key, n, m) for m in partners]
        if not partners and how in ("left", "full"):
            expected.append((key, n, None))
    if how in ("right", "full"):
        expected += [(key, None, m) for key, m, _ in right if m not in matched]
    one = spark.createDataFrame(left, "id STRING, n INT, pt TIMESTAMP")
    two = spark.createDataFrame(right, "key STRING, m INT, pt TIMESTAMP")
    joined = ttl_join(one, two, [("id", "key")], how, ttl="20 seconds")
    assert sorted(joined.columns) == ["id", "m", "n", "pt"]
    found = [(r.id, r.n, r.m) for r in joined.collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)


# --- routing -----------------------------------------------------------------
def test_routes_follow_the_last_change(spark):
    def envelope(op, ts, before, after):
        return json.dumps({"before": before, "after": after, "op": op, "ts_ms": ts})

    one = {"source_table": "a", "sink_table": "dim_a", "sink_columns": "id,x", "sink_pk": "id"}
    two = {**one, "sink_table": "dim_a2"}
    gone = {"source_table": "b", "sink_table": "dim_b", "sink_columns": "id"}
    rows = lines(
        spark, envelope("r", 1, None, one), envelope("u", 2, one, two), envelope("c", 1, None, gone),
        envelope("d", 3, gone, None), "junk",
    )
    routes = latest_routes(read_debezium(rows))
    assert [(r.source_table, r.sink_table) for r in routes.collect()] == [("a", "dim_a2")]


def test_columns_are_pruned_and_unknown_tables_drop_or_wait(spark):
    rows = changes(spark, ("a", "insert", {"id": "1", "x": "2", "y": "3"}, None), ("z", "insert", {"id": "1"}, None))
    routes = spark.sql("SELECT 'a' source_table, 'dim_a' sink_table, 'id, x' sink_columns, 'id' sink_pk, '' sink_extend")
    assert [(r.sink_table, r.data) for r in route_dimensions(rows, routes).collect()] == [("dim_a", {"id": "1", "x": "2"})]
    kept = route_dimensions(rows, routes, "replay").orderBy("table").collect()
    assert [(r.sink_table, r.data) for r in kept] == [("dim_a", {"id": "1", "x": "2"}), (None, {"id": "1"})]


# --- functions ---------------------------------------------------------------
@pytest.mark.parametrize(
    "text, expected",
    [
        ("Redmi 10X 4G", ["redmi", "10x", "4g"]),
        ("小米盒子", ["小米", "米盒", "盒子"]),
        ("小米 box盒", ["小米", "box", "盒"]),
        ("été-À", ["été", "à"]),
        ("!!!", ["!!!"]),
        (None, None),
    ],
)
def test_keywords(spark, text, expected):
    frame = spark.createDataFrame([(text,)], "item STRING")
    assert frame.select(texts.tokenize("item").alias("k")).collect()[0].k == expected


def test_keywords_from_sql(spark):
    texts.register_keyword_function(spark)
    found = spark.sql("SELECT word FROM VALUES ('小米盒 TV'), (NULL) AS log(item), LATERAL keywords(item)").collect()
    assert [r.word for r in found] == ["小米", "米盒", "tv"]


def test_keywords_go_over_whole_texts(spark):
    long = " ".join(["word"] * 30_000)
    frame = spark.createDataFrame([(long,)], "item STRING")
    assert frame.select(F.size(texts.tokenize("item")).alias("n")).collect()[0].n == 30_000


@pytest.mark.parametrize(
    "left, right, sign",
    [("41", "410", 0), ("042", "041", 1), ("3", "302", -1), ("999", "999", 0)],
)
def test_operation_times(spark, left, right, sign):
    frame = spark.createDataFrame([(f"2022-04-01 10:20:47.{left}Z", f"2022-04-01 10:20:47.{right}Z")], "a STRING, b STRING")
    assert frame.select(times.compare_op_times("a", "b").alias("s")).collect()[0].s == sign


def test_time_functions(spark):
    frame = spark.createDataFrame([("2024-01-10 12:34:56", 1704890096789)], "t STRING, ms BIGINT")
    row = frame.select(
        times.first_token("t"), times.day_text("t"), times.to_millis("t"),
        times.time_text(times.from_millis("ms")), times.from_millis_in_seconds("ms").cast("string"),
    ).collect()[0]
    assert tuple(row) == ("2024-01-10", "2024-01-10", 1704890096000, "2024-01-10 12:34:56", "2024-01-10 12:34:56")

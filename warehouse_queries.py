"""Every job and operator on the sample tables, by name.

Wall-clock columns (``ts`` of summaries, ``row_op_ts``) are left out, because
no two runs agree on them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions import times
from tidemark.functions.texts import tokenize
from tidemark.operators import changes as c, firsts
from tidemark.operators.joins import ttl_join
from tidemark.plans import dim, interaction, tool, trade, traffic, user
from tidemark.session import prepare, shared_dir
from tidemark.sinks.dimensions import merged, routes_as_rows
from tidemark.sinks.topics import latest_per_key
from tidemark.sources import sample
from tidemark.streaming.runner import run_available

Query = Callable[[SparkSession, str], DataFrame]

# The sample events of one user are minutes apart, so their jumps need a longer limit.
JUMP_LIMIT = "1 hour"
# Rows of one order line arrive in this order.
LINE_ORDER = [
    "row_op_ts", "create_time", "sku_id", "sku_num", "order_price", "split_activity_amount", "split_coupon_amount",
]
LATEST_ORDER = [
    "row_op_ts", "order_status", "create_time", "sku_id", "sku_num", "order_price", "split_activity_amount",
    "split_coupon_amount",
]


def _flat_page(rows: DataFrame) -> DataFrame:
    common = [F.col(f"common.{name}").alias(name) for name in ("mid", "uid", "vc", "ch", "ar", "is_new")]
    page = [F.col(f"page.{name}").alias(name) for name in ("page_id", "last_page_id", "during_time")]
    return rows.select(F.col("seq").alias("id"), *common, *page, "ts")


# Input plans (not data) are made once per session: they are the same for all queries.
@lru_cache(maxsize=8)
def _pages(spark: SparkSession, sf: str) -> DataFrame:
    return sample.page_log(prepare(spark), sf)


@lru_cache(maxsize=8)
def _changes(spark: SparkSession, sf: str) -> DataFrame:
    return sample.changelog(prepare(spark), sf)


def _order_pre(spark: SparkSession, sf: str, **options) -> DataFrame:
    # the time of the order change stands in for the wall clock of the join
    clock = F.timestamp_seconds(F.col("order_ts").cast("bigint"))
    return trade.order_pre_process(_changes(spark, sf), sample.dictionary(spark), clock=clock, **options)


def _order_detail(spark: SparkSession, sf: str, **options) -> DataFrame:
    return trade.order_detail(_order_pre(spark, sf, **options))


def _pay_detail(spark: SparkSession, sf: str) -> DataFrame:
    return trade.pay_order_detail(_changes(spark, sf), _order_detail(spark, sf), sample.dictionary(spark))


def _shown(rows: DataFrame) -> DataFrame:
    """Maps as JSON text and no wall clock, so that rows can be compared."""
    rows = rows.drop("row_op_ts")
    return rows.withColumn("old", F.to_json("old")) if "old" in rows.columns else rows


# --- traffic -----------------------------------------------------------------
def unique_visitor(spark, sf):
    return _flat_page(traffic.unique_visitor(_pages(spark, sf)))


def user_jump(spark, sf):
    return _flat_page(traffic.user_jump(_pages(spark, sf), JUMP_LIMIT))


def user_jump_default_limit(spark, sf):
    return _flat_page(traffic.user_jump(_pages(spark, sf)))


def log_is_new_fix(spark, sf):
    return _marks(firsts.repair_is_new(_pages(spark, sf), traffic.TIE))


def _base_log(spark, sf, **options):
    return traffic.base_log(sample.raw_log(prepare(spark), sf), **options)


def log_split_counts(spark, sf):
    dirty = traffic.dirty_log(sample.raw_log(prepare(spark), sf)).select(F.lit("dirty").alias("tag"))
    return _base_log(spark, sf).select("tag").unionByName(dirty).groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"))


def _log_stream(tag: str, ddl: str, *columns: str) -> Query:
    def run(spark, sf):
        rows = _base_log(spark, sf, tags=[tag])
        record = rows.select(F.from_json("value", ddl).alias("r"))
        return record.select(*[F.col(f"r.{column}").alias(column.rsplit(".", 1)[-1]) for column in columns])

    return run


def log_dirty(spark, sf):
    return traffic.dirty_log(sample.raw_log(prepare(spark), sf))


def table_change_counts(spark, sf):
    return c.count_by_table(_changes(spark, sf))


# --- facts from change records -----------------------------------------------
def _from_changes(job) -> Query:
    return lambda spark, sf: _shown(job(_changes(spark, sf)))


def _with_dictionary(job) -> Query:
    return lambda spark, sf: _shown(job(_changes(spark, sf), sample.dictionary(spark)))


def order_pre_process(spark, sf):
    return _shown(_order_pre(spark, sf))


def order_pre_process_latest(spark, sf):
    return _shown(latest_per_key(_order_pre(spark, sf, by_line=True), ["id"], LATEST_ORDER))


def order_detail(spark, sf):
    return _shown(_order_detail(spark, sf))


def cancel_order_detail(spark, sf):
    return _shown(trade.cancel_order_detail(_order_pre(spark, sf)))


def pay_order_detail(spark, sf):
    return _shown(_pay_detail(spark, sf))


# --- summaries ---------------------------------------------------------------
def traffic_window(spark, sf):
    pages = _pages(spark, sf)
    return traffic.traffic_window(traffic.unique_visitor(pages), traffic.user_jump(pages, JUMP_LIMIT), pages)


def _from_pages(job) -> Query:
    return lambda spark, sf: job(_pages(spark, sf))


def keyword_texts(spark, sf):
    documents = sample.table(prepare(spark), sf, "documents")
    words = documents.select(F.col("lang").alias("source"), F.explode(tokenize("text")).alias("keyword"))
    return words.groupBy("source", "keyword").agg(F.count(F.lit(1)).alias("keyword_count"))


def register_window(spark, sf):
    return user.register_window(user.user_register(_changes(spark, sf)))


def cart_add_window(spark, sf):
    return trade.cart_add_window(trade.cart_add(_changes(spark, sf), sample.dictionary(spark)))


def payment_window(spark, sf):
    return trade.payment_window(_pay_detail(spark, sf))


def order_window(spark, sf):
    return trade.order_window(_order_detail(spark, sf), LINE_ORDER)


# --- duplicates --------------------------------------------------------------
def order_detail_first_wins(spark, sf):
    rows = firsts.first_wins(_order_detail(spark, sf), ["id"], LINE_ORDER)
    return rows.select("id", *LINE_ORDER[1:])


def pay_detail_latest_wins(spark, sf):
    rows = firsts.latest_wins(_pay_detail(spark, sf), ["order_detail_id"], "row_op_ts", ["sku_id", "sku_num", "order_price"])
    return rows.select("order_detail_id", "user_id", "callback_time", "sku_id", "sku_num", "order_price")


# --- dimensions --------------------------------------------------------------
def dim_route(spark, sf):
    rows = dim.routed(_changes(spark, sf), sample.routes(spark))
    return rows.select("table", "type", "ts", "sink_table", F.to_json("data").alias("data"))


def _dim_table(source: str) -> Query:
    def run(spark, sf):
        routes = sample.routes(prepare(spark))
        route = next(row for row in routes_as_rows(routes) if row.source_table == source)
        # a route names one source table, so only its records are read
        rows = dim.routed(c.of_table(_changes(spark, sf), source), routes)
        # two changes of one second: the higher status is the later one
        return merged(rows, route, ["ts", F.col("data")["order_status"].alias("status")])

    return run


# --- joins of two streams ----------------------------------------------------
def _clicks_and_purchases(spark, sf):
    events = sample.table(prepare(spark), sf, "events")

    def of(kind: str, number: str) -> DataFrame:
        rows = events.filter(F.col("event_type") == kind)
        return rows.select(F.col("user_id").alias("id"), F.col("event_id").alias(number), F.col("ts").alias("pt"))

    return of("click", "click_id"), of("purchase", "purchase_id")


def _stream_join(how: str) -> Query:
    def run(spark, sf):
        clicks, purchases = _clicks_and_purchases(spark, sf)
        joined = ttl_join(clicks, purchases, [("id", "id")], how, ttl="1 hour")
        return joined.select("id", "click_id", "purchase_id", F.unix_millis("pt").alias("pt_ms"))

    return run


def stream_join_chain(spark, sf):
    orders = sample.table(prepare(spark), sf, "orders")
    first = orders.select(F.col("o_custkey").alias("id"), F.col("o_totalprice").alias("vc"))
    second = sample.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name2"))
    third = sample.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name3"))
    return ttl_join(ttl_join(first, second, [("id", "id")]), third, [("id", "id")], "left")


# --- streams -----------------------------------------------------------------
def _streamed(job: Callable[[DataFrame], DataFrame]) -> Query:
    """The job on a stream over the whole events file, run until everything is read."""

    def run(spark, sf):
        static = _pages(spark, sf)
        source = sample.table(spark, sf, "events", streaming=True)
        rows = job(sample.pages_of(source))
        folder = f"{shared_dir(spark)}/{uuid4().hex}"

        def put(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

        run_available(rows, put, "stream", f"{folder}/checkpoint", idle_batches=False)
        return spark.read.schema(rows.schema).parquet(f"{folder}/out").select(*static.columns)

    return run


def _then(view: Callable[[DataFrame], DataFrame], query: Query) -> Query:
    return lambda spark, sf: view(query(spark, sf))


def _marks(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("seq").alias("id"), F.col("common.mid").alias("mid"), F.col("common.is_new").alias("is_new"))


# --- scalar functions --------------------------------------------------------
def time_functions(spark, sf):
    orders = sample.table(prepare(spark), sf, "orders")
    text = times.time_text("o_orderdate")
    later = F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 12).cast("int"))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        text.alias("time_text"),
        times.day_text(text).alias("day_text"),
        times.first_token(text).alias("first_token"),
        times.to_millis(text).alias("millis"),
        times.time_text(times.from_millis(times.to_millis(text) + F.col("o_custkey"))).alias("from_millis"),
        times.time_text(times.from_millis_in_seconds(times.to_millis(text) + F.col("o_custkey") * 7)).alias("in_seconds"),
        times.day_gap(later, F.to_date("o_orderdate")).alias("day_gap"),
    )


def op_time_compare(spark, sf):
    events = sample.table(prepare(spark), sf, "events")
    base = times.time_text("ts")
    left = F.concat(base, F.lit("."), (F.col("event_id") % 1000).cast("string"), F.lit("Z"))
    right = F.concat(base, F.lit("."), (F.col("user_id") % 100).cast("string"), F.lit("Z"))
    return events.select(F.col("event_id").alias("id"), times.compare_op_times(left, right).alias("sign"))


COMMON = "common STRUCT<mid: STRING, uid: STRING, vc: STRING, ch: STRING, ar: STRING, is_new: STRING>"
PAGE = "page STRUCT<page_id: STRING, last_page_id: STRING, during_time: BIGINT, item: STRING, item_type: STRING>"

QUERIES: dict[str, Query] = {
    "dwd_unique_visitor": unique_visitor,
    "dwd_user_jump": user_jump,
    "dwd_user_jump_10s": user_jump_default_limit,
    "dwd_log_is_new_fix": log_is_new_fix,
    "dwd_log_split_counts": log_split_counts,
    "dwd_log_page": _log_stream(
        "page", f"{COMMON}, {PAGE}, ts BIGINT", "common.mid", "common.is_new", "page.page_id", "page.item",
        "page.during_time", "ts",
    ),
    "dwd_log_start": _log_stream(
        "start", f"{COMMON}, start STRUCT<entry: STRING>, ts BIGINT", "common.mid", "common.is_new", "start.entry", "ts",
    ),
    "dwd_log_display": _log_stream(
        "display", f"{COMMON}, page_id STRING, item STRING, ts BIGINT", "common.mid", "page_id", "item", "ts",
    ),
    "dwd_log_action": _log_stream(
        "action", f"{COMMON}, page_id STRING, action_id STRING, ts BIGINT", "common.mid", "page_id", "action_id", "ts",
    ),
    "dwd_log_error": _log_stream(
        "error", f"{COMMON}, {PAGE}, err STRUCT<error_code: BIGINT>, ts BIGINT", "common.mid", "page.page_id",
        "err.error_code", "ts",
    ),
    "dwd_log_dirty": log_dirty,
    "dwd_cart_add": _with_dictionary(trade.cart_add),
    "dwd_order_pre_process": order_pre_process,
    "dwd_order_pre_process_latest": order_pre_process_latest,
    "dwd_order_detail": order_detail,
    "dwd_order_detail_first_wins": order_detail_first_wins,
    "dwd_cancel_order_detail": cancel_order_detail,
    "dwd_pay_order_detail": pay_order_detail,
    "dwd_pay_detail_latest_wins": pay_detail_latest_wins,
    "dwd_order_refund": _with_dictionary(trade.order_refund),
    "dwd_refund_pay": _with_dictionary(trade.refund_pay),
    "dwd_coupon_get": _from_changes(tool.coupon_get),
    "dwd_coupon_order": _from_changes(tool.coupon_order),
    "dwd_coupon_pay": _from_changes(tool.coupon_pay),
    "dwd_favor_add": _from_changes(interaction.favor_add),
    "dwd_comment": _with_dictionary(interaction.comment),
    "dwd_user_register": _from_changes(user.user_register),
    "dws_keyword_window": _from_pages(traffic.keyword_window),
    "dws_traffic_window": traffic_window,
    "dws_page_view_window": _from_pages(traffic.page_view_window),
    "dws_login_window": _from_pages(user.login_window),
    "dws_register_window": register_window,
    "dws_cart_add_window": cart_add_window,
    "dws_payment_window": payment_window,
    "dws_order_window": order_window,
    "dim_route": dim_route,
    "dim_user_info": _dim_table("user_info"),
    "dim_order_info": _dim_table("order_info"),
    "stream_join_inner": _stream_join("inner"),
    "stream_join_left": _stream_join("left"),
    "stream_join_right": _stream_join("right"),
    "stream_join_full": _stream_join("full"),
    "stream_join_chain": stream_join_chain,
    "stream_unique_visitor": _then(_flat_page, _streamed(traffic.unique_visitor)),
    "stream_log_is_new_fix": _then(_marks, _streamed(lambda rows: firsts.repair_is_new(rows, traffic.TIE))),
    "table_change_counts": table_change_counts,
    "keyword_texts": keyword_texts,
    "time_functions": time_functions,
    "op_time_compare": op_time_compare,
}

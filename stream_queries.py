"""Queries that begin at JSON text or run as streams: topics, split stores, loads, and state across batches."""

from __future__ import annotations

from functools import lru_cache
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

import warehouse_queries as q
from tidemark import schemas as s, topics as t
from tidemark.functions.records import encode
from tidemark.functions.texts import register_keyword_function
from tidemark.operators import changes as c, firsts
from tidemark.operators.joins import lookup_join, ttl_join
from tidemark.plans import dim, trade, traffic
from tidemark.session import prepare, shared_dir
from tidemark.sinks import dimensions as d, split, topics as out
from tidemark.sources import sample, topics as src
from tidemark.sources.cdc import read_debezium
from tidemark.sources.lookup import KeyedLookup
from tidemark.sources.replay import played, read_splits, split_of, time_bounds, write_splits
from tidemark.streaming.runner import run_clocked
from tidemark.topics import Topic

SPLITS = 5
# Seconds in which all rows of a key arrive, which come in two batches after one another, for each file of a batch.
WAIT_SECONDS = 30
WAIT = f"{WAIT_SECONDS} seconds"


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(prepare(spark))}/{uuid4().hex}"


# --- topics of JSON text, read once --------------------------------------------
# Text and split stores are written once per session: all queries read the same ones.
@lru_cache(maxsize=8)
def _change_store(spark: SparkSession, sf: str) -> split.loads.FolderStore:
    folder = _folder(spark)
    topic = Topic(t.CHANGES, root=folder)
    out.write_topic(q._changes(spark, sf).select(encode("database", "table", "type", "ts", "data", "old").alias("value")), topic)
    store = split.change_store(spark, f"{folder}/by_table")
    split.split_changes(src.read_topic(spark, topic), store)
    return store


@lru_cache(maxsize=8)
def _tag_store(spark: SparkSession, sf: str) -> split.loads.FolderStore:
    folder = _folder(spark)
    # the sample's order of records is kept, as a queue's offsets would
    lines = sample.raw_log(spark, sf)
    store, tags = split.log_store(spark, f"{folder}/parsed"), split.tag_store(spark, f"{folder}/by_tag")
    split.split_lines(lines, store)
    split.split_log(store, tags)
    return tags


def _from_store(job) -> q.Query:
    return lambda spark, sf: q._shown(job(split.read_changes(_change_store(spark, sf)), sample.dictionary(spark)))


def split_log_counts(spark, sf):
    return split.read_split(_tag_store(prepare(spark), sf)).groupBy("tag").agg(F.count(F.lit(1)).alias("cnt"))


def _split_pages(spark, sf) -> DataFrame:
    return src.good(src.decode(split.lines_of(_tag_store(prepare(spark), sf), "page"), s.PAGE_LOG, keep=["seq"]))


def split_log_page(spark, sf):
    rows = _split_pages(spark, sf)
    return rows.select("common.mid", "common.is_new", "page.page_id", "page.item", F.col("page.during_time").cast("bigint").alias("during_time"), "ts")


def split_table_counts(spark, sf):
    return c.count_by_table(split.read_changes(_change_store(prepare(spark), sf)))


# --- words of all scripts, from SQL ------------------------------------------------
#: Letters that stand for the Latin ones, by script.
LATIN = "abcdefghijklmnopqrstuvwxyz"
SCRIPTS = [
    "的一是不了人我在有他这中大来上国个到说们为子和你地出",  # Han
    "あいうえおかきくけこさしすせそたちつてとなにぬねのはひ",  # kana
    "가나다라마바사아자차카타파하거너더러머버서어저처커터",  # hangul
]


def keyword_scripts(spark, sf):
    """Whole texts, three of four with their Latin letters in another script, cut into words by SQL."""
    register_keyword_function(prepare(spark), "keywords")
    text = F.col("text")
    for number, letters in enumerate(SCRIPTS, 1):
        text = F.when(F.col("doc_id") % 4 == number, F.translate("text", LATIN, letters)).otherwise(text)
    rows = sample.table(spark, sf, "documents").select("lang", text.alias("item"))
    return spark.sql(
        "SELECT lang AS source, word AS keyword, count(*) AS keyword_count FROM {rows}, LATERAL keywords(item) GROUP BY ALL", rows=rows
    )


# --- a look-up that reads the codes it needs --------------------------------------
def lookup_needed(spark, sf):
    """Facts with the names of their parts: only parts that occur are read."""
    parts = KeyedLookup(lambda: sample.table(spark, sf, "part").select("p_partkey", "p_name"), "p_partkey")
    lines = sample.table(prepare(spark), sf, "lineitem").filter("l_linenumber = 7")
    named = lookup_join(lines, parts, "l_partkey", "part", code="p_partkey", label="p_name")
    return named.select("l_orderkey", "l_partkey", "part")


# --- loads of a dimension --------------------------------------------------------
def _order_info(spark, sf) -> DataFrame:
    return c.of_table(q._changes(spark, sf), "order_info").select("table", "type", "ts", "data")


def _order() -> list[Column]:
    # two changes of one second: the higher status is the later one
    return [F.col("ts").try_cast("bigint").alias("at"), F.col("data")["order_status"].alias("status")]


def dim_order_loads(spark, sf):
    """Orders placed as a bounded load, changes as a stream, folded in between, the last changes as another load."""
    folder, database = _folder(spark), f"dims_{uuid4().hex}"
    rows = _order_info(spark, sf)
    routes = sample.routes(spark).filter("source_table = 'order_info'")
    status = F.col("data")["order_status"]

    def load(part: DataFrame, **named) -> None:
        dim.dim_sink(part, routes, database, f"{folder}/dims", order=_order(), **named)

    load(rows.filter(status == "1001"), load="placed")
    changed = rows.filter(status.isin("1002", "1003", "1005")).withColumn("at", F.col("ts").cast("double"))
    bounds = time_bounds(changed, "at", SPLITS)
    files = write_splits(changed.drop("at"), split_of(F.col("ts").cast("double"), bounds), SPLITS, f"{folder}/in")
    stream = read_splits(spark, f"{folder}/in", rows.schema, files)
    query = dim.dim_sink(
        stream, routes, database, f"{folder}/dims", order=_order(), checkpoint=f"{folder}/cp", availableNow=True
    )
    query.awaitTermination()
    route = d.routes_as_rows(routes)[0]
    d.compact_dim(spark, route, database, f"{folder}/dims", f"{folder}/aside")
    load(rows.filter(status == "1006"))
    # a load that is run again under its name keeps its place before all others
    load(rows.filter(status == "1001"), load="placed")
    return d.read_dim(spark, route, database)


# --- a configuration that changes while changes of tables are read ---------------
#: Days from which versions of the route hold (fixed values): created, changed, deleted, created again.
ROUTE_DAYS = ("1996-01-01", "1997-06-01", "1998-09-01", "2000-01-01")


def _route_lines(spark: SparkSession, folder: str) -> None:
    """The configuration's change envelopes, one file for each change."""
    def route(columns: str) -> str:
        return (
            f'{{"source_table":"order_info","sink_table":"dim_order","sink_columns":"{columns}",'
            '"sink_pk":"id","sink_extend":""}'
        )

    first, second, third = route("id,user_id"), route("id,user_id,order_status"), route("id,order_status,total_amount")
    other = '{"source_table":"user_info","sink_table":"dim_user","sink_columns":"id,name","sink_pk":"id","sink_extend":""}'
    changes = [("r", "null", other, "1970-01-01"), ("c", "null", first, ROUTE_DAYS[0]), ("u", first, second, ROUTE_DAYS[1]),
               ("d", second, "null", ROUTE_DAYS[2]), ("c", "null", third, ROUTE_DAYS[3])]
    lines = spark.createDataFrame([(n, *change) for n, change in enumerate(changes)], "n INT, op STRING, before STRING, after STRING, day STRING")
    text = F.format_string(
        '{"op":"%s","ts_ms":%d,"before":%s,"after":%s}', "op", F.unix_millis(F.to_timestamp("day")), "before", "after"
    )
    write_splits(lines.select("n", text.alias("value")), F.col("n"), len(changes), folder)


def dim_live_routes(spark, sf):
    """Orders while their route comes, changes, goes and comes back; what came before it has waited."""
    folder, database = _folder(spark), f"live_{uuid4().hex}"
    rows = _order_info(spark, sf)
    # each version arrives no later than the changes that it is for
    days = F.array_compact(F.array(*[F.when(F.col("ts").cast("bigint") >= F.unix_timestamp(F.lit(day), "yyyy-MM-dd"), 1) for day in ROUTE_DAYS]))
    files = write_splits(rows, F.size(days), SPLITS, f"{folder}/in")
    _route_lines(spark, f"{folder}/routes")
    envelopes = read_debezium(read_splits(spark, f"{folder}/routes", src.TEXT))
    query = dim.live_dim_sink(
        envelopes, read_splits(spark, f"{folder}/in", rows.schema, files), database, f"{folder}/dims", on_missing="replay",
        wait_for=["order_info"], order=_order(), checkpoint=f"{folder}/cp", availableNow=True,
    )
    query.awaitTermination()
    route = next(route for route in dim.live_routes(spark, f"{folder}/dims") if route.sink_table == "dim_order")
    return d.read_dim(spark, route, database).select("id", "user_id", "order_status", "total_amount")


# --- joins of two streams over several batches -------------------------------------
def _later(rows: DataFrame, key: str, value, time: str, micros: int) -> DataFrame:
    """One row of a key of its own, two days after all others, which lets the watermark pass them."""
    columns = [F.lit(value) if name == key else F.timestamp_micros(F.lit(micros)) if name == time else F.lit(None) for name in rows.columns]
    return rows.sparkSession.range(1).select(*[column.cast(field.dataType).alias(field.name) for column, field in zip(columns, rows.schema)])


def _batched_join(how: str) -> q.Query:
    def run(spark, sf):
        folder = _folder(spark)
        clicks, purchases = q._clicks_and_purchases(spark, sf)
        both = clicks.select("pt").unionByName(purchases.select("pt")).select(F.unix_micros("pt").alias("at"))
        bounds = time_bounds(both.withColumn("at", F.col("at").cast("double")), "at", SPLITS)
        last = both.agg(F.max("at")).first()[0] + 2 * 86_400_000_000
        streams = []
        for name, rows, alone in (("left", clicks, -1), ("right", purchases, -2)):
            split_at = split_of(F.unix_micros("pt").cast("double"), bounds)
            files = write_splits(rows, split_at, SPLITS, f"{folder}/{name}")
            write_splits(_later(rows, "id", alone, "pt", last), F.lit(0), 1, f"{folder}/{name}", files)
            streams.append(read_splits(spark, f"{folder}/{name}", rows.schema, files))
        joined = ttl_join(*streams, [("id", "id")], how, ttl="1 hour")
        rows = played(joined.select("id", "click_id", "purchase_id", F.unix_millis("pt").alias("pt_ms")), folder)
        return rows.filter("id >= 0")

    return run


# --- patterns in event time ----------------------------------------------------------
def user_jump_batches(spark, sf):
    """Page logs in five files whose rows overlap by up to a second, less than the watermark waits."""
    folder = _folder(spark)
    pages = q._pages(spark, sf)
    shaken = (F.col("ts") + F.pmod(F.xxhash64("seq"), F.lit(1000))).cast("double")
    bounds = time_bounds(pages.select(F.col("ts").cast("double").alias("at")), "at", SPLITS)
    files = write_splits(pages.orderBy(F.xxhash64("seq")), split_of(shaken, bounds), SPLITS, f"{folder}/in")
    last = pages.agg(F.max("ts")).first()[0]
    # a device of its own that opens no session; an event that its first row gives its turn is timed out by the second
    other = F.col("common").withField("mid", F.lit("later")), F.col("page").withField("last_page_id", F.lit("home"))
    later = [last + days * 86_400_000 for days in (2, 4)]
    ends = F.explode(F.array(*map(F.lit, later)))
    late = pages.limit(1).withColumns({"common": other[0], "page": other[1], "ts": ends})
    write_splits(late, split_of("ts", later[:1]), len(later), f"{folder}/in", files)
    found = played(traffic.user_jump(read_splits(spark, f"{folder}/in", pages.schema, files), q.JUMP_LIMIT), folder)
    return q._flat_page(found)


# --- state in processing time ----------------------------------------------------------
def _adjacent(key: str, second: Column) -> Column:
    """A key's rows in one of four places, some of them in the file after it."""
    return F.pmod(F.xxhash64(key), F.lit(SPLITS - 1)) + F.when(second, 1).otherwise(0)


def first_wins_batches(spark, sf):
    """Order lines of which the first ones come in one batch, the others in the next."""
    folder = _folder(spark)
    rows = q._order_detail(spark, sf, by_line=True).select("id", *q.LINE_ORDER)
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("id").orderBy(*q.LINE_ORDER)))
    files = write_splits(ranked, _adjacent("id", F.col("_rank") > 1), SPLITS, f"{folder}/in")
    stream = read_splits(spark, f"{folder}/in", rows.schema, files)
    wait = f"{WAIT_SECONDS * files} seconds"
    found = played(firsts.first_wins(stream, ["id"], q.LINE_ORDER, wait), folder, run=run_clocked, drain=False)
    return found.select("id", *q.LINE_ORDER[1:])


def latest_wins_batches(spark, sf):
    """Paid lines in two batches after one another; timers give the latest of each once its time is up."""
    folder = _folder(spark)
    names = ["order_detail_id", "user_id", "callback_time", "sku_id", "sku_num", "order_price"]
    rows = q._pay_detail(spark, sf).select(*names, "row_op_ts")
    files = write_splits(rows, _adjacent("order_detail_id", F.xxhash64(*rows.columns) % 2 == 0), SPLITS, f"{folder}/in")
    stream = read_splits(spark, f"{folder}/in", rows.schema, files)
    latest = firsts.latest_wins(stream, ["order_detail_id"], "row_op_ts", ["sku_id", "sku_num", "order_price"], WAIT)
    return played(latest, folder, run=run_clocked).select(*names)


QUERIES: dict[str, q.Query] = {
    "split_log_counts": split_log_counts,
    "split_log_page": split_log_page,
    "split_table_counts": split_table_counts,
    "split_cart_add": _from_store(trade.cart_add),
    "split_order_refund": _from_store(trade.order_refund),
    "split_refund_pay": _from_store(trade.refund_pay),
    "keyword_scripts": keyword_scripts,
    "lookup_needed": lookup_needed,
    "dim_order_loads": dim_order_loads,
    "dim_live_routes": dim_live_routes,
    "batched_join_inner": _batched_join("inner"),
    "batched_join_left": _batched_join("left"),
    "batched_join_right": _batched_join("right"),
    "batched_join_full": _batched_join("full"),
    "batched_user_jump": user_jump_batches,
    "batched_first_wins": first_wins_batches,
    "batched_latest_wins": latest_wins_batches,
}

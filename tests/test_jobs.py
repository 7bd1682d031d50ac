"""The wired jobs: every one over folders of topics, linked by what the others wrote."""

from __future__ import annotations

import warehouse_queries as q
from tidemark import schemas as s, topics as t
from tidemark.functions.records import encode
from tidemark.jobs import JOBS, Warehouse, parser, warehouse
from tidemark.plans import dim
from tidemark.sinks import dimensions as d
from tidemark.sources import sample, topics as src
from tidemark.topics import Topic

ORDER = [
    "dim_sink", "base_log", "unique_visitor", "user_jump", "cart_add", "order_pre_process", "order_detail",
    "cancel_order_detail", "pay_order_detail", "order_refund", "refund_pay", "coupon_get", "coupon_order", "coupon_pay",
    "favor_add", "comment", "user_register", "keyword_window", "traffic_window", "page_view_window", "login_window",
    "register_window", "cart_add_window", "payment_window", "order_window",
]


def feed(spark, sf, root):
    sample.raw_log(spark, sf).select("value").write.text(f"{root}/{t.LOG}")
    names = ["database", "table", "type", "ts", "data", "old"]
    sample.changelog(spark, sf).select(encode(*names).alias("value")).write.text(f"{root}/{t.CHANGES}")


def test_all_jobs_in_the_order_of_their_links(spark, sf, folder):
    assert sorted([*ORDER, "split_changes"]) == sorted(JOBS) and len(ORDER) == 25
    feed(spark, sf, folder)
    house = Warehouse(
        spark, root=folder, dictionary=sample.dictionary(spark), routes=sample.routes(spark), database="alljobs",
        store=f"{folder}/store",
    )
    for name in ORDER:
        assert JOBS[name](house) == []
    for topic, query in (
        (t.CART_ADD, "dwd_cart_add"), (t.ORDER_PRE, "dwd_order_pre_process"), (t.ORDER_DETAIL, "dwd_order_detail"),
        (t.CANCEL_DETAIL, "dwd_cancel_order_detail"), (t.PAY_DETAIL, "dwd_pay_order_detail"),
        (t.REFUND, "dwd_order_refund"), (t.REFUND_PAY, "dwd_refund_pay"), (t.COUPON_GET, "dwd_coupon_get"),
        (t.COUPON_ORDER, "dwd_coupon_order"), (t.COUPON_PAY, "dwd_coupon_pay"), (t.FAVOR_ADD, "dwd_favor_add"),
        (t.COMMENT, "dwd_comment"), (t.REGISTER, "dwd_user_register"), (t.PAGE, "dwd_log_page"),
        (t.START, "dwd_log_start"), (t.ERROR, "dwd_log_error"), (t.DIRTY, "dwd_log_dirty"),
    ):
        written = src.read_topic(spark, Topic(topic, root=folder)).count()
        assert written == q.QUERIES[query](spark, sf).count() > 0, topic
    store = f"{folder}/store/"
    payments = spark.read.parquet(store + "dws_trade_payment_suc_window").drop("ts")
    assert sorted(map(str, payments.collect())) == sorted(map(str, q.payment_window(spark, sf).collect()))
    carts = spark.read.parquet(store + "dws_trade_cart_add_uu_window")
    assert carts.columns == s.CART_ADD_SUMMARY and carts.count() == q.cart_add_window(spark, sf).count()
    assert spark.read.parquet(store + "dws_traffic_vc_ch_ar_is_new_page_view_window").columns == s.TRAFFIC_SUMMARY
    for route in d.routes_as_rows(sample.routes(spark)):
        assert d.read_dim(spark, route, "alljobs").count() == q.QUERIES[route.sink_table](spark, sf).count()
    spark.sql("DROP DATABASE alljobs CASCADE")


def test_streaming_jobs_over_folders(spark, sf, folder):
    feed(spark, sf, folder)
    house = Warehouse(
        spark, root=folder, dictionary=sample.dictionary(spark), store=f"{folder}/store", checkpoints=f"{folder}/cp",
        streaming=True, trigger={"availableNow": True},
    )
    for name in ("base_log", "cart_add", "user_register", "register_window", "keyword_window"):
        for query in JOBS[name](house):
            query.awaitTermination()
    for topic, query in ((t.CART_ADD, "dwd_cart_add"), (t.REGISTER, "dwd_user_register"), (t.ERROR, "dwd_log_error")):
        assert src.read_topic(spark, Topic(topic, root=folder)).count() == q.QUERIES[query](spark, sf).count()
    registered = spark.read.parquet(f"{folder}/store/dws_user_user_register_window")
    assert 0 < registered.count() <= q.register_window(spark, sf).count()


def test_streaming_jobs_from_the_command_line(spark, sf, folder):
    """Changes are split once, jobs read their tables from there, a few files a batch; the configuration is a topic."""
    feed(spark, sf, folder)
    route = '{"source_table":"user_info","sink_table":"dim_user","sink_columns":"id,name","sink_pk":"id","sink_extend":""}'
    spark.createDataFrame([(f'{{"op":"r","ts_ms":0,"before":null,"after":{route}}}',)], "value STRING").write.text(f"{folder}/routes")
    spark.sql("SELECT * FROM {d}", d=sample.dictionary(spark)).write.parquet(f"{folder}/dictionary")

    def run(job, *more):
        given = ["--root", folder, "--store", f"{folder}/store", "--checkpoints", f"{folder}/cp", "--once", "--database", "fromline",
                 "--limit", "maxFilesPerTrigger=4", "--dictionary", f"{folder}/dictionary", "--split", f"{folder}/split", *more]
        queries = JOBS[job](warehouse(spark, parser().parse_args([job, *given])))
        for query in queries:
            query.awaitTermination()
        return queries

    (split,) = run("split_changes")
    files = [path for path in split.recentProgress[0].sources if "topic_db" in path.description]
    assert files and len(split.recentProgress) > 1
    run("cart_add")
    assert src.read_topic(spark, Topic(t.CART_ADD, root=folder)).count() == q.QUERIES["dwd_cart_add"](spark, sf).count()
    run("dim_sink", "--route-topic", "routes")
    (found,) = dim.live_routes(spark, f"{folder}/store/fromline")
    assert d.read_dim(spark, found, "fromline").count() == q.QUERIES["dim_user_info"](spark, sf).count()
    spark.sql("DROP DATABASE fromline CASCADE")

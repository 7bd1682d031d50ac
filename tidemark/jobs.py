"""The jobs wired to topics and stores: each reads its inputs by name and writes its outputs.

A bounded warehouse runs a job over everything that is there; a streaming one
starts its queries and returns them.  Jobs are independent programs linked by
topics, as ``python -m tidemark.jobs <job> --root <folder> --dictionary <folder>``
or from code.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas as s, topics as t
from tidemark.functions import times
from tidemark.functions.records import encode
from tidemark.operators.routing import ROUTE_FIELDS
from tidemark.plans import dim, interaction, tool, trade, traffic, user
from tidemark.session import build_session, shared_dir
from tidemark.sinks import split, topics as out
from tidemark.sinks.loads import stream_load
from tidemark.sinks.summaries import write_summary
from tidemark.sources import topics as src
from tidemark.sources.cdc import read_debezium
from tidemark.sources.lookup import Lookup, read_lookup
from tidemark.streaming.runner import start_job
from tidemark.topics import Topic

Started = list[StreamingQuery]


@dataclass
class Warehouse:
    """Where topics, look-ups and stores are.

    ``limits`` are options of topics that are read, such as
    ``maxFilesPerTrigger`` or ``maxOffsetsPerTrigger``: without them the first
    run takes the whole history as one batch.  With ``split``, a folder that the
    job ``split_changes`` fills, jobs read the changes of their tables from there
    instead of the topic of all changes.  With ``route_topic`` the dimension job follows
    the configuration's change envelopes of that topic instead of a table.
    """

    spark: SparkSession
    servers: str | None = None
    root: str | None = None
    dictionary: DataFrame | Lookup | None = None
    routes: DataFrame | Lookup | None = None
    database: str = "dims"
    store: str | None = None
    jdbc: dict[str, str] | None = None
    checkpoints: str | None = None
    streaming: bool = False
    trigger: dict = field(default_factory=lambda: {"processingTime": "1 second"})
    limits: dict[str, str] = field(default_factory=dict)
    split: str | None = None
    route_topic: str | None = None
    on_missing: str = "drop"

    def topic(self, name: str) -> Topic:
        """A topic to be written."""
        return Topic(name, servers=self.servers, root=self.root)

    def source(self, name: str) -> Topic:
        """A topic to be read, within the limits."""
        return Topic(name, servers=self.servers, root=self.root, options=self.limits)

    def lines(self, name: str) -> DataFrame:
        return src.read_topic(self.spark, self.source(name), self.streaming)

    def rows(self, name: str, schema) -> DataFrame:
        return src.read_json_topic(self.spark, self.source(name), schema, self.streaming)

    def pages(self, name: str = t.PAGE) -> DataFrame:
        return src.read_page_log(self.spark, self.source(name), self.streaming)

    def changes(self) -> DataFrame:
        if self.split:
            limits = {name: value for name, value in self.limits.items() if name in src.FILE_OPTIONS}
            return split.read_changes(self.change_store(), streaming=self.streaming, options=limits)
        return src.read_changelog(self.spark, self.source(t.CHANGES), self.streaming)

    def change_store(self) -> split.loads.FolderStore:
        return split.change_store(self.spark, self.split)

    def options(self, name: str) -> dict:
        if not self.streaming:
            return {}
        return {"checkpoint": f"{self.checkpoints or shared_dir(self.spark) + '/checkpoints'}/{name}", **self.trigger}

    def write(self, rows: DataFrame, name: str, keys: list[str] | None = None) -> Started:
        """JSON records, under their key if there is one; every version of a row is written."""
        key = [encode(*keys).alias("key")] if keys else []
        query = out.write_topic(rows.select(*key, encode("*").alias("value")), self.topic(name), **self.options(name))
        return [query] if query else []

    def summarise(self, rows: DataFrame, columns: list[str], name: str, clock: Column | None = None) -> Started:
        place = {"jdbc": {**self.jdbc, "dbtable": name}} if self.jdbc else {"path": f"{self.store}/{name}"}
        query = write_summary(rows, columns, name=name, clock=clock, **place, **self.options(name))
        return [query] if query else []


def base_log(w: Warehouse) -> Started:
    lines = w.lines(t.LOG)
    topics = {tag: w.topic(name) for tag, name in t.LOG_TOPICS.items()}
    queries = [
        out.fan_out(traffic.base_log(lines), topics, "base_log", **w.options("base_log")),
        out.write_topic(traffic.dirty_log(lines), w.topic(t.DIRTY), **w.options(t.DIRTY)),
    ]
    return [query for query in queries if query]


def split_changes(w: Warehouse) -> Started:
    if not w.split:
        raise ValueError("name the folder of the split store")
    query = split.split_changes(w.lines(t.CHANGES), w.change_store(), **w.options("split_changes"))
    return [query] if query else []


def dim_sink(w: Warehouse) -> Started:
    root = f"{w.store}/{w.database}"
    if w.route_topic:
        if not w.streaming:
            raise ValueError("a configuration that changes is followed by a stream")
        envelopes = read_debezium(w.lines(w.route_topic))
        return [dim.live_dim_sink(envelopes, w.changes(), w.database, root, w.on_missing, **w.options("dim_sink"))]
    query = dim.dim_sink(w.changes(), w.routes, w.database, root, **w.options("dim_sink"))
    return [query] if query else []


def _per_batch(job: Callable[[DataFrame], DataFrame], name: str) -> Callable[[Warehouse], Started]:
    """A job without state: planned anew for every micro-batch of a stream."""

    def run(w: Warehouse) -> Started:
        changes = w.changes()
        if not w.streaming:
            return w.write(job(changes), name)

        def put(batch: DataFrame, number: int) -> None:
            out.put_batch(batch.select(encode("*").alias("value")), w.topic(name), number, stream_load(batch))

        return [start_job(changes, job, put, name, **w.options(name))]

    return run


def _with_names(job: Callable, name: str) -> Callable[[Warehouse], Started]:
    return lambda w: _per_batch(lambda changes: job(changes, w.dictionary), name)(w)


def _pre(w: Warehouse) -> DataFrame:
    return src.read_order_pre(w.spark, w.source(t.ORDER_PRE), w.streaming)


def _details(w: Warehouse) -> DataFrame:
    return src.read_order_detail(w.spark, w.source(t.ORDER_DETAIL), w.streaming)


def _paid(w: Warehouse) -> DataFrame:
    return src.read_pay_order_detail(w.spark, w.source(t.PAY_DETAIL), w.streaming)


def _pay(w: Warehouse) -> DataFrame:
    return trade.pay_order_detail(w.changes(), _details(w).drop("seq"), w.dictionary)


JOBS: dict[str, Callable[[Warehouse], Started]] = {
    "split_changes": split_changes,
    "dim_sink": dim_sink,
    "base_log": base_log,
    "unique_visitor": lambda w: w.write(traffic.unique_visitor(w.pages()).drop("seq"), t.VISITOR),
    "user_jump": lambda w: w.write(traffic.user_jump(w.pages()).drop("seq"), t.JUMP),
    "cart_add": _with_names(trade.cart_add, t.CART_ADD),
    "order_pre_process": lambda w: w.write(trade.order_pre_process(w.changes(), w.dictionary), t.ORDER_PRE, ["id"]),
    "order_detail": lambda w: w.write(trade.order_detail(_pre(w)), t.ORDER_DETAIL),
    "cancel_order_detail": lambda w: w.write(trade.cancel_order_detail(_pre(w)), t.CANCEL_DETAIL),
    "pay_order_detail": lambda w: w.write(_pay(w), t.PAY_DETAIL, ["order_detail_id"]),
    "order_refund": lambda w: w.write(trade.order_refund(w.changes(), w.dictionary), t.REFUND),
    "refund_pay": lambda w: w.write(trade.refund_pay(w.changes(), w.dictionary), t.REFUND_PAY),
    "coupon_get": _per_batch(tool.coupon_get, t.COUPON_GET),
    "coupon_order": _per_batch(tool.coupon_order, t.COUPON_ORDER),
    "coupon_pay": _per_batch(tool.coupon_pay, t.COUPON_PAY),
    "favor_add": _per_batch(interaction.favor_add, t.FAVOR_ADD),
    "comment": _with_names(interaction.comment, t.COMMENT),
    "user_register": _per_batch(user.user_register, t.REGISTER),
    "keyword_window": lambda w: w.summarise(
        traffic.keyword_window(w.pages()), s.KEYWORD_SUMMARY, "dws_traffic_source_keyword_page_view_window",
        times.now_seconds_in_millis(),
    ),
    "traffic_window": lambda w: w.summarise(
        traffic.traffic_window(w.pages(t.VISITOR), w.pages(t.JUMP), w.pages()), s.TRAFFIC_SUMMARY,
        "dws_traffic_vc_ch_ar_is_new_page_view_window",
    ),
    "page_view_window": lambda w: w.summarise(
        traffic.page_view_window(w.pages()), s.PAGE_VIEW_SUMMARY, "dws_traffic_page_view_window"
    ),
    "login_window": lambda w: w.summarise(user.login_window(w.pages()), s.LOGIN_SUMMARY, "dws_user_user_login_window"),
    "register_window": lambda w: w.summarise(
        user.register_window(w.rows(t.REGISTER, s.record(" ".join(s.USER_REGISTER)))), s.REGISTER_SUMMARY,
        "dws_user_user_register_window",
    ),
    "cart_add_window": lambda w: w.summarise(
        trade.cart_add_window(w.rows(t.CART_ADD, s.record(" ".join(s.CART_ADD)))), s.CART_ADD_SUMMARY,
        "dws_trade_cart_add_uu_window",
    ),
    "payment_window": lambda w: w.summarise(
        trade.payment_window(_paid(w)), s.PAYMENT_SUMMARY, "dws_trade_payment_suc_window"
    ),
    "order_window": lambda w: w.summarise(
        trade.order_window(_details(w), ["pt", "seq"]), s.ORDER_SUMMARY, "dws_trade_order_window"
    ),
}


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(description="Run one job of the warehouse as a stream.")
    made.add_argument("job", choices=sorted(JOBS))
    made.add_argument("--servers", help="message servers; or")
    made.add_argument("--root", help="folder of topics")
    made.add_argument("--limit", action="append", default=[], metavar="NAME=VALUE", help="option of topics that are read, such as maxFilesPerTrigger=100")
    made.add_argument("--split", help="folder of the split store of changes")
    made.add_argument("--dictionary", help="parquet folder of the code dictionary")
    made.add_argument("--routes", help="parquet folder of the dimension routes; or")
    made.add_argument("--route-topic", help="topic of the routes' change envelopes")
    made.add_argument("--on-missing", choices=("drop", "replay"), default="drop", help="what becomes of changes without a route")
    made.add_argument("--store", help="folder of summaries and dimension tables")
    made.add_argument("--database", default="dims", help="database of the dimension tables")
    made.add_argument("--jdbc", action="append", default=[], metavar="NAME=VALUE", help="option of the summaries' database, such as url=...")
    made.add_argument("--checkpoints", help="folder of checkpoints")
    made.add_argument("--clock", default="1 second", help="time between batches")
    made.add_argument("--once", action="store_true", help="read what is there and stop")
    return made


def _pairs(given: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in given)


def warehouse(spark: SparkSession, given: argparse.Namespace) -> Warehouse:
    """The warehouse that the command line names."""
    return Warehouse(
        spark,
        servers=given.servers,
        root=given.root,
        dictionary=read_lookup(spark, given.dictionary) if given.dictionary else None,
        routes=read_lookup(spark, given.routes, columns=tuple(ROUTE_FIELDS)) if given.routes else None,
        database=given.database,
        store=given.store,
        jdbc=_pairs(given.jdbc) or None,
        checkpoints=given.checkpoints,
        streaming=True,
        trigger={"availableNow": True} if given.once else {"processingTime": given.clock},
        limits=_pairs(given.limit),
        split=given.split,
        route_topic=given.route_topic,
        on_missing=given.on_missing,
    )


def main() -> None:
    given = parser().parse_args()
    for query in JOBS[given.job](warehouse(build_session(given.job), given)):
        query.awaitTermination()


if __name__ == "__main__":
    main()

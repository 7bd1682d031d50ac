"""Rows of interest taken out of the database change stream.

Every function takes the change records (``database``, ``table``, ``type``,
``data``, ``old``, ``ts`` and, where rows are joined later, ``pt``) and returns
named columns.  They are narrow: filter and project, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas as s
from tidemark.functions import times


def of_table(changes: DataFrame, table: str, *types: str, database: str | None = None) -> DataFrame:
    """Records of one table, optionally of some change types and one database."""
    wanted = F.col("table") == table
    if types:
        wanted &= F.col("type").isin(*types)
    if database:
        wanted &= F.col("database") == database
    return changes.filter(wanted)


def of_known_types(changes: DataFrame) -> DataFrame:
    """Inserts, updates and rows of the initial snapshot; deletes go."""
    return changes.filter(F.col("type").isin(*s.CHANGE_TYPES))


def new(field: str) -> Column:
    return F.col("data")[field]


def previous(field: str) -> Column:
    return F.col("old")[field]


def _take(changes: DataFrame, fields: list[str], *more: str) -> DataFrame:
    """Project payload fields, then the record columns that exist in the input."""
    extra = [F.col(name) for name in more if name in changes.columns]
    return changes.select(*[new(field).alias(field) for field in fields], *extra)


def count_by_table(changes: DataFrame) -> DataFrame:
    """Number of change records per table."""
    return changes.groupBy("table").agg(F.count(F.lit(1)).alias("cnt"))


def cart_adds(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Items put into the cart: new rows, and updates that raise the quantity (by the difference)."""
    now, before = new("sku_num").try_cast("int"), previous("sku_num").try_cast("int")
    inserted = F.col("type") == "insert"
    raised = (F.col("type") == "update") & previous("sku_num").isNotNull() & (now > before)
    rows = of_table(changes, "cart_info", database=database).filter(inserted | raised)
    number = F.when(inserted, new("sku_num")).otherwise((now - before).cast("string"))
    columns = [(number if field == "sku_num" else new(field)).alias(field) for field in s.CART_INFO]
    return rows.select(*columns, *[F.col(name) for name in ("pt",) if name in rows.columns])


def order_details(changes: DataFrame, database: str | None = None) -> DataFrame:
    return _take(of_table(changes, "order_detail", "insert", database=database), s.ORDER_DETAIL_INFO, "pt", "ts")


def orders(changes: DataFrame, database: str | None = None) -> DataFrame:
    rows = of_table(changes, "order_info", "insert", "update", database=database)
    return _take(rows, s.ORDER_INFO, "type", "old", "pt", "ts")


def detail_activities(changes: DataFrame, database: str | None = None) -> DataFrame:
    return _take(of_table(changes, "order_detail_activity", "insert", database=database), s.DETAIL_ACTIVITY, "pt")


def detail_coupons(changes: DataFrame, database: str | None = None) -> DataFrame:
    return _take(of_table(changes, "order_detail_coupon", "insert", database=database), s.DETAIL_COUPON, "pt")


def placed_details(order_pre: DataFrame) -> DataFrame:
    """Order lines as first placed."""
    return order_pre.filter(F.col("type") == "insert").select(*s.ORDER_DETAIL, "row_op_ts")


def cancelled_details(order_pre: DataFrame) -> DataFrame:
    """Order lines whose order has just been cancelled."""
    cancelled = (
        (F.col("type") == "update")
        & previous("order_status").isNotNull()
        & (F.col("order_status") == s.ORDER_CANCELLED)
    )
    return order_pre.filter(cancelled).withColumnRenamed("operate_time", "cancel_time").select(*s.CANCEL_ORDER_DETAIL)


def payments(changes: DataFrame, database: str | None = None) -> DataFrame:
    """Payments that have just succeeded."""
    rows = of_table(changes, "payment_info", "update", database=database)
    return _take(rows.filter(new("payment_status") == s.PAYMENT_SUCCEEDED), s.PAYMENT_INFO, "pt")


def refund_requests(changes: DataFrame, database: str | None = None) -> DataFrame:
    return _take(of_table(changes, "order_refund_info", "insert", database=database), s.REFUND_INFO, "pt", "ts")


def orders_changed_to(changes: DataFrame, status: str, database: str | None = None) -> DataFrame:
    """Orders whose status has just become ``status``."""
    rows = of_table(changes, "order_info", "update", database=database)
    changed = (new("order_status") == status) & previous("order_status").isNotNull()
    return _take(rows.filter(changed), ["id", "user_id", "province_id"], "pt")


def refund_payments(changes: DataFrame, strict: bool = False, database: str | None = None) -> DataFrame:
    """Paid-out refunds; ``strict`` keeps only updates that set the final status."""
    rows = of_table(changes, "refund_payment", database=database)
    if strict:
        rows = _status_updates(rows, "refund_status", s.REFUND_PAYMENT_DONE)
    return _take(rows, s.REFUND_PAYMENT, "pt", "ts")


def refund_records(changes: DataFrame, strict: bool = False, database: str | None = None) -> DataFrame:
    """Refund requests of any change type; ``strict`` as above."""
    rows = of_table(changes, "order_refund_info", database=database)
    if strict:
        rows = _status_updates(rows, "refund_status", s.REFUND_REQUEST_PAID)
    return _take(rows, ["order_id", "sku_id", "refund_num"], "pt")


def _status_updates(rows: DataFrame, field: str, status: str) -> DataFrame:
    return rows.filter((F.col("type") == "update") & (new(field) == status) & previous(field).isNotNull())


def coupons_received(changes: DataFrame) -> DataFrame:
    rows = of_table(changes, "coupon_use", "insert")
    return rows.select(
        new("id").alias("id"),
        new("coupon_id").alias("coupon_id"),
        new("user_id").alias("user_id"),
        times.day_text(new("get_time")).alias("date_id"),
        new("get_time").alias("get_time"),
        "ts",
    )


def coupons_used_in_order(changes: DataFrame) -> DataFrame:
    used = (new("coupon_status") == s.COUPON_USED_IN_ORDER) & (previous("coupon_status") == s.COUPON_RECEIVED)
    return _coupon_step(of_table(changes, "coupon_use", "update").filter(used), "using_time", "order_time")


def coupons_paid(changes: DataFrame) -> DataFrame:
    paid = new("used_time").isNotNull()
    return _coupon_step(of_table(changes, "coupon_use", "update").filter(paid), "used_time", "payment_time")


def _coupon_step(rows: DataFrame, field: str, name: str) -> DataFrame:
    return rows.select(
        *[new(key).alias(key) for key in ("id", "coupon_id", "user_id", "order_id")],
        times.day_text(new(field)).alias("date_id"),
        new(field).alias(name),
        "ts",
    )


def favours_added(changes: DataFrame) -> DataFrame:
    """New favourites and favourites switched on again."""
    active = (F.col("type") == "update") & (new("is_cancel") == s.FAVOUR_ACTIVE)
    rows = of_table(changes, "favor_info").filter((F.col("type") == "insert") | active)
    return rows.select(
        *[new(key).alias(key) for key in ("id", "user_id", "sku_id")],
        times.day_text(new("create_time")).alias("date_id"),
        new("create_time").alias("create_time"),
        "ts",
    )


def comments(changes: DataFrame) -> DataFrame:
    return _take(of_table(changes, "comment_info", "insert"), s.COMMENT_INFO, "pt", "ts")


def users_registered(changes: DataFrame) -> DataFrame:
    rows = of_table(changes, "user_info", "insert")
    return rows.select(
        new("id").alias("user_id"),
        times.day_text(new("create_time")).alias("date_id"),
        new("create_time").alias("create_time"),
        "ts",
    )

"""Carts, orders, payments and refunds.

``ttl`` is how long rows of joined streams wait for each other; bounded inputs
join without limit unless one is given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas as s
from tidemark.functions import times
from tidemark.operators import changes as c, firsts, windows as w
from tidemark.operators.joins import lookup_join, ttl_join
from tidemark.sources.lookup import Lookup

Dictionary = DataFrame | Lookup

# How long joined streams wait in each job.
ORDER_TTL = "30 seconds"
PAYMENT_TTL = "905 seconds"
REFUND_TTL = "5 seconds"
# exact enough for amounts with two decimals times rates with two
MONEY = "decimal(18,4)"


def _ttl(rows: DataFrame, given: str | None, usual: str) -> str | None:
    return given or (usual if rows.isStreaming else None)


def _now(clock: Column | None) -> Column:
    return F.current_timestamp() if clock is None else clock


def cart_add(changes: DataFrame, dictionary: Dictionary, database: str | None = None) -> DataFrame:
    """Cart additions with the name of their source."""
    named = lookup_join(c.cart_adds(changes, database), dictionary, "source_type", "source_type_name")
    return named.withColumnRenamed("source_type", "source_type_id").select(*s.CART_ADD)


def order_pre_process(
    changes: DataFrame,
    dictionary: Dictionary,
    ttl: str | None = None,
    clock: Column | None = None,
    database: str | None = None,
    by_line: bool = False,
) -> DataFrame:
    """Order lines with their order, activity and coupon: 44 columns, one row per line and order change.

    ``clock`` gives ``row_op_ts``; it may use ``ts`` (of the line) and
    ``order_ts`` (of the order change), and is the wall clock by default.
    ``by_line`` leaves the rows of a bounded input where their line's ``id``
    put them, for what goes on by that; otherwise they lie by order.
    """
    ttl = _ttl(changes, ttl, ORDER_TTL)
    lines = lookup_join(c.order_details(changes, database), dictionary, "source_type", "source_type_name")
    orders = c.orders(changes, database).withColumnRenamed("ts", "order_ts").drop("create_time")
    activities = c.detail_activities(changes, database)
    activities = activities.withColumnRenamed("id", "order_detail_activity_id").drop("order_id", "sku_id", "create_time")
    coupons = c.detail_coupons(changes, database)
    coupons = coupons.withColumnRenamed("id", "order_detail_coupon_id").drop("order_id", "sku_id", "create_time")

    def with_orders(rows: DataFrame) -> DataFrame:
        return ttl_join(rows, orders, [("order_id", "id")], "inner", ttl)

    def with_extras(rows: DataFrame) -> DataFrame:
        rows = ttl_join(rows, activities, [("id", "order_detail_id")], "left", ttl)
        return ttl_join(rows, coupons, [("id", "order_detail_id")], "left", ttl)

    # An order has several changes, each of which repeats its lines, so bounded
    # inputs add what belongs to the line before that: both left joins then
    # share one shuffle by line.  A stream must not delay lines by its left
    # joins before they have met their order.
    if lines.isStreaming:
        joined = with_extras(with_orders(lines))
    elif by_line and ttl is None:
        # lines without an id meet their order, but lie nowhere
        joined = _changes_by_line(with_extras(lines), lines, orders)
        joined = joined.unionByName(with_orders(with_extras(lines.filter(F.col("id").isNull()))))
    else:
        joined = with_orders(with_extras(lines))
    shaped = joined.withColumnRenamed("source_type", "source_type_id")
    return shaped.withColumn("row_op_ts", _now(clock)).select(*s.ORDER_PRE, "old", "row_op_ts")


def _changes_by_line(rows: DataFrame, lines: DataFrame, orders: DataFrame) -> DataFrame:
    """The inner join of lines with an id and their orders, with the changes of an order brought to its lines.

    Which lines an order has is told by two columns, so the lines' own are not
    shuffled to meet their order, nor the joined ones to meet by line again.
    """
    names = lines.select(F.col("id").alias("_line"), F.col("order_id").alias("_order"))
    names = names.filter(F.col("_line").isNotNull()).repartition("_order").distinct()
    changed = orders.drop("pt").join(names, F.col("id") == F.col("_order")).drop("id")
    # equal, but as a range: a key of the join would tear the rows of a line apart
    theirs = F.col("order_id").between(F.col("_order"), F.col("_order"))
    return rows.join(changed, (F.col("id") == F.col("_line")) & theirs).drop("_line", "_order")


def order_detail(order_pre: DataFrame) -> DataFrame:
    return c.placed_details(order_pre)


def cancel_order_detail(order_pre: DataFrame) -> DataFrame:
    return c.cancelled_details(order_pre)


def pay_order_detail(
    changes: DataFrame,
    order_details: DataFrame,
    dictionary: Dictionary,
    ttl: str | None = None,
    database: str | None = None,
) -> DataFrame:
    """Order lines whose payment succeeded."""
    paid = c.payments(changes, database).drop("user_id")
    named = lookup_join(paid, dictionary, "payment_type", "payment_type_name")
    joined = ttl_join(order_details, named, [("order_id", "order_id")], "inner", _ttl(changes, ttl, PAYMENT_TTL))
    names = {"id": "order_detail_id", "payment_type": "payment_type_code", "split_total_amount": "split_payment_amount"}
    return joined.withColumnsRenamed(names).select(*s.PAY_ORDER_DETAIL, "row_op_ts")


def order_refund(
    changes: DataFrame,
    dictionary: Dictionary,
    ttl: str | None = None,
    clock: Column | None = None,
    database: str | None = None,
) -> DataFrame:
    """Refund requests of orders that have just changed to "refund requested"."""
    requests = lookup_join(c.refund_requests(changes, database), dictionary, "refund_type", "refund_type_name")
    requests = lookup_join(requests, dictionary, "refund_reason_type", "refund_reason_type_name")
    orders = c.orders_changed_to(changes, s.ORDER_REFUND_REQUESTED, database).drop("user_id")
    joined = ttl_join(requests, orders, [("order_id", "id")], "inner", _ttl(changes, ttl, REFUND_TTL))
    names = {"refund_type": "refund_type_code", "refund_reason_type": "refund_reason_type_code"}
    shaped = joined.withColumn("date_id", times.day_text("create_time")).withColumnsRenamed(names)
    return shaped.withColumn("row_op_ts", _now(clock)).select(*s.ORDER_REFUND, "row_op_ts")


def refund_pay(
    changes: DataFrame,
    dictionary: Dictionary,
    ttl: str | None = None,
    clock: Column | None = None,
    strict: bool = False,
    database: str | None = None,
) -> DataFrame:
    """Refunds paid out, with the order and the refund request they belong to."""
    ttl = _ttl(changes, ttl, REFUND_TTL)
    paid = lookup_join(c.refund_payments(changes, strict, database), dictionary, "payment_type", "payment_type_name")
    orders = c.orders_changed_to(changes, s.ORDER_REFUNDED, database)
    records = c.refund_records(changes, strict, database)
    joined = ttl_join(paid, orders, [("order_id", "id")], "inner", ttl)
    joined = ttl_join(joined, records, [("order_id", "order_id"), ("sku_id", "sku_id")], "inner", ttl)
    names = {"payment_type": "payment_type_code", "total_amount": "refund_amount"}
    shaped = joined.withColumn("date_id", times.day_text("callback_time")).withColumnsRenamed(names)
    return shaped.withColumn("row_op_ts", _now(clock)).select(*s.REFUND_PAY, "row_op_ts")


def cart_add_window(cart_adds: DataFrame) -> DataFrame:
    """Daily-unique users who put something into the cart."""
    rows = cart_adds.select("user_id", times.from_text(F.coalesce("operate_time", "create_time")).alias("rt"))
    users = firsts.daily_starts(rows, ["user_id"], "rt")
    return w.tumbling(w.with_delay(users, "rt"), "rt", {"cartAddUuCt": F.count(F.lit(1))})


def payment_window(pay_details: DataFrame, tie: list[str] | None = None) -> DataFrame:
    """Daily-unique and new payers."""
    latest = firsts.latest_wins(pay_details, ["order_detail_id"], "row_op_ts", tie or ["callback_time"])
    rows = latest.select("user_id", times.from_text("callback_time").alias("rt"))
    users = firsts.unique_users(rows, "user_id", "rt", [])
    sums = {"paymentSucUniqueUserCount": w.total("unique_user"), "paymentSucNewUserCount": w.total("new_user")}
    return w.tumbling(w.with_delay(users, "rt"), "rt", sums)


def order_window(order_details: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Daily-unique and new buyers, reductions and original amounts.

    ``order`` is the arrival order among rows of one order line.
    """
    lines = firsts.first_wins(order_details, ["id"], order or ["row_op_ts"])

    def money(value: Column) -> Column:
        return value.try_cast(MONEY)

    zero = F.lit(0).cast(MONEY)
    rows = lines.select(
        "user_id",
        times.from_text("create_time").alias("rt"),
        F.coalesce(money(F.col("split_activity_amount")), zero).alias("activity"),
        F.coalesce(money(F.col("split_coupon_amount")), zero).alias("coupon"),
        money(F.col("sku_num").try_cast("int") * money(F.col("order_price"))).alias("original"),
    )
    marked = firsts.mark_unique_users(rows, "user_id", "rt", [], ["activity", "coupon", "original"])
    sums = {
        "orderUniqueUserCount": w.total("unique_user"),
        "orderNewUserCount": w.total("new_user"),
        "orderActivityReduceAmount": F.sum("activity").cast("double"),
        "orderCouponReduceAmount": F.sum("coupon").cast("double"),
        "orderOriginalTotalAmount": F.sum("original").cast("double"),
    }
    return w.tumbling(w.with_delay(marked, "rt"), "rt", sums)

"""Field names and types of every stream.

Fixed values: the names and their order are the published contract of the
streams, so they are spelled out here once and every projection is derived
from them.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DataType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

TYPES = {"": StringType(), "long": LongType(), "time": TimestampType(), "map": MapType(StringType(), StringType())}


def strings(names: str) -> list[str]:
    return names.split()


def record(names: str, **nested: DataType) -> StructType:
    """``name`` is text, ``name:long``, ``name:time`` and ``name:map`` are not; nested fields come last."""
    parts = [name.partition(":") for name in names.split()]
    plain = [StructField(name, TYPES[kind]) for name, _, kind in parts]
    return StructType(plain + [StructField(name, kind) for name, kind in nested.items()])


# --- raw log -----------------------------------------------------------------
COMMON = record("ar ba ch is_new md mid os uid vc")
PAGE = record("during_time:long item item_type last_page_id page_id source_type")
#: What the log split looks at; records go on whole.
LOG_KEYS = record("ts", common=record("is_new mid"))
PAGE_LOG = record("ts:long", common=COMMON, page=PAGE)

# --- change records ----------------------------------------------------------
CHANGE = record("database table type ts data:map old:map")
ROUTE = record("source_table sink_table sink_columns sink_pk sink_extend")
ENVELOPE = record("op ts_ms:long", before=ROUTE, after=ROUTE)
DICTIONARY = record("dic_code dic_name parent_code create_time:time operate_time:time")

# --- change feeds: columns taken out of the payload map ----------------------
CART_INFO = strings(
    "id user_id sku_id cart_price sku_num sku_name is_checked create_time operate_time is_ordered order_time "
    "source_type source_id"
)
ORDER_DETAIL_INFO = strings(
    "id order_id sku_id sku_name order_price sku_num create_time source_type source_id split_total_amount "
    "split_activity_amount split_coupon_amount"
)
ORDER_INFO = strings(
    "id consignee consignee_tel total_amount order_status user_id payment_way delivery_address order_comment "
    "out_trade_no trade_body create_time operate_time expire_time process_status tracking_no parent_order_id "
    "province_id activity_reduce_amount coupon_reduce_amount original_total_amount feight_fee feight_fee_reduce "
    "refundable_time"
)
DETAIL_ACTIVITY = strings("id order_id order_detail_id activity_id activity_rule_id sku_id create_time")
DETAIL_COUPON = strings("id order_id order_detail_id coupon_id coupon_use_id sku_id create_time")
PAYMENT_INFO = strings("user_id order_id payment_type callback_time")
REFUND_INFO = strings(
    "id user_id order_id sku_id refund_type refund_num refund_amount refund_reason_type refund_reason_txt create_time"
)
REFUND_PAYMENT = strings("id order_id sku_id payment_type callback_time total_amount")
COMMENT_INFO = strings("id user_id sku_id order_id create_time appraise")

# --- fact streams ------------------------------------------------------------
CART_ADD = strings(
    "id user_id sku_id cart_price sku_num sku_name is_checked create_time operate_time is_ordered order_time "
    "source_type_id source_type_name source_id"
)
# 44 fields with `old` (a map) and row_op_ts (a timestamp) after these 42
ORDER_PRE = strings(
    "id order_id sku_id sku_name order_price sku_num create_time source_type_id source_type_name source_id "
    "split_total_amount split_activity_amount split_coupon_amount consignee consignee_tel total_amount order_status "
    "user_id payment_way delivery_address order_comment out_trade_no trade_body operate_time expire_time "
    "process_status tracking_no parent_order_id province_id activity_reduce_amount coupon_reduce_amount "
    "original_total_amount feight_fee feight_fee_reduce refundable_time order_detail_activity_id activity_id "
    "activity_rule_id order_detail_coupon_id coupon_id coupon_use_id type"
)
ORDER_DETAIL = strings(
    "id order_id user_id sku_id sku_name sku_num order_price province_id activity_id activity_rule_id coupon_id "
    "create_time source_id source_type_id source_type_name split_activity_amount split_coupon_amount "
    "split_total_amount"
)
CANCEL_ORDER_DETAIL = strings(
    "id order_id user_id sku_id sku_name province_id activity_id activity_rule_id coupon_id cancel_time source_id "
    "source_type_id source_type_name sku_num order_price split_activity_amount split_coupon_amount split_total_amount"
)
PAY_ORDER_DETAIL = strings(
    "order_detail_id order_id user_id sku_id sku_name province_id activity_id activity_rule_id coupon_id "
    "payment_type_code payment_type_name callback_time source_id source_type_id source_type_name sku_num order_price "
    "split_activity_amount split_coupon_amount split_payment_amount"
)
ORDER_REFUND = strings(
    "id user_id order_id sku_id province_id date_id create_time refund_type_code refund_type_name "
    "refund_reason_type_code refund_reason_type_name refund_reason_txt refund_num refund_amount ts"
)
REFUND_PAY = strings(
    "id user_id order_id sku_id province_id payment_type_code payment_type_name date_id callback_time refund_num "
    "refund_amount ts"
)
COUPON_GET = strings("id coupon_id user_id date_id get_time ts")
COUPON_ORDER = strings("id coupon_id user_id order_id date_id order_time ts")
COUPON_PAY = strings("id coupon_id user_id order_id date_id payment_time ts")
FAVOR_ADD = strings("id user_id sku_id date_id create_time ts")
COMMENT = strings("id user_id sku_id order_id date_id create_time appraise_code appraise_name ts")
USER_REGISTER = strings("user_id date_id create_time ts")

ORDER_PRE_SCHEMA = record(" ".join([*ORDER_PRE, "old:map", "row_op_ts:time"]))
ORDER_DETAIL_SCHEMA = record(" ".join([*ORDER_DETAIL, "row_op_ts:time"]))
PAY_ORDER_DETAIL_SCHEMA = record(" ".join([*PAY_ORDER_DETAIL, "row_op_ts:time"]))

# --- summaries: column order of the stores -----------------------------------
KEYWORD_SUMMARY = strings("stt edt source keyword keyword_count ts")
TRAFFIC_SUMMARY = strings("stt edt vc ch ar isNew uvCt svCt pvCt durSum ujCt ts")
PAGE_VIEW_SUMMARY = strings("stt edt homeUvCt goodDetailUvCt ts")
LOGIN_SUMMARY = strings("stt edt backCt uuCt ts")
REGISTER_SUMMARY = strings("stt edt registerCt ts")
CART_ADD_SUMMARY = strings("stt edt cartAddUuCt ts")
PAYMENT_SUMMARY = strings("stt edt paymentSucUniqueUserCount paymentSucNewUserCount ts")
ORDER_SUMMARY = strings(
    "stt edt orderUniqueUserCount orderNewUserCount orderActivityReduceAmount orderCouponReduceAmount "
    "orderOriginalTotalAmount ts"
)

# --- codes that appear in predicates -----------------------------------------
ORDER_CANCELLED = "1003"
ORDER_REFUND_REQUESTED = "1005"
ORDER_REFUNDED = "1006"
PAYMENT_SUCCEEDED = "1602"
COUPON_RECEIVED = "1401"
COUPON_USED_IN_ORDER = "1402"
REFUND_PAYMENT_DONE = "0702"
REFUND_REQUEST_PAID = "0705"
FAVOUR_ACTIVE = "0"
CHANGE_TYPES = ("insert", "update", "bootstrap-insert")

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"

"""Names of message topics, on Kafka or as folders of JSON lines."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Topic:
    """``servers`` for Kafka, or ``root`` for a folder ``root/name`` of text files."""

    name: str
    servers: str | None = None
    root: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if (self.servers is None) == (self.root is None):
            raise ValueError("a topic is either on servers or under a root folder")

    @property
    def on_kafka(self) -> bool:
        return self.servers is not None

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.name}"


# The topics of the warehouse.
LOG = "topic_log"
CHANGES = "topic_db"
PAGE = "dwd_traffic_page_log"
START = "dwd_traffic_start_log"
DISPLAY = "dwd_traffic_display_log"
ACTION = "dwd_traffic_action_log"
ERROR = "dwd_traffic_error_log"
VISITOR = "dwd_traffic_unique_visitor_detail"
JUMP = "dwd_traffic_user_jump_detail"
CART_ADD = "dwd_trade_cart_add"
ORDER_PRE = "dwd_trade_order_pre_process"
ORDER_DETAIL = "dwd_trade_order_detail"
CANCEL_DETAIL = "dwd_trade_cancel_order_detail"
PAY_DETAIL = "dwd_trade_pay_order_detail_suc"
REFUND = "dwd_trade_order_refund"
REFUND_PAY = "dwd_trade_refund_pay_suc"
COUPON_GET = "dwd_tool_coupon_get"
COUPON_ORDER = "dwd_tool_coupon_order"
COUPON_PAY = "dwd_tool_coupon_pay"
FAVOR_ADD = "dwd_interaction_favor_add"
COMMENT = "dwd_interaction_comment"
REGISTER = "dwd_user_register"
DIRTY = "dirty_log"

LOG_TOPICS = {"page": PAGE, "start": START, "display": DISPLAY, "action": ACTION, "error": ERROR}

"""DuckDB SQL for the queries of the same name, written on the sample tables themselves."""

from __future__ import annotations

from tidemark import schemas as s

# Labels of the codes.
DIC = """dic AS (SELECT * FROM (VALUES
  ('2400','user query'), ('2401','promotion'), ('2402','recommendation'), ('2403','campaign'),
  ('1101','alipay'), ('1102','wechat'), ('1103','unionpay'), ('1104','card'),
  ('1500','refund only'), ('1501','return goods'), ('1300','quality'), ('1301','wrong item'), ('1302','late'),
  ('1201','good')) AS t(code, label))"""

PAGES = """pages_in AS (
  SELECT event_id AS id, cast(user_id AS varchar) AS mid,
    CASE WHEN k % 10 = 0 THEN NULL ELSE cast(user_id AS varchar) END AS uid,
    CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login'
                    WHEN 'purchase' THEN 'trade' ELSE 'mine' END AS page_id,
    CASE WHEN k % 3 = 0 THEN NULL WHEN k % 3 = 1 THEN 'search' ELSE 'login' END AS last_page_id,
    CASE WHEN event_type = 'signup' THEN '1' ELSE '0' END AS is_new,
    concat('v', k % 4) AS vc, concat('ch', k % 3) AS ch, cast(user_id % 5 AS varchar) AS ar,
    cast(round(value * 100) AS bigint) AS during_time,
    (epoch_us(ts) // 1000) AS ts, ts AS tm, cast(ts AS date) AS d
  FROM (SELECT *, cast(regexp_extract(props, '"k": *([0-9]+)', 1) AS int) AS k FROM events) e)"""

FIXED = f"""{PAGES}, fixed AS (
  SELECT * REPLACE (CASE WHEN is_new = '1' AND d <> d0 THEN '0' ELSE is_new END AS is_new) FROM (
    SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE cast(d - INTERVAL 1 DAY AS date) END)
      OVER (PARTITION BY mid ORDER BY ts, id) AS d0 FROM pages_in) p)"""

# The first record decides on is_new after unreadable lines are gone.
LOGS = f"""{PAGES}, readable AS (SELECT * FROM pages_in WHERE id % 97 <> 0), logs AS (
  SELECT * REPLACE (CASE WHEN is_new = '1' AND d <> d0 THEN '0' ELSE is_new END AS is_new) FROM (
    SELECT *, first_value(CASE WHEN is_new = '1' THEN d ELSE cast(d - INTERVAL 1 DAY AS date) END)
      OVER (PARTITION BY mid ORDER BY ts, id) AS d0 FROM readable) p)"""

UV = """uv AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mid, d ORDER BY ts, id) AS rn
  FROM pages_in WHERE last_page_id IS NULL) u WHERE rn = 1)"""


def _jumps(limit_ms: int) -> str:
    return f"""jumps AS (SELECT * FROM (SELECT *, lead(ts) OVER w AS next_ts, lead(last_page_id) OVER w AS next_last
  FROM pages_in WINDOW w AS (PARTITION BY mid ORDER BY ts, id)) j
  WHERE last_page_id IS NULL
    AND NOT (next_ts IS NOT NULL AND next_ts - ts < {limit_ms} AND next_last IS NOT NULL))"""


HOUR = 3_600_000
PAGE_COLUMNS = "id, mid, uid, vc, ch, ar, is_new, page_id, last_page_id, during_time, ts"


def _stt(tm: str) -> str:
    return f"strftime(time_bucket(INTERVAL '10 seconds', {tm}), '%Y-%m-%d %H:%M:%S') AS stt"


def _edt(tm: str) -> str:
    return (
        f"strftime(time_bucket(INTERVAL '10 seconds', {tm}) + INTERVAL '10 seconds', '%Y-%m-%d %H:%M:%S') AS edt"
    )


def _bounds(tm: str) -> str:
    return f"{_stt(tm)}, {_edt(tm)}"


def _text(tm: str) -> str:
    return f"strftime({tm}, '%Y-%m-%d %H:%M:%S')"


def _day(tm: str) -> str:
    return f"strftime({tm}, '%Y-%m-%d')"


def _sec(tm: str) -> str:
    return f"cast(cast(epoch({tm}) AS bigint) AS varchar)"


def _fill(names: list[str], given: dict[str, str]) -> str:
    return ", ".join(f"{given.get(name, 'cast(NULL AS varchar)')} AS {name}" for name in names)


LINES = """lines AS (SELECT *, l_orderkey * 10 + l_linenumber AS id, cast(l_extendedprice AS decimal(18,2)) AS price,
  concat('240', l_linenumber % 5) AS source_type FROM lineitem)"""
ORDER_CHANGES = """order_changes AS (
  SELECT *, 'insert' AS type, '1001' AS status, NULL AS old, o_orderdate AS changed FROM orders
  UNION ALL
  SELECT o.*, 'update', u.status, '{"order_status":"1001"}', o_orderdate + INTERVAL 1 DAY FROM orders o
  JOIN (VALUES ('F','1003'), ('P','1005'), ('P','1006'), ('O','1002')) u(state, status) ON o.o_orderstatus = u.state)"""
ACTIVITY = "SELECT id AS aid FROM lines WHERE l_discount > 0.05"
COUPON = "SELECT id AS cid FROM lines WHERE l_tax > 0.04"
LINE_VALUES = {
    "id": "cast(l.id AS varchar)",
    "order_id": "cast(l_orderkey AS varchar)",
    "sku_id": "cast(l_partkey AS varchar)",
    "order_price": "cast(price AS varchar)",
    "sku_num": "cast(cast(trunc(l_quantity) AS int) AS varchar)",
    "create_time": _text("l_shipdate"),
    "source_type_id": "source_type",
    "source_type_name": "dic.label",
    "split_activity_amount": "CASE WHEN l_discount > 0.05 THEN cast(price * cast(l_discount AS decimal(4,2)) AS varchar) END",
    "split_coupon_amount": "CASE WHEN l_tax > 0.04 THEN cast(price * cast(l_tax AS decimal(4,2)) AS varchar) END",
    "activity_id": "cast(a.aid % 4 AS varchar)",
    "activity_rule_id": "cast(a.aid % 3 AS varchar)",
    "coupon_id": "cast(c.cid % 3 AS varchar)",
    "coupon_use_id": "cast(c.cid % 7 AS varchar)",
    "order_detail_activity_id": "cast(a.aid AS varchar)",
    "order_detail_coupon_id": "cast(c.cid AS varchar)",
    "total_amount": "cast(cast(o_totalprice AS decimal(18,2)) AS varchar)",
    "order_status": "o.status",
    "user_id": "cast(o_custkey AS varchar)",
    "province_id": "cast(o_custkey % 25 AS varchar)",
    "operate_time": f"CASE WHEN o.type = 'update' THEN {_text('changed')} END",
    "type": "o.type",
    "old": "o.old",
}
PRE = f"""{DIC}, {LINES}, {ORDER_CHANGES}, pre AS (
  SELECT {_fill([*s.ORDER_PRE, "old"], LINE_VALUES)}, o.changed
  FROM lines l JOIN dic ON l.source_type = dic.code
  JOIN order_changes o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN ({ACTIVITY}) a ON l.id = a.aid
  LEFT JOIN ({COUPON}) c ON l.id = c.cid)"""
PLACED = f"{PRE}, placed AS (SELECT {', '.join(s.ORDER_DETAIL)}, changed FROM pre WHERE type = 'insert')"
PAY_COLUMNS = {
    "order_detail_id": "p.id",
    "payment_type_code": "pay.payment_type",
    "payment_type_name": "d.label",
    "callback_time": _text("pay.o_orderdate"),
    "split_payment_amount": "p.split_total_amount",
}
PAID = f"""{PLACED}, paid AS (
  SELECT {", ".join(f"{PAY_COLUMNS.get(n, f'p.{n}')} AS {n}" for n in s.PAY_ORDER_DETAIL)}, p.changed, pay.o_orderdate AS tm
  FROM placed p
  JOIN (SELECT cast(o_orderkey AS varchar) AS order_id, concat('110', substr(o_orderpriority, 1, 1)) AS payment_type,
          o_orderdate FROM orders WHERE o_orderstatus = 'O') pay ON p.order_id = pay.order_id
  JOIN dic d ON pay.payment_type = d.code)"""

CART = f"""{DIC}, carts AS (
  SELECT *, cast(trunc(value) AS int) % 7 AS num, concat('240', event_id % 5) AS source_type
  FROM events WHERE event_type = 'purchase'), cart AS (
  SELECT {_fill(s.CART_ADD, {
    "id": "cast(event_id AS varchar)",
    "user_id": "cast(user_id AS varchar)",
    "sku_num": "CASE WHEN event_id % 2 = 0 THEN cast(num AS varchar) ELSE cast(num - event_id % 5 AS varchar) END",
    "create_time": _text("ts"),
    "source_type_id": "source_type",
    "source_type_name": "dic.label",
  })}, ts AS tm
  FROM carts JOIN dic ON source_type = dic.code
  WHERE event_id % 2 = 0 OR (event_id % 3 <> 0 AND num > event_id % 5))"""


def _coupon(kind: str, hours: int, where: str) -> str:
    tm = f"o_orderdate + INTERVAL {hours} HOUR"
    return f"""SELECT cast(o_orderkey AS varchar) AS id, cast(o_custkey % 3 AS varchar) AS coupon_id,
  cast(o_custkey AS varchar) AS user_id, cast(o_orderkey AS varchar) AS order_id, {_day(tm)} AS date_id,
  {_text(tm)} AS {kind}, {_sec(tm)} AS ts FROM orders WHERE {where}"""


JOIN_INPUT = """clicks AS (SELECT user_id AS id, event_id AS click_id, ts AS pt FROM events WHERE event_type = 'click'),
buys AS (SELECT user_id AS id, event_id AS purchase_id, ts AS pt FROM events WHERE event_type = 'purchase')"""


def _interval_join(kind: str) -> str:
    return f"""WITH {JOIN_INPUT}
SELECT coalesce(l.id, r.id) AS id, click_id, purchase_id, epoch_us(coalesce(l.pt, r.pt)) // 1000 AS pt_ms
FROM clicks l {kind} JOIN buys r
  ON l.id = r.id AND l.pt BETWEEN r.pt - INTERVAL 1 HOUR AND r.pt + INTERVAL 1 HOUR"""


REGISTERED = "TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey * 3)"

ORACLES: dict[str, str] = {
    "dwd_unique_visitor": f"WITH {PAGES}, {UV} SELECT {PAGE_COLUMNS} FROM uv",
    "dwd_user_jump": f"WITH {PAGES}, {_jumps(HOUR)} SELECT {PAGE_COLUMNS} FROM jumps",
    "dwd_user_jump_10s": f"WITH {PAGES}, {_jumps(10_000)} SELECT {PAGE_COLUMNS} FROM jumps",
    "dwd_log_is_new_fix": f"WITH {FIXED} SELECT id, mid, is_new FROM fixed",
    "dwd_log_split_counts": f"""WITH {LOGS}
SELECT 'dirty' AS tag, count(*) AS cnt FROM pages_in WHERE id % 97 = 0
UNION ALL SELECT 'error', count(*) FROM logs WHERE page_id = 'mine'
UNION ALL SELECT 'start', count(*) FROM logs WHERE id % 50 = 0
UNION ALL SELECT 'display', cast(sum(id % 4) AS bigint) FROM logs WHERE id % 50 <> 0
UNION ALL SELECT 'action', cast(sum(id % 3) AS bigint) FROM logs WHERE id % 50 <> 0
UNION ALL SELECT 'page', count(*) FROM logs WHERE id % 50 <> 0""",
    "dwd_log_page": f"""WITH {LOGS} SELECT mid, is_new, page_id, concat(page_id, ' ', ch) AS item, during_time, ts
FROM logs WHERE id % 50 <> 0""",
    "dwd_log_start": f"""WITH {LOGS} SELECT mid, is_new, 'icon' AS entry, ts FROM logs WHERE id % 50 = 0""",
    "dwd_log_display": f"""WITH {LOGS} SELECT mid, page_id, cast(i AS varchar) AS item, ts
FROM logs JOIN generate_series(1, 3) g(i) ON i <= id % 4 WHERE id % 50 <> 0""",
    "dwd_log_action": f"""WITH {LOGS} SELECT mid, page_id, cast(i AS varchar) AS action_id, ts + i AS ts
FROM logs JOIN generate_series(1, 2) g(i) ON i <= id % 3 WHERE id % 50 <> 0""",
    "dwd_log_error": f"""WITH {LOGS} SELECT mid, CASE WHEN id % 50 <> 0 THEN page_id END AS page_id,
  cast(1001 AS bigint) AS error_code, ts FROM logs WHERE page_id = 'mine'""",
    "dwd_log_dirty": f"WITH {PAGES} SELECT 'not json' AS value FROM pages_in WHERE id % 97 = 0",
    "dwd_cart_add": f"WITH {CART} SELECT {', '.join(s.CART_ADD)} FROM cart",
    "dwd_order_pre_process": f"WITH {PRE} SELECT {', '.join(s.ORDER_PRE)}, old FROM pre",
    "dwd_order_pre_process_latest": f"""WITH {PRE} SELECT {', '.join(s.ORDER_PRE)}, old FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed DESC, order_status DESC NULLS LAST,
    create_time DESC NULLS LAST, sku_id DESC NULLS LAST, sku_num DESC NULLS LAST, order_price DESC NULLS LAST,
    split_activity_amount DESC NULLS LAST, split_coupon_amount DESC NULLS LAST) AS rn FROM pre) p WHERE rn = 1""",
    "dwd_order_detail": f"WITH {PLACED} SELECT {', '.join(s.ORDER_DETAIL)} FROM placed",
    "dwd_order_detail_first_wins": f"""WITH {PLACED}, firsts AS (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY changed, create_time, sku_id, sku_num, order_price,
    split_activity_amount NULLS FIRST, split_coupon_amount NULLS FIRST) AS rn FROM placed)
SELECT id, create_time, sku_id, sku_num, order_price, split_activity_amount, split_coupon_amount FROM firsts
WHERE rn = 1""",
    "dwd_cancel_order_detail": f"""WITH {PRE}
SELECT {', '.join('operate_time AS cancel_time' if n == 'cancel_time' else n for n in s.CANCEL_ORDER_DETAIL)} FROM pre
WHERE type = 'update' AND order_status = '1003'""",
    "dwd_pay_order_detail": f"WITH {PAID} SELECT {', '.join(s.PAY_ORDER_DETAIL)} FROM paid",
    "dwd_pay_detail_latest_wins": f"""WITH {PAID}, latest AS (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY changed DESC, sku_id DESC, sku_num DESC,
    order_price DESC) AS rn FROM paid)
SELECT order_detail_id, user_id, callback_time, sku_id, sku_num, order_price FROM latest WHERE rn = 1""",
    "dwd_order_refund": f"""WITH {DIC}, {LINES}, refunds AS (
  SELECT *, concat('150', l_linenumber % 3) AS rt, concat('130', l_suppkey % 4) AS rr FROM lines WHERE l_returnflag = 'R')
SELECT {_fill(s.ORDER_REFUND, {
    "id": "cast(l.id AS varchar)",
    "order_id": "cast(l_orderkey AS varchar)",
    "sku_id": "cast(l_partkey AS varchar)",
    "province_id": "cast(o_custkey % 25 AS varchar)",
    "date_id": _day("l_shipdate"),
    "create_time": _text("l_shipdate"),
    "refund_type_code": "rt",
    "refund_type_name": "t.label",
    "refund_reason_type_code": "rr",
    "refund_reason_type_name": "r.label",
    "refund_num": "cast(cast(trunc(l_quantity) AS int) AS varchar)",
    "ts": _sec("l_shipdate"),
})}
FROM refunds l JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'P'
JOIN dic t ON rt = t.code JOIN dic r ON rr = r.code""",
    "dwd_refund_pay": f"""WITH {DIC}, {LINES}, refunds AS (
  SELECT *, concat('110', l_linenumber % 5 + 1) AS pt FROM lines WHERE l_returnflag = 'R')
SELECT {_fill(s.REFUND_PAY, {
    "id": "cast(l.id AS varchar)",
    "user_id": "cast(o_custkey AS varchar)",
    "order_id": "cast(l.l_orderkey AS varchar)",
    "sku_id": "cast(l.l_partkey AS varchar)",
    "province_id": "cast(o_custkey % 25 AS varchar)",
    "payment_type_code": "l.pt",
    "payment_type_name": "dic.label",
    "date_id": _day("l.l_shipdate"),
    "callback_time": _text("l.l_shipdate"),
    "refund_num": "cast(cast(trunc(r.l_quantity) AS int) AS varchar)",
    "refund_amount": "cast(l.price AS varchar)",
    "ts": _sec("l.l_shipdate"),
})}
FROM refunds l JOIN orders ON l.l_orderkey = o_orderkey AND o_orderstatus = 'P'
JOIN refunds r ON l.l_orderkey = r.l_orderkey AND l.l_partkey = r.l_partkey JOIN dic ON l.pt = dic.code""",
    "dwd_coupon_get": f"SELECT {', '.join(s.COUPON_GET)} FROM ({_coupon('get_time', 0, 'true')}) c",
    "dwd_coupon_order": _coupon("order_time", 1, "o_orderstatus <> 'F'"),
    "dwd_coupon_pay": _coupon("payment_time", 2, "o_orderstatus = 'O'"),
    "dwd_favor_add": f"""SELECT cast(event_id AS varchar) AS id, cast(user_id AS varchar) AS user_id,
  cast(event_id % 50 AS varchar) AS sku_id, {_day('ts')} AS date_id, {_text('ts')} AS create_time,
  cast(epoch_us(ts) // 1000000 AS varchar) AS ts FROM events
WHERE event_type = 'click' AND (event_id % 2 = 0 OR event_id % 3 % 2 = 0)""",
    "dwd_comment": f"""WITH {DIC}, remarks AS (
  SELECT *, concat('120', event_id % 3 + 1) AS appraise FROM events WHERE event_type = 'error')
SELECT cast(event_id AS varchar) AS id, cast(user_id AS varchar) AS user_id, cast(event_id % 50 AS varchar) AS sku_id,
  cast(event_id AS varchar) AS order_id, {_day('ts')} AS date_id, {_text('ts')} AS create_time,
  appraise AS appraise_code, label AS appraise_name, cast(epoch_us(ts) // 1000000 AS varchar) AS ts
FROM remarks JOIN dic ON appraise = code""",
    "dwd_user_register": f"""SELECT cast(c_custkey AS varchar) AS user_id, {_day(REGISTERED)} AS date_id,
  {_text(REGISTERED)} AS create_time, {_sec(REGISTERED)} AS ts FROM customer""",
    "dws_keyword_window": f"""WITH {PAGES}, words AS (
  SELECT unnest(regexp_extract_all(lower(concat(page_id, ' ', ch)), '[\\p{{L}}\\p{{N}}]+')) AS keyword, tm
  FROM pages_in WHERE last_page_id = 'search' AND id % 2 = 0)
SELECT {_bounds('tm')}, 'search' AS source, keyword, count(*) AS keyword_count FROM words GROUP BY ALL""",
    "dws_traffic_window": f"""WITH {PAGES}, {UV}, {_jumps(HOUR)}, measures AS (
  SELECT tm, vc, ch, ar, is_new, 1 AS u, 0 AS s, 0 AS p, 0 AS d, 0 AS j FROM uv
  UNION ALL SELECT tm, vc, ch, ar, is_new, 0, 0, 0, 0, 1 FROM jumps
  UNION ALL SELECT tm, vc, ch, ar, is_new, 0, CASE WHEN last_page_id IS NULL THEN 1 ELSE 0 END, 1, during_time, 0
  FROM pages_in)
SELECT {_bounds('tm')}, vc, ch, ar, is_new AS "isNew", cast(sum(u) AS bigint) AS "uvCt", cast(sum(s) AS bigint) AS "svCt",
  cast(sum(p) AS bigint) AS "pvCt", cast(sum(d) AS bigint) AS "durSum", cast(sum(j) AS bigint) AS "ujCt"
FROM measures GROUP BY ALL""",
    "dws_page_view_window": f"""WITH {PAGES}, seen AS (
  SELECT *, row_number() OVER (PARTITION BY mid, page_id, d ORDER BY ts, id) AS rn FROM pages_in
  WHERE page_id IN ('home', 'good_detail'))
SELECT {_bounds('tm')}, cast(sum(CASE WHEN page_id = 'home' THEN 1 ELSE 0 END) AS bigint) AS "homeUvCt",
  cast(sum(CASE WHEN page_id = 'good_detail' THEN 1 ELSE 0 END) AS bigint) AS "goodDetailUvCt"
FROM seen WHERE rn = 1 GROUP BY ALL""",
    "dws_login_window": f"""WITH {PAGES}, days AS (
  SELECT *, lag(d) OVER (PARTITION BY uid ORDER BY d) AS last_d FROM (
    SELECT *, row_number() OVER (PARTITION BY uid, d ORDER BY ts, id) AS rn FROM pages_in
    WHERE uid IS NOT NULL AND (last_page_id IS NULL OR last_page_id = 'login')) l WHERE rn = 1)
SELECT {_bounds('tm')}, cast(sum(CASE WHEN date_diff('day', last_d, d) >= 8 THEN 1 ELSE 0 END) AS bigint) AS "backCt",
  count(*) AS "uuCt" FROM days GROUP BY ALL""",
    "dws_register_window": f"""SELECT {_bounds(REGISTERED)}, count(*) AS "registerCt" FROM customer GROUP BY ALL""",
    "dws_cart_add_window": f"""WITH {CART}, users AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, cast(tm AS date) ORDER BY tm) AS rn FROM cart)
SELECT {_bounds('tm')}, count(*) AS "cartAddUuCt" FROM users WHERE rn = 1 GROUP BY ALL""",
    "dws_payment_window": f"""WITH {PAID}, latest AS (
  SELECT *, row_number() OVER (PARTITION BY order_detail_id ORDER BY changed DESC, callback_time DESC) AS rn FROM paid),
payers AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, cast(tm AS date) ORDER BY tm, order_detail_id) AS of_day,
    row_number() OVER (PARTITION BY user_id ORDER BY tm, order_detail_id) AS ever FROM latest WHERE rn = 1)
SELECT {_bounds('tm')}, count(*) AS "paymentSucUniqueUserCount",
  cast(sum(CASE WHEN ever = 1 THEN 1 ELSE 0 END) AS bigint) AS "paymentSucNewUserCount"
FROM payers WHERE of_day = 1 GROUP BY ALL""",
    "dws_order_window": f"""WITH {PLACED}, firsts AS (
  SELECT *, strptime(create_time, '%Y-%m-%d %H:%M:%S') AS tm,
    row_number() OVER (PARTITION BY id ORDER BY changed, create_time, sku_id, sku_num, order_price,
      split_activity_amount NULLS FIRST, split_coupon_amount NULLS FIRST) AS rn FROM placed),
buyers AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, cast(tm AS date) ORDER BY tm, id) AS of_day,
    row_number() OVER (PARTITION BY user_id ORDER BY tm, id) AS ever FROM firsts WHERE rn = 1)
SELECT {_bounds('tm')}, cast(sum(CASE WHEN of_day = 1 THEN 1 ELSE 0 END) AS bigint) AS "orderUniqueUserCount",
  cast(sum(CASE WHEN ever = 1 THEN 1 ELSE 0 END) AS bigint) AS "orderNewUserCount",
  cast(sum(coalesce(cast(split_activity_amount AS decimal(18,4)), 0)) AS double) AS "orderActivityReduceAmount",
  cast(sum(coalesce(cast(split_coupon_amount AS decimal(18,4)), 0)) AS double) AS "orderCouponReduceAmount",
  cast(sum(cast(sku_num AS int) * cast(order_price AS decimal(18,4))) AS double) AS "orderOriginalTotalAmount"
FROM buyers GROUP BY ALL""",
    "dim_route": f"""WITH {ORDER_CHANGES}
SELECT 'order_info' AS "table", type, {_sec('changed')} AS ts, 'dim_order_info' AS sink_table,
  concat('{{"id":"', o_orderkey, '","user_id":"', o_custkey, '","order_status":"', status, '"}}') AS data FROM order_changes
UNION ALL
SELECT 'user_info', 'insert', {_sec(REGISTERED)}, 'dim_user_info',
  concat('{{"id":"', c_custkey, '","name":"', c_name, '"}}') FROM customer""",
    "dim_user_info": "SELECT cast(c_custkey AS varchar) AS id, c_name AS name FROM customer",
    "dim_order_info": f"""WITH {ORDER_CHANGES} SELECT cast(o_orderkey AS varchar) AS id,
  cast(o_custkey AS varchar) AS user_id, status AS order_status FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY changed DESC, status DESC) AS rn FROM order_changes) o
WHERE rn = 1""",
    "stream_join_inner": _interval_join("INNER"),
    "stream_join_left": _interval_join("LEFT"),
    "stream_join_right": _interval_join("RIGHT"),
    "stream_join_full": _interval_join("FULL"),
    "stream_join_chain": """SELECT o_custkey AS id, o_totalprice AS vc, c_name AS name2, s_name AS name3
FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN supplier ON o_custkey = s_suppkey""",
    "table_change_counts": """WITH e AS (SELECT * FROM events), l AS (SELECT * FROM lineitem), o AS (SELECT * FROM orders)
SELECT 'order_info' AS "table", (SELECT count(*) FROM o)
  + (SELECT cast(sum(CASE o_orderstatus WHEN 'P' THEN 2 WHEN 'F' THEN 1 WHEN 'O' THEN 1 ELSE 0 END) AS bigint) FROM o) AS cnt
UNION ALL SELECT 'order_detail', count(*) FROM l
UNION ALL SELECT 'order_detail_activity', count(*) FROM l WHERE l_discount > 0.05
UNION ALL SELECT 'order_detail_coupon', count(*) FROM l WHERE l_tax > 0.04
UNION ALL SELECT 'order_refund_info', count(*) FROM l WHERE l_returnflag = 'R'
UNION ALL SELECT 'refund_payment', count(*) FROM l WHERE l_returnflag = 'R'
UNION ALL SELECT 'payment_info', count(*) FROM o WHERE o_orderstatus = 'O'
UNION ALL SELECT 'coupon_use', (SELECT count(*) FROM o) + (SELECT count(*) FROM o WHERE o_orderstatus <> 'F')
  + (SELECT count(*) FROM o WHERE o_orderstatus = 'O')
UNION ALL SELECT 'cart_info', count(*) FROM e WHERE event_type = 'purchase'
UNION ALL SELECT 'favor_info', count(*) FROM e WHERE event_type = 'click'
UNION ALL SELECT 'comment_info', count(*) FROM e WHERE event_type = 'error'
UNION ALL SELECT 'user_info', count(*) FROM customer""",
    "keyword_texts": r"""SELECT source, keyword, count(*) AS keyword_count FROM (
  SELECT lang AS source, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS keyword FROM documents) w
GROUP BY ALL""",
    "time_functions": f"""SELECT o_orderkey AS id, {_text('o_orderdate')} AS time_text, {_day('o_orderdate')} AS day_text,
  {_day('o_orderdate')} AS first_token, epoch_ms(o_orderdate) AS millis,
  {_text('epoch_ms(epoch_ms(o_orderdate) + o_custkey)')} AS from_millis,
  {_text('epoch_ms(epoch_ms(o_orderdate) + o_custkey * 7)')} AS in_seconds, cast(o_orderkey % 12 AS int) AS day_gap
FROM orders""",
    "op_time_compare": """SELECT event_id AS id, cast(sign(
  cast(rpad(cast(event_id % 1000 AS varchar), 3, '0') AS int) - cast(rpad(cast(user_id % 100 AS varchar), 3, '0') AS int)
  ) AS int) AS sign FROM events""",
}
ORACLES["stream_unique_visitor"] = ORACLES["dwd_unique_visitor"]
ORACLES["stream_log_is_new_fix"] = ORACLES["dwd_log_is_new_fix"]
# Streams, split stores and loads give what the bounded forms give.
ORACLES |= {
    "split_log_counts": ORACLES["dwd_log_split_counts"],
    "split_log_page": ORACLES["dwd_log_page"],
    "split_table_counts": ORACLES["table_change_counts"],
    "split_cart_add": ORACLES["dwd_cart_add"],
    "split_order_refund": ORACLES["dwd_order_refund"],
    "split_refund_pay": ORACLES["dwd_refund_pay"],
    "dim_order_loads": ORACLES["dim_order_info"],
    "batched_join_inner": ORACLES["stream_join_inner"],
    "batched_join_left": ORACLES["stream_join_left"],
    "batched_join_right": ORACLES["stream_join_right"],
    "batched_join_full": ORACLES["stream_join_full"],
    "batched_user_jump": ORACLES["dwd_user_jump"],
    "batched_first_wins": ORACLES["dwd_order_detail_first_wins"],
    "batched_latest_wins": ORACLES["dwd_pay_detail_latest_wins"],
}
# Until June 1997 the route has no status, from September 1998 to 1999 there is none, then it has no user.
ORACLES["dim_live_routes"] = f"""WITH {ORDER_CHANGES}, routed AS (
  SELECT cast(o_orderkey AS varchar) AS id, changed, status,
    CASE WHEN changed < DATE '1998-09-01' THEN cast(o_custkey AS varchar) END AS user_id,
    CASE WHEN changed >= DATE '1997-06-01' THEN status END AS order_status,
    CASE WHEN changed >= DATE '2000-01-01' THEN cast(cast(o_totalprice AS decimal(18, 2)) AS varchar) END AS total_amount
  FROM order_changes WHERE changed < DATE '1998-09-01' OR changed >= DATE '2000-01-01')
SELECT id, max(user_id) AS user_id, arg_max(order_status, (changed, status)) FILTER (order_status IS NOT NULL) AS order_status,
  max(total_amount) AS total_amount FROM routed GROUP BY id"""


def _in_scripts() -> str:
    from stream_queries import LATIN, SCRIPTS
    from tidemark.functions.texts import PAIRED

    paired = PAIRED.replace("\\x{20000}-\\x{3FFFF}", "")
    paired = "".join("\\x{" + part[:4] + "}" + part[4:] for part in paired.split("\\u")[1:])
    cases = " ".join(f"WHEN {n} THEN translate(text, '{LATIN}', '{letters}')" for n, letters in enumerate(SCRIPTS, 1))
    return f"""WITH texts AS (SELECT lang, CASE doc_id % 4 {cases} ELSE text END AS item FROM documents),
runs AS (
  SELECT lang, item, regexp_extract_all(regexp_replace(lower(item), '([{paired}]+)', ' \\1 ', 'g'), '[\\p{{L}}\\p{{N}}]+') AS found
  FROM texts WHERE item IS NOT NULL),
cut AS (
  SELECT lang, CASE WHEN len(found) = 0 THEN [item] ELSE flatten(list_transform(found, lambda w:
    CASE WHEN regexp_matches(w, '^[{paired}]') AND len(w) > 2 THEN list_transform(range(1, len(w)), lambda i: substr(w, i, 2)) ELSE [w] END))
    END AS words FROM runs)
SELECT lang AS source, keyword, count(*) AS keyword_count FROM (SELECT lang, unnest(words) AS keyword FROM cut) w GROUP BY ALL"""


ORACLES["keyword_scripts"] = _in_scripts()
ORACLES["lookup_needed"] = "SELECT l_orderkey, l_partkey, p_name AS part FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber = 7"

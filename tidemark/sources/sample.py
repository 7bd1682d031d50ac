"""The warehouse's input streams derived from the sample tables.

The sample tables are a small star schema and an ``events`` stream; these
functions give their rows the shape of change records, page logs and raw logs.
They are lazy projections, so filters and column choices of the jobs reach the
parquet scan.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# Labels of the codes; 2404, 1105, 1502 and 1303 have none on purpose.
DICTIONARY = [
    ("2400", "user query"), ("2401", "promotion"), ("2402", "recommendation"), ("2403", "campaign"),
    ("1101", "alipay"), ("1102", "wechat"), ("1103", "unionpay"), ("1104", "card"),
    ("1500", "refund only"), ("1501", "return goods"),
    ("1300", "quality"), ("1301", "wrong item"), ("1302", "late"),
    ("1201", "good"),
]
# The routing configuration.
ROUTES = [
    ("user_info", "dim_user_info", "id,name", "id", ""),
    ("order_info", "dim_order_info", "id,user_id,order_status", "id", ""),
]


# A file of one row group is read by one task, whatever its size on disk.  Inputs between these sizes are dealt
# out to all cores; larger ones come in enough pieces and are read as they are, without this shuffle.
SPREAD_FROM = 1 << 20
SPREAD_PER_CORE = 32 << 20
# Joins and sorts of larger inputs begin with a partition for so many bytes on disk, so that none has to be spilled;
# adaptive execution joins those that turn out small.
PARTITION_BYTES = 4 << 20
PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def table(spark: SparkSession, sf_dir: str, name: str, streaming: bool = False) -> DataFrame:
    """A sample table; its timestamps carry no zone and are read as session time."""
    path = f"{sf_dir}/{name}.parquet"
    rows = spark.read.parquet(path)
    if streaming:
        # a pattern, because a stream takes a plain path for a folder, and the table may be a single file
        rows = spark.readStream.schema(rows.schema).parquet(f"{sf_dir}/{name}.parque[t]")
    else:
        cores = spark.sparkContext.defaultParallelism
        size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        if SPREAD_FROM <= size < SPREAD_PER_CORE * cores and len(rows.inputFiles()) < cores:
            rows = rows.repartition(cores)
        usual = spark.conf.get(PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
        if size // PARTITION_BYTES > int(usual):
            spark.conf.set(PARTITIONS, str(size // PARTITION_BYTES))
    zoned = {f.name: F.col(f.name).cast("timestamp") for f in rows.schema if f.dataType.typeName() == "timestamp_ntz"}
    return rows.withColumns(zoned) if zoned else rows


def _values(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    # literal rows, whose exact size the planner knows when it picks the join
    literals = ", ".join("(" + ", ".join(f"'{value}'" for value in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {literals} AS t({', '.join(names)})")


def dictionary(spark: SparkSession) -> DataFrame:
    return _values(spark, DICTIONARY, ["dic_code", "dic_name"])


def routes(spark: SparkSession) -> DataFrame:
    return _values(spark, ROUTES, ["source_table", "sink_table", "sink_columns", "sink_pk", "sink_extend"])


TIME = "'yyyy-MM-dd HH:mm:ss'"


def _payload(**fields: str) -> str:
    return "map(" + ", ".join(f"'{name}', {value}" for name, value in fields.items()) + ")"


def _change(rows: DataFrame, name: str, kind: str, at: str, data: str, old: str = "NULL") -> DataFrame:
    return rows.selectExpr(
        "'shop' AS database",
        f"'{name}' AS table",
        f"{kind} AS type",
        f"string(unix_timestamp({at})) AS ts",
        f"{data} AS data",
        f"CAST({old} AS map<string,string>) AS old",
    )


INSERT, UPDATE = "'insert'", "'update'"


def changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All change records: ``database``, ``table``, ``type``, ``ts``, ``data``, ``old``."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    lines = table(spark, sf_dir, "lineitem").withColumn("id", F.expr("l_orderkey * 10 + l_linenumber"))
    parts = [
        *_order_changes(orders),
        *_line_changes(lines),
        *_coupon_changes(orders),
        *_event_changes(events),
        _customer_changes(table(spark, sf_dir, "customer")),
    ]
    return reduce(DataFrame.unionByName, parts).withColumn("pt", F.current_timestamp())


def _order_changes(orders: DataFrame) -> list[DataFrame]:
    placed, changed = "o_orderdate", "o_orderdate + INTERVAL 1 DAY"

    def info(status: str, **more: str) -> str:
        return _payload(
            id="string(o_orderkey)",
            user_id="string(o_custkey)",
            order_status=status,
            total_amount="string(CAST(o_totalprice AS decimal(18,2)))",
            province_id="string(o_custkey % 25)",
            create_time=f"date_format({placed}, {TIME})",
            **more,
        )

    updates = orders.withColumn(
        "status",
        F.expr(
            "explode(CASE o_orderstatus WHEN 'F' THEN array('1003') WHEN 'P' THEN array('1005', '1006') "
            "WHEN 'O' THEN array('1002') END)"
        ),
    )
    paid = _payload(
        order_id="string(o_orderkey)",
        user_id="string(o_custkey)",
        payment_status="'1602'",
        payment_type="concat('110', substr(o_orderpriority, 1, 1))",
        callback_time=f"date_format({placed}, {TIME})",
    )
    updated = info("status", operate_time=f"date_format({changed}, {TIME})")
    return [
        _change(orders, "order_info", INSERT, placed, info("'1001'")),
        _change(updates, "order_info", UPDATE, changed, updated, "map('order_status', '1001')"),
        _change(
            orders.filter("o_orderstatus = 'O'"), "payment_info", UPDATE, placed, paid, "map('payment_status', '1601')"
        ),
    ]


def _line_changes(lines: DataFrame) -> list[DataFrame]:
    shipped, price = "l_shipdate", "CAST(l_extendedprice AS decimal(18,2))"
    reduced, couponed = "l_discount > 0.05", "l_tax > 0.04"
    number, time = "string(CAST(l_quantity AS int))", f"date_format({shipped}, {TIME})"
    keys = dict(id="string(id)", order_id="string(l_orderkey)", sku_id="string(l_partkey)")
    detail = _payload(
        **keys,
        sku_num=number,
        order_price=f"string({price})",
        create_time=time,
        source_type="concat('240', string(l_linenumber % 5))",
        split_activity_amount=f"CASE WHEN {reduced} THEN string({price} * CAST(l_discount AS decimal(4,2))) END",
        split_coupon_amount=f"CASE WHEN {couponed} THEN string({price} * CAST(l_tax AS decimal(4,2))) END",
    )
    activity = _payload(
        **keys, order_detail_id="string(id)", activity_id="string(id % 4)", activity_rule_id="string(id % 3)"
    )
    coupon = _payload(**keys, order_detail_id="string(id)", coupon_id="string(id % 3)", coupon_use_id="string(id % 7)")
    request = _payload(
        **keys,
        refund_num=number,
        refund_type="concat('150', string(l_linenumber % 3))",
        refund_reason_type="concat('130', string(l_suppkey % 4))",
        create_time=time,
    )
    refund = _payload(
        **keys,
        payment_type="concat('110', string(l_linenumber % 5 + 1))",
        total_amount=f"string({price})",
        callback_time=time,
    )
    returned = lines.filter("l_returnflag = 'R'")
    return [
        _change(lines, "order_detail", INSERT, shipped, detail),
        _change(lines.filter(reduced), "order_detail_activity", INSERT, shipped, activity),
        _change(lines.filter(couponed), "order_detail_coupon", INSERT, shipped, coupon),
        _change(returned, "order_refund_info", INSERT, shipped, request),
        _change(returned, "refund_payment", INSERT, shipped, refund),
    ]


def _coupon_changes(orders: DataFrame) -> list[DataFrame]:
    got, using, used = "o_orderdate", "o_orderdate + INTERVAL 1 HOUR", "o_orderdate + INTERVAL 2 HOURS"
    keys = dict(id="string(o_orderkey)", coupon_id="string(o_custkey % 3)", user_id="string(o_custkey)")
    order = dict(order_id="string(o_orderkey)")
    received = _payload(**keys, coupon_status="'1401'", get_time=f"date_format({got}, {TIME})")
    ordered = _payload(**keys, **order, coupon_status="'1402'", using_time=f"date_format({using}, {TIME})")
    paid = _payload(**keys, **order, coupon_status="'1403'", used_time=f"date_format({used}, {TIME})")
    later, last = orders.filter("o_orderstatus <> 'F'"), orders.filter("o_orderstatus = 'O'")
    return [
        _change(orders, "coupon_use", INSERT, got, received),
        _change(later, "coupon_use", UPDATE, using, ordered, "map('coupon_status', '1401')"),
        _change(last, "coupon_use", UPDATE, used, paid, "map('coupon_status', '1402')"),
    ]


def _event_changes(events: DataFrame) -> list[DataFrame]:
    kind, time = f"if(event_id % 2 = 0, {INSERT}, {UPDATE})", f"date_format(ts, {TIME})"
    keys = dict(id="string(event_id)", user_id="string(user_id)")
    cart = _payload(
        **keys,
        sku_num="string(CAST(value AS int) % 7)",
        source_type="concat('240', string(event_id % 5))",
        create_time=time,
    )
    before = (
        "CASE WHEN event_id % 2 = 0 THEN NULL WHEN event_id % 3 = 0 THEN map('is_checked', '1') "
        "ELSE map('sku_num', string(event_id % 5)) END"
    )
    item = dict(sku_id="string(event_id % 50)", create_time=time)
    favour = _payload(**keys, **item, is_cancel="string(event_id % 3 % 2)")
    remark = _payload(
        **keys, **item, order_id="string(event_id)", appraise="concat('120', string(event_id % 3 + 1))"
    )
    return [
        _change(events.filter("event_type = 'purchase'"), "cart_info", kind, "ts", cart, before),
        _change(events.filter("event_type = 'click'"), "favor_info", kind, "ts", favour),
        _change(events.filter("event_type = 'error'"), "comment_info", INSERT, "ts", remark),
    ]


def _customer_changes(customers: DataFrame) -> DataFrame:
    since = "timestamp_seconds(unix_timestamp(timestamp'2024-01-01 00:00:00') + c_custkey * 3)"
    info = _payload(id="string(c_custkey)", name="c_name", create_time=f"date_format({since}, {TIME})")
    return _change(customers, "user_info", INSERT, since, info)


def page_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-log records: ``common``, ``page``, ``ts`` and ``seq``, the event number."""
    return pages_of(table(spark, sf_dir, "events"))


def pages_of(events: DataFrame) -> DataFrame:
    """Events in the shape of page-log records."""
    page_id = (
        "CASE event_type WHEN 'view' THEN 'home' WHEN 'click' THEN 'good_detail' WHEN 'signup' THEN 'login' "
        "WHEN 'purchase' THEN 'trade' ELSE 'mine' END"
    )
    events = events.selectExpr(
        "*", "int(get_json_object(props, '$.k')) AS k", f"{page_id} AS page_id"
    )
    return events.selectExpr(
        "struct(string(user_id % 5) AS ar, concat('ch', string(k % 3)) AS ch, "
        "if(event_type = 'signup', '1', '0') AS is_new, string(user_id) AS mid, "
        "if(k % 10 <> 0, string(user_id), NULL) AS uid, concat('v', string(k % 4)) AS vc) AS common",
        "struct(bigint(round(value * 100)) AS during_time, concat(page_id, ' ch', string(k % 3)) AS item, "
        "if(event_id % 2 = 0, 'keyword', 'sku_ids') AS item_type, "
        "CASE k % 3 WHEN 1 THEN 'search' WHEN 2 THEN 'login' END AS last_page_id, page_id) AS page",
        "unix_millis(ts) AS ts",
        "event_id AS seq",
    )


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw log lines (``value``, ``seq``) with launches, displays, actions, errors and unreadable text."""
    line = (
        "to_json(struct(common, "
        "CASE WHEN seq % 50 = 0 THEN struct('icon' AS entry) END AS start, "
        "CASE WHEN seq % 50 <> 0 THEN page END AS page, "
        "CASE WHEN seq % 4 > 0 THEN transform(sequence(1, int(seq % 4)), i -> struct(string(i) AS item)) END AS displays, "
        "CASE WHEN seq % 3 > 0 THEN transform(sequence(1, int(seq % 3)), "
        "i -> struct(string(i) AS action_id, ts + i AS ts)) END AS actions, "
        "CASE WHEN page.page_id = 'mine' THEN struct(1001 AS error_code) END AS err, ts))"
    )
    return page_log(spark, sf_dir).selectExpr(f"if(seq % 97 = 0, 'not json', {line}) AS value", "seq")

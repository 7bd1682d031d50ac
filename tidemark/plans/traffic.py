"""Page traffic: log split, visitors, jumps and the traffic summaries.

Page-log records have ``common``, ``page`` and ``ts`` (epoch milliseconds).
``tie`` names columns that order records of the same millisecond; they are part
of the records, such as the offset under which a record was read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark import schemas as s
from tidemark.functions import times
from tidemark.functions.records import BAD, bad, decode, good
from tidemark.functions.texts import tokenize
from tidemark.operators import firsts, logsplit, patterns, windows as w

TIE = ["seq"]
JUMP_LIMIT = "10 seconds"


def parsed_log(lines: DataFrame) -> DataFrame:
    """Raw lines (``value``, ``seq``) with the device, its mark and the time of their record.

    ``_corrupt_record`` holds the text of lines that are no JSON objects or have no time.
    """
    records = decode(lines, s.LOG_KEYS, keep=[*TIE, "value"])
    ts = F.col("ts").try_cast("decimal(38, 6)").try_cast("bigint")
    # the repair orders a device's records by time
    return records.withColumn("ts", ts).withColumn(BAD, F.when(F.col("ts").isNull(), F.coalesce(BAD, "value")).otherwise(F.col(BAD)))


def dirty_log(lines: DataFrame) -> DataFrame:
    """Lines that are not JSON objects or have no time."""
    return bad(parsed_log(lines))


def base_log(
    lines: DataFrame, tie: list[str] = TIE, common_as_string: bool = False, tags: Sequence[str] = logsplit.TAGS
) -> DataFrame:
    """Raw lines to (tag, value) rows of the five log streams, or of some of them, new-visitor marks repaired."""
    records = firsts.repair_is_new(good(parsed_log(lines)), tie)
    return logsplit.tagged(records, common_as_string, tags)


def entry_pages(pages: DataFrame) -> DataFrame:
    """Pages that open a session: no page before them."""
    return pages.filter(F.col("page.last_page_id").isNull())


def unique_visitor(pages: DataFrame, tie: list[str] = TIE) -> DataFrame:
    """First session-entry page of each device and day."""
    rows = entry_pages(pages).withColumn("_rt", times.from_millis("ts"))
    return firsts.first_of_day(rows, "common.mid", "_rt", tie).select(*pages.columns)


def user_jump(pages: DataFrame, within: str = JUMP_LIMIT, tie: list[str] = TIE) -> DataFrame:
    """Session-entry pages that were left again: another entry follows, or nothing in time."""
    rows = w.with_delay(pages.withColumn("_rt", times.from_millis("ts")), "_rt")
    entry = "page.last_page_id IS NULL"
    found = patterns.followed_by_within(rows, "common.mid", "_rt", tie, entry, entry, within)
    return found.select(*pages.columns)


def _measures(records: DataFrame, uv: Column, sv: Column, pv: Column, dur: Column, uj: Column) -> DataFrame:
    return records.select(
        times.from_millis("ts").alias("rt"),
        F.col("common.vc").alias("vc"),
        F.col("common.ch").alias("ch"),
        F.col("common.ar").alias("ar"),
        F.col("common.is_new").alias("isNew"),
        uv.cast("bigint").alias("uvCt"),
        sv.cast("bigint").alias("svCt"),
        pv.cast("bigint").alias("pvCt"),
        dur.cast("bigint").alias("durSum"),
        uj.cast("bigint").alias("ujCt"),
    )


def traffic_window(visitors: DataFrame, jumps: DataFrame, pages: DataFrame) -> DataFrame:
    """Visitors, sessions, pages, time on page and jumps by version, channel, area and newness."""
    no, yes = F.lit(0), F.lit(1)
    opened = F.when(F.col("page.last_page_id").isNull(), 1).otherwise(0)
    rows = (
        _measures(visitors, yes, no, no, no, no)
        .unionByName(_measures(jumps, no, no, no, no, yes))
        .unionByName(_measures(pages, no, opened, yes, F.col("page.during_time"), no))
    )
    sums = {name: w.total(name) for name in ("uvCt", "svCt", "pvCt", "durSum", "ujCt")}
    return w.tumbling(w.with_delay(rows, "rt", w.UNION_DELAY), "rt", sums, ["vc", "ch", "ar", "isNew"])


def page_view_window(pages: DataFrame) -> DataFrame:
    """Daily-unique visitors of the home page and of the detail pages."""
    rows = pages.filter(F.col("page.page_id").isin("home", "good_detail")).select(
        F.col("common.mid").alias("mid"), F.col("page.page_id").alias("page_id"), times.from_millis("ts").alias("rt")
    )
    seen = firsts.daily_starts(rows, ["mid", "page_id"], "rt")
    sums = {
        "homeUvCt": F.count_if(F.col("page_id") == "home"),
        "goodDetailUvCt": F.count_if(F.col("page_id") == "good_detail"),
    }
    return w.tumbling(w.with_delay(seen, "rt"), "rt", sums)


def keyword_window(pages: DataFrame) -> DataFrame:
    """Search keywords per window; the watermark follows all pages, not only searches."""
    timed = w.with_delay(pages.withColumn("rt", times.from_millis_in_seconds("ts")), "rt")
    searches = timed.filter(
        (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
        & F.col("page.item").isNotNull()
    )
    words = searches.select(F.explode(tokenize("page.item")).alias("keyword"), "rt")
    counted = w.tumbling(words, "rt", {"keyword_count": F.count(F.lit(1))}, ["keyword"])
    return counted.select("stt", "edt", F.lit("search").alias("source"), "keyword", "keyword_count")

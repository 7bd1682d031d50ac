"""Users: registrations and logins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import times
from tidemark.operators import changes as c, firsts, windows as w


def user_register(changes: DataFrame) -> DataFrame:
    """New users."""
    return c.users_registered(changes)


def login_window(pages: DataFrame, gap_days: int = 8) -> DataFrame:
    """Users of the day and users back after ``gap_days`` or more."""
    last = F.col("page.last_page_id")
    logins = pages.filter(F.col("common.uid").isNotNull() & (last.isNull() | (last == "login"))).select(
        F.col("common.uid").alias("uid"), times.from_millis("ts").alias("rt")
    )
    users = firsts.returning_users(logins, "uid", "rt", gap_days)
    return w.tumbling(w.with_delay(users, "rt"), "rt", {"backCt": w.total("back"), "uuCt": w.total("uu")})


def register_window(registrations: DataFrame) -> DataFrame:
    """Registrations per window."""
    rows = registrations.select(times.from_text("create_time").alias("rt"))
    return w.tumbling(w.with_delay(rows, "rt"), "rt", {"registerCt": F.count(F.lit(1))})

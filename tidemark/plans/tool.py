"""Coupons: received, used in an order, paid."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import changes as c


def coupon_get(changes: DataFrame) -> DataFrame:
    return c.coupons_received(changes)


def coupon_order(changes: DataFrame) -> DataFrame:
    return c.coupons_used_in_order(changes)


def coupon_pay(changes: DataFrame) -> DataFrame:
    return c.coupons_paid(changes)

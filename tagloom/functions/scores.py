"""Scores of customer behaviour."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# (lowest value, highest value, score); None leaves the end open.
Bins = Sequence[tuple[float | None, float | None, int]]

# Score bins for recency, frequency and monetary value.
RFM_BINS: dict[str, Bins] = {
    "recency": [(1, 3, 5), (4, 6, 4), (7, 9, 3), (10, 15, 2), (16, None, 1)],
    "frequency": [(200, None, 5), (150, 199, 4), (100, 149, 3), (50, 99, 2), (1, 49, 1)],
    "monetary": [(200000, None, 5), (100000, 199999, 4), (50000, 99999, 3), (10000, 49999, 2), (None, 9999, 1)],
}

# Score bins for recency, frequency and engagements of web visits.
RFE_BINS: dict[str, Bins] = {
    "recency": [(0, 15, 5), (16, 30, 4), (31, 45, 3), (46, 60, 2), (61, None, 1)],
    "frequency": [(400, None, 5), (300, 399, 4), (200, 299, 3), (100, 199, 2), (None, 99, 1)],
    "engagements": [(250, None, 5), (200, 249, 4), (150, 199, 3), (50, 149, 2), (None, 49, 1)],
}


def bin_score(value: Column, bins: Bins) -> Column:
    """Score of the inclusive bin that holds the value; null in a gap."""
    if not bins:
        raise ValueError("no bins given")
    chain = F
    for low, high, score in bins:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (value >= low)
        if high is not None:
            inside = inside & (value <= high)
        chain = chain.when(inside, score)
    return chain


def discount_columns(amount: Column, coupon: Column) -> list[Column]:
    """Receivable, discount and paid amount of an order, and whether a coupon was used."""
    return [(amount + coupon).alias("ra"), coupon.alias("da"), amount.alias("pa"),
            F.when(coupon != 0, 1).when(coupon == 0, 0).alias("state")]


def price_sensitivity(tdon: Column, ton: Column, tda: Column, tra: Column) -> Column:
    """Share of discounted orders + relative discount per discounted order + share of the discount.

    Null for a user without a discounted order.
    """
    per_order = F.try_divide(F.try_divide(tda, tdon), F.try_divide(tra, ton))
    return F.try_divide(tdon, ton) + per_order + F.try_divide(tda, tra)

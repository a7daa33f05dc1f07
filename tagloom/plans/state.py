"""Mergeable state by user: what the jobs of a run need of one table, from one scan, and kept between runs.

A state is the table summed up by user and one further column, with measures that
are maxima or sums. States of two parts of a table merge into that of the whole,
so a run can add what is new to what is kept; and every job of a table reads the
state in place of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.scores import discount_columns
from tagloom.sources.stores import BucketStore


@dataclass(frozen=True)
class Measure:
    """A maximum or a sum of an expression over the fields of the table."""

    name: str
    kind: str  # max or sum
    type: str
    fields: tuple[str, ...]
    value: str  # SQL over the fields, and over ``discount``, what the amount and the coupon of an order make


@dataclass(frozen=True)
class UserState:
    """The user and detail columns of a table and the measures that can be kept for them."""

    name: str
    user: str
    detail: str
    measures: tuple[Measure, ...]

    def measure(self, name: str) -> Measure:
        return next(m for m in self.measures if m.name == name)

    def fields(self, names: Sequence[str], with_detail: bool = True) -> list[str]:
        """The columns of the table that these measures need, in a fixed order."""
        own = [self.user, *([self.detail] if with_detail else []), *(f for n in names for f in self.measure(n).fields)]
        return list(dict.fromkeys(own))

    def schema(self, names: Sequence[str]) -> str:
        return ", ".join([f"{self.user} string", f"{self.detail} string", *(f"{n} {self.measure(n).type}" for n in names)])


def _discount(field: str) -> str:
    return f"discount.{field}"


# Receivable, discount and use of a coupon are null where the amount or the coupon is no number.
ORDERS = UserState("orders", "memberId", "paymentCode", (
    Measure("last_time", "max", "long", ("finishTime",), "try_cast(finishTime AS BIGINT)"),
    Measure("orders", "sum", "long", ("orderSn",), "if(orderSn IS NULL, 0L, 1L)"),
    Measure("amount", "sum", "double", ("orderAmount",), "try_cast(orderAmount AS DOUBLE)"),
    Measure("codes", "sum", "long", ("paymentCode",), "if(paymentCode IS NULL, 0L, 1L)"),
    Measure("tdon", "sum", "long", ("orderAmount", "couponCodeValue"), _discount("state")),
    Measure("ton", "sum", "long", ("orderAmount", "couponCodeValue"), f"if({_discount('state')} IS NULL, 0L, 1L)"),
    Measure("tda", "sum", "double", ("orderAmount", "couponCodeValue"), _discount("da")),
    Measure("tra", "sum", "double", ("orderAmount", "couponCodeValue"), _discount("ra")),
))
LOGS = UserState("logs", "global_user_id", "loc_url", (
    Measure("last_visit", "max", "timestamp_ntz", ("log_time",), "try_cast(log_time AS TIMESTAMP_NTZ)"),
    Measure("views", "sum", "long", ("loc_url",), "if(loc_url IS NULL, 0L, 1L)"),
))


def _merged(measure: Measure, value: Column) -> Column:
    found = F.max(value) if measure.kind == "max" else F.sum(value)
    return found.cast(measure.type).alias(measure.name)


def summed(source: DataFrame, state: UserState, names: Sequence[str], with_detail: bool = True) -> DataFrame:
    """The state of a table: one row per user and detail, or per user with a null detail. Combined before its one shuffle."""
    if any(_discount("") in state.measure(n).value for n in names):
        numbers = [F.col(c).try_cast("double") for c in ("orderAmount", "couponCodeValue")]
        source = source.withColumn("discount", F.struct(*discount_columns(*numbers)))
    keys = [F.col(state.user).cast("string").alias(state.user), (F.col(state.detail) if with_detail else F.lit(None)).cast("string").alias(state.detail)]
    values = [F.expr(state.measure(n).value).alias(f"_{n}") for n in names]
    rows = source.select(*keys, *values)
    return rows.groupBy(state.user, state.detail).agg(*[_merged(state.measure(n), F.col(f"_{n}")) for n in names])


def merged(parts: DataFrame, state: UserState, names: Sequence[str], keys: Sequence[str] | None = None) -> DataFrame:
    """States of several parts of a table to the state of them all."""
    return parts.groupBy(*(keys or [state.user]), state.detail).agg(*[_merged(state.measure(n), F.col(n)) for n in names])


class StateStore:
    """A state kept in buckets by user.

    ``add`` takes what is new in the table: the rows whose ``new_by``, a whole number that grows with every load, is above the
    largest one seen so far. The number is part of the version's manifest, so a run that breaks off has added nothing, and a
    row is counted once. Rows without it are taken by the first run only.
    """

    SEEN = "seen"

    def __init__(self, spark: SparkSession, root: str, state: UserState, names: Sequence[str] | None = None, keep: int | None = None,
                 buckets: int | None = None):
        self.state, self.names = state, list(names or [m.name for m in state.measures])
        self.store = BucketStore(spark, root, state.schema(self.names), state.user, keep, buckets)

    def seen(self) -> int | None:
        return self.store.note().get(self.SEEN)

    def read(self) -> DataFrame:
        return self.store.read()

    def add(self, source: DataFrame, new_by: str) -> DataFrame:
        """Add what is new in the table and return the whole state."""
        number = F.col(new_by) if isinstance(source.schema[new_by].dataType, T.LongType) else F.col(new_by).try_cast("long")
        base = self.store.version()
        seen = self.store.note(base).get(self.SEEN)
        fresh = source if seen is None else source.where(number > seen)
        newest = fresh.agg(F.max(number)).first()[0]
        if newest is None and base:
            return self.read()
        # What arrives while the state is summed up belongs to the next run.
        fresh = fresh if newest is None else fresh.where((number <= newest) | number.isNull() if seen is None else number <= newest)
        note = {self.SEEN: newest if newest is not None else seen}

        def combine(stacked: DataFrame, keys: Sequence[str]) -> DataFrame:
            return merged(stacked, self.state, self.names, keys)

        return self.store.merge(summed(fresh, self.state, self.names), combine, base, note)

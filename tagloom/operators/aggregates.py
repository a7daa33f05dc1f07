"""Grouped and global statistics. All are map-side combined by Spark before their shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom.functions.dates import days_since, epoch_to_timestamp
from tagloom.functions.scores import discount_columns
from tagloom.operators.joins import skew_join
from tagloom.operators.ordering import running_total
from tagloom.session import materialised


def last_event(df: DataFrame, user: str, time: str) -> DataFrame:
    return df.groupBy(user).agg(F.max(time).alias("last_time"))


def usage_counts(df: DataFrame, user: str, value: str) -> DataFrame:
    """``(user, value, counts)``; a null value is kept with a count of 0."""
    return df.groupBy(user, value).agg(F.count(value).alias("counts"))


def rfm(df: DataFrame, user: str, order: str, amount: str, time: str, as_of: str, shift_days: int = 0) -> DataFrame:
    """Days since the last order, number of orders and amount spent per user.

    ``time`` is a timestamp without zone or epoch seconds, which are turned into
    a timestamp only after the maximum is found.
    """
    last = F.max(time)
    if isinstance(df.schema[time].dataType, T.LongType):
        last = epoch_to_timestamp(last)
    return df.groupBy(user).agg(
        days_since(last, as_of, shift_days).alias("recency"),
        F.count(order).alias("frequency"),
        F.sum(amount).alias("monetary"))


def rfe(df: DataFrame, user: str, url: str, time: str, as_of: str, shift_days: int = 0) -> DataFrame:
    """Days since the last visit, page views and distinct pages per user."""
    return df.groupBy(user).agg(
        days_since(F.max(time), as_of, shift_days).alias("recency"),
        F.count(url).alias("frequency"),
        F.count_distinct(url).alias("engagements"))


def discount_totals(df: DataFrame, user: str, amount: str, coupon: str) -> DataFrame:
    """Discounted orders, orders, total discount and total receivable per user."""
    orders = df.select(user, *discount_columns(F.col(amount), F.col(coupon)))
    return orders.groupBy(user).agg(
        F.sum("state").alias("tdon"), F.count("state").alias("ton"),
        F.sum("da").alias("tda"), F.sum("ra").alias("tra"))


def votes(df: DataFrame, user: str, male: Column, female: Column) -> DataFrame:
    """Male, female and all predictions per user, as doubles."""
    return df.groupBy(user).agg(
        F.count_if(male).cast("double").alias("male"),
        F.count_if(female).cast("double").alias("female"),
        F.count(user).cast("double").alias("total"))


def implicit_ratings(df: DataFrame, user: str, item: str) -> DataFrame:
    """Clicks per user and item; rows without either are left out."""
    return (df.where(F.col(user).isNotNull() & F.col(item).isNotNull())
            .groupBy(user, item).agg(F.count(item).cast("double").alias("rating")))


def contingency(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.groupBy(left, right).agg(F.count("*").alias("n"))


def column_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Max, min, mean, sample variance, L1 and L2 norm: one row per column, from one pass."""
    wide = []
    for c in columns:
        x = F.col(c).cast("double")
        wide.append(F.struct(
            F.lit(c).alias("column"), F.max(x).alias("max"), F.min(x).alias("min"), F.avg(x).alias("mean"),
            F.var_samp(x).alias("variance"), F.sum(F.abs(x)).alias("l1"), F.sqrt(F.sum(x * x)).alias("l2")))
    return df.agg(F.array(*wide).alias("stats")).select(F.inline("stats"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias("corr"))


def mid_ranks(df: DataFrame, value: str, weight: str) -> DataFrame:
    """Average rank of every distinct value, where ``weight`` counts its rows."""
    values = materialised(df.groupBy(value).agg(F.sum(weight).alias("_count")))
    ranked = running_total(values, [value], "_count", "_upto")
    return ranked.select(value, (F.col("_upto") - (F.col("_count") - 1) / 2).alias("rank"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rank correlation with average ranks for ties.

    Rows are reduced to counted value pairs first, so a value that fills much
    of the table is a single row when the ranks are built.
    """
    pairs = materialised(df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
                         .groupBy(F.col(x).alias("x"), F.col(y).alias("y")).agg(F.count("*").alias("w")))
    ranked = skew_join(pairs, mid_ranks(pairs, "x", "w").select(F.col("x").alias("vx"), F.col("rank").alias("rx")),
                       "x", "vx", "inner", ["x", "y"])
    ranked = skew_join(ranked, mid_ranks(pairs, "y", "w").select(F.col("y").alias("vy"), F.col("rank").alias("ry")),
                       "y", "vy", "inner", ["x", "y"], pairs)
    rows = pairs.agg(F.sum("w")).first()[0] or 0
    middle = F.lit((rows + 1) / 2)
    dx, dy = F.col("rx") - middle, F.col("ry") - middle
    w = F.col("w")
    return ranked.agg(F.try_divide(F.sum(w * dx * dy), F.sqrt(F.sum(w * dx * dx) * F.sum(w * dy * dy))).alias("corr"))


def mean_squared_error(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.avg(F.pow(F.col(actual) - F.col(predicted), 2)).alias("mse"))


def cluster_profile(df: DataFrame, cluster: str, total: Column) -> DataFrame:
    """Highest and lowest score sum per cluster, sorted by cluster."""
    return df.groupBy(cluster).agg(F.max(total).alias("max_total"), F.min(total).alias("min_total")).orderBy(cluster)


def outlier_filter(df: DataFrame, price: str, size: str, price_range: tuple[float, float] = (2, 1e8),
                   size_range: tuple[float, float] = (2, 1e5)) -> tuple[DataFrame, DataFrame]:
    """Rows kept (price or size strictly inside its range) and rows called bad (either outside).

    The two are not complements: a row with one good and one bad value is in both.
    """
    p, s = F.col(price), F.col(size)
    kept = df.where(((p > price_range[0]) & (p < price_range[1])) | ((s > size_range[0]) & (s < size_range[1])))
    bad = df.where((p > price_range[1]) | (p < price_range[0]) | (s < size_range[0]) | (s > size_range[1]))
    return kept, bad

"""Row numbers, ranks, running totals and top-n that do not pull a large group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators.joins import skew_join
from tagloom.session import checkpointed, shuffle_partitions

# Row count up to which a set may be ordered by a single task.
ONE_TASK_ROWS = 200_000


def _names(df: DataFrame, columns: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in columns]


def _placed(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Sort into range partitions and freeze them; adds the partition and the row position in it."""
    parts = shuffle_partitions(df.sparkSession)
    sorted_rows = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return (checkpointed(sorted_rows)
            .withColumn("_part", F.spark_partition_id())
            .withColumn("_pos", F.monotonically_increasing_id()))


def number_rows(df: DataFrame, order_by: Sequence[str | Column], name: str = "rn") -> DataFrame:
    """Number all rows 1..n in the given order, which must be total for a repeatable result.

    Small inputs use one window. Larger ones are range-partitioned; only the
    row count of each partition is combined to find where it starts.
    """
    order = _names(df, order_by)
    if df.count() <= ONE_TASK_ROWS:
        return df.withColumn(name, F.row_number().over(W.orderBy(*order)).cast("long"))
    rows = _placed(df, order)
    # One row per partition: bounded by spark.sql.shuffle.partitions.
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"), F.min("_pos").alias("_first"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select("_part", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (rows.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_pos") - F.col("_first") + F.col("_before") + 1)
            .drop("_part", "_pos", "_first", "_before"))


def running_total(df: DataFrame, order_by: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Inclusive running sum of ``value`` over all rows in a total order."""
    order = _names(df, order_by)
    if df.count() <= ONE_TASK_ROWS:
        frame = W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
        return df.withColumn(name, F.sum(value).over(frame))
    rows = _placed(df, order)
    sums = rows.groupBy("_part").agg(F.sum(value).alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_part").orderBy("_pos").rowsBetween(W.unboundedPreceding, 0)
    return (rows.join(F.broadcast(starts), "_part")
            .withColumn(name, F.sum(value).over(inside) + F.col("_before"))
            .drop("_part", "_pos", "_before"))


def _few_values(df: DataFrame, column: str) -> bool:
    return df.select(column).distinct().count() <= ONE_TASK_ROWS


def rank_in_group(df: DataFrame, group: str, order_by: Sequence[str | Column], distinct_by: str,
                  name: str = "rn", values_from: DataFrame | None = None) -> DataFrame:
    """Number the rows of each group. ``(group, distinct_by)`` must be unique.

    A group is then no larger than the number of ``distinct_by`` values. While
    that is small a window per group is safe; otherwise the rows are numbered
    as a whole and each group subtracts its first number. ``values_from`` is a
    cheaper frame with the same ``distinct_by`` values, to count them in.
    """
    order = _names(df, order_by)
    if _few_values(df if values_from is None else values_from, distinct_by):
        return df.withColumn(name, F.row_number().over(W.partitionBy(group).orderBy(*order)).cast("long"))
    numbered = checkpointed(number_rows(df, [F.col(group), *order], "_all"))
    first = numbered.groupBy(group).agg(F.min("_all").alias("_first"))
    joined = skew_join(numbered.withColumnRenamed(group, "_group"), first, "_group", group, "inner", ["_all"])
    return (joined.withColumn(name, F.col("_all") - F.col("_first") + 1)
            .withColumnRenamed("_group", group).select(*df.columns, name))


def rank_in_group_sql(df: DataFrame, group: str, count: str, distinct_by: str,
                      values_from: DataFrame | None = None) -> DataFrame:
    """The ranking of ``rank_in_group`` written as SQL over a view."""
    if not _few_values(df if values_from is None else values_from, distinct_by):
        return rank_in_group(df, group, [F.desc(count), F.asc(distinct_by)], distinct_by, values_from=values_from)
    return df.sparkSession.sql(
        f"""SELECT *, CAST(row_number() OVER (PARTITION BY {group}
                 ORDER BY {count} DESC, {distinct_by} ASC) AS BIGINT) AS rn
            FROM {{ranked}}""", ranked=df)


def top_n_per_group(df: DataFrame, group: str, order_by: Sequence[str | Column], n: int,
                    name: str = "rn") -> DataFrame:
    """First ``n`` rows of each group.

    Up to ``n`` = 1000 Spark applies the limit in each map task before the
    shuffle, so a hot group reaches the final task with ``n`` rows per map task.
    """
    window = W.partitionBy(group).orderBy(*_names(df, order_by))
    return df.withColumn(name, F.row_number().over(window)).where(F.col(name) <= n)


def first_rows(df: DataFrame, order_by: Sequence[str | Column], n: int) -> DataFrame:
    """The ``n`` first rows in a total order."""
    return df.orderBy(*_names(df, order_by)).limit(n)

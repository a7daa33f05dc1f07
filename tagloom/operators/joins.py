"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import local_frame, shuffle_partitions

# A side is broadcast only below both bounds, measured before the join.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 32 * 1024 * 1024

# Most hot keys looked for, and the size of the sketch that finds them.
HOT_KEYS = 100_000
SKETCH_KEYS = 1_000_000
# A key with fewer rows than this is never worth splitting.
HOT_ROWS = 100_000


def fits_broadcast(df: DataFrame) -> bool:
    """Measure ``df`` (one map-side combined aggregate) against the broadcast bounds."""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, width = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= BROADCAST_ROWS and width <= BROADCAST_BYTES


def lookup_join(df: DataFrame, dim: DataFrame, key: str, dim_key: str, how: str = "inner",
                spread_by: Sequence[str] | None = None) -> DataFrame:
    """Add the columns of a dimension keyed by ``dim_key``: broadcast when measured small, else ``skew_join``."""
    if fits_broadcast(dim):
        right = F.broadcast(dim.withColumnRenamed(dim_key, "_dim_key"))
        return df.join(right, F.col(key) == F.col("_dim_key"), how).drop("_dim_key")
    return skew_join(df, dim, key, dim_key, how, spread_by)


def hot_keys(df: DataFrame, key: str) -> list[tuple[int, int]]:
    """Hashes of the keys too frequent for one task, each with the number of tasks it needs.

    A key is hot above half the mean partition, so there are fewer than twice
    as many as partitions. One pass over the key column with a mergeable sketch
    finds them; an estimate that is off changes only how the work is split,
    never the joined rows.
    """
    parts = shuffle_partitions(df.sparkSession)
    hashed = df.select(F.xxhash64(key).alias("h"))
    wanted = min(2 * parts, HOT_KEYS)
    tracked = min(max(10 * wanted, 10_000), SKETCH_KEYS)
    rows, top = hashed.agg(F.count("*"), F.expr(f"approx_top_k(h, {wanted}, {tracked})")).first()
    share = max(rows // parts, 1)
    return [(t["item"], min(parts, t["count"] // share + 2)) for t in top or []
            if t["count"] >= HOT_ROWS and 2 * t["count"] > share]


def skew_join(left: DataFrame, right: DataFrame, key: str, right_key: str, how: str = "inner",
              spread_by: Sequence[str] | None = None, keys_from: DataFrame | None = None,
              shuffled: bool = False) -> DataFrame:
    """Inner or left equi-join in which the rows of a hot left key are split over several tasks.

    Rows of a hot key get a salt below the key's task count and the matching
    right rows are repeated once per salt, so every pair still meets exactly
    once. ``spread_by`` names the columns that tell the rows of one key apart;
    without it all columns do. The salt is a function of the row, so a task that
    runs again deals its rows out as before. ``keys_from`` is a cheaper frame to count the
    keys in, when ``left`` was derived from it. With ``shuffled`` neither side is broadcast,
    for sides known to be large whose size Spark underrates.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    right = right.withColumnRenamed(right_key, "_right_key")
    hot = hot_keys(left if keys_from is None else keys_from, key)
    if not hot:
        right = right.hint("merge") if shuffled else right
        return left.join(right, F.col(key) == F.col("_right_key"), how).drop("_right_key")
    # At most HOT_KEYS rows, so always safe to broadcast.
    plan = F.broadcast(local_frame(left.sparkSession, hot, "_h long, _tasks int"))
    position = F.xxhash64(*(spread_by or [f"`{c}`" for c in left.columns]))
    left = (left.withColumn("_pos", position)
            .join(plan, F.xxhash64(key) == F.col("_h"), "left")
            .withColumn("_salt", F.pmod("_pos", F.coalesce("_tasks", F.lit(1))).cast("int"))
            .drop("_h", "_tasks", "_pos"))
    right = (right.join(plan, F.xxhash64("_right_key") == F.col("_h"), "left")
             .withColumn("_right_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_tasks", F.lit(1)) - 1)))
             .drop("_h", "_tasks"))
    right = right.hint("merge") if shuffled else right
    on = (F.col(key) == F.col("_right_key")) & (F.col("_salt") == F.col("_right_salt"))
    return left.join(right, on, how).drop("_right_key", "_salt", "_right_salt")

"""Collaborative filtering with alternating least squares."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.texts import struct_field_csv
from tagloom.operators.joins import lookup_join
from tagloom.operators.ordering import number_rows
from tagloom.session import ensure_checkpoint_dir, materialised

# Largest part of a factor table that is sent to every executor at once, and the products one block may hold.
FACTOR_BYTES = 64 * 1024 * 1024
BLOCK_CELLS = 8_000_000
ROUNDING = 1e-4  # of a product of 32-bit factors, relative to their lengths
# Ratings of one factor block. A task that deals ratings out holds a builder for each pair of blocks, so by default there are 64
# blocks at most, which then grow; ``fit_als`` takes another number where the executors hold more builders or smaller blocks.
BLOCK_RATINGS = 500_000
MOST_BLOCKS = 64


def numeric_ids(ratings: DataFrame, user: str, item: str) -> DataFrame:
    """32-bit ids and double ratings, as ALS needs them; ids that are no such numbers are left out."""
    typed = ratings.select(F.col(user).try_cast("int").alias("userId"), F.col(item).try_cast("int").alias("itemId"),
                           F.col("rating").cast("double").alias("rating"))
    return typed.dropna()


def number_ids(ratings: DataFrame, user: str, item: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Ratings with numbered ids, and the ``(id, number)`` tables of the users and the items."""
    typed = materialised(ratings.select(
        F.col(user).cast("string").alias("user"), F.col(item).cast("string").alias("item"),
        F.col("rating").cast("double").alias("rating")).dropna())
    tables = []
    for c in ("user", "item"):
        ids = materialised(typed.select(F.col(c).alias("id")).distinct())
        tables.append(materialised(number_rows(ids, ["id"], "number").withColumn("number", F.col("number").cast("int"))))
    users, items = tables
    numbered = lookup_join(typed, users.withColumnRenamed("number", "userId"), "user", "id", "inner", ["item"])
    numbered = lookup_join(numbered, items.withColumnRenamed("number", "itemId"), "item", "id", "inner", ["userId"])
    return numbered.select("userId", "itemId", "rating"), users, items


def restore_ids(recommendations: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Recommendations over numbers as recommendations over the ids they stand for."""
    single = recommendations.select(F.col("userId").alias("_u"), F.posexplode("recommendations").alias("_place", "_r"))
    single = single.select("_u", "_place", F.col("_r.itemId").alias("_i"), F.col("_r.rating").alias("rating"))
    named = lookup_join(single, items.withColumnRenamed("id", "itemId"), "_i", "number", "inner", ["_u"])
    # As many rows per user as there are recommendations for one.
    lists = named.groupBy("_u").agg(F.array_sort(F.collect_list(F.struct("_place", "itemId", "rating"))).alias("_l"))
    restored = lookup_join(lists, users.withColumnRenamed("id", "userId"), "_u", "number", "inner", ["_u"])
    return restored.select("userId", F.transform("_l", lambda r: F.struct(r["itemId"].alias("itemId"), r["rating"].alias(
        "rating"))).alias("recommendations"))


def fit_als(ratings: DataFrame, rank: int = 10, iterations: int = 10, alpha: float = 0.1, reg: float = 0.1,
            implicit: bool = True, seed: int = 1, most_blocks: int = MOST_BLOCKS) -> ALSModel:
    """Factor ``(userId, itemId, rating)``; the lineage of the iterations is cut by checkpoints."""
    spark = ratings.sparkSession
    ensure_checkpoint_dir(spark)
    blocks = min(most_blocks, ratings.count() // BLOCK_RATINGS + 1)  # of the data, so a cluster setting does not change the model
    return ALS(userCol="userId", itemCol="itemId", ratingCol="rating", rank=rank, maxIter=iterations, alpha=alpha,
               regParam=reg, implicitPrefs=implicit, seed=seed, numUserBlocks=blocks, numItemBlocks=blocks,
               coldStartStrategy="nan").fit(ratings)


def predict_pairs(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predicted rating of each ``(userId, itemId)``; NaN for unknown ids."""
    return model.transform(pairs)


def top_items(model: ALSModel, n: int = 5, users: DataFrame | None = None) -> DataFrame:
    """``(userId, recommendations)`` with the ``n`` best items of all or of the given users; the smaller id wins a tie."""
    return _best_matches(model.userFactors, model.itemFactors, model.rank, n, "userId", "itemId", users)


def top_users(model: ALSModel, n: int = 5, items: DataFrame | None = None) -> DataFrame:
    """``(itemId, recommendations)`` with the ``n`` best users of all or of the given items; the smaller id wins a tie."""
    return _best_matches(model.itemFactors, model.userFactors, model.rank, n, "itemId", "userId", items)


def _best_matches(asking: DataFrame, offered: DataFrame, rank: int, n: int, key: str, other: str,
                  subset: DataFrame | None) -> DataFrame:
    """Best ``n`` offered factors for each asking one.

    Factors that may be sent to every task at once need no shuffle. More of them are sent in parts, the longest factors first.
    No product is larger than that of the lengths, so a row whose ``n``-th best is above its length times that of the next part
    is done, and the parts that are left when all rows are done are never sent.
    """
    parts = offered.count() * (rank + 1) * 4 // max(1, FACTOR_BYTES) + 1
    if subset is not None:
        asking = asking.join(subset.select(F.col(key).alias("id")), "id", "left_semi")
    if parts == 1:
        return _best_of_part(asking, offered, rank, n, key, other)[0]
    offered = materialised(offered.select("id", "features", _length().alias("_length")), "factors")
    none = F.array().cast(f"array<struct<{other}: int, rating: float>>").alias("recommendations")
    state = materialised(asking.select("id", "features", _length().alias("_length"), none), "best")
    for part, longest in parts_by_length(offered, parts, rank):
        reached = F.col("_length") * F.lit(longest * (1 + ROUNDING))
        open_ = (F.size("recommendations") < n) | (F.coalesce(F.get("recommendations", F.lit(n - 1))["rating"], F.lit(0.0)) <= reached)
        if not state.where(open_).take(1):
            break
        state = _with_part(state.withColumn("_open", open_), part, rank, n, other)
    return state.select(F.col("id").alias(key), "recommendations")


def _length() -> Column:
    return F.sqrt(F.aggregate("features", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")))


def parts_by_length(offered: DataFrame, parts: int, rank: int) -> Iterator[tuple[DataFrame, float]]:
    """Parts of the factors that may be sent, with the largest length in each, from long to short.

    Quantiles cut the lengths into ranges; a range that is too large, as of many equal lengths, is dealt out further.
    """
    shares = [i / parts for i in range(1, parts)]
    cuts = sorted(set(offered.agg(F.percentile_approx("_length", shares, 100 * parts)).first()[0] or []))
    shorter = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda cut: F.col("_length") <= cut))
    ranged = offered.withColumn("_range", shorter)
    # One row for each range.
    for row in sorted(ranged.groupBy("_range").agg(F.count("*").alias("n"), F.max("_length").alias("longest")).collect()):
        own, pieces = ranged.where(F.col("_range") == row["_range"]), row["n"] * (rank + 1) * 4 // max(1, FACTOR_BYTES) + 1
        for piece in range(pieces):
            yield own.where(F.pmod(F.xxhash64("id"), F.lit(pieces)) == piece).select("id", "features"), row["longest"]


def _with_part(state: DataFrame, part: DataFrame, rank: int, n: int, other: str) -> DataFrame:
    """The lists of the open rows with what a part has to offer, written; other rows stay as they are."""
    table = part.orderBy("id").toArrow()  # bounded by FACTOR_BYTES, about
    shared = state.sparkSession.sparkContext.broadcast((table["id"].combine_chunks().to_numpy(), _matrix(table["features"], rank)))
    columns = ["id", "features", "_length", "recommendations"]
    kept = min(n, table.num_rows)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, factors = shared.value
        block = max(1, BLOCK_CELLS // max(1, len(ids)))
        for batch in batches:
            lists, wanted = batch.column("recommendations").to_pylist(), np.flatnonzero(batch.column("_open").to_numpy(zero_copy_only=False))
            rows = _matrix(batch.column("features"), rank)
            for at in range(0, len(wanted) if kept else 0, block):
                own = wanted[at:at + block]
                products = rows[own] @ factors.T
                top = highest(products, kept)
                for i, found, values in zip(own.tolist(), ids[top].tolist(), np.take_along_axis(products, top, axis=1).tolist()):
                    offers = lists[i] + [{other: x, "rating": v} for x, v in zip(found, values)]
                    lists[i] = sorted(offers, key=lambda r: (-r["rating"], r[other]))[:n]
            merged = pa.array(lists, batch.schema.field("recommendations").type)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns[:-1]), merged], names=columns)

    written = materialised(state.mapInArrow(best, state.select(*columns).schema), "best")
    shared.destroy()
    return written


def _best_of_part(asking: DataFrame, offered: DataFrame, rank: int, n: int, key: str, other: str) -> tuple[DataFrame, Broadcast]:
    """Each task multiplies a block of asking factors with all factors of the part and keeps the highest of every row."""
    # Bounded by FACTOR_BYTES, about.
    table = offered.orderBy("id").toArrow()
    sent = (table["id"].combine_chunks().to_numpy(), _matrix(table["features"], rank))
    shared = asking.sparkSession.sparkContext.broadcast(sent)
    kept = min(n, table.num_rows)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, factors = shared.value
        block = max(1, BLOCK_CELLS // max(1, len(ids)))
        for batch in batches if kept else ():
            keys, rows = batch.column("id"), _matrix(batch.column("features"), rank)
            for at in range(0, len(rows), block):
                products = rows[at:at + block] @ factors.T
                top = highest(products, kept)
                pairs = pa.StructArray.from_arrays(
                    [pa.array(ids[top].ravel()), pa.array(np.take_along_axis(products, top, axis=1).ravel())],
                    fields=[pa.field(other, pa.int32()), pa.field("rating", pa.float32())])
                offsets = pa.array(np.arange(0, top.size + 1, kept, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [keys.slice(at, len(top)), pa.ListArray.from_arrays(offsets, pairs)], names=[key, "recommendations"])

    schema = f"{key} int, recommendations array<struct<{other}: int, rating: float>>"
    return asking.select("id", "features").mapInArrow(best, schema), shared


def highest(values: np.ndarray, n: int) -> np.ndarray:
    """Columns of the ``n`` highest values of each row, highest first; of equal values the first columns."""
    top = np.sort(np.argpartition(-values, n - 1, axis=1)[:, :n], axis=1)
    least = np.take_along_axis(values, top, axis=1).min(axis=1)
    # Where more values than places equal the last one, the places go to the first of them.
    for i in np.flatnonzero((values >= least[:, None]).sum(axis=1) > n):
        above, equal = np.flatnonzero(values[i] > least[i]), np.flatnonzero(values[i] == least[i])
        top[i] = np.sort(np.concatenate([above, equal[:n - len(above)]]))
    order = np.argsort(-np.take_along_axis(values, top, axis=1), axis=1, kind="stable")
    return np.take_along_axis(top, order, axis=1)


def _matrix(features: pa.ChunkedArray | pa.Array, rank: int) -> np.ndarray:
    flat = features.combine_chunks() if isinstance(features, pa.ChunkedArray) else features
    return np.ascontiguousarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.float32).reshape(-1, rank)


def items_as_csv(recommendations: DataFrame) -> DataFrame:
    """``(userId, tagsId)`` where ``tagsId`` lists the recommended items, best first."""
    return recommendations.select(F.col("userId").cast("string").alias("userId"),
                                  struct_field_csv(F.col("recommendations"), "itemId").alias("tagsId"))

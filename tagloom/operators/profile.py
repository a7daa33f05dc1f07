"""The profile table ``(userId, tagsId)`` with one row and one sorted tag list per user."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.texts import is_blank, tag_set
from tagloom.operators.joins import lookup_join


def collect_tags(tagged: DataFrame) -> DataFrame:
    """One row per user with the union of its tag lists. A user's list is as long as its distinct tags."""
    single = tagged.select("userId", F.explode_outer(F.split("tagsId", ",")).alias("tag"))
    filled = F.when(~is_blank(F.col("tag")), F.col("tag"))
    joined = F.array_join(F.array_sort(F.collect_set(filled)), ",")
    return single.groupBy("userId").agg(joined.alias("tagsId")).withColumn(
        "tagsId", F.when(F.col("tagsId") != "", F.col("tagsId")))


def merge_new_users(new: DataFrame, old: DataFrame) -> DataFrame:
    """Users of ``new`` only, with their old tags added."""
    left = collect_tags(new).withColumnRenamed("tagsId", "_new")
    right = collect_tags(old).withColumnRenamed("tagsId", "_old")
    return left.join(right, "userId", "left").select("userId", tag_set(F.col("_new"), F.col("_old")).alias("tagsId"))


def merge_all_users(new: DataFrame, old: DataFrame) -> DataFrame:
    """Users of either side with the union of their tags: what an upsert of the new rows leaves in the table.

    The sides are stacked and grouped, so both are combined before one shuffle and nothing is sorted.
    """
    return collect_tags(new.select("userId", "tagsId").unionByName(old.select("userId", "tagsId")))


def merge_new_users_sql(new: DataFrame, old: DataFrame) -> DataFrame:
    """``merge_new_users`` written as SQL over views."""
    return new.sparkSession.sql(
        """SELECT n.userId,
                  array_join(array_sort(array_distinct(filter(
                      split(concat_ws(',', n.tagsId, o.tagsId), ','), t -> trim(t) <> ''))), ',') AS tagsId
           FROM {new} n LEFT JOIN {old} o ON n.userId = o.userId""",
        new=collect_tags(new), old=collect_tags(old))


def drop_tags(profile: DataFrame, stale: DataFrame) -> DataFrame:
    """Remove the tags listed in ``stale(id)`` from every user; users stay, with a null list when none is left."""
    single = profile.select("userId", F.explode_outer(F.split("tagsId", ",")).alias("tag"))
    known = stale.select(F.col("id").cast("string").alias("_stale")).distinct().withColumn("_drop", F.lit(True))
    marked = lookup_join(single, known, "tag", "_stale", "left", ["userId", "tag"])
    return collect_tags(marked.select("userId", F.when(F.col("_drop").isNull(), F.col("tag")).alias("tagsId")))


def one_change(changes: DataFrame) -> DataFrame:
    """One row per user; several changes of one user are one change to the union of their tags."""
    lists = changes.groupBy("userId").agg(F.max("tagsId").alias("_one"), F.collect_set("tagsId").alias("_all"))
    union = F.array_join(F.array_sort(F.array_distinct(F.split(F.array_join("_all", ","), ","))), ",")
    return lists.select("userId", F.when(F.size("_all") > 1, union).otherwise(F.col("_one")).alias("tagsId"))


def changed_lists(stacked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and changed rows (``_new``), one of either kind a user at most, to one row a user: the changed one where there is one."""
    found = stacked.groupBy(*keys).agg(F.max("_new").alias("_hit"), F.max(F.when(F.col("_new"), F.col("tagsId"))).alias("_after"),
                                       F.max(F.when(~F.col("_new"), F.col("tagsId"))).alias("_before"))
    return found.select(*keys, F.when(F.col("_hit"), F.col("_after")).otherwise(F.col("_before")).alias("tagsId"))


def united_lists(stacked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Old and new rows, one of either kind a user at most, to one row a user with all their tags, sorted."""
    lists = stacked.groupBy(*keys).agg(F.max(F.when(F.col("_new"), F.col("tagsId"))).alias("_after"),
                                       F.max(F.when(~F.col("_new"), F.col("tagsId"))).alias("_before"))
    return lists.select(*keys, tag_set(F.col("_after"), F.col("_before")).alias("tagsId"))


def upsert(current: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows of ``changes`` replace those of the same user, other users are untouched.

    Several changes of one user are one change to the union of their tags.
    """
    sides = current.select("userId", "tagsId", F.lit(False).alias("_new")).unionByName(
        one_change(changes).withColumn("_new", F.lit(True)))
    return changed_lists(sides, ["userId"])

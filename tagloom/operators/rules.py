"""The tag table: source rules, value rules and the tag tree.

Columns: ``id long, name string, rule string, level int, pid long``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.rules import source_rule_map
from tagloom.operators.joins import lookup_join, skew_join
from tagloom.operators.ordering import number_rows
from tagloom.session import materialised

ROOT_PID = -1


@dataclass(frozen=True)
class SourceSpec:
    """Where the source of a tag lives and which of its fields are read."""

    in_type: str
    table: str
    fields: tuple[str, ...]
    options: dict[str, str]


def rule_of(tags: DataFrame, tag_id: int) -> str:
    """Rule text of one tag; an unknown tag is an error."""
    row = tags.where(F.col("id") == tag_id).select("rule").first()
    if row is None:
        raise KeyError(f"no tag with id {tag_id}")
    return row["rule"]


def rules_of(tags: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rule text of every wanted tag, one row per wanted row."""
    return skew_join(wanted, tags.select("id", "rule"), key, "id", "inner")


def source_spec(tags: DataFrame, tag_id: int) -> SourceSpec:
    """Parsed source rule of a tag; a key that is not in the rule is the empty string."""
    rule = rule_of(tags, tag_id)
    pieces = tags.sparkSession.range(1).select(source_rule_map(F.lit(rule)).alias("m")).first()["m"]
    if any(value is None for value in pieces.values()):
        raise ValueError(f"rule of tag {tag_id} has a piece without '='")
    fields = tuple(f for f in pieces.get("selectFields", "").split(",") if f)
    return SourceSpec(pieces.get("inType", ""), pieces.get("hbaseTable", ""), fields, pieces)


def child_rules(tags: DataFrame, tag_id: int | None = None) -> DataFrame:
    """``(id, rule)`` of the children of one tag, or ``(pid, id, rule)`` of all children."""
    if tag_id is None:
        return tags.where(F.col("pid") != ROOT_PID).select("pid", "id", "rule")
    return tags.where(F.col("pid") == tag_id).select("id", "rule")


def range_rules(rules: DataFrame) -> DataFrame:
    """Parse ``lo-hi`` rules into ``(tagsId, start, end)`` with numeric, inclusive bounds."""
    bounds = F.split("rule", "-")
    return rules.select(F.col("id").alias("tagsId"),
                        bounds[0].cast("long").alias("start"), bounds[1].cast("long").alias("end"))


def exact_rules(rules: DataFrame) -> DataFrame:
    """``(rule, tagsId)`` with one tag per rule; the highest id wins when a rule is listed twice."""
    return rules.where(F.col("rule").isNotNull()).groupBy("rule").agg(F.max("id").alias("tagsId"))


def tags_of_level(tags: DataFrame, level: int) -> DataFrame:
    return tags.where(F.col("level") == level)


def children_of(tags: DataFrame, parents: DataFrame) -> DataFrame:
    """Every child of the given tags with the name of its parent."""
    names = parents.select(F.col("id").alias("parent_id"), F.col("name").alias("parent_name"))
    return skew_join(tags, names, "pid", "parent_id", "inner")


def tags_with_models(tags: DataFrame, models: DataFrame) -> DataFrame:
    """Each tag with its model, or nulls where it has none."""
    return skew_join(tags, models.withColumnRenamed("id", "model_id"), "id", "tag_id", "left")


def _next_id(tags: DataFrame) -> int:
    return (tags.agg(F.max("id")).first()[0] or 0) + 1


def append_tags(tags: DataFrame, new: DataFrame, order_by: list[str], first_id: int = 1) -> tuple[DataFrame, DataFrame]:
    """Give new tags the next free ids, ``first_id`` at least; returns the whole table and the numbered new rows."""
    start = max(_next_id(tags), first_id)
    numbered = number_rows(new, order_by, "_n").withColumn("id", F.col("_n") + (start - 1)).drop("_n")
    return tags.unionByName(numbered.select(*tags.columns)), numbered


def append_tags_with_models(tags: DataFrame, models: DataFrame, new: DataFrame,
                            order_by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Append tag rows that carry ``model_*`` columns, and one model row per tag pointing at its new id."""
    all_tags, numbered = append_tags(tags, new, order_by)
    rows = numbered.withColumn("tag_id", F.col("id")).drop("id", "name", "rule", "level", "pid")
    start = _next_id(models)
    rows = number_rows(rows, ["tag_id"], "_n").withColumn("id", F.col("_n") + (start - 1)).drop("_n")
    return all_tags, models.unionByName(rows.select(*models.columns))


def upsert_paths(tags: DataFrame, paths: DataFrame, first_id: int = 1) -> DataFrame:
    """Insert the missing tags of a batch of ``(name1, name2, name3)`` paths.

    Level by level: a tag exists when its name is known under the resolved
    parent; the others get new ids. The root level hangs under ``ROOT_PID``.
    """
    resolved = materialised(paths.distinct()).withColumn("pid", F.lit(ROOT_PID).cast("long"))
    for level in (1, 2, 3):
        name = f"name{level}"
        wanted = resolved.select(F.col(name).alias("name"), "pid").distinct()
        known = tags_of_level(tags, level).select("name", "pid")
        fresh = (wanted.join(known, ["name", "pid"], "left_anti")
                 .withColumn("level", F.lit(level)).withColumn("rule", F.lit(None).cast("string")))
        tags = materialised(append_tags(tags, fresh, ["pid", "name"], first_id)[0])
        if level < 3:
            ids = (tags_of_level(tags, level).groupBy("name", "pid").agg(F.min("id").alias("_id"))
                   .select(F.struct("pid", "name").alias("_key"), "_id"))
            keyed = resolved.withColumn("_path_key", F.struct("pid", F.col(name).alias("name")))
            resolved = (lookup_join(keyed, ids, "_path_key", "_key", "inner", ["name1", "name2", "name3"])
                        .select("name1", "name2", "name3", F.col("_id").alias("pid")))
    return tags

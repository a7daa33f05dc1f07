"""Matching values with the rules of a tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.joins import fits_broadcast, lookup_join, skew_join
from tagloom.operators.ordering import number_rows
from tagloom.operators.rules import exact_rules

# Up to this many bands every row is compared with every band of a broadcast list.
LOOP_BANDS = 64
# Levels of the power-of-two cells that bands are cut into beyond that.
CELL_LEVELS = 62


def match_exact(df: DataFrame, value: str, rules: DataFrame, on_missing: str = "error",
                default: str | None = None, spread_by: Sequence[str] | None = None) -> DataFrame:
    """Add ``tagsId`` by looking the value up among the rules ``(id, rule)``.

    A value without a rule takes the tag of the ``default`` rule when one is
    named. Otherwise ``on_missing`` decides: ``error`` fails the job, ``drop``
    leaves the row out, ``null`` keeps it untagged.
    """
    if on_missing not in ("error", "drop", "null"):
        raise ValueError(f"unsupported on_missing {on_missing!r}")
    exact = exact_rules(rules)
    how = "inner" if on_missing == "drop" and default is None else "left"
    matched = lookup_join(df, exact, value, "rule", how, spread_by)
    if default is not None:
        fallback = exact.where(F.col("rule") == default).first()
        if fallback is None:
            raise KeyError(f"no rule {default!r} to fall back on")
        return matched.withColumn("tagsId", F.coalesce("tagsId", F.lit(fallback["tagsId"])))
    if on_missing == "error":
        message = F.concat(F.lit("no rule for value "), F.coalesce(F.col(value).cast("string"), F.lit("null")))
        return matched.withColumn("tagsId", F.coalesce("tagsId", F.raise_error(message).cast("long")))
    return matched


def match_range(df: DataFrame, value: str, bands: DataFrame, spread_by: Sequence[str] | None = None) -> DataFrame:
    """Add the ``tagsId`` of every band ``[start, end]`` that holds the value.

    A value in a gap drops its row, overlapping bands give one row each. A few
    bands are compared directly. More are cut into power-of-two cells, at most
    two per level, and joined by equality: the cells of one band are disjoint,
    so each (row, band) pair is found exactly once. Cells beyond the broadcast
    bound meet each distinct value once instead of every row, and are shuffled
    whatever Spark takes their size for: its estimate is that of the uncut bands.
    """
    if len(bands.take(LOOP_BANDS + 1)) <= LOOP_BANDS and fits_broadcast(bands):
        small = F.broadcast(bands.select("tagsId", "start", "end"))
        return df.join(small, F.col(value).between(F.col("start"), F.col("end"))).drop("start", "end")
    cells = band_cells(bands)
    levels = sorted(r["level"] for r in cells.select("level").distinct().collect())  # at most CELL_LEVELS + 1
    if fits_broadcast(cells):
        return _join_cells(df, value, F.broadcast(cells), levels)
    values = df.where(F.col(value).isNotNull()).select(F.col(value).alias("_value")).distinct()
    matched = _join_cells(values, "_value", cells.hint("merge"), levels)
    return skew_join(df, matched, value, "_value", "inner", spread_by, shuffled=True)


def _join_cells(df: DataFrame, value: str, cells: DataFrame, levels: Sequence[int]) -> DataFrame:
    points = (df.withColumn("level", F.explode(F.array(*[F.lit(level) for level in levels])))
              .withColumn("cell", F.floor(F.col(value)).cast("long")))
    points = points.withColumn("cell", F.expr("shiftright(cell, level)"))
    # A value between two whole numbers has the cell of the lower one, which may be the end of its band.
    found = points.join(cells, ["level", "cell"]).where(F.col(value).between(F.col("start"), F.col("end")))
    return found.drop("level", "cell", "start", "end")


def band_cells(bands: DataFrame) -> DataFrame:
    """Cut ``[start, end]`` bands into disjoint cells ``[cell << level, (cell + 1) << level)``."""
    left = "-shiftright(-start, level)"
    right = "shiftright(end + 1, level)"
    spread = bands.where("start <= end").withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(CELL_LEVELS))))
    edges = spread.selectExpr("tagsId", "start", "end", "level", f"{left} AS l", f"{right} AS r").where("l < r")
    cells = F.array(F.when(F.pmod("l", F.lit(2)) == 1, F.col("l")),
                    F.when(F.pmod("r", F.lit(2)) == 1, F.col("r") - 1))
    return (edges.withColumn("cell", F.explode(F.array_compact(cells))).select("tagsId", "start", "end", "level", "cell"))


def unmatched(df: DataFrame, tagged: DataFrame, key: str = "userId") -> DataFrame:
    """Users that no rule tagged (null values, gaps in the bands, unknown values)."""
    return df.join(tagged.select(key).distinct(), key, "left_anti")


def rank_zip(items: DataFrame, item: str, score: str, rules: DataFrame, numeric_rank: bool = False) -> DataFrame:
    """Give the k-th best item the k-th rule: ``(item, score, rank, tagsId)``; the longer side is cut.

    Items go by score descending, then item descending; rules by their text, or
    by its number with ``numeric_rank``.
    """
    ranked = number_rows(items.select(item, score), [F.desc(score), F.desc(item)], "rank")
    rule_order = F.col("rule").cast("long") if numeric_rank else F.col("rule")
    slots = number_rows(rules.select("rule", F.col("id").alias("tagsId")), [rule_order, F.col("tagsId")], "rank")
    return ranked.join(slots.drop("rule"), "rank").select(item, score, "rank", "tagsId")

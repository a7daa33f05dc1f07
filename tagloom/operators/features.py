"""Feature vectors, category indexes, scaling and feature selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.feature import (MinMaxScaler, OneHotEncoder, StandardScaler, UnivariateFeatureSelector,
                                VectorAssembler, VectorIndexer)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.operators.joins import lookup_join
from tagloom.operators.ordering import number_rows
from tagloom.session import materialised


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric and vector columns, in order, as one vector."""
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(df)


def category_index(df: DataFrame, column: str) -> DataFrame:
    """``(label, index)``: labels numbered from 0 by frequency descending, ties by label."""
    counts = materialised(df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("label"))
                          .agg(F.count("*").alias("n")))
    return number_rows(counts, [F.desc("n"), F.asc("label")], "rn").select(
        "label", (F.col("rn") - 1).cast("double").alias("index"))


def index_strings(df: DataFrame, column: str, labels: DataFrame, output: str,
                  spread_by: Sequence[str] | None = None) -> DataFrame:
    """Replace a label by its index from ``category_index``."""
    return lookup_join(df, labels.withColumnRenamed("index", output), column, "label", "left", spread_by)


def index_to_string(df: DataFrame, column: str, labels: DataFrame, output: str,
                    spread_by: Sequence[str] | None = None) -> DataFrame:
    """Give an index its label back."""
    return lookup_join(df, labels.withColumnRenamed("label", output), column, "index", "left", spread_by)


def one_hot(df: DataFrame, column: str, output: str) -> DataFrame:
    """Sparse one-hot vector of an index column; the last category is the zero vector."""
    return OneHotEncoder(inputCol=column, outputCol=output).fit(df).transform(df)


def index_vector(df: DataFrame, column: str, output: str, max_categories: int = 20) -> DataFrame:
    """Renumber vector entries that take at most ``max_categories`` values from 0."""
    return VectorIndexer(inputCol=column, outputCol=output, maxCategories=max_categories).fit(df).transform(df)


def standard_scale(df: DataFrame, columns: Sequence[str], output: str = "scaled", with_mean: bool = False,
                   with_std: bool = True) -> tuple[DataFrame, PipelineModel]:
    """Scale to unit sample deviation, optionally around the mean; returns the rows and the fitted model."""
    vectors = assemble(df, columns, "_raw")
    model = StandardScaler(inputCol="_raw", outputCol=output, withMean=with_mean, withStd=with_std).fit(vectors)
    return model.transform(vectors).drop("_raw"), model


def min_max_scale(df: DataFrame, columns: Sequence[str], output: str = "scaled") -> DataFrame:
    """Scale every column to [0, 1]."""
    vectors = assemble(df, columns, "_raw")
    return MinMaxScaler(inputCol="_raw", outputCol=output).fit(vectors).transform(vectors).drop("_raw")


def chi_square(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(feature, statistic, dof)`` of the independence test of each categorical column against the label.

    All columns are counted in one pass; from then on only the counted
    (feature, value, label) cells are handled. Empty cells need
    no row of their own: the statistic is n * (sum of o^2 / (r * c) - 1). A row with a null value counts for
    the other features only, one with a null label not at all.
    """
    cells = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features])
    counted = (df.select(F.explode(cells).alias("c"), F.col(label).cast("string").alias("label"))
               .where("c.value is not null and label is not null").groupBy("c.feature", "c.value", "label").agg(F.count("*").alias("o")))
    per_value = counted.groupBy("feature", "value").agg(F.sum("o").alias("r"))
    per_label = (counted.join(per_value, ["feature", "value"]).groupBy("feature", "label")
                 .agg(F.sum(F.col("o") * F.col("o") / F.col("r")).alias("part"), F.sum("o").alias("c")))
    sums = per_label.groupBy("feature").agg(F.sum(F.col("part") / F.col("c")).alias("part"), F.sum("c").alias("n"),
                                            F.count("*").alias("labels"))
    sizes = per_value.groupBy("feature").agg(F.count("*").alias("values"))
    return sums.join(sizes, "feature").select(
        "feature", (F.col("n") * (F.col("part") - 1)).alias("statistic"),
        ((F.col("values") - 1) * (F.col("labels") - 1)).cast("long").alias("dof"))


def select_by_chi_square(df: DataFrame, features: str, label: str, top: int, output: str = "selected") -> DataFrame:
    """Keep the ``top`` entries of a categorical vector that depend most on the label."""
    selector = UnivariateFeatureSelector(featuresCol=features, labelCol=label, outputCol=output,
                                         selectionMode="numTopFeatures")
    selector.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(top)
    return selector.fit(df).transform(df)


def indexed_rows(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Rows of a matrix ``(row_id, v)``, numbered from 0 by key."""
    numbered = number_rows(df.select(key, *columns), [key], "rn")
    vector = F.array(*[F.col(c).cast("double") for c in columns])
    return numbered.select(key, (F.col("rn") - 1).alias("row_id"), vector.alias("v"))

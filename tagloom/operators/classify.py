"""Decision trees over categorical purchases, and the measures of a classifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexerModel, VectorAssembler, VectorIndexer
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hash_split(df: DataFrame, key: Sequence[str], train_share: float, seed: int = 100) -> DataFrame:
    """Add ``part`` = ``train`` or ``test`` by a hash of the key, the same on every run and retry."""
    bucket = F.pmod(F.xxhash64(F.lit(seed), *key), F.lit(1_000_000))
    return df.withColumn("part", F.when(bucket < round(train_share * 1_000_000), "train").otherwise("test"))


def tree_pipeline(features: Sequence[str], label: str, labels: Sequence[str], trees: int = 1, max_depth: int = 5,
                  seed: int = 100) -> Pipeline:
    """Label index, vector, categorical index, tree (or forest) and label text as one pipeline.

    ``labels`` is the short list of class names, most frequent first.
    """
    indexer = StringIndexerModel.from_labels(list(labels), inputCol=label, outputCol="label_index")
    vector = VectorAssembler(inputCols=list(features), outputCol="features")
    categories = VectorIndexer(inputCol="features", outputCol="features_index", handleInvalid="keep")
    options = dict(featuresCol="features_index", labelCol="label_index", predictionCol="predict", maxBins=64,
                   maxDepth=max_depth, weightCol="weight", seed=seed)
    tree = DecisionTreeClassifier(**options) if trees == 1 else RandomForestClassifier(numTrees=trees, **options)
    names = IndexToString(inputCol="predict", outputCol="predict_string", labels=list(labels))
    return Pipeline(stages=[indexer, vector, categories, tree, names])


def class_labels(cases: DataFrame, label: str) -> list[str]:
    """Class names of weighted cases, most frequent first, ties by name. Classes are few by nature."""
    totals = cases.groupBy(label).agg(F.sum("weight").alias("n"))
    return [row[label] for row in totals.orderBy(F.desc("n"), F.asc(label)).collect()]


def tree_rules(model: PipelineModel) -> str:
    """The decisions of a fitted tree as text."""
    return model.stages[3].toDebugString


def confusion(df: DataFrame, label: str, prediction: str, weight: str | None = None) -> DataFrame:
    """``(label, prediction, n)``, the only thing the measures below need."""
    n = F.sum(weight) if weight else F.count("*")
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(n.alias("n"))


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, error rate and F1 weighted by class size."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    actual = counts.select(F.col("label").alias("c"), hit.alias("tp"), F.col("n").alias("support"),
                           F.lit(0).alias("predicted"))
    guessed = counts.select(F.col("prediction").alias("c"), F.lit(0).alias("tp"), F.lit(0).alias("support"),
                            F.col("n").alias("predicted"))
    classes = actual.unionByName(guessed).groupBy("c").agg(
        F.sum("tp").alias("tp"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
    f1 = 2 * F.col("tp") / (F.col("support") + F.col("predicted"))
    measures = classes.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"),
                           F.sum(f1 * F.col("support")).alias("f1"))
    return measures.select((F.col("tp") / F.col("n")).alias("accuracy"),
                           (1 - F.col("tp") / F.col("n")).alias("error_rate"),
                           (F.col("f1") / F.col("n")).alias("weighted_f1"))


def hard_auc(counts: DataFrame, positive) -> DataFrame:
    """Area under the ROC curve of yes/no predictions: the mean of both classes' hit rates."""
    is_pos, said_pos = F.col("label") == F.lit(positive), F.col("prediction") == F.lit(positive)

    def total(condition):
        return F.sum(F.when(condition, F.col("n")).otherwise(0))

    tpr = F.try_divide(total(is_pos & said_pos), total(is_pos))
    tnr = F.try_divide(total(~is_pos & ~said_pos), total(~is_pos))
    return counts.agg(((tpr + tnr) / 2).alias("auc"))


def fit_line(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least-squares line through (x, y)."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def linear_regression(df: DataFrame, features: Sequence[str], label: str) -> tuple[DataFrame, PipelineModel]:
    """Standard-scale the features and fit a linear model; returns rows with ``prediction`` and the model."""
    stages = [VectorAssembler(inputCols=list(features), outputCol="_raw"),
              StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
              LinearRegression(featuresCol="features", labelCol=label, solver="normal")]
    model = Pipeline(stages=stages).fit(df)
    return model.transform(df).drop("_raw", "features"), model

"""A training corpus from ``documents``: each stage works on all that the one before it kept.

All stages take null ids, null, empty and very long texts, repeated rows, tables without rows and further columns of any name.
A null text is judged like an empty one. All but the last stage return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import lshforest, packing, pii, toxicity, wumanber
from tagloom.llm.common import table
from tagloom.session import materialised


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the segment search judges toxic go, a null or empty text only if such texts are labelled toxic."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id, and one row of each id.

    Rows without an id or without words are like no others and stay. Shingles are of two words, as in ``op8_lsh_forest``.
    """
    return lshforest.deduplicated(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of the benchmark go; those without words stay."""
    return wumanber.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; all documents stay, repeated and empty ones included."""
    return pii.redact(docs, pii.fit(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of all documents in sequences, one row per piece; a null or empty text is the end token alone."""
    return packing.pack(docs)


STAGES = [("toxicity", toxic), ("near duplicates", near_duplicates), ("decontamination", benchmarks),
          ("personal data", personal_data), ("packing", packed)]

# The stages learn from the data and tokenise, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialised(stage(spark, docs, sf_dir), "stage")
    return docs

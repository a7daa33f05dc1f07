"""Token counts, TF-IDF, count vectors and word embeddings over whole texts."""

from __future__ import annotations

from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, Tokenizer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.texts import tokens
from tagloom.operators.embedding import document_means, word_hashes
from tagloom.operators.joins import lookup_join
from tagloom.operators.ordering import number_rows
from tagloom.session import materialised, spread


def tokenize(df: DataFrame, text: str, output: str = "tokens") -> DataFrame:
    return df.withColumn(output, tokens(F.col(text)))


def _each(df: DataFrame, terms: Column) -> DataFrame:
    """One row per term. The outer form keeps Spark from splitting each text once more just to skip empty ones."""
    return df.select(F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def term_counts(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, term, tf)`` for the exact terms of every text; each row is a document.

    The tokens of a row are sorted and runs of equal ones measured in place, so
    nothing is shuffled.
    """
    words = spread(df).select(doc, F.sort_array(tokens(F.col(text))).alias("_w"))
    starts = words.select(doc, "_w", F.expr(
        "filter(sequence(0, greatest(size(_w) - 1, 0)), i -> i = 0 OR _w[i] != _w[greatest(i - 1, 0)])").alias("_start"))
    ends = "concat(slice(_start, 2, size(_w)), array(size(_w)))"
    runs = F.expr(f"zip_with(_start, {ends}, (a, b) -> struct(get(_w, a) AS term, CAST(b - a AS BIGINT) AS tf))")
    return starts.select(doc, F.inline_outer(runs)).where(F.col("term").isNotNull())


def inverse_document_frequency(df: DataFrame, text: str) -> DataFrame:
    """``(term, df, idf)`` with idf = ln((documents + 1) / (documents with the term + 1)).

    Each row is a document and hands out each of its terms once, so the only
    shuffle carries partial counts per term.
    """
    terms = _each(spread(df), F.array_distinct(tokens(F.col(text))))
    frequency = materialised(terms.groupBy("term").agg(F.count("*").alias("df")))
    return frequency.withColumn("idf", F.log((F.lit(float(df.count())) + 1) / (F.col("df") + 1)))


def tf_idf(df: DataFrame, doc: str, text: str) -> DataFrame:
    """``(doc, term, tf, idf, tf_idf)`` for the exact terms of every text."""
    counts = term_counts(df, doc, text).withColumnRenamed("term", "_term")
    idf = inverse_document_frequency(df, text).select("term", "idf")
    joined = lookup_join(counts, idf, "_term", "term", "inner", [doc, "_term"])
    return joined.select(doc, F.col("_term").alias("term"), "tf", "idf",
                         (F.col("tf") * F.col("idf")).alias("tf_idf"))


def hashed_tf_idf(df: DataFrame, text: str, buckets: int = 1 << 18) -> DataFrame:
    """Token, hashed term frequency and TF-IDF vectors."""
    words = Tokenizer(inputCol=text, outputCol="tokens").transform(df)
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=buckets).transform(words)
    return IDF(inputCol="tf", outputCol="tf_idf").fit(tf).transform(tf)


def vocabulary(df: DataFrame, text: str) -> DataFrame:
    """``(term, term_index)`` by frequency in the whole corpus, ties by term."""
    terms = _each(spread(df), tokens(F.col(text)))
    totals = materialised(terms.groupBy("term").agg(F.count("*").alias("n")))
    return number_rows(totals, [F.desc("n"), F.asc("term")], "rn").select(
        "term", (F.col("rn") - 1).alias("term_index"))


def count_vectors(df: DataFrame, doc: str, text: str) -> DataFrame:
    """Count vectors in long form ``(doc, term, term_index, tf)`` over the full vocabulary."""
    terms = vocabulary(df, text).withColumnRenamed("term", "_t")
    return lookup_join(term_counts(df, doc, text), terms, "term", "_t", "inner", [doc, "term"]).select(
        doc, "term", "term_index", "tf")


def count_vectorizer(df: DataFrame, tokens_column: str, output: str = "counts") -> DataFrame:
    """Count vectors as sparse ML vectors over all terms, for vocabularies the driver can hold."""
    terms = df.select(F.explode(tokens_column).alias("term")).distinct().count()
    return CountVectorizer(inputCol=tokens_column, outputCol=output, vocabSize=max(1, terms)).fit(df).transform(df)


def word_vectors(df: DataFrame, tokens_column: str, size: int = 3, min_count: int = 0, seed: int = 1,
                 output: str = "vector", partitions: int = 8, sentence_length: int = 1000) -> DataFrame:
    """Mean word embedding of each document; texts beyond ``sentence_length`` words are trained in pieces of that length.

    The number of training partitions is part of the model, so it is a parameter and not a cluster setting; there are more
    of them when one would hold more than ``embedding.PART_WORDS`` words. A text without words, or null, has the mean zero.
    """
    means = document_means(df, tokens_column, size, min_count, seed, partitions, sentence_length)
    # Null without words, so that only the key and not the words has to meet the means.
    keyed = df.withColumn("_doc", F.when(F.size(tokens_column) > 0, F.xxhash64(word_hashes(F.col(tokens_column)))))
    found = lookup_join(keyed, means.withColumnsRenamed({"doc": "_key", "mean": "_mean"}), "_doc", "_key", "left")
    vector = F.when(F.col("_doc").isNotNull(), F.col("_mean")).otherwise(F.array(*[F.lit(0.0)] * size))
    return found.withColumn(output, array_to_vector(vector)).drop("_doc", "_mean")

"""Queries over feature vectors, indexes, scaling and text features."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tagloom.catalogue.registry import query, table
from tagloom.functions.texts import tokens
from tagloom.operators import features as feat
from tagloom.operators import text as txt

_TOKENS_SQL = r"""(SELECT doc_id, regexp_split_to_array(lower(regexp_replace(text, '\s+$', '')), '\s') AS words FROM documents)"""
_TF_SQL = f"(SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(words) AS term FROM {_TOKENS_SQL} t) GROUP BY 1, 2)"


@query("l1_assemble", """
  SELECT l_orderkey, l_linenumber, l_quantity AS v0, l_tax AS v1, CAST(l_linenumber AS DOUBLE) AS v2, l_quantity AS v3,
         l_discount AS v4, 5 AS size FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_tax", "l_discount")
    pair = feat.assemble(rows, ["l_quantity", "l_discount"], "pair")
    v = vector_to_array("features")
    return feat.assemble(pair, ["l_quantity", "l_tax", "l_linenumber", "pair"]).select(
        "l_orderkey", "l_linenumber", *[v[i].alias(f"v{i}") for i in range(5)], F.size(v).alias("size"))


@query("l2_tokens", f"""
  SELECT doc_id, CAST(len(words) AS INTEGER) AS n_tokens, array_to_string(words, '|') AS words FROM {_TOKENS_SQL} t""")
def _(spark, sf):
    words = tokens(F.col("text"))
    return table(spark, sf, "documents").select("doc_id", F.size(words).alias("n_tokens"),
                                                F.array_join(words, "|").alias("words"))


@query("l3_tf", f"SELECT doc_id, term, CAST(tf AS BIGINT) AS tf FROM {_TF_SQL} t")
def _(spark, sf):
    return txt.term_counts(table(spark, sf, "documents"), "doc_id", "text")


@query("l3_hashing_tf", f"""
  SELECT doc_id, CAST(len(words) AS DOUBLE) AS total, 1024 AS size, true AS idf_not_negative FROM {_TOKENS_SQL} t""")
def _(spark, sf):
    vectors = txt.hashed_tf_idf(table(spark, sf, "documents").select("doc_id", "text"), "text", 1024)
    tf = vector_to_array("tf")
    return vectors.select("doc_id", F.aggregate(tf, F.lit(0.0), lambda a, x: a + x).alias("total"),
                          F.size(tf).alias("size"), (F.array_min(vector_to_array("tf_idf")) >= 0).alias("idf_not_negative"))


@query("l4_tfidf", f"""
  WITH tf AS (SELECT * FROM {_TF_SQL} t),
       idf AS (SELECT term, ln(((SELECT count(*) FROM documents) + 1.0::DOUBLE) / (count(*) + 1)) AS idf FROM tf GROUP BY 1)
  SELECT doc_id, term, CAST(tf AS BIGINT) AS tf, round(idf, 9) AS idf, round(tf * idf, 9) AS tf_idf FROM tf JOIN idf USING (term)""")
def _(spark, sf):
    result = txt.tf_idf(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")
    return result.withColumn("idf", F.round("idf", 9)).withColumn("tf_idf", F.round("tf_idf", 9))


@query("l5_word2vec", "SELECT doc_id, 3 AS size, true AS finite FROM documents")
def _(spark, sf):
    docs = txt.tokenize(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")
    v = vector_to_array("vector")
    return txt.word_vectors(docs, "tokens").select("doc_id", F.size(v).alias("size"),
                                                   F.forall(v, lambda x: ~F.isnan(x)).alias("finite"))


@query("l6_countvec", f"""
  WITH tf AS (SELECT * FROM {_TF_SQL} t),
       vocabulary AS (SELECT term, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS term_index FROM tf GROUP BY 1)
  SELECT doc_id, term, CAST(term_index AS BIGINT) AS term_index, CAST(tf AS BIGINT) AS tf FROM tf JOIN vocabulary USING (term)""")
def _(spark, sf):
    return txt.count_vectors(table(spark, sf, "documents").select("doc_id", "text"), "doc_id", "text")


_BRAND_INDEX_SQL = """(SELECT p_brand AS label, CAST(row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS DOUBLE) AS index
  FROM part GROUP BY 1)"""


def _brands(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", "p_brand")
    labels = feat.category_index(parts, "p_brand")
    return feat.index_strings(parts, "p_brand", labels, "brand_index", ["p_partkey"]), labels


@query("l7_string_index", f"""
  SELECT p_partkey, p_brand, index AS brand_index FROM part JOIN {_BRAND_INDEX_SQL} i ON p_brand = label""")
def _(spark, sf):
    return _brands(spark, sf)[0]


@query("l8_index_to_string", "SELECT p_partkey, p_brand AS original, p_brand AS decoded FROM part")
def _(spark, sf):
    indexed, labels = _brands(spark, sf)
    return feat.index_to_string(indexed, "brand_index", labels, "decoded", ["p_partkey"]).select(
        "p_partkey", F.col("p_brand").alias("original"), "decoded")


@query("l9_one_hot", f"""
  SELECT p_partkey, CAST(n - 1 AS INTEGER) AS size, CAST(CASE WHEN index < n - 1 THEN index ELSE -1 END AS INTEGER) AS hot
  FROM part JOIN {_BRAND_INDEX_SQL} i ON p_brand = label, (SELECT count(DISTINCT p_brand) AS n FROM part) c""")
def _(spark, sf):
    indexed, _ = _brands(spark, sf)
    v = vector_to_array("hot")
    return feat.one_hot(indexed, "brand_index", "hot").select(
        "p_partkey", F.size(v).alias("size"), (F.array_position(v, 1.0) - 1).cast("int").alias("hot"))


@query("l10_vector_index", """
  SELECT p_partkey, CAST(dense_rank() OVER (ORDER BY length(p_type)) - 1 AS DOUBLE) AS kind, CAST(p_size AS DOUBLE) AS size
  FROM part""")
def _(spark, sf):
    parts = table(spark, sf, "part").select("p_partkey", F.length("p_type").alias("n"), "p_size")
    v = vector_to_array("indexed")
    return feat.index_vector(feat.assemble(parts, ["n", "p_size"]), "features", "indexed").select(
        "p_partkey", v[0].alias("kind"), v[1].alias("size"))


@query("l11_standard_scale", """
  SELECT l_orderkey, l_linenumber, round((l_quantity - mq) / sq, 6) AS q, round((l_extendedprice - mp) / sp, 6) AS p
  FROM lineitem, (SELECT avg(l_quantity) AS mq, stddev_samp(l_quantity) AS sq, avg(l_extendedprice) AS mp,
                         stddev_samp(l_extendedprice) AS sp FROM lineitem) s""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    scaled, _ = feat.standard_scale(rows, ["l_quantity", "l_extendedprice"], with_mean=True)
    v = vector_to_array("scaled")
    return scaled.select("l_orderkey", "l_linenumber", F.round(v[0], 6).alias("q"), F.round(v[1], 6).alias("p"))


@query("l12_min_max_scale", """
  SELECT l_orderkey, l_linenumber, round((l_quantity - lq) / (hq - lq), 6) AS q, round((l_extendedprice - lp) / (hp - lp), 6) AS p
  FROM lineitem, (SELECT min(l_quantity) AS lq, max(l_quantity) AS hq, min(l_extendedprice) AS lp,
                         max(l_extendedprice) AS hp FROM lineitem) s""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    v = vector_to_array("scaled")
    return feat.min_max_scale(rows, ["l_quantity", "l_extendedprice"]).select(
        "l_orderkey", "l_linenumber", F.round(v[0], 6).alias("q"), F.round(v[1], 6).alias("p"))


_CHI_FEATURES = ["l_returnflag", "l_linenumber", "l_discount", "l_quantity"]


def _chi_sql(column):
    return f"""SELECT '{column}' AS feature, round(sum((o - e) * (o - e) / e), 6) AS statistic,
        CAST((count(DISTINCT v) - 1) * (count(DISTINCT s) - 1) AS BIGINT) AS dof FROM (
      SELECT r.v, c.s, coalesce(o.n, 0) AS o, r.n * c.n / (SELECT CAST(count(*) AS DOUBLE) FROM lineitem) AS e
      FROM (SELECT {column} AS v, count(*) AS n FROM lineitem GROUP BY 1) r
      CROSS JOIN (SELECT l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1) c
      LEFT JOIN (SELECT {column} AS v, l_linestatus AS s, count(*) AS n FROM lineitem GROUP BY 1, 2) o ON o.v = r.v AND o.s = c.s)"""


@query("l13_chisq", " UNION ALL ".join(_chi_sql(c) for c in _CHI_FEATURES))
def _(spark, sf):
    return feat.chi_square(table(spark, sf, "lineitem"), _CHI_FEATURES, "l_linestatus").withColumn(
        "statistic", F.round("statistic", 6))


@query("l13_select", """
  SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 0.0::DOUBLE WHEN 'N' THEN 1 ELSE 2 END AS selected,
         1 AS size FROM lineitem""")
def _(spark, sf):
    # The label is the flag itself, so the flag must be the feature that is kept.
    flag = F.when(F.col("l_returnflag") == "A", 0.0).when(F.col("l_returnflag") == "N", 1.0).otherwise(2.0)
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", flag.alias("flag"))
    vectors = feat.assemble(rows, ["l_quantity", "flag", "l_linenumber"])
    v = vector_to_array("selected")
    return feat.select_by_chi_square(vectors, "features", "flag", 1).select(
        "l_orderkey", "l_linenumber", v[0].alias("selected"), F.size(v).alias("size"))


@query("l25_indexed_rows", """
  SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS row_id, o_totalprice AS v0,
         CAST(o_custkey AS DOUBLE) AS v1 FROM orders""")
def _(spark, sf):
    rows = feat.indexed_rows(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice", "o_custkey"])
    return rows.select("o_orderkey", "row_id", F.col("v")[0].alias("v0"), F.col("v")[1].alias("v1"))

"""Queries over the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalogue.registry import bins_sql, query, table
from tagloom.catalogue.tables import (BRAND_CODES, COUPON_SQL, EVENTS_AS_OF, FEMALE_BRANDS, FEMALE_PART_TYPES, LOGS_SQL,
                                      ORDERS_AS_OF, PART_TYPE_CODES, coupon_source, goods_source, log_source, order_source)
from tagloom.functions.dates import (compact_date, days_since, epoch_to_text, reference_day, timestamp_to_epoch)
from tagloom.functions.scores import RFE_BINS, RFM_BINS, discount_columns
from tagloom.functions.shopping import dictionary_code, purchase_label, vote_rule
from tagloom.functions.texts import is_blank, item_of_url, struct_field_csv
from tagloom.operators.aggregates import implicit_ratings, votes
from tagloom.operators.ordering import top_n_per_group
from tagloom.plans.tags import psm_features, rfe_features, rfm_features, score

# The bins moved to the quartiles of the given tables, so that every score occurs.
SCALED_RFM = {
    "recency": [(None, 30, 5), (31, 90, 4), (91, 180, 3), (181, 365, 2), (366, None, 1)],
    "frequency": [(14, None, 5), (11, 13, 4), (8, 10, 3), (5, 7, 2), (None, 4, 1)],
    "monetary": [(3060000, None, 5), (2460000, 3060000, 4), (1850000, 2460000, 3), (900000, 1850000, 2), (None, 900000, 1)],
}
SCALED_RFE = {
    "recency": [(None, 1, 5), (2, 2, 4), (3, 3, 3), (4, 5, 2), (6, None, 1)],
    "frequency": [(75, None, 5), (70, 74, 4), (65, 69, 3), (60, 64, 2), (None, 59, 1)],
    "engagements": [(55, None, 5), (52, 54, 4), (49, 51, 3), (45, 48, 2), (None, 44, 1)],
}


def dates(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate")


@query("f1_compact_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS day FROM orders")
def _(spark, sf):
    return dates(spark, sf).select("o_orderkey", compact_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))


@query("f2_epoch", """
  SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, strftime(ts, '%Y-%m-%d %H:%M:%S') AS moment FROM events""")
def _(spark, sf):
    seconds = timestamp_to_epoch(F.col("ts"))
    return table(spark, sf, "events").select("event_id", seconds.alias("seconds"), epoch_to_text(seconds).alias("moment"))


@query("f3_as_of", f"SELECT o_orderkey, '{ORDERS_AS_OF}' AS as_of FROM orders")
def _(spark, sf):
    return dates(spark, sf).select("o_orderkey", reference_day(ORDERS_AS_OF).cast("string").alias("as_of"))


@query("f4_date_sub", f"SELECT o_orderkey, strftime(DATE '{ORDERS_AS_OF}' - INTERVAL 206 DAY, '%Y-%m-%d') AS day FROM orders")
def _(spark, sf):
    return dates(spark, sf).select("o_orderkey", reference_day(ORDERS_AS_OF, 206).cast("string").alias("day"))


@query("f5_datediff", f"""
  SELECT o_orderkey, CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '{ORDERS_AS_OF}') - 200 AS INTEGER) AS days FROM orders""")
def _(spark, sf):
    return dates(spark, sf).select("o_orderkey", days_since(F.col("o_orderdate"), ORDERS_AS_OF, 200).alias("days"))


@query("f6_split", """
  SELECT c_custkey, split_part(c_name, '#', 1) AS head, split_part(c_name, '#', 2) AS tail FROM customer""")
def _(spark, sf):
    parts = F.split("c_name", "#")
    return table(spark, sf, "customer").select("c_custkey", parts[0].alias("head"), parts[1].alias("tail"))


@query("f7_when", """
  SELECT l_orderkey, l_linenumber, CASE WHEN l_quantity > 40 THEN 3 WHEN l_quantity > 20 THEN 2 END AS bulk,
         CASE WHEN l_returnflag = 'R' THEN 'back' ELSE 'kept' END AS state FROM lineitem""")
def _(spark, sf):
    q = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(q > 40, 3).when(q > 20, 2).alias("bulk"),
        F.when(F.col("l_returnflag") == "R", "back").otherwise("kept").alias("state"))


@query("f8_arithmetic", """
  SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity + l_tax - l_discount AS unit,
         l_tax / nullif(l_discount, 0) AS ratio, l_discount <> 0 AND l_quantity > 25 OR l_tax = 0 AS flag
  FROM lineitem""")
def _(spark, sf):
    d, t, q = F.col("l_discount"), F.col("l_tax"), F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / q + t - d).alias("unit"),
        F.try_divide(t, d).alias("ratio"), ((d != 0) & (q > 25) | (t == 0)).alias("flag"))


@query("f9_blank", r"""
  SELECT doc_id, regexp_replace(coalesce(text, ''), '\s+', '', 'g') = '' AS blank,
         regexp_replace(regexp_replace(lang, '[a-z]', ' '), '\s+', '', 'g') = '' AS some_blank FROM documents""")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", is_blank(F.col("text")).alias("blank"),
                                                is_blank(F.regexp_replace("lang", "^[a-z]", " ")).alias("some_blank"))


@query("f10_arrays", """
  SELECT p_partkey, list_aggregate(list_sort(list_distinct(list_concat(string_split(p_name, ' '),
         [p_type, p_brand, split_part(p_name, ' ', 1)]))), 'string_agg', '|') AS words FROM part""")
def _(spark, sf):
    words = F.split("p_name", " ")
    both = F.array_union(words, F.array("p_type", "p_brand", words[0]))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.array_sort(both), "|").alias("words"))


@query("f11_item_of_url", f"SELECT user_id, url, item FROM {LOGS_SQL} l")
def _(spark, sf):
    return log_source(spark, sf).select(F.col("global_user_id").alias("user_id"), F.col("loc_url").alias("url"),
                                        item_of_url(F.col("loc_url")).alias("item"))


@query("f11_item_of_page", """
  SELECT page_id, CASE WHEN s > 0 AND e > s THEN substring(u, s + 9, e - s - 9) END AS item FROM (
    SELECT *, instr(u, '/product/') AS s, instr(u, '.html') AS e FROM (
      SELECT page_id, CASE WHEN contains(url, '?') THEN replace(url, '.example', '.html') || '/product/7.html'
                           WHEN contains(url, '#') THEN url || '/product/.html'
                           ELSE replace(url, '/en/', '/product/') || '.html' END AS u FROM pages))""")
def _(spark, sf):
    url = F.col("url")
    built = (F.when(url.contains("?"), F.concat(F.replace(url, F.lit(".example"), F.lit(".html")), F.lit("/product/7.html")))
             .when(url.contains("#"), F.concat(url, F.lit("/product/.html")))
             .otherwise(F.concat(F.replace(url, F.lit("/en/"), F.lit("/product/")), F.lit(".html"))))
    return table(spark, sf, "pages").select("page_id", item_of_url(built).alias("item"))


@query("f12_struct_csv", f"""
  SELECT user_id, string_agg(item, ',' ORDER BY rn) AS items FROM (
    SELECT user_id, item, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item) AS rn
    FROM {LOGS_SQL} l WHERE item IS NOT NULL GROUP BY 1, 2) WHERE rn <= 5 GROUP BY 1""")
def _(spark, sf):
    logs = log_source(spark, sf).select(F.col("global_user_id").alias("user_id"), item_of_url(F.col("loc_url")).alias("item"))
    best = top_n_per_group(implicit_ratings(logs, "user_id", "item"), "user_id", [F.desc("rating"), F.asc("item")], 5)
    lists = best.groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("rn", "item"))).alias("rated"))  # five each
    return lists.select("user_id", struct_field_csv(F.col("rated"), "item").alias("items"))


def _code_sql(column, codes):
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in codes.items()) + " ELSE 0 END"


@query("f13_dictionary", f"""
  SELECT p_partkey, {_code_sql('p_brand', BRAND_CODES)} AS color, {_code_sql('p_type', PART_TYPE_CODES)} AS product_type
  FROM part""")
def _(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey", dictionary_code(F.col("p_brand"), BRAND_CODES).alias("color"),
        dictionary_code(F.col("p_type"), PART_TYPE_CODES).alias("product_type"))


def label_sql(brand="p_brand", kind="p_type"):
    brands = ", ".join(f"'{b}'" for b in FEMALE_BRANDS)
    kinds = ", ".join(f"'{k}'" for k in FEMALE_PART_TYPES)
    return f"CASE WHEN {brand} IN ({brands}) OR {kind} IN ({kinds}) THEN '女' ELSE '男' END"


@query("f14_label", f"SELECT p_partkey, {label_sql()} AS gender FROM part")
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", purchase_label(
        F.col("p_brand"), F.col("p_type"), FEMALE_BRANDS, FEMALE_PART_TYPES).alias("gender"))


@query("f15_vote", f"""
  SELECT o, CASE WHEN m / n > 0.6 THEN '0' WHEN f / n > 0.6 THEN '1' ELSE '-1' END AS rule FROM (
    SELECT CAST(l_orderkey AS VARCHAR) AS o, sum(CASE WHEN g = '男' THEN 1.0::DOUBLE ELSE 0 END) AS m,
           sum(CASE WHEN g = '女' THEN 1.0::DOUBLE ELSE 0 END) AS f, CAST(count(*) AS DOUBLE) AS n
    FROM (SELECT l_orderkey, {label_sql()} AS g FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY 1)""")
def _(spark, sf):
    label = purchase_label(F.col("ogColor"), F.col("productType"), FEMALE_BRANDS, FEMALE_PART_TYPES)
    counted = votes(goods_source(spark, sf), "cOrderSn", label == "男", label == "女")
    return counted.select(F.col("cOrderSn").alias("o"), vote_rule(F.col("male"), F.col("female"), F.col("total")).alias("rule"))


RFM_SQL = f"""(SELECT CAST(o_custkey AS VARCHAR) AS u,
  date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{ORDERS_AS_OF}') AS recency,
  count(*) AS frequency, sum(o_totalprice) AS monetary FROM orders GROUP BY 1)"""
RFE_SQL = f"""(SELECT user_id AS u, date_diff('day', CAST(max(ts) AS DATE), DATE '{EVENTS_AS_OF}') AS recency,
  count(url) AS frequency, count(DISTINCT url) AS engagements FROM {LOGS_SQL} l GROUP BY 1)"""


def scores_sql(source, bins):
    return f"SELECT u AS \"userId\", {', '.join(f'{bins_sql(c, b)} AS {c}' for c, b in bins.items())} FROM {source} s"


@query("f16_rfm_scores", scores_sql(RFM_SQL, RFM_BINS))
def _(spark, sf):
    return score(rfm_features(order_source(spark, sf), ORDERS_AS_OF), RFM_BINS)


@query("f16_rfm_scores_scaled", scores_sql(RFM_SQL, SCALED_RFM))
def _(spark, sf):
    return score(rfm_features(order_source(spark, sf), ORDERS_AS_OF), SCALED_RFM)


@query("f17_rfe_scores", scores_sql(RFE_SQL, RFE_BINS))
def _(spark, sf):
    return score(rfe_features(log_source(spark, sf), EVENTS_AS_OF), RFE_BINS)


@query("f17_rfe_scores_scaled", scores_sql(RFE_SQL, SCALED_RFE))
def _(spark, sf):
    return score(rfe_features(log_source(spark, sf), EVENTS_AS_OF), SCALED_RFE)


PSM_SQL = f"""(SELECT u, tdon / ton + (tda / nullif(tdon, 0)) / (tra / ton) + tda / tra AS psm FROM (
  SELECT "memberId" AS u, CAST(count(*) FILTER (WHERE coupon <> 0) AS DOUBLE) AS tdon, CAST(count(*) AS DOUBLE) AS ton,
         sum(coupon) AS tda, sum(amount + coupon) AS tra FROM {COUPON_SQL} c GROUP BY 1) WHERE tdon > 0)"""


@query("f18_psm", f'SELECT u AS "userId", round(psm, 9) AS psm FROM {PSM_SQL} p')
def _(spark, sf):
    return psm_features(coupon_source(spark, sf)).withColumn("psm", F.round("psm", 9))


@query("f19_discount_columns", f"""
  SELECT "memberId", amount + coupon AS ra, coupon AS da, amount AS pa, CASE WHEN coupon <> 0 THEN 1 ELSE 0 END AS state
  FROM {COUPON_SQL} c""")
def _(spark, sf):
    amount, coupon = F.col("orderAmount").cast("double"), F.col("couponCodeValue").cast("double")
    return coupon_source(spark, sf).select("memberId", *discount_columns(amount, coupon))


@query("f20_pow", "SELECT l_orderkey, l_linenumber, round(l_quantity ** 2, 6) AS q2, round(l_discount ** 3, 9) AS d3 FROM lineitem")
def _(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(F.pow("l_quantity", F.lit(2)), 6).alias("q2"),
                                               F.round(F.pow("l_discount", F.lit(3)), 9).alias("d3"))

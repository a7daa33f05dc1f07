"""Queries over projections, joins, aggregates, ranks and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalogue.registry import query, rules_frame, table, values_sql
from tagloom.catalogue.tables import COUPON_SQL, LOGS_SQL, ORDERS_AS_OF, coupon_source, log_source
from tagloom.functions.dates import days_since
from tagloom.functions.texts import item_of_url, tag_set
from tagloom.operators import aggregates as agg
from tagloom.operators.classify import hash_split
from tagloom.operators.joins import skew_join
from tagloom.operators.match import match_exact, match_range, rank_zip, unmatched
from tagloom.operators.ordering import first_rows, number_rows, rank_in_group, rank_in_group_sql, top_n_per_group
from tagloom.operators.profile import merge_new_users, merge_new_users_sql
from tagloom.operators.rules import range_rules

SEGMENT_RULES = [(8, "AUTOMOBILE"), (9, "BUILDING"), (10, "FURNITURE"), (11, "HOUSEHOLD"), (12, "MACHINERY")]
OTHER_RULES = [(30, "AUTOMOBILE"), (31, "BUILDING"), (32, "FURNITURE"), (35, "other")]
# A gap from 31 to 60 and an overlap from 100 to 150.
BAND_RULES = [(24, "0-7"), (25, "8-14"), (26, "15-30"), (27, "61-150"), (28, "100-400"), (29, "401-3000")]


# --- projections and filters ------------------------------------------------------------------------------------

@query("p1_rename", 'SELECT c_custkey AS "userId", c_mktsegment AS job FROM customer')
def _(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").alias("userId"), F.col("c_mktsegment").alias("job"))


@query("p2_equality", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderpriority = '2-HIGH' AND o_orderstatus = 'F'")
def _(spark, sf):
    return (table(spark, sf, "orders").where("o_orderpriority = '2-HIGH'").where(F.col("o_orderstatus") == "F")
            .select("o_orderkey", "o_custkey"))


@query("p3_not_null", f"""
  SELECT user_id AS "userId", item FROM {LOGS_SQL} l WHERE user_id IS NOT NULL AND item IS NOT NULL""")
def _(spark, sf):
    logs = log_source(spark, sf).select(F.col("global_user_id").alias("userId"), item_of_url(F.col("loc_url")).alias("item"))
    return logs.where(F.col("userId").isNotNull() & F.col("item").isNotNull())


@query("p4_computed_column", """
  SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
         round(l_extendedprice * (1 - l_discount), 4) AS paid FROM lineitem""")
def _(spark, sf):
    return (table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
            .withColumn("paid", F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)))


@query("p5_positional_rename", 'SELECT p_partkey AS "tagsId", p_size AS start, p_name AS "end" FROM part')
def _(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_size", "p_name").toDF("tagsId", "start", "end")


@query("p6_cast", r"""
  SELECT page_id, TRY_CAST(regexp_extract(url, '/([^/?#]*)([?#].*)?$', 1) AS INTEGER) AS number,
         CAST(page_id AS DOUBLE) AS id_double FROM pages""")
def _(spark, sf):
    last = F.regexp_extract("url", r"/([^/?#]*)([?#].*)?$", 1)
    return table(spark, sf, "pages").select("page_id", last.try_cast("int").alias("number"),
                                            F.col("page_id").cast("double").alias("id_double"))


@query("p7_between", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity BETWEEN 10 AND 20")
def _(spark, sf):
    return (table(spark, sf, "lineitem").where(F.col("l_quantity").between(10, 20))
            .select("l_orderkey", "l_linenumber", "l_quantity"))


@query("p8_outliers", """
  SELECT kept, l_orderkey, l_extendedprice, l_quantity FROM (
    SELECT true AS kept, * FROM lineitem
    WHERE (l_extendedprice > 2000 AND l_extendedprice < 80000) OR (l_quantity > 2 AND l_quantity < 45)
    UNION ALL
    SELECT false AS kept, * FROM lineitem
    WHERE l_extendedprice > 80000 OR l_extendedprice < 2000 OR l_quantity < 2 OR l_quantity > 45)""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice", "l_quantity")
    kept, bad = agg.outlier_filter(rows, "l_extendedprice", "l_quantity", (2000, 80000), (2, 45))
    return kept.withColumn("kept", F.lit(True)).unionByName(bad.withColumn("kept", F.lit(False)))


# --- joins ------------------------------------------------------------------------------------------------------

@query("j1_match_exact", f"""
  SELECT c_custkey, c_mktsegment, r.id AS "tagsId" FROM customer
  JOIN {values_sql(SEGMENT_RULES, 'r(id, rule)')} ON c_mktsegment = r.rule""")
def _(spark, sf):
    users = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return match_exact(users, "c_mktsegment", rules_frame(spark, SEGMENT_RULES))


@query("j1_match_exact_drop", f"""
  SELECT c_custkey, c_mktsegment, r.id AS "tagsId" FROM customer
  JOIN {values_sql(SEGMENT_RULES[:4], 'r(id, rule)')} ON c_mktsegment = r.rule""")
def _(spark, sf):
    users = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return match_exact(users, "c_mktsegment", rules_frame(spark, SEGMENT_RULES[:4]), on_missing="drop")


@query("j2_match_default", f"""
  SELECT c_custkey, c_mktsegment, coalesce(r.id, 35) AS "tagsId" FROM customer
  LEFT JOIN {values_sql(OTHER_RULES, 'r(id, rule)')} ON c_mktsegment = r.rule""")
def _(spark, sf):
    users = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return match_exact(users, "c_mktsegment", rules_frame(spark, OTHER_RULES), default="other")


_DAYS_SQL = f"""(SELECT o_custkey, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{ORDERS_AS_OF}') AS INTEGER)
  AS days FROM orders GROUP BY o_custkey)"""
_BANDS_SQL = f"""(SELECT id, CAST(split_part(rule, '-', 1) AS INTEGER) AS lo, CAST(split_part(rule, '-', 2) AS INTEGER) AS hi
  FROM {values_sql(BAND_RULES, 'r(id, rule)')})"""


def _order_days(spark, sf):
    last = agg.last_event(table(spark, sf, "orders"), "o_custkey", "o_orderdate")
    return last.select("o_custkey", days_since(F.col("last_time"), ORDERS_AS_OF).alias("days"))


@query("j3_match_range", f"""
  SELECT o_custkey, days, b.id AS "tagsId" FROM {_DAYS_SQL} d JOIN {_BANDS_SQL} b ON days BETWEEN lo AND hi""")
def _(spark, sf):
    bands = range_rules(rules_frame(spark, BAND_RULES))
    return match_range(_order_days(spark, sf), "days", bands, ["o_custkey"])


@query("j3_match_many_ranges", """
  SELECT l.o_orderkey, b.p_partkey AS "tagsId" FROM (
      SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS price FROM orders) l
  JOIN (SELECT p_partkey, CAST(floor(p_retailprice * p_size * 7) AS BIGINT) AS lo, p_size * 20 AS width FROM part) b
    ON l.price BETWEEN b.lo AND b.lo + b.width""")
def _(spark, sf):
    low = F.floor(F.col("p_retailprice") * F.col("p_size") * 7).cast("long")
    bands = table(spark, sf, "part").select(F.col("p_partkey").alias("tagsId"), low.alias("start"),
                                            (low + F.col("p_size") * 20).alias("end"))
    prices = table(spark, sf, "orders").select("o_orderkey", F.floor("o_totalprice").cast("long").alias("price"))
    return match_range(prices, "price", bands, ["o_orderkey"]).select("o_orderkey", "tagsId")


@query("j3_match_decimals", """
  SELECT l.o_orderkey, b.p_partkey AS "tagsId" FROM orders l
  JOIN (SELECT p_partkey, CAST(floor(p_retailprice * p_size * 7) AS BIGINT) AS lo, p_size * 20 AS width FROM part) b
    ON l.o_totalprice BETWEEN b.lo AND b.lo + b.width""")
def _(spark, sf):
    low = F.floor(F.col("p_retailprice") * F.col("p_size") * 7).cast("long")
    bands = table(spark, sf, "part").select(F.col("p_partkey").alias("tagsId"), low.alias("start"),
                                            (low + F.col("p_size") * 20).alias("end"))
    prices = table(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("price"))
    return match_range(prices, "price", bands, ["o_orderkey"]).select("o_orderkey", "tagsId")


@query("j3_unmatched", f"""
  SELECT o_custkey, days FROM {_DAYS_SQL} d
  WHERE NOT EXISTS (SELECT 1 FROM {_BANDS_SQL} b WHERE days BETWEEN lo AND hi)""")
def _(spark, sf):
    days = _order_days(spark, sf)
    tagged = match_range(days, "days", range_rules(rules_frame(spark, BAND_RULES)), ["o_custkey"])
    return unmatched(days, tagged, "o_custkey")


@query("j4_items_orders", """
  SELECT o_custkey, l_orderkey, l_linenumber, p_type FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""")
def _(spark, sf):
    # The row position is taken at the scan, where a retried task finds the same order again.
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                F.monotonically_increasing_id().alias("row"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    parts = table(spark, sf, "part").select("p_partkey", "p_type")
    typed = skew_join(items, parts, "l_partkey", "p_partkey", "inner", ["row"])
    return skew_join(typed, orders, "l_orderkey", "o_orderkey", "inner", ["row"], items).select(
        "o_custkey", "l_orderkey", "l_linenumber", "p_type")


# New tags by segment, old tags by balance (none for customers with little money).
_NEW_OLD_SQL = f"""
  new AS (SELECT CAST(c_custkey AS VARCHAR) AS u, CAST(r.id AS VARCHAR) AS t FROM customer
          JOIN {values_sql(SEGMENT_RULES, 'r(id, rule)')} ON c_mktsegment = r.rule),
  old AS (SELECT CAST(c_custkey AS VARCHAR) AS u, CASE WHEN c_acctbal > 5000 THEN '12,6,6' WHEN c_acctbal < 0 THEN ' ' ELSE '5' END AS t
          FROM customer WHERE c_acctbal > 1000 OR c_acctbal < 0)"""
_UNION_SQL = """list_aggregate(list_sort(list_distinct(list_filter(
  string_split(concat_ws(',', n.t, o.t), ','), lambda x: trim(x) <> ''))), 'string_agg', ',')"""


def new_and_old(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    tagged = match_exact(customers, "c_mktsegment", rules_frame(spark, SEGMENT_RULES))
    user = F.col("c_custkey").cast("string").alias("userId")
    new = tagged.select(user, F.col("tagsId").cast("string").alias("tagsId"))
    old_tags = F.when(F.col("c_acctbal") > 5000, "12,6,6").when(F.col("c_acctbal") < 0, " ").otherwise("5")
    old = customers.where("c_acctbal > 1000 OR c_acctbal < 0").select(user, old_tags.alias("tagsId"))
    return new, old


_LEFT_MERGE_SQL = f"""WITH {_NEW_OLD_SQL}
  SELECT n.u AS "userId", {_UNION_SQL} AS "tagsId" FROM new n LEFT JOIN old o ON n.u = o.u"""


@query("j5_left_merge", _LEFT_MERGE_SQL)
def _(spark, sf):
    return merge_new_users(*new_and_old(spark, sf))


@query("j6_left_merge_sql", _LEFT_MERGE_SQL)
def _(spark, sf):
    return merge_new_users_sql(*new_and_old(spark, sf))


_RANK_RULES = [(38, "1"), (39, "2"), (40, "3"), (41, "4"), (42, "5")]


@query("j7_rank_zip", f"""
  SELECT c_mktsegment, round(score, 2) AS score, CAST(s.rank AS BIGINT) AS rank, r.id AS "tagsId" FROM (
    SELECT c_mktsegment, sum(c_acctbal) AS score,
           row_number() OVER (ORDER BY sum(c_acctbal) DESC, c_mktsegment DESC) AS rank FROM customer GROUP BY 1) s
  JOIN (SELECT id, row_number() OVER (ORDER BY rule) AS rank FROM {values_sql(_RANK_RULES, 'v(id, rule)')}) r
    ON s.rank = r.rank""")
def _(spark, sf):
    sums = table(spark, sf, "customer").groupBy("c_mktsegment").agg(F.sum("c_acctbal").alias("score"))
    return (rank_zip(sums, "c_mktsegment", "score", rules_frame(spark, _RANK_RULES))
            .withColumn("score", F.round("score", 2)))


# --- aggregates -------------------------------------------------------------------------------------------------

@query("a1_max", "SELECT o_custkey, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders GROUP BY 1")
def _(spark, sf):
    return agg.last_event(table(spark, sf, "orders"), "o_custkey", "o_orderdate").select(
        "o_custkey", F.date_format("last_time", "yyyy-MM-dd").alias("last_day"))


@query("a2_count2", f"""SELECT user_id, item, CAST(count(item) AS BIGINT) AS counts FROM {LOGS_SQL} l GROUP BY 1, 2""")
def _(spark, sf):
    logs = log_source(spark, sf).select(F.col("global_user_id").alias("user_id"), item_of_url(F.col("loc_url")).alias("item"))
    return agg.usage_counts(logs, "user_id", "item")


@query("a3_rfm", f"""
  SELECT o_custkey, CAST(date_diff('day', CAST(max(o_orderdate) AS DATE), DATE '{ORDERS_AS_OF}') AS INTEGER) AS recency,
         CAST(count(o_orderkey) AS BIGINT) AS frequency, round(sum(o_totalprice), 2) AS monetary
  FROM orders GROUP BY 1""")
def _(spark, sf):
    return agg.rfm(table(spark, sf, "orders"), "o_custkey", "o_orderkey", "o_totalprice", "o_orderdate",
                   ORDERS_AS_OF).withColumn("monetary", F.round("monetary", 2))


@query("a4_rfe", """
  SELECT user_id, CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-31') AS INTEGER) AS recency,
         CAST(count(props) AS BIGINT) AS frequency, CAST(count(DISTINCT props) AS BIGINT) AS engagements
  FROM events GROUP BY 1""")
def _(spark, sf):
    return agg.rfe(table(spark, sf, "events"), "user_id", "props", "ts", "2024-01-31")


@query("a5_psm", f"""
  SELECT "memberId", CAST(sum(CASE WHEN coupon <> 0 THEN 1 ELSE 0 END) AS BIGINT) AS tdon,
         CAST(count(*) AS BIGINT) AS ton, round(sum(coupon), 4) AS tda, round(sum(amount + coupon), 4) AS tra
  FROM {COUPON_SQL} c GROUP BY 1""")
def _(spark, sf):
    typed = coupon_source(spark, sf).select(
        "memberId", F.col("orderAmount").cast("double").alias("amount"), F.col("couponCodeValue").cast("double").alias("coupon"))
    return (agg.discount_totals(typed, "memberId", "amount", "coupon")
            .withColumn("tda", F.round("tda", 4)).withColumn("tra", F.round("tra", 4)))


@query("a6_votes", """
  SELECT l_suppkey, CAST(count(*) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS male,
         CAST(count(*) FILTER (WHERE l_returnflag = 'R') AS DOUBLE) AS female, CAST(count(*) AS DOUBLE) AS total
  FROM lineitem GROUP BY 1""")
def _(spark, sf):
    flag = F.col("l_returnflag")
    return agg.votes(table(spark, sf, "lineitem"), "l_suppkey", flag == "A", flag == "R")


@query("a7_ratings", f"""
  SELECT user_id, item, CAST(count(*) AS DOUBLE) AS rating FROM {LOGS_SQL} l WHERE item IS NOT NULL GROUP BY 1, 2""")
def _(spark, sf):
    logs = log_source(spark, sf).select(F.col("global_user_id").alias("user_id"), item_of_url(F.col("loc_url")).alias("item"))
    return agg.implicit_ratings(logs, "user_id", "item")


@query("a8_contingency", "SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1, 2")
def _(spark, sf):
    return agg.contingency(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")


@query("a9_cluster_profile", """
  SELECT l_linenumber AS cluster, max(l_quantity + l_linenumber) AS max_total, min(l_quantity + l_linenumber) AS min_total
  FROM lineitem GROUP BY 1""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.col("l_linenumber").alias("cluster"), "l_quantity")
    return agg.cluster_profile(rows, "cluster", F.col("l_quantity") + F.col("cluster"))


@query("a10_colstats", """
  SELECT 'l_quantity' AS "column", max(l_quantity) AS max, min(l_quantity) AS min, round(avg(l_quantity), 6) AS mean,
         round(var_samp(l_quantity), 6) AS variance, round(sum(abs(l_quantity)), 2) AS l1,
         round(sqrt(sum(l_quantity * l_quantity)), 4) AS l2 FROM lineitem
  UNION ALL SELECT 'l_tax', max(l_tax), min(l_tax), round(avg(l_tax), 6), round(var_samp(l_tax), 6),
         round(sum(abs(l_tax)), 2), round(sqrt(sum(l_tax * l_tax)), 4) FROM lineitem""")
def _(spark, sf):
    stats = agg.column_stats(table(spark, sf, "lineitem"), ["l_quantity", "l_tax"])
    return stats.select("column", "max", "min", F.round("mean", 6).alias("mean"), F.round("variance", 6).alias("variance"),
                        F.round("l1", 2).alias("l1"), F.round("l2", 4).alias("l2"))


@query("a11_pearson", "SELECT round(corr(l_quantity, l_extendedprice), 9) AS corr FROM lineitem")
def _(spark, sf):
    return agg.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("corr", 9).alias("corr"))


@query("a12_spearman", """
  SELECT round(corr(rx, ry), 9) AS corr FROM (
    SELECT rank() OVER (ORDER BY l_quantity) + (count(*) OVER (PARTITION BY l_quantity) - 1) / 2.0::DOUBLE AS rx,
           rank() OVER (ORDER BY l_extendedprice) + (count(*) OVER (PARTITION BY l_extendedprice) - 1) / 2.0::DOUBLE AS ry
    FROM lineitem)""")
def _(spark, sf):
    return agg.spearman(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(F.round("corr", 9).alias("corr"))


@query("a13_mse", """
  SELECT CAST(count(*) AS BIGINT) AS n_rows, round(avg((l_extendedprice - l_quantity * 2000) ** 2), 0) AS mse FROM lineitem""")
def _(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_extendedprice", (F.col("l_quantity") * 2000).alias("guess"))
    return agg.mean_squared_error(rows, "l_extendedprice", "guess").withColumn("mse", F.round("mse", 0))


# --- ranks, sorts, limits ---------------------------------------------------------------------------------------

_RANK_SQL = """
  SELECT o_custkey, o_orderpriority, CAST(count(*) AS BIGINT) AS counts,
         CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS BIGINT) AS rn
  FROM orders GROUP BY 1, 2"""


def _priorities(spark, sf):
    return agg.usage_counts(table(spark, sf, "orders"), "o_custkey", "o_orderpriority")


@query("w1_rank", _RANK_SQL)
def _(spark, sf):
    return rank_in_group(_priorities(spark, sf), "o_custkey", [F.desc("counts"), F.asc("o_orderpriority")], "o_orderpriority",
                         values_from=table(spark, sf, "orders"))


@query("w2_rank_sql", _RANK_SQL)
def _(spark, sf):
    return rank_in_group_sql(_priorities(spark, sf), "o_custkey", "counts", "o_orderpriority", table(spark, sf, "orders"))


@query("w3_top1", f"SELECT o_custkey, o_orderpriority, counts FROM ({_RANK_SQL}) WHERE rn = 1")
def _(spark, sf):
    return top_n_per_group(_priorities(spark, sf), "o_custkey", [F.desc("counts"), F.asc("o_orderpriority")], 1).drop("rn")


@query("o1_sort", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def _(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


def _part_sums(spark, sf):
    return table(spark, sf, "part").groupBy("p_brand").agg(F.sum("p_size").alias("total"))


@query("o2_sort_sums", """
  SELECT p_brand, CAST(sum(p_size) AS BIGINT) AS total,
         CAST(row_number() OVER (ORDER BY sum(p_size) DESC, p_brand DESC) AS BIGINT) AS rank FROM part GROUP BY 1""")
def _(spark, sf):
    return number_rows(_part_sums(spark, sf), [F.desc("total"), F.desc("p_brand")], "rank")


@query("o3_sort_rules", """
  SELECT rule, CAST(row_number() OVER (ORDER BY rule) AS BIGINT) AS by_text,
         CAST(row_number() OVER (ORDER BY CAST(rule AS BIGINT)) AS BIGINT) AS by_number
  FROM (SELECT DISTINCT CAST(p_size AS VARCHAR) AS rule FROM part)""")
def _(spark, sf):
    rules = table(spark, sf, "part").select(F.col("p_size").cast("string").alias("rule")).distinct()
    return number_rows(number_rows(rules, ["rule"], "by_text"), [F.col("rule").cast("long")], "by_number")


@query("o4_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(spark, sf):
    return first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"),
                      [F.desc("o_totalprice"), F.asc("o_orderkey")], 10)


@query("o5_top_n_items", f"""
  SELECT user_id, item, rating, CAST(rn AS INTEGER) AS rn FROM (
    SELECT user_id, item, CAST(count(*) AS DOUBLE) AS rating,
           row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, item) AS rn
    FROM {LOGS_SQL} l WHERE item IS NOT NULL GROUP BY 1, 2) WHERE rn <= 5""")
def _(spark, sf):
    logs = log_source(spark, sf).select(F.col("global_user_id").alias("user_id"), item_of_url(F.col("loc_url")).alias("item"))
    return top_n_per_group(agg.implicit_ratings(logs, "user_id", "item"), "user_id", [F.desc("rating"), F.asc("item")], 5)


# --- sets and splits --------------------------------------------------------------------------------------------

@query("u1_union", """
  SELECT o_orderkey AS k, o_totalprice AS x FROM orders UNION ALL SELECT l_orderkey, l_extendedprice FROM lineitem""")
def _(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("x"))
    return orders.union(table(spark, sf, "lineitem").select("l_orderkey", "l_extendedprice"))


@query("u2_tagset", """
  SELECT o_orderkey, list_aggregate(list_sort(list_distinct(list_filter(string_split(concat_ws(',',
           CASE WHEN o_orderstatus = 'F' THEN '  ' ELSE o_orderpriority || ',7,' || o_orderstatus END,
           CASE WHEN o_orderstatus = 'P' THEN NULL ELSE '7,' || o_orderpriority END), ','), lambda x: trim(x) <> ''))),
         'string_agg', ',') AS tags FROM orders""")
def _(spark, sf):
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    left = F.when(status == "F", "  ").otherwise(F.concat_ws(",", priority, F.lit("7"), status))
    right = F.when(status != "P", F.concat_ws(",", F.lit("7"), priority))
    return table(spark, sf, "orders").select("o_orderkey", tag_set(left, right).alias("tags"))


@query("u3_hash_split", """
  SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count(DISTINCT o_orderkey) AS BIGINT) AS n_keys, true AS both_parts,
         true AS near_share, 0::BIGINT AS in_both FROM orders""")
def _(spark, sf):
    split = hash_split(table(spark, sf, "orders").select("o_orderkey"), ["o_orderkey"], 0.8)
    per_key = split.groupBy("o_orderkey").agg(F.count("*").alias("n"), F.count_distinct("part").alias("parts"),
                                              F.count_if(F.col("part") == "train").alias("train"))
    share = F.sum("train") / F.sum("n")
    return per_key.agg(
        F.sum("n").alias("n_rows"), F.count("*").alias("n_keys"), ((share > 0) & (share < 1)).alias("both_parts"),
        (F.abs(share - 0.8) < 0.03).alias("near_share"), F.count_if(F.col("parts") > 1).alias("in_both"))

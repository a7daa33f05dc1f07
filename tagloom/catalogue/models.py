"""Queries over clustering, classification, regression and recommendation.

A fitted model is reduced to facts that hold whatever the model's numbers are.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalogue.registry import distances_sql, query, rules_frame, table, values_sql
from tagloom.catalogue.scalars import RFM_SQL, SCALED_RFM, scores_sql
from tagloom.catalogue.tables import (BRAND_CODES, FEMALE_PART_TYPES, LOGS_SQL, ORDERS_AS_OF, PART_TYPE_CODES,
                                      goods_source, log_source, order_source)
from tagloom.operators import classify, cluster, recommend
from tagloom.session import local_frame
from tagloom.plans.tags import (bp_ratings, purchases, rfm_features, score, train_purchase_tree)

FEATURES = ["recency", "frequency", "monetary"]
CENTRES = [[4.5, 4.5, 4.5], [1.0, 3.0, 3.0], [2.0, 1.5, 1.0]]
SCORES_SQL = f"({scores_sql(RFM_SQL, SCALED_RFM)})"


def scores(spark, sf):
    return score(rfm_features(order_source(spark, sf), ORDERS_AS_OF), SCALED_RFM)


@query("l14_assign", f"""
  SELECT "userId", CAST(list_position(d, list_min(d)) - 1 AS INTEGER) AS cluster, round(list_min(d), 9) AS distance
  FROM (SELECT "userId", {distances_sql(FEATURES, CENTRES)} AS d FROM {SCORES_SQL} s)""")
def _(spark, sf):
    return cluster.assign(scores(spark, sf), FEATURES, CENTRES).select(
        "userId", "cluster", F.round("distance", 9).alias("distance"))


@query("l14_sse", f"""
  SELECT round(sum(list_min(d)), 6) AS sse FROM (SELECT {distances_sql(FEATURES, CENTRES)} AS d FROM {SCORES_SQL} s)""")
def _(spark, sf):
    return cluster.sum_of_squares(scores(spark, sf), FEATURES, CENTRES).select(F.round("sse", 6).alias("sse"))


@query("l14_fit", f"""
  SELECT CAST(count(*) AS BIGINT) AS n_users, 4::BIGINT AS clusters, true AS better_than_one FROM {SCORES_SQL} s""")
def _(spark, sf):
    users = scores(spark, sf)
    centres = cluster.fit_kmeans(users, FEATURES, 4)
    mean = users.agg(*[F.avg(c) for c in FEATURES]).first()
    placed = cluster.assign(users, FEATURES, centres).withColumn("_one", cluster.squared_distances(FEATURES, [mean])[0])
    return placed.agg(F.count("cluster").alias("n_users"), F.count_distinct("cluster").alias("clusters"),
                      (F.sum("distance") < F.sum("_one")).alias("better_than_one"))


@query("l15_elbow", "SELECT CAST(k AS INTEGER) AS k, CAST(k AS INTEGER) AS clusters, true AS error_found FROM range(2, 6) r(k)")
def _(spark, sf):
    table_ = cluster.elbow(scores(spark, sf), FEATURES, range(2, 6))
    return table_.select("k", "clusters", (F.col("sse") > 0).alias("error_found"))


@query("l16_select_k", f"SELECT CAST(count(*) AS BIGINT) AS n_users, true AS within FROM {SCORES_SQL} s")
def _(spark, sf):
    users = scores(spark, sf)
    k = cluster.select_k(cluster.elbow(users, FEATURES, range(2, 7)))
    return users.agg(F.count("*").alias("n_users")).withColumn("within", F.lit(3 <= k <= 5))


_SEGMENT_TAGS = [(38, "1"), (39, "2"), (40, "3"), (41, "4"), (42, "5")]


@query("l17_rank_tags", f"""
  SELECT c_mktsegment, round(centre_sum, 6) AS centre_sum, CAST(s.rank AS BIGINT) AS rank, r.id AS "tagsId" FROM (
    SELECT c_mktsegment, avg(recency) + avg(frequency) + avg(monetary) AS centre_sum,
           row_number() OVER (ORDER BY avg(recency) + avg(frequency) + avg(monetary) DESC) AS rank
    FROM {SCORES_SQL} s JOIN customer ON "userId" = CAST(c_custkey AS VARCHAR) GROUP BY 1) s
  JOIN (SELECT id, row_number() OVER (ORDER BY rule) AS rank FROM {values_sql(_SEGMENT_TAGS, 'v(id, rule)')}) r ON s.rank = r.rank""")
def _(spark, sf):
    # The mean scores of each market segment stand for fitted centres.
    segments = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("userId"), "c_mktsegment")
    means = (scores(spark, sf).join(segments, "userId").groupBy("c_mktsegment")
             .agg(*[F.avg(c).alias(c) for c in FEATURES]).orderBy("c_mktsegment").collect())
    ranked = cluster.rank_tags(segments, [[row[c] for c in FEATURES] for row in means], rules_frame(spark, _SEGMENT_TAGS))
    names = local_frame(spark, [(i, row["c_mktsegment"]) for i, row in enumerate(means)], "cluster int, c_mktsegment string")
    return ranked.join(names, "cluster").select("c_mktsegment", F.round("centre_sum", 6).alias("centre_sum"), "rank", "tagsId")


_THREE_TAGS = [(38, "1"), (39, "2"), (40, "3")]


@query("l18_predict_tags", f"""
  SELECT "userId", CASE list_position(d, list_min(d)) WHEN 1 THEN '38' WHEN 2 THEN '39' ELSE '40' END AS "tagsId"
  FROM (SELECT "userId", {distances_sql(FEATURES, CENTRES)} AS d FROM {SCORES_SQL} s)""")
def _(spark, sf):
    users = scores(spark, sf)
    return cluster.clusters_to_tags(cluster.assign(users, FEATURES, CENTRES),
                                    cluster.rank_tags(users, CENTRES, rules_frame(spark, _THREE_TAGS)))


# --- classification ---------------------------------------------------------------------------------------------

def _bought(spark, sf):
    orders = order_source(spark, sf).select("orderSn", "memberId")
    return purchases(goods_source(spark, sf), orders, BRAND_CODES, PART_TYPE_CODES, [], FEMALE_PART_TYPES)


@query("l19_tree", """
  SELECT CAST(count(*) AS BIGINT) AS n_items, true AS both_parts, 1.0::DOUBLE AS accuracy, 0.0::DOUBLE AS error_rate,
         1.0::DOUBLE AS weighted_f1, 1.0::DOUBLE AS auc, true AS splits_on_type
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    model, _, counts = train_purchase_tree(_bought(spark, sf))
    total = counts.agg(F.sum("n").alias("n_items"), (F.count_distinct("part") == 2).alias("both_parts"))
    pairs = counts.groupBy("label", "prediction").agg(F.sum("n").alias("n"))
    rules = classify.tree_rules(model)
    # Three one-row results side by side.
    row = {**total.first().asDict(), **classify.classification_metrics(pairs).first().asDict(),
           **classify.hard_auc(pairs, "女").first().asDict(), "splits_on_type": "feature 1" in rules}
    return spark.createDataFrame([row], "n_items long, both_parts boolean, accuracy double, error_rate double, "
                                        "weighted_f1 double, auc double, splits_on_type boolean")


@query("l20_forest", """
  SELECT CAST(count(*) AS BIGINT) AS n_items, true AS better_than_chance
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey""")
def _(spark, sf):
    _, _, counts = train_purchase_tree(_bought(spark, sf), trees=10)
    hits = F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0))
    return counts.agg(F.sum("n").alias("n_items"), (hits / F.sum("n") > 0.5).alias("better_than_chance"))


@query("l21_pipeline", """
  SELECT CAST(o_custkey AS VARCHAR) AS "userId", CAST(count(*) AS BIGINT) AS n_items,
         CAST(count(*) FILTER (WHERE p_type IN ('ECONOMY', 'SMALL')) AS BIGINT) AS predicted_female
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def _(spark, sf):
    _, predicted, _ = train_purchase_tree(_bought(spark, sf))
    female = F.when(F.col("predict_string") == "女", F.col("n")).otherwise(0)
    return predicted.groupBy("userId").agg(F.sum("n").alias("n_items"), F.sum(female).alias("predicted_female"))


_PAIRS_SQL = "(SELECT l_quantity > 25 AS label, l_extendedprice > 30000 AS prediction FROM lineitem)"


def _pairs(spark, sf):
    rows = table(spark, sf, "lineitem").select((F.col("l_quantity") > 25).alias("y"), (F.col("l_extendedprice") > 30000).alias("p"))
    return classify.confusion(rows, "y", "p")


@query("l22_metrics", f"""
  WITH pairs AS {_PAIRS_SQL}, n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM pairs),
       classes AS (SELECT c, count(*) FILTER (WHERE label = c AND prediction = c) AS tp, count(*) FILTER (WHERE label = c) AS s,
                          count(*) FILTER (WHERE prediction = c) AS p FROM pairs, (VALUES (true), (false)) v(c) GROUP BY 1)
  SELECT round(sum(tp) / max(n), 9) AS accuracy, round(1 - sum(tp) / max(n), 9) AS error_rate,
         round(sum(2.0::DOUBLE * tp / (s + p) * s) / max(n), 9) AS weighted_f1 FROM classes, n""")
def _(spark, sf):
    m = classify.classification_metrics(_pairs(spark, sf))
    return m.select(*[F.round(c, 9).alias(c) for c in m.columns])


@query("l23_auc", f"""
  SELECT round((count(*) FILTER (WHERE label AND prediction) / CAST(count(*) FILTER (WHERE label) AS DOUBLE)
    + count(*) FILTER (WHERE NOT label AND NOT prediction) / CAST(count(*) FILTER (WHERE NOT label) AS DOUBLE)) / 2, 9) AS auc
  FROM {_PAIRS_SQL} p""")
def _(spark, sf):
    return classify.hard_auc(_pairs(spark, sf), True).select(F.round("auc", 9).alias("auc"))


# --- regression -------------------------------------------------------------------------------------------------

@query("l24_ols", """
  SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
  FROM lineitem""")
def _(spark, sf):
    return classify.fit_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice").select(
        F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"))


@query("l24_multi", """
  SELECT CAST(count(*) AS BIGINT) AS n_rows, true AS residual_is_centred, true AS residual_is_orthogonal, true AS beats_the_mean
  FROM lineitem""")
def _(spark, sf):
    names = ["l_quantity", "l_discount", "l_tax", "l_linenumber", "l_suppkey"]
    rows = table(spark, sf, "lineitem").select("l_extendedprice", *[F.col(c).cast("double").alias(c) for c in names])
    predicted, _ = classify.linear_regression(rows, names, "l_extendedprice")
    r = F.col("l_extendedprice") - F.col("prediction")
    scale = F.stddev("l_extendedprice")
    return predicted.agg(
        F.count("*").alias("n_rows"), (F.abs(F.avg(r)) < 1e-6 * scale).alias("residual_is_centred"),
        (F.abs(F.corr(r, F.col("l_quantity"))) < 1e-6).alias("residual_is_orthogonal"),
        (F.stddev(r) < scale).alias("beats_the_mean"))


# --- recommendation ---------------------------------------------------------------------------------------------

def _recommendation_facts(df, key, inner):
    items = F.transform("recommendations", lambda r: r[inner])
    ratings = F.transform("recommendations", lambda r: r["rating"])
    return df.select(F.col(key).alias("id"), F.size("recommendations").alias("size"),
                     F.size(F.array_distinct(items)).alias("n_distinct"),
                     (F.sort_array(ratings, asc=False) == ratings).alias("best_first"))


@query("r1_als_top_items", f"""
  SELECT DISTINCT CAST(user_id AS INTEGER) AS id, 5 AS size, 5 AS n_distinct, true AS best_first FROM {LOGS_SQL} l WHERE item IS NOT NULL""")
def _(spark, sf):
    model = recommend.fit_als(bp_ratings(log_source(spark, sf)))
    return _recommendation_facts(recommend.top_items(model, 5), "userId", "itemId")


def _explicit(spark, sf):
    events = table(spark, sf, "events").select(
        F.col("user_id").alias("user"), F.regexp_extract("props", '"k": ([0-9]+)', 1).alias("item"), "value")
    rated = events.groupBy("user", "item").agg(F.avg("value").alias("rating"))
    return recommend.numeric_ids(rated, "user", "item")


@query("r2_als_predict", r"""
  SELECT CAST(count(DISTINCT (user_id, props)) AS BIGINT) AS n_pairs, true AS all_predicted, true AS beats_zero FROM events""")
def _(spark, sf):
    ratings = _explicit(spark, sf)
    model = recommend.fit_als(ratings, rank=10, iterations=20, reg=0.1, implicit=False)
    error = F.sum(F.pow(F.col("prediction") - F.col("rating"), 2))
    return recommend.predict_pairs(model, ratings).agg(
        F.count("*").alias("n_pairs"), (F.count_if(F.isnan("prediction")) == 0).alias("all_predicted"),
        (error < F.sum(F.pow("rating", F.lit(2)))).alias("beats_zero"))


@query("r3_als_user_items", """
  SELECT DISTINCT CAST(user_id AS INTEGER) AS id, 5 AS size, 5 AS n_distinct, true AS best_first FROM events WHERE event_type = 'purchase'""")
def _(spark, sf):
    model = recommend.fit_als(_explicit(spark, sf), implicit=False)
    buyers = table(spark, sf, "events").where("event_type = 'purchase'").select(F.col("user_id").cast("int").alias("userId")).distinct()
    return _recommendation_facts(recommend.top_items(model, 5, buyers), "userId", "itemId")


@query("r4_als_item_users", r"""
  SELECT DISTINCT CAST(regexp_extract(props, '"k": ([0-9]+)', 1) AS INTEGER) AS id, 5 AS size, 5 AS n_distinct, true AS best_first
  FROM events WHERE event_type = 'purchase'""")
def _(spark, sf):
    model = recommend.fit_als(_explicit(spark, sf), implicit=False)
    bought = table(spark, sf, "events").where("event_type = 'purchase'").select(
        F.regexp_extract("props", '"k": ([0-9]+)', 1).cast("int").alias("itemId")).distinct()
    return _recommendation_facts(recommend.top_users(model, 5, bought), "itemId", "userId")

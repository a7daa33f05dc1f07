"""Queries over shared scans and over state that is kept between runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalogue.registry import query, table
from tagloom.catalogue.scalars import RFM_SQL, SCALED_RFM, scores_sql
from tagloom.catalogue.tables import LOGS_SQL, MODELS_SQL, NATION_ID, ORDERS_AS_OF, TAGS_SQL, log_source, model_table, order_source, tag_table
from tagloom.catalogue.tags import (CYCLE_RULES, CYCLE_SQL, PAYMENT_RULES, PAYMENT_SQL, PSM_CENTRES, PSM_RULES, RFM_CENTRES, RFM_RULES, ranked_sql, union_tags_sql)
from tagloom.functions.dates import timestamp_to_epoch
from tagloom.operators import cluster
from tagloom.plans import tags as jobs
from tagloom.plans.registry import CYCLE, PAYMENT, PSM, RFM
from tagloom.plans.state import LOGS, ORDERS, StateStore
from tagloom.plans.template import FromState, KeptStates, TagJob, run_jobs
from tagloom.session import local_frame, materialised, scratch_path
from tagloom.sources.readers import TAG_SCHEMA
from tagloom.sources.stores import Conflict, ProfileStore
from tagloom.sources.tags import TagStore

# Urgent orders come with a coupon of a tenth of the price.
_COUPON_SQL = """SELECT CAST(o_custkey AS VARCHAR) AS u, o_totalprice AS amount,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_totalprice * 0.1::DOUBLE ELSE 0.0::DOUBLE END AS coupon FROM orders"""
_PSM_SQL = f"""(SELECT u AS "userId", tdon / ton + (tda / tdon) / (tra / ton) + tda / tra AS psm FROM (
    SELECT u, CAST(sum(CASE WHEN coupon <> 0 THEN 1 ELSE 0 END) AS DOUBLE) AS tdon, CAST(count(*) AS DOUBLE) AS ton, sum(coupon) AS tda,
           sum(amount + coupon) AS tra FROM ({_COUPON_SQL}) GROUP BY u) WHERE tdon > 0)"""
_RFM_TAGS_SQL = ranked_sql(f"({scores_sql(RFM_SQL, SCALED_RFM)})", list(SCALED_RFM), RFM_CENTRES, RFM_RULES)
_FOUR_TAGS_SQL = union_tags_sql(CYCLE_SQL, PAYMENT_SQL, _RFM_TAGS_SQL, ranked_sql(_PSM_SQL, ["psm"], PSM_CENTRES, PSM_RULES))

_FIELDS = {CYCLE: "memberId,finishTime", PAYMENT: "memberId,paymentCode", RFM: "memberId,orderSn,orderAmount,finishTime",
           PSM: "memberId,orderSn,orderAmount,couponCodeValue"}
_SOURCE = "inType=Parquet##hbaseTable=tbl_orders##family=detail##selectFields="


def order_tags(spark):
    children = {CYCLE: CYCLE_RULES, PAYMENT: PAYMENT_RULES, RFM: RFM_RULES, PSM: PSM_RULES}
    return local_frame(spark, [(tag, str(tag), _SOURCE + fields, 4, 3) for tag, fields in _FIELDS.items()]
                       + [(i, rule, rule, 5, tag) for tag, rules in children.items() for i, rule in rules], TAG_SCHEMA)


def order_jobs():
    """The four jobs over orders, with given centres."""
    def never(source, rules):
        raise AssertionError("jobs of one table are computed from its state")

    def rfm(state, rules):
        return jobs.cluster_tag(jobs.score(jobs.rfm_of_state(state, ORDERS_AS_OF), SCALED_RFM), list(SCALED_RFM), rules, centres=RFM_CENTRES)

    def psm(state, rules):
        return jobs.cluster_tag(jobs.psm_of_state(state), ["psm"], rules, centres=PSM_CENTRES)

    needs = [(CYCLE, ("last_time",), lambda state, rules: jobs.cycle_of_state(state, rules, ORDERS_AS_OF), False),
             (PAYMENT, ("codes",), jobs.payment_of_state, True), (RFM, ("last_time", "orders", "amount"), rfm, False),
             (PSM, ("tdon", "ton", "tda", "tra"), psm, False)]
    return [TagJob(tag, never, shared=FromState(ORDERS, measures, compute, detail)) for tag, measures, compute, detail in needs]


def coupon_orders(spark, sf):
    """The orders, typed, with the coupons, and the day of the order as the number that grows with every load."""
    coupon = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), F.col("o_totalprice") * 0.1).otherwise(0.0)
    return table(spark, sf, "orders").select(
        F.col("o_custkey").cast("string").alias("memberId"), F.col("o_orderkey").cast("string").alias("orderSn"), F.col("o_totalprice").alias("orderAmount"),
        timestamp_to_epoch(F.col("o_orderdate")).alias("finishTime"), F.col("o_orderpriority").alias("paymentCode"), coupon.alias("couponCodeValue"),
        F.datediff("o_orderdate", F.lit("1970-01-01").cast("date")).cast("long").alias("load"))


@query("t13_shared_scan", _FOUR_TAGS_SQL)
def _(spark, sf):
    store = ProfileStore(spark, scratch_path(spark, "profile"))
    return run_jobs(order_jobs(), order_tags(spark), lambda spec: coupon_orders(spark, sf).select(*spec.fields), store)


@query("t13_kept_states", _FOUR_TAGS_SQL)
def _(spark, sf):
    # Three loads of the orders; each run adds what is new and gives the tags anew.
    store = ProfileStore(spark, scratch_path(spark, "profile"), keep=2)
    kept = KeptStates(scratch_path(spark, "states"), "load", keep=2)
    orders = coupon_orders(spark, sf)
    for last in (9131, 10227, None):  # 1995-01-01, 1998-01-01, all
        loaded = orders if last is None else orders.where(F.col("load") < last)
        written = run_jobs(order_jobs(), order_tags(spark), lambda spec, loaded=loaded: loaded.select(*spec.fields), store, True, kept=kept)
    return written


@query("a3_state", """
  SELECT CAST(o_custkey AS VARCHAR) AS "memberId", CAST(epoch(max(o_orderdate)) AS BIGINT) AS last_time, CAST(count(*) AS BIGINT) AS orders,
         round(sum(o_totalprice), 2) AS amount, CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS methods FROM orders GROUP BY 1""")
def _(spark, sf):
    store = StateStore(spark, scratch_path(spark, "state"), ORDERS, ["last_time", "orders", "amount", "codes"])
    orders = order_source(spark, sf).withColumn("load", (F.col("finishTime").cast("long") / 86400).cast("long"))
    for last in (9862, 9862, 1 << 40):  # the second run finds nothing new
        state = store.add(orders.where(F.col("load") < last), "load")
    return state.groupBy("memberId").agg(F.max("last_time").alias("last_time"), F.sum("orders").alias("orders"), F.round(F.sum("amount"), 2).alias("amount"),
                                         F.count("paymentCode").alias("methods"))


@query("a4_state", f"""
  SELECT user_id AS "userId", CAST(date_diff('day', CAST(max(ts) AS DATE), DATE '2024-01-31') AS INTEGER) AS recency,
         CAST(count(url) AS BIGINT) AS frequency, CAST(count(DISTINCT url) AS BIGINT) AS engagements FROM {LOGS_SQL} l GROUP BY 1""")
def _(spark, sf):
    # The same pages are read in both loads, so distinct pages cannot just be added up.
    store = StateStore(spark, scratch_path(spark, "state"), LOGS)
    logs = log_source(spark, sf).withColumn("load", F.crc32("log_time") % 2)
    store.add(logs.where("load = 0"), "load")
    return jobs.rfe_of_state(store.add(logs, "load"), "2024-01-31")


# Four groups of customers at the corners of a square, each order a point near its customer's corner.
_GROUPS = 4


def planted(spark, sf):
    noise = [(F.pmod(F.xxhash64("o_orderkey", F.lit(i)), F.lit(1000)) / 1000.0 - 0.5) * 2 for i in (1, 2)]
    group = F.pmod(F.col("o_custkey"), F.lit(_GROUPS))
    return table(spark, sf, "orders").select("o_orderkey", group.alias("planted"), (F.floor(group / 2) * 10 + noise[0]).alias("x"), (group % 2 * 10 + noise[1]).alias("y"))


@query("l16_gap", """
  SELECT CAST(count(*) AS BIGINT) AS n_points, CAST(count(DISTINCT o_custkey % 4) AS INTEGER) AS k, true AS falling FROM orders""")
def _(spark, sf):
    points = materialised(planted(spark, sf), "points")
    rated = cluster.gap_statistic(points, ["x", "y"], range(1, 8))
    sse = [r["sse"] for r in rated.orderBy("k").collect()]
    return points.agg(F.count("*").alias("n_points")).select(
        "n_points", F.lit(cluster.gap_k(rated)).alias("k"), F.lit(all(a > b for a, b in zip(sse[:_GROUPS], sse[1:_GROUPS]))).alias("falling"))


@query("l14_planted", """
  SELECT CAST(o_custkey % 4 AS BIGINT) AS planted, CAST(count(*) AS BIGINT) AS n_points, 1::BIGINT AS clusters, true AS centre_is_mean,
         true AS nearest FROM orders GROUP BY 1""")
def _(spark, sf):
    points = materialised(planted(spark, sf), "points")
    centres = cluster.fit_kmeans(points, ["x", "y"], _GROUPS, max_iter=100)
    placed = cluster.assign(points, ["x", "y"], centres)
    known = local_frame(spark, [(i, *map(float, c)) for i, c in enumerate(centres)], "_cluster int, cx double, cy double")
    joined = placed.join(F.broadcast(known), F.col("cluster") == F.col("_cluster"))
    own = F.pow(F.col("x") - F.col("cx"), 2) + F.pow(F.col("y") - F.col("cy"), 2)
    return joined.groupBy("planted").agg(
        F.count("*").alias("n_points"), F.count_distinct("cluster").alias("clusters"),
        ((F.abs(F.avg("x") - F.avg("cx")) < 1e-6) & (F.abs(F.avg("y") - F.avg("cy")) < 1e-6)).alias("centre_is_mean"),
        (F.max(F.abs(own - F.col("distance"))) < 1e-9).alias("nearest"))


# Suppliers in debt are the first batch of new tags, the others the second one; each batch is numbered by name.
_BATCHES_SQL = f"""(SELECT s_name AS name, CAST(s_nationkey + {NATION_ID} AS BIGINT) AS pid,
    row_number() OVER (ORDER BY CASE WHEN s_acctbal < 0 THEN 0 ELSE 1 END, s_name) AS n FROM supplier)"""


@query("m9_tag_versions", f"""
  SELECT t.id, t.name, t.pid, m.id AS model_id, m.model_name, m.state FROM {TAGS_SQL} t LEFT JOIN {MODELS_SQL} m ON m.tag_id = t.id
  UNION ALL
  SELECT (SELECT max(id) FROM {TAGS_SQL} t) + n, name, pid, (SELECT max(id) FROM {MODELS_SQL} m) + n, 'model of ' || name, 1
  FROM {_BATCHES_SQL} b""")
def _(spark, sf):
    store = TagStore(spark, scratch_path(spark, "tags"))
    store.load(tag_table(spark, sf), model_table(spark, sf))
    new = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.lit(None).cast("string").alias("rule"), F.lit(4).alias("level"),
        (F.col("s_nationkey") + NATION_ID).cast("long").alias("pid"),
        F.concat(F.lit("model of "), "s_name").alias("model_name"), F.lit(1).alias("state"), "s_acctbal")
    store.append(new.where("s_acctbal < 0"), ["name"])
    # The second writer started from the first version: it fails, and gives its ids anew from the newest one.
    rest = new.where("s_acctbal >= 0")
    try:
        store.append(rest, ["name"], base=1)
    except Conflict:
        store.append(rest, ["name"])
    whole = store.read().select("id", "name", "pid", F.explode_outer("models").alias("m"))
    return whole.select("id", "name", "pid", F.col("m.id").alias("model_id"), "m.model_name", "m.state")

"""The job sources derived from the given tables: Spark frames and the same thing as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.catalogue.registry import table
from tagloom.functions.dates import timestamp_to_epoch
from tagloom.operators.joins import skew_join

ORDERS_AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"

REGION_PID = 1
NATION_ID = 100
CUSTOMER_ID = 10**9
ORDER_ID = 10**12


def tag_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tag table of regions, nations, customers (source rules) and orders (date bands)."""
    none = F.lit(None).cast("string")
    regions = table(spark, sf_dir, "region").select(
        (F.col("r_regionkey") + 1).cast("long").alias("id"), F.col("r_name").alias("name"), none.alias("rule"),
        F.lit(2).alias("level"), F.lit(REGION_PID).cast("long").alias("pid"))
    nations = table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + NATION_ID).cast("long").alias("id"), F.col("n_name").alias("name"),
        none.alias("rule"), F.lit(3).alias("level"), (F.col("n_regionkey") + 1).cast("long").alias("pid"))
    fields = F.when(F.col("c_acctbal") < 0, "").otherwise("##selectFields=o_custkey,o_orderdate")
    customers = table(spark, sf_dir, "customer").select(
        (F.col("c_custkey") + CUSTOMER_ID).alias("id"), F.col("c_name").alias("name"),
        F.concat(F.lit("inType=Parquet##hbaseTable=orders##family="), "c_mktsegment", fields).alias("rule"),
        F.lit(4).alias("level"), (F.col("c_nationkey") + NATION_ID).cast("long").alias("pid"))
    band = F.concat(F.date_format("o_orderdate", "yyyyMMdd"), F.lit("-"),
                    F.date_format(F.date_add("o_orderdate", 30), "yyyyMMdd"))
    orders = table(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") + ORDER_ID).alias("id"), F.col("o_orderpriority").alias("name"), band.alias("rule"),
        F.lit(5).alias("level"), (F.col("o_custkey") + CUSTOMER_ID).alias("pid"))
    return regions.unionByName(nations).unionByName(customers).unionByName(orders)


TAGS_SQL = f"""(
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS id, r_name AS name, CAST(NULL AS VARCHAR) AS rule, 2 AS level,
         CAST({REGION_PID} AS BIGINT) AS pid FROM region
  UNION ALL
  SELECT CAST(n_nationkey + {NATION_ID} AS BIGINT), n_name, NULL, 3, CAST(n_regionkey + 1 AS BIGINT) FROM nation
  UNION ALL
  SELECT c_custkey + {CUSTOMER_ID}, c_name,
         'inType=Parquet##hbaseTable=orders##family=' || c_mktsegment ||
         CASE WHEN c_acctbal < 0 THEN '' ELSE '##selectFields=o_custkey,o_orderdate' END,
         4, CAST(c_nationkey + {NATION_ID} AS BIGINT) FROM customer
  UNION ALL
  SELECT o_orderkey + {ORDER_ID}, o_orderpriority,
         strftime(o_orderdate, '%Y%m%d') || '-' || strftime(o_orderdate + INTERVAL 30 DAY, '%Y%m%d'),
         5, o_custkey + {CUSTOMER_ID} FROM orders
)"""


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A model for every customer tag whose customer is in credit."""
    return (table(spark, sf_dir, "customer").where("c_acctbal > 0").select(
        (F.col("c_custkey") + 1).alias("id"), (F.col("c_custkey") + CUSTOMER_ID).alias("tag_id"),
        F.concat(F.lit("model of "), "c_name").alias("model_name"),
        F.when(F.col("c_acctbal") > 5000, 3).otherwise(4).alias("state")))


MODELS_SQL = f"""(
  SELECT c_custkey + 1 AS id, c_custkey + {CUSTOMER_ID} AS tag_id, 'model of ' || c_name AS model_name,
         CASE WHEN c_acctbal > 5000 THEN 3 ELSE 4 END AS state FROM customer WHERE c_acctbal > 0
)"""


def order_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text fields, the time in epoch seconds."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("memberId"), F.col("o_orderkey").cast("string").alias("orderSn"),
        F.col("o_totalprice").cast("string").alias("orderAmount"),
        timestamp_to_epoch(F.col("o_orderdate")).cast("string").alias("finishTime"),
        F.col("o_orderpriority").alias("paymentCode"))


def coupon_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items as orders; a discount of a tenth or more counts as a coupon."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    coupon = F.when(F.col("l_discount") >= 0.1, F.col("l_extendedprice") * F.col("l_discount")).otherwise(0.0)
    return skew_join(items, orders, "l_orderkey", "o_orderkey").select(
        F.col("o_custkey").cast("string").alias("memberId"), F.col("l_orderkey").cast("string").alias("orderSn"),
        F.col("l_extendedprice").cast("string").alias("orderAmount"), coupon.cast("string").alias("couponCodeValue"))


COUPON_SQL = """(
  SELECT CAST(o_custkey AS VARCHAR) AS "memberId", l_extendedprice AS amount,
         CASE WHEN l_discount >= 0.1 THEN l_extendedprice * l_discount ELSE 0.0 END AS coupon
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

PRODUCT_URL = "http://shop.example/product/"
OTHER_URL = "http://shop.example/help/"


def log_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as page views; errors hit a page that is no product."""
    page = F.concat(F.regexp_extract("props", '"k": ([0-9]+)', 1), F.lit(".html?ebi="), F.col("event_type"))
    start = F.when(F.col("event_type") == "error", OTHER_URL).otherwise(PRODUCT_URL)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("global_user_id"), F.concat(start, page).alias("loc_url"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("log_time"))


LOGS_SQL = f"""(
  SELECT CAST(user_id AS VARCHAR) AS user_id, ts,
         CASE WHEN event_type = 'error' THEN '{OTHER_URL}' ELSE '{PRODUCT_URL}' END
           || regexp_extract(props, '"k": ([0-9]+)', 1) || '.html?ebi=' || event_type AS url,
         CASE WHEN event_type = 'error' THEN NULL ELSE regexp_extract(props, '"k": ([0-9]+)', 1) END AS item
  FROM events
)"""


def goods_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with brand as colour and type as product type."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    return skew_join(items, parts, "l_partkey", "p_partkey").select(
        F.col("l_orderkey").cast("string").alias("cOrderSn"), F.col("p_brand").alias("ogColor"),
        F.col("p_type").alias("productType"))


# Stand-ins for the colour and type dictionaries on the given parts.
BRAND_CODES = {f"Brand#{n}": n for n in range(1, 21)}
PART_TYPE_CODES = {"ECONOMY": 9, "LARGE": 10, "MEDIUM": 12, "PROMO": 13, "SMALL": 14}
FEMALE_BRANDS = ["Brand#2", "Brand#7", "Brand#11", "Brand#19"]
FEMALE_PART_TYPES = ["ECONOMY", "SMALL"]

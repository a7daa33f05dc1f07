"""Queries over the tag table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagloom.catalogue.registry import query, table
from tagloom.catalogue.tables import CUSTOMER_ID, MODELS_SQL, NATION_ID, TAGS_SQL, model_table, tag_table
from tagloom.functions.rules import source_rule_field
from tagloom.operators.joins import skew_join
from tagloom.operators.rules import (append_tags, append_tags_with_models, child_rules, children_of, exact_rules,
                                     range_rules, rules_of, tags_of_level, tags_with_models, upsert_paths)
from tagloom.session import local_frame
from tagloom.sources.readers import TAG_SCHEMA


@query("m1_parse_rule", f"""
  SELECT id, 'Parquet' AS in_type, 'orders' AS source,
         split_part(split_part(rule, '##', 3), '=', 2) AS family, '' AS missing,
         CASE WHEN contains(rule, 'selectFields=') THEN split_part(rule, 'selectFields=', 2) ELSE '' END AS fields
  FROM {TAGS_SQL} t WHERE level = 4""")
def _(spark, sf):
    rule = F.col("rule")
    return tags_of_level(tag_table(spark, sf), 4).select(
        "id", source_rule_field(rule, "inType").alias("in_type"), source_rule_field(rule, "hbaseTable").alias("source"),
        source_rule_field(rule, "family").alias("family"), source_rule_field(rule, "zkHosts").alias("missing"),
        source_rule_field(rule, "selectFields").alias("fields"))


@query("m2_rule_of", f"""
  SELECT o_orderkey, t.id, t.rule FROM orders JOIN {TAGS_SQL} t ON o_custkey + {CUSTOMER_ID} = t.id""")
def _(spark, sf):
    wanted = table(spark, sf, "orders").select("o_orderkey", (F.col("o_custkey") + CUSTOMER_ID).alias("wanted_id"))
    return rules_of(tag_table(spark, sf), wanted, "wanted_id").select(
        "o_orderkey", F.col("wanted_id").alias("id"), "rule")


@query("m3_child_rules", f"SELECT pid, id, rule FROM {TAGS_SQL} t WHERE pid <> -1")
def _(spark, sf):
    return child_rules(tag_table(spark, sf))


@query("m4_range_rules", f"""
  SELECT id AS "tagsId", CAST(split_part(rule, '-', 1) AS BIGINT) AS start, CAST(split_part(rule, '-', 2) AS BIGINT) AS "end"
  FROM {TAGS_SQL} t WHERE level = 5""")
def _(spark, sf):
    return range_rules(tags_of_level(tag_table(spark, sf), 5))


@query("m5_exact_rules", """
  SELECT p_name || '/' || p_brand AS rule, max(p_partkey) AS "tagsId" FROM part GROUP BY 1""")
def _(spark, sf):
    return exact_rules(table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), F.concat_ws("/", "p_name", "p_brand").alias("rule")))


@query("m6_tag_tree", f"""
  WITH tags AS (SELECT * FROM {TAGS_SQL} t)
  SELECT c.id, c.name, c.rule, c.level, c.pid, p.name AS parent_name
  FROM tags c JOIN tags p ON c.pid = p.id WHERE p.level = 4""")
def _(spark, sf):
    tags = tag_table(spark, sf)
    return children_of(tags, tags_of_level(tags, 4)).select("id", "name", "rule", "level", "pid", "parent_name")


@query("m7_tag_model", f"""
  SELECT t.id, t.name, m.id AS model_id, m.model_name, m.state
  FROM {TAGS_SQL} t LEFT JOIN {MODELS_SQL} m ON t.id = m.tag_id WHERE t.level = 4""")
def _(spark, sf):
    tags = tags_of_level(tag_table(spark, sf), 4)
    return tags_with_models(tags, model_table(spark, sf)).select("id", "name", "model_id", "model_name", "state")


_PATHS_SQL = """(SELECT r_name, n_name, c_mktsegment FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("m8_upsert_paths", f"""
  SELECT name, level, parent_name, CAST(count(*) AS BIGINT) AS n FROM (
    SELECT DISTINCT r_name AS name, 1 AS level, '' AS parent_name, r_name AS r, '' AS n FROM {_PATHS_SQL} p
    UNION ALL SELECT DISTINCT n_name, 2, r_name, r_name, n_name FROM {_PATHS_SQL} p
    UNION ALL SELECT DISTINCT c_mktsegment, 3, n_name, r_name, n_name FROM {_PATHS_SQL} p) GROUP BY ALL""")
def _(spark, sf):
    nations = (table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
               .select("n_nationkey", F.col("r_name").alias("name1"), F.col("n_name").alias("name2")))
    customers = table(spark, sf, "customer").select("c_nationkey", "c_acctbal", F.col("c_mktsegment").alias("name3"))
    paths = skew_join(customers, nations, "c_nationkey", "n_nationkey")
    names = ["name1", "name2", "name3"]
    empty = local_frame(spark, [], TAG_SCHEMA)
    known = upsert_paths(empty, paths.where("c_acctbal < 0").select(*names))
    tags = upsert_paths(known, paths.select(*names))
    parents = tags.select(F.col("id").alias("parent_id"), F.col("name").alias("parent_name"))
    return (skew_join(tags, parents, "pid", "parent_id", "left", ["id"])
            .groupBy("name", "level", F.coalesce("parent_name", F.lit("")).alias("parent_name"))
            .agg(F.count("*").alias("n")))


_NEW_SQL = f"""(SELECT s_name AS name, CAST(s_nationkey + {NATION_ID} AS BIGINT) AS pid,
  (SELECT max(id) FROM {TAGS_SQL} t) + row_number() OVER (ORDER BY s_name) AS id FROM supplier)"""


@query("m9_append_tags", f"""
  SELECT name, pid, id, CASE WHEN model_name IS NULL THEN NULL ELSE model_name END AS model_name, model_id FROM (
    SELECT n.name, n.pid, n.id, 'model of ' || n.name AS model_name,
           (SELECT max(id) FROM {MODELS_SQL} m) + row_number() OVER (ORDER BY n.id) AS model_id FROM {_NEW_SQL} n
    UNION ALL
    SELECT t.name, t.pid, t.id, m.model_name, m.id FROM {TAGS_SQL} t LEFT JOIN {MODELS_SQL} m ON m.tag_id = t.id)""")
def _(spark, sf):
    new = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.lit(None).cast("string").alias("rule"), F.lit(4).alias("level"),
        (F.col("s_nationkey") + NATION_ID).cast("long").alias("pid"),
        F.concat(F.lit("model of "), "s_name").alias("model_name"), F.lit(1).alias("state"))
    tags, models = append_tags_with_models(tag_table(spark, sf), model_table(spark, sf), new, ["name"])
    return (tags_with_models(tags.select("id", "name", "pid"), models)
            .select("name", "pid", "id", "model_name", "model_id"))


@query("m9_append_data_tags", f"""
  SELECT id, name FROM {TAGS_SQL} t UNION ALL SELECT id, name FROM {_NEW_SQL} n""")
def _(spark, sf):
    new = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"), F.lit(None).cast("string").alias("rule"), F.lit(4).alias("level"),
        (F.col("s_nationkey") + NATION_ID).cast("long").alias("pid"))
    tags, _ = append_tags(tag_table(spark, sf), new, ["name"])
    return tags.select("id", "name")

"""The registered queries of the text operators: thin, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import ctw, divergence, doubling, fertility, licences, lshforest, packing, pfor, pii, sharding, simplex, toxicity, wumanber
from tagloom.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return register


@query("op1_fertility")
def op1(spark, sf_dir):
    return fertility.judge(table(spark, sf_dir, "documents"))


@query("op2_licences")
def op2(spark, sf_dir):
    return licences.search(table(spark, sf_dir, "documents"))


@query("op3_context_tree")
def op3(spark, sf_dir):
    return ctw.scores(table(spark, sf_dir, "documents"))


@query("op4_decontamination")
def op4(spark, sf_dir):
    return wumanber.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op5_pii")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.fit(docs))


@query("op6_toxicity")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


@query("op7_sharding", sharding.oracle())
def op7(spark, sf_dir):
    return sharding.place(table(spark, sf_dir, "documents"))


@query("op8_lsh_forest")
def op8(spark, sf_dir):
    return lshforest.groups(table(spark, sf_dir, "documents"))


@query("op9_packing")
def op9(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op10_token_ids")
def op10(spark, sf_dir):
    return pfor.round_trip(table(spark, sf_dir, "documents"))


@query("op11_substrings", doubling.ORACLE)
def op11(spark, sf_dir):
    return doubling.digests(table(spark, sf_dir, "documents"))


@query("op12_divergence", divergence.ORACLE)
def op12(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_centroids", simplex.oracle())
def op13(spark, sf_dir):
    return simplex.cluster(table(spark, sf_dir, "embeddings"))

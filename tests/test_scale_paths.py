"""The ways taken for large or skewed data give the same rows as the plain ones."""

import os
import random
import subprocess
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tagloom.operators import aggregates, embedding, joins, match, ordering, recommend, rules, text
from tagloom.operators.match import band_cells, match_exact, match_range


def rows(df):
    return Counter(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.fixture
def tight(monkeypatch):
    """Bounds so low that every large-data path is taken."""
    monkeypatch.setattr(joins, "BROADCAST_ROWS", 1)
    monkeypatch.setattr(joins, "HOT_ROWS", 10)
    monkeypatch.setattr(ordering, "ONE_TASK_ROWS", 1)
    monkeypatch.setattr(match, "LOOP_BANDS", 1)


def skewed(spark, n=3000):
    """A third of the rows on key 1, a few null keys, and exact copies."""
    generator = random.Random(5)
    keys = [1 if i % 3 == 0 else None if i % 50 == 1 else generator.randint(2, 400) for i in range(n)]
    return spark.createDataFrame([(k, i // 4) for i, k in enumerate(keys)], "k long, x long")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("spread", [None, ["x"]])
def test_skew_join(spark, tight, how, spread):
    left = skewed(spark)
    # Key 1 twice, so the join also multiplies rows; keys above 300 are missing.
    right = spark.createDataFrame([(k, f"v{k}") for k in range(300)] + [(1, "again")], "id long, v string")
    assert joins.hot_keys(left, "k")
    plain = left.join(right, left.k == right.id, how).drop("id")
    assert rows(joins.skew_join(left, right, "k", "id", how, spread)) == rows(plain)


def test_hot_rows_are_split(spark, tight):
    left = skewed(spark)
    right = spark.createDataFrame([(k, k) for k in range(400)], "id long, v long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = joins.skew_join(left, right, "k", "id").withColumn("p", F.spark_partition_id())
        used = joined.where("k = 1").groupBy("p").count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(used) > 1


def test_lookup_beyond_the_broadcast_bound(spark, tight):
    left = skewed(spark)
    dim = spark.createDataFrame([(k, k * 2) for k in range(200)], "id long, v long")
    assert not joins.fits_broadcast(dim)
    assert rows(joins.lookup_join(left, dim, "k", "id", "left")) == rows(left.join(dim, left.k == dim.id, "left").drop("id"))


def test_exact_match_beyond_the_broadcast_bound(spark, tight):
    users = skewed(spark).withColumn("value", F.col("k").cast("string"))
    found = match_exact(users, "value", spark.createDataFrame([(7, "1"), (8, "2"), (9, "other")], "id long, rule string"),
                        default="other")
    tags = Counter(r["tagsId"] for r in found.collect())
    assert tags[7] == 1000 and sum(tags.values()) == 3000


def brute_force(values, bands):
    return Counter((v, t) for v in values if v is not None for t, lo, hi in bands if lo <= v <= hi)


@pytest.mark.parametrize("broadcast_rows", [1, 10**6])
def test_many_bands(spark, tight, monkeypatch, broadcast_rows):
    monkeypatch.setattr(joins, "BROADCAST_ROWS", broadcast_rows)
    generator = random.Random(3)
    values = [generator.randint(-50, 2000) for _ in range(400)] + [None, 0, 0, 0, 10**15, -(10**15)]
    bands = [(i, lo, lo + generator.choice([0, 1, 7, 64, 999])) for i, lo in enumerate(generator.sample(range(-100, 1900), 150))]
    bands += [(900, 0, 10**16), (901, -(10**16), 0), (902, 5, 4), (903, 0, 0), (904, 0, 0)]
    df = spark.createDataFrame([(v,) for v in values], "v long")
    found = match_range(df, "v", spark.createDataFrame(bands, "tagsId long, start long, end long"))
    assert Counter((r["v"], r["tagsId"]) for r in found.collect()) == brute_force(values, bands)


@pytest.mark.parametrize("values", [range(300), [7] * 100 + list(range(50)), [i / 2 for i in range(300)]], ids=["even", "hot", "halves"])
def test_many_cells_are_never_broadcast(spark, tight, tmp_path, values):
    """Beyond the bound all sides are shuffled, though Spark takes the cells for as few as the bands in the file."""
    bands = [(i, i, i + 20) for i in range(150)]
    spark.createDataFrame(bands, "tagsId long, start long, end long").write.parquet(str(tmp_path / "bands"))
    df = spark.createDataFrame([(v,) for v in values], "v double" if isinstance(values[1], float) else "v long")
    found = match_range(df, "v", spark.read.parquet(str(tmp_path / "bands")))
    assert Counter((r["v"], r["tagsId"]) for r in found.collect()) == brute_force(values, bands)
    plan = found._jdf.queryExecution().sparkPlan().toString()
    assert bool(joins.hot_keys(df, "v")) == (values[0] == 7)
    # The list of hot keys, a row per key, is the only thing that may be broadcast.
    assert plan.count("SortMergeJoin") == 2
    assert plan.count("BroadcastHashJoin") == (2 if values[0] == 7 else 0)


def test_few_bands_give_the_same(spark):
    bands = [(1, 0, 10), (2, 5, 20), (3, 30, 40)]
    values = [-1, 0, 5, 10, 20, 25, 30, 40, 41, None]
    df = spark.createDataFrame([(v,) for v in values], "v int")
    found = match_range(df, "v", spark.createDataFrame(bands, "tagsId long, start long, end long"))
    assert Counter((r["v"], r["tagsId"]) for r in found.collect()) == brute_force(values, bands)


def test_cells_of_a_band_are_disjoint_and_complete(spark):
    bands = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate([(-9, 23), (0, 0), (5, 8), (-7, -7), (1, 1023)])],
                                  "tagsId long, start long, end long")
    limits = {r["tagsId"]: (r["start"], r["end"]) for r in bands.collect()}
    covered = {i: [] for i in limits}
    for r in band_cells(bands).collect():
        covered[r["tagsId"]] += range(r["cell"] << r["level"], (r["cell"] + 1) << r["level"])
    for i, (lo, hi) in limits.items():
        assert sorted(covered[i]) == list(range(lo, hi + 1))


def test_numbering_in_parts(spark, tight):
    df = skewed(spark).withColumn("u", F.monotonically_increasing_id())
    expected = df.withColumn("rn", F.row_number().over(W.orderBy("k", "u")).cast("long"))
    assert rows(ordering.number_rows(df, ["k", "u"])) == rows(expected)


def test_running_total_in_parts(spark, tight):
    df = skewed(spark).withColumn("u", F.monotonically_increasing_id())
    expected = df.withColumn("t", F.sum("x").over(W.orderBy("k", "u").rowsBetween(W.unboundedPreceding, 0)))
    assert rows(ordering.running_total(df, ["k", "u"], "x", "t")) == rows(expected)


def test_ranks_in_hot_groups(spark, tight):
    df = skewed(spark).where("k is not null").groupBy("k", "x").agg(F.count("*").alias("n"))
    order = [F.desc("n"), F.asc("x")]
    expected = df.withColumn("rn", F.row_number().over(W.partitionBy("k").orderBy(*order)).cast("long"))
    assert rows(ordering.rank_in_group(df, "k", order, "x")) == rows(expected)
    assert rows(ordering.rank_in_group_sql(df, "k", "n", "x")) == rows(expected)


def test_rank_correlation_in_parts(spark, tight):
    generator = random.Random(1)
    values = [(generator.randint(0, 30), generator.randint(0, 30)) for _ in range(500)] + [(7, None), (None, 1)]
    df = spark.createDataFrame(values, "x int, y int")
    import pandas as pd

    # Spearman is the correlation of average ranks.
    frame = pd.DataFrame([v for v in values if None not in v], columns=["x", "y"]).rank()
    assert aggregates.spearman(df, "x", "y").first()["corr"] == pytest.approx(frame["x"].corr(frame["y"]))


def test_text_with_large_vocabulary_path(spark, tight):
    docs = spark.createDataFrame([(i, "the " * 5 + f"w{i % 7} x{i}") for i in range(60)], "doc long, text string")
    terms = text.tf_idf(docs, "doc", "text").collect()
    assert len(terms) == 180
    assert {r["tf"] for r in terms if r["term"] == "the"} == {5}
    assert all(r["idf"] == 0.0 for r in terms if r["term"] == "the")
    index = {r["term"]: r["term_index"] for r in text.count_vectors(docs, "doc", "text").collect()}
    assert index["the"] == 0 and sorted(index.values()) == list(range(len(index)))


def test_huffman_runs_equal_the_plain_tree():
    generator = random.Random(9)
    for n in [1, 2, 3, *(generator.randint(4, 60) for _ in range(100))]:
        weights = sorted(int(1 / generator.random()) for _ in range(n))
        # The plain way of two queues; of equal weights the inner node goes first.
        known, parents, codes, leaf, inner = list(weights), {}, {}, 0, n
        for made in range(n, 2 * n - 1):
            for code in (0, 1):
                if leaf < n and (inner >= made or known[leaf] < known[inner]):
                    at, leaf = leaf, leaf + 1
                else:
                    at, inner = inner, inner + 1
                parents[at], codes[at] = made, code
            known.append(sum(known[x] for x, p in parents.items() if p == made))
        tree = embedding.HuffmanRuns(sorted(Counter(weights).items()))
        first, node, code, nodes = tree.paths(np.arange(n))
        assert nodes == n - 1
        for i in range(n):
            path, at = [], i
            while at in parents:
                path.append((parents[at] - n, codes[at]))
                at = parents[at]
            assert list(zip(node[first[i]:first[i + 1]].tolist(), code[first[i]:first[i + 1]].tolist())) == path


@pytest.mark.parametrize("partitions", [1, 4])
def test_word_vectors_tell_topics_apart(spark, monkeypatch, partitions):
    monkeypatch.setattr(embedding, "PIECE_WORDS", 500)
    generator = random.Random(4)
    docs = [(i, [f"{'ab'[i % 2]}{min(int(generator.expovariate(0.15)), 29)}" for _ in range(30)]) for i in range(1200)]
    docs += [(1200, []), (1201, None), *((1202 + i, docs[i][1]) for i in range(4))]
    df = spark.createDataFrame(docs, "i int, w array<string>").repartition(3)
    found = {r["i"]: r["vector"].toArray() for r in text.word_vectors(df, "w", 4, partitions=partitions).collect()}
    assert len(found) == len(docs)
    assert not found[1200].any() and not found[1201].any() and all((found[1202 + i] == found[i]).all() for i in range(4))
    vectors = np.array([found[i] for i in range(1200)])
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    alike = vectors @ vectors.T
    same = np.arange(1200)[:, None] % 2 == np.arange(1200) % 2
    assert alike[same].mean() > 0.95 and alike[~same].mean() < 0


def test_word_vectors_beyond_the_broadcast_bound(spark, tight):
    docs = [(i, [f"w{i % 9}", f"w{i % 7}", f"x{i % 11}"]) for i in range(90)] + [(90, []), (91, None)]
    df = spark.createDataFrame(docs, "i int, w array<string>")
    found = text.word_vectors(df, "w", partitions=2).select("i", "vector")
    assert sorted(r["i"] for r in found.collect()) == list(range(92))
    assert {r["i"] for r in found.collect() if not r["vector"].toArray().any()} == {90, 91}
    below = found._jdf.queryExecution().optimizedPlan().toString().split("Join", 1)[1]
    assert ", w#" not in below.split("Project [", 1)[1].split("]", 1)[0]  # the words do not go through the join


def test_word_vectors_leave_rare_words_out(spark):
    df = spark.createDataFrame([(["x", "y"] * 8 + ["rare"] * 16,), (["rare2"],)], "w array<string>")
    found = {len(r["w"]): r["vector"].toArray() for r in text.word_vectors(df, "w", min_count=2, partitions=1).collect()}
    assert not found[1].any() and found[32].any()
    plain = spark.createDataFrame([(["x", "y"] * 8,)], "w array<string>")
    assert text.word_vectors(plain, "w", min_count=99).first()["vector"].toArray().tolist() == [0, 0, 0]


def test_word_vectors_keep_the_vocabulary_off_the_driver(tmp_path):
    """100,000 different words, of which the driver may be sent 2 MB in all."""
    (tmp_path / "run.py").write_text("""
from pyspark.sql import SparkSession, functions as F
from tagloom.operators import text

spark = (SparkSession.builder.master("local[2]").config("spark.driver.maxResultSize", "2m").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").getOrCreate())
words = F.transform(F.sequence(F.col("id") * 50, F.col("id") * 50 + 49), lambda x: F.concat(F.lit("w"), x))
print("rows", text.word_vectors(spark.range(2000).select(words.alias("w")), "w").count())
""")
    env = os.environ | {"PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "run.py"], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "rows 2000" in done.stdout, done.stderr[-2000:]


def test_tag_paths(spark, tight):
    empty = spark.createDataFrame([], "id long, name string, rule string, level int, pid long")
    first = rules.upsert_paths(empty, spark.createDataFrame([("a", "b", "c")], "name1 string, name2 string, name3 string"))
    paths = spark.createDataFrame([("a", "b", "c"), ("a", "b", "d"), ("a", "x", "c"), ("z", "b", "c"), ("a", "b", "d")],
                                  "name1 string, name2 string, name3 string")
    tags = rules.upsert_paths(first, paths).collect()
    names = {t["id"]: t["name"] for t in tags}
    assert len(names) == len(tags)
    found = sorted((t["level"], t["name"], names.get(t["pid"], "")) for t in tags)
    assert found == [(1, "a", ""), (1, "z", ""), (2, "b", "a"), (2, "b", "z"), (2, "x", "a"),
                     (3, "c", "b"), (3, "c", "b"), (3, "c", "x"), (3, "d", "b")]
    assert {t["pid"] for t in tags if t["level"] == 1} == {-1}
    assert rules.upsert_paths(spark.createDataFrame(tags, empty.schema), paths).count() == len(tags)


def test_best_matches_equal_the_ml_recommendation(spark, monkeypatch):
    generator = random.Random(2)
    seen = {(generator.randint(0, 60), generator.randint(0, 40)) for _ in range(600)}
    ratings = spark.createDataFrame([(u, i, float(generator.randint(1, 9))) for u, i in seen], "userId int, itemId int, rating double")
    model = recommend.fit_als(ratings, rank=4, iterations=3)
    some_users = spark.createDataFrame([(1,), (2,), (2,), (999,)], "userId int")
    some_items = spark.createDataFrame([(3,), (4,)], "itemId int")

    def listed(*frames):
        return [{r[0]: [(x[0], round(x[1], 4)) for x in r["recommendations"]] for r in f.collect()} for f in frames]

    def results():
        return listed(recommend.top_items(model, 5), recommend.top_items(model, 3, some_users), recommend.top_users(model, 100),
                      recommend.top_users(model, 4, some_items))

    monkeypatch.setattr(recommend, "BLOCK_CELLS", 100)  # a few rows per block
    found = results()
    plan = recommend.top_items(model, 5)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Cross" not in plan
    monkeypatch.setattr(recommend, "FACTOR_BYTES", 200)  # a few factors at once
    in_parts = results()
    assert "Cross" not in recommend.top_items(model, 5)._jdf.queryExecution().toString()
    expected = listed(model.recommendForAllUsers(5), model.recommendForUserSubset(some_users, 3), model.recommendForAllItems(100),
                      model.recommendForItemSubset(some_items, 4))
    for mine, parts, theirs in zip(found, in_parts, expected):
        assert mine.keys() == theirs.keys() == parts.keys()
        for key, best in mine.items():
            for other in (theirs[key], parts[key]):
                assert [s for _, s in best] == pytest.approx([s for _, s in other], abs=2e-4)
            assert len({i for i, _ in best}) == len(best) == len({i for i, _ in parts[key]})
    assert len(found[0]) == 61 and set(found[1]) == {1, 2} and set(found[3]) == {3, 4}


def test_plans_have_no_cross_join_and_prune(spark, sf_dir):
    from __spark_entry__ import queries

    plan = queries()["t14_profile"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "Join Cross" not in plan
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in plan
    top = queries()["t5_payment_method"](spark, sf_dir)._jdf.queryExecution().toString()
    assert top.count("WindowGroupLimit") >= 2  # the top-1 is taken on both sides of the shuffle


def test_highest_columns_with_ties():
    rng = np.random.default_rng(7)
    for n in (1, 3, 6):
        values = rng.integers(0, 4, (50, 6)).astype(np.float32)
        expected = [sorted(range(6), key=lambda c: (-row[c], c))[:n] for row in values]
        assert recommend.highest(values, n).tolist() == expected

"""Known inputs and results of the operators."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tagloom.functions.dates import compact_date, days_since, epoch_to_text, epoch_to_timestamp
from tagloom.functions.scores import RFE_BINS, RFM_BINS, price_sensitivity
from tagloom.functions.texts import item_of_url, struct_field_csv, tag_set, tokens
from tagloom.operators import aggregates, classify, cluster, features, text
from tagloom.operators.match import match_exact, rank_zip
from tagloom.operators.rules import range_rules, source_spec
from tagloom.plans import tags as jobs


def pairs(df):
    return sorted(tuple(r) for r in df.collect())


GENDER = [(5, "1"), (6, "2")]
JOB = [(8, "1"), (9, "2"), (10, "3"), (11, "4"), (12, "5"), (13, "6")]
AGE = [(15, "19500101-19591231"), (16, "19600101-19691231"), (17, "19700101-19791231"), (18, "19800101-19891231"),
       (19, "19900101-19991231"), (20, "20000101-20091231"), (21, "20100101-20191231"), (22, "20200101-20291231")]
CYCLE = [(24, "0-7"), (25, "8-14"), (26, "15-30"), (27, "31-60"), (28, "61-90")]
PAYMENT = [(30, "alipay"), (31, "wxpay"), (32, "chinapay"), (33, "kjtpay"), (34, "cod"), (35, "other")]


def rules(spark, rows):
    return spark.createDataFrame(rows, "id long, rule string")


def test_source_rule(spark):
    rule = ("inType=HBase##zkHosts=zk.example##zkPort=2181##hbaseTable=tbl_users##family=detail##"
            "selectFields=id,gender")
    tags = spark.createDataFrame([(4, "gender", rule, 4, 3), (9, "bad", "inType=HBase##oops", 4, 3)],
                                 "id long, name string, rule string, level int, pid long")
    spec = source_spec(tags, 4)
    assert (spec.in_type, spec.table, spec.fields) == ("HBase", "tbl_users", ("id", "gender"))
    assert spec.options["zkPort"] == "2181"
    with pytest.raises(ValueError):
        source_spec(tags, 9)
    with pytest.raises(KeyError):
        source_spec(tags, 5)


def test_gender_and_job(spark):
    users = spark.createDataFrame([("1", "2", "3"), ("10", "2", "5"), ("100", "1", "1"), ("101", "1", "6")],
                                  "id string, gender string, job string")
    assert pairs(jobs.exact_tag(users, rules(spark, GENDER), "gender")) == [
        ("1", "6"), ("10", "6"), ("100", "5"), ("101", "5")]
    assert pairs(jobs.exact_tag(users, rules(spark, JOB), "job")) == [
        ("1", "10"), ("10", "12"), ("100", "8"), ("101", "13")]


def test_age(spark):
    users = spark.createDataFrame([("1", "1992-05-31"), ("2", "1989-12-31"), ("3", "1990-01-01"), ("4", None),
                                   ("5", "1949-12-31")], "id string, birthday string")
    assert users.select(compact_date(F.col("birthday"))).first()[0] == "19920531"
    assert pairs(jobs.age_tag(users, rules(spark, AGE))) == [("1", "19"), ("2", "18"), ("3", "19")]


def test_cycle(spark):
    assert spark.range(1).select(epoch_to_text(F.lit(1564415022))).first()[0] == "2019-07-29 15:43:42"
    orders = spark.createDataFrame([("a", "1564415022"), ("a", "1500000000"), ("b", "1567000000")],
                                   "memberId string, finishTime string")
    assert pairs(jobs.cycle_tag(orders, rules(spark, CYCLE), "2019-08-12")) == [("a", "25")]
    # 200 days later with the day moved back again.
    assert pairs(jobs.cycle_tag(orders, rules(spark, CYCLE), "2020-02-28", 200)) == [("a", "25")]


def test_days_since_does_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        row = spark.range(1).select(days_since(epoch_to_timestamp(F.lit(1564358400)), "2019-07-30")).first()
        assert row[0] == 1  # 2019-07-29 00:00:00 UTC
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_payment(spark):
    used = {"alipay": 89, "cod": 12, "kjtpay": 9, "wspay": 3, "giftCard": 2, "prepaid": 1}
    rows = [("13822725", method) for method, n in used.items() for _ in range(n)]
    rows += [("7", "wspay"), ("8", None), ("9", "cod"), ("9", "alipay")]
    orders = spark.createDataFrame(rows, "memberId string, paymentCode string")
    counts = aggregates.usage_counts(orders, "memberId", "paymentCode")
    assert {r["paymentCode"]: r["counts"] for r in counts.where("memberId = '13822725'").collect()} == used
    assert counts.where("memberId = '8'").first()["counts"] == 0
    # An unknown and a missing method count as other; a tie goes to the first name.
    assert pairs(jobs.payment_tag(orders, rules(spark, PAYMENT))) == [
        ("13822725", "30"), ("7", "35"), ("8", "35"), ("9", "30")]


def test_rfm_scores(spark):
    raw = spark.createDataFrame([("1", 12, 116, 179298.34), ("2", 12, 132, 233524.17), ("3", 0, 0, 199999.5)],
                                "userId string, recency int, frequency long, monetary double")
    assert pairs(jobs.score(raw, RFM_BINS)) == [("1", 2, 3, 4), ("2", 2, 3, 5), ("3", None, None, None)]


def test_rfe_scores(spark):
    raw = spark.createDataFrame([("1", 0, 400, 250), ("2", 60, 99, 150), ("3", 61, 100, 49), ("4", -1, 300, 50)],
                                "userId string, recency int, frequency long, engagements long")
    assert pairs(jobs.score(raw, RFE_BINS)) == [("1", 5, 5, 5), ("2", 2, 1, 3), ("3", 1, 2, 1), ("4", None, 4, 2)]


def test_cluster_rank(spark):
    sums = [10.0, 3.4, 8.97, 11.04, 7.0, 5.25, 4.5]
    ranked = cluster.rank_tags(spark.range(1), [[s] for s in sums], rules(spark, [(37 + n, str(n)) for n in range(1, 8)]))
    assert {r["cluster"]: r["tagsId"] for r in ranked.collect()} == {3: 38, 0: 39, 2: 40, 4: 41, 5: 42, 6: 43, 1: 44}
    with pytest.raises(ValueError):
        cluster.rank_tags(spark.range(1), [[1.0], [2.0]], rules(spark, [(1, "1")]))


def test_rank_zip_order(spark):
    items = spark.createDataFrame([(0, 5.0), (1, 5.0), (2, 9.0)], "i int, s double")
    ranks = rules(spark, [(1, "1"), (2, "2"), (3, "10")])
    by_text = {r["i"]: r["tagsId"] for r in rank_zip(items, "i", "s", ranks).collect()}
    assert by_text == {2: 1, 1: 3, 0: 2}  # ties: higher item first; "10" sorts before "2"
    by_number = {r["i"]: r["tagsId"] for r in rank_zip(items, "i", "s", ranks, numeric_rank=True).collect()}
    assert by_number == {2: 1, 1: 2, 0: 3}


def test_price_sensitivity(spark):
    raw = spark.createDataFrame([(3, 142, 500.0, 252430.92), (4, 116, 800.0, 180098.34), (1, 108, 200.0, 169946.1),
                                 (0, 5, 0.0, 100.0)], "tdon long, ton long, tda double, tra double")
    found = [r[0] for r in raw.select(price_sensitivity(*[F.col(c) for c in raw.columns])).collect()]
    assert found[:3] == pytest.approx([0.11686252330855691, 0.16774328728519597, 0.13753522440350205], abs=1e-15)
    assert found[3] is None


def test_users_without_discount(spark):
    orders = spark.createDataFrame([("a", "10.0", "0.00"), ("b", "10.0", "2.00")],
                                   "memberId string, orderAmount string, couponCodeValue string")
    assert [r["userId"] for r in jobs.psm_features(orders).collect()] == ["b"]
    kept = {r["userId"]: r["psm"] for r in jobs.psm_features(orders, "least_sensitive").collect()}
    assert kept["a"] == 0.0 and kept["b"] > 0


def test_price_sensitivity_groups(spark):
    rows = [(f"{coupon}-{i}", str(100.0 - coupon + i / 100), str(float(coupon))) for coupon in (2, 30, 60) for i in range(20)]
    orders = spark.createDataFrame(rows, "memberId string, orderAmount string, couponCodeValue string")
    assert jobs.psm_cluster_count(orders, range(2, 7)) == 3
    tagged = jobs.psm_tag(orders, rules(spark, [(51, "1"), (52, "2"), (53, "3")]))
    assert {(r["userId"].split("-")[0], r["tagsId"]) for r in tagged.collect()} == {("60", "51"), ("30", "52"), ("2", "53")}


def test_votes(spark):
    rows = [("a", 13, 4), ("b", 12, 1), ("c", 3, 0), ("d", 3, 2), ("e", 5, 2), ("f", 1, 4)]
    predicted = spark.createDataFrame([(u, g, n) for u, m, f in rows for g, n in (("男", m), ("女", f)) if n],
                                      "userId string, gender string, n long")
    tagged = jobs.vote_tag(predicted, rules(spark, [(57, "0"), (58, "1"), (59, "-1")]), "gender")
    assert pairs(tagged) == [("a", "57"), ("b", "57"), ("c", "57"), ("d", "59"), ("e", "57"), ("f", "58")]


def test_purchase_codes(spark):
    goods = spark.createDataFrame([("o1", "樱花粉", "烤箱"), ("o1", "黑色", "Haier/海尔冰箱"), ("o2", None, "挂烫机"),
                                   ("o2", "绿色", None), ("o2", "绿色", None)],
                                  "cOrderSn string, ogColor string, productType string")
    orders = spark.createDataFrame([("o1", "u"), ("o2", "v")], "orderSn string, memberId string")
    found = jobs.purchases(goods, orders).select("userId", "color", "productType", "gender", "n")
    assert pairs(found) == [("u", 3, 10, "男", 1), ("u", 17, 28, "女", 1), ("v", 0, 0, "男", 2), ("v", 0, 22, "女", 1)]


def test_url_items(spark):
    urls = ["http://shop.example/product/11013.html?ebi=1", "http://x.html/product/5.html", "http://x/product/.html",
            "http://x/product/5", "http://x/5.html", None, "http://x/product/a/product/b.html"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(item_of_url(F.col("u"))).collect()] == ["11013", None, "", None, None, None, "a/product/b"]


def test_recommendations_as_csv(spark):
    df = spark.createDataFrame([(471, [(10935, 1.0), (6603, 0.9), (9371, 0.8), (6393, 0.7), (6395, 0.6)])],
                               "userId int, r array<struct<productId:int, rating:float>>")
    assert df.select(struct_field_csv(F.col("r"), "productId")).first()[0] == "10935,6603,9371,6393,6395"


@pytest.mark.parametrize("offset", [0, 10**12])
def test_preferred_products_of_short_and_long_ids(spark, offset):
    # Two groups of users that visit products 0-9 and 10-19, each user all but its own number.
    logs = spark.createDataFrame([(str(offset + u), f"http://shop.example/product/{offset + 10 * (u % 2) + i}.html", "t")
                                  for u in range(20) for i in range(10) for _ in range(3) if i != u // 2] + [("x", None, "t")],
                                 "global_user_id string, loc_url string, log_time string")
    found = {int(r["userId"]) - offset: [int(i) - offset for i in r["tagsId"].split(",")] for r in jobs.bp_tag(logs).collect()}
    assert sorted(found) == list(range(20))
    for user, items in found.items():
        assert len(set(items)) == 5 and all(i // 10 == user % 2 for i in items)


def test_tag_set(spark):
    rows = [("10", "6"), (" ", "6"), ("5", None), (None, "  "), ("3,3,1", "1,2,"), ("", "7")]
    df = spark.createDataFrame(rows, "a string, b string")
    assert [r[0] for r in df.select(tag_set(F.col("a"), F.col("b"))).collect()] == ["10,6", "6", "5", None, "1,2,3", "7"]


def test_column_statistics(spark):
    row = aggregates.column_stats(spark.createDataFrame([(float(i),) for i in range(1, 6)], "x double"), ["x"]).first()
    assert (row["max"], row["min"], row["mean"], row["variance"], row["l1"]) == (5, 1, 3, 2.5, 15)
    assert row["l2"] == pytest.approx(7.416198487095663)


def test_correlations(spark):
    df = spark.createDataFrame([(float(i), 10.0 * i, -10.0 * i, float(i) ** 3) for i in range(1, 6)], "x double, y double, z double, c double")
    assert aggregates.pearson(df, "x", "y").first()[0] == pytest.approx(1.0)
    assert aggregates.pearson(df, "x", "z").first()[0] == pytest.approx(-1.0)
    assert aggregates.spearman(df, "x", "c").first()[0] == pytest.approx(1.0)


def test_count_vectorizer(spark):
    df = spark.createDataFrame([(0, ["a", "b", "c"]), (1, ["a", "b", "b", "c", "a"])], "id int, words array<string>")
    rows = {r["id"]: r["counts"] for r in text.count_vectorizer(df, "words").collect()}
    assert list(rows[1].toArray()) == [2.0, 2.0, 1.0]


def test_tokens_equal_the_ml_tokenizer(spark):
    from pyspark.ml.feature import Tokenizer

    texts = ["Hello Spark  World", " lead", "trail  ", "a\tb\n c", "", "   ", "x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    both = Tokenizer(inputCol="t", outputCol="w").transform(df).select("w", tokens(F.col("t")))
    for expected, found in both.collect():
        assert found == expected


def test_word_vectors(spark):
    sentences = ["Hi I heard about Spark", "I wish Java could use case classes", "Logistic regression models are neat"]
    df = spark.createDataFrame([(s.split(" "),) for s in sentences], "text array<string>")
    assert [r["n"] for r in text.word_vectors(df, "text").select(F.size(vector_to_array("vector")).alias("n")).collect()] == [3, 3, 3]


def test_hashed_tf_idf(spark):
    df = spark.createDataFrame([(0, "Hi I heard about Spark"), (1, "I wish Java could use case classes")], "label int, words string")
    rows = text.hashed_tf_idf(df, "words").collect()
    assert [sum(r["tf"].toArray()) for r in rows] == [5, 7]
    assert rows[0]["tf"].size == 1 << 18


def test_one_hot(spark):
    df = spark.createDataFrame([(0, "红"), (1, "绿"), (2, "蓝")], "id int, colour string")
    labels = features.category_index(df, "colour")
    indexed = features.index_strings(df, "colour", labels, "i")
    assert {r["colour"]: r["i"] for r in indexed.collect()} == {"红": 0.0, "绿": 1.0, "蓝": 2.0}
    hot = {r["i"]: r["v"] for r in features.one_hot(indexed, "i", "v").collect()}
    assert hot[0.0] == Vectors.sparse(2, [0], [1.0]) and hot[1.0] == Vectors.sparse(2, [1], [1.0])
    assert hot[2.0] == Vectors.sparse(2, [], [])
    back = features.index_to_string(indexed, "i", labels, "name").collect()
    assert all(r["name"] == r["colour"] for r in back)


def test_assembler(spark):
    df = spark.createDataFrame([(0, 18, 1.0, Vectors.dense([0.0, 10.0, 0.5]), 1.0)],
                               ["id", "hour", "mobile", "userFeatures", "clicked"])
    row = features.assemble(df, ["hour", "mobile", "userFeatures", "clicked"]).first()
    assert list(row["features"].toArray()) == [18, 1, 0, 10, 0.5, 1]


def test_standard_scaler(spark):
    rows = [(1.0, 2.0, 3.0, 4.0, 5.0), (2.0, 3.0, 4.0, 5.0, 10.0), (3.0, 4.0, 5.0, 6.0, 14.0)]
    df = spark.createDataFrame(rows, ["a", "b", "c", "d", "e"])
    scaled, _ = features.standard_scale(df, df.columns, with_mean=True)
    assert [round(r["scaled"][4], 4) for r in scaled.collect()] == [-1.0349, 0.0739, 0.961]
    assert features.standard_scale(df, df.columns)[0].first()["scaled"][0] == pytest.approx(1.0)


def test_min_max_scaler(spark):
    # The ranges of the four iris measures.
    df = spark.createDataFrame([(5.1, 3.5, 1.4, 0.2), (4.3, 2.0, 1.0, 0.1), (7.9, 4.4, 6.9, 2.5)], ["a", "b", "c", "d"])
    first = features.min_max_scale(df, df.columns).where("a = 5.1").first()["scaled"]
    assert [round(x, 4) for x in first] == [0.2222, 0.625, 0.0678, 0.0417]


# (gender, hobby, age, salary) and the label of ten people; gender decides most.
PEOPLE = [(1, 1, 3, 1, 1), (1, 2, 1, 2, 1), (1, 3, 2, 1, 1), (1, 1, 1, 3, 1), (0, 2, 3, 2, 0),
          (0, 3, 1, 1, 0), (0, 1, 2, 3, 0), (0, 2, 2, 2, 0), (1, 3, 3, 3, 0), (0, 1, 1, 1, 1)]


def test_chi_square_equals_the_ml_test(spark):
    from pyspark.ml.stat import ChiSquareTest

    names = ["gender", "hobby", "age", "salary"]
    df = spark.createDataFrame([tuple(float(x) for x in row) for row in PEOPLE], [*names, "label"])
    found = {r["feature"]: (r["statistic"], r["dof"]) for r in features.chi_square(df, names, "label").collect()}
    vectors = features.assemble(df, names)
    expected = ChiSquareTest.test(vectors, "features", "label").first()
    assert [found[n][0] for n in names] == pytest.approx(list(expected["statistics"]))
    assert [found[n][1] for n in names] == list(expected["degreesOfFreedom"])
    chosen = features.select_by_chi_square(vectors, "features", "label", 1).select("gender", "selected").collect()
    assert all(r["selected"][0] == r["gender"] for r in chosen)


def test_metrics_equal_the_ml_evaluators(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator

    rows = [(1.0, 1.0)] * 7 + [(1.0, 0.0)] * 2 + [(0.0, 0.0)] * 5 + [(0.0, 1.0)] * 3
    df = spark.createDataFrame(rows, "label double, prediction double")
    counts = classify.confusion(df, "label", "prediction")
    found = classify.classification_metrics(counts).first()
    for name, metric in (("accuracy", "accuracy"), ("weighted_f1", "f1")):
        assert found[name] == pytest.approx(MulticlassClassificationEvaluator(metricName=metric).evaluate(df))
    assert found["error_rate"] == pytest.approx(1 - found["accuracy"])
    auc = BinaryClassificationEvaluator(rawPredictionCol="prediction").evaluate(df)
    assert classify.hard_auc(counts, 1.0).first()["auc"] == pytest.approx(auc)


def test_unknown_value_fails_the_strict_match(spark):
    users = spark.createDataFrame([("1", "9")], "id string, gender string")
    with pytest.raises(Exception, match="no rule for value 9"):
        match_exact(users, "gender", rules(spark, GENDER)).collect()
    assert match_exact(users, "gender", rules(spark, GENDER), on_missing="drop").count() == 0
    assert match_exact(users, "gender", rules(spark, GENDER), on_missing="null").first()["tagsId"] is None


def test_range_rules(spark):
    assert pairs(range_rules(rules(spark, CYCLE[:2]))) == [(24, 0, 7), (25, 8, 14)]


def test_kmeans_separates_groups(spark):
    rows = [(str(i), float(c * 100 + i % 3)) for c in range(3) for i in range(30)]
    df = spark.createDataFrame(rows, "userId string, x double")
    centres = sorted(c[0] for c in cluster.fit_kmeans(df, ["x"], 3))
    assert centres == pytest.approx([1.0, 101.0, 201.0])
    table = cluster.elbow(df, ["x"], range(2, 7))
    assert cluster.select_k(table) == 3


def test_fewer_points_than_clusters(spark):
    one = spark.createDataFrame([("a", 2.0), ("b", 2.0)], "userId string, x double")
    assert cluster.fit_kmeans(one, ["x"], 3) == [[2.0]]
    assert [tuple(r) for r in cluster.elbow(one, ["x"], [2, 3]).collect()] == [(2, 1, 0.0), (3, 1, 0.0)]
    tagged = jobs.cluster_tag(one, ["x"], rules(spark, [(51, "1"), (52, "2"), (53, "3")]))
    assert pairs(tagged) == [("a", "51"), ("b", "51")]


def test_fitted_clusters_are_ranked_best_first(spark):
    rows = [(f"u{c}{i}", c, c, c) for c in (1, 3, 5) for i in range(10)]
    scores = spark.createDataFrame(rows, "userId string, recency int, frequency int, monetary int")
    tagged = jobs.cluster_tag(scores, ["recency", "frequency", "monetary"], rules(spark, [(38, "1"), (39, "2"), (40, "3")]))
    assert {r["userId"][1]: r["tagsId"] for r in tagged.collect()} == {"5": "38", "3": "39", "1": "40"}


def test_outlier_filters_overlap(spark):
    df = spark.createDataFrame([(1, 1.0, 500.0), (2, 500.0, 1e6), (3, 1.0, 1.0), (4, 9.0, 9.0)], "id int, price double, size double")
    kept, bad = aggregates.outlier_filter(df, "price", "size")
    assert sorted(r["id"] for r in kept.collect()) == [1, 2, 4]
    assert sorted(r["id"] for r in bad.collect()) == [1, 2, 3]

"""Number of clusters by the gap statistic, stored models by fingerprint, and recommendations by length."""

import numpy as np
import pytest

from tagloom.operators import cluster, recommend
from tagloom.sources.stores import fingerprint, stored_centres


def blobs(k, n=60, spread=0.3, seed=5):
    rng = np.random.default_rng(seed)
    corners = np.array([[i % 3 * 10, i // 3 * 10] for i in range(k)], float)
    return (corners[:, None] + rng.normal(0, spread, (k, n, 2))).reshape(-1, 2)


@pytest.mark.parametrize("k", [1, 2, 3, 5])
def test_gap_finds_the_planted_number(spark, k):
    points = spark.createDataFrame([tuple(map(float, p)) for p in blobs(k, spread=1.0 if k == 1 else 0.3)] + [(None, 1.0)], "x double, y double")
    table = cluster.gap_statistic(points, ["x", "y"], range(1, 8))
    assert cluster.gap_k(table) == k
    sse = [r["sse"] for r in table.orderBy("k").collect()]
    assert sse[0] == pytest.approx(cluster.sum_of_squares(points.dropna(), ["x", "y"], cluster.fit_kmeans(points, ["x", "y"], 1)).first()[0])


def test_gap_of_odd_points(spark):
    same = spark.createDataFrame([(1.0, 2.0)] * 5, "x double, y double")
    table = cluster.gap_statistic(same, ["x", "y"], [1, 2, 3])
    assert [r["sse"] for r in table.collect()] == [0.0] * 3 and cluster.gap_k(table) == 1
    assert cluster.gap_statistic(same.limit(0), ["x", "y"], [1, 2]).count() == 0
    flat = spark.createDataFrame([(float(i // 50 * 100 + i % 50 / 50), 3.0) for i in range(100)], "x double, y double")
    assert cluster.gap_k(cluster.gap_statistic(flat, ["x", "y"], range(1, 5))) == 2


def test_all_errors_from_one_pass(spark):
    points = spark.createDataFrame([(0.0,), (2.0,), (10.0,), (None,)], "x double")
    assert cluster.errors(points, ["x"], [[[0.0]], [[1.0], [10.0]]]) == [pytest.approx(104 / 3), pytest.approx(2 / 3)]


def test_models_belong_to_data_and_parameters(spark, tmp_path):
    path, fits = str(tmp_path / "m"), []
    data = spark.createDataFrame([(1.0,), (2.0,), (2.0,)], "x double")

    def fit():
        fits.append(1)
        return [[float(len(fits))]]

    def stored(df, **more):
        return stored_centres(spark, path, 1, ["x"], fit, data=df, **more)

    assert stored(data) == stored(data.orderBy("x").repartition(3)) == [[1.0]]
    assert stored(data.distinct()) == [[2.0]] and stored(data, parameters={"seed": 3}) == [[3.0]] and stored(data) == [[1.0]]
    assert stored(data, refresh=True) == [[4.0]] and stored(data) == [[4.0]]
    assert stored_centres(spark, path, 1, ["x"], fit) == [[5.0]]
    for left in (tmp_path / "m").glob("*.json"):
        (left.parent / f"{left.stem.rsplit('.', 1)[0]}.000009.json.abc.tmp").write_text("{")  # a save that broke off
    assert stored(data) == [[4.0]] and len(fits) == 5
    assert fingerprint(data, ["x"]) != fingerprint(data.limit(0), ["x"])


def test_later_parts_are_not_sent(spark, monkeypatch):
    rng = np.random.default_rng(3)
    items = rng.normal(0, 1, (120, 4)).astype(np.float32) * np.array([10.0 if i < 12 else 0.01 for i in range(120)], np.float32)[:, None]
    items[30:60] = 0  # equal lengths, more of them than a part holds
    users = rng.normal(0, 1, (50, 4)).astype(np.float32)
    factors = [spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(m)], "id int, features array<float>") for m in (users, items)]
    calls, with_part = [], recommend._with_part

    def counted(*a):
        calls.append(1)
        return with_part(*a)

    monkeypatch.setattr(recommend, "_with_part", counted)
    monkeypatch.setattr(recommend, "FACTOR_BYTES", 12 * 5 * 4)
    for n, most in ((2, 3), (200, 1000)):
        calls.clear()
        found = {r.userId: [(x["itemId"], x["rating"]) for x in r.recommendations] for r in recommend._best_matches(*factors, 4, n, "userId", "itemId", None).collect()}
        products = users @ items.T
        for u in range(50):
            expected = sorted(range(120), key=lambda i: (-products[u, i], i))[:n]
            assert [r for _, r in found[u]] == pytest.approx([float(products[u, i]) for i in expected], abs=1e-5)
            if n == 2:
                assert [i for i, _ in found[u]] == expected
        assert len(calls) <= most
    parts = list(recommend.parts_by_length(factors[1].select("id", "features", recommend._length().alias("_length")), 11, 4))
    assert sum(p.count() for p, _ in parts) == 120 and [x for _, x in parts] == sorted((x for _, x in parts), reverse=True)

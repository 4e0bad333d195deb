import math
import random
import time
from itertools import combinations
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.operators import ml
from kestrel.plans import queries as q
from kestrel.sources import readers

NEAR = [(x, x + 1.0, y) for x in (0.0, 0.5, 1.0) for y in (0.0, 0.25)]
FAR = [(x + 40.0, 30.0 - x, y) for x in (0.0, 0.5, 1.0) for y in (0.0, 0.25)]
BASKETS = ["oak elm ash", "oak elm", "oak ash fir", "elm fir", "oak elm ash fir", "yew"]


def test_kmeans_fixture(spark):
    lines = [" ".join(map(str, p)) for p in NEAR + FAR]
    pts = readers.parse_vector(spark.createDataFrame([(x,) for x in lines], "value string"))
    model = ml.kmeans_fit(pts, k=2, max_iter=20, seed=1)
    means = [tuple(sum(c) / len(g) for c in zip(*g)) for g in (NEAR, FAR)]
    assert sorted(tuple(round(v, 9) for v in c) for c in model.clusterCenters()) == sorted(
        tuple(round(v, 9) for v in m) for m in means)
    cost = sum(sum((a - b) ** 2 for a, b in zip(p, m)) for g, m in zip((NEAR, FAR), means) for p in g)
    assert abs(ml.kmeans_cost(model, pts).first()[0] - cost) < 1e-9
    assert abs(ml.nearest_center(model, pts).agg(F.sum("least")).first()[0] - cost) < 1e-9


def test_als_fixture(spark):
    rows = [(u, i, 5.0 if (u <= 2) == (i % 2 == 1) else 1.0) for u in range(1, 5) for i in range(1, 5)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double")
    model = ml.als_fit(ratings, rank=50, max_iter=10, reg=0.01, seed=0)
    pred = model.transform(ratings.select("user", "item"))
    m = ml.mse(ml.score_against(ratings, pred), "rating", "prediction").first()
    assert m["rows"] == 16 and m["mse"] < 1e-2


def test_als_drops_the_shuffles_of_past_iterations(spark):
    """Of ten iterations (two shuffles each) only the last may still lie on disk."""
    dirs = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def shuffles():
        return {f.name.split("_")[1] for d in dirs for f in Path(d).glob("*/shuffle_*.data")}

    rows = [(u, i, float((u * i) % 5)) for u in range(60) for i in range(u % 3, 40, 3)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double").cache()
    ratings.count()
    before = shuffles()
    model = ml.als_fit(ratings, rank=4, max_iter=10)
    assert model.transform(ratings).count() == len(rows)
    for _ in range(50):  # files are removed in the background
        left = shuffles() - before
        if len(left) <= 9:
            break
        time.sleep(0.2)
    assert len(left) <= 9
    ratings.unpersist()


def test_als_blocks_grow_in_number_not_in_size(spark, monkeypatch):
    """The ratings of a block, and the other side's factors that they name, fit one
    task, where a fixed number of blocks would grow with the ratings."""
    room, factor, rating = 22_500, 4 * 50 + 24, 80
    monkeypatch.setattr(ml, "ALS_TASK_MB", room / 1e6, raising=False)
    rng = random.Random(1)
    rows = [(u, i, float(u % 5 + i % 3)) for u in range(80) for i in rng.sample(range(300), 25)]
    ratings = spark.createDataFrame(rows, "user int, item int, rating double").cache()
    model = ml.als_fit(ratings, rank=50, max_iter=3)
    users, items = model.userFactors.rdd.getNumPartitions(), model.itemFactors.rdd.getNumPartitions()
    for b in range(users):  # ALS deals ids to blocks by their remainder
        mine = [i for u, i, _ in rows if u % users == b]
        assert len(mine) * rating <= room and len(set(mine)) * factor <= 1.25 * room  # so few are dealt unevenly
    for b in range(items):
        assert sum(i % items == b for _, i, _ in rows) * rating <= room
    assert items < users  # 80 users' factors fit one task, 300 items' do not
    got = ml.mse(model.transform(ratings), "rating", "prediction").first()
    assert got["rows"] == len(rows) and got["mse"] < 0.1
    fixed = ml.als_fit(ratings, rank=4, max_iter=1, num_blocks=3)
    assert fixed.userFactors.rdd.getNumPartitions() == fixed.itemFactors.rdd.getNumPartitions() == 3
    ratings.unpersist()


def test_fpgrowth_fixture(spark):
    b = readers.parse_basket(spark.createDataFrame([(x,) for x in BASKETS], "value string"))
    fi = ml.frequent_itemsets(b, 0.3, num_partitions=2)
    got = {frozenset(r["items"]): r["freq"] for r in fi.collect()}
    sets, names = [set(x.split()) for x in BASKETS], sorted({w for x in BASKETS for w in x.split()})
    want = {frozenset(c): n for k in range(1, 5) for c in combinations(names, k)
            if (n := sum(set(c) <= s for s in sets)) >= 2}
    assert got == want


def test_gradient_descent_beyond_the_gram_limit(spark):
    df = spark.createDataFrame([(float(x), float(x % 3), 2.0 * x - (x % 3)) for x in range(1, 21)], "a double, b double, y double")
    by_gram = ml.linreg_gd(df, ["a", "b"], "y", iters=5, step=1e-3)
    by_round = ml.linreg_gd(df, ["a", "b"], "y", iters=5, step=1e-3, gram_limit=1)
    assert all(abs(p - q) < 1e-9 for p, q in zip(by_gram, by_round))


def test_large_ids_get_int_indexes(spark):
    rows = [(u * 10**12, i * 10**11, float(u + i)) for u in range(1, 5) for i in range(1, 4)]
    got = ml.with_int_ids(spark.createDataFrame(rows, "user bigint, item bigint, rating double")).collect()
    assert {(r["user"], r["user_id"]) for r in got} == {(u * 10**12, u - 1) for u in range(1, 5)}
    assert {(r["item"], r["item_id"]) for r in got} == {(i * 10**11, i - 1) for i in range(1, 4)} and len(got) == 12


def test_tree_and_error_rate(spark):
    rows = [(float(i % 2), float(i % 2) * 10 + (i % 7) * 0.1) for i in range(200)]
    df = spark.createDataFrame(rows, "label double, x double").withColumn(
        "features", ml.as_vector(F.array("x"))).withColumn("id", F.monotonically_increasing_id())
    train, test = ml.hash_split(df, ["id"], 7)
    model = ml.tree_fit(train)
    e = ml.error_rate(model.transform(test)).first()
    assert e["error_rate"] == 0.0 and e["rows"] + train.count() == 200


def test_linear_regression_exact_and_gd(spark):
    df = spark.createDataFrame([(float(x), 3.0 * x) for x in range(1, 51)], "x double, y double")
    pts = df.select(F.col("y").alias("label"), ml.as_vector(F.array("x")).alias("features"))
    model = ml.linreg_fit(pts)
    assert math.isclose(model.coefficients[0], 3.0, rel_tol=1e-9)
    assert ml.mse(model.transform(pts), "label", "prediction").first()["mse"] < 1e-12
    w = ml.linreg_gd(df, "x", "y", iters=100, step=1e-3)
    assert abs(w - 3.0) < 1e-3


SMALL = "/root/testdata/sf0.001"


def test_kmeans_centers_are_the_means_of_their_points(spark):
    pts = q._points(spark, SMALL)
    model = ml.kmeans_fit(pts, k=2, max_iter=100, seed=1)
    rows = model.transform(pts).select(vector_to_array("features").alias("x"), "cluster").collect()
    x, cluster = np.array([r["x"] for r in rows]), np.array([r["cluster"] for r in rows])
    centers = np.array([list(c) for c in model.clusterCenters()])
    far = ((x[:, None] - centers[None]) ** 2).sum(axis=2)
    assert (far[np.arange(len(x)), cluster] <= far.min(axis=1) + 1e-9).all()
    for k in range(2):  # within the fit's tolerance of a fixed point
        assert np.abs(x[cluster == k].mean(axis=0) - centers[k]).max() < 2e-2
    assert ml.kmeans_cost(model, pts).first()[0] == pytest.approx(far.min(axis=1).sum(), rel=1e-9)


def test_tree_splits_its_root_best_and_error_is_counted(spark):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 20, (300, 3)).astype(float)
    y = ((x[:, 1] > 11) ^ (rng.random(300) < 0.1)).astype(float)
    df = spark.createDataFrame([(float(b), *map(float, a)) for a, b in zip(x, y)], "label double, a double, b double, c double")
    df = df.withColumn("features", ml.as_vector(F.array("a", "b", "c")))
    model = ml.tree_fit(df, max_depth=1)
    root = model._java_obj.rootNode()

    def gini(part):
        return 2 * part.mean() * (1 - part.mean()) * len(part) if len(part) else 0.0

    def loss(feature, cut):
        left = x[:, feature] <= cut
        return gini(y[left]) + gini(y[~left])

    least = min(loss(f, cut) for f in range(3) for cut in np.arange(0.5, 19.5))
    feature, cut = root.split().featureIndex(), root.split().threshold()
    assert loss(feature, cut) == pytest.approx(least)
    left = x[:, feature] <= cut
    guess = np.where(left, y[left].mean() > 0.5, y[~left].mean() > 0.5)
    got = ml.error_rate(model.transform(df)).first()
    assert got["rows"] == 300 and got["error_rate"] == pytest.approx((guess != y).mean())


def test_als_factors_solve_their_least_squares(spark):
    """The last half step solves every user's ridge system for the item factors,
    and the score is the mean squared error of the factors' products."""
    reg, rank = 0.05, 6
    ratings = ml.with_int_ids(q._ratings(spark, SMALL)).cache()
    model = ml.als_fit(ratings, rank=rank, max_iter=5, reg=reg, seed=0, user="user_id", item="item_id")
    users = {r["id"]: np.array(r["features"]) for r in model.userFactors.collect()}
    items = {r["id"]: np.array(r["features"]) for r in model.itemFactors.collect()}
    rows = ratings.select("user_id", "item_id", "rating").collect()
    mine: dict = {}
    for u, i, r in rows:
        mine.setdefault(u, []).append((i, r))
    assert set(mine) == set(users)
    for u, rated in mine.items():
        v, r = np.array([items[i] for i, _ in rated]), np.array([x for _, x in rated])
        want = np.linalg.solve(v.T @ v + reg * len(rated) * np.eye(rank), v.T @ r)
        assert np.allclose(users[u], want, rtol=1e-2, atol=1e-2 * max(1.0, np.abs(want).max()))
    mse = np.mean([(r - users[u] @ items[i]) ** 2 for u, i, r in rows])
    predicted = model.transform(ratings).select("user", "item", "prediction")
    got = ml.mse(ml.score_against(ratings, predicted), "rating", "prediction").first()
    assert got["rows"] == len(rows) and got["mse"] == pytest.approx(mse, rel=1e-3)

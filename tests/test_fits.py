"""Fits by aggregation against the plain algorithms, and Spark ML's."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from quarry.operators import features as FE
from quarry.operators import fits as FT


def _blobs(spark, n=300, k=3, seed=5):
    rng = random.Random(seed)
    rows = [(i, f"c{i % k}", rng.gauss((i % k) * 4, 1.0), rng.gauss(-(i % k) * 3, 1.0), rng.random()) for i in range(n)]
    return rows, spark.createDataFrame(rows + [(9000, None, 1.0, 1.0, 0.5), (9001, "c0", None, 0.0, 0.1)],
                                       "row_id long, y string, a double, b double, noise double").repartition(5)


def test_tree_splits_where_the_impurity_is_least(spark):
    rows, df = _blobs(spark)
    rows = rows + [(9001, "c0", None, 0.0, 0.1)]
    tree = FT.histogram_tree(df, ["a", "b", "noise"], "y", depth=2, bins=8)

    def bins(r):
        x = [r[2], r[3], r[4]]
        return [0 if v is None else int(min(max((v - lo) // w, 0), 7)) for v, lo, w in zip(x, tree.low, tree.width)]

    def gini(part):
        return len(part) - sum(part.count(c) ** 2 for c in set(part)) / len(part) if part else 0

    def best(part):
        found = []
        for f in range(3):
            for cut in range(7):
                left, right = ([r[1] for r in part if (bins(r)[f] > cut) == side] for side in (False, True))
                if left and right:
                    found.append((round(gini(left) + gini(right), 9), f, cut))
        return min(found)[1:]

    assert tree.splits[1] == best(rows)
    for side in (0, 1):
        f, cut = tree.splits[1]
        part = [r for r in rows if (bins(r)[f] > cut) == bool(side)]
        if 2 + side in tree.splits:
            assert tree.splits[2 + side] == best(part)
    got = df.filter("y is not null").select("y", tree.predict().alias("p"))
    assert got.filter("y = p").count() > 0.9 * len(rows)
    again = FT.histogram_tree(df.repartition(2), ["a", "b", "noise"], "y", depth=2, bins=8)
    assert again == tree


def test_tree_edges(spark):
    none = spark.createDataFrame([], "a double, y string")
    tree = FT.histogram_tree(none, ["a"], "y")
    assert tree.splits == {} and spark.range(1).select(F.lit(1.0).alias("a")).select(tree.predict().alias("p")).first().p is None
    flat = spark.createDataFrame([(1.0, "x"), (1.0, "y"), (1.0, "y")], "a double, y string")
    assert FT.histogram_tree(flat, ["a"], "y").labels == {1: "y"}


def test_forest_votes(spark):
    rows, df = _blobs(spark)
    forest = FT.histogram_forest(df, ["a", "b", "noise"], "y", F.col("row_id"), trees=7, depth=3, bins=8)
    p = FT.vote(forest, ["c0", "c1", "c2"])
    assert df.filter("y is not null").filter(p == F.col("y")).count() > 0.85 * len(rows)


def test_lloyd_equals_the_plain_loop(spark):
    rows, df = _blobs(spark)
    seeds = FT.hash_seeds(df.filter("a is not null"), ["a", "b"], "row_id", 3)
    x = np.array([r[2:4] for r in rows] + [(1.0, 1.0)])
    c = np.array(seeds)
    for _ in range(5):
        at = ((x[:, None] - c[None]) ** 2).sum(2).argmin(1)
        c = np.array([x[at == j].mean(0) if (at == j).any() else c[j] for j in range(3)])
    assert np.allclose(FT.lloyd_kmeans(df, ["a", "b"], seeds, 5), c, atol=1e-9)
    good = FT.lloyd_kmeans(df, ["a", "b"], FT.parallel_seeds(df.filter("a is not null"), ["a", "b"], "row_id", 3), 10)
    assert sorted(round(v[0] / 4) for v in good) == [0, 1, 2]


def test_em_equals_the_plain_loop(spark):
    rows, df = _blobs(spark)
    x = np.array([r[2:4] for r in rows] + [(1.0, 1.0)])
    seeds = [[0.0, 0.0], [4.0, -3.0], [8.0, -6.0]]
    w, m, v = np.full(3, 1 / 3), np.array(seeds), np.tile(x.var(0), (3, 1))
    for _ in range(4):
        log = np.log(w) - 0.5 * (np.log(2 * np.pi * v).sum(1) + ((x[:, None] - m) ** 2 / v).sum(2))
        r = np.exp(log - log.max(1, keepdims=True))
        r /= r.sum(1, keepdims=True)
        n = r.sum(0)
        m = (r.T @ x) / n[:, None]
        v = (r.T @ (x * x)) / n[:, None] - m ** 2
        w = n / len(x)
    got = FT.gaussian_em(df, ["a", "b"], seeds, 4)
    for a, b in zip(got, (w, m, v)):
        assert np.allclose(a, b, atol=1e-8)


def test_newton_equals_spark_ml(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        a, b = rng.gauss(0, 1), rng.gauss(1, 2)
        rows.append((a, b, float(rng.random() < 1 / (1 + np.exp(-(0.4 + 1.1 * a - 0.6 * b))))))
    df = spark.createDataFrame(rows, "a double, b double, label double").repartition(4)
    ml = LogisticRegression(tol=1e-12, maxIter=200).fit(FE.assembler(["a", "b"]).transform(df))
    got = FT.newton_logistic(df, ["a", "b"], "label")
    assert got == pytest.approx([ml.intercept, *ml.coefficients.toArray()], abs=1e-6)
    _, blobs = _blobs(spark)
    fits = FT.softmax_classes(blobs, ["a", "b"], "y", ridge=1.0)
    assert sorted(fits) == ["c0", "c1", "c2"] and fits["c2"][1] > 0 > fits["c0"][1]

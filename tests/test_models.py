"""Estimators: shape and quality floors (values depend on the optimiser)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from quarry.operators import evaluate as EV
from quarry.operators import features as FE
from quarry.operators import models as ML


def _blobs(spark, n=60, k=3):
    random.seed(11)
    rows = [(i * k + c, float(c), random.gauss(c * 4, 0.7), random.gauss(-c * 3, 0.7))
            for i in range(n) for c in range(k)]
    return spark.createDataFrame(rows, "row_id long, label double, a double, b double")


@pytest.mark.parametrize("make", [ML.logistic, ML.decision_tree, ML.random_forest])
def test_classifiers_quality_floor(spark, make):
    df = _blobs(spark)
    sp = FE.hash_split(df, F.col("row_id"))
    _, pred = ML.fit_score([FE.assembler(["a", "b"]), make()], sp["train"], sp["test"])
    m = EV.accuracy_f1(pred).first()
    assert m.accuracy > 0.9 and m.f1 > 0.9


def test_naive_bayes_and_unseen_category(spark):
    rows = [(1.0 if i % 2 else 0.0, float(i % 2), float(1 - i % 2), "x" if i < 50 else "y") for i in range(100)]
    df = spark.createDataFrame(rows, "label double, f1 double, f2 double, cat string")
    stages = [FE.string_indexer("cat", "cat_idx"), FE.assembler(["f1", "f2", "cat_idx"]), ML.naive_bayes()]
    model = ML.fit_stages(stages, df.filter("cat = 'x'"))
    scored = model.transform(df)                       # 'y' unseen in training: kept, not an error
    assert scored.count() == 100
    assert EV.accuracy_f1(scored).first().accuracy == 1.0


def test_clusterings(spark):
    df = FE.assembler(["a", "b"]).transform(_blobs(spark))
    km = ML.kmeans(3).fit(df).transform(df)
    assert km.select("prediction").distinct().count() == 3
    assert EV.silhouette(km).first().silhouette > 0.7
    gm = ML.gaussian_mixture(3).fit(df)
    assert gm.transform(df).count() == df.count()
    assert math.isfinite(gm.summary.logLikelihood)
    assert gm.transform(df).select("prediction").distinct().count() <= 3


def test_ols_matches_closed_form(spark):
    rows = [(float(x), 3.0 * x + 7.0 + (0.5 if x % 3 else -1.0)) for x in range(200)]
    df = spark.createDataFrame(rows, "x double, y double")
    lr = ML.fit_stages([FE.assembler(["x"]), ML.linear_regression(label="y")], df).stages[-1]
    c = df.agg(F.regr_slope("y", "x").alias("b"), F.regr_intercept("y", "x").alias("a")).first()
    assert lr.coefficients[0] == pytest.approx(c.b, rel=1e-9) and lr.intercept == pytest.approx(c.a, rel=1e-9)


def test_trees_derive_their_rows_once(spark):
    """One pass counts the indexed columns, one stores label and features;
    the forest is the one that the plain chain of stages fits."""
    from pyspark.ml import Pipeline
    read = spark.sparkContext.accumulator(0)

    def row(i):
        read.add(1)
        return f"c{i % 3}", None if i % 11 == 0 else f"a{i % 4}", f"b{i % 5}", float((i * 37) % 101)

    df = spark.createDataFrame(spark.sparkContext.parallelize(range(600), 3).map(row), "y string, a string, b string, x double")
    stages = lambda: [FE.string_indexer("y", "label"), *FE.index_strings_then_assemble(df, ["x", "a", "b"]),
                      ML.random_forest(num_trees=5)]
    model = ML.fit_stages(stages(), df)
    assert read.value == 2 * 600
    assert model.stages[-1].toDebugString.split("\n", 1)[1] == Pipeline(stages=stages()).fit(df).stages[-1].toDebugString.split("\n", 1)[1]


def test_indexers_are_joined_only_where_they_are_alike():
    s = [FE.string_indexer("a", "i"), FE.string_indexer("b", "j"), FE.string_indexer("i", "k"),
         FE.string_indexer("c", "l", "error"), FE.assembler(["i"])]
    got = ML.counted_together(s)
    assert len(got) == 4 and got[0].getInputCols() == ["a", "b"] and got[0].getOutputCols() == ["i", "j"] and got[1:] == s[2:]

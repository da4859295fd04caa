"""Evaluators against Spark ML's evaluators and brute force."""

import random

import pytest
from pyspark.ml.evaluation import (BinaryClassificationEvaluator, ClusteringEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from quarry.operators import evaluate as EV
from quarry.operators import features as FE


def test_accuracy_f1_matches_spark(spark):
    random.seed(3)
    rows = [(float(random.randint(0, 3)), float(random.randint(0, 4))) for _ in range(300)]
    df = spark.createDataFrame(rows, "label double, prediction double")   # class 4 never a label
    m = EV.accuracy_f1(df).first()
    ev = MulticlassClassificationEvaluator()
    assert m.accuracy == pytest.approx(ev.setMetricName("accuracy").evaluate(df), abs=1e-12)
    assert m.f1 == pytest.approx(ev.setMetricName("f1").evaluate(df), abs=1e-12)


def test_auc_pr_match_spark_and_brute_force(spark):
    random.seed(5)
    rows = [(float(random.random() < 0.4), float(random.randint(0, 30)) / 30) for _ in range(400)]
    df = spark.createDataFrame(rows, "label double, score double")
    auc = EV.area_under_roc(df).first().auc
    pos = [s for l, s in rows if l == 1]
    neg = [s for l, s in rows if l == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert auc == pytest.approx(brute, abs=1e-12)
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label")
    assert auc == pytest.approx(ev.evaluate(df), abs=1e-12)
    pr = EV.area_under_pr(df).first().aupr
    assert pr == pytest.approx(ev.setMetricName("areaUnderPR").evaluate(df), abs=1e-12)


def test_all_scores_equal(spark):
    df = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5), (1.0, 0.5)], "label double, score double")
    assert EV.area_under_roc(df).first().auc == pytest.approx(0.5)


def test_silhouette_matches_spark(spark):
    random.seed(7)
    rows = [(random.gauss(c * 3, 1), random.gauss(-c, 1), c) for c in range(3) for _ in range(40)]
    rows.append((50.0, 50.0, 3))                          # a cluster with one member
    df = spark.createDataFrame(rows, "a double, b double, prediction int")
    vec = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    ours = EV.silhouette(vec).first().silhouette
    assert ours == pytest.approx(ClusteringEvaluator().evaluate(vec), abs=1e-9)


def test_regression_metrics(spark):
    rows = [(float(i), float(i) + (0.5 if i % 2 else -0.5)) for i in range(50)]
    df = spark.createDataFrame(rows, "label double, prediction double")
    m = EV.regression_metrics(df).first()
    ev = RegressionEvaluator()
    assert m.rmse == pytest.approx(ev.setMetricName("rmse").evaluate(df), abs=1e-12)
    assert m.r2 == pytest.approx(ev.setMetricName("r2").evaluate(df), abs=1e-12)
    perfect = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0)], "label double, prediction double")
    assert EV.regression_metrics(perfect).first().r2 == 1.0


def test_standardize_matches_scaler(spark):
    df = spark.createDataFrame([(float(i), float(i * i), 3.0) for i in range(20)], "a double, b double, c double")
    ours = FE.standardize(df, ["a", "b", "c"]).collect()
    from pyspark.ml import Pipeline
    vec = VectorAssembler(inputCols=["a", "b", "c"], outputCol="v")
    m = Pipeline(stages=[vec, FE.scaler("v", "z")]).fit(df).transform(df)
    from pyspark.ml.functions import vector_to_array
    theirs = m.select(vector_to_array("z").alias("z")).collect()
    for o, t in zip(sorted(ours, key=lambda r: r.a), sorted(theirs, key=lambda r: r.z[0])):
        assert o.a_z == pytest.approx(t.z[0]) and o.b_z == pytest.approx(t.z[1])
        assert o.c_z == 0.0                               # constant column


def test_tokenizer_twin_matches_ml(spark):
    from pyspark.ml.feature import Tokenizer
    texts = [("  Lead  space",), ("Trailing  ",), ("", ), ("Tabs\tand\nlines",), ("ÉCOLE Été",)]
    df = spark.createDataFrame(texts, "t string")
    ml = [r.w for r in Tokenizer(inputCol="t", outputCol="w").transform(df).collect()]
    ours = [r.w for r in df.select(FE.tokenize(F.col("t")).alias("w")).collect()]
    assert ml == ours


def test_keyword_modes(spark):
    df = spark.createDataFrame([("senior javascript developer",), ("apple picker",)], "clean_title string")
    sub = FE.keyword_flags(df).collect()
    tok = FE.keyword_flags(df, mode="token").collect()
    assert sub[0].has_java == 1 and tok[0].has_java == 0 and tok[0].has_javascript == 1
    assert sub[1].has_app == 1 and tok[1].has_app == 0


def test_hash_split_deterministic(spark):
    df = spark.range(0, 5000)
    a = FE.hash_split(df, F.col("id"))["train"]
    b = FE.hash_split(df.repartition(7), F.col("id"))["train"]
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    assert 0.67 < a.count() / 5000 < 0.73


def test_cumulative_sums(spark):
    from quarry.operators.ordered import cumulative_sums
    df = spark.range(0, 3000).select((F.col("id") * 7 % 3000).alias("k"), F.lit(1).alias("one"))
    rows = sorted((r.k, r.cum_one) for r in cumulative_sums(df, [F.col("k").asc()], ["one"]).collect())
    assert rows == [(k, k + 1) for k in range(3000)]


def _murmur3(data: bytes, seed: int = 42) -> int:
    """MurmurHash3 x86 32-bit, as a signed number."""
    def rot(x, r):
        return (x << r | x >> 32 - r) & 0xFFFFFFFF

    h = seed
    whole = len(data) // 4 * 4
    for i in range(0, whole, 4):
        h = rot(h ^ rot(int.from_bytes(data[i:i + 4], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF, 13)
        h = h * 5 + 0xE6546B64 & 0xFFFFFFFF
    if data[whole:]:
        h ^= rot(int.from_bytes(data[whole:], "little") * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
    h ^= len(data)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35), (16, 1)):
        h = (h ^ h >> shift) * factor & 0xFFFFFFFF
    return h - (1 << 32) if h >> 31 else h


def test_hashed_terms_fall_into_their_buckets(spark):
    from collections import Counter

    from pyspark.ml.feature import HashingTF
    words = ["java", "sql", "java", "é", "data", "a", "scientist", "日本"]
    df = spark.createDataFrame([(words,)], "words array<string>")
    v = HashingTF(inputCol="words", outputCol="tf", numFeatures=1000).transform(df).first().tf
    want = Counter(_murmur3(w.encode()) % 1000 for w in words)
    assert dict(zip(map(int, v.indices), v.values)) == dict(want)

"""Exact heavy hitters against a full count; what the counters rule out."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators.heavy_hitters import counters, survivors, top_values

from conftest import SF_SMALL


def _want(values, k):
    return sorted(Counter(values).items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))[:k]


def _got(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("k,buckets,lead", [(1, 64, None), (5, 16, 2), (7, 1, None), (500, 64, None)])
def test_equals_a_full_count(spark, k, buckets, lead):
    rnd = random.Random(k)
    values = ["hot"] * 700 + [None] * 90 + [f"v{int(rnd.paretovariate(0.8)) % 300}" for _ in range(1500)]
    df = spark.createDataFrame([(v, 1) for v in values], "v string, count int").repartition(5)
    assert _got(top_values(df, "v", k, buckets=buckets, lead=lead)) == _want(values, k)


def test_flat_values_and_ties(spark):
    df = spark.range(400).select((F.col("id") % 100).alias("v"))
    assert _got(top_values(df, "v", 10, buckets=32)) == [(i, 4) for i in range(10)]


def test_zeros_and_nans_are_one_value(spark):
    nan = float("nan")
    df = spark.createDataFrame([(x,) for x in [0.0, -0.0] * 5 + [nan] * 7 + [1.0] * 8], "v double")
    got = _got(top_values(df, "v", 3, buckets=1 << 10))
    assert [n for _, n in got] == [10, 8, 7] and got[0][0] == 0.0 and got[1][0] == 1.0


def test_empty_and_all_null(spark):
    empty = spark.createDataFrame([], "v string")
    assert _got(top_values(empty, "v", 3)) == []
    assert _got(top_values(spark.createDataFrame([(None,)] * 3, "v string"), "v", 3)) == [(None, 3)]
    with pytest.raises(ValueError):
        top_values(empty, "v", 0)


def test_counters_rule_out_the_rare_values(spark):
    df = spark.range(60000).select(F.when(F.col("id") % 3 == 0, F.col("id") % 5).otherwise(F.col("id") + 10).alias("v"))
    sketch = counters(df, "v", 3, 1 << 12)
    assert sketch.agg(F.sum("n")).first()[0] == 3 * 60000
    kept = sketch.filter("n >= 4000").select("table", "bucket")
    assert survivors(df, "v", kept, 3, 1 << 12).distinct().count() == 5
    assert _got(top_values(df, "v", 5, buckets=1 << 12)) == [(i, 4000) for i in range(5)]


def test_counters_of_loads_add_up(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").select("l_partkey", "l_orderkey")
    whole = counters(li, "l_partkey", 2, 64)
    halves = counters(li.filter("l_orderkey % 2 = 0"), "l_partkey", 2, 64).unionByName(counters(li.filter("l_orderkey % 2 = 1"), "l_partkey", 2, 64))
    assert whole.exceptAll(halves.groupBy("table", "bucket").agg(F.sum("n").alias("n"))).isEmpty()

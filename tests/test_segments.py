"""Segment summaries against runs over the whole log."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quarry.operators import runs as R
from quarry.operators import segments as SG

SCHEMA = "k string, t timestamp_ntz, state string"


def _log(spark, seed, n=600):
    rng = random.Random(seed)
    at = [datetime(2024, 1, 1) + timedelta(hours=rng.randint(0, 24 * 9)) for _ in range(n)]
    keys = [rng.choice(["hot"] * 6 + ["a", "b", None, "never"]) for _ in range(n)]
    return spark.createDataFrame(
        [(k, t, "whole" if k == "never" else rng.choice(["broken"] * 4 + ["whole", None])) for k, t in zip(keys, at)]
        + [("hot", None, "broken"), ("blank", datetime(2024, 1, 2), None)], SCHEMA)


HIT = "state = 'broken'"


def _rows(df):
    return sorted((tuple(r) for r in df.select("k", "grp", "run_id", "streak_len", "start_t", "end_t").collect()), key=str)


def _want(df):
    return _rows(R.longest_streaks(df, "k", "t", F.expr(HIT))["per_key"])


def test_summaries_equal_the_whole_log(spark):
    for seed in range(3):
        df = _log(spark, seed)
        s = SG.summarize(df, "k", "t", F.expr(HIT), F.to_date("t")).cache()
        assert s.count() > 30
        assert _rows(SG.longest_from_summaries(s, "k")) == _want(df)
        two = SG.merge_summaries(s, "k", F.date_trunc("week", "segment")).cache()
        assert two.groupBy("k", "segment").count().filter("count > 1").count() == 0
        assert _rows(SG.longest_from_summaries(two, "k")) == _want(df)
        one = SG.merge_summaries(two, "k", F.lit(0))
        assert _rows(SG.longest_from_summaries(one, "k")) == _want(df)


def test_days_are_added_and_replaced(spark, tmp):
    df = _log(spark, 9).filter("t IS NOT NULL")
    log = SG.StreakLog(f"{tmp}/s", "k", "t", F.expr(HIT), F.to_date("t"))
    early, late = df.filter("t < '2024-01-05'"), df.filter("t >= '2024-01-05'")
    log.add(early)
    assert _rows(log.longest(spark)) == _want(early)
    log.add(late.filter(F.hour("t") < 12))
    log.add(late)                                            # the same days again, now whole
    assert _rows(log.longest(spark)) == _want(df)
    assert sorted(r.k for r in log.keys_without_runs(spark).collect()) == ["blank", "never"]


def test_empty_log(spark):
    s = SG.summarize(spark.createDataFrame([], SCHEMA), "k", "t", F.expr(HIT), F.to_date("t"))
    assert SG.longest_from_summaries(SG.merge_summaries(s, "k", F.lit(0)), "k").collect() == []

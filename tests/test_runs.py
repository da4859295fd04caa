"""Streaks: micro-fixtures against a brute-force reference implementation."""

import itertools
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quarry.operators import runs as R

SCHEMA = "video_file string, t_sec double, state string"


def brute(rows):
    """Straight transcription of the semantics: per key, sort by time; the
    miss counter over peers (equal time) includes all peers."""
    out = []
    rows = [r for r in rows]
    for key, grp in itertools.groupby(sorted(rows, key=lambda r: (r[0] is None, r[0] or "")), key=lambda r: r[0]):
        g = sorted(grp, key=lambda r: (r[1] is not None, r[1] or 0.0))
        runs = {}
        for r in g:
            peers = [p for p in g if p[1] == r[1]] if r[1] is not None else [p for p in g if p[1] is None]
            upto = [p for p in g if (p[1] is None) or (r[1] is not None and p[1] <= r[1])] \
                if r[1] is not None else peers
            misses = [0 if p[2] == "broken" else 1 for p in upto if p[2] is not None]
            if r[2] != "broken":
                continue
            mc = sum(misses) if misses else None
            runs.setdefault(mc, []).append(r[1])
        for mc, ts in runs.items():
            present = [t for t in ts if t is not None]          # SQL min/max skip NULLs
            out.append((key, mc, len(ts), min(present) if present else None,
                        max(present) if present else None))
    return sorted(out, key=lambda x: (x[0] or "", -1 if x[1] is None else x[1]))


CASES = {
    "leading_hits": [("v", 0.0, "broken"), ("v", 1.0, "broken"), ("v", 2.0, "whole"), ("v", 3.0, "broken")],
    "leading_misses": [("v", 0.0, "whole"), ("v", 1.0, "whole"), ("v", 2.0, "broken"), ("v", 3.0, "broken")],
    "all_hit": [("v", float(i), "broken") for i in range(5)],
    "all_miss": [("v", float(i), "whole") for i in range(5)],
    "null_state_middle": [("v", 0.0, "broken"), ("v", 1.0, None), ("v", 2.0, "broken"), ("v", 3.0, "unknown")],
    "time_tie": [("v", 0.0, "broken"), ("v", 1.0, "broken"), ("v", 1.0, "whole"), ("v", 2.0, "broken")],
    "two_equal_longest": [("v", 0.0, "broken"), ("v", 1.0, "broken"), ("v", 2.0, "whole"),
                          ("v", 3.0, "broken"), ("v", 4.0, "broken")],
    "single_row": [("v", 0.0, "broken")],
    "two_keys": [("a", 0.0, "broken"), ("b", 0.0, "whole"), ("b", 1.0, "broken"), ("a", 1.0, "whole")],
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_runs_match_brute_force(spark, name):
    rows = CASES[name]
    df = spark.createDataFrame(rows, SCHEMA)
    got = R.streak_runs(df, "video_file", "t_sec", F.col("state") == "broken")
    got = sorted((r.video_file, r.run_id, r.streak_len, r.start_t, r.end_t) for r in got.collect())
    assert got == brute(rows)


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    rep = R.longest_streaks(df)
    assert rep["runs"].count() == 0 and rep["per_key"].count() == 0 and rep["topn"].count() == 0


def test_per_key_tie_break_earliest_start(spark):
    df = spark.createDataFrame(CASES["two_equal_longest"], SCHEMA)
    best = R.longest_streaks(df)["per_key"].collect()
    assert len(best) == 1 and best[0].streak_len == 2 and best[0].start_t == 0.0


def test_runs_cross_bucket_boundaries(spark):
    """Tiny buckets force every run across many (key, bucket) slices: the
    offsets must stitch the running count back together."""
    base = datetime(2024, 1, 1)
    pattern = "HHHMHHMMHHHHHMH"
    rows = [(1, base + timedelta(hours=i), "broken" if c == "H" else "whole") for i, c in enumerate(pattern)]
    rows += [(2, base + timedelta(hours=i), "broken") for i in range(7)]
    df = spark.createDataFrame(rows, "user_id long, ts timestamp_ntz, state string")
    hit = F.col("state") == "broken"
    coarse = R.streak_runs(df, "user_id", "ts", hit, bucket=F.lit(0))
    fine = R.streak_runs(df, "user_id", "ts", hit, bucket=F.date_trunc("hour", F.col("ts")))
    a = sorted(tuple(r) for r in coarse.collect())
    b = sorted(tuple(r) for r in fine.collect())
    assert a == b
    lens = sorted(r.streak_len for r in fine.filter("user_id = 1").collect())
    assert lens == [1, 2, 3, 5]


def test_invariant_under_repartition(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hit = F.col("event_type") == "click"
    ref = sorted(tuple(r) for r in R.streak_runs(df, "user_id", "ts", hit).collect())
    for n in (1, 4, 7):
        got = sorted(tuple(r) for r in R.streak_runs(df.repartition(n), "user_id", "ts", hit).collect())
        assert got == ref


def test_topn_total_order(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    runs = R.streak_runs(df, "user_id", "ts", F.col("event_type") == "click")
    top = [tuple(r) for r in R.top_n_runs(runs, "user_id", 10).collect()]
    full = sorted((tuple(r) for r in runs.collect()), key=lambda r: (-r[3], r[0], r[4], r[2]))[:10]
    assert top == full


def test_plan_has_no_single_key_window(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    runs = R.streak_runs(df, "user_id", "ts", F.col("event_type") == "click")
    best = R.longest_per_key(runs, "user_id")
    from quarry.plans.inspect import plan_text
    plan = plan_text(best, "simple")
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan
    # the top-1 per key is an aggregation, not a window over the key
    assert plan.count("Window [") + plan.count("Window(") <= 2 or plan.count(" Window ") <= 2


def test_hot_key_third_of_rows_matches_sql(spark, tmp_path):
    """One key holding a third of all rows: results equal a plain SQL
    window (DuckDB, in-process) and the key is split over time slices."""
    import duckdb

    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    hot = ev.select(F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
                    "ts", "event_type")
    path = str(tmp_path / "hot.parquet")
    hot.write.parquet(path)
    df = spark.read.parquet(path)
    hit = F.col("event_type") == "click"
    got = sorted(tuple(r) for r in R.streak_runs(df, "user_id", "ts", hit)
                 .select("user_id", "run_id", "streak_len", "start_t", "end_t").collect())
    want = duckdb.sql(f"""
        WITH c AS (SELECT user_id, ts, event_type = 'click' AS h,
                          SUM(CASE WHEN event_type = 'click' THEN 0 ELSE 1 END)
                              OVER (PARTITION BY user_id ORDER BY ts) AS m
                   FROM read_parquet('{path}/*.parquet'))
        SELECT user_id, m, COUNT(*), MIN(ts), MAX(ts) FROM c WHERE h GROUP BY user_id, m""").fetchall()
    assert got == sorted(tuple(r) for r in want)
    slices = df.filter("user_id = -1").select(R.default_bucket(df, "ts").alias("b")).distinct().count()
    assert df.filter("user_id = -1").count() * 3 >= df.count() - 3 and slices >= 28


@pytest.mark.parametrize("name", ["time_tie", "null_state_middle", "two_keys", "leading_misses"])
def test_row_balanced_slices_match(spark, name):
    rows = CASES[name]
    df = spark.createDataFrame(rows, SCHEMA)
    got = R.streak_runs(df, "video_file", "t_sec", F.col("state") == "broken", balance="rows")
    got = sorted((r.video_file, r.run_id, r.streak_len, r.start_t, r.end_t) for r in got.collect())
    assert got == brute(rows)


def test_row_balanced_equals_time_balanced(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    hit = F.col("event_type") == "click"
    a = sorted(tuple(r) for r in R.streak_runs(df, "user_id", "ts", hit).collect())
    spark.conf.set("spark.sql.shuffle.partitions", "37")    # many small range partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        b = sorted(tuple(r) for r in R.streak_runs(df, "user_id", "ts", hit, balance="rows").collect())
        lab = R.running_miss_count(df, "user_id", "ts", hit, balance="rows")
        assert lab.count() == df.count()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert a == b


@pytest.mark.parametrize("balance", ["time", "rows"])
def test_null_keys_and_null_times(spark, balance):
    rows = [(None, 0.0, "broken"), (None, 1.0, "broken"), (None, 2.0, "whole"), (None, 3.0, "broken"),
            ("v", None, "whole"), ("v", None, "broken"), ("v", 0.0, "broken"), ("v", 1.0, "broken"),
            ("w", 5.0, "broken")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = R.streak_runs(df, "video_file", "t_sec", F.col("state") == "broken", balance=balance)
    norm = lambda t: tuple("" if v is None else v for v in t)
    got = sorted(norm((r.video_file, r.run_id, r.streak_len, r.start_t, r.end_t)) for r in got.collect())
    want = sorted(norm(t) for t in brute(rows))
    assert got == want


def test_offsets_join_reuses_window_partitioning(spark):
    """With broadcasts off, the offsets join must consume the window's
    output directly: the events are shuffled once, not twice."""
    import re
    from quarry.plans.inspect import plan_text
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_text(R.running_miss_count(df, "user_id", "ts", F.col("event_type") == "click"), "simple")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert re.search(r"SortMergeJoin \[_k0[^\n]*\n\s*:- Window", plan), plan
    assert "hashpartitioning(coalesce(" not in plan

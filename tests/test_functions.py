"""Scalar helpers against Python's own behaviour."""

import os
import random
from datetime import datetime
from pathlib import PurePosixPath

from pyspark.sql import functions as F

from quarry.functions import expressions as X


def test_py_fixed_matches_python(spark):
    random.seed(2)
    vals = [21 / 640, 0.00625, 0.125, 2.5, 0.0, 1e-9, 123.4565, -0.015625, -1 / 3]
    vals += [random.randint(0, 10 ** 5) / random.choice([640, 480, 24, 2000, 16]) for _ in range(1500)]
    vals += [random.random() * 10 ** random.randint(-4, 4) for _ in range(1500)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    for d in (0, 2, 3, 4, 6):
        got = df.select("x", X.py_fixed("x", d).alias("t")).collect()
        bad = [(r.x, r.t) for r in got if r.t != f"{r.x:.{d}f}"]
        assert not bad, bad[:5]


def test_py_isoformat(spark):
    ts = [datetime(2024, 1, 1, 0, 0, 7), datetime(2024, 2, 29, 23, 59, 59, 123456), datetime(2024, 3, 1, 1, 2, 3, 500)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r.s for r in df.select(X.py_isoformat("ts").alias("s")).collect()]
    assert got == [t.isoformat() for t in ts]


def test_path_base_and_stem(spark):
    paths = ["/data/videos/clip01.MP4", "rel/dir/archive.tar.gz", "noext", "/trailing/", ".hidden", "a/.bashrc"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = df.select(X.path_base("p").alias("b"), X.path_stem("p").alias("s")).collect()
    assert [r.b for r in got] == [os.path.basename(p) for p in paths]
    assert [r.s for r in got] == [PurePosixPath(os.path.basename(p)).stem if os.path.basename(p) else ""
                                  for p in paths]


def test_sampling_step_half_even(spark):
    fps = [30.0, 25.0, 5.0, 1.0, 0.5, 29.97, 3.0, 7.0]
    df = spark.createDataFrame([(f,) for f in fps], "fps double")
    got = [r.s for r in df.select(X.sampling_step(F.col("fps"), 0.5).alias("s")).collect()]
    assert got == [max(1, int(round(f * 0.5))) for f in fps]


def test_hash_bucket_formula(spark):
    keys = [0, 1, 7, 12345, 10 ** 12 + 7, 2 ** 40 + 3]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r.b for r in df.select(X.hash_bucket100(F.col("k")).alias("b")).collect()]
    assert got == [((k % 2 ** 32) * 2654435761) % 2 ** 32 % 100 for k in keys]


def test_date_key_and_frame_name(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 29, 5), "clip", 7)], "t timestamp_ntz, s string, i int")
    r = df.select(X.date_key("t").alias("k"), X.frame_name(F.col("s"), F.col("i")).alias("n")).first()
    assert r.k == 20240229 and r.n == "clip_f000007"


def test_hash_bucket_of_any_integer(spark):
    keys = [0, 1, -1, 7, -12345, 2**31, 2**32 - 1, 2**32, -2**32 - 5, 2**63 - 1, -2**63, None]
    got = spark.createDataFrame([(k,) for k in keys], "k long").select("k", X.hash_bucket100(F.col("k")).alias("b")).collect()
    assert [r.b for r in got] == [None if k is None else (k % 2**32) * 2654435761 % 2**32 % 100 for k in keys]
    plan = spark.range(1).select(X.hash_bucket100(F.col("id")).alias("b"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("decimal") == plan.count("pmod") == 2  # the key mod 2^32, its halves; the rest are longs


def test_py_rounded_reads_as_the_text(spark):
    xs = [0.0, -0.0, 0.5, 2.675, -2.675, 0.125, 0.375, -0.001, 1e-9, 123456.785, 719 / 24, 1 / 3, 99.995, 0.99995, None]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for d in (0, 2, 3, 4, 6):
        for r in df.select("x", X.py_rounded("x", d).alias("r"), X.py_fixed("x", d).alias("t")).collect():
            assert repr(r.r) == repr(None if r.x is None else float(f"{r.x:.{d}f}")) or (r.x == 0 and r.r == 0)
            assert r.r is None or r.x == 0 or r.t == f"{r.x:.{d}f}"


def test_rounding_is_small_enough_to_compile(spark):
    """A method of more than 8000 bytes is interpreted by the JVM: what the
    rounding names often is compiled as often."""
    def named(c):
        plan = spark.range(1).select(F.col("id").cast("double").alias("xx")).repartition(1).select(c)
        return plan._jdf.queryExecution().optimizedPlan().toString().count("abs(xx")
    assert named(X.py_rounded("xx", 4)) <= 16 and named(X.py_fixed("xx", 4)) <= 32

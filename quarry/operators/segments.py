"""Streaks over a growing log, by mergeable summaries of its segments.

A segment is a slice of a key's history. Its summary holds the number of
misses, the hits before the first miss (``lead``), those after the last one
(``trail``), and the best run between two misses, each as (length, start,
end). Runs are numbered by the misses before them, so with the misses of all
earlier segments as offset every piece has its place in the whole history:
a trail and the lead of the next segment get the same run number, and adding
up pieces by (key, run) joins runs over any number of segments. The merge is
associative, and its result is a summary again.

A new day thus costs one pass over that day; the history is only read as
summaries, a few numbers per key and segment, never sorted again.

Semantics are those of ``quarry.operators.runs`` (time peers share the misses
of all of them, a NULL state neither extends nor breaks a run).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.operators.joins import join_null_safe
from quarry.operators.runs import longest_per_key
from quarry.session import materialize
from quarry.sinks.files import write_partitioned

#: A summary's columns besides key, segment and part.
SUMMARY = ["misses", "lead", "trail", "best"]


def _piece(n: Column, start: Column, end: Column) -> Column:
    return F.struct(n.alias("n"), start.alias("start"), end.alias("end"))


def summarize(df: DataFrame, key: str, order: str, hit: Column, segment: Column) -> DataFrame:
    """(key, segment, part, misses, lead, trail, best): a row per key,
    segment and part of it. ``segment`` is a function of the time that grows
    with it (say the day). Rows are range-sorted by (key, time) and each
    range partition is a part, so a key that holds a third of a day is
    summarized by many tasks; equal times of a key share a part. Rows with a
    NULL time come before all others."""
    at = [F.col("k").asc_nulls_first(), F.col("t").asc_nulls_first()]
    rows = materialize(df.select(F.col(key).alias("k"), F.col(order).alias("t"), segment.alias("segment"),
                                 hit.cast("int").alias("h")).orderBy(*at))
    rows = rows.withColumn("part", F.spark_partition_id())
    group = ["k", "segment", "part"]
    so_far = F.sum(F.lit(1) - F.col("h")).over(Window.partitionBy(*group).orderBy("t"))
    # a hit among leading NULL states follows no miss
    runs = rows.select(*group, "t", "h", F.coalesce(so_far, F.lit(0)).alias("run"))
    runs = runs.groupBy(*group, "run").agg(F.sum(F.lit(1) - F.col("h")).alias("m"), F.count_if(F.col("h") == 1).alias("n"),
                                           F.min(F.when(F.col("h") == 1, F.col("t"))).alias("start"),
                                           F.max(F.when(F.col("h") == 1, F.col("t"))).alias("end"))
    out = _summary(runs.withColumn("total", F.sum("m").over(Window.partitionBy(*group))), group)
    return out.select(F.col("k").alias(key), "segment", "part", *SUMMARY)


def _summary(runs: DataFrame, group: list[str]) -> DataFrame:
    """Summaries of groups from their runs (run, n, start, end) and the
    number of misses (total) of each."""
    total = F.coalesce(F.col("total"), F.lit(0))
    some = F.col("n") > 0
    piece = _piece(F.col("n"), F.col("start"), F.col("end"))
    inner = some & (F.col("run") > 0) & (F.col("run") < total)
    best = F.min(F.when(inner, F.struct((-F.col("n")).alias("neg"), F.col("start"), F.col("run"), F.col("end"))))
    return runs.groupBy(*group).agg(
        F.max(total).cast("long").alias("misses"), F.max(F.when(some & (F.col("run") == 0), piece)).alias("lead"),
        F.max(F.when(some & (F.col("run") == total) & (total > 0), piece)).alias("trail"), best.alias("best"))


def pieces(summaries: DataFrame, key: str) -> DataFrame:
    """(key, run, n, start, end): pieces of runs, numbered over the whole
    history of a key. Its segments are put in order by one window over
    summaries, a few rows per key and day."""
    before = (Window.partitionBy(key).orderBy(F.col("segment").asc_nulls_first(), F.col("part"))
              .rowsBetween(Window.unboundedPreceding, -1))
    s = summaries.withColumn("off", F.coalesce(F.sum("misses").over(before), F.lit(0)))

    def one(name, run, n):
        return F.when(F.col(name).isNotNull(), F.struct(run.cast("long").alias("run"), n.cast("long").alias("n"),
                                                        F.col(f"{name}.start").alias("start"), F.col(f"{name}.end").alias("end")))

    three = F.array(one("lead", F.col("off"), F.col("lead.n")), one("trail", F.col("off") + F.col("misses"), F.col("trail.n")),
                    one("best", F.col("off") + F.col("best.run"), -F.col("best.neg")))
    return s.select(key, F.explode(three).alias("p")).filter("p IS NOT NULL").select(key, "p.*")


def joined_runs(summaries: DataFrame, key: str) -> DataFrame:
    """Pieces of one run added up."""
    return pieces(summaries, key).groupBy(key, "run").agg(F.sum("n").alias("n"), F.min("start").alias("start"), F.max("end").alias("end"))


def merge_summaries(summaries: DataFrame, key: str, segment: Column) -> DataFrame:
    """One summary per key and coarser ``segment`` (a function of the old
    segment that grows with it, say the month of a day): the same table as
    from the events, for any later merge."""
    s = summaries.withColumn("coarse", segment)
    wide = s.select(F.struct(key, "coarse").alias("g"), "segment", "part", *SUMMARY)
    runs = joined_runs(wide, "g")
    totals = wide.groupBy("g").agg(F.sum("misses").alias("total"))
    # groups without hits have a total only; a null key is a field of g, not a null g
    runs = totals.join(runs, "g", "left").withColumn("run", F.coalesce("run", F.lit(0))).withColumn("n", F.coalesce("n", F.lit(0)))
    out = _summary(runs, ["g"])
    return out.select(F.col(f"g.{key}").alias(key), F.col("g.coarse").alias("segment"), F.lit(0).alias("part"), *SUMMARY)


def longest_from_summaries(summaries: DataFrame, key: str) -> DataFrame:
    """Best run of every key, as ``runs.longest_per_key`` gives it."""
    runs = joined_runs(summaries, key).select(
        key, F.concat_ws("_", F.col(key).cast("string"), F.col("run").cast("string")).alias("grp"), F.col("run").alias("run_id"),
        F.col("n").alias("streak_len"), F.col("start").alias("start_t"), F.col("end").alias("end_t"))
    return longest_per_key(runs, key)


class StreakLog:
    """Stored summaries of a log that grows by whole segments: a folder per
    segment. Adding a segment again (late rows, a repeated load) replaces its
    folder, so a load can be repeated."""

    def __init__(self, root: str, key: str, order: str, hit: Column, segment: Column):
        self.path, self.key, self.order, self.hit, self.segment = root.rstrip("/"), key, order, hit, segment

    def add(self, events: DataFrame) -> None:
        """Summarize whole segments and store them."""
        s = summarize(events, self.key, self.order, self.hit, self.segment)
        write_partitioned(s.withColumn("folder", F.coalesce(F.col("segment").cast("string"), F.lit("none"))), self.path, ("folder",),
                          dynamic_overwrite=True)

    def summaries(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).drop("folder")

    def longest(self, spark: SparkSession) -> DataFrame:
        return longest_from_summaries(self.summaries(spark), self.key)

    def keys_without_runs(self, spark: SparkSession) -> DataFrame:
        """Keys whose whole history has no hit."""
        s = self.summaries(spark)
        return join_null_safe(s.select(self.key).distinct(), self.longest(spark).select(self.key), [self.key], "left_anti")

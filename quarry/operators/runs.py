"""Runs in ordered event logs: running counts, gaps-and-islands run ids,
longest streak per key and global top-N.

Semantics (fixed by the event-log job this library rebuilds):

* ``hit`` is a nullable boolean; ``miss = 1 - hit`` (NULL stays NULL).
* ``miss_cum`` is the running sum of ``miss`` per key ordered by time with
  the default RANGE frame: rows with the same time are peers and share the
  value; NULLs are skipped; all-NULL prefixes give NULL.
* every hit row belongs to run ``(key, miss_cum)``; a NULL state neither
  extends nor breaks a run.
* a run's start is ``min(time)`` and the best run of a key is the longest,
  ties to the earliest start.

Scale design. A plain ``Window.partitionBy(key)`` moves every row of a key
into one task, so one hot key (say a third of all rows) would serialize
the job. Here the running sum is split in two:

1. a local running sum inside ``(key, slice)`` where a slice is a range
   partition of a global sort (``balance="rows"``, the default) or a coarse
   time bucket (``balance="time"``); peers always share a slice, so RANGE semantics
   hold;
2. per-bucket totals (a partial aggregation, tiny), turned into offsets by
   a window over buckets of one key (rows = buckets, not events), joined
   back on ``(key, bucket)`` — Spark/AQE broadcasts it when it is small
   and otherwise runs a skew-aware shuffle join.

Run statistics are ordinary partial aggregations and the top-1 per key is
a ``min(struct)`` aggregation rather than a per-key window, so no step
needs all rows of one key in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, NumericType, StringType, TimestampNTZType,
                               TimestampType)


def default_bucket(df: DataFrame, order_col: str) -> Column:
    """Day slices for timestamps, 1 000-unit slices for numeric times."""
    dtype = df.schema[order_col].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.date_trunc("day", F.col(order_col))
    if isinstance(dtype, NumericType):
        return F.floor(F.col(order_col) / F.lit(1000))
    raise TypeError(f"cannot bucket order column of type {dtype}")


def _filled(c: Column, dtype) -> Column:
    """``c`` with NULL replaced by a value of its type; paired with an
    ``isNull`` flag it is a non-null, collision-free join key."""
    if isinstance(dtype, NumericType):
        fill = F.lit(0).cast(dtype)
    elif isinstance(dtype, StringType):
        fill = F.lit("")
    elif isinstance(dtype, BooleanType):
        fill = F.lit(False)
    elif isinstance(dtype, (TimestampType, TimestampNTZType, DateType)):
        fill = F.lit("1970-01-01").cast(dtype)
    else:
        raise TypeError(f"unsupported key type {dtype}")
    return F.coalesce(c, fill)


def running_miss_count(df: DataFrame, key: str, order: str, hit: Column,
                       bucket: Column | None = None,
                       keep: list[str] | None = None, balance: str = "rows") -> DataFrame:
    """Rows of ``df`` with ``is_hit`` (int, nullable), ``miss_flag`` and
    ``miss_cum`` (running count of misses per ``key`` by ``order``).

    ``balance="rows"`` slices by row count: the narrow (key, time, flags)
    projection is range-sorted and stored, and each range partition is a
    slice, so even a hot key concentrated in one day is split evenly (equal
    (key, time) rows always share a partition, keeping RANGE peers
    together). ``balance="time"`` slices every key by ``bucket`` (default:
    day) instead: no sort and no stored copy, for logs where no (key,
    bucket) is hot."""
    keep = keep or []
    cols = [F.col(key), F.col(order), *[F.col(c) for c in keep], hit.cast("int").alias("is_hit")]
    if balance == "rows":
        from quarry.session import materialize
        ranged = materialize(df.select(*cols).orderBy(F.col(key).asc_nulls_first(), F.col(order).asc_nulls_first()))
        base = ranged.withColumn("_bucket", F.spark_partition_id())
    elif balance == "time":
        bucket = bucket if bucket is not None else default_bucket(df, order)
        base = df.select(*cols, bucket.alias("_bucket"))
    else:
        raise ValueError(balance)
    base = base.withColumn("miss_flag", (F.lit(1) - F.col("is_hit")).cast("int"))
    # non-null join keys (value + null flag): the local window is
    # partitioned by exactly these columns and the offsets join on them
    # with plain equality, so the big side's shuffle is reused by the join
    kt, bt = base.schema[key].dataType, base.schema["_bucket"].dataType
    base = base.select("*", _filled(F.col(key), kt).alias("_k0"), F.col(key).isNull().alias("_k1"),
                       _filled(F.col("_bucket"), bt).alias("_b0"), F.col("_bucket").isNull().alias("_b1"))
    slice_cols = ["_k0", "_k1", "_b0", "_b1"]

    local_w = Window.partitionBy(*slice_cols).orderBy(order)
    local = base.withColumn("_local_cum", F.sum("miss_flag").over(local_w))

    totals = base.groupBy(*slice_cols).agg(F.sum("miss_flag").alias("_tot"))
    # NULL slice first, as in an ascending order with NULLS FIRST
    prev_w = (Window.partitionBy("_k0", "_k1").orderBy(F.col("_b1").desc(), F.col("_b0").asc())
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*slice_cols, F.sum("_tot").over(prev_w).alias("_offset"))

    out = local.join(offsets, slice_cols, "inner")
    miss_cum = F.when(F.col("_local_cum").isNull() & F.col("_offset").isNull(),
                      F.lit(None).cast("long")) \
        .otherwise(F.coalesce(F.col("_local_cum"), F.lit(0)) +
                   F.coalesce(F.col("_offset"), F.lit(0))).cast("long")
    return out.select(key, order, *keep, "is_hit", "miss_flag",
                      miss_cum.alias("miss_cum"))


def streak_runs(df: DataFrame, key: str, order: str, hit: Column,
                bucket: Column | None = None, balance: str = "rows") -> DataFrame:
    """One row per run of hits: key, grp (``"<key>_<miss_cum>"``), run_id,
    streak_len, start_t, end_t."""
    labelled = running_miss_count(df, key, order, hit, bucket, balance=balance)
    return (labelled.filter(F.col("is_hit") == 1)
            .groupBy(key, "miss_cum")
            .agg(F.count(F.lit(1)).alias("streak_len"),
                 F.min(order).alias("start_t"),
                 F.max(order).alias("end_t"))
            .select(key,
                    F.concat_ws("_", F.col(key).cast("string"),
                                F.col("miss_cum").cast("string")).alias("grp"),
                    F.col("miss_cum").alias("run_id"),
                    "streak_len", "start_t", "end_t"))


def longest_per_key(runs: DataFrame, key: str) -> DataFrame:
    """Top-1 run per key: longest, then earliest start, then lowest run id.
    Computed as ``min(struct(-len, start, run_id, ...))`` — a partial
    aggregation, so a key with many runs is combined map-side."""
    best = F.min(F.struct((-F.col("streak_len")).alias("neg_len"),
                          F.col("start_t"), F.col("run_id"),
                          F.col("end_t"), F.col("grp"))).alias("b")
    return (runs.groupBy(key).agg(best)
            .select(key, F.col("b.grp").alias("grp"),
                    F.col("b.run_id").alias("run_id"),
                    (-F.col("b.neg_len")).alias("streak_len"),
                    F.col("b.start_t").alias("start_t"),
                    F.col("b.end_t").alias("end_t")))


def top_n_runs(runs: DataFrame, key: str, n: int = 10) -> DataFrame:
    """Global top-N longest runs with a total tie-break (length desc, key,
    start, run id). Planned as TakeOrderedAndProject: each task keeps its
    own top-N and only N rows per task reach the final merge."""
    return (runs.orderBy(F.desc("streak_len"), F.asc(key), F.asc("start_t"),
                         F.asc("run_id"))
            .limit(n))


def longest_streaks(df: DataFrame, key: str = "video_file",
                    order: str = "t_sec", hit: Column | None = None,
                    n: int = 10, bucket: Column | None = None,
                    balance: str = "rows") -> dict[str, DataFrame]:
    """The full streak report: ``runs``, ``per_key`` (best run of every key)
    and ``topn``. Default hit rule: ``state == 'broken'``."""
    hit = hit if hit is not None else (F.col("state") == F.lit("broken"))
    runs = streak_runs(df, key, order, hit, bucket, balance)
    return {"runs": runs, "per_key": longest_per_key(runs, key),
            "topn": top_n_runs(runs, key, n)}


def parse_event_log(df: DataFrame) -> DataFrame:
    """Typed view of an event-log CSV read as strings (t_sec → double)."""
    return df.withColumn("t_sec", F.col("t_sec").try_cast("double"))

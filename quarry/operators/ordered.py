"""Order-dependent computations without single-partition windows.

``cumulative_sums`` computes running totals over a global order the way a
distributed system should: a global sort (range partitioning, balanced by
sampling), a reliable checkpoint that fixes partition ids, per-partition
totals (one row per partition), offsets from those totals, and a local
running sum inside each partition. No task ever holds more than its own
range partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import materialize


def cumulative_sums(df: DataFrame, order: list[Column], values: list[str],
                    prefix: str = "cum_") -> DataFrame:
    """Add ``<prefix><v>`` = sum of ``v`` over all rows up to and including
    this one in ``order`` (``order`` should be total)."""
    ranged = materialize(df.orderBy(*order)).withColumn("__pid", F.spark_partition_id())
    tot = ranged.groupBy("__pid").agg(*[F.sum(v).alias(f"__t_{v}") for v in values])
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tot.select("__pid", *[F.coalesce(F.sum(f"__t_{v}").over(before), F.lit(0)).alias(f"__o_{v}")
                                    for v in values])
    upto = Window.partitionBy("__pid").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(v).over(upto).alias(f"__l_{v}") for v in values])
    out = local.join(F.broadcast(offsets), "__pid")
    return out.select(*df.columns, *[(F.col(f"__l_{v}") + F.col(f"__o_{v}")).alias(f"{prefix}{v}")
                                     for v in values])

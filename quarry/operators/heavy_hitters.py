"""The k most frequent values, exact, without a shuffle of all values.

A full count shuffles every distinct value of every map task. Here a sketch
of counters by hash (count-min) rules out most values first:

1. ``hashes`` tables of ``buckets`` counters, one aggregation whose size is
   fixed. A value occurs at most as often as its smallest counter says.
2. Values that only have counters among the ``lead`` greatest of each table
   are counted exactly; the k-th count of them, the *floor*, is a lower bound
   of the k-th count of all values.
3. Values with a counter below the floor cannot be among the first k. All
   others are counted exactly.

The result is that of a full count whatever the data. Where counters cannot
separate the k-th value (flat distributions, fewer than k values), the floor
is low, more values survive, and in the limit step 3 is the full count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from quarry.session import materialize

#: Counters of a table at most; a list of buckets is broadcast.
MOST_BUCKETS = 1 << 20


def _value(df: DataFrame, col: str) -> Column:
    """The value as grouping sees it: one zero, one NaN."""
    c = F.col(f"`{col}`")
    if isinstance(df.schema[col].dataType, (DoubleType, FloatType)):
        return F.when(F.isnan(c), F.lit(float("nan"))).otherwise(c + F.lit(0.0))
    return c


def _bucket(value: Column, table: int, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(table), value), F.lit(buckets)).cast("int")


def counters(df: DataFrame, col: str, hashes: int = 3, buckets: int = 1 << 14) -> DataFrame:
    """(table, bucket, n): how many rows hash to each counter. Counters of
    two inputs add up, so stored ones can be merged over loads."""
    value = _value(df, col)
    each = F.array(*[F.struct(F.lit(t).alias("table"), _bucket(value, t, buckets).alias("bucket")) for t in range(hashes)])
    return df.select(F.inline(each)).groupBy("table", "bucket").agg(F.count(F.lit(1)).alias("n"))


def survivors(df: DataFrame, col: str, kept: DataFrame, hashes: int, buckets: int) -> DataFrame:
    """The values (column ``value``, a row each time) all of whose counters
    are among ``kept`` (table, bucket): at most ``buckets`` rows a table."""
    value = _value(df, col)
    rows = df.select(F.col(f"`{col}`").alias("value"), *[_bucket(value, t, buckets).alias(f"b{t}") for t in range(hashes)])
    for t in range(hashes):
        one = kept.filter(F.col("table") == t).select(F.col("bucket").alias(f"b{t}"))
        rows = rows.join(F.broadcast(one), f"b{t}", "left_semi")
    return rows.select("value")


def _first(rows: DataFrame, k: int) -> DataFrame:
    return (rows.groupBy("value").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc_nulls_first("value")).limit(k))


def top_values(df: DataFrame, col: str, k: int, hashes: int = 3, buckets: int = 1 << 14, lead: int | None = None) -> DataFrame:
    """(``col``, count) of the ``k`` most frequent values, ties by value with
    null first, as a full count gives them. A null is a value like any other;
    an empty table gives an empty result. ``hashes``, ``buckets`` and ``lead``
    (four times ``k``) move work, not results."""
    if k < 1 or hashes < 1 or not 1 <= buckets <= MOST_BUCKETS:
        raise ValueError(f"k {k}, hashes {hashes}, buckets {buckets}: at least 1, at most {MOST_BUCKETS} buckets")
    sketch = materialize(counters(df, col, hashes, buckets))
    lead = min(buckets, lead or 4 * k)
    # the least of the ``lead`` greatest counters of each table: a few numbers
    tops = [sketch.filter(F.col("table") == t).orderBy(F.desc("n"), "bucket").limit(lead).withColumn("table", F.lit(t)) for t in range(hashes)]
    greatest = tops[0]
    for other in tops[1:]:
        greatest = greatest.unionByName(other)
    floor = (_first(survivors(df, col, greatest.select("table", "bucket"), hashes, buckets), k)
             .agg(F.when(F.count(F.lit(1)) == k, F.min("count")).otherwise(F.lit(0)).alias("floor")).first()["floor"])
    possible = sketch.filter(F.col("n") >= floor).select("table", "bucket")
    return _first(survivors(df, col, possible, hashes, buckets), k).withColumnRenamed("value", col)

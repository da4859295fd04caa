"""Group counts, top-k categories with semi-join filtering, ordered group
profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.modeling import assign_keys


def category_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def top_categories(df: DataFrame, col: str, k: int) -> DataFrame:
    """The ``k`` most frequent values of ``col`` (ties by value): a partial
    aggregation, then TakeOrderedAndProject — never a collect."""
    return (category_counts(df, col)
            .orderBy(F.desc("count"), F.asc_nulls_first(col)).limit(k))


def filter_top_categories(df: DataFrame, col: str, k: int = 5) -> DataFrame:
    """Rows whose ``col`` is among the top ``k`` values: a left-semi join
    against the k-row table (broadcast; its size is bounded by ``k``)."""
    top = top_categories(df, col, k).select(col)
    return df.join(F.broadcast(top), col, "left_semi")


def group_profile(df: DataFrame, by: str, mean_cols: list[str], count_name: str = "count") -> DataFrame:
    """Per group: mean of each column in ``mean_cols`` and the row count."""
    return df.groupBy(by).agg(*[F.avg(c).alias(f"avg_{c}") for c in mean_cols],
                              F.count(F.lit(1)).alias(count_name))


def ordered(df: DataFrame, order_cols: list[str], pos_col: str = "pos") -> DataFrame:
    """Attach the 1-based position of each row in ``order_cols`` order
    (prefix a column with ``-`` for descending). Uses the distributed
    ranking of ``assign_keys`` (range partitioning + per-partition
    offsets), never a single-partition window."""
    return assign_keys(df, order_cols, pos_col)

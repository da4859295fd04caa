"""The training fold, and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Values of a label that a sample is taken for.
MAX_VALUES = 4096


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2 (a null id is never held out)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def by_hash(df: DataFrame, rows: int, *cols: str) -> DataFrame:
    """About ``rows`` rows (all, if there are no more), those with the least
    hashes of ``cols``: the same rows for every partitioning. The rows are
    counted first and then filtered by a share, so no task sends candidates
    to the driver, whatever their number."""
    n = df.count()
    if n <= rows:
        return df
    return df.filter(F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) < int((1 << 40) * rows / n))


def by_hash_each(df: DataFrame, rows: int, least: int, group: str, *cols: str) -> DataFrame:
    """``by_hash``, but about ``least`` rows of every value of ``group`` (fewer
    if the values are many, one at least) where its share of ``rows`` is
    smaller. Rows that are equal in ``cols`` come or go together: with
    distinct rows the result has about ``rows`` rows plus ``least`` for every
    value, in any case no more values than ``MAX_VALUES``."""
    h = F.pmod(F.xxhash64(*cols), F.lit(1 << 40))
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.min(h).alias("lo"))
    n, values = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if values > MAX_VALUES:
        raise ValueError(f"{values} values of {group} to learn, more than {MAX_VALUES}")
    if n <= rows:
        return df
    least = max(min(least, rows // values), 1)
    share = F.greatest(F.lit(rows / n), F.lit(float(least)) / F.col("n"))
    limit = sizes.select(group, F.greatest((share * (1 << 40)).cast("long"), F.col("lo") + 1).alias("__limit"))
    return df.join(F.broadcast(limit), group).filter(h < F.col("__limit")).select(*df.columns)  # a row per value

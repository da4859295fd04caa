"""Join helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str],
                   how: str = "inner", send: Callable[[DataFrame], DataFrame] = lambda t: t) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (``<=>``); the right
    side's key columns are dropped from the result. ``send`` may hint at how
    the right side is to be joined (``F.broadcast``)."""
    r = right.select(*[F.col(f"`{c}`").alias(f"__r_{c}") if c in keys else F.col(f"`{c}`")
                       for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"__r_{k}"])
        cond = c if cond is None else cond & c
    out = left.join(send(r), cond, how)
    return out.drop(*[f"__r_{k}" for k in keys])

"""Surrogate keys that stay: a stored dictionary from natural keys to numbers.

``modeling.assign_keys`` numbers the members of one load. Over several loads a
member must keep its number, so the dictionary is stored: a load finds its new
members by a null-safe anti-join, numbers them after the greatest key in use
(in natural order, by the distributed numbering of ``assign_keys``), writes
them to a folder of their own, and commits a manifest that names it. Folders
are never changed; a crash before the commit leaves the dictionary as it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.joins import join_null_safe
from quarry.operators.modeling import assign_keys
from quarry.sinks.store import Manifests


class KeyDictionary:
    """Keys 1.. of the members with natural columns ``natural`` under ``root``."""

    def __init__(self, root: str, natural: list[str], key_col: str):
        self.root, self.natural, self.key_col = root.rstrip("/"), list(natural), key_col

    def members(self, spark: SparkSession) -> DataFrame | None:
        """(key, natural columns) of the last committed version; None before
        the first load."""
        _, now = Manifests(spark, self.root).latest()
        return self._read(spark, now)

    def _read(self, spark: SparkSession, now: dict) -> DataFrame | None:
        if not now.get("loads"):
            return None
        return spark.read.schema(now["schema"]).parquet(*[f"{self.root}/{x}" for x in now["loads"]])

    def load(self, df: DataFrame) -> DataFrame:
        """Give keys to the members in ``df`` that have none (rows with a
        null in a natural column are no members); the whole dictionary."""
        spark = df.sparkSession
        log = Manifests(spark, self.root)
        version, now = log.latest()
        new = df.select(*self.natural).dropna().distinct()
        old = self._read(spark, now)
        if old is not None:
            new = join_null_safe(new, old.select(*self.natural), self.natural, "left_anti")
        top = now.get("top", 0)
        keyed = assign_keys(new, self.natural, self.key_col)
        keyed = keyed.select((F.col(self.key_col) + top).alias(self.key_col), *self.natural)
        folder = f"load-{version + 1:012d}-{uuid.uuid4().hex[:8]}"
        keyed.write.parquet(f"{self.root}/{folder}")
        written = spark.read.schema(keyed.schema).parquet(f"{self.root}/{folder}")
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in keyed.schema.fields)
        n = written.agg(F.max(self.key_col)).first()[0]
        if n is None:
            log.store.remove(folder)
            return old if old is not None else spark.createDataFrame([], schema)
        log.commit(version, {"loads": [*now.get("loads", []), folder], "schema": schema, "top": n})
        return self.members(spark)

    def keyed(self, df: DataFrame, members: DataFrame | None = None, how: str = "inner") -> DataFrame:
        """``df`` with the key of its member."""
        members = members if members is not None else self.members(df.sparkSession)
        return join_null_safe(df, members, self.natural, how)

"""A table with a UNIQUE column and a Bloom index beside it.

Rows lie in ``buckets`` folders by hash of the unique column. For every bucket
the index holds a Bloom filter as rows (bucket, word, bits) of 64 bits each,
built and probed by DataFrame operations, so it is as distributed as the table
itself. A batch is admitted in three steps:

1. its values are probed: a value with an unset bit is not in the table, so
   only values whose bits are all set need a look;
2. only the buckets of those values are read (by path), only their unique
   column, and joined;
3. accepted rows and the bits they set are appended to new folders, and a
   manifest of the next version makes both visible at once.

A filter has no false negatives, so accepts and rejects are those of a join
with the whole table, whatever its size; its false positives only cost reads.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.messages import admission
from quarry.session import materialize
from quarry.sinks.files import rebalanced
from quarry.sinks.store import Manifests

HASHES = 5


class UniqueTable:
    """Append-only table under ``root``; ``value_col`` is unique, ``order_col``
    decides which row of a batch comes first. ``bits_per_bucket`` is fixed
    when the table is made (about ten times the values expected in one)."""

    def __init__(self, root: str, value_col: str = "email", order_col: str = "seq", buckets: int = 64,
                 bits_per_bucket: int = 1 << 20):
        self.root, self.value_col, self.order_col = root.rstrip("/"), value_col, order_col
        self.buckets, self.bits = buckets, bits_per_bucket

    # ------------------------------------------------------------- filter
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.lit("bucket"), F.col(self.value_col)), F.lit(self.buckets)).cast("int")

    def _positions(self) -> Column:
        return F.array(*[F.pmod(F.xxhash64(F.lit(k), F.col(self.value_col)), F.lit(self.bits)) for k in range(HASHES)])

    def _bits_of(self, df: DataFrame) -> DataFrame:
        """(bucket, word, bits) that the values of ``df`` set."""
        each = df.select("bucket", F.explode(self._positions()).alias("p"))
        return each.groupBy("bucket", F.expr("p div 64").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(p % 64 AS INT))")).alias("bits"))

    def maybe_known(self, batch: DataFrame, index: DataFrame) -> DataFrame:
        """The distinct non-null values of a batch whose bits are all set:
        (value, bucket)."""
        values = batch.select(self.value_col).filter(F.col(self.value_col).isNotNull()).distinct().withColumn("bucket", self.bucket())
        each = values.select(self.value_col, "bucket", F.explode(self._positions()).alias("p"))
        each = each.withColumn("word", F.expr("p div 64"))
        # an index is a list of loads: a bit is set if any of them sets it
        hit = each.join(index, ["bucket", "word"]).filter(F.expr("(shiftright(bits, CAST(p % 64 AS INT)) & 1) = 1"))
        return hit.groupBy(self.value_col, "bucket").agg(F.countDistinct("p").alias("n"), F.first(F.size(F.array_distinct(
            self._positions()))).alias("need")).filter("n = need").select(self.value_col, "bucket")

    # -------------------------------------------------------------- table
    def _loads(self, spark: SparkSession) -> tuple[int, dict]:
        return Manifests(spark, self.root).latest()

    def rows(self, spark: SparkSession) -> DataFrame:
        """All rows of the last committed version."""
        _, now = self._loads(spark)
        if not now.get("loads"):
            raise ValueError(f"{self.root} holds no rows")
        return spark.read.schema(now["schema"]).parquet(*[f"{self.root}/rows/{x['id']}/bucket={b}" for x in now["loads"] for b in x["buckets"]])

    def admit(self, batch: DataFrame) -> DataFrame:
        """``batch`` with ``reason`` (NULL: to accept), as ``admission``
        against the whole table gives it."""
        spark = batch.sparkSession
        _, now = self._loads(spark)
        none = spark.createDataFrame([], f"`{self.value_col}` {batch.schema[self.value_col].dataType.simpleString()}")
        if not now.get("loads"):
            return admission(none, batch, self.value_col, self.order_col)
        index = spark.read.parquet(*[f"{self.root}/index/{x['id']}" for x in now["loads"]])
        maybe = materialize(self.maybe_known(batch, index))
        look = [r["bucket"] for r in maybe.select("bucket").distinct().collect()]  # at most as many as buckets
        return admission(self.known(spark, look, now).join(maybe.select(self.value_col), self.value_col, "left_semi") if look else none,
                         batch, self.value_col, self.order_col)

    def known(self, spark: SparkSession, buckets: list[int], now: dict | None = None) -> DataFrame:
        """The unique column of some buckets; no other folder is listed."""
        now = now or self._loads(spark)[1]
        paths = [f"{self.root}/rows/{x['id']}/bucket={b}" for x in now["loads"] for b in x["buckets"] if b in set(buckets)]
        if not paths:
            return spark.createDataFrame([], now["schema"]).select(self.value_col)
        return spark.read.schema(now["schema"]).parquet(*paths).select(self.value_col)

    def append(self, batch: DataFrame) -> dict[str, DataFrame]:
        """Admit a batch and store its accepted rows with their ``id`` and
        ``created_at``, drawn once. Returns ``accepted`` (as stored) and
        ``rejected`` (with reason)."""
        spark = batch.sparkSession
        log = Manifests(spark, self.root)
        version, now = log.latest()
        tagged = materialize(self.admit(batch))
        load = uuid.uuid4().hex[:12]
        good = (tagged.filter(F.col("reason").isNull())
                .select(F.expr("uuid()").alias("id"), *batch.columns, F.current_timestamp().alias("created_at"), self.bucket().alias("bucket")))
        path = f"{self.root}/rows/{load}"
        rebalanced(good, ["bucket"]).write.partitionBy("bucket").parquet(path)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in good.drop("bucket").schema.fields)
        buckets = sorted(int(n.partition("=")[2]) for n in log.store.names(f"rows/{load}") if n.startswith("bucket="))
        loads = list(now.get("loads", []))
        if buckets:
            stored = spark.read.schema(schema + ", bucket int").parquet(path)
            self._bits_of(stored).write.parquet(f"{self.root}/index/{load}")
            loads.append({"id": load, "buckets": buckets})
        log.commit(version, {"loads": loads, "schema": now.get("schema", schema)})
        accepted = spark.read.schema(schema).parquet(*[f"{path}/bucket={b}" for b in buckets]) if buckets else spark.createDataFrame([], schema)
        return {"accepted": accepted, "rejected": tagged.filter(F.col("reason").isNotNull()).select(*batch.columns, "reason")}

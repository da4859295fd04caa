"""Keyed tables for streams: a bucketed merge table with versioned manifests,
and named flush files committed exactly once.

``KeyedUpsertSink`` holds the latest row per key in ``buckets`` folders by
key hash. A micro-batch is reduced to its latest row per key, and only the
buckets it touches are read, merged and written anew, beside the old ones; a
manifest of the next version then names one data folder per bucket and the
batch that it contains. Manifests are never replaced, and readers take the
highest complete one: a crash between any two steps leaves the version before,
and the replayed batch does the work again (or, if its version was committed,
nothing).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.messages import latest_by_key
from quarry.sinks.files import rebalanced
from quarry.sinks.store import Manifests, Store, sealed, unsealed

BUCKET = "_bucket"


class KeyedUpsertSink:
    """Last-write-wins table under ``root``; call it with (batch, batch_id).

    ``order`` decides which row of a key is the latest. Batches of one
    ``stream`` (its checkpoint, say) come with ascending ids; one that the
    table holds already changes nothing. Rows with new columns widen the table (older rows have nulls)."""

    def __init__(self, root: str, keys: list[str], order: list[str], buckets: int = 64, keep_versions: int = 2):
        self.root, self.keys, self.order = root.rstrip("/"), keys, order
        self.buckets, self.keep_versions = buckets, keep_versions

    def bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _read(self, spark: SparkSession, folders: dict[str, str], schema: str | None) -> DataFrame | None:
        """The rows of (bucket -> data folder), read by path."""
        if not folders:
            return None
        paths = [f"{self.root}/{f}/{BUCKET}={b}" for b, f in sorted(folders.items())]
        return spark.read.schema(schema).parquet(*paths)

    def __call__(self, batch: DataFrame, batch_id: int, stream: str = "") -> None:
        spark = batch.sparkSession
        log = Manifests(spark, self.root)
        version, now = log.latest()
        if batch_id <= now.get("batches", {}).get(stream, -1):
            return  # replayed after its version was committed
        buckets = now.get("buckets", self.buckets)
        if buckets != self.buckets:
            raise ValueError(f"the table has {buckets} buckets")
        data = f"data/{version + 1:012d}-{uuid.uuid4().hex[:8]}"
        latest = latest_by_key(batch, self.keys, self.order).withColumn(BUCKET, self.bucket())
        fresh = f"{self.root}/{data}/in"
        rebalanced(latest, [BUCKET]).write.partitionBy(BUCKET).parquet(fresh)
        store = Store(spark, self.root)
        touched = [n.partition("=")[2] for n in store.names(f"{data}/in") if n.startswith(f"{BUCKET}=")]
        folders = dict(now.get("folders", {}))
        schema = now.get("schema")
        if touched:
            new = spark.read.schema(batch_schema := _ddl(latest.drop(BUCKET))).parquet(*[f"{fresh}/{BUCKET}={b}" for b in touched])
            old = self._read(spark, {b: folders[b] for b in touched if b in folders}, schema)
            rows = new if old is None else old.unionByName(new, allowMissingColumns=True)
            merged = latest_by_key(rows, self.keys, self.order).withColumn(BUCKET, self.bucket())
            rebalanced(merged, [BUCKET]).write.partitionBy(BUCKET).parquet(f"{self.root}/{data}/merged")
            schema = batch_schema if old is None and schema is None else _ddl(_empty(spark, schema).unionByName(
                _empty(spark, batch_schema), allowMissingColumns=True))
            folders |= {b: f"{data}/merged" for b in touched}
        store.remove(f"{data}/in")
        log.commit(version, {"batches": now.get("batches", {}) | {stream: batch_id}, "buckets": self.buckets, "folders": folders, "schema": schema})

    def current(self, spark: SparkSession) -> DataFrame:
        """The table at its last committed version: one row per key, read
        without a shuffle."""
        _, now = Manifests(spark, self.root).latest()
        if not now or now["schema"] is None:
            raise ValueError(f"{self.root} holds no version with rows")
        return self._read(spark, now["folders"], now["schema"])

    def lookup(self, spark: SparkSession, **key) -> DataFrame:
        """The row of one key: only its bucket is read."""
        _, now = Manifests(spark, self.root).latest()
        types = dict(self.current(spark).dtypes)
        one = spark.range(1).select(*[F.lit(key[k]).cast(types[k]).alias(k) for k in self.keys])
        b = str(one.select(self.bucket()).first()[0])
        if b not in now["folders"]:
            return _empty(spark, now["schema"])
        rows = self._read(spark, {b: now["folders"][b]}, now["schema"])
        for k in self.keys:
            rows = rows.filter(F.col(k).eqNullSafe(F.lit(key[k])))
        return rows

    def compact(self, spark: SparkSession) -> int:
        """Forget old versions and remove data that no kept version names
        (also what crashed batches have left). Readers of a version that is
        gone have to start anew. Returns the highest batch id in the table."""
        kept = Manifests(spark, self.root).forget(self.keep_versions)
        store = Store(spark, self.root)
        used = {f.split("/")[1] for body in kept for f in body["folders"].values()}
        live = {(f.split("/")[1], b) for body in kept for b, f in body["folders"].items()}
        for name in store.names("data"):
            if name not in used:
                store.remove(f"data/{name}")
                continue
            for part in store.names(f"data/{name}/merged"):
                if part.startswith(f"{BUCKET}=") and (name, part.partition("=")[2]) not in live:
                    store.remove(f"data/{name}/merged/{part}")
        return max(kept[0]["batches"].values()) if kept else -1


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


class FlushFiles:
    """Each micro-batch with rows becomes ``<prefix><flush time>.jsonl``
    (``...-<part>.jsonl`` for further parts of a batch beyond one advisory
    partition size). Call it with (batch, batch_id).

    Parts are written to a staging folder; a note of the batch, never
    replaced, fixes their final names; then they are moved in. A replayed
    batch finishes its own moves under the same names and adds no file."""

    def __init__(self, out_dir: str, prefix: str = "users_", clock: Callable[[], datetime] = _utc_now):
        self.out_dir, self.prefix, self.clock = out_dir.rstrip("/"), prefix, clock

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        store = Store(batch.sparkSession, self.out_dir)
        note = f"_flush/batch-{batch_id:012d}.json"
        body = unsealed(store.read(note)) if store.exists(note) else None
        if body is None:
            staging = f"_staging/batch-{batch_id:012d}"
            store.remove(staging)
            store.remove(note)  # a note that its writer did not finish names nothing yet
            batch.hint("rebalance").write.json(f"{self.out_dir}/{staging}")
            parts = [n for n in store.names(staging) if n.startswith("part-")]
            stem = self._free_name(store)
            names = [f"{stem}.jsonl" if k == 0 else f"{stem}-{k}.jsonl" for k in range(len(parts))]
            body = {"moves": [[f"{staging}/{p}", n] for p, n in zip(parts, names)], "staging": staging}
            store.create(note, sealed(body))
        for staged, name in body["moves"]:
            store.move(staged, name)
        store.remove(body["staging"])

    def _free_name(self, store: Store) -> str:
        """The flush time; a second flush within one second counts up."""
        stem = self.prefix + self.clock().strftime("%Y%m%d_%H%M%S")
        taken, k, name = set(store.names()), 0, stem
        while f"{name}.jsonl" in taken:
            k += 1
            name = f"{stem}_{k}"
        return name

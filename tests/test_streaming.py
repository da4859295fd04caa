"""Batch/stream equivalence, rate limit, restart, idempotent upsert."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quarry.operators import messages as MS
from quarry.sinks.store import Manifests, Store
from quarry.sources import files as SR
from quarry.streaming import jobs as ST

RECS = [
    [{"id": "1", "name": "A", "email": "a@x.io", "country": "FR", "created_at": "2024-01-01T00:00:01"},
     {"id": "2", "name": "B", "email": "b@x.io", "country": "DE", "created_at": "2024-01-01T00:00:02"},
     {"id": "1", "name": "A2", "email": "a@x.io", "country": "FR", "created_at": "2024-01-01T00:00:03"}],
    [],                                                              # empty file
    [{"id": "1", "name": "A3", "email": "a@x.io", "country": "FR", "created_at": "2024-01-01T00:00:00"},
     {"id": "3", "name": "C", "country": "FR", "created_at": "2024-01-01T00:00:04"}],  # NULL email
]


def _write_files(folder, recs, start=0):
    os.makedirs(folder, exist_ok=True)
    for i, batch in enumerate(recs):
        with open(os.path.join(folder, f"users_{start + i:04d}.jsonl"), "w") as f:
            for r in batch:
                f.write(json.dumps(r) + "\n")


def test_file_stream_to_messages_one_file_per_trigger_and_restart(spark, tmp):
    src, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    _write_files(src, RECS)
    q = ST.start_file_to_messages(spark, src, ck, out, trigger={"availableNow": True})
    q.awaitTermination()
    assert q.recentProgress and sum(1 for p in q.recentProgress if p["numInputRows"] >= 0) >= 3
    first = spark.read.parquet(out).count()
    assert first == 5                                    # every line of every file (no multiLine)
    # restart on the same checkpoint with nothing new: no re-emission
    ST.start_file_to_messages(spark, src, ck, out, trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out).count() == first
    # a new file is picked up once
    _write_files(src, [[RECS[0][1]]], start=10)
    ST.start_file_to_messages(spark, src, ck, out, trigger={"availableNow": True}).awaitTermination()
    assert spark.read.parquet(out).count() == first + 1


def test_stream_matches_batch(spark, tmp):
    src = f"{tmp}/in"
    _write_files(src, RECS)
    batch = MS.to_messages(spark.read.schema(MS.USER_EVENT_SCHEMA).json(src))
    stream = MS.to_messages(SR.read_json_stream(spark, src, MS.USER_EVENT_SCHEMA))
    q = stream.writeStream.format("memory").queryName("msgs_eq").trigger(availableNow=True).start()
    q.awaitTermination()
    got = sorted((bytes(r.key), bytes(r.value)) for r in spark.table("msgs_eq").collect())
    want = sorted((bytes(r.key), bytes(r.value)) for r in batch.collect())
    assert got == want


def test_upsert_sink_idempotent_and_latest(spark, tmp):
    src, root, ck = f"{tmp}/in", f"{tmp}/table", f"{tmp}/ck"
    _write_files(src, RECS)
    sink = ST.KeyedUpsertSink(root, ["country", "id"], ["created_at"])
    msgs = MS.to_messages(SR.read_json_stream(spark, src, MS.USER_EVENT_SCHEMA))
    ST.start_upsert(spark, msgs, sink, ck, trigger={"availableNow": True}).awaitTermination()
    cur = {(r.country, r.id): r.name for r in sink.current(spark).collect()}
    assert cur == {("FR", "1"): "A2", ("DE", "2"): "B", ("FR", "3"): "C"}
    # replaying a batch that the table holds changes nothing
    version = Manifests(spark, root).latest()
    sink(spark.createDataFrame([("FR", "1", "Z", "z@x.io", "2030-01-01")], "country string, id string, name string, email string, created_at string"), 0, ck)
    assert Manifests(spark, root).latest() == version
    assert "ingested_at" in sink.current(spark).columns


def test_key_partitioned_messages(spark):
    msgs = MS.to_messages(spark.createDataFrame(
        [(str(i), "n", "e@x.io", c, "2024-01-01T00:00:00") for i, c in enumerate(["FR", "DE", "US"] * 20)],
        MS.USER_EVENT_SCHEMA))
    part = MS.partition_by_key(msgs, 10).select(F.col("key").cast("string").alias("k"),
                                               F.spark_partition_id().alias("p"))
    per_key = part.groupBy("k").agg(F.countDistinct("p").alias("n")).collect()
    assert all(r.n == 1 for r in per_key) and len(per_key) == 3


def test_minute_files_processing_time_trigger(spark, tmp):
    src, out, ck = f"{tmp}/in", f"{tmp}/out", f"{tmp}/ck"
    _write_files(src, RECS)
    q = ST.start_minute_files(SR.read_json_stream(spark, src, MS.USER_EVENT_SCHEMA, 10), out, ck,
                              interval="1 second")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.schema(MS.USER_EVENT_SCHEMA).json(out).count() == 5


def test_upsert_compaction(spark, tmp):
    src, root, ck = f"{tmp}/in", f"{tmp}/table", f"{tmp}/ck"
    _write_files(src, RECS[:1])
    sink = ST.KeyedUpsertSink(root, ["country", "id"], ["created_at"])
    msgs = lambda: MS.to_messages(SR.read_json_stream(spark, src, MS.USER_EVENT_SCHEMA))
    ST.start_upsert(spark, msgs(), sink, ck, trigger={"availableNow": True}).awaitTermination()
    before = sorted(tuple(r) for r in sink.current(spark).drop("ingested_at").collect())
    assert sink.compact(spark) >= 0
    assert sorted(tuple(r) for r in sink.current(spark).drop("ingested_at").collect()) == before
    _write_files(src, RECS[2:], start=5)
    ST.start_upsert(spark, msgs(), sink, ck, trigger={"availableNow": True}).awaitTermination()
    cur = {(r.country, r.id): r.name for r in sink.current(spark).collect()}
    assert cur == {("FR", "1"): "A2", ("DE", "2"): "B", ("FR", "3"): "C"}


def test_unparsed_messages_are_dead_letters(spark, tmp):
    good = json.dumps({"id": "1", "name": "n", "email": "e@x.io", "country": "FR", "created_at": "2024-01-01T00:00:00"})
    spark.createDataFrame([("FR", good), ("FR", good[:-9])], "key string, value string").coalesce(1).write.parquet(f"{tmp}/in")
    msgs = spark.readStream.schema("key string, value string").parquet(f"{tmp}/in").select(
        F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"))
    sink = ST.KeyedUpsertSink(f"{tmp}/t", ["country", "id"], ["created_at"])
    ST.start_upsert(spark, msgs, sink, f"{tmp}/ck", trigger={"availableNow": True}).awaitTermination()
    assert sink.current(spark).count() == 1
    assert [r.raw for r in spark.read.parquet(f"{tmp}/t/dead_letters").collect()] == [good[:-9]]


def _batches():
    rows = [[("a", 1, "x", 1), ("b", 1, "x", 1), ("a", 2, "y", 1)], [("a", 3, "z", 1), ("c", 1, "x", 1)], [],
            [(None, 1, "n", 1), ("b", 0, "late", 1)], [("d", 1, "x", 1), ("a", 3, "z2", 1)]]
    return rows, "k string, at int, v string, w int"


def _state(sink, spark):
    return sorted((tuple(r) for r in sink.current(spark).select("k", "at", "v").collect()), key=str)


WANT = sorted([("a", 3, "z2"), ("b", 1, "x"), ("c", 1, "x"), ("d", 1, "x"), (None, 1, "n")], key=str)


@pytest.mark.parametrize("step", ["create", "remove", "names"])
@pytest.mark.parametrize("calls", [1, 2, 5])
def test_upsert_survives_a_crash_at_any_step(spark, tmp, monkeypatch, step, calls):
    """Every batch crashes once at the step, then is replayed; compaction
    crashes as well. No row is lost at any time."""
    rows, schema = _batches()
    sink = ST.KeyedUpsertSink(f"{tmp}/t", ["k"], ["at", "v"], buckets=4)
    real, left = getattr(Store, step), [0]

    def crash(self, *args):
        left[0] -= 1
        if left[0] == 0:
            raise KeyboardInterrupt
        return real(self, *args)

    monkeypatch.setattr(Store, step, crash)
    seen = 0
    for n, batch in enumerate(rows):
        df = spark.createDataFrame(batch, schema)
        for action in (lambda: sink(df, n), lambda: sink.compact(spark)):
            left[0] = calls
            try:
                action()
            except KeyboardInterrupt:
                left[0] = 0
                if n:
                    assert len(_state(sink, spark)) >= seen
                action()
            left[0] = 0
        seen = len(_state(sink, spark))
    assert _state(sink, spark) == WANT
    folders = Manifests(spark, f"{tmp}/t").latest()[1]["folders"]
    assert len({f for f in folders.values()}) > 1            # untouched buckets stayed where they were


def test_upsert_rewrites_only_touched_buckets_and_widens(spark, tmp):
    sink = ST.KeyedUpsertSink(f"{tmp}/t", ["k"], ["at"], buckets=16)
    sink(spark.range(200).selectExpr("cast(id as string) k", "1 at", "'x' v"), 0)
    before = Manifests(spark, f"{tmp}/t").latest()[1]["folders"]
    sink(spark.createDataFrame([("7", 2, "new", 5)], "k string, at int, v string, more int"), 1)
    after = Manifests(spark, f"{tmp}/t").latest()[1]["folders"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert sink.current(spark).count() == 200 and sink.current(spark).columns[-1] == "more"
    assert [tuple(r) for r in sink.lookup(spark, k="7").collect()] == [("7", 2, "new", 5)]
    assert sink.lookup(spark, k="none").count() == 0
    assert "Exchange" not in sink.current(spark)._jdf.queryExecution().executedPlan().toString()


def test_flush_files_are_named_and_written_once(spark, tmp, monkeypatch):
    at = [datetime(2024, 1, 1, 0, 1, 0)]
    flush = ST.FlushFiles(f"{tmp}/out", clock=lambda: at[0])
    df = spark.createDataFrame([("1", "A"), ("2", "B")], "id string, name string")
    flush(df, 0)
    assert [n for n in os.listdir(f"{tmp}/out") if n.endswith(".jsonl")] == ["users_20240101_000100.jsonl"]
    at[0] = datetime(2024, 1, 1, 0, 2, 0)
    flush(df, 0)                                             # replayed: no new file
    assert spark.read.json(f"{tmp}/out").count() == 2
    real, left = Store.move, [1]

    def crash(self, *args):
        left[0] -= 1
        if left[0] == 0:
            raise KeyboardInterrupt
        return real(self, *args)

    monkeypatch.setattr(Store, "move", crash)
    with pytest.raises(KeyboardInterrupt):
        flush(df, 1)
    at[0] = datetime(2024, 1, 1, 0, 3, 0)
    flush(df, 1)                                             # finishes under the name of its first try
    assert sorted(n for n in os.listdir(f"{tmp}/out") if n.endswith(".jsonl")) == \
        ["users_20240101_000100.jsonl", "users_20240101_000200.jsonl"]
    assert spark.read.json(f"{tmp}/out").count() == 4

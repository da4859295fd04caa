"""Streaming jobs built from the batch operators (the same functions run on
a static or a streaming DataFrame).

* ``start_file_to_messages`` — NDJSON folder (1 file per trigger by
  default) → (key, value) messages → any sink format (``kafka`` when the
  connector is present; ``parquet``/``json``/``memory`` otherwise) with a
  checkpoint, append mode. A restart resumes from the checkpoint and emits
  nothing twice for file sinks.
* ``start_upsert`` — messages into a last-write-wins table
  (``streaming.tables.KeyedUpsertSink``) by ``foreachBatch``.
* ``start_minute_files`` — records flushed to NDJSON files named by the flush
  time on a processing-time trigger (none when empty).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarry.operators.messages import USER_EVENT_SCHEMA, decode_messages, to_messages
from quarry.sources.files import read_json_stream, require_format
from quarry.streaming.tables import FlushFiles, KeyedUpsertSink


def _trigger(w, trigger: dict | None):
    return w.trigger(**trigger) if trigger else w


def start_file_to_messages(spark: SparkSession, in_dir: str, checkpoint: str, sink: str,
                           fmt: str = "parquet", schema: T.StructType = USER_EVENT_SCHEMA,
                           key_col: str = "country", topic: str | None = None,
                           options: dict | None = None, max_files_per_trigger: int = 1,
                           trigger: dict | None = None) -> StreamingQuery:
    src = read_json_stream(spark, in_dir, schema, max_files_per_trigger)
    msgs = to_messages(src, key_col)
    w = msgs.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if fmt == "kafka":
        require_format(spark, "kafka")
        w = w.format("kafka").option("topic", topic)
    elif fmt == "memory":
        w = w.format("memory").queryName(sink)
    else:
        w = w.format(fmt).option("path", sink)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return _trigger(w, trigger).start()


def start_upsert(spark: SparkSession, messages: DataFrame, sink: KeyedUpsertSink, checkpoint: str,
                 schema: T.StructType = USER_EVENT_SCHEMA, trigger: dict | None = None,
                 extra_cols: list[str] | None = None) -> StreamingQuery:
    """Decode a message stream and upsert it by key. Messages that do not
    parse go to ``<root>/dead_letters/batch_id=<n>`` in the same batch
    (overwritten when a batch is replayed, so each is kept once)."""
    def upsert(batch: DataFrame, batch_id: int) -> None:
        dec = decode_messages(batch, schema, keep=extra_cols)
        sink(dec["good"].drop("msg_key").withColumn("ingested_at", F.current_timestamp()), batch_id, checkpoint)
        dec["bad"].write.mode("overwrite").parquet(f"{sink.root}/dead_letters/batch_id={batch_id}")

    w = messages.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger).start()


def start_minute_files(records: DataFrame, out_dir: str, checkpoint: str,
                       interval: str = "60 seconds", prefix: str = "users_", trigger: dict | None = None) -> StreamingQuery:
    """Flush records once per ``interval`` of processing time to a file
    named by the flush time, exactly once (``FlushFiles``); an interval with
    no records writes nothing."""
    flush = FlushFiles(out_dir, prefix)

    def write(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            flush(batch, batch_id)

    w = records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return _trigger(w, trigger or {"processingTime": interval}).start()

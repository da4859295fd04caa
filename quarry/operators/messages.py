"""Keyed messages, decoding, last-write-wins and sign-up admission.

These are the data steps of a sign-up stream (records → keyed topic
messages → keyed upsert) written so the same function serves a batch
DataFrame and a streaming one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.expressions import EMAIL_PATTERN
from quarry.operators.quality import Rule, reject_reasons

# Fixed value: the sign-up record schema (all text on the wire).
USER_EVENT_SCHEMA = T.StructType([T.StructField(n, T.StringType(), True)
                                  for n in ("id", "name", "email", "country", "created_at")])
CORRUPT_COL = "_corrupt_record"


def to_messages(df: DataFrame, key_col: str = "country", value_cols: list[str] | None = None,
                include_key: bool = False) -> DataFrame:
    """(key BINARY, value BINARY): key = ``key_col`` as text, value = JSON
    of ``value_cols`` (default: every input column; NULL fields are
    omitted by ``to_json``). ``include_key`` adds the key to the payload."""
    cols = list(value_cols or df.columns)
    if include_key:
        cols = cols + [F.col(key_col).cast("string").alias("key")]
    payload = F.to_json(F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols]))
    return df.select(F.col(key_col).cast("string").cast("binary").alias("key"),
                     payload.cast("binary").alias("value"))


def partition_by_key(msgs: DataFrame, partitions: int = 10, key_col: str = "key") -> DataFrame:
    """Batch analogue of a key-partitioned topic: every message with the
    same key lands in the same one of ``partitions`` partitions."""
    return msgs.repartition(partitions, F.col(key_col))


def decode_messages(msgs: DataFrame, schema: T.StructType = USER_EVENT_SCHEMA,
                    keep: list[str] | None = None) -> dict[str, DataFrame]:
    """Parse the JSON value PERMISSIVE-ly; ``good`` has the typed fields,
    ``bad`` the raw text of records that did not parse."""
    full = T.StructType(schema.fields + [T.StructField(CORRUPT_COL, T.StringType(), True)])
    parsed = msgs.select(*(keep or []), F.col("key").cast("string").alias("msg_key"),
                         F.from_json(F.col("value").cast("string"), full,
                                     {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
                                     ).alias("m"),
                         F.col("value").cast("string").alias("raw"))
    ok = F.col(f"m.{CORRUPT_COL}").isNull() & F.col("m").isNotNull()
    good = parsed.filter(ok).select(*(keep or []), "msg_key",
                                    *[F.col(f"m.{f.name}").alias(f.name) for f in schema.fields])
    bad = parsed.filter(~ok).select(*(keep or []), "msg_key", "raw")
    return {"good": good, "bad": bad}


def latest_by_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write wins: per ``keys`` the row with the greatest ``order``
    tuple. ``max(struct(order…, rest…))`` is a partial aggregation, so a
    hot key is reduced map-side instead of being gathered in one task."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*[F.col(c) for c in order + rest])).alias("_w")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_w.{c}").alias(c) for c in order + rest])


def minute_batches(df: DataFrame, ts_col: str = "created_at", every: str = "1 minute",
                   prefix: str = "users_") -> DataFrame:
    """Batch analogue of a flush-every-minute buffer: tumbling windows on
    the record time; one output file name per non-empty window, named by
    the flush (window end) time. Records without a readable time are left to
    ``unreadable_times``."""
    ts = F.col(ts_col)
    if isinstance(df.schema[ts_col].dataType, T.StringType):
        ts = F.try_to_timestamp(ts)
    w = df.filter(ts.isNotNull()).select(F.window(ts.cast("timestamp"), every).alias("w"), ts.alias("_ts"))
    g = w.groupBy("w").agg(F.count(F.lit(1)).alias("n_records"),
                           F.min("_ts").alias("first_ts"), F.max("_ts").alias("last_ts"))
    return g.select(F.col("w.start").alias("batch_start"), F.col("w.end").alias("batch_end"),
                    F.concat(F.lit(prefix), F.date_format("w.end", "yyyyMMdd_HHmmss"),
                             F.lit(".jsonl")).alias("file_name"),
                    "n_records", "first_ts", "last_ts")


def unreadable_times(df: DataFrame, ts_col: str = "created_at") -> DataFrame:
    """The records that ``minute_batches`` cannot place."""
    return df.filter(F.try_to_timestamp(F.col(ts_col).cast("string")).isNull())


def user_rules() -> list[Rule]:
    """Admission rules of a users table: required name/email/country and a
    well-formed e-mail."""
    return [Rule("name_missing", F.col("name").isNull()),
            Rule("email_missing", F.col("email").isNull()),
            Rule("country_missing", F.col("country").isNull()),
            Rule("email_format", ~F.col("email").rlike(EMAIL_PATTERN))]


def append_unique(existing: DataFrame, incoming: DataFrame, unique_col: str = "email",
                  order_col: str = "seq") -> dict[str, DataFrame]:
    """Append a batch to a table with a UNIQUE column.

    Accepted rows pass the rules, are the first of the batch for their
    value (by ``order_col``) and the value is not yet in ``existing``; they
    get ``id = uuid()`` and ``created_at = current_timestamp()``. Every
    other row is returned in ``rejected`` with a reason."""
    tagged = admission(existing, incoming, unique_col, order_col)
    base = incoming.columns
    accepted = (tagged.filter(F.col("reason").isNull())
                .select(F.expr("uuid()").alias("id"), *base, F.current_timestamp().alias("created_at")))
    return {"accepted": accepted, "rejected": tagged.filter(F.col("reason").isNotNull()).select(*base, "reason")}


def admission(existing: DataFrame, incoming: DataFrame, unique_col: str = "email",
              order_col: str = "seq") -> DataFrame:
    """``incoming`` with ``reason``: NULL for rows to accept. One union of
    both sides, one aggregation per value (does it exist, which row of the
    batch is its first), one join: each table is read once per side."""
    tagged = incoming.withColumn("_reasons", reject_reasons(user_rules()))
    old = existing.select(unique_col, F.lit(True).alias("_exists"), F.lit(None).cast(incoming.schema[order_col].dataType).alias("_at"))
    new = tagged.filter(F.size("_reasons") == 0).select(unique_col, F.lit(False).alias("_exists"), F.col(order_col).alias("_at"))
    known = old.unionByName(new).groupBy(unique_col).agg(F.max("_exists").alias("_exists"), F.min("_at").alias("_first"))
    known = known.filter(F.col("_first").isNotNull())
    reason = (F.when(F.size("_reasons") > 0, F.array_join("_reasons", ";")).when(F.col("_exists"), F.lit("email_exists"))
              .when(F.col(order_col) != F.col("_first"), F.lit("duplicate_in_batch")))
    return tagged.join(known, unique_col, "left").select(*incoming.columns, reason.alias("reason"))


def lookup(requests: DataFrame, table: DataFrame, req_key: str, key: str) -> DataFrame:
    """Batch point lookup: every request gets the matching row or a
    not-found status (a left join; filters on ``table`` push down)."""
    t = table.withColumn("_found", F.lit(True))
    j = requests.join(t, requests[req_key] == t[key], "left")
    return j.withColumn("status", F.when(F.col("_found"), F.lit(200)).otherwise(F.lit(404))).drop("_found")


def is_uuid(c: Column) -> Column:
    return c.rlike(r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$")

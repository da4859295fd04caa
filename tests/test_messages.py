"""Messages, decoding, last-write-wins, admission, minute batches."""

import json

from pyspark.sql import functions as F

from quarry.operators import messages as MS

USERS = "id string, name string, email string, country string, created_at string"


def _users(spark):
    return spark.createDataFrame([
        ("1", "Ann", "ann@x.io", "FR", "2024-01-01T00:00:01"),
        ("1", "Ann", "ann@x.io", "FR", "2024-01-01T00:00:09"),
        ("1", "Ann", "ann@x.io", "DE", "2024-01-01T00:00:05"),   # same id under two countries
        ("2", "Bob", None, "FR", "2024-01-01T00:01:00"),          # NULL field
    ], USERS)


def test_messages_key_and_payload(spark):
    m = MS.to_messages(_users(spark)).collect()
    assert bytes(m[0].key).decode() == "FR"
    p = json.loads(bytes(m[3].value).decode())
    assert "email" not in p and p["name"] == "Bob"                # NULL fields omitted
    k = MS.to_messages(_users(spark), include_key=True).first()
    assert json.loads(bytes(k.value).decode())["key"] == "FR"


def test_decode_with_corrupt_records(spark):
    msgs = MS.to_messages(_users(spark)).unionByName(
        spark.createDataFrame([(b"FR", b"{not json")], "key binary, value binary"))
    dec = MS.decode_messages(msgs)
    assert dec["good"].count() == 4 and dec["bad"].count() == 1


def test_latest_by_key(spark):
    lt = {(r.country, r.id): r.created_at for r in
          MS.latest_by_key(_users(spark), ["country", "id"], ["created_at"]).collect()}
    assert lt == {("FR", "1"): "2024-01-01T00:00:09", ("DE", "1"): "2024-01-01T00:00:05",
                  ("FR", "2"): "2024-01-01T00:01:00"}


def test_append_unique(spark):
    existing = spark.createDataFrame([("u1", "Old", "old@x.io", "FR")], "id string, name string, email string, country string")
    incoming = spark.createDataFrame([
        (1, "A", "a@x.io", "FR"), (2, "B", "a@x.io", "FR"),       # in-batch duplicate
        (3, "C", "old@x.io", "FR"),                                # exists already
        (4, "D", "bad-address", "FR"), (5, None, "e@x.io", "FR"),  # invalid
    ], "seq long, name string, email string, country string")
    res = MS.append_unique(existing, incoming)
    acc = res["accepted"].collect()
    assert [r.seq for r in acc] == [1] and MS.is_uuid(F.col("id")) is not None
    assert res["accepted"].filter(MS.is_uuid(F.col("id"))).count() == 1
    rej = {r.seq: r.reason for r in res["rejected"].collect()}
    assert rej == {2: "duplicate_in_batch", 3: "email_exists", 4: "email_format", 5: "name_missing"}


def test_minute_batches(spark):
    mb = MS.minute_batches(_users(spark)).collect()
    by = {r.file_name: r.n_records for r in mb}
    assert by == {"users_20240101_000100.jsonl": 3, "users_20240101_000200.jsonl": 1}


def test_append_unique_hot_value(spark):
    """A third of the batch shares one address: exactly the earliest row is
    admitted, every other copy is rejected as a duplicate."""
    n = 3000
    incoming = spark.range(0, n).select(
        F.col("id").alias("seq"), F.lit("N").alias("name"),
        F.when(F.col("id") % 3 == 0, F.lit("hot@x.io"))
         .otherwise(F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.io"))).alias("email"),
        F.lit("FR").alias("country"))
    existing = spark.createDataFrame([], "id string, name string, email string, country string")
    res = MS.append_unique(existing, incoming.repartition(7))
    hot_acc = res["accepted"].filter("email = 'hot@x.io'").collect()
    assert [r.seq for r in hot_acc] == [0]
    assert res["accepted"].count() == n - n // 3 + 1
    assert res["rejected"].filter("reason = 'duplicate_in_batch'").count() == n // 3 - 1


def test_latest_by_key_hot_key(spark):
    n = 3000
    df = spark.range(0, n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("FR").alias("country"), F.col("id").alias("seq"), F.col("id").cast("string").alias("name"))
    lt = {r.id: r.seq for r in MS.latest_by_key(df.repartition(7), ["country", "id"], ["seq"]).collect()}
    assert lt["hot"] == 2997 and len(lt) == n - n // 3 + 1


def test_unreadable_time_does_not_abort(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:05.000000",), ("yesterday",), (None,)], "created_at string")
    assert [r.n_records for r in MS.minute_batches(df).collect()] == [1]
    assert MS.unreadable_times(df).count() == 2

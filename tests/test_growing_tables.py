"""Unique table with a Bloom index, and durable surrogate keys."""

import pytest
from pyspark.sql import functions as F

from quarry.operators import messages as MS
from quarry.operators.durable_keys import KeyDictionary
from quarry.operators.unique_index import UniqueTable
from quarry.sinks.store import Manifests

SCHEMA = "seq long, name string, email string, country string"


def _batch(spark, ids, seq0=0):
    rows = [(seq0 + k, f"n{i}", None if i is None else f"u{i}@x.io", "FR") for k, i in enumerate(ids)]
    return spark.createDataFrame(rows + [(seq0 + 900, "bad", "no-address", "FR"), (seq0 + 901, None, "q@x.io", "FR")], SCHEMA)


def _tagged(df):
    return sorted((tuple(r) for r in df.select("seq", "reason").collect()), key=str)


def test_admission_equals_a_join_with_the_whole_table(spark, tmp):
    table = UniqueTable(f"{tmp}/t", buckets=16, bits_per_bucket=2048)
    batches = [[*range(0, 300), 5, None], [*range(250, 400)], [1000], [], [*range(390, 420), 1000, 7, 7]]
    for n, ids in enumerate(batches):
        batch = _batch(spark, ids, n * 1000)
        have = table.rows(spark) if n else spark.createDataFrame([], "email string")
        assert _tagged(table.admit(batch)) == _tagged(MS.admission(have, batch))
        out = table.append(batch)
        assert out["accepted"].count() + out["rejected"].count() == batch.count()
        first = [tuple(r) for r in out["accepted"].select("id", "email").orderBy("email").collect()]
        assert first == [tuple(r) for r in out["accepted"].select("id", "email").orderBy("email").collect()]  # ids are stored
    rows = table.rows(spark)
    assert rows.count() == rows.select("email").distinct().count() == 421
    assert rows.filter(~MS.is_uuid(F.col("id"))).count() == 0


def test_unknown_values_read_no_bucket(spark, tmp, monkeypatch):
    table = UniqueTable(f"{tmp}/t", buckets=16, bits_per_bucket=1 << 14)
    table.append(_batch(spark, range(400)))
    looks = []
    real = UniqueTable.known
    monkeypatch.setattr(UniqueTable, "known", lambda self, sp, buckets, now=None: looks.append(buckets) or real(self, sp, buckets, now))
    table.admit(_batch(spark, range(5000, 5040)))
    assert sum(map(len, looks)) <= 2                         # 40 unknown values: false positives only
    looks.clear()
    table.admit(_batch(spark, [3]))
    assert len(looks[0]) == 1
    known = real(table, spark, looks[0])
    assert len({f.rsplit("bucket=", 1)[1].split("/")[0] for f in known.inputFiles()}) == 1


def test_a_crash_before_the_commit_adds_nothing(spark, tmp, monkeypatch):
    table = UniqueTable(f"{tmp}/t", buckets=4, bits_per_bucket=1024)
    table.append(_batch(spark, range(10)))

    def crash(self, after, body):
        raise KeyboardInterrupt

    real = Manifests.commit
    monkeypatch.setattr(Manifests, "commit", crash)
    with pytest.raises(KeyboardInterrupt):
        table.append(_batch(spark, range(20)))
    monkeypatch.setattr(Manifests, "commit", real)
    assert table.rows(spark).count() == 10
    assert table.append(_batch(spark, range(20)))["accepted"].count() == 10


def test_old_members_keep_their_keys(spark, tmp):
    d = KeyDictionary(f"{tmp}/d", ["city", "country"], "city_key")
    make = lambda rows: spark.createDataFrame(rows, "city string, country string, x int")
    assert d.members(spark) is None
    one = {(r.city, r.country): r.city_key for r in d.load(make([("b", "Q", 1), ("c", "Q", 1), ("b", "Q", 2), (None, "Q", 1)])).collect()}
    assert one == {("b", "Q"): 1, ("c", "Q"): 2}
    two = {(r.city, r.country): r.city_key for r in d.load(make([("a", "Q", 1), ("b", "Q", 2), ("b", "P", 2)])).collect()}
    assert two == one | {("a", "Q"): 3, ("b", "P"): 4}
    version = Manifests(spark, f"{tmp}/d").latest()
    assert d.load(make([("a", "Q", 1)])).count() == 4 and Manifests(spark, f"{tmp}/d").latest() == version
    assert sorted((r.x, r.city_key) for r in d.keyed(make([("b", "P", 9), ("zz", "P", 8)])).collect()) == [(9, 4)]


def test_a_load_that_crashed_can_be_repeated(spark, tmp, monkeypatch):
    d = KeyDictionary(f"{tmp}/d", ["city"], "k")
    df = spark.createDataFrame([("a",), ("b",)], "city string")
    real = Manifests.commit
    monkeypatch.setattr(Manifests, "commit", lambda self, after, body: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        d.load(df)
    monkeypatch.setattr(Manifests, "commit", real)
    assert d.members(spark) is None
    assert sorted(tuple(r) for r in d.load(df).collect()) == [(1, "a"), (2, "b")]

"""Personal data: base spans against the patterns, the field on held-out
documents and on spellings that the patterns miss."""

import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conftest import SF_MID
from quarry.llm import personal_data as P
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def check_digits(s):
    d = [int(c) for c in s if c.isdigit()][::-1]
    return 13 <= len(d) <= 19 and sum(x if k % 2 == 0 else sum(divmod(2 * x, 10)) for k, x in enumerate(d)) % 10 == 0


def by_pattern(text):
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if check_digits(m.group())]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15]
    return out


def base(texts):
    return [[s[:3] for s in r if s[3]] for r in P.spans_of(pa.array(texts, pa.string()), None)]


def test_base_spans_equal_the_patterns(rng):
    bits = ["a", "Zo", "é", "日", ".", "..", "-", "@", "+", " ", "\n", "(", ")", "7", "12", "255", "256", "007", "1.2.3.4", "+1 (017) 555-7713",
            "4111 1111 1111 1111", "4111-1111-1111-1111", "4845168114407329", "x@y.z", "_", "%", "@b.c", "1" * 30, "mail3.example.com", "\r", "٣"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(6000)]
    texts += ["", "@", "a@b.c@d.e", "+1" + "(" * 5000, "9" * 9000, "1.2.3.4.5.6.7.8.9", "é+1234567890", "1.1.1.1 1.1.1.1", "a" * 9000 + "@b.c"]
    for text, got in zip(texts, base(texts)):
        assert got == by_pattern(text), text


def test_long_texts_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000 + ".", "@" * 300_000, "+1(" * 300_000, "1.1" * 300_000, "a@" * 300_000):
        assert P.spans_of(pa.array([text]), None) is not None


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").filter("doc_id % 3 != 0")
    return P.label_table(docs).cache()


@pytest.fixture(scope="module")
def field(labelled):
    return P.train(labelled)


def test_labelled_table_is_small_and_true(labelled):
    rows = labelled.collect()
    assert 100 < len(rows) <= 5000
    assert {s["kind"] for r in rows for s in r["spans"]} == set(P.KINDS)
    assert all(0 <= s["start"] < s["end"] <= len(r["line"]) for r in rows for s in r["spans"])


def test_field_finds_other_spellings_in_held_out_documents(spark, field):
    docs = [r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").filter("doc_id % 3 = 0").select("text").collect()]
    hit = miss = wrong = 0
    for text in docs:
        for k, a, b in base([text])[0]:
            for way in range(8):
                new, real = P.rewritten(k, text[a:b], way)
                part = text[max(a - 100, 0):a] + new + text[b:b + 100]
                lo = min(a, 100)
                added = [s for s in P.spans_of(pa.array([part]), field)[0] if not s[3]]
                mine = [s for s in added if s[1] < lo + len(new) and lo < s[2]]
                if real:
                    good = any(s[:3] == (k, lo, lo + len(new)) for s in mine)
                    hit, miss = hit + good, miss + (not good)
                else:
                    wrong += len(mine)
    print("other spellings found", hit, "missed", miss, "look-alikes flagged", wrong)
    assert hit + miss > 100 and hit >= 0.8 * (hit + miss) and wrong <= 0.05 * (hit + miss)


def test_clean_documents_are_left_alone(spark, field):
    docs = [r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").select("text").collect()]
    clean = [t for t, b in zip(docs, base(docs)) if not b]
    assert len(clean) > 500
    assert sum(len(r) for r in P.spans_of(pa.array(clean), field)) == 0


def test_query_keeps_base_spans(spark, labelled):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    texts = dict(docs.select("doc_id", "text").collect())
    for r in P.report(P.find_personal_data(docs, labelled=labelled)).collect():
        want = by_pattern(texts[r["doc_id"]])
        line = ",".join(f"{P.KINDS[k]}:{a}:{b}" for k, a, b in want)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in P.KINDS] == [sum(w[0] == n for w in want) for n in range(4)]
        every = [s for s in r["spans"].split(",") if s]
        assert set(line.split(",")) - {""} <= set(every)
        assert every == sorted(every, key=lambda s: (P.KINDS.index(s.split(":")[0]), int(s.split(":")[1])))


def test_edge_tables(spark, edge_docs, no_docs):
    got = P.find_personal_data(edge_docs)
    assert got.columns == ["doc_id", "text", "spans"] and got.count() == edge_docs.count()
    rows = P.report(got).collect()
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in rows)
    assert P.report(P.find_personal_data(no_docs)).collect() == []


def test_masked(spark, labelled):
    rows = [(1, "é jo@a.b.c, 日 1.2.3.4 end"), (2, None), (3, "none"), (4, "no. 4111 1111 1111 1111")]
    got = P.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), labelled=labelled.limit(0))
    out = dict(got.select("doc_id", P.masked(F.col("text"), F.col("spans"))).collect())
    assert out == {1: "é <email>, 日 <ip> end", 2: None, 3: "none", 4: "no. <card>"}

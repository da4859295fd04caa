"""Operator 4: forward-backward, training and edge cases."""

import itertools

import pytest
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from quarry.llm.folds import by_hash_each
from quarry.llm.langid import Chains, Tagger, chains_of, detect_language, language_shares, word_features
from quarry.llm.text import flat_bytes
from llm_fixtures import edge_docs, no_docs  # noqa: F401

SF = "/root/testdata/sf0.01"


def test_forward_backward_equals_enumeration():
    r = np.random.default_rng(3)
    emission, trans = r.normal(size=(9, 3)), r.normal(size=(3, 3))
    starts, sizes = np.array([0, 4, 5]), np.array([4, 1, 4])
    post, counts, logz = Chains(starts, sizes).posteriors(emission, trans, pairs=True)
    want, pairs, total = np.zeros((9, 3)), np.zeros((3, 3)), 0.0
    for a, n in zip(starts, sizes):
        weight = {p: np.exp(sum(emission[a + i, y] for i, y in enumerate(p)) + sum(trans[x, y] for x, y in zip(p, p[1:])))
                  for p in itertools.product(range(3), repeat=n)}
        z = sum(weight.values())
        total += np.log(z)
        for p, w in weight.items():
            for i, y in enumerate(p):
                want[a + i, y] += w / z
            for x, y in zip(p, p[1:]):
                pairs[x, y] += w / z
    assert np.allclose(post, want) and np.allclose(counts, pairs) and np.isclose(logz, total)


def test_features_do_not_depend_on_the_neighbours():
    data, off = flat_bytes(pa.array(["alpha be gamma", "be"]))
    starts, ends, first, begin, size = chains_of(data, off)
    bucket, n = word_features(data, starts, ends)
    cut = np.split(bucket, np.cumsum(n)[:-1])
    assert sorted(cut[1]) == sorted(cut[3]) and first.tolist() == [0, 3, 4] and n[1] < n[0]
    long = " ".join(["w"] * 200) + "\n" + "x y"
    _, _, _, begin, size = chains_of(*flat_bytes(pa.array([long])))
    assert size.tolist() == [64, 64, 64, 8, 2] and begin.tolist() == [0, 64, 128, 192, 200]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = detect_language(docs, max_docs=600, max_chains=3000).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert len(out) > 150 and (out.lang_pred == out.lang).mean() > 0.97 and got.score.between(0, 1).all()


def test_code_switching(spark):
    """Runs of two languages in one text get about their shares."""
    en, fr = ["the", "thing", "oned", "with"], ["le", "éoi", "queaux", "dans"]
    t = Tagger(["en", "fr"])
    t.fit([" ".join(en[i % 4] for i in range(k, k + 8)) for k in range(40)] + [" ".join(fr[i % 4] for i in range(k, k + 8)) for k in range(40)],
          [0] * 40 + [1] * 40)
    share, n = t.shares(pa.array(["the thing oned with the thing le éoi", "", None, "12 34"]), "test")
    assert n.tolist() == [8, 0, 0, 0] and abs(share[0, 0] - 6) < 0.6 and t.trans[0, 0] > t.trans[0, 1]


def test_edges(spark, edge_docs, no_docs):
    docs = edge_docs.withColumn("lang", edge_docs["id"])   # one language, "x"
    got = {}
    for r in detect_language(docs).collect():
        got.setdefault(r.doc_id, r)
    assert [got[i].lang_pred for i in (1, 2, 3, 9, 4)] == ["und"] * 4 + ["x"] and got[9].score == 0.0
    assert got[None].held_out is False and got[8].lang_pred == "x"
    none = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in detect_language(none).collect()} == {"und"}
    assert detect_language(no_docs).count() == 0
    assert {r.doc_id: r.shares for r in language_shares(docs).collect()}[9] == {}


def test_a_rare_language_is_learned(spark):
    """4 of 40,000 documents, far below one of the training sample."""
    words = {"aa": ["bada", "gode", "lemi", "rota", "sanu"], "bb": ["kwix", "pzyr", "vhoq", "xylk", "jwuz"],
             "cc": ["ødån", "æblø", "åræs", "økåm", "ætøl"]}
    lang = F.when(F.col("id") % 10_000 == 17, "cc").when(F.col("id") % 3 == 0, "bb").otherwise("aa")
    say = [F.concat_ws(" ", *[F.element_at(F.array(*[F.lit(x) for x in w]), (F.pmod(F.hash("id", F.lit(k)), F.lit(5)) + 1).cast("int"))
                              for k in range(8)]) for w in words.values()]
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), lang.alias("lang"),
                                      F.when(lang == "aa", say[0]).when(lang == "bb", say[1]).otherwise(say[2]).alias("text"))
    got = docs.join(detect_language(docs).filter("not held_out"), "doc_id")
    assert got.filter("lang = 'cc'").count() > 0 and got.filter("lang != lang_pred").count() == 0


def test_repeated_lines_do_not_enlarge_the_sample(spark):
    """100,000 equal lines in one document, and equal documents."""
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "aa").otherwise("bb").alias("lang"),
        F.when(F.col("id") % 3 == 0, F.lit("the same line")).otherwise(F.concat(F.lit("line "), F.col("id"))).alias("text"))
    junk = spark.createDataFrame([(90_000, "aa", "junk line here\n" * 100_000)], docs.schema)
    rows = docs.unionByName(junk)
    lines = rows.select("lang", F.explode(F.split("text", "\n")).alias("chain")).distinct()
    assert by_hash_each(lines, 6000, 60, "lang", "chain", "lang").count() <= 6500
    assert detect_language(rows, max_docs=500, max_chains=300).count() == 30_001


def test_many_labels_share_fewer_buckets():
    assert Tagger([str(k) for k in range(4)]).weight.nbytes < 1 << 23
    assert Tagger([str(k) for k in range(3000)]).weight.nbytes <= 128 << 20


def test_more_labels_than_the_bound_are_an_error(spark, monkeypatch):
    monkeypatch.setattr("quarry.llm.folds.MAX_VALUES", 3)
    docs = spark.range(9).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("lang"), F.lit("a text").alias("text"))
    with pytest.raises(ValueError, match="values of lang"):
        detect_language(docs)

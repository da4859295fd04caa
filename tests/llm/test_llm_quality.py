"""Operators 5 and 6."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import quality_rank
from quarry.llm.quality_rules import BASE_RULES, REPORT_SQL, RULES, cascade_order, judge, rule_report
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401

SF = "/root/testdata/sf0.01"


def brute(text):
    t = text or ""
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    tri = list(zip(w, w[1:], w[2:]))
    twice = {x for x in tri if tri.count(x) > 1} if len(tri) < 3000 else {x for x, n in __import__("collections").Counter(tri).items() if n > 1}
    covered = {i + k for i, x in enumerate(tri) if x in twice for k in range(3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


CASES = ["", None, " \n\t", "a", "a b c a b c", "x " * 60, "one\ntwo\none\n \n \none", "a,b #* <é> 日本 |", "a b a b a b a b",
         "  lead and trail  ", "\x0b\x0c", "A B C " * 20, "1 2 3 4 5 6 1 2 3 9 4 5 6"]


def test_report_equals_brute_force(spark, edge_docs):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(100 + i, r.text) for i, r in enumerate(edge_docs.select("text").collect())]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in rule_report(df).collect()}
    for i, t in rows:
        r = got[i]
        want = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, repr((t or "")[:60])
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_report_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    want = sorted(map(tuple, con.execute(REPORT_SQL).fetchall()))
    assert sorted(map(tuple, rule_report(spark.read.parquet(f"{SF}/documents.parquet")).collect())) == want


def test_the_order_does_not_change_the_verdict(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    rules = BASE_RULES + RULES
    kept = [sorted(r.doc_id for r in judge(df, order).filter("kept").select("doc_id").collect())
            for order in (rules, rules[::-1])]
    assert kept[0] == kept[1] and 0 < len(kept[0]) < 400
    named = [r.name for r in cascade_order(df.select(F.col("text").alias("__text")), rules)]
    assert sorted(named) == sorted(r.name for r in rules)


def test_clashing_names_and_empty_tables(spark, edge_docs, no_docs):
    out = judge(edge_docs, eager=("n_words",))
    assert out.columns == [*edge_docs.columns, "n_words_", "kept_"]
    assert {r.doc_id: r.kept_ for r in out.collect()}[4] is False
    assert judge(no_docs).count() == 0 and rule_report(no_docs).count() == 0


def test_no_python_on_the_main_path(spark):
    plan = rule_report(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ------------------------------------------------------------------ ranking
def test_held_out_ranking(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rank.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    out = got[got.held_out]
    assert len(out) > 50 and (out.predicted == out.quality).mean() > 0.95
    good, bad = out.score[out.quality == 1].to_numpy(), out.score[out.quality == 0].to_numpy()
    assert (good[:, None] > bad[None, :]).mean() > 0.98
    assert ((got.score >= 0.7) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_held_out_labels_are_not_read(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality"))
                                .otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id, r.score) for r in quality_rank.quality_scores(docs, x).collect()) for x in (labels, flipped))
    assert a == b


def test_newton_finds_the_minimum(rng):
    r = np.random.default_rng(1)
    x = r.normal(size=(400, len(quality_rank.FEATURES)))
    label = (x[:, 0] + 0.5 * x[:, 1] + 0.3 * r.normal(size=400) > 0).astype(int)
    m = quality_rank.PairwiseModel(x, label, 4000)
    s = m.score(x)
    assert (s[label == 1][:, None] > s[label == 0][None]).mean() > 0.95
    assert abs(m.weight[1] / m.weight[0] - 0.5) < 0.15 and np.abs(m.weight[3:]).max() < 0.3 * m.weight[0]


@pytest.mark.parametrize("rows", [[], [(1, 1)], [(1, 0), (2, None), (3, 7)]])
def test_ranking_edges(spark, edge_docs, no_docs, rows):
    labels = spark.createDataFrame(rows, "doc_id long, quality int")
    got = quality_rank.quality_scores(edge_docs, labels).collect()
    assert len(got) == edge_docs.count() and all(0 <= r.score <= 1 and r.predicted == 0 for r in got)
    assert quality_rank.quality_scores(no_docs, labels).count() == 0

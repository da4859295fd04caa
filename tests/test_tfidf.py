"""TF-IDF as a table: counts, repeated and null ids, one shuffle of the words."""

import math

from quarry.operators import features as FE


def _df(spark):
    return spark.createDataFrame([(1, ["a", "b", "a"]), (1, ["a"]), (2, ["b", None]), (None, ["a", ""]), (3, None)],
                                 "doc_id long, words array<string>")


def test_counts_with_repeated_and_null_ids(spark):
    rows = {(r.doc_id, r.term): (r.tf, r.df, round(r.idf, 9)) for r in FE.tfidf(_df(spark), "doc_id", "words").collect()}
    idf = {k: round(math.log(4 / (k + 1)), 9) for k in (1, 2)}
    assert rows == {(1, "a"): (3, 2, idf[2]), (1, "b"): (1, 2, idf[2]), (2, "b"): (1, 2, idf[2]),
                    (None, "a"): (1, 2, idf[2]), (None, ""): (1, 1, idf[1])}


def test_words_are_shuffled_once_and_not_joined(spark):
    t = FE.tfidf(_df(spark), "doc_id", "words")
    plan = t._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning(term#") == 1

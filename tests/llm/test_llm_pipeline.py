"""The pipeline, stage by stage, against brute force on the smallest tables."""

import collections
import re

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
import tiktoken

import __spark_entry__ as E
import corpus_pipeline
from quarry.llm.bpe_codec import read_ranks
from quarry.llm.common import file_bytes, stored, table
from quarry.llm.queries import QUERIES, SQL
from test_llm_jaccard import all_pairs
from test_llm_quality import brute

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, read from Parquet."""
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return [{r.doc_id: r for r in d.collect()} for d in out], [d.columns for d in out]


def good(text):
    n, chars, symbols, dup, repeated = brute(text)
    lines = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
    upper = sum(c.isupper() for c in text)
    return (n >= 50 and 100 * repeated <= 50 * n and 3 * n <= chars <= 10 * n and 100 * symbols <= 10 * n
            and 100 * dup <= 50 * lines and 100 * upper <= 40 * chars)


def test_stages_in_order(stages):
    rows, columns = stages
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "ngram_jaccard_join", "substring_dedup",
                                                      "benchmark_decontamination", "byte_level_bpe"]
    assert all(c == COLUMNS for c in columns[:-1]) and all(set(b) <= set(a) for a, b in zip(rows, rows[1:]))


def test_quality_stage(stages):
    (raw, kept, *_), _ = stages
    assert set(kept) == {i for i, r in raw.items() if good(r.text)}


def test_one_document_of_each_group_stays(stages):
    (_, before, after, *_), _ = stages
    want = {i for i, _, c in all_pairs([(i, r.text) for i, r in before.items()], 5, 80) if i == c}
    assert set(after) == want


def test_no_long_passage_is_left_twice(stages):
    (_, _, before, after, *_), _ = stages
    def windows(rows):
        held = collections.defaultdict(set)
        for i, r in rows.items():
            w = r.text.split()
            for k in range(len(w) - 54):
                held[tuple(w[k:k + 55])].add(i)
        return [x for x in held.values() if len(x) > 1]
    assert windows(after) == []
    assert all(r.n_chars == len(r.text) for r in after.values())
    shared = {i for x in windows(before) for i in x}
    changed = {i for i in before if i not in after or after[i].text != before[i].text}
    assert not shared or changed


def test_leaks_go(spark, stages):
    (*_, before, after, _), _ = stages
    norm = lambda t: " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())) + " "
    items = [norm(r.text) for r in table(spark, SF, "benchmark").collect()]
    leaks = {i for i, r in before.items() if any(x in norm(r.text) for x in items)}
    gone = set(before) - set(after)
    assert leaks <= gone and len(gone - leaks) <= 0.01 * len(before)


def test_ids_decode_to_the_text(stages):
    (*_, before, after), _ = stages
    ranks = read_ranks(file_bytes(P.path("byte_bpe_multi_50k.tiktoken")))
    e = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    assert all(r.ids == e.encode_ordinary(before[i].text) and r.n_tokens == len(r.ids) for i, r in after.items())


def test_run_is_the_stages(spark, stages):
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()} == {
        i: r.n_tokens for i, r in stages[0][-1].items()}


def test_registration():
    q = E.queries()
    assert q["pipeline"] is corpus_pipeline.run and {f"op{n}_" for n in range(1, 14)} == {
        re.match(r"op\d+_", k)[0] for k in QUERIES} and set(QUERIES) <= set(q) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_table(spark, name):
    got = QUERIES[name](spark, SF)
    rows = got.count()
    if name.startswith("op13"):  # the best 50 of each item
        ranks = got.groupBy("item_id").agg(F.sort_array(F.collect_list("rank")).alias("ranks")).collect()
        assert len(ranks) <= table(spark, SF, "benchmark").count() and all(r.ranks == list(range(1, len(r.ranks) + 1)) and len(r.ranks) <= 50 for r in ranks)
    else:
        assert name.startswith(("op7", "op8")) or rows == table(spark, SF, "documents").count()
    assert rows > 0

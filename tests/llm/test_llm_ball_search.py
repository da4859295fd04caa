"""Ranked search against scores of all pairs, and the bounds themselves."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quarry.llm import ball_search as B
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(B.TERM, low)


def brute(docs, items, k):
    """(item, rank, id, score) by every document and item."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in bags if c), sum(c.total() for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in bags:
            m = 100 - 50 + 50 * c.total() * n_docs // max(n_terms, 1)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in set(terms(text)) if t in c)
            if s > 0:
                found.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(docs, items, k):
    got = B.ranked_search(docs, items, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def corpus(rng, n):
    words = [f"{a}{b}" for a in ("ka", "Ünd", "zo", "9", "re") for b in ("n", "日", "st", "li", "mo", "7")]
    pick = lambda m: " ".join(rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=m))
    docs = [(i, pick(rng.randint(1, 40))) for i in range(n)]
    docs += [(n + i, docs[3][1]) for i in range(60)]  # many ties
    return docs, [(k, pick(rng.randint(1, 9)) + ".") for k in range(25)]


def test_equals_all_pairs(spark, rng, monkeypatch):
    docs, items = corpus(rng, 300)
    docs += [(None, "kan zost"), (None, None), (400, "kan zost"), (400, "kan zost"), (401, "")]
    items += [(90, None), (91, ""), (92, "!!"), (93, "unheard"), (94, docs[3][1]), (94, docs[3][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    i = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items, 7)
    assert run(d, i, 7) == want
    monkeypatch.setattr(B, "BLOCK", 100)  # several blocks of queries
    assert run(d, i.filter("item_id < 6"), 7) == [w for w in want if w[0] < 6]


def test_edge_tables(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "a b c word1"), (2, "日本語 text"), (3, None)], "item_id long, text string")
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    assert run(edge_docs, items, 50) == brute(rows, [tuple(r) for r in items.collect()], 50)
    assert run(no_docs, items, 5) == []
    assert run(edge_docs, items.limit(0), 5) == []
    with pytest.raises(ValueError):
        B.ranked_search(edge_docs, items, 0)


def batch(docs, block):
    src = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs], pa.int64()), pa.array([d[1] for d in docs], pa.string())], ["id", "text"])
    return list(B.counted([src], block))


def test_bounds_hold_and_prune(rng, monkeypatch):
    docs, items = corpus(rng, 1500)
    docs += [(9000 + i, "rest re7 " * 3) for i in range(700)]
    block = B.Block([t for _, t in items])
    held = pa.Table.from_batches(batch(docs, block)).combine_chunks().to_batches()[0]
    df = np.bincount(np.asarray(held.column("term").values), minlength=len(block.keys))
    total = int(np.asarray(held.column("n")).sum())
    weight = B.weights(len(docs), df)
    row, term, value = B.vectors(held, weight, len(docs), total)
    tree = B.BallTree(row, term, value, held.num_rows, leaf=16)
    dense = np.zeros((held.num_rows, len(block.keys)), np.int64)
    dense[row, term] = value
    for terms_ in block.terms:
        score = dense[:, terms_].sum(1)
        for (a, b, _, _), bound in zip(tree.node, tree.bounds(terms_)):
            assert score[tree.order[a:b]].max() <= bound
    tally = []
    monkeypatch.setattr(B, "BALL", 500)
    found = list(B.searched([held], block, weight, len(docs), total, 5, tally))[0].to_pydict()
    assert len(tally) == 5 and sum(t[0] for t in tally) < 0.8 * sum(t[1] for t in tally)  # subtrees stay closed
    for q, terms_ in enumerate(block.terms):
        top = sorted((-int(s), docs[j][0]) for j, s in enumerate(dense[:, terms_].sum(1)) if s > 0)[:5]
        assert sorted((-s, i) for x, i, s in zip(found["q"], found["id"], found["score"]) if x == q) == top


def test_whole_numbers_beyond_64_bits():
    n = np.array([10**9, 5], np.int64)
    got = B.contributions(np.array([3, 2], np.int64), n, 5 * 10**10, 10**13)
    want = [10**9 * t // (1000 * t + 20 * (50 + 50 * int(k) * 5 * 10**10 // 10**13)) for t, k in zip((3, 2), n)]
    assert got.tolist() == want

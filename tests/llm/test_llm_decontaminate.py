"""Operator 8: planted copies and paraphrases, the common subsequence, the
decomposition."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm import decontaminate
from quarry.llm.decontaminate import Benchmark, find_leaks, latent_words, lcs, masks_of, remove_leaks, sketch
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401

VOCAB = [f"{a}{b}{c}" for a in "bdfgklmprs" for b in ("a", "en", "ou", "i") for c in ("st", "ri", "x", "tion", "mo", "")]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 6), max_size=30))
def test_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    assert lcs(masks_of(np.array(a, int)), len(a), b) == table[-1][-1]


def test_single_pass_decomposition(rng):
    """At full width the vectors span the TF-IDF Gram matrix exactly."""
    r = np.random.default_rng(2)
    block = np.sort(r.integers(0, 40, 200))
    word = r.integers(0, 12, 200)
    omega = r.standard_normal((12, 12))
    df, z = sketch(block, word, omega)
    tf = np.zeros((40, 12))
    np.add.at(tf, (block, word), 1)
    assert np.allclose(z, tf.T @ (tf @ omega)) and df.tolist() == (tf > 0).sum(0).tolist()
    e = latent_words(df, 40, z, np.zeros_like(z), omega, 12)
    idf = np.log(41 / (df + 1)) + 1e-3
    assert np.allclose(e @ e.T, np.diag(idf**2), atol=1e-4)   # an orthonormal basis of all 12 words


def plant(rng):
    say = lambda n: " ".join(rng.choices(VOCAB, k=n))
    items = [(k, say(rng.randint(18, 50)) + ". " + say(6) + ".") for k in range(40)]
    docs, want = [], set()
    for i in range(300):
        text = say(rng.randint(20, 400))
        if i % 5 == 0:
            k = i % 40
            item = items[k][1].upper() if i % 3 == 0 else items[k][1].replace(" ", "\n", 1)
            text, want = f"{text} {item} {say(rng.randint(0, 60))}", want | {(i, k)}
        elif i % 5 == 1:                                     # a paraphrase: one word in six is another one
            k = (i + 7) % 40
            w = items[k][1].split()
            w = [rng.choice(VOCAB) if rng.random() < 1 / 6 and p < len(w) - 6 else x for p, x in enumerate(w)]
            text, want = f"{say(rng.randint(0, 60))} {' '.join(w)} {text}", want | {(i, k)}
        docs.append((i, text))
    return items, docs, want


def test_planted_leaks_are_found_and_clean_documents_are_not(spark, rng):
    items, docs, want = plant(rng)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in find_leaks(d, b).collect()}
    copies = {(i, k) for i, k in want if i % 5 == 0}
    assert copies <= set(got) and len(want - set(got)) <= 0.05 * len(want) and not set(got) - want
    assert all(got[x].share == 1.0 and got[x].answer_found for x in copies)
    left = {r.doc_id for r in remove_leaks(d, b).collect()}
    assert left == {i for i, _ in docs} - {i for i, _ in got}


def test_edges(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "a b c d e"), (2, None), (3, ""), (4, "!!!"), (5, "a b c d e"), (None, "Naïve 日本語 text with spaces and")],
                                  "item_id long, text string")
    got = sorted((r.doc_id, r.item_id or 0) for r in find_leaks(edge_docs, items).collect())
    assert got == [(8, 0), (10, 1), (10, 5), (11, 1), (11, 5)]
    assert find_leaks(no_docs, items).count() == 0 and find_leaks(edge_docs, items.limit(0)).count() == 0
    assert remove_leaks(edge_docs, items).columns == edge_docs.columns
    assert sorted(r.doc_id or 0 for r in remove_leaks(edge_docs, items).collect()) == [0, 1, 2, 3, 4, 5, 5, 6, 7, 9]


def test_answers_and_common_words():
    b = Benchmark([1, 2], ["One two three. Four five six seven.", "two"])
    hashes = {w: int(x[0]) for w, x in zip(["t"], [b.items[1]])}
    assert [len(x) for x in b.items] == [7, 1] and [len(a) for a in b.answers] == [4, 1] and hashes["t"] in b.items[0]
    assert b.tokens(pa.array(["", "two"]))[2].tolist() == [0, 0, 1]


def test_items_longer_than_a_window(spark, rng):
    """Copies and paraphrases (one word in five is another one) of items of
    59 to 1,000 words, anywhere in a document."""
    say = lambda n: " ".join(rng.choices(VOCAB, k=n))
    items = [(k, say(n - 6) + ". " + say(6) + ".") for k, n in enumerate([59, 100, 130, 150, 300, 1000] * 4)]
    docs, want = [], set()
    for i in range(96):
        w = items[i % 24][1].split()
        if i % 3 == 0:
            w = [rng.choice(VOCAB) if p < len(w) - 6 and rng.random() < 0.2 else x for p, x in enumerate(w)]
        docs.append((i, f"{say(rng.randint(0, 90))} {' '.join(w)} {say(rng.randint(0, 90))}"))
        want.add((i, i % 24))
    docs += [(i, say(1200)) for i in range(96, 140)]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id): r for r in find_leaks(d, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert set(got) == want
    assert all(got[x].share == 1.0 and got[x].answer_found for x in want if x[0] % 3)


def test_exact_copies_do_not_depend_on_the_rank(spark, rng):
    items, docs, want = plant(rng)
    items += [(40, "zzone"), (41, "zztwo zzthree")]
    docs += [(300, "some zzone " * 30), (301, "a zztwo zzthree b")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = {(r.doc_id, r.item_id) for r in find_leaks(d, spark.createDataFrame(items, "item_id long, text string"), rank=1, min_cosine=2.0).collect()}
    assert {(i, k) for i, k in want if i % 5 == 0} | {(300, 40), (301, 41)} <= got <= want | {(300, 40), (301, 41)}


def test_memory_follows_vocabulary_and_items():
    few, many = (Benchmark(list(range(n)), [f"word{k} of item{k} and more" for k in range(n)]) for n in (10, 1000))
    assert many.memory(48) > 50 * few.memory(48) >= 50 * 48 * 56 * 23


def test_a_large_benchmark_is_searched_in_parts(spark, rng, monkeypatch):
    items, docs, want = plant(rng)
    d = spark.createDataFrame(docs + [(None, docs[0][1]), (0, "clean words only")], "doc_id long, text string").repartition(4)
    b = spark.createDataFrame(items, "item_id long, text string")
    one = {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()}
    seen, real = [], decontaminate._latent
    monkeypatch.setattr(decontaminate, "_latent", lambda *a: seen.append(len(a[1].items)) or real(*a))
    monkeypatch.setattr(decontaminate, "BENCHMARK_BYTES", sum(len(t) for _, t in items) // 2)
    monkeypatch.setattr(decontaminate, "MEMORY_BYTES", Benchmark([i for i, _ in items[:9]], [t for _, t in items[:9]]).memory(48))
    got = {(r.doc_id, r.item_id) for r in find_leaks(d, b).collect()}
    assert len(seen) > 2 and sum(seen) == len(items)
    copies = {(i, k) for i, k in want if i % 5 == 0}
    assert copies <= got and len(got ^ one) <= 0.05 * len(one)
    left = sorted((r.doc_id is None, r.doc_id, r.text) for r in remove_leaks(d, b).collect())
    bad = {i for i, _ in got}
    assert left == sorted((i is None, i, t) for i, t in docs + [(0, "clean words only")] if i not in bad or t == "clean words only")


def test_sums_do_not_depend_on_the_run(spark, rng):
    """A task that is run again sends its sums to the same reducer."""
    items, docs, _ = plant(rng)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    b = spark.createDataFrame(items, "item_id long, text string")
    runs = [sorted(tuple(r) for r in find_leaks(d, b).collect()) for _ in range(2)]
    assert [r[:2] + r[3:] for r in runs[0]] == [r[:2] + r[3:] for r in runs[1]]

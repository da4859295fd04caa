"""Operator 2 against all pairs, on fixtures around the threshold."""

import re
from hashlib import blake2b

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quarry.llm.components import components
from quarry.llm.jaccard_join import block_keys, near_duplicates, prefix_keys, size_bands, slack, without_copies
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1)) if len(w) >= width else frozenset([tuple(w)] if w else [])


def all_pairs(rows, width, percent):
    """(id, n, component) by comparing everything with everything."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    part = list(range(len(sets)))

    def root(x):
        while part[x] != x:
            x = part[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                part[root(a)] = root(b)
    least = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            least[root(k)] = min(least.get(root(k), i), i)
    return sorted((i or 0, len(s), least.get(root(k), i) if s else i) for k, (i, s) in enumerate(sets))


def run(spark, rows, width, percent, **k):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_duplicates(df, width, percent, **k).collect())


def near_copies(rng, groups, copies, words, edits):
    vocab = [f"w{i}" for i in range(4000)]
    rows = []
    for _ in range(groups):
        base = rng.choices(vocab, k=words)
        for _ in range(copies):
            t = list(base)
            for _ in range(rng.randint(0, edits)):
                t[rng.randrange(len(t))] = rng.choice(vocab)
            rows.append((len(rows) * 3, " ".join(t)))
    rng.shuffle(rows)
    return rows


def test_equal_to_all_pairs(spark, rng):
    rows = near_copies(rng, 4, 40, 120, 9) + [(10_000 + i, " ".join(rng.choices("abcdefgh", k=rng.randint(1, 12)))) for i in range(150)]
    rows += [(20_000, None), (20_001, ""), (20_002, " \n"), (20_003, "One two"), (20_004, "one  TWO"), (20_005, "one two three")]
    assert run(spark, rows, 4, 85) == all_pairs(rows, 4, 85)
    assert run(spark, rows, 5, 80, rare=2) == all_pairs(rows, 5, 80)


def test_frequent_tokens_are_combined(spark, rng):
    """One shared passage in all texts and one large group of near copies."""
    passage = " ".join(f"p{i}" for i in range(60))
    rows = near_copies(rng, 1, 120, 80, 6)
    rows = [(i, f"{passage} {t}" if i % 2 else t) for i, t in rows]
    rows += [(5000 + i, passage + " " + " ".join(rng.choices([f"z{k}" for k in range(900)], k=rng.randint(0, 25)))) for i in range(80)]
    assert run(spark, rows, 4, 85, rare=4) == all_pairs(rows, 4, 85)


@settings(max_examples=120, deadline=None)
@given(st.integers(2, 60), st.integers(0, 12), st.integers(1, 6), st.randoms(use_true_random=False))
def test_linked_texts_share_a_key(n, extra, rare, rnd):
    """Sets in random counts: whenever two link, they have a key in common."""
    base = rnd.sample(range(1, 10_000), n + 40)
    x, y = set(base[:n]), set(base[extra // 2:n + extra - extra // 2])
    count = {t: rnd.choice([1, 2, 3, rare, rare + 1, 500]) for t in base}
    for t in x & y:
        count[t] = max(count[t], 2)

    def keys(s):
        held = sorted((count[t], t) for t in s if count[t] > 1)
        return set(prefix_keys(np.array([t for _, t in held], np.int64), np.array([c for c, _ in held], np.int32),
                               len(s), 80, rare).tolist())

    lonely = {t for t in x ^ y if count[t] == 1}
    if 100 * len(x & y) >= 80 * len(x | y) and x != y:
        assert lonely <= x ^ y and keys(x) & keys(y)


@settings(max_examples=200, deadline=None)
@given(st.integers(2, 300), st.integers(0, 70), st.integers(0, 70), st.sampled_from([80, 85, 100]), st.integers(0, 2), st.randoms(use_true_random=False))
def test_linked_texts_share_an_extended_key(n, left, right, percent, seed, rnd):
    """Also when tokens of one text only are left out of its keys."""
    tokens = rnd.sample(range(-(1 << 60), 1 << 60), n + left + right)
    x, y = set(tokens[:n + left]), set(tokens[:n] + tokens[n + left:])
    if 100 * len(x & y) >= percent * len(x | y):
        alone = set(rnd.sample(sorted(x ^ y), len(x ^ y) // 2))
        bands = size_bands(percent)
        keys = [set(block_keys(np.array(sorted(s - alone), np.int64), len(s), percent, bands, seed).tolist()) for s in (x, y)]
        assert keys[0] & keys[1]


def test_size_bands_hold_linked_sizes():
    for percent in (50, 80, 85, 100):
        first = size_bands(percent, 100_000)
        for k in range(len(first) - 2):
            assert 100 * (first[k + 1] - 1) // percent < first[k + 2]


def paragraphs(rng, texts, of=30, take=10):
    """Texts made of shared paragraphs in any order: all tokens frequent,
    hardly any links."""
    pars = [" ".join(f"p{k}w{i}" for i in range(20)) for k in range(of)]
    rows = [" ".join(rng.sample(pars, take)) for _ in range(texts)]
    near = [r.replace("w7 ", "w7x ", 1) for r in rows[:texts // 20]]
    return list(enumerate(rows + near))


def test_hot_keys_are_extended(spark, rng):
    """Hot keys give the links of all pairs, however low the limit."""
    rows = paragraphs(rng, 300)
    want = all_pairs(rows, 4, 85)
    assert len({c for _, _, c in want}) < len(rows)
    for hot in (1, 8, 10_000):
        assert run(spark, rows, 4, 85, hot=hot) == want
    rows = near_copies(rng, 3, 30, 60, 8)
    assert run(spark, rows, 5, 80, hot=1) == all_pairs(rows, 5, 80)


def test_pairs_under_keys_do_not_grow_as_the_square(rng):
    """Pairs that meet under the extended keys of the paragraph corpus: far
    fewer than all pairs, of which the plain keys give more than one each."""
    from collections import Counter
    for texts in (500, 2000):
        met = Counter()
        for _, t in paragraphs(rng, texts):
            s = np.array(sorted(int.from_bytes(blake2b(" ".join(g).encode(), digest_size=8).digest(), "big", signed=True)
                                for g in shingles(t, 4)), np.int64)
            met.update(block_keys(s, len(s), 85, size_bands(85), 0).tolist())
        assert sum(c * (c - 1) // 2 for c in met.values()) < texts * 20


def test_slack_is_one_more_than_a_link_can_miss():
    for percent in (80, 85):
        for n in range(1, 300):
            assert slack(n, percent) == n - -(-percent * n // 100) + 1


def test_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in near_duplicates(edge_docs, 4, 85).collect())
    want = all_pairs(rows, 4, 85)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g for g in got if g[0]] == [w for w in want if w[0]] and got[0][2] is None
    assert near_duplicates(no_docs).count() == 0


def test_components_of_paths_and_hubs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(200, 400)] + [(5, 5), (900, 901), (901, 900), (901, 902)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[k] == 7 for k in range(200, 400)) and got[7] == 7
    assert got[900] == got[901] == got[902] == 900 and got.get(5, 5) == 5
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_report_equals_its_sql(spark):
    import duckdb

    from quarry.llm.jaccard_join import REPORT_SQL
    path = "/root/testdata/sf0.001/documents.parquet"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{path}')")
    want = sorted(map(tuple, con.execute(REPORT_SQL).fetchall()))
    assert sorted(map(tuple, near_duplicates(spark.read.parquet(path), 4, 85).collect())) == want


def test_rows_with_null_ids_link_like_any_other(spark, rng):
    base = [f"w{k}" for k in range(200)]
    near = lambda *at: " ".join("x" if k in at else w for k, w in enumerate(base))
    rows = [(7, near()), (5, near(0, 1)), (None, near(199)), (None, near(199)), (None, "all alone " * 9), (3, "other words " * 7)]
    assert run(spark, rows, 5, 80) == all_pairs(rows, 5, 80)
    # the only bridge between two rows is one without an id
    rows = [(1, near(*range(0, 16))), (None, near()), (2, near(*range(184, 200)))]
    got = run(spark, rows, 4, 80)
    assert got == all_pairs(rows, 4, 80) and len({c for _, _, c in got}) == 1


def test_one_row_of_each_group_stays(spark, rng):
    """Repeated and null ids, repeated rows, texts without words."""
    base = [f"w{k}" for k in range(120)]
    text, near, other = " ".join(base), " ".join(base[:-1] + ["x"]), "another text of its own " * 3
    rows = [(1, text), (1, text), (2, text), (None, text), (2, other), (3, near), (3, ""), (3, ""), (4, None), (None, "alone here"),
            (None, "alone here")]
    df = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, ID int").repartition(3)
    got = sorted(((r.doc_id or 0, r.text or "") for r in without_copies(df, 5, 80).collect()))
    assert got == sorted([(1, text), (2, other), (3, ""), (3, ""), (4, ""), (0, "alone here")])
    rows = near_copies(rng, 5, 12, 60, 8)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in without_copies(df, 5, 80).collect()} == {c for _, _, c in all_pairs(rows, 5, 80)}


def test_edges_without_copies(edge_docs, no_docs):
    left = without_copies(edge_docs, 5, 80)
    assert left.columns == edge_docs.columns and sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 8, 9, 10]
    assert without_copies(no_docs).count() == 0

"""Merkle manifest against a tree built node by node."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quarry.llm import merkle
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401

FIELDS = merkle.FIELDS
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (row[f] for f in FIELDS)])


def tree(nodes, fanout=3):
    """(root, siblings of each leaf from its level up as (left, right))."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, p in enumerate(at):
            lo = p // fanout * fanout
            paths[k].append(("".join(nodes[lo:p]), "".join(nodes[p + 1:lo + fanout])))
        nodes = [H(*nodes[i:i + fanout]) for i in range(0, len(nodes), fanout)]
        at = [p // fanout for p in at]
    return nodes[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subs = {}
    for s in order:
        groups[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        subs[s] = tree([leaf(r) for r in groups[s]])
    root, up = tree([subs[s][0] for s in order])
    out = []
    for s, above in zip(order, up):
        for r, path in zip(groups[s], subs[s][1]):
            path = path + above
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and text is not None:
                text = text.replace("\n", "")
            h = leaf({**r, "text": text})
            for left, right in path:
                h = H(left, h, right)
            proof = H(*[left + right for left, right in path])
            out.append((r["doc_id"], leaf(r), subs[s][0], root, proof, h, h == root))
    return sorted(out, key=str)


def run(df):
    got = merkle.tamper_report(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def test_equals_a_tree_built_by_hand(spark, rng, monkeypatch):
    monkeypatch.setattr(merkle, "BAND", 9)  # several bands over few rows
    rows = []
    for s, n in (("hot", 88), ("b", 27), ("Ä", 10), (None, 4), ("one", 1), ("", 3), ("a", 2)):
        for _ in range(n):
            text = rng.choice([None, "", "x\ny", "plain", "naïve 日本\n" * rng.randint(1, 3)])
            rows.append((rng.choice([None, *range(500)]), s, rng.choice([None, "en"]), rng.choice([None, 3]), text))
    rows += rows[:7]  # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    want = brute([dict(zip(FIELDS, r)) for r in rows])
    assert run(df) == want
    assert {r[-1] for r in want} == {True, False}


def test_sources_of_one_leaf(spark):
    rows = [(k, f"s{k:02d}", None, None, "a\nb") for k in range(12)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute([dict(zip(FIELDS, r)) for r in rows])
    alone = run(spark.createDataFrame([(1, "s", "en", 3, "abc")], SCHEMA))
    assert alone[0][1] == alone[0][2] == alone[0][3] and alone[0][6]


def test_edge_tables(spark, edge_docs, no_docs):
    add = lambda d: d.withColumn("source", F.lit("src").cast("string")).withColumn("n_chars", F.lit(None).cast("long"))
    rows = add(edge_docs).select(*FIELDS).collect()
    assert run(add(edge_docs)) == brute([r.asDict() for r in rows])
    assert run(add(no_docs)) == []


@pytest.mark.parametrize("fanout", [2, 5])
def test_a_change_of_any_leaf_shows(spark, fanout):
    df = spark.range(40).select(F.col("id"), (F.col("id") % 3).cast("string").alias("grp"),
                                merkle.leaf_hash([F.col("id")]).alias("leaf"), F.lit(1).alias("path_above"), F.lit(2).alias("g"))
    m = merkle.manifest(df, "id", "grp", fanout=fanout)
    assert m.columns == ["id", "grp", "leaf", "path_above", "g", "subroot", "root", "path"]
    got = m.select("root", merkle.fold(F.col("leaf"), F.col("path")).alias("true"),
                   merkle.fold(merkle.digest(F.col("leaf")), F.col("path")).alias("other")).collect()
    assert len(got) == 40 and all(r["true"] == r["root"] != r["other"] for r in got)

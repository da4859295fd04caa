"""Operator 3: rolling hash, chunks and planted passages."""

import numpy as np
import pyarrow as pa

from quarry.llm.substring import GEAR, _chunks, chunk_starts, cut_out, remove_repeats, rolling_hash
from quarry.llm.text import flat_bytes
from llm_fixtures import edge_docs, no_docs, rng  # noqa: F401

VOCAB = [f"{a}{b}{c}" for a in "bdfgklm" for b in ("a", "en", "ou") for c in ("st", "ri", "x", "tion")]


def words(rng, n):
    return " ".join(rng.choices(VOCAB, k=n))


def test_rolling_hash_is_the_gear_recurrence():
    data, h, want = bytes(range(1, 256)) * 2, 0, []
    for b in data:
        h = (h << 1) + int(GEAR[b]) & 0xFFFFFFFF
        want.append(h)
    assert rolling_hash(np.frombuffer(data, np.uint8)).tolist() == want


def test_chunks_do_not_shift(rng):
    """An insertion changes the chunks around it and no others; neighbours in
    the batch change nothing."""
    text = words(rng, 2000)
    other = text[:5000] + "INSERTED" + text[5000:]
    digests = lambda t: _chunks(pa.array(t))
    _, _, s, first, d = digests([text, other])
    a, b = set(d[first[0]:first[1]].tolist()), set(d[first[1]:].tolist())
    assert len(a ^ b) <= 8 and len(a & b) > 200
    alone = digests([other])[4]
    assert alone.tolist() == d[first[1]:].tolist()
    starts, f = chunk_starts(*flat_bytes(pa.array(["", "é" * 500, None, "x"])))
    assert f[0] == f[1] and f[2] == f[3] and all("é".encode() * 500 for _ in starts)


def test_planted_passages_go_and_the_rest_stays(spark, rng):
    passage = [words(rng, 55) for _ in range(20)]
    rows, clean = [], set()
    for i in range(400):
        if i % 4 == 0:
            p = passage[i % 20]
            rows.append((i, f"{words(rng, rng.randint(5, 90))}\n{p} {words(rng, rng.randint(5, 90))}"))
        else:
            clean.add(i)
            rows.append((i, words(rng, rng.randint(1, 200))))
    got = {r.doc_id: r for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert all(got[i].text == t and not got[i].removed for i, t in rows if i in clean)
    holders = [i for i, _ in rows if i not in clean]
    first = {i % 20: min(j for j in holders if j % 20 == i % 20) for i in holders}
    caught = [i for i in holders if i != first[i % 20] and got[i].removed]
    assert all(not got[i].removed for i in first.values())
    assert len(caught) >= 0.98 * (len(holders) - len(first))
    for i in caught:
        assert passage[i % 20] not in got[i].text
        text = dict(rows)[i].encode()
        spans = [(s.start, s.end) for s in got[i].removed]
        assert got[i].text == cut_out(text, spans) and all(text[a:b].decode() in f"{passage[i % 20]}" for a, b in spans)


def test_copies_and_edges(spark, edge_docs, no_docs):
    out = remove_repeats(edge_docs)
    assert out.columns[:-1] == edge_docs.columns and out.columns[-1] == "removed_spans"
    got = {}
    for r in out.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [r.text == "" for r in got[6]] == [True]          # a copy of an earlier document
    assert len(got[5]) == 2 and len({r.text for r in got[5]}) == 1 and got[5][0].text
    assert got[1][0].text is None and got[2][0].text == "" and got[None][0].text == "a text without id"
    assert got[11][0].text == "a b c d e"                    # too short to be a passage
    assert got[7][0]["start"] == 9
    assert remove_repeats(no_docs).count() == 0

"""Operators 1, 9 and 10 against the tokenizer libraries themselves."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quarry.llm import bpe_codec, token_count, token_store
from quarry.llm.bpe import merge_all, pairs_of
from quarry.llm.common import file_bytes, fresh_path
from llm_fixtures import edge_docs, no_docs  # noqa: F401

PIECES = ["a", "B", " ", "  ", "\n", "\t", "the", "hehe", "é", "é", "日本", "🙂", "▁", "Ａ", "<s>", "<unk>", "\x00", "\x1c", "\x85", " ",
          "ing", "'s", "'S", "İ", "ß", "Σ", "12", "!?", "_", "<|endoftext|>", "aaaa", "क्षि", "　"]


def mixed(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choices(PIECES, k=r.randint(0, 30))) for _ in range(n)]


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def byte_bpe():
    ranks = bpe_codec.read_ranks(file_bytes(P.path("byte_bpe_multi_50k.tiktoken")))
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def word_bpe():
    return Tokenizer.from_file(P.path("word_bpe_49k.json"))


def naive_merge(ranks, parts):
    """One best, leftmost merge at a time."""
    parts = list(parts)
    while True:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks), default=None)
        if best is None:
            return parts
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", min_size=2, max_size=4), unique=True, max_size=9), st.lists(st.text("ab", max_size=25), max_size=6))
def test_merges_equal_one_at_a_time(tokens, texts):
    """Any ranks, also those where a merge makes a pair of lower rank."""
    vocab = {t: i for i, t in enumerate(["a", "b", *tokens])}
    table = pairs_of(vocab, tokens, vocab)
    flat = np.array([vocab[c] for t in texts for c in t], np.int32)
    sym, _, left = merge_all(table, flat, np.array([len(t) for t in texts], np.int64))
    want = [naive_merge({t: vocab[t] for t in tokens}, t) for t in texts]
    assert left.tolist() == list(map(len, want))
    assert sym.tolist() == [vocab[p] for w in want for p in w]


def test_piece_counts_equal_the_library(pieces):
    m = token_count.PieceModel(file_bytes(P.path("piece_bpe_32k.model")))
    texts = mixed(3000) + ["", " ", " " * 300, "a" * 5000, "ab" * 3000]
    for t in texts:
        words = token_count.pretokens_of(t)
        assert (m.counts(words).sum() if words else 0) == len(pieces.encode(t)), repr(t)


def test_token_counts_edges(spark, edge_docs, no_docs, pieces):
    got = token_count.token_counts(edge_docs, P.path("piece_bpe_32k.model"), limit=10).collect()
    rows = edge_docs.select("doc_id", "text").collect()
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (r.doc_id or 0, len((r.text or "").encode()), n := len(pieces.encode(r.text or "")), n > 10) for r in rows)
    assert token_count.token_counts(no_docs, P.path("piece_bpe_32k.model")).count() == 0


def digests(encoder, text):
    ids = encoder.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_byte_bpe_equals_the_library(spark, edge_docs, no_docs, byte_bpe):
    path = P.path("byte_bpe_multi_50k.tiktoken")
    got = bpe_codec.encoded_digests(edge_docs, path, P.PATTERN).collect()
    want = [(r.doc_id or 0, *digests(byte_bpe, r.text)) for r in edge_docs.select("doc_id", "text").collect()]
    assert sorted((r[0] or 0, *r[1:]) for r in got) == sorted(want)
    assert bpe_codec.encoded_digests(no_docs, path, P.PATTERN).count() == 0
    docs = spark.createDataFrame(list(enumerate(mixed(2000, 2))), "doc_id long, text string").repartition(5)
    full = {r.doc_id: r for r in bpe_codec.encode_documents(docs, path, P.PATTERN).collect()}
    for i, t in enumerate(mixed(2000, 2)):
        assert (full[i].ids, bytes(full[i].decoded).decode()) == (byte_bpe.encode_ordinary(t), t), repr(t)


def test_a_hot_word_is_one_entry_per_block(spark, byte_bpe, monkeypatch):
    monkeypatch.setattr(bpe_codec, "BLOCK_BYTES", 2000)
    docs = spark.createDataFrame([(i, "hot " * 200 + f"w{i}") for i in range(40)], "doc_id long, text string").repartition(4)
    got = bpe_codec.encoded_digests(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    assert sorted(tuple(r) for r in got) == [(i, *digests(byte_bpe, "hot " * 200 + f"w{i}")) for i in range(40)]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=40))
def test_control_byte_code_round_trip(numbers):
    control, data = token_store.encode_ranks(np.array(numbers, np.uint32))
    assert token_store.decode_ranks(control, data, len(numbers)).tolist() == numbers
    assert len(data) == sum(max(1, (n.bit_length() + 7) // 8) for n in numbers) and len(control) == -(-len(numbers) // 4)


def test_frequent_ids_have_small_ranks():
    rank, order = token_store.rank_by_frequency(np.array([7, 7, 3, 3, 9, 7]))
    assert order.tolist() == [7, 3, 9] and rank.tolist() == [0, 0, 1, 1, 2, 0]


def stored(spark, docs):
    path = fresh_path(spark, "test-store")
    token_store.write_token_store(docs, path, P.path("word_bpe_49k.json"), 1)
    return token_store.read_token_store(spark, path)


def test_token_store_equals_the_library(spark, edge_docs, no_docs, word_bpe, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_BYTES", 20_000)
    texts = mixed(1500, 3)
    docs = spark.createDataFrame([(i * 7, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    at = 0
    for r, t in zip(sorted(stored(spark, docs).collect(), key=lambda r: r.id), texts):
        ids = word_bpe.encode(t, add_special_tokens=False).ids + [1]
        assert (r.start, r.n_tokens, r.token_ids) == (at, len(ids), ids), repr(t)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    edge = stored(spark, edge_docs).collect()
    want = sorted((r.doc_id or -1, len(word_bpe.encode(r.text or "", add_special_tokens=False).ids) + 1)
                  for r in edge_docs.select("doc_id", "text").collect())
    assert sorted((-1 if r.id is None else r.id, r.n_tokens) for r in edge) == want
    starts = sorted((r.start, r.n_tokens) for r in edge)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    assert stored(spark, no_docs).count() == 0


def test_rank_file_reader():
    assert bpe_codec.read_ranks(base64.b64encode(b"ab") + b" 5\n") == {b"ab": 5}

"""Edge cases that every operator has to take."""

import random

import pytest

LONG = " ".join(f"word{i % 977} of{i % 13}" for i in range(40_000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls, empty, blank, very long and repeated texts, a null id, and
    columns named like the operators' own."""
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (5, LONG), (6, LONG), (7, "x" * 50_000), (None, "a text without id"),
            (8, "naïve 日本語 text 🙂 with   spaces\n\nand <|endoftext|> <s>"), (9, "123 456 !!!"), (10, "a b c d e"), (11, "a b c d e")]
    clash = {"id": "x", "key": 1, "block": 2, "digest": "d", "n_tokens": -1, "n_words": -5, "kept": "no", "removed": 1,
             "tid": 3, "score": "s", "lang": "en", "component": 4, "__row": 0, "start": 9}
    return spark.createDataFrame([(i, t, *clash.values()) for i, t in rows],
                                 "doc_id long, text string, " + ", ".join(
                                     f"`{k}` {'string' if isinstance(v, str) else 'int'}" for k, v in clash.items()))


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)


@pytest.fixture
def rng():
    return random.Random(7)

"""The driver contract must import in a bare process: no JVM, no jars."""

import builtins
import importlib
import sys

from pyspark.ml.feature import StopWordsRemover

from quarry.operators.features import ENGLISH_STOP_WORDS


def test_entry_imports_without_files(monkeypatch):
    real = builtins.open

    def no_jars(f, *a, **k):
        assert not str(f).endswith(".jar")
        return real(f, *a, **k)

    monkeypatch.setattr(builtins, "open", no_jars)
    monkeypatch.setattr("glob.glob", lambda *a, **k: [])
    for m in [m for m in sys.modules if m == "__spark_entry__" or m.startswith("quarry.plans")]:
        monkeypatch.delitem(sys.modules, m)
    e = importlib.import_module("__spark_entry__")
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.queries()) > 60


def test_stop_words_are_the_library_default(spark):
    assert list(ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")


def test_entry_works_without_the_optional_part(monkeypatch):
    for m in [m for m in sys.modules if m.split(".")[0] == "corpus_pipeline" or m.startswith("quarry.llm")]:
        monkeypatch.delitem(sys.modules, m)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "quarry.llm", None)
    monkeypatch.delitem(sys.modules, "__spark_entry__", raising=False)
    e = importlib.import_module("__spark_entry__")
    from quarry.plans.catalog import QUERIES
    assert set(e.queries()) == set(QUERIES) and set(e.oracle_sql()) <= set(QUERIES)
    monkeypatch.delitem(sys.modules, "__spark_entry__")

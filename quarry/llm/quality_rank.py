"""Quality scores by Bradley-Terry pairwise ranking (operator 6).

Labelled documents give preference pairs (a document of label 1 is preferred
to one of label 0). The score is linear in document features; its weights
minimise the logistic loss of the pairs' feature differences, by Newton
steps. The threshold is the quantile of the training scores that separates
the labels best, and scores are put on a 0 to 1 scale on which it lies at
``CUT``.

The fit uses about ``max_rows`` labelled rows at most and ``max_pairs`` pairs,
both taken by hash or with a fixed seed; every document is scored on its
whole text, in Arrow batches without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import need
from quarry.llm.folds import by_hash, held_out
from quarry.llm.text import flat_bytes, mix, slices, span_hashes, word_spans

CUT = 0.7
_SYMBOLS, _STOPS = b"#*$%&|<>", b".,;:!?"


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int64)
    t[list(chars)] = 1
    return t


IS_SYMBOL, IS_STOP = _flags(_SYMBOLS), _flags(_STOPS)
IS_UPPER, IS_DIGIT, IS_HIGH = _flags(bytes(range(65, 91))), _flags(bytes(range(48, 58))), _flags(bytes(range(128, 256)))

FEATURES = ("words", "word_bytes", "symbols", "stops", "capitals", "digits", "high_bytes", "distinct_words", "top_word",
            "repeated_windows", "repeated_lines", "line_words")


def _per_text(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    return total[off[1:]] - total[off[:-1]]


def _line_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begins = np.unique(np.concatenate([np.flatnonzero(data == 10) + 1, off[:-1][np.diff(off) > 0]]))
    begins = begins[begins < len(data)]
    return begins, np.append(begins[1:], len(data)), np.searchsorted(begins, off)


def _copies(keys: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct keys, and occurrences of the most frequent one."""
    distinct, most = np.zeros(len(first) - 1), np.zeros(len(first) - 1)
    for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
        if b > a:
            s = np.sort(keys[a:b])
            edge = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1], [True]]))
            distinct[k], most[k] = len(edge) - 1, np.diff(edge).max()
    return distinct, most


def features(col) -> np.ndarray:
    """One row of ``FEATURES`` per text; an empty or null text is all zero."""
    data, off = flat_bytes(col)
    starts, ends, first = word_spans(data, off)
    n = np.diff(first).astype(float)
    safe, size = np.maximum(n, 1), np.maximum(np.diff(off), 1).astype(float)
    words = span_hashes(data, starts, ends)
    rate = lambda t, by: _per_text(t[data], off) / by
    distinct, top = _copies(words, first)
    tri = mix(words[:-2] * np.uint64(3) + words[1:-1] * np.uint64(5) + words[2:] * np.uint64(7)) if len(words) > 2 else words[:0]
    room = np.maximum(np.diff(first) - 2, 0)
    windows = np.concatenate([tri[a:a + r] for a, r in zip(first[:-1].tolist(), room.tolist())]) if len(room) else tri
    w_first = np.concatenate([[0], np.cumsum(room)])
    w_distinct, _ = _copies(windows, w_first)
    l_start, l_end, l_first = _line_spans(data, off)
    lines = np.diff(l_first).astype(float)
    l_distinct, _ = _copies(span_hashes(data, l_start, l_end), l_first)
    out = np.stack([
        np.log1p(n), _per_text(1 - (IS_STOP + 0)[data], off) / safe, np.log1p(100 * rate(IS_SYMBOL, safe)), np.log1p(10 * rate(IS_STOP, safe)),
        np.log1p(100 * rate(IS_UPPER, size)), np.log1p(100 * rate(IS_DIGIT, size)), rate(IS_HIGH, size),
        1 - distinct / safe, top / safe, 1 - w_distinct / np.maximum(room, 1) * (room > 0) - (room == 0),
        1 - l_distinct / np.maximum(lines, 1) - (lines == 0), np.log1p(n / np.maximum(lines, 1))], 1)
    out[:, 1] = np.where(n > 0, out[:, 1], 0)
    out[n == 0, 7] = 0
    return out


class PairwiseModel:
    """Weights, scale and threshold of the fitted score."""

    def __init__(self, x: np.ndarray, label: np.ndarray, max_pairs: int, ridge: float = 1e-3, seed: int = 7):
        self.mean = x.mean(0) if len(x) else np.zeros(len(FEATURES))
        self.scale = np.maximum(x.std(0), 1e-6) if len(x) else np.ones(len(FEATURES))
        self.weight, self.cut = np.zeros(len(FEATURES)), 0.0
        good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
        if not len(good) or not len(bad):
            self.cut = 1.0  # nothing to prefer: every score lies below the cut
            return
        z = (x - self.mean) / self.scale
        rng = np.random.default_rng(seed)
        d = z[rng.choice(good, max_pairs)] - z[rng.choice(bad, max_pairs)]
        w = self.weight
        for _ in range(25):  # Newton steps on log(1 + exp(-d.w)) + ridge/2 |w|^2
            p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
            step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + ridge * np.eye(len(w)),
                                   d.T @ p / len(d) - ridge * w)
            w = w + step
            if np.abs(step).max() < 1e-6:
                break
        self.weight = w
        s = z @ w
        cuts = np.quantile(s, np.linspace(0.005, 0.995, 199))
        right = [np.mean(s[good] >= c) + np.mean(s[bad] < c) for c in cuts]
        best = np.flatnonzero(np.isclose(right, max(right)))
        self.cut = float(cuts[best].mean())

    def score(self, x: np.ndarray) -> np.ndarray:
        s = ((x - self.mean) / self.scale) @ self.weight - self.cut
        return 1 / (1 + np.exp(-np.clip(s + np.log(CUT / (1 - CUT)), -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, max_rows: int,
        max_pairs: int) -> PairwiseModel:
    """Fit on labelled rows outside the held-out fold."""
    named = labels.select(labels[id_col].alias("id"), labels[label_col].cast("int").alias("label"))
    named = by_hash(named.filter(~held_out(F.col("id")) & F.col("label").isin(0, 1) & F.col("id").isNotNull())
                    .groupBy("id").agg(F.min("label").alias("label")), max_rows, "id")
    rows = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).join(F.broadcast(named), "id")

    def run(batches):
        for b in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([b.column("label"), pa.array(list(features(b.column("text"))), pa.list_(pa.float64()))],
                                             ["label", "x"])

    got = rows.select("label", "text").mapInArrow(run, "label int, x array<double>").toPandas()  # about max_rows rows
    x = np.stack(got["x"].to_list()) if len(got) else np.zeros((0, len(FEATURES)))
    order = np.lexsort(x.T) if len(x) else []  # the same sums whatever order tasks end in
    return PairwiseModel(x[order], got["label"].to_numpy(int)[order] if len(x) else np.zeros(0, int), max_pairs)


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_rows: int = 20_000, max_pairs: int = 50_000) -> DataFrame:
    """(id, held_out, score, predicted) of every row of ``docs``.

    ``score`` is 0 to 1, ``predicted`` 1 where it is at least ``CUT``. Null
    and empty texts are scored as the all-zero text; null ids stay null and
    are never held out; repeated rows are scored alike; without labels of
    both kinds every score is below the cut; empty tables give an empty one.
    Labels that are neither 0 nor 1 are left out, of several labels of an id
    the least counts. Columns other than id and text are not read."""
    need(docs, id_col, text_col)
    need(labels, id_col, label_col)
    model = fit(docs, labels, id_col, text_col, label_col, max_rows, max_pairs)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches):
        for b in slices(batches, "text"):
            s = model.score(features(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(s, pa.float64()), pa.array((s >= CUT).astype(np.int32))],
                                             ["id", "score", "predicted"])

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, score double, predicted int")
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "score", "predicted")

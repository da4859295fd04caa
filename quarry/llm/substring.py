"""Substring deduplication by content-defined chunking (operator 3).

A gear rolling hash of the last 32 bytes runs over every text. A chunk
starts where that hash is the least within ``REACH`` bytes on both sides, so
a boundary depends on some 70 bytes around it only: an insertion or another
beginning shifts no boundary further on, and a passage that occurs in two
documents is cut alike in both but for its edges. Chunks are 2 * REACH + 1
bytes on average. A chunk is a duplicate in a document if a document with a
smaller id holds a chunk with the same digest; a run of duplicate chunks
with at least ``min_words`` whole words is removed, so the first document
keeps the passage.

Each document sends each of its digests once, and digests are aggregated
(smallest and largest id) before the shuffle, so a passage in a third of
all documents makes no hot task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import need
from quarry.llm.text import flat_bytes, slices, span_hashes, word_spans

REACH = 14
_WINDOW = 32  # bytes of the rolling hash: its 32 bits are shifted out after as many
_SLICE = 1 << 20


def gear_table() -> np.ndarray:
    """256 pseudo-random 32-bit numbers, by a fixed rule."""
    x = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return (x >> np.uint64(32)).astype(np.uint32)


GEAR = gear_table()


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - k]] << k: the gear hash h = (h << 1) +
    GEAR[byte] at every position, by doubling the window five times."""
    h = GEAR[data]
    h[data == 0] = 0  # padding counts as nothing
    width = 1
    while width < _WINDOW:
        h[width:] = h[width:] + (h[:-width] << np.uint32(width))
        width *= 2
    return h


def _least_around(h: np.ndarray, reach: int) -> np.ndarray:
    """Minimum over [i - reach, i + reach] (the ends are padded)."""
    span, low, width = 2 * reach + 1, h, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:len(low) - (span - width)], low[span - width:])
    return low  # low[j] covers h[j : j + span]


def chunk_starts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, first): byte positions in ``data`` where chunks begin, every
    non-empty text beginning with one, and each text's first chunk number."""
    n_texts, pad = len(off) - 1, _WINDOW + REACH
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(n_texts + 1, np.int64)
    shift = pad * (np.arange(n_texts) + 1)
    place = np.arange(len(data)) + np.repeat(shift, np.diff(off))
    wide = np.zeros(len(data) + pad * (n_texts + 1), np.uint8)
    wide[place] = np.where(data == 0, 1, data)  # zero stands for padding
    h = rolling_hash(wide)
    h[wide == 0] = 0xFFFFFFFF
    low = _least_around(h, REACH)
    cut = h[place] == low[place - REACH]
    cut &= (data & 0xC0) != 0x80
    begins = off[:-1][np.diff(off) > 0]
    cut[begins] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, off)


def _chunks(col) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, chunk starts, first chunk of each text, digests)."""
    data, off = flat_bytes(col)
    starts, first = chunk_starts(data, off)
    return data, off, starts, first, span_hashes(data, starts, np.append(starts[1:], len(data)))


def repeated_spans(known: np.ndarray, starts: np.ndarray, end: int, words: tuple[np.ndarray, np.ndarray],
                   min_words: int) -> list[tuple[int, int]]:
    """Byte spans (whole words) of the runs of duplicate chunks.

    ``known``: flag per chunk; ``starts``: their starts; ``end``: end of the
    text; ``words``: starts and ends of the text's words."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], known, [False]]).astype(np.int8)))
    stops = np.append(starts, end)
    out = []
    for a, b in zip(edge[::2], edge[1::2]):
        lo = int(np.searchsorted(words[0], stops[a]))
        hi = int(np.searchsorted(words[1], stops[b], side="right"))
        if hi - lo >= min_words:
            out.append((int(words[0][lo]), int(words[1][hi - 1])))
    return out


def remove_repeats(docs: DataFrame, min_words: int = 20, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with repeated passages taken out of the text,
    and ``removed``, the byte spans [start, end) cut from the original text.

    Spans are whole words; the white space after a span goes with it. A null
    or empty text, and a row with a null id, is returned as it is. Rows that
    repeat an id count as parts of one document: they keep what only they
    share. Ties need no rule (the smallest id keeps a passage). An empty
    table gives an empty one. Other columns pass through whatever their
    names. A text of any length is taken whole."""
    need(docs, id_col, text_col)
    spark_id = docs[id_col].cast("long")
    src = docs.select(spark_id.alias("id"), docs[text_col].alias("text")).filter("id is not null and text != ''")

    def digests(batches):
        for b in slices(batches, "text", _SLICE):
            _, _, _, first, d = _chunks(b.column("text"))
            each = [np.unique(d[a:z]) for a, z in zip(first[:-1].tolist(), first[1:].tolist())]
            size = np.array([len(x) for x in each])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(b.column("id").to_numpy(zero_copy_only=False), size), pa.int64()),
                 pa.array(np.concatenate(each).view(np.int64) if each else np.zeros(0, np.int64), pa.int64())], ["id", "digest"])

    held = src.mapInArrow(digests, "id long, digest long")
    first = (held.groupBy("digest").agg(F.min("id").alias("lo"), F.max("id").alias("hi"))
             .filter("lo != hi").select("digest", "lo"))
    known = (held.join(first, "digest").filter("id > lo").groupBy("id")
             .agg(F.collect_list("digest").alias("digests")))  # at most the document's own chunks

    names = [f"c{i}" for i in range(len(docs.columns))]
    at = docs.columns.index(text_col)
    rows = docs.select(spark_id.alias("__id"), *[docs[c].alias(n) for c, n in zip(docs.columns, names)])
    rows = rows.join(known.select(F.col("id").alias("__id"), "digests"), "__id", "left").drop("__id")
    schema = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)

    def clean(batches):
        for b in slices(batches, names[at], _SLICE):
            lists = b.column("digests")
            texts, removed = b.column(names[at]).to_pylist(), [[] for _ in range(b.num_rows)]
            some = np.flatnonzero(~lists.is_null().to_numpy(zero_copy_only=False))
            if len(some):
                part = b.take(pa.array(some))
                data, off, starts, begin, d = _chunks(part.column(names[at]))
                w_start, w_end, w_first = word_spans(data, off)
                for k, row in enumerate(some.tolist()):
                    a, z = begin[k], begin[k + 1]
                    flags = np.isin(d[a:z], np.array(part.column("digests")[k].as_py(), np.int64).view(np.uint64))
                    words = slice(w_first[k], w_first[k + 1])
                    base = off[k]
                    spans = repeated_spans(flags, starts[a:z] - base, int(off[k + 1] - base),
                                           (w_start[words] - base, w_end[words] - base), min_words)
                    if spans:
                        texts[row], removed[row] = cut_out(texts[row].encode(), spans), [{"start": x, "end": y} for x, y in spans]
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()) if n == names[at] else b.column(n) for n in names]
                + [pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], [*names, "removed"])

    out = rows.mapInArrow(clean, f"{schema}, removed array<struct<start:bigint,end:bigint>>")
    last = "removed" if "removed" not in docs.columns else "removed_spans"
    return out.toDF(*docs.columns, last)


def cut_out(text: bytes, spans: list[tuple[int, int]]) -> str:
    kept, at = [], 0
    for a, z in spans:
        kept.append(text[at:a])
        at = z
        while at < len(text) and text[at:at + 1].isspace():
            at += 1
    kept.append(text[at:])
    return b"".join(kept).decode()

"""Benchmark decontamination by latent semantic retrieval (operator 8).

1. One pass over the corpus: texts are cut into passages of ``BLOCK`` words;
   over the words of the benchmark (bounded, without those that many items
   hold) it counts passages per word and adds up a random sketch G * Omega
   of the term co-occurrence G = sum of tf tf' over all passages, benchmark
   passages included with equal weight. Tasks add up their passages, two
   levels of grouping add up the tasks.
2. The driver, on a matrix of the benchmark's vocabulary, finishes the
   randomised singular value decomposition of the TF-IDF passages from that
   single-pass sketch (Q = orth(D G Omega), eigenvalues of the core matrix)
   and keeps the ``rank`` leading right singular vectors.
3. Second pass: windows of two and three passages, one passage apart, are folded
   into the latent space; those within ``min_cosine`` of an item are
   candidates of it. An item longer than a window is searched by overlapping
   pieces of it, any of which makes a candidate of the whole item. Beside the
   cosine, whatever the rank, the rarest three words in a row of every item
   and piece make a candidate where a text holds them, so an exact copy is
   always compared. A candidate
   is checked on its words: the longest common subsequence of the whole item
   and the window's neighbourhood (all of it, not only the vocabulary of
   step 1), and whether the item's answer, its last sentence, is found. A long subsequence is a copy; a shorter one with the answer
   intact is a paraphrase.

Words are runs of letters, digits and bytes above 127, lower-cased. The
benchmark is broadcast; its size is checked.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 — pa.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Shared, need
from quarry.llm.text import as_utf8, flat_bytes, ragged, slices, span_hashes

BLOCK = 16
#: Words of a piece of a long item: a window of three blocks that begins with
#: the block where the piece begins holds all of it.
PIECE = 2 * BLOCK
#: Share of a passage's words and latent length that a window must hold.
HELD = 0.4
#: Most bytes of benchmark text held by the driver and each worker.
BENCHMARK_BYTES = 32 << 20
#: Most bytes of arrays that a benchmark may take in one process (``memory``).
MEMORY_BYTES = 640 << 20
#: Cosines computed at once.
COSINES = 4 << 20
#: Words of an anchor, the rarest run of an item or piece.
ANCHOR = 3


def _word_bytes() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return t


IS_WORD = _word_bytes()
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(col) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text), in lower case."""
    data, off = flat_bytes(pa.compute.utf8_lower(as_utf8(col)))
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64)
    solid = IS_WORD[data]
    begin, last = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = off[(off > 0) & (off < len(data))]
    begin[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begin)
    return span_hashes(data, starts, np.flatnonzero(last) + 1), np.searchsorted(starts, off)


def passages_of(size: int) -> list[tuple[int, int]]:
    """[first word, end) of the passages that stand for an item: the whole
    item as long as a window can hold its share, and beyond a window pieces
    of ``PIECE`` words, ``BLOCK`` words apart, the last at the item's end."""
    out = [(0, size)] if HELD * size <= 3 * BLOCK else []
    if size > 3 * BLOCK:
        out += [(a, a + PIECE) for a in range(0, size - PIECE, BLOCK)] + [(size - PIECE, size)]
    return out


def run_hashes(number: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """A hash of the ``width`` word numbers from each place ``at`` on."""
    h = np.zeros(len(at), np.uint64)
    for k in range(width):
        h = (h ^ number[at + k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h


class Benchmark:
    """Items as word numbers; the vocabulary with its common words marked."""

    def __init__(self, ids: list, texts: list[str], common_share: float = 0.02):
        rows = [(i, t) for i, t in zip(ids, texts) if t and WORD.search(t.encode())]
        self.ids = [i for i, _ in rows]
        hashes, first = words_of(pa.array([t for _, t in rows], pa.string()))
        self.vocabulary = np.unique(hashes)
        number = np.searchsorted(self.vocabulary, hashes)
        self.items = [number[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        held = np.zeros(len(self.vocabulary), np.int64)
        for x in self.items:
            held[np.unique(x)] += 1
        while True:  # a share at which every item keeps some words that count
            self.common = held > max(2, common_share * len(self.items))
            if all((~self.common[x]).sum() >= min(5, len(x)) for x in self.items):
                break
            common_share *= 2
        self.answers = []
        for (_, t), x in zip(rows, self.items):  # the last sentence, at least three words
            tail = [s for s in re.split(r"(?<=[.!?])\s+|\n", t) if WORD.search(s.encode())][-1]
            self.answers.append(x[-max(len(WORD.findall(tail.encode())), min(3, len(x))):])
        #: what is searched for: (item, first word, end) of whole items and of pieces of long ones
        self.passages = [(k, a, z) for k, x in enumerate(self.items) for a, z in passages_of(len(x))
                         if not self.common[x[a:z]].all()]
        self.informative = np.array([int((~self.common[self.items[k][a:z]]).sum()) for k, a, z in self.passages])

    def memory(self, rank: int) -> int:
        """Bytes of arrays of the process that holds the most: the driver's
        decomposition (six float64 arrays of vocabulary x sketch width, more
        than a task of pass 1 has), or a searcher (vectors of words and
        passages, bit masks of the items)."""
        v, words = len(self.vocabulary), np.array([len(x) for x in self.items], float)
        searcher = 4 * rank * (v + 2 * len(self.passages)) + float((150 * words + words * words / 8).sum())
        return int(max(48 * (rank + 8) * v, searcher))

    def place(self, hashes: np.ndarray) -> np.ndarray:
        """Vocabulary number of each hash, -1 for other words."""
        if not len(self.vocabulary):
            return np.full(len(hashes), -1, np.int32)
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1).astype(np.int32)

    def tokens(self, col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of every word, first word and first block of each text)."""
        hashes, first = words_of(col)
        blocks = np.concatenate([[0], np.cumsum(-(-np.diff(first) // BLOCK))])
        return self.place(hashes), first, blocks

    def spread(self, number: np.ndarray, first: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(block, word) of the words that count: in the vocabulary, not common."""
        use = np.flatnonzero(number >= 0)
        use = use[~self.common[number[use]]]
        text = np.searchsorted(first, use, side="right") - 1
        return blocks[text] + (use - first[text]) // BLOCK, number[use]


def _sum_rows(values: np.ndarray, key: np.ndarray, size: int) -> np.ndarray:
    """Sum of ``values`` by ascending ``key`` into ``size`` rows."""
    out = np.zeros((size, values.shape[1]), values.dtype)
    if len(key):
        edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        out[key[edge]] = np.add.reduceat(values, edge, axis=0)
    return out


def sketch(block: np.ndarray, word: np.ndarray, omega: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passages per word, sum over passages of tf (tf' omega))."""
    size = int(block[-1]) + 1 if len(block) else 0
    y = _sum_rows(omega[word], block, size)
    order = np.argsort(word, kind="stable")
    z = _sum_rows(y[block[order]], word[order], len(omega))
    pair = np.unique(word.astype(np.int64) * max(size, 1) + block)
    return np.bincount(pair // max(size, 1), minlength=len(omega)), z


def latent_words(df: np.ndarray, passages: int, z: np.ndarray, items_z: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """idf-weighted word vectors: single-pass randomised decomposition of
    M = D (G_corpus + w G_items) D with test matrix D^-1 omega."""
    idf = np.log((passages + 1) / (df + 1)) + 1e-3
    weight = max(np.abs(z).sum(), 1e-9) / max(np.abs(items_z).sum(), 1e-9)
    y = idf[:, None] * (z + weight * items_z)
    q, _ = np.linalg.qr(y)
    test = omega / idf[:, None]
    core = (q.T @ y) @ np.linalg.pinv(q.T @ test)
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    lead = np.argsort(-np.abs(values))[:rank]
    return (idf[:, None] * (q @ vectors[:, lead])).astype(np.float32)


def lcs(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Longest common subsequence of an item (bit masks of its words'
    places) and a list of words, one big-integer step per word."""
    full = (1 << size) - 1
    v = full
    for w in words:
        m = masks.get(w)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return size - v.bit_count()


def masks_of(words: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, w in enumerate(words.tolist()):
        out[w] = out.get(w, 0) | 1 << k
    return out


class Searcher:
    """Candidate search and checks of one worker."""

    def __init__(self, bench: Benchmark, latent: np.ndarray, df: np.ndarray, min_cosine: float, copy_share: float, paraphrase_share: float):
        self.bench, self.latent, self.min_cosine = bench, latent, min_cosine
        self.copy_share, self.paraphrase_share = copy_share, paraphrase_share
        words = [bench.items[k][a:z] for k, a, z in bench.passages]
        rows = np.stack([latent[x[~bench.common[x]]].sum(0) for x in words]) if words else np.zeros((0, latent.shape[1]))
        self.length = np.maximum(np.linalg.norm(rows, axis=1), 1e-9)
        self.query = rows / self.length[:, None]
        self.common_words = np.array([int(bench.common[x].sum()) for x in bench.items])
        self.size = np.array([len(x) for x in bench.items])
        self.item, self.before, end = np.array(bench.passages, np.int64).reshape(-1, 3).T
        # blocks by which a copy of a long item may be stretched on both sides of a piece
        self.slack = np.where(end - self.before < self.size[self.item], self.size[self.item] // (8 * BLOCK), 0)
        self.pairs = np.unique(np.concatenate([k * len(bench.vocabulary) + x.astype(np.int64) for k, x in enumerate(bench.items)]))
        self.masks = [(masks_of(x), len(x), masks_of(a), len(a)) for x, a in zip(bench.items, bench.answers)]

        weight, runs = np.log1p(df), {}
        for j, (x, (_, at, _)) in enumerate(zip(words, bench.passages)):
            width = min(ANCHOR, len(x))
            total = np.convolve(weight[x], np.ones(width), "valid")
            runs.setdefault(width, []).append((j, at + int(total.argmin())))
        self.anchors = []  # (words, ascending hashes, passages, places in the item)
        for width, found in sorted(runs.items()):
            j, at = np.array(found, np.int64).T
            h = np.concatenate([run_hashes(bench.items[k], np.array([p]), width) for k, p in zip(self.item[j].tolist(), at.tolist())])
            order = np.argsort(h, kind="stable")
            self.anchors.append((width, h[order], j[order], at[order]))

    def search(self, col) -> list[tuple[int, int, float, float, bool]]:
        """(text, item, cosine, share of the item found, answer found)."""
        bench = self.bench
        number, first, blocks = bench.tokens(col)
        block, word = bench.spread(number, first, blocks)
        size = int(blocks[-1])
        if not size or not len(word):
            return []
        vec = _sum_rows(self.latent[word], block, size)
        told = np.bincount(block, minlength=size)
        text_of = np.repeat(np.arange(len(first) - 1), np.diff(blocks))
        found: dict[tuple[int, int], tuple[float, float, bool]] = {}
        wide, count, seen = vec.copy(), told.copy(), set()
        for step in (1, 2):  # windows of two, then three blocks of one text
            at = np.flatnonzero(text_of[:-step] == text_of[step:]) if size > step else np.zeros(0, np.int64)
            wide[at] += vec[at + step]
            count[at] += told[at + step]
            some = np.flatnonzero(count >= min(2, bench.informative.min()))
            many = min(8192, max(COSINES // max(len(self.query), 1), 1))
            for lo in range(0, len(some), many):
                self._check(some[lo:lo + many], wide, count, number, first, blocks, text_of, block, word, found, seen)
        self._anchored(wide, number, first, blocks, block, word, found, seen)
        return [(t, k, *v) for (t, k), v in sorted(found.items())]

    def _check(self, some, wide, count, number, first, blocks, text_of, block, word, found, seen) -> None:
        """Candidates among the windows ``some``, compared word by word."""
        bench = self.bench
        size = np.linalg.norm(wide[some], axis=1)
        near = (wide[some] / np.maximum(size, 1e-9)[:, None]) @ self.query.T
        i, j = np.nonzero(near >= self.min_cosine)
        # the window must also hold a good part of the item's vector and words
        use = (near[i, j] * size[i] >= HELD * self.length[j]) & (count[some[i]] >= HELD * bench.informative[j])
        i, j = i[use], j[use]
        w, k = some[i], self.item[j]
        t = text_of[w]
        lo = np.maximum(w - 1 - self.slack[j] - (-(-self.before[j] // BLOCK)), blocks[t])
        hi = np.minimum(w + 2 + self.slack[j] - (-np.maximum(self.size[k] - self.before[j], 3 * BLOCK) // BLOCK), blocks[t + 1])
        self._parts(near[i, j], t, k, lo, hi, number, first, blocks, block, word, found, seen)

    def _anchored(self, wide, number, first, blocks, block, word, found, seen) -> None:
        """Candidates by the anchors that the texts hold."""
        known = np.flatnonzero(number >= 0)
        for width, hashes, passage, place in self.anchors:
            at = known[known <= len(number) - width]
            for k in range(1, width):
                at = at[number[at + k] >= 0]
            h = run_hashes(number, at, width)
            lo, hi = np.searchsorted(hashes, h), np.searchsorted(hashes, h, side="right")
            q, x = np.repeat(at, hi - lo), ragged(lo, hi - lo)
            j, p = passage[x], place[x]
            t, k = np.searchsorted(first, q, side="right") - 1, self.item[j]
            begin = q - first[t] - p  # where the item would begin in the text
            w = blocks[t] + (q - first[t]) // BLOCK
            size = np.maximum(np.linalg.norm(wide[w], axis=1), 1e-9)
            near = (wide[w] / size[:, None] * self.query[j]).sum(1)
            lo = np.maximum(blocks[t] + begin // BLOCK - 1 - self.slack[j], blocks[t])
            hi = np.minimum(blocks[t] - (-(begin + self.size[k]) // BLOCK) + 1 + self.slack[j], blocks[t + 1])
            self._parts(near, t, k, lo, hi, number, first, blocks, block, word, found, seen)

    def _parts(self, near, t, k, lo, hi, number, first, blocks, block, word, found, seen) -> None:
        """Compare the candidates, about a million words at once."""
        a, z = np.searchsorted(block, lo), np.searchsorted(block, hi)
        group = np.cumsum(z - a) >> 20
        for part in np.split(np.arange(len(k)), np.flatnonzero(np.diff(group)) + 1):
            self._compare(near[part], t[part], k[part], lo[part], hi[part], a[part], z[part], number, first, blocks, word, found, seen)

    def _compare(self, near, t, k, lo, hi, a, z, number, first, blocks, word, found, seen) -> None:
        """Items ``k`` against the blocks [lo, hi) of the texts ``t``, whose counting words are [a, z)."""
        bench = self.bench
        # bound of the common subsequence: counting words there that the item holds, and its common words
        at = ragged(a, z - a)
        key = np.repeat(k, z - a) * len(bench.vocabulary) + word[at].astype(np.int64)
        held = self.pairs[np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)] == key
        total = np.concatenate([[0], np.cumsum(held)])
        ends = np.cumsum(z - a)
        most = total[ends] - total[ends - (z - a)] + self.common_words[k]
        for c in np.flatnonzero(most >= self.paraphrase_share * self.size[k]).tolist():
            text, item, place = int(t[c]), int(k[c]), (int(k[c]), int(lo[c]), int(hi[c]))
            if place in seen:  # by another window or piece
                continue
            seen.add(place)
            masks, m, answer, n = self.masks[item]
            begin = first[text] + (lo[c] - blocks[text]) * BLOCK
            around = number[begin:min(first[text] + (hi[c] - blocks[text]) * BLOCK, first[text + 1])].tolist()
            share = lcs(masks, m, around) / m
            if share >= self.paraphrase_share:
                told = lcs(answer, n, around) >= 0.8 * n
                if share >= self.copy_share or told and m >= 8:
                    if found.get((text, item), (0, 0))[1] < share:
                        found[text, item] = float(near[c]), share, told


def _latent(docs: DataFrame, bench: Benchmark, shared: Shared, rank: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Pass 1 and the decomposition: (word vectors, passages per word)."""
    v, width = len(bench.vocabulary), min(rank + 8, max(len(bench.vocabulary), 1))
    part = 256  # words per summed row

    def omega() -> np.ndarray:
        return np.random.default_rng(seed).standard_normal((v, width)).astype(np.float32)

    def run(batches):
        b, test = shared.value, omega()
        df, z, passages = np.zeros(v, np.int64), np.zeros((v, width)), 0
        for s in slices(batches, "text"):
            number, first, blocks = b.tokens(s.column("text"))
            d, y = sketch(*b.spread(number, first, blocks), test)
            df, z, passages = df + d, z + y, passages + int(blocks[-1])
        salt = TaskContext.get().partitionId()  # the same if the task is run again
        for k in range(0, v, part):
            if df[k:k + part].any() or k == 0:
                yield row(k // part, salt % 64, passages if k == 0 else 0, df[k:k + part], z[k:k + part])

    kind = "part int, salt int, passages long, df array<long>, z binary"

    def row(k, salt, passages, df, z):
        return pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([salt], pa.int32()), pa.array([passages], pa.int64()),
                                           pa.array([df.tolist()], pa.list_(pa.int64())), pa.array([z.astype("<f8").tobytes()], pa.binary())],
                                          ["part", "salt", "passages", "df", "z"])

    def add(keys, rows):
        one = [(r["passages"], np.array(r["df"]), np.frombuffer(r["z"], "<f8")) for r in rows.to_pylist()]
        return pa.Table.from_batches([row(keys[0].as_py(), 0, *(sum(x) for x in zip(*one)))])

    texts = docs.select("text").filter("text is not null")
    sums = (texts.mapInArrow(run, kind).groupBy("part", "salt").applyInArrow(add, kind)
            .groupBy("part").applyInArrow(add, kind).collect())  # a row per 256 words of the benchmark
    df, z, passages = np.zeros(v), np.zeros((v, width)), 0
    for r in sums:
        at = r["part"] * part
        df[at:at + len(r["df"])] = r["df"]
        z[at:at + len(r["df"])] = np.frombuffer(r["z"], "<f8").reshape(-1, width)
        passages += r["passages"]
    test = omega().astype(float)
    words = [bench.items[k][a:z] for k, a, z in bench.passages]
    block = np.repeat(np.arange(len(words)), [len(x) for x in words])
    word = np.concatenate(words)
    use = ~bench.common[word]
    _, items_z = sketch(block[use], word[use], test)
    return latent_words(df, passages, z, items_z, test, rank), df


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", rank: int = 48, min_cosine: float = 0.25,
               copy_share: float = 0.7, paraphrase_share: float = 0.6, seed: int = 11) -> DataFrame:
    """(id, item, cosine, share, answer_found): documents that hold an item
    of the benchmark, one row per document row and item.

    ``share`` is the longest common subsequence over the item's words in the
    best window's neighbourhood, ``cosine`` that of the window and the item,
    or the piece of a long item, that led there. Items of any length are
    compared whole. At least ``copy_share`` is a copy; from
    ``paraphrase_share`` on, an item of eight words or more counts if its
    answer is there (four fifths of it, in order). Null and empty texts hold
    nothing; null, empty and wordless items match nothing; equal items are
    each reported; repeated rows are reported each; empty tables on either
    side give an empty result; other columns are not read. Texts of any
    length are searched whole. A benchmark of more than ``BENCHMARK_BYTES``
    of text or ``MEMORY_BYTES`` of arrays is searched in parts, one after
    another, each with its own passes over the documents."""
    need(docs, id_col, text_col)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    schema = f"id {src.schema['id'].dataType.simpleString()}, item long, cosine double, share double, answer_found boolean"
    names = {"id": id_col, "item": item_col if item_col != id_col else "item_id"}
    out = None
    for searcher in _searchers(src, benchmark, item_col, item_text_col, rank, min_cosine, copy_share, paraphrase_share, seed):
        part = src.mapInArrow(_report(searcher), schema)
        out = part if out is None else out.unionByName(part)
    return (docs.sparkSession.createDataFrame([], schema) if out is None else out).withColumnsRenamed(names)


def _report(searcher: Shared):
    def run(batches):
        s = searcher.value
        for b in slices(batches, "text"):
            hits = s.search(b.column("text"))
            t, k, c, share, answer = ([h[x] for h in hits] for x in range(5))
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(t, pa.int64())), pa.array([s.bench.ids[x] for x in k], pa.int64()),
                 pa.array(c, pa.float64()), pa.array(share, pa.float64()), pa.array(answer, pa.bool_())],
                ["id", "item", "cosine", "share", "answer_found"])
    return run


def _searchers(src, benchmark, item_col, item_text_col, rank, min_cosine, copy_share, paraphrase_share, seed):
    """A fitted searcher for each part of the benchmark. Parts are dealt by
    hash of the item rows; one that takes too much memory is halved. Only a
    part of one row (as often as it is there) may be larger."""
    need(benchmark, item_col, item_text_col)
    items = benchmark.select(benchmark[item_col].cast("long").alias("item"), benchmark[item_text_col].alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(-(-size // BENCHMARK_BYTES), 1)
    todo = [(parts, k) for k in range(parts)]
    while todo:
        n, k = todo.pop(0)
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).collect()  # about BENCHMARK_BYTES
        rows = sorted(((r["item"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r))
        bench = Benchmark([r[0] for r in rows], [r[1] for r in rows])
        if not bench.items:
            continue
        if bench.memory(rank) > MEMORY_BYTES and len(set(rows)) > 1:
            todo += [(2 * n, k), (2 * n, k + n)]
            continue
        latent, df = _latent(src, bench, Shared(src.sparkSession, bench), rank, seed)
        yield Shared(src.sparkSession, Searcher(bench, latent, df, min_cosine, copy_share, paraphrase_share))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", rank: int = 48, min_cosine: float = 0.25, copy_share: float = 0.7,
                 paraphrase_share: float = 0.6, seed: int = 11) -> DataFrame:
    """The rows of ``docs`` that hold no item of the benchmark, as
    ``find_leaks`` decides, with all their columns whatever their names. Each
    row is judged by itself in the search pass, whether its id is null,
    repeated or absent; no join follows."""
    need(docs, text_col)
    names = [f"c{i}" for i in range(len(docs.columns))]
    text = names[docs.columns.index(text_col)]
    out = docs.toDF(*names)
    src = out.select(out[text].alias("text"))
    for searcher in _searchers(src, benchmark, item_col, item_text_col, rank, min_cosine, copy_share, paraphrase_share, seed):
        def run(batches, searcher=searcher):
            s = searcher.value
            for b in slices(batches, text):
                keep = np.ones(b.num_rows, bool)
                keep[[h[0] for h in s.search(b.column(text))]] = False
                yield b.filter(pa.array(keep))

        out = out.mapInArrow(run, out.schema)
    return out.toDF(*docs.columns)

"""Word-level language identification with a linear-chain conditional random
field (operator 4).

A text is a set of chains: its lines, cut after ``CHAIN`` words. Every word
is labelled with a language: its emission scores are learned weights of
hashed features (the lower-cased word itself, its affixes of one to four
bytes, its byte bigrams and trigrams), and learned transition weights join
neighbours. Forward-backward gives each word's posterior; a document's
language is the one with the largest expected share of its words, and that
share is the score. Code-switched texts thus get a share per language
(``language_shares``).

Training uses labelled documents outside the held-out fold: about
``max_docs`` rows, by hash, cut into chains, about ``max_chains`` of them;
languages whose part of that is small have ``LEAST_DOCS`` rows and
``LEAST_CHAINS`` chains all the same (or what there is), so that every
labelled language is learned. Rows and chains are made distinct before they
are drawn, so repeated ones do not enlarge the sample. More than
``folds.MAX_VALUES`` languages are an error; beyond 256 the hashed features
get fewer buckets, so that the broadcast weights stay within 128 MB.
Training sequences join one to three chains of any languages, so that the
transitions are learned from switches as well as from runs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Shared, need
from quarry.llm.folds import by_hash_each, held_out
from quarry.llm.text import TO_LOWER, flat_bytes, mix, slices, span_hashes, word_spans, worker_store

CHAIN = 64
BITS = 17
LEAST_DOCS, LEAST_CHAINS = 20, 60


def _letters() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
    return t


MAY_BE_LETTER = _letters()


def word_features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(bucket numbers of all words one after another, buckets per word)."""
    size = ends - starts
    wide = size + 2  # the word between two zero bytes
    w_end = np.cumsum(wide)
    w_start = w_end - wide
    buf = np.zeros(int(w_end[-1]) + 2 if len(wide) else 2, np.uint64)
    buf[np.arange(int(size.sum())) + np.repeat(w_start + 1 - (np.cumsum(size) - size), size)] = data[
        np.arange(int(size.sum())) + np.repeat(starts - (np.cumsum(size) - size), size)].astype(np.uint64) + np.uint64(1)
    kinds, owner = [], []

    def add(kind: int, value: np.ndarray, who: np.ndarray) -> None:
        kinds.append((mix(value * np.uint64(64) + np.uint64(kind)) >> np.uint64(64 - bits)).astype(np.int32))
        owner.append(who)

    who = np.arange(len(size))
    at = np.arange(len(buf) - 2)
    word_of = np.repeat(who, wide)
    two = buf[:-2] * np.uint64(257) + buf[1:-1]
    three = two * np.uint64(257) + buf[2:]
    in2 = at < (w_end - 1)[word_of]
    in3 = at < (w_end - 2)[word_of]
    add(1, two[in2], word_of[in2])
    add(2, three[in3], word_of[in3])
    head, tail = np.zeros(len(size), np.uint64), np.zeros(len(size), np.uint64)
    for k in range(1, 5):
        ok = size >= k
        head[ok] = head[ok] * np.uint64(257) + buf[w_start[ok] + k]
        tail[ok] = tail[ok] * np.uint64(257) + buf[w_end[ok] - 1 - k]
        add(2 + k, head[ok], who[ok])
        add(8 + k, tail[ok], who[ok])
    add(20, span_hashes(data, starts, ends), who)
    own = np.concatenate(owner)
    order = np.argsort(own, kind="stable")
    return np.concatenate(kinds)[order], np.bincount(own, minlength=len(size))


class Chains:
    """Positions of chains of words, longest first, for step-wise scans."""

    def __init__(self, starts: np.ndarray, sizes: np.ndarray):
        order = np.argsort(-sizes, kind="stable")
        self.starts, self.sizes = starts[order], sizes[order]
        longest = int(self.sizes[0]) if len(self.sizes) else 0
        self.active = [int(np.searchsorted(-self.sizes, -t)) for t in range(longest)]  # chains longer than t

    def posteriors(self, emission: np.ndarray, trans: np.ndarray, pairs: bool = False):
        """Marginals of every word (forward-backward), and with ``pairs``
        the expected transition counts and the log partition sum."""
        e = np.exp(emission - emission.max(1, keepdims=True))
        move = np.exp(trans)
        alpha = np.empty_like(e)
        scale = np.ones(len(e))
        for t, n in enumerate(self.active):
            i = self.starts[:n] + t
            a = e[i] if t == 0 else (alpha[i - 1] @ move) * e[i]
            scale[i] = z = a.sum(1)
            alpha[i] = a / z[:, None]
        post, beta = alpha.copy(), np.ones_like(e)
        counts = np.zeros_like(trans)
        for t in range(len(self.active) - 1, 0, -1):
            i = self.starts[:self.active[t]] + t
            right = beta[i] * e[i] / scale[i][:, None]
            if pairs:
                counts += alpha[i - 1].T @ right * move
            beta[i - 1] = right @ move.T
            post[i - 1] = alpha[i - 1] * beta[i - 1]
        post /= post.sum(1, keepdims=True)
        if not pairs:
            return post
        return post, counts, float(np.log(scale).sum() + emission.max(1).sum())


def chains_of(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word starts, word ends, first word of each text, chain starts, chain
    sizes) of the words that hold a letter, or a byte that may be of one."""
    starts, ends, _ = word_spans(data, off)
    total = np.concatenate([[0], np.cumsum(MAY_BE_LETTER[data])])
    has = total[ends] > total[starts]
    starts, ends = starts[has], ends[has]
    first = np.searchsorted(starts, off)
    lines = np.unique(np.concatenate([np.searchsorted(starts, np.flatnonzero(data == 10)), first]))
    lines = lines[lines < len(starts)]
    sizes = np.diff(np.append(lines, len(starts)))
    pieces = -(-sizes // CHAIN)
    begin = np.repeat(lines, pieces) + CHAIN * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    size = np.minimum(np.repeat(lines + sizes, pieces) - begin, CHAIN)
    return starts, ends, first, begin, size


class Tagger:
    """A fitted field: label names, hashed feature weights, transitions."""

    def __init__(self, names: list[str]):
        self.names = names
        self.bits = BITS - max(len(names) - 1, 1).bit_length() + 8 if len(names) > 256 else BITS
        self.weight = np.zeros((1 << self.bits, len(names)), np.float32)
        self.trans = np.zeros((len(names), len(names)))

    def fit(self, texts: list[str], labels: list[int], rounds: int = 30, rate: float = 0.3, ridge: float = 1e-5,
            seed: int = 3) -> None:
        rng = np.random.default_rng(seed)
        order = rng.permutation(len(texts))
        data, off = flat_bytes(pa.array([texts[i] for i in order], pa.string()))
        data = TO_LOWER[data]
        starts, ends, first, _, _ = chains_of(data, off)
        if not len(starts):
            return
        gold = np.repeat(np.array(labels)[order], np.diff(first))
        # one to three neighbouring chains (shuffled, so of any language) make a sequence
        cut = np.cumsum(rng.integers(1, 4, len(texts)))
        edge = np.unique(np.concatenate([[0], first[cut[cut < len(texts)]]]))
        edge = edge[edge < len(starts)]
        chains = Chains(edge, np.diff(np.append(edge, len(starts))))
        _, at, of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        bucket, n = word_features(data, starts[at], ends[at], self.bits)
        begin = np.cumsum(n) - n
        inner = np.ones(len(starts), bool)
        inner[edge] = False
        told = np.zeros_like(self.trans)
        here = np.flatnonzero(inner)
        np.add.at(told, (gold[here - 1], gold[here]), 1)
        target = np.eye(len(self.names))[gold]
        sums = [np.zeros_like(self.weight), np.zeros_like(self.trans)]
        w_of = np.repeat(np.arange(len(n)), n)
        for _ in range(rounds):  # AdaGrad on the whole conditional log-likelihood
            score = np.add.reduceat(self.weight[bucket], begin)[of]
            post, counts, _ = chains.posteriors(score.astype(float), self.trans, pairs=True)
            diff = np.zeros((len(n), len(self.names)))
            for k in range(len(self.names)):
                diff[:, k] = np.bincount(of, (target - post)[:, k], len(n))
            grad = np.stack([np.bincount(bucket, diff[w_of, k], len(self.weight)) for k in range(len(self.names))], 1)
            for param, g, total in ((self.weight, grad / len(starts) - ridge * self.weight, sums[0]),
                                    (self.trans, (told - counts) / len(starts) - ridge * self.trans, sums[1])):
                total += (g * g).astype(total.dtype)
                param += (rate * g / (np.sqrt(total) + 1e-7)).astype(param.dtype)

    def emissions(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, memo: str) -> np.ndarray:
        """Scores of the words; a bounded memo keeps those of words seen
        before by this worker (emptied when full: speed only)."""
        keys, at, of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        have, rows = worker_store().get(memo, (np.zeros(0, np.uint64), np.zeros((0, len(self.names)), np.float32)))
        if len(have) + len(keys) > 2_000_000:
            have, rows = have[:0], rows[:0]
        place = np.searchsorted(have, keys)
        new = np.ones(len(keys), bool) if not len(have) else have[np.minimum(place, len(have) - 1)] != keys
        if new.any():
            bucket, n = word_features(data, starts[at[new]], ends[at[new]], self.bits)
            fresh = np.add.reduceat(self.weight[bucket], np.cumsum(n) - n)
            have, rows = np.insert(have, place[new], keys[new]), np.insert(rows, place[new], fresh, axis=0)
            worker_store()[memo] = have, rows
        return rows[np.searchsorted(have, keys)][of]

    def shares(self, col, memo: str) -> tuple[np.ndarray, np.ndarray]:
        """(expected words per language, words) of each text."""
        data, off = flat_bytes(col)
        data = TO_LOWER[data] if len(data) else data
        starts, ends, first, begin, size = chains_of(data, off)
        out = np.zeros((len(off) - 1, len(self.names)))
        if len(starts):
            post = Chains(begin, size).posteriors(self.emissions(data, starts, ends, memo).astype(float), self.trans)
            total = np.concatenate([np.zeros((1, len(self.names))), np.cumsum(post, 0)])
            out = total[first[1:]] - total[first[:-1]]
        return out, np.diff(first)


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, max_docs: int, max_chains: int) -> Tagger:
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))
    rows = src.filter(~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    chosen = by_hash_each(rows.select("id", "lang").distinct(), max_docs, LEAST_DOCS, "lang", "id", "lang")
    lines = (rows.join(F.broadcast(chosen), ["id", "lang"])  # about max_docs pairs
             .select("lang", F.explode(F.split("text", "\n")).alias("line")).filter(F.length("line") > 0)
             .select("lang", F.explode(F.regexp_extract_all("line", F.lit(r"(?:\S+\s*){1,%d}" % CHAIN), F.lit(0))).alias("chain"))
             .distinct())
    got = by_hash_each(lines, max_chains, LEAST_CHAINS, "lang", "chain", "lang").toPandas()
    names = sorted(got["lang"].unique().tolist())
    tagger = Tagger(names)
    tagger.fit(got["chain"].tolist(), [names.index(x) for x in got["lang"]])
    return tagger


def _scored(docs, id_col, text_col, lang_col, max_docs, max_chains, columns, rows):
    need(docs, id_col, text_col, lang_col)
    tagger = train(docs, id_col, text_col, lang_col, max_docs, max_chains)
    model = Shared(docs.sparkSession, tagger)  # 2^BITS weights per language
    memo = f"emissions-{model.key}"
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches):
        import regex
        letter = regex.compile(r"\p{L}")
        t = model.value
        for b in slices(batches, "text"):
            share, n = t.shares(b.column("text"), memo) if t.names else (np.zeros((b.num_rows, 1)), np.zeros(b.num_rows, int))
            texts = b.column("text")
            for k in np.flatnonzero(n > 0).tolist():  # "may be a letter" is decided where no ASCII letter shows
                s = texts[k].as_py()
                if not letter.search(s):
                    n[k] = 0
            yield rows(b.column("id"), share, n, t.names)

    return src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, {columns}")


def detect_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    max_docs: int = 2000, max_chains: int = 6000) -> DataFrame:
    """(id, held_out, lang_pred, score) of every row of ``docs``.

    A text that is null, empty or without a letter is ``und`` with score 0,
    as is every text if no row is labelled. Ties go to the language that
    sorts first. Repeated rows are alike, null ids stay null and are never
    held out, an empty table gives an empty one, other columns are not read;
    texts of any length are read whole."""
    def rows(ids, share, n, names):
        known = n > 0
        best = share.argmax(1)
        score = np.where(known, share[np.arange(len(n)), best] / np.maximum(n, 1), 0.0)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([names[k] if ok else "und" for k, ok in zip(best.tolist(), known.tolist())], pa.string()),
             pa.array(np.clip(score, 0, 1), pa.float64())], ["id", "lang_pred", "score"])

    out = _scored(docs, id_col, text_col, lang_col, max_docs, max_chains, "lang_pred string, score double", rows)
    return out.select(F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), "lang_pred", "score")


def language_shares(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                    max_docs: int = 2000, max_chains: int = 6000) -> DataFrame:
    """(id, n_words, shares map<language, expected share of words>) of every
    row: the mixture of a code-switched text. Texts without letters have 0
    words and an empty map; other cases as in ``detect_language``."""
    def rows(ids, share, n, names):
        maps = [list(zip(names, (s / k).tolist())) if k else [] for s, k in zip(share, n.tolist())]
        return pa.RecordBatch.from_arrays([ids, pa.array(n, pa.int64()), pa.array(maps, pa.map_(pa.string(), pa.float64()))],
                                          ["id", "n_words", "shares"])

    out = _scored(docs, id_col, text_col, lang_col, max_docs, max_chains, "n_words long, shares map<string,double>", rows)
    return out.withColumnRenamed("id", id_col)

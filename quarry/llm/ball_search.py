"""Exact ranked lexical search with sparse ball trees (operator 13).

A score is an inner product: a query is the set of its terms, a document the
sparse vector of ``weight * ((1000000000 * tf) div (1000 * tf + 20 * m))``
over the terms that any query of the block holds (all others add nothing).

* One pass over the texts counts terms and keeps, for each document, the
  terms of the queries with their numbers of occurrences, as stored vectors;
  document frequencies, N and L are aggregates of these.
* Vectors are range-partitioned by their two heaviest terms, so neighbours
  are alike (copies side by side) and no group of any size meets in a task.
* A task takes ``BALL`` neighbours at a time and splits them into a ball
  tree: each node has a centroid, and a radius rounded up. No document below
  a node can score more than ``<query, centroid> + |query| * radius``, again
  rounded up. Nodes are opened best first for each query; a subtree whose
  bound is under the query's k-th best score so far is never opened, and the
  documents of an opened leaf are scored in 64-bit integers. Bounds equal to
  the k-th score are opened, as a smaller id wins a tie.
* The k best of each task meet per query in two steps, k rows from each.

Queries are taken in blocks of about ``BLOCK`` bytes of distinct text, as many
blocks (passes over the texts) as needed; only a block's terms are broadcast.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import Shared, need, partitions, stored
from quarry.llm.text import TO_LOWER, flat_bytes, ragged, slices, span_hashes

BALL, LEAF = 4096, 48
#: Bytes of query text in a block, and of the centroids of a tree (leaves grow beyond).
BLOCK, CENTER_BYTES = 1 << 18, 128 << 20
#: Sorts after every integer id.
NO_ID = 1 << 63
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def _term_table() -> np.ndarray:
    t = np.zeros(256, bool)
    t[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
    return t


IS_TERM = _term_table()


def term_spans(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first term of each text) of the terms of a slice."""
    solid = IS_TERM[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[off] = True
    starts = np.flatnonzero(solid & (edge[:-1] | ~np.concatenate([[False], solid[:-1]])))
    ends = np.flatnonzero(solid & (edge[1:] | ~np.concatenate([solid[1:], [False]]))) + 1
    return starts, ends, np.searchsorted(starts, off)


class Block:
    """The queries of a block: their terms by hash, with the bytes to verify,
    and each query's distinct term numbers."""

    def __init__(self, texts: list[str | None]):
        data, off = flat_bytes(pa.array(texts, pa.string()))
        data = TO_LOWER[data] if len(data) else data
        starts, ends, first = term_spans(data, off)
        words = [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())]
        names = sorted(set(words))
        flat, at = flat_bytes(pa.array(names, pa.binary()).cast(pa.string())) if names else (np.zeros(0, np.uint8), np.zeros(1, np.int64))
        keys = span_hashes(flat, at[:-1], at[1:])
        order = np.argsort(keys, kind="stable")
        if len(np.unique(keys)) < len(keys):
            raise ValueError("two query terms share a hash")
        self.keys, self.flat = keys[order], flat
        self.start, self.size = at[:-1][order], np.diff(at)[order]
        number = {names[k]: n for n, k in enumerate(order.tolist())}
        self.terms = [np.array(sorted({number[w] for w in words[a:b]}), np.int64) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]

    def match(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(spans that are query terms, their numbers): found by hash, then
        compared byte by byte."""
        if not len(self.keys) or not len(starts):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero((self.keys[at] == keys) & (self.size[at] == ends - starts))
        at, size = at[hit], self.size[at[hit]]
        if len(hit):
            same = data[ragged(starts[hit], size)] == self.flat[ragged(self.start[at], size)]
            good = np.logical_and.reduceat(same, np.cumsum(size) - size)
            hit, at = hit[good], at[good]
        return hit, at


def counted(batches, block: Block):
    """(id, n, term, tf) of every text: its number of terms, and the numbers
    and counts of the query terms in it."""
    for b in slices(batches, "text"):
        data, off = flat_bytes(b.column("text"))
        data = TO_LOWER[data] if len(data) else data
        starts, ends, first = term_spans(data, off)
        hit, term = block.match(data, starts, ends)
        doc = np.searchsorted(first, hit, side="right") - 1
        pair, tf = np.unique(doc * max(len(block.keys), 1) + term, return_counts=True)
        doc, term = np.divmod(pair, max(len(block.keys), 1))
        cut = np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(cut), pa.array(x, t)) for x, t in ((term, pa.int32()), (tf, pa.int64()))]
        yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.diff(first), pa.int64()), *lists], ["id", "n", "term", "tf"])


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    """floor(1000 * ln((2N + 2) / (2df + 1))) in doubles."""
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def contributions(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 20 * m) with the document's m."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 62:  # beyond 64 bits: whole numbers of any size
        m = np.array([100 - 50 + 50 * k * n_docs // n_terms for k in n.tolist()], np.int64)
    else:
        m = 100 - 50 + 50 * n * n_docs // max(n_terms, 1)
    return 1_000_000_000 * tf // (1000 * tf + 20 * m)


class BallTree:
    """A ball tree over sparse vectors of integers from 0 on, given as (row,
    term, value) triples, row by row."""

    def __init__(self, row: np.ndarray, term: np.ndarray, value: np.ndarray, rows: int, leaf: int = LEAF):
        self.first = np.searchsorted(row, np.arange(rows + 1))
        self.term, self.value, self.order = term, value, np.arange(rows)
        self.used, self.place = np.unique(term, return_inverse=True)
        self.x = value.astype(np.float64)
        self.norm = np.bincount(row, self.x * self.x, rows)
        # a relative error bound of sums over a row or a centroid, several times over
        self.tol = 1e-12 + 1e-15 * max(int(np.diff(self.first).max(initial=0)), len(self.used))
        leaf = max(leaf, 2 * rows * len(self.used) * 8 // CENTER_BYTES)
        self.node, centers, radii = [], [], []  # nodes are [from, to, left child or -1, right child]
        todo = [(0, rows, -1, 0)]
        while todo:
            a, b, parent, side = todo.pop()
            at = len(self.node)
            self.node.append([a, b, -1, -1])
            if parent >= 0:
                self.node[parent][2 + side] = at
            mine = self.order[a:b].copy()
            cells, who = self.cells(mine)
            center = np.bincount(self.place[cells], self.x[cells], len(self.used)) / max(b - a, 1)
            far = self.distances(mine, cells, who, center)
            centers.append(center)
            radii.append(math.sqrt(far.max(initial=0.0)) * (1 + 1e-12))
            if b - a > leaf and far.max() > 1e-9 * self.norm[mine].max() + 4:
                one = self.distances(mine, cells, who, self.dense(mine[far.argmax()]))
                two = self.distances(mine, cells, who, self.dense(mine[one.argmax()]))
                cut = int(np.clip(np.count_nonzero(one < two), (b - a) // 8, b - a - (b - a) // 8))
                self.order[a:b] = mine[np.argsort(one - two, kind="stable")]
                todo += [(a, a + cut, at, 0), (a + cut, b, at, 1)]
        self.center, self.radius = np.array(centers), np.array(radii)

    def cells(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(triples of the rows, number in ``rows`` of each)."""
        size = self.first[rows + 1] - self.first[rows]
        return ragged(self.first[rows], size), np.repeat(np.arange(len(rows)), size)

    def dense(self, row: int) -> np.ndarray:
        out = np.zeros(len(self.used))
        out[self.place[self.first[row]:self.first[row + 1]]] = self.x[self.first[row]:self.first[row + 1]]
        return out

    def distances(self, rows, cells, who, point) -> np.ndarray:
        """Squared distances of the rows from a point, at least the true ones:
        as differences of large sums they get the error bound on top."""
        dot = np.bincount(who, self.x[cells] * point[self.place[cells]], len(rows))
        whole = self.norm[rows] + point @ point
        return np.maximum(whole - 2 * dot, 0) + self.tol * (whole + 2 * dot) + 1

    def bounds(self, terms: np.ndarray) -> np.ndarray:
        """An upper bound of the scores below each node, rounding included."""
        at = np.searchsorted(self.used, terms)
        at = at[(at < len(self.used)) & (self.used[np.minimum(at, len(self.used) - 1)] == terms)] if len(self.used) else at[:0]
        return (self.center[:, at].sum(1) + math.sqrt(len(at)) * self.radius) * (1 + 1e-9) + 1

    def search(self, terms: np.ndarray, ids, k: int, best: list) -> int:
        """Adds to ``best``, a heap of the k best (score, -id) with the worst
        first; returns how many documents were scored."""
        bound = self.bounds(terms)
        wanted = np.zeros(1 + max(int(terms[-1]), int(self.used[-1]) if len(self.used) else 0), bool)
        wanted[terms] = True
        queue, scored = [(-float(bound[0]), 0)], 0
        while queue:
            upper, at = heapq.heappop(queue)
            if -upper < (best[0][0] if len(best) == k else 1):
                break
            a, b, left, right = self.node[at]
            if left >= 0:
                for child in (left, right):
                    heapq.heappush(queue, (-float(bound[child]), child))
                continue
            cells, who = self.cells(self.order[a:b])
            score = np.zeros(b - a, np.int64)
            hit = np.flatnonzero(wanted[self.term[cells]])
            np.add.at(score, who[hit], self.value[cells[hit]])  # 64-bit integers throughout
            scored += b - a
            for j in np.flatnonzero(score >= (best[0][0] if len(best) == k else 1)).tolist():
                one = (int(score[j]), -ids(int(self.order[a + j])))
                if len(best) < k:
                    heapq.heappush(best, one)
                elif one > best[0]:
                    heapq.heapreplace(best, one)
        return scored


def balls(batches):
    """Record batches of ``BALL`` rows (the last may have fewer)."""
    held, n = [], 0
    for b in batches:
        at = 0
        while at < b.num_rows:
            take = min(BALL - n, b.num_rows - at)
            held.append(b.slice(at, take))
            n, at = n + take, at + take
            if n == BALL:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def vectors(b: pa.RecordBatch, weight: np.ndarray, n_docs: int, n_terms: int):
    """(row, term, value) triples of a batch of counted documents."""
    off = np.asarray(b.column("term").offsets, np.int64)
    term = np.asarray(b.column("term").values, np.int64)[off[0]:off[-1]]
    tf = np.asarray(b.column("tf").values, np.int64)[off[0]:off[-1]]
    row = np.repeat(np.arange(b.num_rows), np.diff(off))
    return row, term, weight[term] * contributions(tf, np.asarray(b.column("n"), np.int64)[row], n_docs, n_terms)


def signed(batches, weight: np.ndarray, n_docs: int, n_terms: int):
    """The batches with ``s1``, ``s2``: the two terms that add most."""
    for b in batches:
        row, term, value = vectors(b, weight, n_docs, n_terms)
        order = np.lexsort((term, -value, row))
        at = np.searchsorted(row, np.arange(b.num_rows))
        size = np.bincount(row, minlength=b.num_rows)
        two = [np.where(size > k, term[order[np.minimum(at + k, len(row) - 1)]], -1) for k in range(2)]
        yield pa.RecordBatch.from_arrays([*b.columns, *[pa.array(x, pa.int32()) for x in two]], [*b.schema.names, "s1", "s2"])


def searched(batches, block: Block, weight: np.ndarray, n_docs: int, n_terms: int, k: int, tally: list | None = None):
    """The k best documents of a partition for every query of the block, as
    (q, id, score). ``tally`` gets (documents scored, documents offered) of
    each ball."""
    best = [[] for _ in block.terms]
    for b in balls(batches):
        row, term, value = vectors(b, weight, n_docs, n_terms)
        some = value > 0
        tree = BallTree(row[some], term[some], value[some], b.num_rows)
        ids = b.column("id")

        def id_of(j):
            x = ids[j].as_py()
            return NO_ID if x is None else x

        done = sum(tree.search(terms, id_of, k, heap) for terms, heap in zip(block.terms, best) if len(terms))
        if tally is not None:
            tally.append((done, b.num_rows * sum(len(t) > 0 for t in block.terms)))
    rows = [(q, None if r == -NO_ID else -r, s) for q, heap in enumerate(best) for s, r in heap]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64()))],
                                     ["q", "id", "score"])


def _search_block(src: DataFrame, texts: list[str], k: int) -> DataFrame:
    """(text, rank, id, score) of the distinct query texts of one block."""
    spark = src.sparkSession
    block = Shared(spark, queries := Block(texts))
    held = stored(src.mapInArrow(lambda it: counted(it, block.value), "id long, n long, term array<int>, tf array<long>"), "ball-terms")
    n_docs, n_terms = held.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(len(queries.keys), np.int64)
    for r in held.select(F.explode("term").alias("t")).groupBy("t").count().collect():  # a row per query term
        df[r["t"]] = r["count"]
    weight = weights(n_docs, df)
    order = ["s1", "s2", "n", "id"]
    alike = (held.filter(F.size("term") > 0)
             .mapInArrow(lambda it: signed(it, weight, n_docs, n_terms), "id long, n long, term array<int>, tf array<long>, s1 int, s2 int")
             .repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order))
    found = alike.mapInArrow(lambda it: searched(it, block.value, weight, n_docs, n_terms, k), "q int, id long, score long")
    ranked = [F.desc("score"), F.asc_nulls_last("id")]
    some = found.withColumn("part", F.pmod(F.xxhash64("id", "score"), F.lit(64)))
    some = some.withColumn("r", F.row_number().over(Window.partitionBy("q", "part").orderBy(*ranked))).filter(F.col("r") <= k)
    out = some.withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(*ranked))).filter(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(texts)), "q int, text string")  # about BLOCK bytes
    return out.join(F.broadcast(names), "q").select("text", "rank", "id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item, rank, id, score): for each row of ``items`` the ``k`` rows of
    ``docs`` that score highest, above 0; equal scores by ascending id.

    Ids of documents are integers; null ids are ranked after all others of
    their score, rows that repeat an id are documents of their own (equal
    rows take ranks one after another). Items that repeat an id or a text
    are each ranked; items without terms (null, empty) and items of an empty
    table of documents have no rows. Texts are read whole, other columns are
    not read."""
    need(docs, id_col, text_col)
    need(items, item_col, item_text)
    if k < 1:
        raise ValueError("k must be 1 or more")
    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    asked = items.select(items[item_col].alias("item"), items[item_text].alias("text")).filter("text IS NOT NULL")
    texts = asked.select("text").distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(-(-size // BLOCK), 1)
    out = None
    for b in range(blocks):
        mine = texts.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()  # about BLOCK bytes
        if mine or b == 0:
            got = _search_block(src, sorted(r["text"] for r in mine), k)
            out = got if out is None else out.unionByName(got)
    return asked.join(out, "text").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


#: DuckDB text of the query: all postings, no pruning.
REPORT_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}') AS t FROM documents),
i AS (SELECT DISTINCT item_id, unnest(
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{TERM}')) AS term FROM benchmark),
s AS (SELECT count(*) FILTER (len(t) > 0) AS n_docs, sum(len(t))::BIGINT AS n_terms FROM d),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d)
    WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
v AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))) AS x
    FROM p JOIN w USING (term), s),
t AS (SELECT item_id, r, doc_id, sum(x)::BIGINT AS score FROM i JOIN v USING (term) GROUP BY ALL HAVING sum(x) > 0),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM t)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= 50
"""

"""Token ids on disk: frequency-ranked ids in a byte-aligned
variable-length code with separate control bytes (operator 10).

File format (a Parquet table, one row per block of whole documents in
ascending id order; Spark commits it, so retried or lost tasks leave no
half-written file):

    shard       number of the range of document ids, ascending
    block       number of the block in its shard
    before      token ids in the shard before this block
    ids         the documents' ids
    lengths     token ids of each document
    ranking     the block's distinct token ids, most frequent first
                (little-endian uint32): rank -> token id
    control     2 bits per token id, four to a byte: data bytes - 1
    data        the ranks, 1 to 4 little-endian bytes each

A rank takes one byte for the 256 most frequent ids of the block, two for
the next 65,280 and so on. The control bytes are read through a table of
256 rows (byte -> four lengths) and the data with array indexing.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import file_bytes, need, partitions
from quarry.llm.text import flat_bytes, ragged, slices, span_hashes, word_spans, worker_store

#: Bytes of text whose ids make a block (a longer document is one block).
BLOCK_BYTES = 8 << 20


def length_table() -> np.ndarray:
    """Control byte -> the data lengths of its four numbers."""
    b = np.arange(256)
    return np.stack([(b >> (2 * k) & 3) + 1 for k in range(4)], 1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of uint32 numbers."""
    ranks = ranks.astype("<u4")
    extra = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[:len(ranks)] = extra
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers back, by table lookup."""
    size = length_table()[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(size, dtype=np.int64)
    at = ends - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        if len(more):
            out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def rank_by_frequency(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank of each id, distinct ids by falling count, ties by id)."""
    count = np.bincount(ids) if len(ids) else np.zeros(0, np.int64)
    seen = np.flatnonzero(count)
    order = seen[np.argsort(-count[seen], kind="stable")]
    rank = np.zeros(len(count), np.uint32)
    rank[order] = np.arange(len(order), dtype=np.uint32)
    return rank[ids] if len(ids) else np.zeros(0, np.uint32), order.astype("<u4")


class WordIds:
    """Word hash -> token ids, as sorted arrays; emptied when full, so it
    affects speed only."""

    LIMIT = 3_000_000

    def __init__(self):
        self.key, self.start, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.pool = np.zeros(0, "<u4")

    def missing(self, keys: np.ndarray) -> np.ndarray:
        if len(self.key) + len(keys) > self.LIMIT:
            self.__init__()
        if not len(self.key):
            return np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.key, keys), len(self.key) - 1)
        return self.key[at] != keys

    def add(self, keys: np.ndarray, ids: np.ndarray, size: np.ndarray) -> None:
        start = len(self.pool) + np.cumsum(size) - size
        self.pool = np.concatenate([self.pool, ids])
        at = np.searchsorted(self.key, keys)
        self.key, self.start, self.size = (np.insert(a, at, b) for a, b in
                                           ((self.key, keys), (self.start, start), (self.size, size)))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, keys)
        return self.start[at], self.size[at]


class WordEncoder:
    """Ids of whole texts by the tokenizers library, each distinct
    white-space-separated word encoded once per worker.

    Valid for tokenizers whose words never cross white space and that drop
    it; ``check`` compares with whole-text encoding on a probe. Words are
    the runs between ASCII white space; other white space inside them is
    left to the library. They are known by a 64-bit hash."""

    def __init__(self, spec: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_str(spec.decode())
        self.words: WordIds = worker_store().setdefault("word_ids", WordIds())

    def check(self) -> None:
        probe = "It's a  test,\n\tof 12 WORDS' and more <|endoftext|>."
        whole = self.library.encode(probe, add_special_tokens=False).ids
        if whole != [i for w in probe.split() for i in self.library.encode(w, add_special_tokens=False).ids]:
            raise ValueError("this tokenizer's words cross white space")

    def _learn(self, words: list[str], keys: np.ndarray) -> None:
        """Encode new words, joined by spaces, and cut the ids by offset."""
        ids, size = [], np.zeros(len(words), np.int32)
        for at in range(0, len(words), 512):
            some = words[at:at + 512]
            e = self.library.encode(" ".join(some), add_special_tokens=False)
            begin = np.cumsum([0] + [len(w) + 1 for w in some[:-1]])
            tokens = np.array(e.offsets, np.int64).reshape(-1, 2)[:, 0]
            size[at:at + len(some)] = np.bincount(np.searchsorted(begin, tokens, side="right") - 1, minlength=len(some))
            ids.append(np.array(e.ids, "<u4"))
        self.words.add(keys, np.concatenate(ids), size)

    def encode(self, col) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, ids per text)."""
        data, off = flat_bytes(col)
        starts, ends, first = word_spans(data, off)
        keys, at, of = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        new = np.flatnonzero(self.words.missing(keys))
        if len(new):
            raw = data.tobytes()
            some = [raw[a:z].decode() for a, z in zip(starts[at[new]].tolist(), ends[at[new]].tolist())]
            self._learn(some, keys[new])
        begin, size = self.words.find(keys)
        ids = self.words.pool[ragged(begin[of], size[of])]
        total = np.concatenate([[0], np.cumsum(size[of], dtype=np.int64)])
        return ids, np.diff(total[first])


def write_token_store(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text") -> None:
    """Encode every text, append ``end_id``, write the files in id order.

    Documents are dealt out by ranges of their id (Spark samples the id
    column), sorted inside a range, encoded in blocks as they stream by and
    written; the corpus passes the tokenizer once and no task holds more
    than a block. A null or empty text is the end id alone; a null id sorts
    first; repeated ids follow each other in the order of their texts; an
    empty table writes no rows; other columns are not read. Many rows of
    one id stay in one range: ids are expected to be nearly unique."""
    need(docs, id_col, text_col)
    spark = docs.sparkSession
    spec = file_bytes(tokenizer_path)
    WordEncoder(spec).check()
    spec = spark.sparkContext.broadcast(spec)
    src = docs.select(docs[id_col].cast("long").alias("id"), docs[text_col].alias("text"))
    ordered = (src.repartitionByRange(partitions(spark), "id").withColumn("shard", F.spark_partition_id())
               .sortWithinPartitions("id", "text"))

    def blocks(batches):
        encoder, block, before = WordEncoder(spec.value), 0, 0
        for part in slices(batches, "text", BLOCK_BYTES):
            ids, lengths = [], []
            for b in slices([part], "text"):
                flat, size = encoder.encode(b.column("text"))
                ids.append(np.insert(flat, np.cumsum(size), end_id))
                lengths.append(size + 1)
            ids, lengths = np.concatenate(ids), np.concatenate(lengths)
            ranks, ranking = rank_by_frequency(ids)
            control, data = encode_ranks(ranks)
            yield pa.RecordBatch.from_pydict({
                "shard": [part.column("shard")[0].as_py()], "block": [block], "before": [before],
                "ids": [part.column("id").to_pylist()], "lengths": [lengths.tolist()], "ranking": [ranking.tobytes()],
                "control": [control], "data": [data]}, schema=BLOCK_ARROW)
            block, before = block + 1, before + len(ids)

    ordered.mapInArrow(blocks, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)


BLOCK_SCHEMA = ("shard int, block int, before long, ids array<long>, lengths array<long>, ranking binary, "
                "control binary, data binary")
BLOCK_ARROW = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()),
                         ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("ranking", pa.binary()),
                         ("control", pa.binary()), ("data", pa.binary())])


def block_ids(row: dict) -> np.ndarray:
    """A block's token ids."""
    ranks = decode_ranks(row["control"], row["data"], sum(row["lengths"]))
    return np.frombuffer(row["ranking"], "<u4")[ranks]


def read_token_store(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """(id, start, n_tokens, ids_crc32[, token_ids]) of every document, from
    the files: ``start`` counts the ids of all documents before it. One row
    per shard is summed up to find where a shard starts."""
    files = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    size = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    upto = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row per shard: few
    shards = (files.select("shard", size.alias("n")).groupBy("shard").agg(F.sum("n").alias("n"))
              .select("shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("shard_start")))

    def rows(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = block_ids(row)
                ends = np.cumsum(row["lengths"], dtype=np.int64)
                starts = ends - np.array(row["lengths"], np.int64)
                each = [ids[a:z] for a, z in zip(starts.tolist(), ends.tolist())]
                cols = [pa.array([row["shard"]] * len(each), pa.int32()), pa.array(row["ids"], pa.int64()),
                        pa.array(starts + row["before"]), pa.array(row["lengths"], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64())]
                names = ["shard", "id", "at", "n_tokens", "ids_crc32"]
                if tokens:
                    cols.append(pa.array([x.astype(np.int64) for x in each], pa.list_(pa.int64())))
                    names.append("token_ids")
                yield pa.RecordBatch.from_arrays(cols, names)

    out = files.mapInArrow(rows, "shard int, id long, at long, n_tokens long, ids_crc32 long"
                           + ", token_ids array<long>" * tokens)
    return (out.join(F.broadcast(shards), "shard")
            .select("id", (F.col("at") + F.col("shard_start")).alias("start"), "n_tokens", "ids_crc32",
                    *["token_ids"] * tokens))

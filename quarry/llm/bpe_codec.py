"""Byte-level BPE encoding and decoding by a global distinct-word shuffle
(operator 9).

1. Every text is cut into pre-tokens (matches of the tokenizer's pattern).
   The pre-tokens of a block of documents (tens of MB) are numbered; a
   document keeps the numbers in text order, so position = place in its
   array. The block's distinct pre-tokens are dealt by hash into buckets and
   explode to one row per (block, bucket) with the packed words of it.
2. A shuffle by bucket brings together all of the corpus' words of a hash
   range; each distinct word is encoded there once, the merges of all words
   of a batch applied together (``bpe.merge_all``).
3. The ids go back to their block, join its word numbers, and each document
   is put together by position. Decoding joins the ids with the token-byte
   table.

A word that fills a third of the corpus is one entry per block in step 1,
so no shuffle partition is hot; blocks are bounded by bytes of text, however
documents are distributed.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.bpe import MergeTable, merge_all, pairs_of
from quarry.llm.common import Shared, file_bytes, need, partitions, stored
from quarry.llm.text import as_utf8, slices
from quarry.llm.token_store import decode_ranks, encode_ranks

#: Bytes of text of one block (a longer single document is one block).
BLOCK_BYTES = 32 << 20
#: Most word buckets of a block (fewer shuffle partitions give fewer).
MOST_BUCKETS = 4096


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes -> rank from a file of ``base64 rank`` lines."""
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a}


class ByteModel:
    """Merges of a byte-level vocabulary where rank = token id."""

    def __init__(self, ranks: dict[bytes, int]):
        singles = [bytes([b]) for b in range(256)]
        if any(s not in ranks for s in singles):
            raise ValueError("a byte-level vocabulary holds all 256 bytes")
        self.byte = np.array([ranks[s] for s in singles], np.int32)
        self.table: MergeTable = pairs_of(ranks, [t for t in ranks if len(t) > 1], ranks)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, ids per word)."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        sym, _, left = merge_all(self.table, self.byte[np.frombuffer(b"".join(words), np.uint8)], lengths)
        return sym, left


UNIT = re.compile(r"\s*\S+|\s+")


def splitter(pattern: str):
    """``text -> pre-tokens``, all matches of ``pattern`` in order.

    The text is first cut into units (white space and the visible run after
    it), across which no match of the pattern can reach, and each distinct
    unit is matched once. That holds for patterns whose matches are a visible
    run with at most one leading space, or white space; others are matched
    on the whole text."""
    import regex

    import public_tokenizers
    whole = regex.compile(pattern)
    if pattern != public_tokenizers.PATTERN:
        return lambda text: [text], whole.findall
    return UNIT.findall, whole.findall


def odd_space(text: str) -> bool:
    """Characters that the two regular expression engines may class
    differently as white space: such texts are matched whole."""
    return any(c in text for c in "\x1c\x1d\x1e\x1f\x85")


def pack(numbers: np.ndarray) -> bytes:
    """int32 numbers: control and data bytes, each compressed."""
    control, data = encode_ranks(numbers)
    small = squeeze(control)
    return struct.pack("<II", len(small), len(data)) + small + squeeze(data)


def squeeze(data: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=6).compress(data, asbytes=True)


def by_frequency(placed: list[np.ndarray], n: int) -> np.ndarray:
    """number -> rank by falling count (ties by number)."""
    count = np.bincount(np.concatenate(placed), minlength=n) if placed else np.zeros(n, np.int64)
    rank = np.empty(n, np.int32)
    rank[np.argsort(-count, kind="stable")] = np.arange(n, dtype=np.int32)
    return rank


def unpack(packed: bytes, n: int) -> np.ndarray:
    size, width = struct.unpack("<II", packed[:8])
    control = pa.decompress(packed[8:8 + size], -(-n // 4), "zstd", asbytes=True)
    return decode_ranks(control, pa.decompress(packed[8 + size:], width, "zstd", asbytes=True), n).view(np.int32)


class Block:
    """Documents of a block as numbers of its distinct words."""

    def __init__(self, units_of, match):
        self.units_of, self.match = units_of, match
        self.number: dict[str, int] = {}
        self.known: dict[str, bytes] = {}
        self.ids, self.placed, self.size = [], [], 0

    def add(self, ids: list, texts: list) -> None:
        self.ids += ids
        for text in texts:
            text = text or ""
            self.size += len(text)
            units = [text] if odd_space(text) else self.units_of(text)
            for u in set(units).difference(self.known):
                self.known[u] = np.array([self.number.setdefault(w, len(self.number)) for w in self.match(u)], np.int32).tobytes()
            self.placed.append(np.frombuffer(b"".join(map(self.known.__getitem__, units)), np.int32))

    def packed(self, buckets: int) -> tuple[bytes, list[int], list[dict]]:
        """(word numbers of all documents, numbers per document, buckets)."""
        rank = by_frequency(self.placed, len(self.number))  # small numbers for frequent words pack better
        dealt = [[] for _ in range(buckets)]
        for w, n in zip(self.number, rank.tolist()):
            w = w.encode()
            dealt[zlib.crc32(w) % buckets].append((w, n))
        parts = []
        for d in dealt:
            d.sort()
            words = b"".join(w for w, _ in d)
            parts.append({"count": len(d), "numbers": pack(np.array([n for _, n in d], np.int32)),
                          "sizes": pack(np.array([len(w) for w, _ in d], np.int32)), "width": len(words), "words": squeeze(words)})
        return pack(rank[np.concatenate(self.placed)]), [len(x) for x in self.placed], parts


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", decoded: bool = True) -> DataFrame:
    """(id, n_tokens, ids array<int>[, decoded binary]) of every text; edge
    cases as in ``encoded_digests``."""
    def row(words):
        tokens, texts = words
        def result(nums):
            ids = np.concatenate([tokens[i] for i in nums]) if nums else np.zeros(0, np.int32)
            return len(ids), ids, *([b"".join(map(texts.__getitem__, nums))] if decoded else [])
        return result
    return _encode(docs, ranks_path, pattern, id_col, text_col, row, "ids array<int>" + ", decoded binary" * decoded)


def encoded_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every text.

    A null or empty text has no ids and decodes to no bytes. Repeated rows
    and ids give one result row each; a null id stays null; an empty table
    gives an empty one; columns other than id and text are not read, so
    their names cannot clash. A text of any length is encoded whole."""
    def row(words):
        tokens, texts = words
        size = [len(t) for t in tokens]
        shown = [",".join(map(str, t.tolist())).encode() for t in tokens]
        def result(nums):
            return (sum(map(size.__getitem__, nums)),
                    hashlib.sha256(b",".join(map(shown.__getitem__, nums))).hexdigest(),
                    hashlib.sha256(b"".join(map(texts.__getitem__, nums))).hexdigest())
        return result
    return _encode(docs, ranks_path, pattern, id_col, text_col, row, "ids_sha256 string, decoded_sha256 string")


def _encode(docs, ranks_path, pattern, id_col, text_col, row, columns):
    need(docs, id_col, text_col)
    spark = docs.sparkSession
    ranks = read_ranks(file_bytes(ranks_path))
    model = Shared(spark, ByteModel(ranks))                 # fixed by the vocabulary
    of_id = [b""] * (max(ranks.values()) + 1)
    for t, i in ranks.items():
        of_id[i] = t
    token_bytes = spark.sparkContext.broadcast(of_id)       # the token-byte table, fixed as well
    buckets = min(partitions(spark), MOST_BUCKETS)
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    part = pa.struct([("count", pa.int32()), ("numbers", pa.binary()), ("sizes", pa.binary()),
                      ("width", pa.int32()), ("words", pa.binary())])

    def cut(batches):
        """One row per block: the documents' ids, their word numbers in text
        order, and the distinct words with their numbers, dealt by hash into
        buckets and sorted there. A block may span many Arrow batches; only
        numbers and distinct words are held."""
        units_of, match = splitter(pattern)
        block = Block(units_of, match)
        for b in slices(batches, "text"):
            block.add(b.column("id").to_pylist(), as_utf8(b.column("text")).to_pylist())
            if block.size >= BLOCK_BYTES:
                yield row_of(block, b.column("id").type)
                block = Block(units_of, match)
        if block.ids:
            yield row_of(block, b.column("id").type)

    def row_of(block, id_kind):
        return pa.RecordBatch.from_arrays(
            [pa.array([block.ids], pa.list_(id_kind)), *(pa.array([v], k) for v, k in zip(
                block.packed(buckets), (pa.binary(), pa.list_(pa.int32()), pa.list_(part))))], ["ids", "places", "lengths", "parts"])

    blocks = stored(src.mapInArrow(cut, f"ids array<{id_type}>, places binary, lengths array<int>, parts array<struct"
                                        "<count:int,numbers:binary,sizes:binary,width:int,words:binary>>")
                    .withColumn("block", F.monotonically_increasing_id()), "bpe-blocks")

    def encode(batches):
        """A bucket holds every distinct word of its hash range: each is
        encoded the first time it is seen (the memo is bounded)."""
        m = model.value
        known: dict[bytes, bytes] = {}
        for b in batches:
            lists = []
            for r in b.select(["count", "sizes", "width", "words"]).to_pylist():
                ends = np.cumsum(unpack(r["sizes"], r["count"])).tolist()
                words = pa.decompress(r["words"], r["width"], "zstd", asbytes=True)
                lists.append([words[a:z] for a, z in zip([0, *ends], ends)])
            if len(known) > 400_000:
                known.clear()
            new = list(set().union(*lists).difference(known))
            ids, n = m.encode(new)
            raw, ends = ids.astype("<i4").tobytes(), (4 * np.cumsum(n)).tolist()
            known.update(zip(new, [raw[a:z] for a, z in zip([0, *ends], ends)]))
            tokens = [[known[w] for w in x] for x in lists]
            flat = [np.frombuffer(b"".join(x), "<i4") for x in tokens]
            yield pa.RecordBatch.from_arrays(
                [b.column("block"), b.column("bucket"), pa.array([pack(np.array([len(t) // 4 for t in x], np.int32)) for x in tokens], pa.binary()),
                 pa.array([len(x) for x in flat], pa.int32()), pa.array(list(map(pack, flat)), pa.binary())],
                ["block", "bucket", "sizes", "total", "tokens"])

    dealt = blocks.select("block", F.posexplode("parts").alias("bucket", "part")).filter("part.count > 0")
    coded = (dealt.select("block", "bucket", "part.count", "part.sizes", "part.width", "part.words")
             .repartition(buckets, "bucket")
             .mapInArrow(encode, "block long, bucket int, sizes binary, total int, tokens binary"))

    def assemble(left: pa.Table, right: pa.Table) -> pa.Table:
        reply = {r["bucket"]: r for r in right.to_pylist()}
        ids, out = [], []
        for block in left.to_pylist():
            tokens = [None] * sum(p["count"] for p in block["parts"])
            for k, p in enumerate(block["parts"]):
                if p["count"]:
                    flat = unpack(reply[k]["tokens"], reply[k]["total"])
                    ends = np.cumsum(unpack(reply[k]["sizes"], p["count"])).tolist()
                    for n, a, z in zip(unpack(p["numbers"], p["count"]).tolist(), [0, *ends], ends):
                        tokens[n] = flat[a:z]
            table = token_bytes.value
            texts = [b"".join([table[i] for i in t.tolist()]) for t in tokens]  # ids joined with the token-byte table
            result = row((tokens, texts))
            ids += block["ids"]
            ends = np.cumsum(block["lengths"]).tolist()
            flat = unpack(block["places"], ends[-1])
            out += [result(flat[a:z].tolist()) for a, z in zip([0, *ends], ends)]
        kinds = [pa.int64(), *({"array<int>": pa.list_(pa.int32()), "binary": pa.binary(), "string": pa.string()}[c.split()[-1]]
                               for c in columns.split(", "))]
        names = ["id", "n_tokens", *(c.split()[0] for c in columns.split(", "))]
        cols = list(zip(*out)) if out else [[] for _ in kinds]
        return pa.Table.from_arrays([pa.array(ids, left.schema.field("ids").type.value_type),
                                     *(pa.array(list(c), k) for c, k in zip(cols, kinds))], names=names)

    numbered = F.transform("parts", lambda p: F.struct(p["count"].alias("count"), p["numbers"].alias("numbers"))).alias("parts")
    out = (blocks.select("block", "ids", "places", "lengths", numbered).groupBy("block").cogroup(coded.groupBy("block"))
           .applyInArrow(assemble, f"id {id_type}, n_tokens long, {columns}"))
    return out.withColumnRenamed("id", id_col)

"""Token counts by rank-synchronous array merging (operator 1).

The counts equal the sentencepiece BPE model's own encoding (byte fallback,
dummy prefix, no added tokens). A text is cut into pre-tokens where no
piece of the vocabulary can reach across: before a run of spaces that
follows another character, and around line ends. Distinct pre-tokens of a
slice are held as ragged rows of one numpy array, every row applies its
lowest-ranked pair in each round (``bpe.merge_all``), and the surviving
symbols are counted: a known piece is one token, an unknown character as
many as its UTF-8 bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 — pa.compute
from pyspark.sql import DataFrame

from quarry.llm.bpe import MergeTable, merge_all, pairs_of
from quarry.llm.common import Shared, file_bytes, need
from quarry.llm.text import as_utf8, bounded_cache, slices

SPACE = "▁"


class PieceModel:
    """What the counter needs of a sentencepiece BPE model."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        plain = [i for i in range(sp.vocab_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        pieces = {sp.id_to_piece(i): i for i in plain}
        score = {p: sp.get_score(i) for p, i in pieces.items()}
        order = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        if any(re.search(f"[^{SPACE}]{SPACE}|\n", p) for p in pieces):
            raise ValueError("a piece crosses a space or a line end; this cutting does not hold for it")
        if sp.normalize(" Ａ  b\t") != f"{SPACE}{SPACE}Ａ{SPACE}{SPACE}b\t":
            raise ValueError("the model normalises its input or adds no dummy prefix")
        symbols = dict(pieces)
        for p in pieces:  # characters inside pieces that are no piece themselves
            for c in p:
                symbols.setdefault(c, sp.vocab_size() + len(symbols))
        self.known = np.zeros(max(symbols.values()) + 2, bool)
        self.known[list(pieces.values())] = True
        self.char = np.full(0x110000, len(self.known) - 1, np.int32)  # the last symbol: not in the vocabulary
        for c, i in symbols.items():
            if len(c) == 1:
                self.char[ord(c)] = i
        self.table: MergeTable = pairs_of(symbols, [p for p in pieces if len(p) > 1], {p: order[s] for p, s in score.items()})

    def counts(self, pretokens: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        lengths = np.fromiter(map(len, pretokens), np.int64, len(pretokens))
        code = np.frombuffer("".join(pretokens).encode("utf-32-le", "surrogatepass"), np.uint32)
        sym, pos, left = merge_all(self.table, self.char[code], lengths)
        c = code[pos]
        bytes_of = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        weight = np.where(self.known[sym], 1, bytes_of)
        out = np.zeros(len(pretokens), np.int64)
        full = left > 0
        ends = np.cumsum(left[full])
        if len(ends):
            out[full] = np.add.reduceat(weight, ends - left[full])
        return out


CUT = re.compile(f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+")


def pretokens_of(text: str) -> list[str]:
    """The text's pre-tokens, in order, spaces as the model writes them."""
    if not text:
        return []
    return CUT.findall(SPACE + text.replace(" ", SPACE))


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every text.

    A null or empty text has 0 bytes and 0 tokens. Rows stay as they are:
    repeated rows give repeated results, a null id stays null, an empty
    table gives an empty one; other columns are not read. A text of any
    length is counted whole; its memory is a few times its own size.
    No shuffle: one pass in Arrow batches.
    """
    need(docs, id_col, text_col)
    model = Shared(docs.sparkSession, PieceModel(file_bytes(model_path)))

    def run(batches):
        m = model.value
        for b in slices(batches, "text"):
            lists = [pretokens_of(t or "") for t in as_utf8(b.column("text")).to_pylist()]
            cache = bounded_cache("piece_counts", 300_000)
            new = list(set().union(*lists).difference(cache))
            if new:
                cache.update(zip(new, m.counts(new).tolist()))
            n = [sum(map(cache.__getitem__, x)) for x in lists]
            size = pa.compute.fill_null(pa.compute.binary_length(b.column("text")), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), size, pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                ["id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = src.schema["id"].dataType.simpleString()
    out = src.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("id", id_col)

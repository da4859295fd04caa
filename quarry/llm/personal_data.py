"""Personal data: fixed patterns, and a linear-chain conditional random field
over word shapes that adds what the patterns miss (operator 11).

*Base spans* are the leftmost non-overlapping matches of four patterns (with
their checks), found on the flat bytes of a slice by runs of characters, so a
text of any shape costs linear time.

*Added spans*: a text is a row of tokens (runs of letters, runs of digits,
single signs). Windows around digits and ``@`` are chains; each token's
emission is the sum of learned weights of its shape, the shapes around it, how
they are glued together, and of the digit group it belongs to (number of
digits, separators, whether check digits hold). Learned transitions join
neighbours, Viterbi decodes all chains of a slice step by step in numpy. A
decoded span is added if it passes the check of its kind (digit counts, Luhn,
parts of an address) and touches no base span.

The field is trained on a small labelled table (``label_table``): lines of a
sample of documents with their base spans, and the same lines with a span
rewritten as people write it to avoid patterns (``name [at] host [dot] org``,
numbers without ``+``, other separators), or with look-alikes (dates, prices,
versions, numbers with a wrong check digit) that are no personal data.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import Shared, need, stored
from quarry.llm.folds import by_hash
from quarry.llm.langid import Chains
from quarry.llm.text import as_utf8, flat_bytes, mix, slices

KINDS = ("email", "ip", "card", "phone")
#: Tokens kept on each side of a digit or @, and in a chain at most.
REACH, CHAIN = 8, 512
BITS = 14
SPAN = "struct<kind:string,start:int,end:int,base:boolean>"
LABELLED = "line string, spans array<struct<kind:string,start:int,end:int>>"

_DOMAIN = re.compile(rb"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PHONE = re.compile(rb"\+[0-9][\x20().0-9-]+[0-9]")


def _table(chars: str) -> np.ndarray:
    t = np.zeros(256, bool)
    t[np.frombuffer(chars.encode(), np.uint8)] = True
    return t


_AZ = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
IS_DIGIT, IS_LOCAL = _table("0123456789"), _table(_AZ + _AZ.lower() + "0123456789._%+-")
IS_UPPER, IS_LOWER, IS_BLANK = _table(_AZ), _table(_AZ.lower()), _table(" \t\r\v\f")
IS_LETTER = IS_UPPER | IS_LOWER | (np.arange(256) >= 128)


def luhn(digits: bytes) -> bool:
    d = [c - 48 for c in digits[::-1]]
    return (sum(d[::2]) + sum(2 * x - 9 * (x > 4) for x in d[1::2])) % 10 == 0


def octet(digits: bytes) -> bool:
    short = digits.lstrip(b"0")
    return len(short) <= 3 and int(short or b"0") <= 255


def only_digits(b: bytes) -> bytes:
    return bytes(c for c in b if 48 <= c <= 57)


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the runs of true values."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def lined(col) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts, each with a line break at its end, so
    that no run of characters reaches the next text; a null is empty."""
    col = as_utf8(col)
    return flat_bytes(pc.binary_join_element_wise(col.fill_null("") if col.null_count else col, "\n", ""))


def base_spans(data: np.ndarray) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base matches, in bytes, by kind and start."""
    buf, out = data.tobytes(), []
    at = np.flatnonzero(data == 64)
    if len(at):
        before = np.maximum.accumulate(np.where(IS_LOCAL[data], -1, np.arange(len(data))))  # last sign that ends a local part
        done = 0
        for p in at.tolist():
            m = _DOMAIN.match(buf, p + 1)
            start = max(int(before[p - 1]) + 1 if p else 0, done)
            if m and start < p:
                out.append((0, start, m.end()))
                done = m.end()
    s, e = runs_of(IS_DIGIT[data])
    gap = np.where(s[1:] - e[:-1] == 1, data[np.minimum(e[:-1], len(data) - 1)], 0) if len(s) else np.zeros(0, np.uint8)

    def groups(linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last+1 digit run of each linked group."""
        cut = np.flatnonzero(~linked) + 1
        return np.concatenate([[0], cut]), np.concatenate([cut, [len(s)]])

    if len(s):
        a, b = groups(gap == 46)
        for i, j in zip(a[b - a >= 4].tolist(), b[b - a >= 4].tolist()):
            for k in range(i, j - 3, 4):
                if all(octet(buf[s[x]:e[x]]) for x in range(k, k + 4)):
                    out.append((1, int(s[k]), int(e[k + 3])))
        a, b = groups((gap == 32) | (gap == 45))
        n = np.add.reduceat(e - s, a)
        for i, j in zip(a[(n >= 13) & (n <= 19)].tolist(), b[(n >= 13) & (n <= 19)].tolist()):
            if luhn(only_digits(buf[s[i]:e[j - 1]])):
                out.append((2, int(s[i]), int(e[j - 1])))
        plus = np.flatnonzero(data[:-1] == 43)
        for p in plus[IS_DIGIT[data[plus + 1]]].tolist():
            m = _PHONE.match(buf, p)
            if m and 9 <= len(only_digits(m.group())) <= 15:
                out.append((3, p, m.end()))
    return out


# ---------------------------------------------------------------- word shapes
#: Words with a shape of their own.
_WORDS = {w: 20 + k for k, w in enumerate((b"at", b"dot", b"com", b"org", b"net", b"mail", b"tel", b"phone", b"fax", b"card", b"ip"))}


class Tokens:
    """Tokens of a slice that lie in windows around digits and ``@``, with
    shape, glue to the token before, and chains."""

    def __init__(self, data: np.ndarray):
        kind = np.full(256, 9, np.int8)
        kind[IS_LETTER], kind[IS_DIGIT], kind[IS_BLANK], kind[10] = 1, 2, 0, 3
        k = kind[data]
        first = np.ones(len(data), bool)
        first[1:] = (k[1:] != k[:-1]) | (k[1:] == 9) | (k[1:] == 3)
        start = np.flatnonzero(first)
        end = np.append(start[1:], len(data))
        solid = k[start] > 0
        start, end, k = start[solid], end[solid], k[start][solid]
        # windows around triggers, within lines
        hot = np.flatnonzero((k == 2) | (data[start] == 64))
        reach = np.zeros(len(start) + 1, np.int32)
        np.add.at(reach, np.maximum(hot - REACH, 0), 1)
        np.add.at(reach, np.minimum(hot + REACH + 1, len(start)), -1)
        near = (np.cumsum(reach[:-1]) > 0) & (k != 3)
        a, b = runs_of(near)
        keep = np.flatnonzero(near)
        self.start, self.end, k = start[keep], end[keep], k[keep]
        pieces = -(-(b - a) // CHAIN)
        base = np.cumsum(b - a) - (b - a)
        step = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        self.chain = np.repeat(base, pieces) + CHAIN * step
        self.size = np.minimum(np.repeat(base + (b - a), pieces) - self.chain, CHAIN)
        self.glued = np.zeros(len(keep), bool)
        if len(keep) > 1:
            self.glued[1:] = self.start[1:] == self.end[:-1]
        self.data, self.kind = data, k
        self.shape = self._shapes()
        self.group = self._digit_groups()

    def _shapes(self) -> np.ndarray:
        size, first, last = self.end - self.start, self.data[self.start], self.data[self.end - 1]
        letters = 1 + IS_UPPER[first] + 2 * IS_UPPER[last] + 4 * np.minimum(size > 3, 1)
        out = np.where(self.kind == 1, letters, np.where(self.kind == 2, 32 + np.minimum(size, 20), 64 + np.minimum(first, 127)))
        for i in np.flatnonzero((self.kind == 1) & (size <= 5)).tolist():
            word = _WORDS.get(self.data[self.start[i]:self.end[i]].tobytes().lower())
            if word:
                out[i] = word
        return out

    def _digit_groups(self) -> np.ndarray:
        """For digit tokens a number for their group, digits joined by at
        most three signs or blanks: its digits, separator and checks."""
        out = np.zeros(len(self.start), np.int64)
        d = np.flatnonzero(self.kind == 2)
        if not len(d):
            return out
        buf = self.data.tobytes()
        s, e = self.start[d], self.end[d]
        gap = s[1:] - e[:-1]
        total = np.concatenate([[0], np.cumsum((IS_LETTER[self.data] & ~IS_DIGIT[self.data]) | (self.data == 10))])
        linked = (gap <= 3) & (total[s[1:]] == total[e[:-1]])
        cut = np.flatnonzero(~linked) + 1
        for i, j in zip([0, *cut.tolist()], [*cut.tolist(), len(d)]):
            n = int((e[i:j] - s[i:j]).sum())
            sep = min({buf[e[x]] for x in range(i, min(j - 1, i + 20))}, default=0)
            check = 13 <= n <= 19 and luhn(only_digits(buf[s[i]:e[j - 1]]))
            four = j - i == 4 and all(octet(buf[s[x]:e[x]]) for x in range(i, j))
            out[d[i:j]] = 1 + min(n, 24) + 32 * min(j - i, 7) + 256 * check + 512 * four + 1024 * (sep % 128)
        return out

    def features(self) -> np.ndarray:
        """Bucket numbers, a row of equal length for every token."""
        n = len(self.start)
        edge = np.zeros(n, np.int64)
        edge[self.chain[self.chain < n]] = 1
        s = np.concatenate([[0, 0], self.shape, [0, 0]]).astype(np.uint64)
        g = np.concatenate([self.glued.astype(np.uint64), np.zeros(2, np.uint64)])
        far = np.concatenate([[0, 0], edge, [1, 1]])
        here, back, ahead = s[2:-2], s[1:-3] * (far[2:-2] == 0), s[3:-1] * (far[3:-1] == 0)
        back2 = s[:-4] * ((far[2:-2] == 0) & (far[1:-3] == 0))
        ahead2 = s[4:] * ((far[3:-1] == 0) & (far[4:] == 0))
        group = self.group.astype(np.uint64)
        g0, g1 = g[:-2], g[1:-1]
        u = np.uint64
        cells = [here, back * u(2) + g0, ahead * u(2) + g1, (here * u(256) + back) * u(2) + g0, (here * u(256) + ahead) * u(2) + g1,
                 back2 * u(256) + back, ahead * u(256) + ahead2, group, group * u(256) + back, (group & u(1023)) * u(2) + g0,
                 (back * u(256) + here) * u(256) + ahead]
        return np.stack([(mix(c * u(16) + u(i)) >> u(64 - BITS)).astype(np.int64) for i, c in enumerate(cells)], 1)


LABELS = 1 + 2 * len(KINDS)  # 0 outside, then first and further token of each kind


def _illegal() -> np.ndarray:
    out = np.zeros((LABELS, LABELS))
    for k in range(len(KINDS)):
        out[:, 2 + 2 * k] = -30.0
        out[[1 + 2 * k, 2 + 2 * k], 2 + 2 * k] = 0.0
    return out


class Field:
    """A fitted field: hashed feature weights and transitions."""

    def __init__(self):
        self.weight = np.zeros((1 << BITS, LABELS), np.float32)
        self.trans = _illegal()

    def fit(self, lines: list[str], spans: list[list[tuple[int, int, int]]], rounds: int = 60, rate: float = 0.3,
            ridge: float = 1e-5) -> None:
        data, off = lined(pa.array(lines, pa.string()))
        if not len(data):
            return
        t = Tokens(data)
        if not len(t.start):
            return
        gold = np.zeros(len(t.start), np.int64)
        for line, own in enumerate(spans):
            head = lines[line]
            for kind, a, b in own:
                lo, hi = (int(off[line]) + len(head[:x].encode()) for x in (a, b))
                x, y = np.searchsorted(t.start, [lo, hi])
                gold[x:y] = 2 + 2 * kind
                gold[x:x + 1] = 1 + 2 * kind
        cells, chains = t.features(), Chains(t.chain, t.size)
        inner = np.ones(len(gold), bool)
        inner[t.chain] = False
        here = np.flatnonzero(inner)
        told = np.zeros_like(self.trans)
        np.add.at(told, (gold[here - 1], gold[here]), 1)
        target, sums = np.eye(LABELS)[gold], [np.zeros_like(self.weight), np.zeros_like(self.trans)]
        legal = _illegal() == 0
        for _ in range(rounds):  # AdaGrad on the conditional log-likelihood
            post, counts, _ = chains.posteriors(self.weight[cells].sum(1).astype(float), self.trans, pairs=True)
            diff = target - post
            grad = np.stack([np.bincount(cells.ravel(), np.repeat(diff[:, k], cells.shape[1]), len(self.weight))
                             for k in range(LABELS)], 1)
            for param, g, total in ((self.weight, grad / len(gold) - ridge * self.weight, sums[0]),
                                    (self.trans, ((told - counts) / len(gold) - ridge * self.trans) * legal, sums[1])):
                total += (g * g).astype(total.dtype)
                param += (rate * g / (np.sqrt(total) + 1e-7)).astype(param.dtype)

    def decode(self, t: Tokens) -> np.ndarray:
        """The best label of every token (Viterbi over all chains at once)."""
        emission = self.weight[t.features()].sum(1).astype(float)
        chains = Chains(t.chain, t.size)
        best, back = np.empty_like(emission), np.zeros(emission.shape, np.int8)
        start = _illegal()[0]
        for step, n in enumerate(chains.active):
            i = chains.starts[:n] + step
            if step == 0:
                best[i] = emission[i] + start
                continue
            way = best[i - 1][:, :, None] + self.trans
            back[i] = way.argmax(1)
            best[i] = way.max(1) + emission[i]
        label, now = np.zeros(len(emission), np.int8), np.zeros(len(chains.starts), np.int64)
        for step in range(len(chains.active) - 1, -1, -1):
            n = chains.active[step]
            longer = chains.active[step + 1] if step + 1 < len(chains.active) else 0
            i = chains.starts[:n] + step
            now[longer:n] = best[i[longer:]].argmax(1)
            label[i] = now[:n]
            now[:n] = back[i, now[:n]]
        return label

    def found(self, data: np.ndarray) -> list[tuple[int, int, int]]:
        """Decoded spans (kind, start, end), in bytes."""
        t = Tokens(data)
        if not len(t.start):
            return []
        label = self.decode(t)
        edge = np.zeros(len(label), bool)
        edge[t.chain] = True
        out = []
        for i in np.flatnonzero(label % 2 == 1).tolist():
            j = i + 1
            while j < len(label) and label[j] == label[i] + 1 and not edge[j]:
                j += 1
            out.append((int(label[i]) // 2, int(t.start[i]), int(t.end[j - 1])))
        return out


_MAIL_SIGN = re.compile(rb"@|\bat\b", re.I)
_MAIL_DOT = re.compile(rb"\.|\bdot\b", re.I)


def passes(kind: int, text: bytes, before: int, after: int) -> bool:
    """The check of an added span: its own signs, and no letter or digit
    glued to it."""
    if any(IS_LETTER[c] or IS_DIGIT[c] for c in (before, after)):
        return False
    digits = only_digits(text)
    if kind == 0:
        sign = _MAIL_SIGN.search(text)
        return bool(sign and _MAIL_DOT.search(text, sign.end()) and IS_LETTER[text[-1]])
    if any(IS_LETTER[c] for c in text):
        return False
    if kind == 1:
        parts = re.findall(rb"[0-9]+", text)
        return len(parts) == 4 and all(octet(p) for p in parts)
    if kind == 2:
        return 13 <= len(digits) <= 19 and luhn(digits)
    return 9 <= len(digits) <= 15 and len(digits) < len(text)


def spans_of(col, field: Field | None) -> list[list[tuple[int, int, int, bool]]]:
    """(kind, start, end, base) of every text of a slice, in code points, by
    kind and start."""
    data, off = lined(col)
    base = base_spans(data)
    every = [(*s, True) for s in base]
    if field is not None:
        taken = np.zeros(len(data) + 1, bool)
        for _, a, b in base:
            taken[a:b] = True
        buf = data.tobytes()
        every += [(k, a, b, False) for k, a, b in field.found(data)
                  if not taken[a:b].any() and passes(k, buf[a:b], buf[a - 1] if a else 10, buf[b])]
    out: list[list] = [[] for _ in range(len(off) - 1)]
    if every:
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for k, a, b, own in sorted(every):
            doc = int(np.searchsorted(off, a, side="right")) - 1
            out[doc].append((k, int(points[a] - points[off[doc]]), int(points[b] - points[off[doc]]), own))
    return out


# ---------------------------------------------------------------- labelled table
def rewritten(kind: int, text: str, pick: int) -> tuple[str, bool]:
    """(other spelling of a base match, whether it is personal data)."""
    d = "".join(c for c in text if c.isdigit())
    way = pick % 8
    if kind == 0:
        local, host = text.split("@", 1)
        sign, dot = [(" at ", " dot "), (" [at] ", " [dot] "), ("(at)", "."), (" @ ", "."), ("[at]", "[dot]"), (" AT ", " DOT "),
                     ("@", " . "), (" (at) ", " (dot) ")][way]
        return local + sign + host.replace(".", dot), True
    if kind == 1:
        p = text.split(".")
        forms = ["[.]".join(p), "(.)".join(p), " . ".join(p), " [.] ".join(p), "-".join(p[:3]), ".".join(p[:3]),
                 "/".join(p[:3]), f"{p[0]}.{p[1]}"]
        return forms[way], way < 4
    if kind == 2:
        wrong = d[:-1] + str((int(d[-1]) + 1 + pick // 8 % 8) % 10)
        cut = lambda x, sep: sep.join(x[i:i + 4] for i in range(0, len(x), 4))
        forms = [cut(d, "."), cut(d, "/"), cut(d, " - "), cut(d, "_"), cut(wrong, "."), cut(wrong, " "), wrong, cut(wrong, "/")]
        return forms[way], way < 4
    area, a, b = d[-10:-7], d[-7:-4], d[-4:]
    forms = [f"{area}-{a}-{b}", f"({area}) {a}-{b}", f"{area}.{a}.{b}", f"00{d[:-10]} {area} {a} {b}", f"20{d[-2:]}-0{d[-3]}-1{d[-4]}",
             f"1{d[-1]}.0{d[-2]}.20{d[-4:-2]}", f"{d[-4:-2]}:{d[-2:]}:0{d[-5]}", f"{d[-5]},{d[-4:-1]}.{d[-2:]}"]
    return forms[way], way < 4


def labelled_lines(text: str, width: int = 160) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Cut-out lines of a text with digits or ``@``: as they are, and with
    one span written otherwise."""
    out = []
    for line in text.split("\n"):
        if not re.search(r"[0-9@]", line):
            continue
        own = [s[:3] for s in spans_of(pa.array([line]), None)[0]]
        spot = [a for _, a, _ in own] or [m.start() for m in list(re.finditer("[0-9@]", line))[:1]]
        for n, at in enumerate(spot[:8]):
            lo = max(at - width, 0)
            part = line[lo:at + width]
            mine = [(k, a - lo, b - lo) for k, a, b in own if a >= lo and b <= lo + len(part)]
            clear = all(b <= lo or a >= lo + len(part) or (k, a - lo, b - lo) in mine for k, a, b in own)
            if not clear:
                continue
            out.append((part, mine))
            pick = zlib.crc32(f"{n}:{part}".encode())
            inside = [s for s in mine if s[1] == at - lo]
            if inside and not any(s[1] < inside[0][2] and inside[0][1] < s[2] for s in mine if s != inside[0]):
                for turn in range(4):
                    k, a, b = inside[0]
                    new, real = rewritten(k, part[a:b], pick + turn * 3)
                    grow = len(new) - (b - a)
                    rest = [(x, y + grow * (y >= b), z + grow * (y >= b)) for x, y, z in mine if (x, y, z) != (k, a, b)]
                    out.append((part[:a] + new + part[b:], sorted(rest + [(k, a, a + len(new))] * real)))
    return out


def label_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_docs: int = 20_000,
                max_lines: int = 4_000) -> DataFrame:
    """The small labelled table (line, spans): lines of about ``max_docs``
    documents (by hash of id and text), distinct, about ``max_lines`` of them."""
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text")).filter("text IS NOT NULL")

    def run(batches):
        for b in slices(batches, "text"):
            rows = [r for t in b.column("text").to_pylist() for r in labelled_lines(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()),
                 pa.array([[{"kind": KINDS[k], "start": a, "end": z} for k, a, z in r[1]] for r in rows],
                          pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])))], ["line", "spans"])

    some = by_hash(src, max_docs, "id", "text").filter(F.col("text").rlike("[0-9@]"))
    lines = stored(some.mapInArrow(run, LABELLED).dropDuplicates(["line"]), "labelled-lines")
    return by_hash(lines, max_lines, "line")


def train(labelled: DataFrame, max_lines: int = 8_000) -> Field:
    """A field fitted on a labelled table (line, spans); a larger table
    is an error, as it is trained on in one place."""
    rows = labelled.select("line", "spans").limit(max_lines + 1).collect()
    if len(rows) > max_lines:
        raise ValueError(f"the labelled table has more than {max_lines} lines")
    rows.sort(key=lambda r: r["line"])
    field = Field()
    field.fit([r["line"] for r in rows], [[(KINDS.index(s["kind"]), s["start"], s["end"]) for s in r["spans"]] for r in rows])
    return field


# ---------------------------------------------------------------- operator
def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", labelled: DataFrame | None = None) -> DataFrame:
    """(id, text, spans) of every row of ``docs``: spans are (kind, start,
    end, base) in code points, end exclusive, by kind (email, ip, card,
    phone) and start; ``base`` marks those of the fixed patterns, the others
    are added by the field. It is trained on ``labelled`` (line, spans), by
    default on ``label_table(docs)``.

    A null or empty text has no spans; repeated rows are alike, null ids
    stay null, an empty table gives an empty one, other columns are not
    read; texts of any length are read whole."""
    need(docs, id_col, text_col)
    field = Shared(docs.sparkSession, train(label_table(docs, id_col, text_col) if labelled is None else labelled))
    src = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))

    def run(batches):
        f = field.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))
        for b in slices(batches, "text"):
            rows = [[{"kind": KINDS[k], "start": x, "end": y, "base": own} for k, x, y, own in r] for r in spans_of(b.column("text"), f)]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("text"), pa.array(rows, kind)], ["id", "text", "spans"])

    out = src.mapInArrow(run, f"id {src.schema['id'].dataType.simpleString()}, text string, spans array<{SPAN}>")
    return out.toDF(id_col, text_col, "spans")


def masked(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``<kind>``; spans that overlap
    are replaced from the first start to the last end, by the first's kind."""
    step = F.aggregate(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"), s["kind"].alias("k")))),
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda st, s: F.struct(
            F.when(s["a"] >= st["at"], F.concat(st["out"], F.substring(text, st["at"] + 1, s["a"] - st["at"]), F.lit("<"), s["k"], F.lit(">")))
            .otherwise(st["out"]).alias("out"), F.greatest(st["at"], s["b"]).alias("at")),
        lambda st: F.concat(st["out"], F.substring(text, st["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, step).otherwise(text)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and
    digest of the base spans, and all spans as ``kind:start:end`` joined by
    commas."""
    def line(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select(id_col, *[count(k) for k in KINDS], F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("spans")).alias("spans"))

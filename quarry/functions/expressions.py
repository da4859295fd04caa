"""Scalar expressions used across operators. Everything returns a
``Column`` built from native Spark functions, so it stays inside
whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["fmt_ts", "r6", "py_fixed", "py_rounded", "py_isoformat", "first_present", "date_key", "path_stem", "path_base",
           "frame_name", "sampling_step", "hash_bucket100", "iso_ts",
           "email_ok", "EMAIL_PATTERN"]

# Fixed value: accepted e-mail shape (local@domain.tld, no spaces).
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def fmt_ts(c) -> Column:
    """Timestamp as text with microseconds (stable across engines)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_ts(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def r6(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 6)


def first_present(df, *names: str) -> Column:
    """coalesce over the spellings of a column that exist in ``df``
    (identifiers resolve case-insensitively, so ``Order_id`` and
    ``order_id`` are one column)."""
    have = {c.lower(): c for c in df.columns}
    found = [F.col(have[n.lower()]) for n in names if n.lower() in have]
    if not found:
        raise KeyError(f"none of {names} in {df.columns}")
    return F.coalesce(*found) if len(found) > 1 else found[0]


def date_key(c) -> Column:
    """Smart date key ``yyyymmdd`` as int."""
    c = F.col(c) if isinstance(c, str) else c
    return (F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)).cast("int")


def path_base(c) -> Column:
    """File name of a path (text after the last ``/``)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(c, r"([^/]*)$", 1)


def path_stem(c) -> Column:
    """File name without its last extension."""
    return F.regexp_extract(path_base(c), r"^(.+?)(\.[^.]*)?$", 1)


def frame_name(stem: Column, frame_idx: Column) -> Column:
    """Sample name ``<stem>_f<idx:06d>``."""
    return F.concat(stem, F.lit("_f"), F.lpad(frame_idx.cast("string"), 6, "0"))


def sampling_step(fps: Column, every_s: float) -> Column:
    """Frame step ``max(1, round_half_even(fps * every))``."""
    return F.greatest(F.lit(1), F.bround(fps * F.lit(float(every_s)), 0).cast("int"))


def hash_bucket100(key: Column) -> Column:
    """Deterministic bucket in [0, 100) of an integer key (Knuth
    multiplicative hash mod 2^32); the same on every partitioning and every
    run. The key mod 2^32 is a decimal, the rest longs: its halves times the
    factor stay below 2^49, so nothing overflows."""
    k = F.pmod(key.cast("decimal(38,0)"), F.lit(4294967296).cast("decimal(38,0)")).cast("long")
    factor, half = F.lit(2654435761), F.lit(65535)
    high = (F.shiftright(k, 16) * factor).bitwiseAND(half) * F.lit(65536)
    h = (high + k.bitwiseAND(half) * factor).bitwiseAND(F.lit(4294967295))
    return (h % F.lit(100)).cast("int")


def email_ok(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.rlike(EMAIL_PATTERN)


def _two_product_err(a: Column, b: float) -> tuple[Column, Column]:
    """(p, e) with p = fl(a·b) and e = a·b - p exactly (Dekker's split;
    double arithmetic is IEEE-exact on the JVM). A factor of 26 bits or less
    has no low half: its terms are left out."""
    split = 134217729.0  # 2^27 + 1
    c = F.lit(split) * a
    ah = c - (c - a)
    al = a - ah
    bh = split * b - (split * b - b)
    bl = b - bh
    p = a * F.lit(b)
    if bl == 0:
        return p, (ah * F.lit(bh) - p) + al * F.lit(bh)
    return p, ((ah * F.lit(bh) - p) + ah * F.lit(bl) + al * F.lit(bh)) + al * F.lit(bl)


def _scaled(x: Column, digits: int) -> Column:
    """``|x|·10^digits`` rounded as Python rounds it, a long.

    ``|x|·10^d = p + e`` exactly (error-free product); with ``q = floor(p)``
    the side of the tie ``q + ½`` is the sign of ``(p − (q + ½)) + e`` — the
    subtraction is exact whenever the two are close (Sterbenz), and a
    floating sum never flips the sign of an exact sum. The sum is named once
    (a tie goes up from an odd ``q``, else it has to be positive): what is
    named twice is compiled twice, and the JVM does not compile long methods."""
    p, e = _two_product_err(F.abs(x.cast("double")), float(10 ** digits))
    q = F.floor(p)
    diff = (p - (q + F.lit(0.5))) + e
    up = diff >= F.when(F.pmod(q, F.lit(2)) == 1, F.lit(0.0)).otherwise(F.lit(5e-324))
    return (q + F.when(up, F.lit(1)).otherwise(F.lit(0))).cast("long")


def py_fixed(x, digits: int) -> Column:
    """Text of a double with ``digits`` decimals exactly as Python's
    ``f"{x:.{digits}f}"`` prints it: correct rounding of the binary value,
    half-even only when the scaled value is exactly a tie."""
    x = F.col(x) if isinstance(x, str) else x
    scale, r = 10 ** digits, _scaled(x, digits)
    body = F.concat((r / F.lit(scale)).cast("long").cast("string"), F.lit("."),
                    F.lpad((r % F.lit(scale)).cast("string"), digits, "0")) if digits > 0 \
        else r.cast("string")
    sign = F.when(x < 0, F.lit("-")).otherwise(F.lit(""))
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(F.concat(sign, body))


def py_rounded(x, digits: int) -> Column:
    """The double that the text of ``py_fixed`` reads back as: the quotient
    of two whole numbers below 2^53 is the double next to it."""
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x < 0, F.lit(-1.0)).otherwise(F.lit(1.0)) * (_scaled(x, digits) / F.lit(10 ** digits))


def py_isoformat(ts) -> Column:
    """Python ``datetime.isoformat()`` text: microseconds only when not 0."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)))

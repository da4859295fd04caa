"""Quality rules as a short-circuit cascade (operator 5), native expressions only.

Every rule names the columns it needs (built from the text, in steps) and
the condition that a good text meets. On a bounded sample each rule is run
alone: its time is its cost, the share of texts it rejects its selectivity.
Rules are then ordered by rejection per cost, and each one, with all its
columns, is evaluated only for the texts that the rules before it let
through. The verdict is a conjunction, so the order changes the work and
never the result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import need

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

# ------------------------------------------------------------------ columns
# name -> expression over "__text" (never null) and columns before it


def _words() -> Column:
    inner = F.btrim("__text", F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, SPACE_RUN))


def _windows() -> Column:
    """A hash of each window of three words, by first word."""
    w = F.col("__words")
    last = F.size(w) - 3
    return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                                         lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
                  ).otherwise(F.array().cast("array<bigint>"))


def _sorted_windows() -> Column:
    """(hash, place), sorted; empty unless some window occurs twice."""
    h = F.col("__windows")
    return F.when(F.size(F.array_distinct(h)) < F.size(h),
                  F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
                  ).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeated_places() -> Column:
    """First word of every window that occurs twice or more, ascending."""
    s = F.col("__sorted")

    def place(x, k):
        twin = ((F.get(s, F.greatest(k - 1, F.lit(0)))["h"] == x["h"]) & (k > 0)) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
        return F.when(twin, x["i"])

    return F.sort_array(F.filter(F.transform(s, place), lambda i: i.isNotNull()))


def _repeat_words() -> Column:
    """Words that some repeated window covers."""
    p = F.col("__places")
    gain = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
    return F.aggregate(gain, F.lit(0).cast("long"), lambda a, x: a + x)


STEPS: dict[str, tuple[Callable[[], Column], tuple[str, ...]]] = {
    "__words": (_words, ()),
    "__lines": (lambda: F.filter(F.split("__text", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != ""), ()),
    "__windows": (_windows, ("__words",)),
    "__sorted": (_sorted_windows, ("__windows",)),
    "__places": (_repeated_places, ("__sorted",)),
    "n_words": (lambda: F.size("__words").cast("long"), ("__words",)),
    "word_chars": (lambda: F.length(F.array_join("__words", "")).cast("long"), ("__words",)),
    "n_symbols": (lambda: F.regexp_count("__text", F.lit(SYMBOL)).cast("long"), ()),
    "n_lines": (lambda: F.size("__lines").cast("long"), ("__lines",)),
    "n_dup_lines": (lambda: (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"), ("__lines",)),
    "n_repeat_words": (_repeat_words, ("__places",)),
    "n_upper": (lambda: F.regexp_count("__text", F.lit(r"\p{Lu}")).cast("long"), ()),
}


@dataclass(frozen=True)
class Rule:
    """``passes``: condition of a good text over ``needs`` (of ``STEPS``)."""

    name: str
    needs: tuple[str, ...]
    passes: Callable[[], Column] = field(compare=False)


BASE_RULES = (
    Rule("enough_words", ("n_words",), lambda: F.col("n_words") >= 50),
    Rule("few_repeated_words", ("n_words", "n_repeat_words"), lambda: 100 * F.col("n_repeat_words") <= 50 * F.col("n_words")),
)
RULES = (
    Rule("mean_word_length", ("n_words", "word_chars"),
         lambda: F.col("word_chars").between(3 * F.col("n_words"), 10 * F.col("n_words"))),
    Rule("few_symbols", ("n_words", "n_symbols"), lambda: 100 * F.col("n_symbols") <= 10 * F.col("n_words")),
    Rule("few_repeated_lines", ("n_lines", "n_dup_lines"), lambda: 100 * F.col("n_dup_lines") <= 50 * F.col("n_lines")),
    Rule("few_capitals", ("word_chars", "n_upper"), lambda: 100 * F.col("n_upper") <= 40 * F.col("word_chars")),
)


def _order(names) -> list[str]:
    """The named steps and all they need, each after what it needs."""
    out: list[str] = []
    for n in names:
        out += [x for x in [*_order(STEPS[n][1]), n] if x not in out]
    return out


def add_columns(df: DataFrame, names, alive: Column | None = None) -> DataFrame:
    """Add steps that ``df`` lacks, one projection each (an array that a
    lambda reads must be a column, or it is built anew for every element);
    with ``alive``, null where it is false."""
    for n in _order(names):
        if n not in df.columns:
            df = df.withColumn(n, F.when(_once() if alive is None else alive & _once(), STEPS[n][0]()))
    return df


def _once() -> Column:
    """True, but not deterministic to the optimizer, which therefore does not
    copy the expression into a filter above, where a lambda would build the
    arrays that it reads anew for every element."""
    return F.monotonically_increasing_id() >= 0


def _run(df: DataFrame, rule: Rule | None) -> tuple[float, int]:
    begun = time.perf_counter()
    if rule is None:
        n = df.agg(F.sum(F.length("__text"))).first()
        return time.perf_counter() - begun, 0
    n = add_columns(df, rule.needs).agg(F.count_if(~rule.passes())).first()[0]
    return time.perf_counter() - begun, n


def cascade_order(df: DataFrame, rules, sample_rows: int = 500) -> list[Rule]:
    """``rules`` by rejections per second on the first ``sample_rows`` rows
    of the first partitions (no other is read); ties and an empty sample keep
    the given order."""
    sample = df.sparkSession.createDataFrame([(r["__text"],) for r in df.select("__text").take(sample_rows)], "__text string")
    _run(sample, None)
    idle = _run(sample, None)[0]
    rate = {}
    for r in rules:
        took, rejected = _run(sample, r)
        rate[r.name] = rejected / max(took - idle, 1e-3)
    return sorted(rules, key=lambda r: -rate[r.name])


def judge(docs: DataFrame, rules=BASE_RULES + RULES, text_col: str = "text", verdict: str = "kept",
          eager: tuple[str, ...] = (), sample_rows: int = 500) -> DataFrame:
    """All columns of ``docs``, the ``eager`` columns of ``STEPS``, and the
    boolean ``verdict``: whether the text meets every rule.

    A null text is an empty one: no words, no lines, every count 0 (rules
    with a least count reject it). Repeated rows are judged alike, an empty
    table gives an empty one; texts of any length are judged whole. All
    columns of ``docs`` come back whatever their names; a result whose name
    is taken gets underscores at its end."""
    need(docs, text_col)
    df = docs.select(F.struct(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)]).alias("__row"),
                     F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("__text"))
    order = cascade_order(df.select("__text"), rules, sample_rows)
    df = add_columns(df, eager)
    alive = F.lit(True)
    for r in sorted(order, key=lambda r: not set(eager).issuperset(r.needs)):  # what is there costs nothing
        df = add_columns(df, r.needs, alive)
        df = df.withColumn("__alive", alive & F.coalesce(r.passes(), F.lit(False)))
        alive = F.col("__alive")
    taken, out = {c.lower() for c in docs.columns}, [F.col(f"__row.c{i}").alias(c) for i, c in enumerate(docs.columns)]
    for name, value in [*((n, F.col(n)) for n in eager), (verdict, alive)]:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(value.alias(name))
    return df.select(*out)


def rule_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_rows: int = 500) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept); see ``judge`` for nulls and other cases."""
    need(docs, id_col, text_col)
    stats = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    src = docs.select(docs[id_col].alias("__id"), docs[text_col].alias("__source"))
    out = judge(src, text_col="__source", eager=stats, sample_rows=sample_rows)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return out.select(F.col("__id").alias(id_col), *stats, failed.alias("base_failed"), "kept")


REPORT_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
p AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 1))) AS i FROM w WHERE len(words) >= 3),
g AS (SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c FROM p),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, a, b, c) AS n FROM g),
v AS (SELECT DISTINCT doc_id, i + k AS j FROM r, (VALUES (0), (1), (2)) AS o(k) WHERE n > 1),
s AS (SELECT doc_id, count(*) AS n_repeat_words FROM v GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
             CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, len(lines) AS n_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
             length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS n_upper
      FROM w LEFT JOIN s ON w.doc_id = s.doc_id),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND word_chars BETWEEN 3 * n_words AND 10 * n_words AND 100 * n_symbols <= 10 * n_words
       AND 100 * n_dup_lines <= 50 * n_lines AND 100 * n_upper <= 40 * word_chars AS kept
FROM b
"""

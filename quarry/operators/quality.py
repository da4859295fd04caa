"""Parsing and data-quality operators.

* ``parse_orders`` — typed parse of raw (all-string) order lines. ANSI mode
  makes ``cast``/``to_timestamp`` throw on bad text, so ``try_*`` forms are
  used: an unparseable value becomes NULL and is caught by the rules.
* ``split_by_rules`` — a *total* good/dead-letter split. Each rule is
  ``(name, predicate)``; a row collects the names of the rules that are
  true, and ``<name>:unknown`` for rules that evaluate to NULL, so a row
  whose predicate is unknown can never fall between the two outputs
  (good + bad = input, always).
* ``null_profile`` — NULL count of every column in one pass.
* ``drop_incomplete`` / ``keep_present`` — drop rows with any NULL, keep
  rows whose value is not NULL / ``'NULL'`` / ``''``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.expressions import first_present

# Sentinel for a bad coordinate and the order-line timestamp format.
SENTINEL = -999.999
ORDER_TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Rule:
    name: str
    predicate: Column


def parse_orders(raw: DataFrame, ts_format: str = ORDER_TS_FORMAT) -> DataFrame:
    """Raw order lines → typed columns plus ``date``; the id column may be
    spelled ``Order_id`` or ``order_id``."""
    oid = first_present(raw, "Order_id", "order_id")
    ts = F.try_to_timestamp(F.col("datetime"), F.lit(ts_format)).cast("timestamp_ntz")
    return raw.select(
        oid.try_cast("long").alias("Order_id"),
        "city", "country", "facility_name",
        F.col("lat").try_cast("double").alias("lat"),
        F.col("lng").try_cast("double").alias("lng"),
        "menu_item",
        F.col("price").try_cast("int").alias("price"),
        ts.alias("datetime"),
        F.to_date(ts).alias("date"),
    )


def order_rules(check_datetime: bool = True) -> list[Rule]:
    """The order-line rule set: sentinel coordinates and missing facility,
    item or id; ``check_datetime`` adds the unparseable-time rule."""
    rules = [
        Rule("lat_sentinel", F.col("lat") == F.lit(SENTINEL)),
        Rule("lng_sentinel", F.col("lng") == F.lit(SENTINEL)),
        Rule("facility_missing", F.col("facility_name").isNull()),
        Rule("item_missing", F.col("menu_item").isNull()),
        Rule("id_missing", F.col("Order_id").isNull()),
    ]
    if check_datetime:
        rules.append(Rule("datetime_invalid", F.col("datetime").isNull()))
    return rules


def reject_reasons(rules: list[Rule]) -> Column:
    """array<string> of fired rule names, in rule order. Built without a
    lambda (``array_except`` drops the NULLs of rules that did not fire):
    higher-order functions have no generated code and would drag the whole
    predicate tree into interpreted evaluation."""
    fired = F.array(*[F.when(r.predicate, F.lit(r.name))
                       .when(r.predicate.isNull(), F.lit(f"{r.name}:unknown"))
                      for r in rules])
    return F.array_except(fired, F.array(F.lit(None).cast("string")))


def is_rejected(rules: list[Rule]) -> Column:
    """True when any rule fires or is unknown (NULL counts as fired)."""
    out = None
    for r in rules:
        c = F.coalesce(r.predicate, F.lit(True))
        out = c if out is None else out | c
    return out if out is not None else F.lit(False)


def split_by_rules(df: DataFrame, rules: list[Rule],
                   reason_col: str = "reject_reason") -> dict[str, DataFrame]:
    """``{"good", "bad"}``; ``bad`` carries ``reason_col`` (array). The
    split itself is a plain boolean (codegen'd); reasons are built for the
    rejected rows only."""
    bad_flag = is_rejected(rules)
    bad = df.filter(bad_flag).withColumn(reason_col, reject_reasons(rules))
    good = df.filter(~bad_flag)
    return {"good": good, "bad": bad}


def reason_counts(bad: DataFrame, reason_col: str = "reject_reason") -> DataFrame:
    """How often each rule fired (a row with two faults counts twice)."""
    return (bad.select(F.explode(reason_col).alias("reason"))
               .groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


def null_profile(df: DataFrame) -> DataFrame:
    """``(column_name, null_count)`` for every column, from ONE scan: a
    single aggregate row of per-column sums, unpivoted."""
    cols = df.columns
    agg = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(f"n{i}")
                   for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c.replace(chr(39), chr(39) * 2)}', n{i}" for i, c in enumerate(cols))
    return agg.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)")


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def keep_present(df: DataFrame, col: str, missing=("NULL", "")) -> DataFrame:
    """Keep rows whose ``col`` is not NULL and not one of ``missing``."""
    c = F.col(col)
    return df.filter(c.isNotNull() & ~c.isin(*missing))


def store_dead_letters(raw: DataFrame, path: str, rules: list[Rule] | None = None) -> int:
    """Only the dead side of the cleaning job: typed parse, rejected lines
    with their reasons as CSV. Returns their number, counted by the write."""
    from quarry.sinks.files import write_dead_letters

    rules = rules or order_rules()
    typed = parse_orders(raw)
    bad = typed.filter(is_rejected(rules)).withColumn("reject_reason", reject_reasons(rules))
    seen = Observation()
    write_dead_letters(bad.observe(seen, F.count(F.lit(1)).alias("n")), path)
    return seen.get["n"]


def store_good_lines(raw: DataFrame, path: str, formats=("parquet",), rules: list[Rule] | None = None,
                     partition_cols=("date", "city")) -> int:
    """Only the good side: typed lines partitioned by ``partition_cols`` in
    every requested format. Returns their number, counted by the write."""
    from quarry.sinks.files import write_partitioned

    good = parse_orders(raw).filter(~is_rejected(rules or order_rules()))
    n = 0
    for fmt in formats:
        seen = Observation()
        write_partitioned(good.observe(seen, F.count(F.lit(1)).alias("n")), f"{path.rstrip('/')}/{fmt}", partition_cols, fmt=fmt)
        n = seen.get["n"]
    return n


def store_clean_orders(raw: DataFrame, good_path: str, dead_letter_path: str,
                       formats=("parquet",), rules: list[Rule] | None = None,
                       partition_cols=("date", "city")) -> dict[str, int]:
    """The cleaning job: dead letters (CSV) and the good rows partitioned by
    (date, city) in every requested format (``parquet``, ``avro`` when
    present). The input is read once per output: no copy of it is held, and
    the counts of both sides are observed by the writes themselves."""
    bad = store_dead_letters(raw, dead_letter_path, rules)
    return {"good": store_good_lines(raw, good_path, formats, rules, partition_cols), "bad": bad}

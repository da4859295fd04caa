"""Relational modelling of flat sales lines: deterministic surrogate keys,
third normal form, star schema and nested order documents.

Surrogate keys (``assign_keys``) come from the natural key, never from
``monotonically_increasing_id`` (whose values depend on the physical
partitioning and are recomputed by every action that re-evaluates the
lineage, so dimension and fact keys could disagree):

* ``mode="rank"`` — consecutive keys 1..n in natural-key order, for sets
  of any size in the same way: a global sort (range partitioning), one
  stored copy that fixes partition ids, per-partition counts (one row per
  partition) as offsets, and a row number inside each partition.
* ``mode="hash"`` — ``xxhash64`` of the natural key: no sort, no stored
  copy; uniqueness is asserted with one aggregation. Enough wherever ids
  need only be unique.

Keys are deterministic functions of the member set, so every consumer
sees the same keys. Joins are left to AQE, which broadcasts by bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.expressions import date_key, first_present
from quarry.operators.joins import join_null_safe
from quarry.session import materialize


def assign_keys(df: DataFrame, order_cols: list[str], key_col: str,
                mode: str = "rank", check_collisions: bool = True) -> DataFrame:
    """Add ``key_col`` to ``df``. With ``mode="rank"`` rows are numbered
    1..n in ``order_cols`` order (prefix a column with ``-`` for descending;
    ``df`` should be distinct on them, or carry extra columns in
    ``order_cols`` that separate equal rows). NULL sorts first, with ``-``
    last."""
    if mode == "hash":
        out = df.withColumn(key_col, F.xxhash64(*[F.col(c) for c in order_cols]))
        if check_collisions:
            assert_no_collisions(out, key_col, order_cols)
        return out
    if mode != "rank":
        raise ValueError(mode)
    sort_cols = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_first()
                 for c in order_cols]
    ranged = materialize(df.orderBy(*sort_cols)).withColumn("__pid", F.spark_partition_id())
    counts = ranged.groupBy("__pid").agg(F.count(F.lit(1)).alias("__n"))
    # one row per partition: a window over it is bounded by the partition count
    offsets = counts.select("__pid", F.coalesce(
        F.sum("__n").over(Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("__off"))
    local = ranged.withColumn("__rn", F.row_number().over(
        Window.partitionBy("__pid").orderBy(*sort_cols)))
    out = local.join(F.broadcast(offsets), "__pid")
    out = out.withColumn(key_col, (F.col("__off") + F.col("__rn")).cast("long"))
    return out.drop("__pid", "__off", "__rn")


def assert_no_collisions(df: DataFrame, key_col: str, natural: list[str]) -> None:
    """Fail when two different natural keys share a hash key (one
    aggregation; only the offending keys, if any, reach the driver)."""
    nat = F.struct(*[F.col(c) for c in natural])
    bad = (df.groupBy(key_col).agg(F.min(nat).alias("a"), F.max(nat).alias("b"))
             .filter(F.col("a") != F.col("b")).limit(1).collect())
    if bad:
        raise AssertionError(f"hash key collision on {key_col}: {bad[0]['a']} vs {bad[0]['b']}")


def assert_unique(df: DataFrame, cols: list[str]) -> None:
    dup = df.groupBy(*cols).count().filter("count > 1").limit(1).count()
    if dup:
        raise AssertionError(f"key {cols} is not unique")


def _order_id(df: DataFrame) -> Column:
    return first_present(df, "order_id", "Order_id")


class Tables(Mapping):
    """Named tables, each made when it is first asked for and then kept:
    a table whose making runs jobs costs nothing where it is not used."""

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers, self._made = makers, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._makers[name]()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


# ------------------------------------------------------------------ 3NF
def to_3nf(df: DataFrame, dedupe_items: bool = False, key_mode: str = "rank") -> Mapping[str, DataFrame]:
    """Flat clean lines → ``cities, facilities, menu_items, orders,
    order_items``. ``order_items`` keeps line grain (one row per line,
    ``order_item_id`` numbered in (order_id, menu_item) order) unless
    ``dedupe_items``; only this table numbers rows (a global sort and a
    stored copy of the lines), when it is asked for."""
    oid = _order_id(df).alias("order_id")
    return Tables({
        "cities": lambda: df.select("city", "country").distinct(),
        "facilities": lambda: df.select("facility_name", "city", "lat", "lng").distinct(),
        "menu_items": lambda: df.select("menu_item", "price").distinct(),
        "orders": lambda: df.select(oid, "datetime", "facility_name", "city").distinct(),
        "order_items": lambda: _order_items(df, oid, dedupe_items, key_mode),
    })


def _order_items(df: DataFrame, oid: Column, dedupe_items: bool, key_mode: str) -> DataFrame:
    if dedupe_items:
        items, order = df.select(oid, "menu_item").distinct(), ["order_id", "menu_item"]
    else:
        # line grain: a line hash and a row id separate equal lines, so a
        # hot order id still spreads over the range partitions
        items = df.select(oid, "menu_item",
                          F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]).alias("__h"),
                          F.monotonically_increasing_id().alias("__m"))
        order = ["order_id", "menu_item", "__h", "__m"]
    keyed = assign_keys(items, order, "order_item_id", key_mode)
    return keyed.select("order_item_id", "order_id", "menu_item")


# ------------------------------------------------------------------ star
_STAR_COLS = ["city", "country", "facility_name", "menu_item", "date", "lat", "lng"]
_STAR_SETS = {"city": ["city", "country"], "facility": ["facility_name", "city", "country"],
              "menu": ["menu_item"], "date": ["date"]}
# A dimension of at most so many bytes (its texts and a fixed part per member)
# is sent to every task that joins the lines with it.
BROADCAST_BYTES = 32 << 20
MEMBER_BYTES = 64


def _gid(members: list[str]) -> int:
    """grouping_id() of a grouping set over ``_STAR_COLS`` (bit = column
    not in the set, first column most significant)."""
    n = len(_STAR_COLS)
    return sum(1 << (n - 1 - i) for i, c in enumerate(_STAR_COLS) if c not in members)


def _numbered_members(dims: dict[str, DataFrame], key_mode: str) -> dict[str, tuple[DataFrame, bool]]:
    """Members of several dimensions with ``key``, 1.. in the order of their
    natural columns in each, and whether they are few enough to broadcast.
    One global sort by (dimension, natural columns) and one stored copy number
    all of them; a dimension's first place is its offset (one row per
    dimension, with its bytes, reaches the driver)."""
    if key_mode != "rank":
        return {d: (assign_keys(m.select(*_STAR_SETS[d], "at.*"), _STAR_SETS[d], "key", key_mode), False) for d, m in dims.items()}
    rows = None
    for k, (d, m) in enumerate(dims.items()):
        cols = [*_STAR_SETS[d], *[None] * (3 - len(_STAR_SETS[d]))]
        one = m.select(F.lit(k).alias("dim"), *[(F.col(c) if c else F.lit(None).cast("string")).alias(f"n{i}") for i, c in enumerate(cols)],
                       "at.lat", "at.lng")
        rows = one if rows is None else rows.unionByName(one)
    placed = assign_keys(rows, ["dim", "n0", "n1", "n2"], "place")
    width = sum(F.coalesce(F.octet_length(f"n{i}"), F.lit(0)) for i in range(3)) + F.lit(MEMBER_BYTES)
    seen = {r["dim"]: r for r in placed.groupBy("dim").agg(F.min("place").alias("lo"), F.sum(width).alias("bytes")).collect()}
    out = {}
    for k, d in enumerate(dims):
        lo, n_bytes = (seen[k]["lo"], seen[k]["bytes"]) if k in seen else (1, 0)
        keyed = placed.filter(F.col("dim") == k).select((F.col("place") - lo + 1).alias("key"),
                                                        *[F.col(f"n{i}").alias(c) for i, c in enumerate(_STAR_SETS[d])], "lat", "lng")
        out[d] = keyed, n_bytes <= BROADCAST_BYTES
    return out


def to_star(df: DataFrame, fact_mode: str = "inner", key_mode: str = "rank") -> dict[str, DataFrame]:
    """Flat clean lines → ``dim_date, dim_city, dim_facility, dim_menu,
    fact_sales``.

    * one pass over the lines derives the members of every dimension
      (GROUPING SETS; the small result is checkpointed), instead of one scan of
      the lines per dimension;
    * city identity is (city, country); facility identity is
      (facility_name, city, country) with one row per facility (its least
      (lat, lng) pair), so no dimension join can fan out fact rows; a NULL
      natural key is not a member;
    * the lines are read twice, for the members and for the facts; no copy
      of them is stored. A dimension's bytes are known once it is numbered:
      up to ``BROADCAST_BYTES`` it is broadcast, so the lines are not
      shuffled by a handful of cities or items; a larger one is left to AQE
      (skewed partitions split);
    * ``fact_mode="inner"`` drops lines with no dimension member,
      ``"unknown_member"`` keeps them with key -1.
    """
    lines = df.withColumn("date", F.to_date("datetime"))
    # small (one row per member of each dimension): checkpointed, so it is
    # computed once, survives executor loss and pins no executor memory. Only
    # plain columns are aggregated over the lines, which hashing does; a least
    # struct would sort every line once per grouping set
    sets = [[*cols, "lat", "lng"] if name == "facility" else cols for name, cols in _STAR_SETS.items()]
    members = materialize(lines.select("*", F.col("lat").alias("_lat"), F.col("lng").alias("_lng"))
                               .groupingSets(sets, *_STAR_COLS)
                               .agg(F.min("_lat").alias("_lat"), F.min("_lng").alias("_lng"), F.grouping_id().alias("_gid")))

    def part(name):
        cols = _STAR_SETS[name]
        own = members.filter((F.col("_gid") == _gid([*cols, "lat", "lng"] if name == "facility" else cols)) &
                             F.expr(" AND ".join(f"{c} IS NOT NULL" for c in cols)))
        # one row per facility and place, then the least place of a facility
        return own.groupBy(*cols).agg(F.min(F.struct(F.col("_lat").alias("lat"), F.col("_lng").alias("lng"))).alias("at"))

    dim_date = part("date").select(date_key("date").alias("date_key"), "date",
                                   F.year("date").alias("year"), F.month("date").alias("month"),
                                   F.dayofmonth("date").alias("day"))
    numbered = _numbered_members({k: part(k) for k in ("city", "facility", "menu")}, key_mode)
    keyed = {k: t for k, (t, _) in numbered.items()}
    sent = {k: F.broadcast if small else (lambda t: t) for k, (_, small) in numbered.items()}
    dim_city = keyed["city"].select(F.col("key").alias("city_key"), "city", "country")
    fac = keyed["facility"].withColumnRenamed("key", "facility_key").join(dim_city, ["city", "country"])
    dim_facility = fac.select("facility_key", "facility_name", "city_key", "lat", "lng")
    dim_menu = keyed["menu"].select(F.col("key").alias("menu_key"), "menu_item")

    how = "inner" if fact_mode == "inner" else "left"
    dt = F.col("datetime")
    f = df.select(_order_id(df).alias("order_id"), "datetime", date_key(dt).alias("date_key"),
                  "city", "country", "facility_name", "menu_item", "price")
    f = join_null_safe(f, dim_city, ["city", "country"], how, sent["city"])
    f = join_null_safe(f, dim_facility.select("facility_key", "facility_name", "city_key"),
                       ["facility_name", "city_key"], how, sent["facility"])
    f = join_null_safe(f, dim_menu, ["menu_item"], how, sent["menu"])
    keys = ["city_key", "facility_key", "menu_key"]
    if fact_mode != "inner":
        f = f.select(*[c for c in f.columns if c not in keys],
                     *[F.coalesce(F.col(k), F.lit(-1).cast("long")).alias(k) for k in keys])
    fact = f.select("order_id", "datetime", "date_key", "city_key", "facility_key", "menu_key", "price")
    return {"dim_date": dim_date, "dim_city": dim_city, "dim_facility": dim_facility,
            "dim_menu": dim_menu, "fact_sales": fact}


# ------------------------------------------------------------ documents
def to_documents(df: DataFrame, id_cols: list[str] | None = None,
                 group_cols: tuple[str, ...] = ("city", "country", "facility_name", "lat", "lng"),
                 item_cols: tuple[str, ...] = ("menu_item", "price"),
                 ts_col: str = "datetime", total_col: str = "price",
                 unique_id: bool = False) -> DataFrame:
    """Line rows → nested order documents, one per group.

    One document per (id, group columns) — or per id with ``unique_id``
    (then the group columns are dropped) — with ``datetime = min``,
    ``order_total = sum`` and ``items`` (array of structs, sorted). One
    aggregation without a sizing pass; lists are combined map-side. The
    document with all its items is the feature, so a group has to fit a row
    (2 GB, in practice some ten million items); ids with more lines than
    that are no orders and belong in the line table.
    """
    df = df.withColumn("order_id", _order_id(df)) if "order_id" not in df.columns else df
    keys = ["order_id"] + ([] if unique_id else list(id_cols or group_cols))
    item = F.struct(*[F.col(c) for c in item_cols])
    docs = df.groupBy(*keys).agg(F.min(ts_col).alias(ts_col), F.sum(F.col(total_col).cast("long")).alias("order_total"),
                                 F.array_sort(F.collect_list(item)).alias("items"))
    return docs.select(F.col("order_id").alias("_id"), *keys[1:], ts_col, "order_total", "items")

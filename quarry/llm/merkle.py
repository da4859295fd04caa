"""Merkle manifest of a dataset by slot pivots (operator 12).

Every row is a leaf: the SHA-256 of its fields. Within a group the leaves
stand in id order; each run of ``fanout`` nodes becomes one parent until one
node, the group's subroot, remains, and the subroots in group order make the
root in the same way.

*Slot pivot*: a node's position gives its parent (``at div fanout``) and its
slot (``at mod fanout``). Conditional aggregates per parent spread the
children into ``fanout`` columns; their concatenation is hashed to the parent,
and leaving out the own slot gives a node's siblings, those on its left and
those on its right.

Positions come from one range sort with offsets per partition, so a group of
any size is numbered by many tasks. A band of ``LEVELS`` levels needs one
shuffle: rows are dealt by (group, ancestor at the band's top), a set of at
most ``fanout ** LEVELS`` rows, and the pivots of all its levels keep that
distribution. The ancestors are the nodes of the next band; what they learn
of the levels above joins back by the same key, so no task ever holds a group.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import need, stored

#: Rows under one ancestor at the top of a band, at most.
BAND = 1024
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_PATH = "array<struct<l:string,r:string>>"


def digest(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def leaf_hash(fields: list[Column]) -> Column:
    """SHA-256 (lowercase hex) of the fields, each ``-`` if null, else its
    UTF-8 byte count, ``:`` and its value (numbers in decimal)."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
                             for t in texts]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of its path give."""
    return F.aggregate(path, leaf, lambda h, x: digest(F.concat(x["l"], h, x["r"])))


def proof_digest(path: Column) -> Column:
    """SHA-256 of the siblings from the leaf's level to the root."""
    return digest(F.array_join(F.transform(path, lambda x: F.concat(x["l"], x["r"])), ""))


def numbered(df: DataFrame, *order: str, name: str) -> DataFrame:
    """The rows with ``at``, their place (from 0) in ``order`` (total, or
    among equal rows), and ``part``, the range partition that holds them.
    Stored, so places stay; only one count per partition is gathered."""
    low = 33  # bits of the row number within a partition
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    held = stored(ranged.withColumn("mark", F.monotonically_increasing_id()), name)
    held = held.withColumn("part", F.shiftright("mark", low))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("off"))
    return (held.join(F.broadcast(offsets), "part")  # a row per partition
            .withColumn("at", F.col("off") + F.col("mark").bitwiseAND((1 << low) - 1)).drop("off", "mark"))


def _climb(nodes: DataFrame, most: int, fanout: int, finish) -> DataFrame:
    """``nodes`` (g, at, n: nodes of the group, h, other columns) with
    ``path``, the siblings from here to the top, and what ``finish`` adds
    to the last nodes, one per group. ``most`` is the greatest n."""
    if most <= 1:
        return finish(nodes)
    levels, full = 1, max(int(math.log(BAND, fanout)), 1)
    while levels < full and fanout ** levels < most:
        levels += 1
    width, slots = fanout ** levels, range(fanout)
    kept = [f"`{c}`" for c in nodes.columns if c not in ("g", "at", "n")]
    x = (nodes.withColumn("chunk", F.expr(f"at div {width}")).repartition("g", "chunk")
         .selectExpr("g", "chunk", *kept, "at AS place", "at", "n", "n AS size", "h AS node", f"CAST(array() AS {_PATH}) AS path"))
    run = f"OVER (PARTITION BY g, chunk, at div {fanout})"  # the children of one parent
    child = [f"max(CASE WHEN at % {fanout} = {i} THEN node END) {run} AS c{i}" for i in slots]
    whole = ", ".join(f"coalesce(c{i}, '')" for i in slots)
    left = ", ".join(f"CASE WHEN at % {fanout} > {i} THEN c{i} ELSE '' END" for i in slots)
    right = ", ".join(f"CASE WHEN at % {fanout} < {i} THEN coalesce(c{i}, '') ELSE '' END" for i in slots)
    for _ in range(levels):
        x = x.selectExpr("*", *child).selectExpr(
            "g", "chunk", *kept, "place", "n", f"at div {fanout} AS at", f"(size + {fanout - 1}) div {fanout} AS size",
            f"CASE WHEN size > 1 THEN sha2(concat({whole}), 256) ELSE node END AS node",
            f"CASE WHEN size > 1 THEN concat(path, array(struct(concat({left}) AS l, concat({right}) AS r))) ELSE path END AS path")
    tops = stored(x.groupBy("g", "chunk").agg(F.max("node").alias("h"), F.max("size").alias("n"))
                  .withColumnRenamed("chunk", "at"), "merkle-nodes")
    above = _climb(tops, -(-most // width), fanout, finish).drop("n", "h")
    above = above.withColumnRenamed("at", "chunk").withColumnRenamed("path", "path_above")
    return (x.drop("at", "size", "node").withColumnRenamed("place", "at").join(above, ["g", "chunk"])
            .withColumn("path", F.concat("path", "path_above")).drop("chunk", "path_above"))


def manifest(leaves: DataFrame, id_col: str, group_col: str, leaf_col: str = "leaf", fanout: int = 3) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path``, the siblings of
    the row's nodes from the leaf to the root: array of (l, r), hex digests
    concatenated, l those before the node and r those after it.

    Groups are ordered bytewise, null first; ids ascend, null first; rows of
    one id stand in order of their leaves (equal rows are interchangeable).
    A group of one leaf has that leaf as subroot, a table of one group its
    subroot as root; an empty table has no rows and no root. Other columns
    are carried along, whatever their names."""
    need(leaves, id_col, group_col, leaf_col)
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    other = [f"x{k}" for k in range(len(leaves.columns))]
    rows = stored(leaves.toDF(*other).select(
        "*", F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.concat(F.lit("1"), _stands_for(leaves, other, group_col).cast("string")), F.lit("0")).alias("s"),
        _stands_for(leaves, other, id_col).alias("id"), _stands_for(leaves, other, leaf_col).alias("h")), "merkle-leaves")
    placed = numbered(rows, "s", "id", "h", "row", name="merkle-order")
    # a group is many runs, one per range partition: only runs meet by group
    runs = placed.groupBy("part", "s").agg(F.min("at").alias("lo"), F.count(F.lit(1)).alias("n"))
    groups = numbered(runs.groupBy("s").agg(F.min("lo").alias("start"), F.sum("n").alias("n")), "s", name="merkle-groups")
    groups = groups.select("s", "start", "n", F.col("at").alias("g"))
    most, count = groups.agg(F.coalesce(F.max("n"), F.lit(0)), F.count(F.lit(1))).first()
    of = runs.select("part", "s").join(groups, "s")
    nodes = placed.join(of, ["part", "s"]).select(*other, "g", (F.col("at") - F.col("start")).alias("at"), "n", "h")

    def root(tops: DataFrame) -> DataFrame:
        return tops.withColumn("path", F.array().cast(_PATH)).withColumn("root", F.col("h"))

    def subroots(last: DataFrame) -> DataFrame:
        one = last.select(F.lit(0).cast("long").alias("g"), F.col("g").alias("at"), F.lit(count).cast("long").alias("n"), "h")
        up = _climb(one, count, fanout, root).select(F.col("at").alias("g"), "path", "root")
        return last.withColumn("subroot", F.col("h")).join(up, "g")

    out = _climb(nodes, most, fanout, subroots)
    return out.select(*[F.col(o).alias(c) for o, c in zip(other, leaves.columns)], "subroot", "root", "path")


def _stands_for(df: DataFrame, names: list[str], col: str) -> Column:
    """The column that stands for ``col`` after renaming by position."""
    return F.col(names[df.columns.index(col)])


def tamper_report(docs: DataFrame, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
                  text_col: str = "text", fanout: int = 3) -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    every row. Rows whose decimal id has an even crc32 are tampered with: the
    line breaks of their text are deleted (a null id or text stays). The root
    folded from such a row's leaf and the original siblings is the true one
    only where the text had no line break. Rows that repeat an id are leaves
    of their own; an empty text is ``0:``; extra columns are not read."""
    need(docs, *fields, id_col, group_col, text_col)
    cols = {f: F.col(f"`{f}`") for f in fields}
    bare = {**cols, text_col: F.replace(cols[text_col], F.lit("\n"), F.lit(""))}
    hit = (F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 2 == 0) & F.contains(cols[text_col], F.lit("\n"))
    leaves = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("grp"),
                         leaf_hash(list(cols.values())).alias("leaf"),
                         F.when(hit, leaf_hash(list(bare.values()))).alias("changed"))
    out = manifest(leaves, "id", "grp", "leaf", fanout)
    out = out.withColumn("folded_root", fold(F.coalesce("changed", "leaf"), F.col("path")))
    return out.select(F.col("id").alias(id_col), "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_field(c: str) -> str:
    return f"coalesce(octet_length(encode({c}::VARCHAR))::VARCHAR || ':' || {c}::VARCHAR, '-')"


_SQL_CRC = """xor(list_reduce([4294967295::UBIGINT] || flatten(list_transform(string_split(doc_id::VARCHAR, ''),
    lambda c: [ord(c)::UBIGINT, 0, 0, 0, 0, 0, 0, 0])), lambda a, x: xor(xor(a, x) >> 1, 3988292384 * (xor(a, x) & 1))), 4294967295)"""

#: DuckDB text of ``tamper_report`` (three children, five fields). Levels are
#: a recursion; it carries every leaf's node, its tampered node and proof.
REPORT_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, sha256({' || '.join(_sql_field(c) for c in FIELDS)}) AS h,
    CASE WHEN {_SQL_CRC} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS bare,
    lang, n_chars FROM documents),
placed AS (
  SELECT *, sha256({' || '.join(_sql_field(c) for c in FIELDS[:-1])} || {_sql_field('bare')}) AS t,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS pos,
    count(*) OVER (PARTITION BY source) AS n FROM leaf),
tree AS (
  SELECT doc_id, source, pos AS id, h AS leaf, 0 AS level, pos, n, h AS node, t AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, source, id, leaf, level + 1, pos // 3, (n + 2) // 3, sha256(c0 || c1 || c2),
    sha256(CASE pos % 3 WHEN 0 THEN folded || c1 || c2 WHEN 1 THEN c0 || folded || c2 ELSE c0 || c1 || folded END),
    proof || CASE pos % 3 WHEN 0 THEN c1 || c2 WHEN 1 THEN c0 || c2 ELSE c0 || c1 END
  FROM (SELECT *, {', '.join(f"coalesce(max(node) FILTER (pos % 3 = {i}) OVER (PARTITION BY source, level, pos // 3), '') AS c{i}" for i in range(3))}
        FROM tree WHERE n > 1)),
done AS (SELECT * FROM tree WHERE n = 1),
subs AS (
  SELECT source, max(node) AS h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n FROM done GROUP BY source),
top AS (
  SELECT source, 0 AS level, pos, n, h AS node, [] :: STRUCT(l VARCHAR, r VARCHAR)[] AS path FROM subs
  UNION ALL
  SELECT source, level + 1, pos // 3, (n + 2) // 3, sha256(c0 || c1 || c2), list_append(path, {{
    'l': CASE pos % 3 WHEN 0 THEN '' WHEN 1 THEN c0 ELSE c0 || c1 END,
    'r': CASE pos % 3 WHEN 0 THEN c1 || c2 WHEN 1 THEN c2 ELSE '' END}})
  FROM (SELECT *, {', '.join(f"coalesce(max(node) FILTER (pos % 3 = {i}) OVER (PARTITION BY level, pos // 3), '') AS c{i}" for i in range(3))}
        FROM top WHERE n > 1)),
up AS (SELECT * FROM top WHERE n = 1),
climb AS (
  SELECT d.doc_id, d.leaf, d.node AS subroot, u.node AS root, d.folded, d.source, d.id, d.proof, u.path, 0 AS k
  FROM done d JOIN up u ON d.source IS NOT DISTINCT FROM u.source
  UNION ALL
  SELECT doc_id, leaf, subroot, root, sha256(path[k + 1].l || folded || path[k + 1].r), source, id,
    proof || path[k + 1].l || path[k + 1].r, path, k + 1
  FROM climb WHERE k < len(path))
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM climb WHERE k = len(path)
"""

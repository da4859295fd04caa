"""N-gram Jaccard join with token-combination prefixes (operator 2).

A document's tokens are its distinct word shingles. Two documents link when
100 * intersection >= percent * union. Links are found exactly:

1. Documents with the same token set are one *text* from here on (grouped
   by set digest; copies are never paired).
2. A text of n tokens can miss at most p - 1 = n - ceil(percent * n / 100)
   tokens of a partner. Of its first 3p/2 tokens by hash at least
   p/2 + 1 must then occur in another text; texts without that many have no
   partner. What is left are the *candidates*.
3. Over the candidates, every token is counted. Tokens of one text only
   stand first in the order of tokens, then tokens by rising count. Each
   token that occurs once is a miss; a text with p of them has no partner.
   Otherwise its prefix is extended until it holds p points: a missed token
   or a token of the rare class (count up to ``rare``) is a point by itself
   and, if shared, an index key. Tokens of the frequent class are dealt by
   hash into groups, a group of m prefix tokens giving m - 1 points, and
   every *pair* of prefix tokens of a group is a key. Were no key of a pair
   of texts equal, each would miss more than p - 1 tokens of the other.
   The number of groups follows the size of the text, so that keys stay
   linear in it; sizes are banded by powers of two and a text is indexed
   under its own and the next band, where partners of either band meet.
4. Under each key, texts are first compared with one pivot (the text with
   the smallest share of unshared tokens). Verified links are contracted to
   components; only texts of a key that are still in different components
   are compared pairwise, and of a key with many texts only those outside its
   largest component with all, when bounds leave a chance: sizes, unshared tokens,
   a parity signature of the shared ones, and the triangle inequality (the
   Jaccard distance is a metric, distances to pivots are known). Every candidate pair is verified on its full token sets.
5. A key that would still take more than ``hot`` squared comparisons is
   not compared pairwise: the combination is extended. Linked texts differ in
   at most D tokens, D following from a narrow band of sizes. All tokens are
   dealt by hash into D // 2 + 1 blocks, of which one must hold one of the
   differing tokens at most, so that two of its three parts are equal: the
   tokens of every two parts of a block are a key. A text needs as many
   blocks as its own size and unshared tokens leave differing ones. Texts
   that share some frequent tokens no longer meet. Texts of a key that stays
   large are compared with one of them, links are contracted, and texts of
   keys that stay open get the keys of another hash, ``ROUNDS`` times in all;
   under the last keys texts are compared pairwise whatever their number.

Tokens and set digests are 64-bit and 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import drop_stored, need, stored
from quarry.llm.components import components
from quarry.llm.text import flat_bytes, shingle_sets, slices, word_hashes


#: Stands for a null id: sorts after every id.
NO_ID = (1 << 63) - 1
#: Longs of a text's parity signature.
WORDS = 8
#: Hashes by which texts of keys above ``hot`` texts are extended.
ROUNDS = 2


def slack(n, percent: int):
    """p: one more than the tokens that a linked text can miss."""
    spare = (100 - percent) * n
    return (F.floor(spare / 100) if isinstance(n, Column) else spare // 100) + 1


def token_sets(docs: DataFrame, width: int, columns: str, row) -> DataFrame:
    """``row(set)`` of every text's token set (sorted int64), beside the
    other columns of ``docs``."""
    held = [f for f in docs.schema if f.name != "text"]
    fields = columns.split(", ")
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}

    def run(batches):
        for b in slices(batches, "text"):
            words, first = word_hashes(*flat_bytes(b.column("text")))
            out = [row(s) for s in shingle_sets(words, first, width)]
            cols = zip(*out) if out else [[]] * len(fields)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(h) for h in names), *(pa.array(c, kinds[f.split()[1]]) for c, f in zip(cols, fields))],
                [*names, *(f.split()[0] for f in fields)])

    names = [f.name for f in held]
    return docs.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in held), columns]))


def _profile(percent: int):
    def row(tokens):
        n = len(tokens)
        first = tokens[:(3 * slack(n, percent) + 1) // 2] if n else tokens
        return n, _digest(tokens), first.view(np.int64)
    return row


def _digest(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def _groups(band):
    """Hash groups of the frequent class for texts of 2^band tokens or more."""
    return 1 << max(int(band) - 6, 0)


def prefix_keys(tokens: np.ndarray, counts: np.ndarray, n: int, percent: int, rare: int) -> np.ndarray:
    """Index keys (int64) of one text.

    ``tokens``: its shared tokens, by rising (count, token); the other
    ``n - len(tokens)`` occur in no other text."""
    points = slack(n, percent) - (n - len(tokens))
    if points <= 0 or n < 2:
        return np.zeros(0, np.int64)
    t = tokens.view(np.uint64)
    n_rare = int(np.searchsorted(counts, rare, side="right"))
    keys = [t[:min(n_rare, points)]]
    missing = points - n_rare
    if missing > 0:
        common = t[n_rare:]
        for band in (n.bit_length(), n.bit_length() + 1):
            groups = _groups(band)
            of = ((common * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % groups
            seen, gained, end = np.zeros(groups, np.int64), 0, len(common)
            for k, g in enumerate(of.tolist()):
                gained += seen[g] > 0
                seen[g] += 1
                if gained >= missing:
                    end = k + 1
                    break
            for g in range(groups):
                mine = np.sort(common[:end][of[:end] == g])
                i, j = np.triu_indices(len(mine), 1)
                pair = (mine[i] * np.uint64(0xBF58476D1CE4E5B9)) ^ ((mine[j] + np.uint64(band)) * np.uint64(0x94D049BB133111EB))
                keys.append(pair)
            if gained < missing:  # too few tokens to combine: each one alone as well
                keys.append(common + np.uint64(band))
    return np.unique(np.concatenate(keys)).view(np.int64)


def size_bands(percent: int, most: int = 1 << 31) -> list[int]:
    """First sizes of the size bands: linked texts lie in one band or in
    neighbouring ones."""
    first = [1, 2]
    while first[-1] <= most:
        last = first[-1] - 1  # the largest size of the band before
        first.append(max(first[-1] + 1, 100 * last // percent + 1, 11 * last // 10))
    return first


def block_keys(tokens: np.ndarray, n: int, percent: int, bands: list[int], seed: int) -> np.ndarray:
    """Extended combinations (int64) of one text of ``n`` tokens, of which
    ``tokens`` occur in other texts: linked texts have one in common, under
    every ``seed``."""
    own = bisect_right(bands, n) - 1
    t = (tokens.view(np.uint64) + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
    t = (t ^ (t >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (t ^ (t >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    out = [np.zeros(0, np.uint64)]
    alone, partner = n - len(tokens), 100 * n // percent
    for band in (own, own + 1):  # texts of a band meet their own and those of the band before
        most = bands[band + 1] - 1
        if band > own and partner < bands[band]:
            continue
        apart = 2 * (100 - percent) * most // (100 + percent)
        mine = (100 - percent) * (n + min(partner, most)) // (100 + percent) - alone
        if mine < 0:
            continue
        least = min(apart, 1)
        blocks, parts = apart // (least + 1) + 1, 2 * least + 1
        need_blocks = mine // (least + 1) + 1  # the first blocks do: one of them holds ``least`` differing tokens at most
        cell = ((t >> np.uint64(33)) % np.uint64(blocks * parts)).astype(np.int64)
        sums = np.zeros(blocks * parts, np.uint64)
        np.add.at(sums, cell, value)
        chosen = np.array(list(combinations(range(parts), parts - least)))
        keys = sums.reshape(blocks, parts)[:need_blocks][:, chosen].sum(axis=2, dtype=np.uint64)
        place = np.arange(keys.size, dtype=np.uint64).reshape(keys.shape) + np.uint64(band << 40)
        keys = (keys ^ (place * np.uint64(0xD6E8FEB86659FD93))) * np.uint64(0x9E3779B97F4A7C15)
        out.append(keys.ravel())
    return np.concatenate(out).view(np.int64)


def _extended(sets: DataFrame, percent: int, seed: int) -> DataFrame:
    """(x, more): the extended combinations of every text."""
    bands = size_bands(percent)

    def run(batches):
        for b in batches:
            keys = [block_keys(np.asarray(t, np.int64), n, percent, bands, seed)
                    for t, n in zip(b.column("tokens").to_pylist(), b.column("n").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("tid"), pa.array(keys, pa.list_(pa.int64()))], ["x", "keys"])

    return sets.select("tid", "n", "tokens").mapInArrow(run, "x long, keys array<long>").select("x", F.explode("keys").alias("more"))


def _placed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows`` with ``x_part``, the component of text x so far."""
    return (rows.join(parts.select(F.col("id").alias("x"), "component"), "x", "left")
            .withColumn("x_part", F.coalesce("component", "x")).drop("component"))


def _open(rows: DataFrame, parts: DataFrame, hot: int) -> DataFrame:
    """(key, major, large), stored, of the keys whose texts (key, x) are in
    different components. ``major`` is the largest of them, looked for where
    a key holds many texts: a group of near copies and some texts outside it
    then cost the texts times those outside. ``large``: even so more than
    ``hot`` squared comparisons."""
    rows = rows.select("key", "x")
    keys = stored(_placed(rows, parts).groupBy("key").agg(F.min("x_part").alias("lo"), F.max("x_part").alias("hi"), F.count(F.lit(1)).alias("n"))
                  .filter("lo != hi").select("key", "n"), "jaccard-keys")
    sizes = (_placed(rows.join(keys.filter(F.col("n") > hot // 8), "key"), parts)
             .groupBy("key", "n", "x_part").agg(F.count(F.lit(1)).alias("c")))
    top = (sizes.groupBy("key", "n").agg(F.max(F.struct("c", "x_part")).alias("top"))
           .select("key", F.col("top.x_part").alias("major"), (F.col("n") * (F.col("n") - F.col("top.c")) > hot * hot).alias("large")))
    out = stored(keys.join(top, "key", "left").select("key", "major", F.coalesce("large", F.lit(False)).alias("large")), "jaccard-open")
    drop_stored(keys)
    return out


def _split(crowd: DataFrame, sets: DataFrame, parts: DataFrame, percent: int, hot: int) -> tuple[list[DataFrame], DataFrame]:
    """(tables, links): linked texts of the ``crowd`` (x) share a key in one
    of the stored tables (key, major, x, x_part) or are connected by the links,
    which hold the components ``parts``.

    Keys that are still large are mostly those of near copies: their texts
    are compared with one of them, links are contracted, and only texts of
    keys that stay open go through the combinations of the next hash."""
    out = []
    links = parts.select(F.col("id").alias("a"), F.col("component").alias("b"))
    for seed in range(ROUNDS):
        more = stored(_extended(sets.join(crowd.withColumnRenamed("x", "tid"), "tid", "left_semi"), percent, seed)
                      .withColumnRenamed("more", "key"), "jaccard-extended")
        open_keys = _open(more, parts, hot)
        split = stored(_placed(more, parts).join(open_keys, "key"), "jaccard-split")
        for done in (more, open_keys):
            drop_stored(done)
        large = split.filter("large")
        if seed == ROUNDS - 1 or large.isEmpty():
            return [*out, split], links
        out.append(split.filter("not large"))
        star = (large.join(large.groupBy("key").agg(F.min("x").alias("y")), "key").filter("x != y").select("x", "y").distinct())
        found = _verified(star, sets, percent).filter("link").select(F.col("x").alias("a"), F.col("y").alias("b"))
        links = links.unionByName(stored(found, "jaccard-more"))
        parts = components(links)
        still = _open(large, parts, hot)
        crowd = stored(large.join(still, "key", "left_semi").select("x").distinct(), "jaccard-crowd")
    return out, links


def _signatures(sets: DataFrame) -> DataFrame:
    """(x, s0 .. s7): the parity of a text's shared tokens in each of 512
    hash classes, as eight longs."""
    def run(batches):
        for b in batches:
            bits = [np.packbits(np.bincount((np.asarray(t, np.int64).view(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                                             >> np.uint64(55)).astype(np.int64), minlength=64 * WORDS).astype(np.uint8) & 1).view(">i8")
                    for t in b.column("tokens").to_pylist()]
            table = np.stack(bits).astype(np.int64) if bits else np.zeros((0, WORDS), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("tid"), *(pa.array(table[:, k]) for k in range(WORDS))],
                                             ["x", *(f"s{k}" for k in range(WORDS))])

    return sets.select("tid", "tokens").mapInArrow(run, "x long, " + ", ".join(f"s{k} long" for k in range(WORDS)))


def _may_link(percent: int):
    """Whether sizes and tokens leave two texts a link. Unshared tokens and
    classes of different parity (each holds a token of one text only) lie in
    the symmetric difference, of which a link allows (100 - percent) / (100
    + percent) of the two sizes."""
    most = F.least("x_shared", "y_shared")
    odd = sum((F.bit_count(F.col(f"x_s{k}").bitwiseXOR(F.col(f"y_s{k}"))) for k in range(WORDS)), F.lit(0))
    apart = F.col("x_n") - F.col("x_shared") + F.col("y_n") - F.col("y_shared") + odd
    size = F.col("x_n") + F.col("y_n")
    return (100 * most >= percent * (size - most)) & ((100 + percent) * apart <= (100 - percent) * size)


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(x, y, d, link) of the pairs: exact distance and decision."""
    own = texts.select(F.col("tid").alias("x"), F.col("n").alias("x_n"), F.col("tokens").alias("x_tokens"))
    other = texts.select(F.col("tid").alias("y"), F.col("n").alias("y_n"), F.col("tokens").alias("y_tokens"))
    both = F.size(F.array_intersect("x_tokens", "y_tokens")).cast("long")
    return (pairs.select("x", "y").join(own, "x").join(other, "y").withColumn("both", both)
            .withColumn("either", F.col("x_n") + F.col("y_n") - F.col("both"))
            .select("x", "y", (1 - F.col("both") / F.col("either")).alias("d"),
                    (100 * F.col("both") >= percent * F.col("either")).alias("link")))


def _candidates(profile: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(texts, candidates): one row per distinct non-empty set (digest, tid,
    rep = smallest id, n), and those that may have a partner."""
    texts = stored(profile.filter("n > 0").groupBy("digest").agg(F.min("id").alias("rep"), F.max("n").alias("n"))
                   .withColumn("tid", F.monotonically_increasing_id()), "jaccard-texts")
    lists = (profile.filter("n > 1").join(texts.select("digest", F.col("rep").alias("id"), "tid"), ["digest", "id"])
             .select("tid", "n", F.explode("first").alias("token")))
    p = slack(F.col("n"), percent)
    need_hits = F.greatest(F.lit(1), F.least(F.floor((3 * p + 1) / 2), F.col("n")) - (p - 1))
    shared = lists.groupBy("token").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("token")
    hits = (lists.join(shared, "token").groupBy("tid", "n").agg(F.count(F.lit(1)).alias("hits"))
            .filter(F.col("hits") >= need_hits).select("tid"))
    return texts, stored(texts.join(hits, "tid", "left_semi"), "jaccard-candidates")


def _ordered_sets(src: DataFrame, candidates: DataFrame, width: int, percent: int) -> DataFrame:
    """(tid, n, counts, tokens) of the candidates whose unshared tokens
    leave them a possible partner; shared tokens by rising (count, token)."""
    ids = candidates.select(F.col("rep").alias("id")).distinct()
    sets = (token_sets(src.join(ids, "id", "left_semi"), width, "digest binary, tokens array<long>",
                       lambda s: (_digest(s), s.view(np.int64)))
            .join(candidates.select("digest", F.col("rep").alias("id"), "tid"), ["id", "digest"]).select("tid", "tokens"))
    rows = sets.select("tid", F.explode("tokens").alias("token"))
    counts = rows.groupBy("token").agg(F.countDistinct("tid").cast("int").alias("c")).filter("c > 1")
    listed = rows.join(counts, "token").groupBy("tid").agg(F.sort_array(F.collect_set(F.struct("c", "token"))).alias("l"))
    return (listed.join(candidates.select("tid", "n"), "tid")
            .filter(F.col("n") - F.size("l") < slack(F.col("n"), percent))
            .select("tid", "n", F.col("l.c").alias("counts"), F.col("l.token").alias("tokens")))


def _posts(sets: DataFrame, percent: int, rare: int) -> DataFrame:
    """(key, x, x_n, x_shared, pivot): texts under each key that two or more
    hold; the pivot is the text with the smallest share of unshared tokens."""
    def run(batches):
        for b in batches:
            keys = [prefix_keys(np.asarray(t, np.int64), np.asarray(c, np.int32), n, percent, rare)
                    for t, c, n in zip(b.column("tokens").to_pylist(), b.column("counts").to_pylist(), b.column("n").to_pylist())]
            size = pa.array([len(t) for t in b.column("tokens").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("tid"), b.column("n"), size, pa.array(keys, pa.list_(pa.int64()))],
                                             ["x", "x_n", "x_shared", "keys"])

    keyed = (sets.mapInArrow(run, "x long, x_n long, x_shared long, keys array<long>")
             .select(F.explode("keys").alias("key"), "x", "x_n", "x_shared"))
    best = F.min(F.struct(((F.col("x_n") - F.col("x_shared")) / F.col("x_n")).alias("alone"), F.col("x")))
    held = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c"), best.alias("best")).filter("c > 1")
    return keyed.join(held.select("key", F.col("best.x").alias("pivot")), "key")


def _grouped(src: DataFrame, width: int, percent: int, rare: int, hot: int) -> DataFrame:
    """The columns of ``src`` (id, text, others) but the text, with n and
    part, the row's component, and component_id, its smallest id; both null
    for an empty set."""
    profile = stored(token_sets(src, width, "n long, digest binary, first array<long>", _profile(percent)), "jaccard-sets")
    texts, candidates = _candidates(profile, percent)
    sets = stored(_ordered_sets(src, candidates, width, percent), "jaccard-ordered")
    posts = stored(_posts(sets, percent, rare), "jaccard-posts")

    star = posts.filter(F.col("x") != F.col("pivot")).select("x", F.col("pivot").alias("y")).distinct()
    star = stored(_verified(star, sets, percent), "jaccard-star")
    first = components(star.filter("link").select(F.col("x").alias("a"), F.col("y").alias("b")))
    open_keys = _open(posts, first, hot)

    placed = (_placed(posts.join(open_keys.filter("not large"), "key"), first)
              .join(star.select("x", F.col("y").alias("pivot"), "d"), ["x", "pivot"], "left")
              .select("key", "major", "x", "x_n", "x_shared", "pivot", "x_part", F.coalesce("d", F.lit(0.0)).alias("x_d")))
    marks = [f"s{k}" for k in range(WORDS)]
    reach = 1 - percent / 100 + 1e-9
    # texts outside the largest component of a key meet all of its texts
    apart = ((F.col("x_part") != F.col("y_part")) & ((F.col("x") < F.col("y")) | F.col("y_part").eqNullSafe(F.col("major")))
             & _may_link(percent))

    def met(rows, also=F.lit(True)):
        """(x, y), x < y, of the rows that meet under a key and may link."""
        rows = rows.join(_signatures(sets), "x").withColumnsRenamed({m: f"x_{m}" for m in marks})
        right = rows.select("key", *[F.col(c).alias(c.replace("x", "y", 1)) for c in rows.columns if c.startswith("x")])
        outside = rows.filter(~F.col("x_part").eqNullSafe(F.col("major")))
        return outside.join(right, "key").filter(apart & also).select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))

    cross = met(placed, (F.col("x") != F.col("pivot")) & (F.col("y") != F.col("pivot")) & (F.abs(F.col("x_d") - F.col("y_d")) <= reach))
    crowd = stored(posts.join(open_keys.filter("large"), "key", "left_semi").select("x").distinct(), "jaccard-crowd")
    if crowd.isEmpty():
        split, links = [], first.select(F.col("id").alias("a"), F.col("component").alias("b"))
    else:
        split, links = _split(crowd, sets, first, percent, hot)
    sized = sets.select(F.col("tid").alias("x"), F.col("n").alias("x_n"), F.size("tokens").cast("long").alias("x_shared"))
    for rows in split:
        cross = cross.unionByName(met(rows.join(sized, "x")))
    more = _verified(cross.distinct(), sets, percent).filter("link").select(F.col("x").alias("a"), F.col("y").alias("b"))
    parts = components(links.unionByName(more))
    for done in (candidates, sets, posts, star, open_keys, crowd, *split):  # the result reads profile, texts and the contracted links
        drop_stored(done)

    of_text = texts.join(parts.withColumnRenamed("id", "tid"), "tid", "left").select(
        "digest", "rep", F.coalesce("component", "tid").alias("part"))
    # stored, so that a large component is a join partition that Spark can split
    least = stored(of_text.groupBy("part").agg(F.min("rep").alias("component_id")), "jaccard-least")
    rows = [c for c in profile.columns if c not in ("first", "digest")]
    found = of_text.join(least, "part").select("digest", "part", "component_id")
    return profile.select(*rows, "digest").join(found, "digest", "left").select(*rows, "part", "component_id")


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                    text_col: str = "text", rare: int = 16, hot: int = 1024) -> DataFrame:
    """(id, n_shingles, component_id) of every row of ``docs``.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case; a document's
    set holds its distinct ``width``-word shingles, with fewer words the
    whole sequence as one. Null, empty and blank texts have an empty set and
    link with nothing. ``component_id`` is the smallest id that links reach,
    the row's own id included. Repeated rows are copies of each other; rows
    that repeat an id with another text are texts of their own. A null id
    comes after all others: its row links like any other, and a component of
    null ids only is null (ids are below ``NO_ID``, which stands for null).
    Empty tables give empty results, other columns are not read. Texts of
    any length are taken whole. ``rare`` and ``hot`` move work, not results."""
    need(docs, id_col, text_col)
    src = docs.select(F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)).alias("id"), docs[text_col].alias("text"))
    return _grouped(src, width, percent, rare, hot).select(
        F.nullif("id", F.lit(NO_ID)).alias(id_col), F.col("n").alias("n_shingles"),
        F.nullif(F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")), F.lit(NO_ID)).alias("component_id"))


def without_copies(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id",
                   text_col: str = "text", rare: int = 16, hot: int = 1024) -> DataFrame:
    """The rows of ``docs``, one of each component of ``near_duplicates``.

    The row with the smallest id stays (a null id comes last; of rows that
    repeat this id with other texts the one with the smallest text hash, of
    rows that repeat id and text any one). Rows without words are no copies
    of each other: all stay. An id that repeats with texts of different
    components stays once in each. Other columns pass through whatever their
    names; an empty table gives an empty one."""
    need(docs, id_col, text_col)
    taken = {c.lower() for c in docs.columns}
    key, mark = ("_" * max(map(len, taken)) + c for c in ("id", "mark"))
    marked = docs.withColumns({key: F.coalesce(docs[id_col].cast("long"), F.lit(NO_ID)), mark: F.xxhash64(docs[text_col])})
    src = marked.select(F.col(key).alias("id"), F.col(mark).alias("mark"), docs[text_col].alias("text"))
    rows = stored(_grouped(src, width, percent, rare, hot).filter("n > 0").select("id", "mark", "part"), "jaccard-rows")
    keep = stored(rows.groupBy("part").agg(F.count(F.lit(1)).alias("c"), F.min(F.struct("id", "mark")).alias("first"))
                  .filter("c > 1").select("part", "first"), "jaccard-keep")
    # rows equal in id and text are of one component, so they stay or go together
    fate = stored(rows.join(keep, "part").groupBy(F.col("id").alias(key), F.col("mark").alias(mark))
                  .agg(F.min(F.struct("id", "mark") == F.col("first")).alias("stays"), F.count(F.lit(1)).alias("c"))
                  .filter("not stays or c > 1"), "jaccard-fate")
    left = marked.join(fate.filter("not stays").select(key, mark), [key, mark], "left_anti")
    again = fate.filter("stays").select(key, mark)
    if not again.isEmpty():
        once = left.join(again, [key, mark], "left_semi").dropDuplicates([key, mark])
        left = left.join(again, [key, mark], "left_anti").unionByName(once)
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])


#: ``near_duplicates(documents, 4, 85)`` by joining all texts on shingles.
REPORT_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
p AS (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM w WHERE len(words) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS shingle FROM p),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
      FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM c JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
      WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)),
r(doc_id, seen) AS (SELECT doc_id, doc_id FROM documents
                    UNION SELECT l.y, r.seen FROM r JOIN l ON r.doc_id = l.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, d.component_id
FROM (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY doc_id) d LEFT JOIN n ON n.doc_id = d.doc_id
"""

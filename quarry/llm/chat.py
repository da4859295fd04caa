"""Chat formatting by minimum-cost role repair (operator 7).

A legal conversation is an optional system turn, then user and assistant
turns in alternation, user first and assistant last. Dynamic programming over
the automaton of the last role chooses for every input turn whether it is
kept, merged into the turn before it, relabelled, or preceded by inserted
empty turns, at least total cost (``COSTS``); the repaired sequence is then
rendered with a template.

Turns are dealt out by ranges of (conversation, turn), so that a
conversation of any length is spread over tasks and no group is collected. A
stretch of turns acts on the automaton as a 4 x 4 matrix in the (min, +)
algebra: each task gives the matrix of its first and last conversation, the
few matrices of a conversation that crosses tasks are chained to find its
states at the task edges, and every stretch is then repaired between fixed
states. Equal role patterns share one solution.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import need, partitions, stored
from quarry.llm.text import memo

ROLES = ("system", "user", "assistant")
#: Roles read as another one; any other role, or none, is unknown.
ALIASES = {"human": "user", "prompter": "user", "bot": "assistant", "ai": "assistant", "gpt": "assistant", "model": "assistant"}
#: What an edit costs. An unknown role takes any label at ``name``.
COSTS = {"merge": 1, "name": 1, "relabel": 8, "merge_other": 9, "insert": 3}

START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_CODE = {"system": "s", "user": "u", "assistant": "a"}
_STATE = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
_BIG = 1 << 60


def role_code(role: str | None) -> str:
    r = (role or "").strip().lower()
    return _CODE.get(ALIASES.get(r, r), "?")


@memo
def inserts(a: int, b: int) -> tuple[int, ...] | None:
    """Shortest run of empty turns that leads from state a to b."""
    paths = {a: ()}
    for _ in range(3):
        for s, p in list(paths.items()):
            for n in _NEXT[s]:
                if n != SYSTEM:  # a system turn is never made up
                    paths.setdefault(n, (*p, n))
    return paths.get(b)


@memo
def step(code: str, a: int, b: int) -> tuple[int, str, tuple[int, ...]]:
    """(cost, action, inserted before) of the cheapest way in which a turn of
    role ``code`` leads from state a to b; ties: keep, merge, relabel."""
    best = (_BIG, "none", ())
    for mid in range(4):
        run = inserts(a, mid)
        if run is None:
            continue
        base = COSTS["insert"] * len(run)
        if b in _NEXT[mid]:
            own = 0 if _STATE.get(code) == b else COSTS["name"] if code == "?" else COSTS["relabel"]
            best = min(best, (base + own, "keep" if own == 0 else "relabel", run), key=_rank)
        if b == mid != START:
            cost = COSTS["merge"] if code == "?" or _STATE[code] == b else COSTS["merge_other"]
            best = min(best, (base + cost, "merge", run), key=_rank)
    return best


def _rank(choice):
    return choice[0], len(choice[2]), ("keep", "merge", "relabel", "none").index(choice[1]), choice[2]


def transfer(pattern: str) -> np.ndarray:
    """(min, +) matrix of a stretch: least cost from each state to each."""
    m = np.where(np.eye(4, dtype=bool), 0, _BIG)
    for code in pattern:
        one = np.array([[step(code, a, b)[0] for b in range(4)] for a in range(4)])
        m = np.minimum((m[:, :, None] + one[None]).min(1), _BIG)
    return m


def closing(state: int) -> tuple[int, ...]:
    """Empty turns that end a conversation legally."""
    return () if state == ASSISTANT else inserts(state, ASSISTANT)


@memo
def solve(pattern: str, start: int = START, end: int | None = None) -> tuple[tuple[tuple[int, str, tuple[int, ...]], ...], int]:
    """((state after, action, inserted before) per turn, cost) of the
    cheapest repair from ``start``, to ``end`` or to a legal end. Ties go to
    the smallest state, from the last turn backwards."""
    cost = [_BIG] * 4
    cost[start] = 0
    back = []
    for code in pattern:
        new, came = [_BIG] * 4, [0] * 4
        for b in range(4):
            new[b], came[b] = min((cost[a] + step(code, a, b)[0], a) for a in range(4))
        cost = [min(c, _BIG) for c in new]
        back.append(came)
    if end is None:
        total, end = min((cost[s] + COSTS["insert"] * len(closing(s)), s) for s in (SYSTEM, USER, ASSISTANT))
    else:
        total = cost[end]
    out, s = [], end
    for code, came in zip(reversed(pattern), reversed(back)):
        a = came[s]
        out.append((s, *step(code, a, s)[1:]))
        s = a
    return tuple(reversed(out)), total


def edge_states(matrices: list[np.ndarray]) -> list[tuple[int, int]]:
    """(state before, state after) of each stretch of one conversation."""
    cost, back = [0, _BIG, _BIG, _BIG], []
    for m in matrices:
        new, came = zip(*(min((cost[a] + int(m[a, b]), a) for a in range(4)) for b in range(4)))
        cost, back = list(new), [*back, came]
    _, s = min((cost[s] + COSTS["insert"] * len(closing(s)), s) for s in (SYSTEM, USER, ASSISTANT))
    out = []
    for came in reversed(back):
        out.append((came[s], s))
        s = came[s]
    return out[::-1]


#: Rendering: what opens a turn, what stands between merged texts, what ends it.
TEMPLATE = ("<|{role}|>\n", "\n", "<|end|>\n")
_SORT = ("conv", "turn", "role", "text")


#: Characters of rendered text in one batch, about.
_OUT = 4 << 20


def _rows(piece):
    """(turn, role, text) of a piece of a stretch."""
    if isinstance(piece, pa.RecordBatch):
        return zip(*(piece.column(c).to_pylist() for c in ("turn", "role", "text")))
    return piece


def _roles(pieces) -> str:
    return "".join(role_code(r) for p in pieces for r in (
        p.column("role").to_pylist() if isinstance(p, pa.RecordBatch) else [role for _, role, _ in p]))


def _stretches(batches):
    """(part, conversation, pieces) of sorted batches, in order. Only the
    stretch that is open at the end of a batch is held, as Arrow slices."""
    held, key = [], None
    for b in batches:
        if not b.num_rows:
            continue
        part = b.column("part").to_numpy(zero_copy_only=False)
        conv = b.column("conv").fill_null(0).to_numpy(zero_copy_only=False)
        null = b.column("conv").is_null().to_numpy(zero_copy_only=False)
        new = (np.diff(part) != 0) | (np.diff(conv) != 0) | (null[1:] != null[:-1])
        cut = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
        rows = None
        for a, z in zip(cut, cut[1:]):
            now = int(part[a]), None if null[a] else int(conv[a])
            if held and now != key:
                yield *key, held
                held = []
            key = now
            if held or z == b.num_rows:
                held.append(b.slice(a, z - a))
            else:
                if rows is None:
                    rows = list(_rows(b))
                yield *key, [rows[a:z]]
    if held:
        yield *key, held


def repair_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", template: tuple[str, str, str] = TEMPLATE) -> DataFrame:
    """(conv, place, turn, role_in, role, action, rendered): the repaired
    conversations, a row for every input turn and every inserted one.

    Rows of a conversation in the order of ``place`` give, with their
    ``rendered`` pieces put together, its rendered text; ``action`` is keep,
    merge, relabel or insert. A null text is an empty turn; a null or
    unknown role takes the label that costs least; turns are ordered by
    turn, then role and text (null first), so equal and repeated rows are
    separate turns; rows with a null conversation form one conversation; an
    empty table gives an empty one; other columns are not read."""
    need(turns, conv_col, turn_col, role_col, text_col)
    spark = turns.sparkSession
    src = turns.select(turns[conv_col].cast("long").alias("conv"), turns[turn_col].cast("long").alias("turn"),
                       turns[role_col].alias("role"), turns[text_col].alias("text"))
    dealt = stored(src.repartitionByRange(partitions(spark), *_SORT).withColumn("part", F.spark_partition_id()), "chat-turns")

    def sorted_parts(keys):
        """Each range in a task of its own, in order; without the texts the
        order of the roles is the same."""
        return dealt.select("part", *keys).repartitionById(partitions(spark), "part").sortWithinPartitions("part", *keys)

    def summary(batches):
        def edges():
            """The first and the last stretch of each part."""
            last, count = None, 0
            for part, conv, pieces in _stretches(batches):
                if last and last[0] != part:
                    if count > 1:
                        yield last
                    count = 0
                count += 1
                last = part, conv, _roles(pieces)
                if count == 1:
                    yield last
            if last and count > 1:
                yield last
        for part, conv, roles in edges():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([conv], pa.int64()),
                                              pa.array([transfer(roles).ravel().tolist()], pa.list_(pa.int64()))], ["part", "conv", "cost"])

    # two rows per range at most
    rows = sorted_parts(_SORT[:-1]).withColumn("text", F.lit(None).cast("string")).mapInArrow(summary, "part int, conv long, cost array<long>").collect()
    edges: dict = {}
    for r in sorted(rows, key=lambda r: r["part"]):
        edges.setdefault(r["conv"], []).append((r["part"], np.array(r["cost"]).reshape(4, 4)))
    fixed = {}
    for conv, some in edges.items():
        if len(some) > 1:
            states = edge_states([m for _, m in some])
            for k, ((part, _), (a, z)) in enumerate(zip(some, states)):
                fixed[part, conv] = a, z, k == len(some) - 1
    opens, joins, ends = template

    def render(batches):
        cols: list[list] = [[] for _ in range(7)]
        size, place, at = 0, 0, None
        for part, conv, pieces in _stretches(batches):
            if part != at:
                at, place = part, part << 32
            a, z, last = fixed.get((part, conv), (START, None, True))
            plan = iter(solve(_roles(pieces), a, z)[0])
            state = a
            for piece in pieces:
                for turn, role, text in _rows(piece):
                    if size > _OUT:  # the row before is complete: a turn of this stretch follows it
                        yield _batch(cols)
                        cols, size = [[] for _ in range(7)], 0
                    after, action, before = next(plan)
                    for s in before:
                        place += 1
                        lead = (ends if state != START else "") + opens.format(role=ROLES[s - 1])
                        _put(cols, conv, place, None, None, ROLES[s - 1], "insert", lead)
                        state = s
                    lead = joins if action == "merge" else (ends if state != START else "") + opens.format(role=ROLES[after - 1])
                    place += 1
                    _put(cols, conv, place, turn, role, ROLES[after - 1], action, lead + (text or ""))
                    size += 64 + len(text or "")
                    state = after
            if last:
                for s in closing(state):
                    place += 1
                    _put(cols, conv, place, None, None, ROLES[s - 1], "insert", ends + opens.format(role=ROLES[s - 1]))
                cols[6][-1] += ends
        if cols[0]:
            yield _batch(cols)

    out = sorted_parts(_SORT).mapInArrow(
        render, "conv long, place long, turn long, role_in string, role string, action string, rendered string")
    return out.withColumnRenamed("conv", conv_col)


_NAMES = ["conv", "place", "turn", "role_in", "role", "action", "rendered"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]


def _batch(cols: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, _KINDS)], _NAMES)


def _put(cols: list[list], *values) -> None:
    for c, v in zip(cols, values):
        c.append(v)

"""Operator 7 against exhaustive search, and conversations across tasks."""

import itertools
import re

import pyarrow as pa
import pytest

from quarry.llm import chat
from quarry.llm.chat import _NEXT, _STATE, _rows, _stretches, ASSISTANT, COSTS, START, SYSTEM, edge_states, repair_chats, role_code, solve, transfer
from llm_fixtures import rng  # noqa: F401

SCHEMA = "conv_id long, turn long, role string, text string"


def least_cost(pattern):
    best = 10**9

    def go(i, s, c):
        nonlocal best
        if c >= best:
            return
        if i == len(pattern):
            if s == ASSISTANT:
                best = c
            elif s != START:
                for n in _NEXT[s]:
                    go(i, n, c + COSTS["insert"])
            return
        code = pattern[i]
        for n in _NEXT[s]:
            go(i + 1, n, c + (0 if _STATE.get(code) == n else COSTS["name"] if code == "?" else COSTS["relabel"]))
            if n != SYSTEM:
                go(i, n, c + COSTS["insert"])
        if s != START:
            go(i + 1, s, c + (COSTS["merge"] if code == "?" or _STATE[code] == s else COSTS["merge_other"]))

    go(0, START, 0)
    return best


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_cost_is_the_least(n):
    for p in itertools.product("sua?", repeat=n):
        assert solve("".join(p))[1] == least_cost(p), p


def test_stretches_chain_to_the_whole(rng):
    for _ in range(200):
        p = "".join(rng.choices("sua?", k=rng.randint(2, 40)))
        cut = sorted(rng.sample(range(1, len(p)), min(3, len(p) - 1)))
        parts = [p[a:b] for a, b in zip([0, *cut], [*cut, len(p)])]
        states = edge_states([transfer(x) for x in parts])
        cost = sum(solve(x, a, z)[1] for x, (a, z) in zip(parts, states))
        assert cost + COSTS["insert"] * {ASSISTANT: 0, 2: 1, 1: 2}[states[-1][1]] == solve(p)[1]


def roles_of(rendered):
    return "".join(re.findall(r"<\|([sua])(?:ystem|ser|ssistant)\|>\n", rendered))


def test_repaired_conversations_are_legal(spark, rng):
    roles = ["user", "assistant", "system", None, "Human", "bot", "tool"]
    rows = [(1, i, rng.choice(roles), f"t{i}") for i in range(700)]         # spread over many tasks
    rows += [(c, i, rng.choice(roles), rng.choice([None, "", "hello"])) for c in range(2, 80) for i in range(rng.randint(1, 7))]
    rng.shuffle(rows)
    got = repair_chats(spark.createDataFrame(rows, SCHEMA).repartition(5)).toPandas().sort_values(["conv_id", "place"])
    for c, g in got.groupby("conv_id"):
        mine = sorted([r for r in rows if r[0] == c], key=lambda r: r[1])
        plan, cost = solve("".join(role_code(r[2]) for r in mine))
        spent = 0
        for action, said, role in zip(g.action, g.role_in, g.role):
            code = role_code(said)
            same = code == "?" or code == role[0]
            spent += {"keep": 0, "insert": COSTS["insert"], "merge": COSTS["merge" if same else "merge_other"],
                      "relabel": COSTS["name" if code == "?" else "relabel"]}[action]
        whole = "".join(g.rendered)
        assert spent == cost and re.fullmatch("s?(ua)+", roles_of(whole))
        assert whole.endswith("<|end|>\n") and whole.count("<|end|>") == len(roles_of(whole))
        kept = g[g.action != "insert"]
        assert kept.turn.tolist() == [r[1] for r in mine]                   # no turn is lost
    one = got[got.conv_id == 1]
    assert [f"t{i}" for i in range(700)] == re.findall(r"t\d+", "".join(one.rendered))


def test_edges(spark):
    rows = [(None, 0, "user", "a"), (None, 1, "assistant", "b"), (5, None, "user", "x"), (5, 1, "user", "y"), (5, 1, "user", "y"),
            (6, 0, "assistant", None), (7, 0, "system", "s")]
    extra = spark.createDataFrame([(*r, 1, "p") for r in rows], SCHEMA + ", place int, conv string")
    got = repair_chats(extra).toPandas().sort_values("place")
    text = {(-1 if c != c else int(c)): "".join(g.rendered) for c, g in got.groupby("conv_id", dropna=False)}
    assert text[-1] == "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n"
    assert text[5] == "<|user|>\nx\ny\ny<|end|>\n<|assistant|>\n<|end|>\n"
    assert text[6] == "<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert text[7] == "<|system|>\ns<|end|>\n<|user|>\n<|end|>\n<|assistant|>\n<|end|>\n"
    assert repair_chats(extra.limit(0)).count() == 0


def test_stretches_cross_batches(rng):
    kinds = pa.schema([("part", pa.int32()), ("conv", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    for _ in range(50):
        rows = sorted(((rng.randrange(3), rng.choice([None, 0, 1, 2])) for _ in range(rng.randrange(40))),
                      key=lambda r: (r[0], r[1] is not None, r[1] or 0))
        table = pa.Table.from_pylist([dict(part=p, conv=c, turn=k, role="user", text=f"t{k}") for k, (p, c) in enumerate(rows)], kinds)
        cuts = sorted({0, len(rows), *(rng.randrange(len(rows) + 1) for _ in range(6))})
        batches = [b for a, z in zip(cuts, cuts[1:]) for b in table.slice(a, z - a).combine_chunks().to_batches()]
        got = [(part, conv, [t for piece in pieces for t, _, _ in _rows(piece)]) for part, conv, pieces in _stretches(batches)]
        want = [(*key, [k for k, r in enumerate(rows) if r == key]) for key in dict.fromkeys(rows)]
        assert got == want


def test_output_comes_in_batches(spark, monkeypatch):
    rows = [(k % 3, k // 3, ["user", "assistant"][k // 3 % 2], "x" * 100) for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = sorted(tuple(r) for r in repair_chats(df).collect())
    monkeypatch.setattr(chat, "_OUT", 500)
    assert len(want) == 300 and sorted(tuple(r) for r in repair_chats(df).collect()) == want

import random
import re

import pytest

from pennant.llm import chat_format as C
from pennant.llm.common import table


def number(role):
    plain = (role or "?").strip().lower()
    return {"system": 1, "user": 2, "assistant": 3}.get(C.ALIASES.get(plain, plain), 0)


def brute(rows):
    conversations, out = {}, []
    for c, t, r, x in {(c, t, r, x or "") for c, t, r, x in rows}:
        conversations.setdefault(c, []).append((C.NO_ID if t is None else t, r, x, t))
    for c, turns in conversations.items():
        turns.sort(key=lambda z: (z[0], (z[1] is not None, z[1] or ""), z[2]))
        roles = [number(t[1]) for t in turns]
        last = C._forward([0, C.FAR, C.FAR, C.FAR], roles)[-1]
        _, path = C.backward([0, C.FAR, C.FAR, C.FAR], roles, last.index(min(last)))
        out += [(c, t[3], t[1], C.NAMES[s], a, C.NAMES[i] or None) for t, (s, a, i) in zip(turns, path, strict=True)]
    return sorted(out, key=repr)


def check(df):
    got = sorted((tuple(r)[:6] for r in C.repair(df).collect()), key=repr)
    assert got == brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])


def test_conversations(spark, sf):
    check(table(spark, sf, "conversations"))


@pytest.mark.parametrize("segment", [3, 256])
def test_segments_and_edges(spark, segment, monkeypatch):
    monkeypatch.setattr(C, "SEGMENT", segment)
    random.seed(3)
    rows = [(1, k, random.choice(["user", "assistant", "system", None, "Human", "x"]), f"t{k}") for k in range(100)]
    rows += [(None, None, "user", None), (None, None, "user", None), (2, 0, "assistant", "hi"), (3, 0, "user", "a"), (3, 0, "user", "a"), (3, 0, "system", "s"), (4, -5, "user", "é" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as conv", "2 as segment")
    check(df)
    check(df.limit(0))


def repairs(given):
    """Cost of every way to repair a list of roles, by the rules alone: merge 1, insert an empty turn 2, relabel 3, name an unknown role 1."""

    def legal(done):
        rest = done[1:] if done[:1] == ["system"] else done
        return all(r == ("user", "assistant")[k % 2] for k, r in enumerate(rest))

    ways = [([], 0)]
    for role in given:
        new = []
        for done, cost in ways:
            for name in ("system", "user", "assistant"):
                own = 0 if name == role else 1 if role is None else 3
                new.append(([*done, name], cost + own))
                if name == role:
                    new += [([*done, empty, name], cost + 2) for empty in ("system", "user", "assistant")]
            if role is not None and done and done[-1] == role:
                new.append((done, cost + 1))
        ways = [(d, c) for d, c in new if legal(d)]
    return min(c for _, c in ways)


@pytest.mark.parametrize("seed", range(3))
def test_least_cost(spark, seed):
    """What the repair costs is the least of all legal repairs, tried one by one with an automaton of the test's own."""
    random.seed(seed)
    lists = [[random.choice(["system", "user", "assistant", None]) for _ in range(random.randrange(1, 6))] for _ in range(60)]
    rows = [(c, k, r, "x") for c, roles in enumerate(lists) for k, r in enumerate(roles)]
    cost, shown = {}, {}
    for r in sorted(C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect(), key=lambda r: (r.conv_id, r.at)):
        own = {"keep": 0, "merge": 1, "insert": 2, "relabel": 1 if r.given_role is None else 3}[r.action]
        cost[r.conv_id] = cost.get(r.conv_id, 0) + own
        assert r.action != "relabel" or r.role != r.given_role
        assert r.action == "relabel" or r.role == r.given_role
        seen = shown.setdefault(r.conv_id, [])
        seen += [x for x in (r.inserted,) if x] + ([r.role] if r.starts else [])
    assert cost == {c: repairs(roles) for c, roles in enumerate(lists)}
    for seen in shown.values():
        rest = seen[1:] if seen[0] == "system" else seen
        assert all(r == ("user", "assistant")[k % 2] for k, r in enumerate(rest))


def test_rendering(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "hi")]
    got = {r.conv_id: r.text for r in C.render(C.repair(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert got == {
        1: "<|im_start|>user\na\nb<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n",
        2: "<|im_start|>user\n<|im_end|>\n<|im_start|>assistant\nhi<|im_end|>\n",
    }


def test_segments_are_bounded(spark, monkeypatch):
    """Null ids, null turn numbers and one repeated number: no segment holds more than SEGMENT turns, and the order is kept."""
    most = []

    def kept(df, label, write=C.materialize):
        out = write(df, label)
        if label == "segments":
            most.append(out.selectExpr("max(size(turns))").first()[0])
        return out

    monkeypatch.setattr(C, "materialize", kept)
    random.seed(5)
    roles = ["user", "assistant", "system", None]
    rows = [(None, None, random.choice(roles), f"a{k}") for k in range(2_000)] + [(7, 3, random.choice(roles), f"b{k}") for k in range(700)]
    rows += [(8, k, random.choice(roles), "c") for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check(df)
    assert most == [C.SEGMENT]
    pieces = C.repair(df)
    at = {}
    for r in pieces.collect():
        at.setdefault(r.conv_id, []).append(r.at)
    assert {c: sorted(x) for c, x in at.items()} == {None: list(range(2_000)), 7: list(range(700)), 8: list(range(300))}
    text = {r.conv_id: r.text for r in C.render(pieces).collect()}
    assert [x for x in re.findall(r"b\d+", text[7])] == [x for _, x in sorted((r or "", x) for c, _, r, x in rows if c == 7)]

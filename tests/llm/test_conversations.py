"""Repair of conversations against a plain search over all nodes and, for short ones, over all audits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from chronoreg.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, key string, cost long"  # with names that the operator uses
SPACE = " \t\n\x0b\x0c\r"
PATTERN = re.compile(r"(s?(ua)+)?")


def damage(rows):
    """The damaged rows of each conversation, in order, as (turn, role, text)."""
    out = {}
    for conv, turn, role, text, *_ in rows:
        mine = out.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        mine += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    for mine in out.values():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.strip(SPACE)
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def moves(state):
    """The state and role that come next, of a pattern read as: 0 nothing yet, 1 system, 2 user, 3 assistant."""
    return (3, "assistant") if state == 2 else (2, "user")


def plain(rows, wrong):
    """Cost and audit by a search node by node, without a heap."""
    best = {(0, 0): (0, "")}
    for at in range(len(rows) + 1):
        for _ in range(4):
            for q in range(4):
                if (at, q) in best:
                    cost, audit = best[at, q]
                    to = (at, moves(q)[0])
                    best[to] = min(best.get(to, (cost + 3, audit + "I")), (cost + 3, audit + "I"))
        if at == len(rows):
            break
        for q in range(4):
            if (at, q) not in best:
                continue
            cost, audit = best[at, q]
            steps = [(4, "D", q)]
            if wrong[at] not in ("blank", "duplicate"):
                more = 3 if wrong[at] == "truncated" else 0
                initial = rows[at][1][:1]
                follows = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "": {x: x for x in range(4)}}.get(initial, {})
                steps += [(more, "K", follows[q])] if q in follows else []
                steps += [(3 + more, "R", moves(q)[0])]
            for more, letter, to in steps:
                new = (cost + more, audit + letter)
                best[at + 1, to] = min(best.get((at + 1, to), new), new)
    return min(best[len(rows), q] for q in (0, 3) if (len(rows), q) in best)


def apply(rows, audit):
    out, at, state = [], 0, 0
    for letter in audit:
        if letter == "I":
            state, role = moves(state)
            out.append((role, ""))
            continue
        _, role, text = rows[at]
        at += 1
        if letter == "R":
            state, role = moves(state)
        elif letter == "K":
            state = {"s": 1, "u": 2, "a": 3}.get(role[:1], state)
        if letter != "D":
            out.append((role, text))
    assert at == len(rows)
    return out


def expected(rows):
    want = {}
    for conv, mine in damage(rows).items():
        wrong = faults(mine)
        cost, audit = plain(mine, wrong)
        after = apply(mine, audit)
        assert PATTERN.fullmatch("".join(r[:1] for r, _ in after))
        turns = {t for t, *_ in mine if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        want[conv] = {
            "conv_id": conv, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, "blank": wrong.count("blank"), "duplicate": wrong.count("duplicate"),
            "truncated": wrong.count("truncated"), "illegal": illegal, "cost": cost, "audit": audit,
            "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in after).encode()).hexdigest(),
        }
    return want


def talk(rng, conv, n):
    rows = []
    for turn in range(n):
        role = rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", None, "unknown"]) if rng.random() < 0.3 else ("user", "assistant")[turn % 2]
        text = rng.choice(["Yes.", "No", "Well!", "", " \t", None, f"Line {turn}.", f"é {turn}\x85", "Ends here. \n"])
        rows.append((conv, rng.choice([turn, turn, turn, None, turn + 2]), role, text, "k", 1))
    return rows


def table(seed=3):
    rng = random.Random(seed)
    rows = [r for conv in range(250) for r in talk(rng, conv, rng.choice([1, 2, 3, 4, 6, 9]))]
    rows += talk(rng, None, 6) + talk(rng, 1000, 90) + [(1001, t % 40, ("user", "assistant")[t % 2], "The same." if t % 3 else f"Other {t % 50}", "k", 1) for t in range(400)]
    rows += [(1002, 7, "user", "Again and again.", "k", 1)] * 60 + [(1003, None, None, None, "k", 1)] * 3
    rows += rows[5:9] + [(2000 + i, t, "user", "x.", "k", 1) for i in range(1) for t in (19,)]
    gone = next(c for c in range(3000, 9000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "All of it is dropped.", "k", 1))
    rng.shuffle(rows)
    return rows


def test_short_lattices_by_all_audits():
    """Every edit sequence of up to three rows."""
    rng = random.Random(1)
    for _ in range(60):
        shape = [(rng.choice(["s", "u", "a", "t", ""]), rng.choice(["", "", "t", "x"]), 1) for _ in range(rng.randint(0, 3))]
        found = []

        def walk(at, state, cost, audit):
            if len(audit) > 7 or cost > 20:
                return
            if at == len(shape) and state in (0, 3):
                found.append((cost, audit))
            walk(at, moves(state)[0], cost + 3, audit + "I")
            if at < len(shape):
                for origin, more, letters, to in conversations.arcs(shape[at]):
                    if origin == state:
                        walk(at + 1, to, cost + more, audit + letters)

        walk(0, 0, 0, "")
        assert conversations.cheapest([conversations.arcs(r) for r in shape], 0, (0, 3)) == min(found)


def test_search_between_any_states():
    """The search from a state to another one agrees with the plain one, however long the conversation."""
    rng = random.Random(2)
    for n in (1, 5, 40):
        for _ in range(30):
            mine = [(t, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["a.", f"b{t}.", "c", ""])) for t in range(n)]
            wrong = faults(mine)
            shape = [(r[:1], {"truncated": "t", "": ""}.get(w, "x"), 1) for (_, r, _), w in zip(mine, wrong)]
            assert conversations.cheapest([conversations.arcs(r) for r in shape], 0, (0, 3)) == plain(mine, wrong)


@pytest.mark.parametrize("seed", [3, 4])
def test_conversations(spark, seed):
    rows = table(seed)
    want = expected(rows)
    got = {r.conv_id: r.asDict() for r in conversations.digest(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()}
    assert got == want
    assert sum(w["illegal"] > 0 for w in want.values()) > 50 and sum("I" in w["audit"] for w in want.values()) > 50


def test_long_conversation_in_chunks(spark):
    """Chunks of three rows: nearly every conversation is cut, within a task and between tasks."""
    rows = table(5)
    want = expected(rows)
    damaged = conversations.damaged(spark.createDataFrame(rows, SCHEMA).repartition(4))
    audits, messages, digests = conversations.repair(damaged, chunk=3)
    assert {r.conv_id: (r.cost, r.audit, r.gaps, r.duplicate, r.illegal) for r in audits.collect()} == {c: (w["cost"], w["audit"], w["gaps"], w["duplicate"], w["illegal"]) for c, w in want.items()}
    assert {r.conv_id: r.sha256 for r in digests.collect()} == {c: w["repaired_sha256"] for c, w in want.items()}
    said = {}
    for r in sorted(messages.collect(), key=lambda r: (r.part, r["at"])):
        said.setdefault(r.conv_id, []).extend(f"{m.role}:{m.text}" for m in r.messages)
    assert {c: hashlib.sha256("\n".join(s).encode()).hexdigest() for c, s in said.items()} == {c: want[c]["repaired_sha256"] for c in said} and set(said) == set(want)


def test_empty_table(spark):
    assert conversations.digest(spark.createDataFrame([], SCHEMA)).collect() == []

"""Conversation repair against plain enumeration of all edits."""

import hashlib
import itertools
import random
import re
import time
import zlib
from collections import defaultdict

import pytest

from waymark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, c string, n int"
CORE = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    """(conv_id, [(turn, role, text)]) after the contract's damage, in order."""
    out = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        out[conv] += []
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        role = "user" if kind == 4 else role
        out[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.md5(r[2].encode()).hexdigest())
    return {conv: sorted(rs, key=order) for conv, rs in out.items()}


def facts(rows):
    turns = [t for t, *_ in rows if t is not None]
    out = {"gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0}
    out |= dict.fromkeys(("blank", "duplicate", "truncated"), 0)
    seen, faults = set(), []
    for _, role, text in rows:
        core = CORE.findall(text)
        fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
        seen.add((role, text))
        faults.append(fault)
        if fault:
            out[fault] += 1
    out["illegal"] = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return out, faults


def enumerate_edits(rows, faults):
    """All edits with up to two insertions at each place whose roles begin a legal pattern."""
    best = None
    stack = [(0, 0, 0, "", [])]
    while stack:
        i, inserted, cost, audit, said = stack.pop()
        if not re.fullmatch("s?(ua)*u?", "".join(r[:1] or "-" for r, _ in said)):
            continue
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", "".join(r[:1] for r, _ in said)):
            best = min(best or (cost, audit, said), (cost, audit, said), key=lambda b: b[:2])
        if inserted < 2:
            stack += [(i, inserted + 1, cost + 2, audit + "I", [*said, (r, "")]) for r in ("user", "assistant")]
        if i == len(rows):
            continue
        _, role, text = rows[i]
        stack.append((i + 1, 0, cost + 3, audit + "D", said))
        if faults[i] not in ("blank", "duplicate"):
            extra = faults[i] == "truncated"
            stack.append((i + 1, 0, cost + extra, audit + "K", [*said, (role, text)]))
            stack += [(i + 1, 0, cost + extra + 2, audit + "R", [*said, (r, text)]) for r in ("user", "assistant")]
    return best


def shortest(rows, faults):
    """The same by a search over (rows read, state) in order of cost and audit, for long ones."""
    state = {0: (0, "", [])}
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}

    def close(states):
        for _ in range(3):
            for q, (cost, audit, said) in list(states.items()):
                role = "assistant" if q == 2 else "user"
                way = (cost + 2, audit + "I", [*said, (role, "")])
                nxt = moves[q][role[0]]
                if nxt not in states or way[:2] < states[nxt][:2]:
                    states[nxt] = way
        return states

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for q, (cost, audit, said) in close(state).items():
            options = [(cost + 3, audit + "D", said, q)]
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                options += [
                    (cost + extra + 2 * (k == "R"), audit + k, [*said, (r, text)], moves[q][r[:1]])
                    for k, r in (("K", role), ("R", "user"), ("R", "assistant"))
                    if r[:1] in moves[q]
                ]
            for way in options:
                if way[3] not in new or way[:2] < new[way[3]][:2]:
                    new[way[3]] = way[:3]
        state = new
    return min((w for q, w in close(state).items() if q in (0, 3)), key=lambda w: w[:2])


def expected(rows, solve):
    out = {}
    for conv, rs in damage(rows).items():
        counts, faults = facts(rs)
        cost, audit, said = solve(rs, faults)
        text = "\n".join(f"{r}:{t}" for r, t in said)
        out[conv] = counts | {"cost": cost, "audit": audit, "repaired_sha256": hashlib.sha256(text.encode()).hexdigest()}
    return out


def check(spark, rows, solve, **settings):
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {r["conv_id"]: r.asDict() for r in cr.repair_conversations(frame, **settings).collect()}
    want = expected(rows, solve)
    assert set(got) == set(want)
    for conv, w in want.items():
        assert {k: got[conv][k] for k in w} == w, conv


def chat(rng, conv, n, turns=None):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", "ux"]
    texts = ["Yes.", "No!", "half a", "", None, " \n", "Why?", "Why?", "x . "]
    for i in range(n):
        usual = ("system", "user")[i > 0] if i < 2 else ("assistant", "user")[i % 2]
        role = usual if rng.random() < 0.5 else rng.choice(roles)
        text = f"Number {rng.randrange(9999)}." if rng.random() < 0.6 else rng.choice(texts)
        yield conv, (turns or range(n))[i], role, text, "extra", 7


def test_short_conversations_equal_enumeration(spark):
    rng = random.Random(12)
    rows = [r for conv in range(90) for r in chat(rng, conv, rng.randint(1, 4))]
    rows += [r for conv in (None, 1000) for r in chat(rng, conv, 3, turns=[None, 5, 2])]
    rows += [(2000, 7, "user", "Same.", "", 0)] * 3 + [(2001, None, None, None, "", 0)] * 2
    check(spark, rows, enumerate_edits)


def test_search_and_enumeration_agree():
    rng = random.Random(7)
    for _ in range(200):
        rows = [(t, r or " ", x or " ") for _, t, r, x, *_ in chat(rng, 0, rng.randint(0, 4))]
        _, faults = facts(rows)
        assert shortest(rows, faults) == enumerate_edits(rows, faults)


def test_long_conversations_are_cut_and_joined(spark):
    rng = random.Random(9)
    rows = [r for conv, n in enumerate([1, 7, 90, 400, 61]) for r in chat(rng, conv, n)]
    rows += [r for r in chat(rng, None, 70, turns=[rng.choice([None, *range(40)]) for _ in range(70)])]
    check(spark, rows, shortest, segment_rows=8, fan=4)
    check(spark, rows, shortest)


def random_steps(rng, n):
    for _ in range(n):
        gone = rng.random() < 0.2
        yield (None, 0, rng.randint(1, 3)) if gone else (rng.choice(["s", "u", "a", "u", "a", "", "t"]), rng.randint(0, 1), 1)


def test_bounds_never_exceed_the_cost():
    rng = random.Random(1)
    for _ in range(300):
        steps = list(random_steps(rng, rng.randint(0, 12)))
        bounds = cr.suffix_bounds(steps)
        for i in range(len(steps) + 1):
            for q in range(4):
                assert bounds[i][q] <= cr.branch_and_bound(steps[i:], q)[0]


def test_loose_bounds_give_the_same_optimum():
    """Pruning and dominance alone are right, whatever the bounds are worth."""
    rng = random.Random(8)
    for _ in range(200):
        steps = list(random_steps(rng, rng.randint(0, 14)))
        for goals in ((0, 3), (1,), (2,)):
            entry = rng.randrange(4)
            tight = cr.suffix_bounds(steps, goals)
            loose = [[0 if b < float("inf") else b for b in row] for row in tight]
            assert cr.branch_and_bound(steps, entry, goals, loose) == cr.branch_and_bound(steps, entry, goals)


def test_long_search_ends_soon():
    rng = random.Random(2)
    began = time.time()
    for n in (500, 2000):
        cost, audit = cr.branch_and_bound([(rng.choice("ua"), rng.randint(0, 1), 1) for _ in range(n)])
        assert len(audit.replace("I", "")) == n
    assert time.time() - began < 10


@pytest.mark.parametrize("rows", [[], [(1, 1, "user", "x", "", 0)]])
def test_tiny_tables(spark, rows):
    check(spark, rows, enumerate_edits)


def test_conversation_without_rows_left(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    frame = spark.createDataFrame([(gone, 0, "user", "Hi.", "", 0)], SCHEMA)
    row = cr.repair_conversations(frame).first().asDict()
    assert row["audit"] == "" and row["repaired_sha256"] == hashlib.sha256().hexdigest()
    assert [row[k] for k in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] == [0] * 6


def test_repaired_rows_are_whole(spark):
    rows = list(chat(random.Random(4), 5, 40))
    solved, repaired = cr.repair(cr.damaged(spark.createDataFrame(rows, SCHEMA)), segment_rows=6, fan=4)
    got = [(r["role"], r["text"]) for r in repaired.orderBy("pos").collect()]
    rs = damage(rows)[5]
    assert got == shortest(rs, facts(rs)[1])[2]
    assert solved.count() == 1

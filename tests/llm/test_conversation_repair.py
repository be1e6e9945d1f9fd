import itertools
import random
import re
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from linefold.llm import conversation_repair as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
GRAMMAR = re.compile("(s?(ua)+)?")


def cheapest(rows):
    """Least (cost, edits) and the repaired lines, row by row over every
    pattern state; ``rows`` of (role, text, fault)."""
    def grow(states, then):
        for s in sorted(states, key=lambda s: states[s]):
            new = {"": "u", "s": "u", "u": "a", "a": "u"}[s]
            x = (states[s][0] + 2, states[s][1] + "I", [*states[s][2], ("user:", "assistant:")[new == "a"]])
            if new not in then or x < then[new]:
                then[new] = x
        return then

    def inserted(states):
        return grow(grow(states, dict(states)), dict(grow(states, dict(states))))

    states = {"": (0, "", [])}
    for role, text, fault in rows:
        states, after = inserted(states), {}
        for s, (cost, edits, lines) in states.items():
            want = {"": "u", "s": "u", "u": "a", "a": "u"}[s]
            name = {"u": "user", "a": "assistant"}[want]
            options = [(3, "D", s, [])]
            if fault not in ("blank", "duplicate"):
                late = int(fault == "truncated")
                if role[:1] == want or (s == "" and role[:1] == "s"):
                    options.append((late, "K", role[0], [f"{role}:{text}"]))
                options.append((2 + late, "R", want, [f"{name}:{text}"]))
            for c, e, to, line in options:
                x = (cost + c, edits + e, lines + line)
                if to not in after or x < after[to]:
                    after[to] = x
        states = after
    states = inserted(states)
    return min(states[s] for s in ("", "a") if s in states)


def by_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def brute(rows):
    """conv_id -> report of rows (conv_id, turn, role, text)."""
    groups = {}
    for c, t, r, x in rows:
        groups.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    out = {}
    for c, own in groups.items():
        own, seen, faults = by_order(own), set(), []
        for _, role, text in own:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
            seen.add((role, text))
        cost, audit, lines = cheapest([(r, x, f) for (_, r, x), f in zip(own, faults)])
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        out[c] = (*(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha256("\n".join(lines).encode()).hexdigest())
    return out


def some_rows(seed, convs, most=9):
    r = random.Random(seed)
    out = []
    for c in range(convs):
        for t in range(r.randrange(1, most)):
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            out.append((c if r.random() < 0.97 else None, r.choice([t, t, t, None, t + 1]), role, r.choice([f"Said {t}.", f"Said {t}", "Yes!", "", " \n", None, "é?\t"])))
    return out


def found(df):
    return {r["conv_id"]: tuple(r[c] for c in (*C.COUNTS, "audit", "repaired_sha256")) for r in C.report(C.repair(df)).collect()}


def test_equals_brute_force(spark):
    rows = some_rows(1, 300)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


def test_long_conversations_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", 8)
    rows = [(k % 2, t, r, x) for k in range(4) for _, t, r, x in some_rows(k, 40)]
    rows += [(5, t, "user" if t % 2 else "assistant", f"Turn {t}." if t % 7 else "cut") for t in range(600)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == brute(rows)


@pytest.mark.parametrize("seed", range(3))
def test_search_equals_plain_rows(seed):
    r = random.Random(seed)
    fault = {"x": "blank", "t": "truncated", ".": ""}
    for _ in range(300):
        codes = [r.choice("sua-") + r.choice("....tx") for _ in range(r.randrange(1, 12))]
        want = cheapest([({"s": "system", "u": "user", "a": "assistant", "-": "tool"}[a], "T.", fault[f]) for a, f in codes])
        assert C.meet("".join(codes), 0, C.ACCEPT, True) == want[:2]
        cuts = [0, *sorted(r.sample(range(1, len(codes)), min(len(codes) - 1, r.randrange(4)))), len(codes)]
        parts = ["".join(codes[a:b]) for a, b in itertools.pairwise(cuts)]
        solved = [C.solve(p, k == 0, k == len(parts) - 1) for k, p in enumerate(parts)]
        links = C.Links()
        for k in reversed(range(len(parts))):
            links.add(k, [x[:3] for x in solved[k]])
        assert "".join(solved[k][rank][3] for k, rank in links.taken()) == want[1]


def test_repaired_rows_read_by_the_pattern(spark):
    df = spark.createDataFrame(some_rows(9, 60), SCHEMA)
    by = {}
    for r in sorted(C.repair(df).collect(), key=lambda r: (r["at"], r["step"])):
        if r["edit"] != "D":
            by.setdefault(r["conv_id"], []).append(r)
    for rows in by.values():
        assert GRAMMAR.fullmatch("".join(r["role"][0] for r in rows))
        assert all((r["text"] == "") == (r["edit"] == "I") and r["fault"] not in ("blank", "duplicate") for r in rows)


def test_edges(spark):
    long = "word " * 400_000
    rows = [(1, 0, "user", long + "."), (1, 1, "assistant", long), (1, 1, "assistant", long), (2, None, None, None), (3, 5, "user", "A."), (3, 9, "assistant", "B."),
            (3, 9, "assistant", "B."), (-4, 0, "system", "Only."), (None, 1, "user", "Hi."), (None, 2, "assistant", "Ho.")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("z") for c in ("conv", "at", "step", "edit", "fault", "block", "rows", "h", "was")})
    got = found(df)
    assert got == brute(rows) and got[1][5] == "KKD" and got[3][5] == "KKD" and got[None][5] == "KK" and got[-4][5] == "D"
    assert {r["conv_id"]: r["gaps"] for r in C.gaps(df).collect()} == {1: 0, 2: 0, 3: 3, -4: 0, None: 0}
    none = spark.createDataFrame([], SCHEMA)
    assert C.repair(none).count() == 0 and C.report(C.repair(none)).count() == 0 and C.gaps(none).count() == 0


def test_damage(spark):
    rows = [(c, t, "assistant", f"Ab. c! {t}?") for c in range(40) for t in range(3)] + [(None, None, None, None), (7, None, "user", "x.")]
    want = []
    for c, t, r, x in rows:
        deal = crc32(":".join(" " if v is None else str(v) for v in (c, t)).encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        row = (c, t, "user" if deal == 4 else r, "" if deal == 1 else re.sub("[.!?]", "", x) if deal == 2 else x)
        want += [row] * (0 if deal == 0 else 2 if deal == 3 else 1)
    assert sorted(map(tuple, C.damaged(spark.createDataFrame(rows, SCHEMA)).collect()), key=str) == sorted(want, key=str)

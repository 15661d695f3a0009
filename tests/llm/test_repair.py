import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from codeloom.llm import grammar, repair
from codeloom.llm.ropes import Ropes
from tests.llm.support import duck_rows, plain_rows

SCHEMA = "conv_id long, turn long, role string, text string"
CLASHING = SCHEMA + ", n string, symbol string, audit string, act string, trimmed string"
COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
SPACE = " \t\n\x0b\x0c\r"
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """Every edit of every row, state by state, with whole strings: (role, text, must go, cut off) in, cost, audit, rows out."""
    def inserted(states):
        for _ in range(3):
            for state, (cost, audit, out) in list(states.items()):
                for role in "ua":
                    if (state, role) in NEXT:
                        offer(states, NEXT[state, role], (cost + 5, audit + "I", out + [(NAMES[role], "")]))
        return states

    def offer(states, state, found):
        if state not in states or found[:2] < states[state][:2]:
            states[state] = found

    now = inserted({0: (0, "", [])})
    for role, text, must_go, cut in rows:
        then = {}
        for state, (cost, audit, out) in now.items():
            offer(then, state, (cost + 2, audit + "D", out))
            if not must_go:
                more = 5 if cut else 0
                if (state, role[:1]) in NEXT:
                    offer(then, NEXT[state, role[:1]], (cost + more, audit + "K", out + [(role, text)]))
                for given in "ua":
                    if (state, given) in NEXT:
                        offer(then, NEXT[state, given], (cost + more + 1, audit + "R", out + [(NAMES[given], text)]))
        now = inserted(then)
    return min((now[s] for s in (0, 3) if s in now), key=lambda x: x[:2])


def brute(rows, damage=True):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = []
    for conv in {r[0] for r in rows}:
        live = []
        for c, t, r, x in rows:
            if c != conv:
                continue
            act = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20 if damage else 9
            if act == 1:
                x = ""
            if act == 2:
                x = "".join(ch for ch in x if ch not in ".!?")
            if act == 4:
                r = "user"
            live += [(t, r, x)] * (0 if act == 0 else 2 if act == 3 else 1)
        live.sort(key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), v[2].encode()))
        seen, states, counts = set(), [], [0, 0, 0]
        for _, r, x in live:
            kind = 0 if not x.strip(SPACE) else 1 if (r, x) in seen else 2 if x.strip(SPACE)[-1] not in ".!?" else None
            seen.add((r, x))
            if kind is not None:
                counts[kind] += 1
            states.append((r, x, kind in (0, 1), kind == 2))
        turns = [t for t, _, _ in live if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in live]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        cost, audit, fixed = cheapest(states)
        text = "\n".join(f"{r}:{x}" for r, x in fixed)
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, convs=60):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "aide"]
    texts = ["Yes.", "no", "Why?", "", " \n", None, "Go!", "cut off", "x" * 30_000 + ".", "dots . . \t"]
    rows = []
    for c in range(convs):
        for t in range(rng.choice([1, 2, 3, 6, 12, 40])):
            turn = rng.choice([t, t, t, t, t + 1, None])
            rows.append((rng.choice([c, c, c, c, None]), turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", range(2))
def test_damaged_rows_against_plain_search(spark, seed):
    rows = random_rows(seed)
    table = spark.createDataFrame([(*r, "n", "s", "a", "x", "t") for r in rows], CLASHING)
    got = plain_rows(repair.digests(*repair.repairs(repair.damaged(table))), *COLUMNS)
    assert got == brute(rows)


def test_repaired_rows_have_legal_roles(spark):
    rows = random_rows(7, 20)
    audits, numbered = repair.repairs(spark.createDataFrame(rows, SCHEMA))
    fixed = {}
    for r in sorted(repair.repaired(audits, numbered).collect(), key=lambda r: (str(r.conv_id), r.turn)):
        fixed.setdefault(r.conv_id, []).append((r.role, r.text))
    digests = {c: hashlib.sha256("\n".join(f"{r}:{x}" for r, x in v).encode()).hexdigest() for c, v in fixed.items()}
    empty = hashlib.sha256(b"").hexdigest()
    assert all(digests.get(r[0], empty) == r[-1] for r in brute(rows, damage=False))
    for turns in fixed.values():
        roles = "".join(r[0] for r, _ in turns).removeprefix("s")
        assert roles and roles == "ua" * (len(roles) // 2)


def test_all_short_sequences_with_and_without_rules():
    plain, ruled = repair.Solver([]), repair.Solver(["ua", "us", grammar.rule_symbol(0) * 2, "Ud"])
    for n in range(5):
        for symbols in itertools.product("suxUd", repeat=n):
            rows = [({"s": "s", "u": "u", "a": "a", "x": "t"}.get(c.lower(), "u"), "", c == "d", c.isupper()) for c in symbols]
            want = cheapest(rows)[:2]
            text = "".join(symbols)
            short = text
            for k, pair in enumerate(["ua", "us", grammar.rule_symbol(0) * 2, "Ud"]):
                short = short.replace(pair, grammar.rule_symbol(k))
            assert plain.solve(text) == want == ruled.solve(short), text


def test_very_long_conversation(spark):
    turns = [(1, i, ["user", "assistant", "assistant", "user"][i % 4], f"{i}.") for i in range(3000)]
    got = plain_rows(repair.digests(*repair.repairs(spark.createDataFrame(turns, SCHEMA))), *COLUMNS)
    assert got == brute(turns, damage=False)


def test_rules_shorten_and_rebuild(spark):
    strings = ["uauauaua", "suaua", "uu", "", "u", "sUaSuauauauauaua"] * 3
    frame = spark.createDataFrame([(s, 1) for s in strings], "s string, w long")
    rules = grammar.repair_rules(frame, "s", "w")
    short = [r.c for r in frame.select(grammar.compressed(F.col("s"), rules).alias("c")).collect()]

    def whole(text):
        for n in reversed(range(len(rules))):
            text = text.replace(grammar.rule_symbol(n), rules[n])
        return text

    assert rules and [whole(s) for s in short] == strings
    assert sum(map(len, short)) < sum(map(len, strings)) / 2


def test_ropes_compare_as_strings():
    rng = random.Random(2)
    ropes = Ropes()
    letters = [ropes.leaf(c) for c in "DIKR"]
    nodes = [0, *letters]
    for _ in range(60):
        nodes.append(ropes.join(rng.choice(nodes), rng.choice(nodes)))
        nodes = [x for x in nodes if ropes.size[x] < 3000]
    for a in nodes:
        for b in nodes:
            assert ropes.less(a, b) == (ropes.text(a) < ropes.text(b))


def test_empty_table(spark):
    assert repair.digests(*repair.repairs(repair.damaged(spark.createDataFrame([], SCHEMA)))).collect() == []


def test_query_against_sql_and_plain_search(spark, sf):
    got = plain_rows(repair.query(spark, sf), *COLUMNS)
    assert got == duck_rows(repair.SQL, sf, list(COLUMNS))
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got == brute(rows)

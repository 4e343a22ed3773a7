"""Conversation repair against a plain dynamic program over whole rows, and against all edits of short conversations."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from docspark.llm import conversation_repair as cr
from docspark.llm import pair_grammar as pg

SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit int"
NEXT = {0: 2, 1: 2, 3: 2, 2: 3}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def repaired(rows):
    """The cheapest edits by a table over rows and states: (cost, audit, lines) in that order."""
    best = {0: (0, "", [])}

    def inserts(best):
        best = dict(best)
        for _ in range(4):
            for s, (c, a, t) in list(best.items()):
                new = (c + 2, a + "I", [*t, "assistant:" if s == 2 else "user:"])
                best[NEXT[s]] = min(best.get(NEXT[s], new), new)
        return best

    for (_, _, role, text), fault in zip(rows, faults(rows), strict=True):
        after = {}

        def offer(s, way):
            after[s] = min(after.get(s, way), way)

        for s, (c, a, t) in inserts(best).items():
            offer(s, (c + 3, a + "D", t))
            if fault in ("blank", "duplicate"):
                continue
            extra = fault == "truncated"
            offer(NEXT[s], (c + 2 + extra, a + "R", [*t, f"{'assistant' if s == 2 else 'user'}:{text}"]))
            to = {"s": 1 if s == 0 else None, "u": 2 if s != 2 else None, "a": 3 if s == 2 else None}.get(role[:1])
            if to:
                offer(to, (c + extra, a + "K", [*t, f"{role}:{text}"]))
        best = after
    return min(way for s, way in inserts(best).items() if s in (0, 3))


def expected(rows):
    out = {}
    after = damaged(rows)
    for conv in {r[0] for r in rows}:
        own = sorted([r for r in after if r[0] == conv], key=lambda r: (r[1] is not None, r[1] or 0))
        f = faults(own)
        turns = {r[1] for r in own if r[1] is not None}
        roles = [r[2][:1] for r in own]
        cost, audit, lines = repaired(own)
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(roles))
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(5)
    out = cr.damaged_repair(docs)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len({r[0] for r in got})
    return {r[0]: r[1:] for r in got}


def talk(seed, conv, turns):
    r = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, ""]
    texts = ["Yes.", "No", "Why?\n ", "", " \t", None, "Été!", "no.", "Fine…"]
    return [(conv, r.choice([t, t, t, t + 1, None]), r.choice(roles[: r.choice([2, 3, 8])]), f"{r.choice(texts) or ''}" if r.random() < 0.4 else f"Number {r.randint(0, 9 * turns)}.") for t in range(turns)]


def distinct_turns(rows):
    """Rows of one turn and conversation are alike: their order is not fixed otherwise."""
    seen = {}
    for r in rows:
        seen.setdefault(r[:2], r)
    return list(seen.values())


def test_against_plain_program(spark):
    rows = [x for k in range(300) for x in distinct_turns(talk(k, k, k % 9 + 1))]
    rows += distinct_turns(talk(7, 1000, 2500)) + distinct_turns(talk(8, None, 30)) + [(2000, 0, None, None), (2001, None, "user", "Hi.")]
    assert found(spark, rows) == expected(rows)


def test_equal_rows_across_blocks(spark):
    rows = [(1, 5, "user", "Same.")] * 3000 + [(2, None, "assistant", "A")] * 5
    assert found(spark, rows) == expected(rows)


def test_dropped_and_empty(spark):
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert found(spark, []) == {}


def test_least_of_all_edits():
    """The plain program itself, over every edit sequence of short conversations."""
    for seed in range(60):
        rows = damaged(distinct_turns(talk(seed, seed, 3)))
        f = faults(rows)
        ways = []
        for signs in itertools.product("DKR", repeat=len(rows)):
            for ins in itertools.product(range(4), repeat=len(rows) + 1):
                state, cost, ok, audit = 0, 0, True, ""
                for k in range(len(rows) + 1):
                    for _ in range(ins[k]):
                        state, cost, audit = NEXT[state], cost + 2, audit + "I"
                    if k == len(rows):
                        break
                    audit += signs[k]
                    if signs[k] == "D":
                        cost += 3
                        continue
                    ok &= f[k] in ("", "truncated")
                    cost += f[k] == "truncated"
                    if signs[k] == "R":
                        state, cost = NEXT[state], cost + 2
                    else:
                        at = "?sua".find(rows[k][2][:1] or "-")
                        ok &= (at == 1 and state == 0) or (at == 2 and state != 2) or (at == 3 and state == 2)
                        state = at if ok else state
                if ok and state in (0, 3):
                    ways.append((cost, audit))
        assert min(ways) == repaired(rows)[:2]


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_grammar_keeps_sequences_and_matrices(rounds):
    r = random.Random(rounds)
    seqs = ["".join(r.choice("aabei") for _ in range(r.randint(1, 60))) for _ in range(50)]
    g = pg.Grammar(cr.SYMBOLS + 1)
    x = pg.symbols_of(pa.array(seqs))
    for _ in range(rounds):
        keys, counts = pg._pairs(pg.compress(x, g))
        pair, n = np.unique(keys[counts], return_counts=True)
        g.rounds.append(pg._apart([(int(p) >> 20, int(p) & (2**20 - 1)) for p in pair[np.argsort(-n, kind="stable")][:5]]))

    def spell(s):
        return chr(96 + s) if s < g.base else "".join(map(spell, g.rules[s - g.base]))

    assert "".join(spell(s) for s in pg.compress(x, g).tolist()) == "".join(s + "`" for s in seqs)
    assert rounds == 0 or len(pg.compress(x, g)) < len(x)
    t = pg.evaluate(g, *cr.letter_matrices())
    for s, (a, b) in enumerate(g.rules, g.base):
        for i, j in itertools.product(range(4), repeat=2):
            ways = [(int(t.cost[a, i, k] + t.cost[b, k, j]), pg.rope_text(t, a, i, k) + pg.rope_text(t, b, k, j)) for k in range(4) if t.cost[a, i, k] + t.cost[b, k, j] < pg.NEVER]
            assert ([] if t.cost[s, i, j] >= pg.NEVER else [(int(t.cost[s, i, j]), pg.rope_text(t, s, i, j))]) == sorted(ways)[:1]

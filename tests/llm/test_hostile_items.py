"""Benchmark items against texts of long runs and repeats."""

import random
import time

import numpy as np

from docspark.llm import decontamination as dc


def sellers(pattern, text):
    """Fewest edits between the pattern and a part of the text, and the smallest end of such a part."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        new = [i]
        for j, t in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (p != t)))
        row = new
    return min((e, j) for j, e in enumerate(row))


def found(texts, patterns):
    items = dc.Items.of(list(range(len(patterns))), patterns, dc.Q, dc.RATE)
    best = {}
    for t, i, edits, end in dc.found_in(texts, items, dc.Q):
        best[t, i] = min(best.get((t, i), (edits, end)), (edits, end))
    return best, items


def check(texts, patterns):
    got, items = found(texts, patterns)
    want = {(t, i): sellers(p, x) for t, x in enumerate(texts) for i, p in enumerate(patterns)}
    want = {key: (e, end) for key, (e, end) in want.items() if e <= items.edits[key[1]]}
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()}
    return got, want


def test_runs_and_periods_against_all_alignments(monkeypatch):
    r = random.Random(2)
    units = ["-", "ab", "=-", "word and ", "0123456789"]
    patterns = [u * (60 // len(u)) for u in units] + ["-" * 30 + "a line of text between rulers" + "-" * 30, "plain words that are not repeated in any way here"]
    patterns += ["".join(r.choice("ab") for _ in range(50)) for _ in range(4)]
    texts = []
    for p in patterns:
        cut = list(p)
        for _ in range(r.randint(0, 7)):
            cut[r.randrange(len(cut))] = r.choice(["", "x", "ab"])
        texts += ["start " + "".join(cut) + " end", p[: len(p) // 2], p * 3, r.choice(units) * 20 + "".join(cut) + r.choice(units) * 9]
    got, want = check(texts, patterns)
    assert len(want) > 20
    monkeypatch.setattr(dc, "HITS", 50)  # items in many groups
    assert check(texts, patterns)[0] == got


def test_rulers_of_a_megabyte_end_soon():
    patterns = ["-" * 60, "a question and its answer " + "=" * 80] + [f"{k} " + "-" * 50 + " item" for k in range(30)]
    start = time.perf_counter()
    got, _ = found(["-" * 1_000_000, "=" * 300_000 + " a question and its answer " + "=" * 81], patterns)
    assert time.perf_counter() - start < 60
    assert got[0, 0][0] == 0 and got[1, 1][0] == 0


def test_items_longer_than_a_million():
    r = np.random.default_rng(1)
    long = "".join(map(chr, r.integers(97, 123, 1_200_000)))
    got, _ = found(["x" + long + "y", "short"], [long])
    assert got == {(0, 0): (0, len(long) + 1)}

"""Quality rules against plain loops over words, lines and tokens."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from docspark.llm import quality_rules as qr
from docspark.llm.sampling import rows_with

SCHEMA = "doc_id long, text string, ratio string, kept int, id long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    n = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if n[w] > 1 for j in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def tokens(text):
    return re.findall(r"[0-9A-Za-z_\x80-\U0010ffff]+|[^0-9A-Za-z_\x80-\U0010ffff\x20\x09-\x0D]+", text or "")


def bucket(gram):
    return int(qr.hashed_grams(pa.array([gram]))[0][-1])


def grams(text):
    t = tokens(text)
    return [bucket(x) for x in t] + [bucket(f"{a} {b}") for a, b in zip(t, t[1:], strict=False)]


def texts():
    r = random.Random(4)
    some = ["", None, " \n\t ", "one", "a a a a a a", "a\n\na\n a\na", "x y z\nx y z\nx y z", "Ünïcode wörds… hier and there", "\x00\x01 \x1f odd", "**!!## <a|b> & $5 %", "a b c d e f a b c d e"]
    some += [" ".join(r.choice(["alpha", "beta", "Gamma", "delta|", "!!", "ö", "\n"]) for _ in range(r.randint(1, 80))) for _ in range(150)]
    some.append(" ".join(f"w{r.randint(0, 500)}" for _ in range(30_000)))
    return some


def test_measures_against_loops():
    t = texts()
    got = qr.measures(pa.array(t))
    assert list(zip(*[got[c].tolist() for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], strict=True)) == [plain(x) for x in t]
    assert {len(v) for v in qr.measures(pa.array([None, ""], pa.string())).values()} == {2}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text("ab \n\t|é#", max_size=40)), min_size=1, max_size=6))
def test_measures_of_any_text(t):
    got = qr.measures(pa.array(t, pa.string()))
    assert [tuple(int(got[c][k]) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) for k in range(len(t))] == [plain(x) for x in t]


def test_verdicts_against_loops(spark):
    t = texts()
    rows = [(k if k % 7 else None, x, "r", 1, k) for k, x in enumerate(t)] + [(3, t[3], "r", 1, 0)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    trusted = rows_with(docs, spark.createDataFrame([(k,) for k in range(20, 60)] + [(None,), (20,)], "doc_id long"), "doc_id")
    assert trusted.count() == len([k for k in range(20, 60) if k % 7])
    wide = rows_with(docs, spark.createDataFrame([(k,) for k in range(20, 60)], "doc_id long"), "doc_id", most=3)
    assert wide.count() == trusted.count()
    p, q = Counter(), Counter()
    for k, x, *_ in rows:
        q.update(grams(x))
        if k is not None and 20 <= k < 60:
            p.update(grams(x))
    logs = {b: math.log((p[b] + 1) / (p.total() + qr.BUCKETS)) - math.log((q[b] + 1) / (q.total() + qr.BUCKETS)) for b in q}
    ratios = [sum(logs[b] for b in g) / len(g) if g else 0.0 for g in (grams(x) for _, x, *_ in rows)]
    good = sorted(r for r, (_, x, *_) in zip(ratios, rows, strict=True) if plain(x)[0] >= 10 and plain(x)[4] * 5 <= plain(x)[0])
    least = (good[len(good) // 2 - 1] + good[len(good) // 2]) / 2
    out = qr.judge(docs, qr.learn_ratios(docs, trusted), least=least)
    assert out.columns == ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "ratio", "base_failed", "kept"]
    want = []
    for (k, x, *_), ratio in zip(rows, ratios, strict=True):
        m = plain(x)
        failed = m[0] < 10 or 100 * m[4] > 20 * m[0]
        want.append((k, *m, round(ratio, 9), failed, not failed and ratio >= least))
    got = [(*tuple(r)[:6], round(r.ratio, 9), r.base_failed, r.kept) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len({r[-1] for r in want}) == 2


def test_nothing_to_learn_from(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert qr.judge(none, qr.learn_ratios(none, none)).count() == 0
    docs = spark.createDataFrame([(1, " ".join(f"word{k}" for k in range(20)), "r", 1, 1), (2, None, None, None, None)], SCHEMA)
    ratios = qr.learn_ratios(docs, none)
    assert not np.any(ratios.logs)
    assert {r.doc_id: (r.kept, r.ratio) for r in qr.judge(docs, ratios).collect()} == {1: (True, 0.0), 2: (False, 0.0)}

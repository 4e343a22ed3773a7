"""Ids with several texts in the n-gram join, groups larger than one comparison takes, and pairs that repeat."""

import random

import pytest

from docspark.llm import ngram_join

SCHEMA = "doc_id long, text string"


def text(seed, words=40):
    r = random.Random(seed)
    return " ".join(f"w{r.randint(0, 10**6)}" for _ in range(words))


def components(spark, rows, **kw):
    out = ngram_join.jaccard_components(spark.createDataFrame(rows, SCHEMA).repartition(3), **kw).collect()
    return {r.doc_id: r.component_id for r in out}


@pytest.mark.parametrize("n", [3, 5])
def test_an_id_ties_all_its_texts(spark, n):
    t = [text(k) for k in range(n)]
    rows = [(k + 1, x) for k, x in enumerate(t)] + [(40, x) for x in t] + [(50, text(99))]
    assert components(spark, rows) == {**{k + 1: 1 for k in range(n)}, 40: 1, 50: 50}


def test_a_crowd_around_one_text(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "GROUP", 4)
    base = text(7, 200).split()
    rows = [(0, " ".join(base))]
    for k in range(1, 40):
        edited = list(base)
        edited[5 * k] = f"x{k}"
        rows.append((k, " ".join(edited)))
    rows += [(100 + k, text(1000 + k, 200)) for k in range(20)]
    found = components(spark, rows)
    assert {found[k] for k in range(40)} == {0}
    assert all(found[100 + k] == 100 + k for k in range(20))

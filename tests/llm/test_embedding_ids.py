"""Embeddings: ids with several vectors, text ids, and the plan of tables."""

import math

import numpy as np

from docspark.llm import embedding_dedup

SCHEMA = "vec_id long, embedding array<double>, label int"


def test_an_id_with_two_vectors_ties_nothing(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    near_a, near_b = [1.0, 0.05, 0.0, 0.0], [0.0, 1.0, 0.05, 0.0]
    rows = [(1, a, 1), (5, near_a, 1), (5, b, 1), (6, near_b, 1), (7, b, 1), (7, b, 1)]
    got = sorted(tuple(r) for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA)).collect())
    # 5 and 7 are copies of b, 6 is near them
    assert got == sorted([(1, 1, 1, True), (5, 1, 1, False), (5, 2, 5, True), (6, 2, 5, False), (7, 2, 5, False), (7, 2, 5, False)])


def test_text_ids(spark):
    rows = [("x", [1.0, 0.0], 1), ("b", [1.0, 0.01], 1), ("c", [0.0, 1.0], 1)]
    got = sorted(tuple(r) for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA.replace("vec_id long", "vec_id string"))).collect())
    assert got == [("b", 1, "b", True), ("c", 0, "c", True), ("x", 1, "b", False)]


def test_plan_keeps_recall():
    for rows in (0, 1, 10**6, 10**8, 10**11):
        bits, tables = embedding_dedup.table_plan(rows, 0.98)
        assert (1 - (1 - math.acos(0.98) / math.pi) ** bits) ** tables <= embedding_dedup.MISS
        assert rows / 2**bits <= embedding_dedup.SPREAD
    assert embedding_dedup.table_plan(10**6, 0.98) == (16, 24)


def test_recall_against_all_pairs(spark):
    """Pairs right above the threshold, by the plan for a thousand million rows."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 24))
    side = rng.standard_normal((300, 24))
    side -= base * ((side * base).sum(1) / (base * base).sum(1))[:, None]
    side *= (np.linalg.norm(base, axis=1) / np.linalg.norm(side, axis=1) * math.tan(math.acos(0.9802)))[:, None]
    rows = [(2 * k + j, v.tolist(), k % 2) for k in range(300) for j, v in enumerate((base[k], base[k] + side[k]))]
    x, y = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    linked = (unit @ unit.T >= 0.98) & (y[:, None] == y)
    bits, tables = embedding_dedup.table_plan(10**9, 0.98)
    got = {r.vec_id: r.n_links for r in embedding_dedup.link_vectors(spark.createDataFrame(rows, SCHEMA), bits=bits, tables=tables).collect()}
    want = {k: int(linked[k].sum()) - 1 for k in range(600)}
    assert sum(want.values()) >= 600 and got == want

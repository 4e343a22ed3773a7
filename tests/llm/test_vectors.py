"""Vector codes against plain integer loops."""

import math
import random

import numpy as np
import pytest

from docspark.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, code int"


def plain(rows, parts, entries, rounds):
    kept = [(i, [math.floor(256 * np.float64(np.float32(x))) for x in v], y) for i, v, y in rows if v and len(v) % parts == 0 and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1]) // parts
    kept = [r for r in kept if len(r[1]) == width * parts]
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        groups = [[[] for _ in b] for b in books]
        for c in cut:
            for p in range(parts):
                groups[p][near(c[p], books[p])[1]].append(c[p])
        books = [[[sum(x) // len(x) for x in zip(*g, strict=True)] if g else e for g, e in zip(gs, b, strict=True)] for gs, b in zip(groups, books, strict=True)]
    found = [[near(c[p], books[p]) for p in range(parts)] for c in cut]
    errors = [sum(d for d, _ in f) for f in found]
    by_label = {}
    for (_, _, y), e in zip(kept, errors, strict=True):
        by_label[y] = by_label.get(y, 0) + e
    return [(r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[2]]) for r, f, e in zip(kept, found, errors, strict=True)], books


def vectors(seed, n, dims, step):
    r = random.Random(seed)
    return [(r.randint(0, 3 * n) if k % 9 else k, [r.randint(-6, 6) * step if k % 3 else r.gauss(0, 0.4) for _ in range(dims)], r.choice([None, 1, 1, 1, 2])) for k in range(n)]


ODD = [(5, None, 1), (6, [], 1), (7, [math.nan] * 8, 1), (8, [None] + [0.5] * 7, 2), (9, [math.inf] * 8, 2), (10, [0.5] * 7, 2), (11, [0.25] * 16, 2), (None, [0.25] * 8, None), (12, [0.0] * 8, 3), (12, [0.0] * 8, 3), (13, [1e30] * 8, 3)]


@pytest.mark.parametrize(("n", "entries", "rounds"), [(400, 16, 2), (9, 64, 2), (60, 5, 0)])
def test_against_loops(spark, n, entries, rounds):
    rows = vectors(n, n, 8, 0.125) + ODD
    docs = spark.createDataFrame([(*r, 1, "v", 2) for r in rows], SCHEMA).repartition(4)
    out, books = vc.compress_vectors(docs, parts=2, entries=entries, rounds=rounds)
    assert out.columns == ["vec_id", "code", "error", "label_error", "evaluations"]
    want, wanted_books = plain([r for r in rows if r[0] != 13], 2, entries, rounds)
    got = [tuple(r) for r in out.collect()]
    assert sorted((r[:4] for r in got), key=repr) == sorted(want, key=repr)
    assert books.tolist() == wanted_books
    if n == 400:
        assert sum(r[4] for r in got) < 0.8 * len(got) * 2 * entries  # the bounds rule out entries


def test_ties_go_to_the_lower_index():
    entries = np.array([[4, 0], [0, 4], [-4, 0], [0, -4], [4, 0]])
    points = np.array([[0, 0], [4, 0], [2, 2], [10**8, 10**8]])
    pivots = vc.pivots_of(entries, 3)
    at, d, tried = vc.nearest_entries(points, vc.distances(points, pivots).astype(np.float32), entries, pivots)
    assert at.tolist() == [0, 0, 0, 0] and d.tolist() == [16, 0, 8, (10**8 - 4) ** 2 + 10**16]
    assert (tried <= len(entries)).all()


def test_empty_and_decode(spark):
    out, books = vc.compress_vectors(spark.createDataFrame([], SCHEMA))
    assert out.columns == ["vec_id", "code", "error", "label_error", "evaluations"] and out.count() == 0
    out, _ = vc.compress_vectors(spark.createDataFrame([(1, None, 1, 1, "v", 1)], SCHEMA))
    assert out.count() == 0
    one, books = vc.compress_vectors(spark.createDataFrame([(1, [0.5] * 16, 1, 1, "v", 1)], SCHEMA))
    r = one.first()
    assert r.code == "00" * 16 and r.error == 0
    assert all(abs(x - 0.5) < 1 / 256 for x in vc.decode(r.code, books))

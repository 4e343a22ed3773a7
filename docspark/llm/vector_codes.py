"""Vectors as codes of their parts' nearest codebook entries, found by pivot distances, exact in integers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.arrays import larger
from docspark.session import materialize

#: Parts of a vector, entries of a part's codebook, rounds of training, fixed pivots of a part.
PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
SCALE = 256
#: Rows worked on at once.
ROWS = 8192
#: Distances to pivots are kept in 32 bits; a lower bound is made smaller by this share of the distances it comes from.
_SLACK = 1e-6


def whole_vectors(rows: DataFrame, id: str, vector: str, label: str, parts: int = PARTS) -> DataFrame:
    """Rows (id, label, v) with components floor(SCALE * x): those whose vector has only finite components and can be cut into ``parts`` equal parts."""
    v = F.col(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) != float("inf")))
    kept = rows.select(F.col(id).alias("id"), F.col(label).alias("label"), v.alias("v")).filter(v.isNotNull() & (F.size(v) > 0) & (F.size(v) % parts == 0) & finite)
    return kept.withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * SCALE)))


def pivots_of(entries: np.ndarray, count: int = PIVOTS) -> np.ndarray:
    """``count`` of the entries, each the farthest from those before it (ties to the lower index), beginning with the first."""
    chosen = [0]
    nearest = ((entries - entries[0]) ** 2).sum(1)
    while len(chosen) < min(count, len(entries)):
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((entries - entries[chosen[-1]]) ** 2).sum(1))
    return entries[chosen]


def distances(points: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Euclidean distances, one row per point and one column per pivot."""
    return np.sqrt(((points[:, None, :] - pivots[None, :, :]) ** 2).sum(2).astype(np.float64))


def nearest_entries(points: np.ndarray, far: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index and squared distance of each point's nearest entry (ties to the lower index), and how many distances were worked out.

    ``far``: the points' distances to the pivots. The difference of a point's and an entry's distance to
    a pivot is a lower bound of their own. Entries are tried in the order of their largest bounds, until
    the bound is beyond the nearest one found.
    """
    reach = distances(entries, pivots)
    bound = np.zeros((len(points), len(entries)))
    for k in range(len(pivots)):
        a, b = far[:, k].astype(np.float64)[:, None], reach[:, k][None, :]
        np.maximum(bound, np.abs(a - b) - _SLACK * (a + b), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    bound = np.take_along_axis(bound, order, 1) ** 2
    best = np.full(len(points), np.iinfo(np.int64).max)
    at = np.zeros(len(points), np.int64)
    tried = np.zeros(len(points), np.int64)
    alive = np.arange(len(points))
    for r in range(len(entries)):
        alive = alive[bound[alive, r] <= best[alive]]
        if not len(alive):
            break
        e = order[alive, r]
        d = ((points[alive] - entries[e]) ** 2).sum(1)
        tried[alive] += 1
        nearer = (d < best[alive]) | ((d == best[alive]) & (e < at[alive]))
        hit = alive[nearer]
        best[hit], at[hit] = d[nearer], e[nearer]
    return at, best, tried


def _lists(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False).reshape(len(column), width)


def _cut(v: np.ndarray, parts: int) -> np.ndarray:
    """(rows, parts, components of a part)"""
    return v.reshape(len(v), parts, -1)


def compress_vectors(
    rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, np.ndarray]:
    """Rows (id, code, error, label_error, evaluations), one per kept row of ``rows``, and the codebooks (part, entry, component).

    A row is kept if its vector is not null and has only finite components. Its components become
    floor(256 * x), cut into ``parts`` parts. A part's codebook begins as that part of the ``entries``
    smallest ids (nulls last, equal ids by vector; fewer rows make fewer entries); each of ``rounds`` rounds
    assigns all parts of all rows to their nearest entries, ties to the lower index, and moves each entry to
    the floor of the mean of its parts; entries without parts stay. code has two hex digits per part, error the sum of
    squared distances, label_error its sum over all rows of the label, null being one label; evaluations
    counts the distances that the bounds did not rule out, of ``parts * entries``.

    Distances of all parts to fixed pivots are worked out once and written with the rows. A round reads that table, broadcasts
    the codebooks (of fixed size) and brings one sum per component of an entry to the driver.
    Vectors that are empty, cannot be cut into equal parts, differ in length from that of the smallest
    id, or whose squared distances could exceed 63 bits (components of 2 million and more for 64 dimensions) are left out too. Repeated rows count each. An empty
    table gives an empty result. Other columns are not read.
    """
    spark = rows.sparkSession
    whole = whole_vectors(rows, id, vector, label, parts)
    kind = rows.schema[id].dataType.simpleString()
    schema = f"id {kind}, label {rows.schema[label].dataType.simpleString()}"
    order = [F.col("id").asc_nulls_last(), "v"]
    first = whole.orderBy(*order).limit(1).collect()
    if not first:
        none = spark.createDataFrame([], f"{schema}, code string, error long, label_error long, evaluations int").drop("label")
        return none.withColumnRenamed("id", id), np.zeros((parts, 0, 0), np.int64)
    width = len(first[0]["v"])
    limit = int((2**60 / width) ** 0.5)
    whole = whole.filter((F.size("v") == width) & (F.array_max("v") < limit) & (F.array_min("v") >= -limit))
    heads = [r["v"] for r in whole.orderBy(*order).limit(entries).collect()]  # a row per entry
    books = np.array(heads, np.int64).reshape(len(heads), parts, -1).swapaxes(0, 1)
    pivots = [pivots_of(b) for b in books] if len(heads) else []
    count = len(pivots[0]) if pivots else 0

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in larger(batches, ROWS):
            v = _cut(_lists(batch.column("v"), width, np.int64), parts)
            far = np.stack([distances(v[:, p], pivots[p]) for p in range(parts)], 1).astype(np.float32)
            listed = pa.ListArray.from_arrays(pa.array(np.arange(0, far.size + 1, parts * count, dtype=np.int32)), pa.array(far.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("label"), batch.column("v").cast(pa.list_(pa.int32())), listed], ["id", "label", "v", "far"])

    table = materialize(whole.mapInArrow(measure, f"{schema}, v array<int>, far array<float>"), "measured")

    def assigned(batches: Iterator[pa.RecordBatch], books: np.ndarray) -> Iterator[tuple]:
        for batch in larger(batches, ROWS):
            v = _cut(_lists(batch.column("v"), width, np.int64), parts)
            far = _lists(batch.column("far"), parts * count, np.float32).reshape(len(v), parts, count)
            yield batch, v, [nearest_entries(v[:, p], far[:, p], books[p], pivots[p]) for p in range(parts)]

    for _ in range(rounds):
        books = _moved(table, assigned, books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.frombuffer("".join(f"{k:02x}" for k in range(256)).encode(), "S2")
        for batch, _, found in assigned(batches, books):
            code = digits[np.stack([f[0] for f in found], 1)]
            text = np.frombuffer(code.tobytes(), f"S{2 * parts}").astype(str)
            error, tried = (sum(f[k] for f in found) for k in (1, 2))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(text, pa.string()), pa.array(error, pa.int64()), pa.array(tried, pa.int32())],
                ["id", "label", "code", "error", "evaluations"],
            )

    codes = materialize(table.mapInArrow(encode, f"{schema}, code string, error long, evaluations int"), "codes")
    # one row per label, of a size that Spark knows before it picks the join
    sums = materialize(codes.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    out = codes.join(sums, F.col("label").eqNullSafe(F.col("of"))).select(F.col("id").alias(id), "code", "error", "label_error", "evaluations")
    return out, books


def _moved(table: DataFrame, assigned, books: np.ndarray) -> np.ndarray:
    """The codebooks with every entry at the floor of the mean of its parts."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)  # the last column counts
        for _, v, found in assigned(batches, books):
            for p in range(parts):
                np.add.at(total[p, :, :width], found[p][0], v[:, p])
                total[p, :, width] += np.bincount(found[p][0], minlength=entries)
        at = np.flatnonzero(total[:, :, width].ravel().repeat(width + 1))
        yield pa.RecordBatch.from_pydict({"at": at, "total": total.ravel()[at]})

    sums = table.mapInArrow(run, "at long, total long").groupBy("at").agg(F.sum("total").alias("total")).collect()
    total = np.zeros(parts * entries * (width + 1), np.int64)
    for r in sums:
        total[r["at"]] = r["total"]
    total = total.reshape(parts, entries, width + 1)
    counts = total[:, :, width:]
    return np.where(counts > 0, total[:, :, :width] // np.maximum(counts, 1), books)


def books_digest(books: np.ndarray) -> str:
    """Hex SHA-256 of all components by part, entry and place, as decimals joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decode(code: str, books: np.ndarray) -> list[float]:
    """The vector that a code stands for."""
    at = [int(code[k : k + 2], 16) for k in range(0, len(code), 2)]
    return [(x + 0.5) / SCALE for p, k in enumerate(at) for x in books[p, k].tolist()]


def _oracle() -> str:
    steps, book = "", "b0"
    for k in range(ROUNDS + 1):
        steps += f""",
      a{k} AS MATERIALIZED (SELECT q.r, q.p, min({{'d': list_sum(list_transform(q.x, lambda v, i: (v - b.x[i]) * (v - b.x[i]))), 'e': b.e}}) AS w
        FROM parts q JOIN {book} b ON q.p = b.p GROUP BY q.r, q.p)"""
        if k == ROUNDS:
            break
        steps += f""",
      s{k} AS (SELECT a.p, a.w.e AS e, u.i, sum(q.x[u.i])::BIGINT AS s, count(*) AS n FROM a{k} a JOIN parts q ON q.r = a.r AND q.p = a.p, (SELECT unnest(range(1, (SELECT max(len(x)) FROM parts) + 1)) AS i) u GROUP BY ALL),
      b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM {book} b LEFT JOIN
        (SELECT p, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS x FROM s{k} GROUP BY p, e) m ON m.p = b.p AND m.e = b.e)"""
        book = f"b{k + 1}"
    return f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v, row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS r FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(embedding) % {PARTS} = 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      parts AS MATERIALIZED (SELECT r, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS x FROM kept, range({PARTS}) t(p)),
      b0 AS MATERIALIZED (SELECT p, r AS e, x FROM parts WHERE r < {ENTRIES}){steps},
      coded AS (SELECT r, string_agg(format('{{:02x}}', w.e), '' ORDER BY p) AS code, sum(w.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY r)
      SELECT k.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY k.label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) FROM {book}) AS codebooks_sha256
      FROM kept k JOIN coded c ON c.r = k.r"""


ORACLE = _oracle()

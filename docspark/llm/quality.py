"""Quality classifier: naive Bayes log-count ratios scale n-gram indicators, a linear SVM decides."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.arrays import slices, word_hashes
from docspark.llm.ngrams import DIMS, counted, hashed_ngrams
from docspark.llm.sampling import bounded, bounded_by_marks, held_out, label_sizes, sized

ORDERS = (1, 2, 3)
#: Marks of word pairs follow the characters' features: a word repeated once, twice, three times in a row.
REPEATS = 3
SIZE = DIMS + REPEATS
#: Labelled documents the SVM is fitted on, at most (and LEAST of each label); the log-count ratios come from all of them.
SAMPLE = 6000


@dataclass
class QualityModel:
    """ratio: naive Bayes log-count ratios; weights and bias of the SVM; slope and shift of the sigmoid."""

    ratio: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def indicators(column: pa.Array) -> Iterator[np.ndarray]:
    """The features of each text: its distinct character n-grams, case kept, and its runs of one word."""
    texts = [t or "" for t in column.to_pylist()]
    words, bounds = word_hashes(column)
    for k, grams in enumerate(hashed_ngrams(texts, ORDERS, False)):
        own = words[bounds[k] : bounds[k + 1]]
        run = own[1:] == own[:-1]
        marks = []
        for r in range(REPEATS):
            if run.any():
                marks.append(DIMS + r)
            run = run[1:] & run[:-1]
        yield np.append(counted(grams)[0], marks).astype(np.int64)


def class_counts(rows: DataFrame, text: str, label: str) -> np.ndarray:
    """In how many texts of either label each feature occurs: over all rows, summed up per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SIZE), np.int64)
        for batch in slices(batches, text):
            for y, at in zip(batch.column(label).to_pylist(), indicators(batch.column(text)), strict=True):
                total[y, at] += 1
        y, at = np.nonzero(total)
        yield pa.RecordBatch.from_pydict({"y": y, "at": at, "n": total[y, at]})

    sums = rows.select(text, label).mapInArrow(run, "y long, at long, n long").groupBy("y", "at").agg(F.sum("n").alias("n"))
    out = np.zeros((2, SIZE))
    for r in sums.collect():  # at most 2 x SIZE rows
        out[r["y"], r["at"]] = r["n"]
    return out


def scaled(at: np.ndarray, ratio: np.ndarray) -> np.ndarray:
    """The ratios of a text's features, of length 1."""
    x = ratio[at]
    norm = np.sqrt(x @ x)
    return x / norm if norm > 0 else x


def dual_coordinate_descent(data: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int, cost: np.ndarray, rounds: int = 15) -> np.ndarray:
    """Weights (the last is the bias) of the linear SVM with hinge loss: one dual variable at a time, in a fixed random order."""
    w, alpha = np.zeros(size + 1), np.zeros(len(data))
    norms = np.array([x @ x + 1 for _, x in data])
    random = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0.0
        for i in random.permutation(len(data)):
            at, x = data[i]
            g = y[i] * (x @ w[at] + w[size]) - 1
            new = min(max(alpha[i] - g / norms[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[at] += step * x
                w[size] += step
                moved = max(moved, abs(step))
        if moved < 1e-3:
            break
    return w


def sigmoid_fit(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and shift of the sigmoid of least log loss (Platt's smoothed targets, Newton steps, a small ridge)."""
    if not len(y):
        return 1.0, 0.0
    t = np.where(y > 0, ((y > 0).sum() + 1) / ((y > 0).sum() + 2), 1 / ((y < 0).sum() + 2))
    a, b = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * margins + b, -35, 35)))
        d, h = p - t, np.maximum(p * (1 - p), 1e-9)
        grad = np.array([d @ margins + 1e-3 * a, d.sum()])
        hess = np.array([[h @ margins**2 + 1e-3, h @ margins], [h @ margins, h.sum() + 1e-9]])
        step = np.linalg.solve(hess, grad)
        a, b = a - np.clip(step[0], -2, 2), b - np.clip(step[1], -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def fit(column: pa.Array, labels: list[int], counts: np.ndarray) -> QualityModel:
    """Fit on four of five texts of each label, in a fixed order; calibrate on the fifth."""
    p, q = counts[1] + 1, counts[0] + 1
    ratio = np.log((p / p.sum()) / (q / q.sum()))
    y = np.where(np.array(labels) == 1, 1, -1)
    data = [(at, scaled(at, ratio)) for k in range(0, len(labels), 200) for at in indicators(column.slice(k, 200))]
    kept, held = held_out(y, np.random.default_rng(1).permutation(len(data)))
    share = {s: max(1, (y[kept] == s).sum()) for s in (-1, 1)}
    cost = np.array([len(kept) / (2 * share[int(s)]) for s in y[kept]])
    w = dual_coordinate_descent([data[k] for k in kept], y[kept], SIZE, cost)
    margins = np.array([data[k][1] @ w[data[k][0]] + w[SIZE] for k in held])
    slope, shift = sigmoid_fit(margins, y[held])
    return QualityModel(ratio, w[:SIZE], float(w[SIZE]), slope, shift)


def train(rows: DataFrame, text: str = "text", label: str = "quality", id: str = "doc_id", sample: int = SAMPLE, labels: DataFrame | None = None) -> QualityModel:
    """Learn from the rows with label 0 or 1; null texts are empty, other labels are left out.

    ``labels``: a table (id, label) of its own, where ``rows`` have none; a row learns from each distinct label of its
    id. It is reduced to distinct pairs first, so that whole texts meet it at most once by a shuffle, and by
    none where it is small.

    The log-count ratios cover all those rows. The SVM is fitted in one task on at most ``sample``
    rows, distinct and picked by a hash of id and text, in the shares of the labels, but LEAST of each, however rare;
    only the model, whose size is fixed, comes to the driver.
    """
    known = F.col(label).isin(0, 1)
    if labels is None:
        rows = rows.filter(known).select(id, F.coalesce(text, F.lit("")).alias("t"), F.col(label).cast("long").alias("y"))
        counts = class_counts(rows, "t", "y")
        picked = bounded(rows, id, "t", "y", label_sizes(rows, id, "t", "y"), sample)
    else:
        rows = rows.select(id, F.coalesce(text, F.lit("")).alias("t"))
        labels = sized(labels.filter(known & F.col(id).isNotNull()).select(id, F.col(label).cast("long").alias("y")).distinct())
        counts = class_counts(rows.join(labels, id), "t", "y")
        picked = bounded_by_marks(rows, labels, id, "t", "y", sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        out = io.BytesIO()
        if table.num_rows:
            table = table.sort_by([("k", "ascending"), ("t", "ascending"), ("y", "ascending")]).combine_chunks()
            m = fit(table.column("t").combine_chunks(), table.column("y").to_pylist(), counts)
            np.savez_compressed(out, ratio=m.ratio, weights=m.weights, rest=np.array([m.bias, m.slope, m.shift]))
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]})

    found = picked.select(F.xxhash64(id).alias("k"), "t", "y").repartition(1).mapInArrow(run, "model binary").first()
    if found is None or not found["model"]:
        return QualityModel(np.zeros(SIZE), np.zeros(SIZE), 0.0, 1.0, 0.0)
    m = np.load(io.BytesIO(found["model"]))
    return QualityModel(m["ratio"], m["weights"], *[float(x) for x in m["rest"]])


def score(docs: DataFrame, model: QualityModel, text: str = "text", id: str = "doc_id") -> DataFrame:
    """Rows (id, score), one per row of ``docs``: the probability of label 1, from the whole text alone; no shuffle.

    Null texts are empty; an empty text gets what the bias says. Where nothing was learned every score
    is 0.5. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))  # of fixed size
    rows = docs.select(id, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = QualityModel(*shared.value)
        for batch in slices(batches, text):
            margins = np.array([scaled(at, m.ratio) @ m.weights[at] + m.bias for at in indicators(batch.column(text))])
            p = 1 / (1 + np.exp(-np.clip(m.slope * margins + m.shift, -35, 35)))
            yield pa.RecordBatch.from_arrays([batch.column(id), pa.array(p, pa.float64())], [id, "score"])

    return rows.mapInArrow(run, f"`{id}` {rows.schema[id].dataType.simpleString()}, score double")

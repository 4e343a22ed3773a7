"""Language identification: sparse multinomial logistic regression on TF-IDF of character n-grams."""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import astuple, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from docspark.llm.arrays import slices
from docspark.llm.ngrams import DIMS, counted, hashed_ngrams
from docspark.llm.sampling import bounded, held_out, label_sizes

ORDERS = (1, 2, 3)
UNKNOWN = "und"
#: Labelled documents the weights are fitted on, at most (and LEAST of each language); document frequencies come from all of them.
SAMPLE = 6000


@dataclass
class LanguageModel:
    """Names of the languages, weights (features x languages, most of them 0), bias, idf and temperature."""

    names: list[str]
    weights: np.ndarray
    bias: np.ndarray
    idf: np.ndarray
    temperature: float


def features(texts: list[str], idf: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(features, values) of each text: 1 + log of the count, times idf, of length 1."""
    for grams in hashed_ngrams(texts, ORDERS, True):
        at, n = counted(grams)
        x = (1 + np.log(n)) * idf[at]
        norm = np.sqrt(x @ x)
        yield at, x / norm if norm > 0 else x


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many texts each feature occurs, and the number of texts: over all rows, summed up per task first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(DIMS, np.int64), 0
        for batch in slices(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            rows += len(texts)
            for grams in hashed_ngrams(texts, ORDERS, True):
                total[counted(grams)[0]] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"feature": np.append(at, -1), "n": np.append(total[at], rows)})

    sums = docs.select(text).mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))
    df, rows = np.zeros(DIMS, np.int64), 0
    for r in sums.collect():  # at most DIMS + 1 rows
        if r["feature"] < 0:
            rows = r["n"]
        else:
            df[r["feature"]] = r["n"]
    return df, rows


class Ftrl:
    """Follow the regularised leader, per coordinate, with L1 and L2 penalties, for softmax regression."""

    def __init__(self, classes: int, alpha: float = 1.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.5) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((DIMS + 1, classes)), np.zeros((DIMS + 1, classes))  # the last row is the bias

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) > self.l1, w, 0.0)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(at, DIMS), np.append(x, 1.0)
        w = self.weights(at)
        p = softmax(x @ w)
        p[label] -= 1
        g = x[:, None] * p
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(-1, keepdims=True))
    return e / e.sum(-1, keepdims=True)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0
    loss = lambda t: -np.log(softmax(logits / np.exp(t))[np.arange(len(labels)), labels] + 1e-12).mean()
    a, b, r = np.log(0.02), np.log(20.0), (5**0.5 - 1) / 2
    for _ in range(40):
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


def fit(texts: list[str], langs: list[str], idf: np.ndarray, names: list[str], epochs: int = 3) -> LanguageModel:
    """Fit on four of five texts of each language, in a fixed order; calibrate on the fifth."""
    label = {n: k for k, n in enumerate(names)}
    data, y = [], np.array([label[x] for x in langs])
    for k in range(0, len(texts), 200):
        data += list(features(texts[k : k + 200], idf))
    kept, held = held_out(y, np.random.default_rng(0).permutation(len(data)))
    model = Ftrl(len(names))
    for _ in range(epochs):
        for k in kept:
            model.learn(*data[k], y[k])
    w = model.weights(np.arange(DIMS + 1))
    logits = np.array([data[k][1] @ w[data[k][0]] + w[DIMS] for k in held]).reshape(-1, len(names))
    return LanguageModel(names, w[:DIMS], w[DIMS], idf, temperature(logits, y[held]))


def train(docs: DataFrame, text: str = "text", lang: str = "lang", id: str = "doc_id", sample: int = SAMPLE) -> LanguageModel:
    """Learn from the rows of ``docs`` with text and language.

    Document frequencies and the list of languages cover all those rows. The weights are fitted in one
    task on at most ``sample`` rows, distinct and picked by a hash of id and text, in the shares of the languages, but
    LEAST of each, however rare; only the model, of fixed size per language, comes to the driver.
    """
    rows = docs.filter(F.col(text).isNotNull() & F.col(lang).isNotNull())
    df, n = document_frequencies(rows, text)
    idf = np.log((1 + n) / (1 + df)) + 1
    sizes = label_sizes(rows, id, text, lang)
    names = sorted(sizes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        out = io.BytesIO()
        if table.num_rows:
            table = table.sort_by([("k", "ascending"), ("t", "ascending")])
            m = fit(table.column("t").to_pylist(), table.column("l").to_pylist(), idf, names)
            np.savez_compressed(out, names=np.array(m.names), weights=m.weights, bias=m.bias, temperature=m.temperature)
        yield pa.RecordBatch.from_pydict({"model": [out.getvalue()]})

    picked = bounded(rows, id, text, lang, sizes, sample).select(F.xxhash64(id).alias("k"), F.col(text).alias("t"), F.col(lang).alias("l"))
    found = picked.repartition(1).mapInArrow(run, "model binary").first()
    if found is None or not found["model"]:
        return LanguageModel([], np.zeros((DIMS, 0)), np.zeros(0), idf, 1.0)
    m = np.load(io.BytesIO(found["model"]))
    return LanguageModel(m["names"].tolist(), m["weights"], m["bias"], idf, float(m["temperature"]))


def predict(docs: DataFrame, model: LanguageModel, text: str = "text", id: str = "doc_id", whole: bool = False) -> DataFrame:
    """Rows (id, lang_pred, score), one per row of ``docs``, from the whole text alone; no shuffle.

    ``whole`` keeps all columns of ``docs`` in place of the id.

    score is the calibrated probability of the language. Null texts, texts without a letter, and all
    texts where no language was learned are `und` with score 0. Ties go to the first name by the
    alphabet. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(astuple(model))  # of fixed size: features x languages
    rows = docs if whole else docs.select(id, text)
    kept = docs.columns if whole else [id]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = LanguageModel(*shared.value)
        for batch in slices(batches, text):
            texts = [t or "" for t in batch.column(text).to_pylist()]
            langs, scores = [], []
            for at, x in features(texts, m.idf):
                if len(at) and m.names:
                    p = softmax((x @ m.weights[at] + m.bias) / m.temperature)
                    best = int(p.argmax())
                    langs.append(m.names[best])
                    scores.append(float(p[best]))
                else:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
            yield pa.RecordBatch.from_arrays([*map(batch.column, kept), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"])

    schema = StructType([StructField(c, rows.schema[c].dataType) for c in kept])
    return rows.mapInArrow(run, schema.add("lang_pred", "string").add("score", "double"))

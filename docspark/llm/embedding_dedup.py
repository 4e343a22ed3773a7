"""Near copies among embeddings: sign hashing by random hyperplanes, exact cosine, connected components."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.llm.graph import connected_components
from docspark.session import materialize

#: Share of the pairs right at the threshold that no table may bring together; closer pairs are missed less.
MISS = 4e-5
#: Vectors that chance may bring together in a bucket: more rows have more signs, and more tables.
SPREAD, LEAST_BITS = 256, 16
#: Rows of one side of a cell: larger buckets are cut into chunks, every two chunks are a cell.
CHUNK = 1024


def table_plan(rows: int, threshold: float) -> tuple[int, int]:
    """Signs per table and number of tables for so many rows: buckets of a bounded size, pairs missed with probability MISS at most.

    Two vectors of cosine c agree in one sign with probability 1 - arccos(c) / pi; at 0.98 that is 0.936, so 16 signs need 24 tables
    and 20 signs (a quarter of a thousand million rows) need 33.
    """
    bits = max(LEAST_BITS, math.ceil(math.log2(max(rows, 1) / SPREAD)))
    same = (1 - math.acos(threshold) / math.pi) ** bits
    return bits, max(1, math.ceil(math.log(MISS) / math.log1p(-same))) if same < 1 else 1


def hashed_vectors(rows: DataFrame, vector: str, label: str, id: str, bits: int, tables: int) -> DataFrame:
    """Rows (id, digest, vec, codes): digest, vector and codes are null where the vector links with nothing.

    digest tells vector, length and label; codes has one number per table.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        powers = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            lists, names = batch.column("vec"), batch.column("label").to_pylist()
            sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            values = pc.cast(lists.flatten(), pa.float64()).to_numpy(zero_copy_only=False)  # nulls are not-a-number
            begins = np.cumsum(sizes) - sizes
            labelled = np.array([n is not None for n in names], bool)
            digests, vecs, codes = [None] * len(names), [None] * len(names), [None] * len(names)
            for size in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero((sizes == size) & labelled)
                x = values[begins[at][:, None] + np.arange(size)]
                with np.errstate(over="ignore", invalid="ignore"):
                    norm = np.sqrt((x * x).sum(1))
                good = (norm > 0) & np.isfinite(norm)
                at, x, norm = at[good], x[good], norm[good]
                if size not in planes:
                    planes[size] = np.random.default_rng([17, size]).standard_normal((size, bits * tables))
                signs = (x / norm[:, None]) @ planes[size] > 0
                found = signs.reshape(len(at), tables, bits) @ powers
                for k, i in enumerate(at.tolist()):
                    digests[i] = hashlib.blake2b(x[k].tobytes() + repr(names[i]).encode(), digest_size=16).digest()
                    vecs[i], codes[i] = x[k], found[k]
            columns = [batch.column("id"), batch.column("label"), pa.array(digests, pa.binary()), pa.array(vecs, pa.list_(pa.float64())), pa.array(codes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "label", "digest", "vec", "codes"])

    rows = rows.select(F.col(id).alias("id"), F.col(vector).alias("vec"), F.col(label).alias("label"))
    kind = rows.schema["label"].dataType.simpleString()
    key = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {key}, label {kind}, digest binary, vec array<double>, codes array<long>")


def _components(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric matrix of links the first node it is connected to."""
    root = np.arange(len(linked))
    open_ = linked.any(1)
    while open_.any():
        at = int(np.flatnonzero(open_)[0])
        reached, edge = np.zeros(len(linked), bool), np.zeros(len(linked), bool)
        edge[at] = True
        while edge.any():
            reached |= edge
            edge = linked[edge].any(0) & ~reached
        root[reached] = at
        open_ &= ~reached
    return root


def _cell(rows: list[tuple], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For one cell: nodes, the weight each gains by links first met in this table, and the smallest node connected to it."""
    rows = sorted(rows, key=lambda r: r[0])
    node = np.array([r[0] for r in rows])
    weight = np.array([r[1] for r in rows])
    own = np.array([r[2] for r in rows])
    x = np.array([r[3] for r in rows])
    codes = np.array([r[4] for r in rows])
    table, first, second = rows[0][5], rows[0][6], rows[0][7]
    norm = np.sqrt((x * x).sum(1))
    linked = (x @ x.T) / (norm[:, None] * norm) >= threshold
    linked &= (own[:, None] == first) & (own == second) if first == second else own[:, None] != own
    np.fill_diagonal(linked, False)
    root = node[_components(linked)]
    u, v = np.nonzero(linked)
    gain = np.zeros(len(node), np.int64)
    for s in range(0, len(u), 1 << 16):
        p, q = u[s : s + (1 << 16)], v[s : s + (1 << 16)]
        new = ~(codes[p, :table] == codes[q, :table]).any(1)
        np.add.at(gain, p[new], weight[q[new]])
    return node, gain, root


def link_vectors(
    rows: DataFrame, vector: str = "embedding", label: str = "label", id: str = "vec_id", threshold: float = 0.98, bits: int | None = None, tables: int | None = None
) -> DataFrame:
    """Rows (id, n_links, component_id, kept), one per row of ``rows``.

    Two vectors of one label and length link when their cosine in double precision is ``threshold`` or
    more. Candidates share a bucket in one of ``tables`` tables of ``bits`` signs, by ``table_plan`` unless both are given. Exact
    copies are one node with a weight.
    A bucket is compared as blocks of a matrix product, a large one as cells of two chunks, which
    spread over tasks; a cell gives back one row per node, not its pairs: the weight gained by pairs
    that share no earlier table, and the smallest node connected to it within the cell.

    n_links counts other vectors linked directly, component_id is the smallest id reachable, kept marks
    that vector. Vectors that are null, empty, zero, not finite, hold nulls or have no label link with
    nothing; rows without an id as well, with component_id null and kept false. A row that repeats id,
    label and vector counts once; an id with several vectors is as many vectors, each with its own links and component. An empty table gives an empty result. Other columns are not read.
    """
    if bits is None or tables is None:
        bits, tables = table_plan(rows.count(), threshold)
    hashed = materialize(hashed_vectors(rows, vector, label, id, bits, tables), "vectors")
    usable = hashed.filter(F.col("digest").isNotNull() & F.col("id").isNotNull())
    copies = usable.select("digest", "id").distinct().groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("weight"))
    copies = materialize(copies.withColumn("node", F.monotonically_increasing_id()), "copies")
    chosen = usable.dropDuplicates(["digest", "id"]).join(copies, (usable.digest == copies.digest) & (F.col("id") == F.col("first")))
    nodes = materialize(chosen.select("node", "label", "weight", "vec", "codes"), "nodes")
    buckets = nodes.select("node", "label", F.size("vec").alias("dim"), F.posexplode("codes").alias("t", "code"))
    buckets = buckets.select("node", "t", F.xxhash64("label", "dim", "t", "code").alias("bucket"))
    shared = buckets.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    rows_of = buckets.join(shared, "bucket").withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    rows_of = rows_of.withColumn("own", F.pmod(F.xxhash64("node", "t"), "chunks").cast("int"))
    cells = rows_of.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    cells = cells.select("node", "t", "bucket", "own", F.least("own", "other").alias("c1"), F.greatest("own", "other").alias("c2"))
    cells = cells.join(nodes.select("node", "weight", "vec", "codes"), "node")
    cells = cells.repartition("bucket", "c1", "c2").sortWithinPartitions("bucket", "c1", "c2", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None

        def done() -> pa.RecordBatch:
            node, gain, root = _cell(held, threshold) if len(held) > 1 else (np.zeros(0, np.int64),) * 3
            return pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(gain, pa.int64()), pa.array(root, pa.int64())], ["node", "gain", "root"])

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("node", "weight", "own")]
            columns += [[v.values.to_numpy() for v in batch.column("vec")], [v.values.to_numpy() for v in batch.column("codes")]]
            columns += [batch.column(c).to_pylist() for c in ("t", "c1", "c2", "bucket")]
            for r in zip(*columns, strict=True):
                at = (r[8], r[6], r[7])
                if at != key:
                    if held:
                        yield done()
                    held, key = [], at
                held.append(r)
        if held:
            yield done()

    return _finish(hashed, copies, materialize(cells.mapInArrow(run, "node long, gain long, root long"), "links"), id)


def _finish(hashed: DataFrame, copies: DataFrame, found: DataFrame, id: str) -> DataFrame:
    gains = found.groupBy("node").agg(F.sum("gain").alias("gain"))
    parts = connected_components(found, "node", "root")
    least = parts.join(copies.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("least"))
    named = copies.join(gains, "node", "left").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = named.join(materialize(least, "components"), "component", "left")
    named = named.select(
        F.col("digest").alias("_digest"), (F.col("weight") - 1 + F.coalesce("gain", F.lit(0))).alias("n_links"), F.coalesce("least", "first").alias("component")
    )
    usable = F.col("id").isNotNull() & (F.col("digest") == F.col("_digest"))
    out = hashed.select("id", "digest").join(named, usable, "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(component == F.col("id"), F.lit(False)).alias("kept"))

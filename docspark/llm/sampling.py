"""Rows to learn from."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from docspark.session import materialize

#: Rows of each label in a sample, at least, if it has as many.
LEAST = 100


def in_fold(id: str, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % modulus == remainder


def label_sizes(rows: DataFrame, key: str, text: str, label: str) -> dict:
    """Each label of ``rows`` and how many distinct pairs of key and text it has: one row per label comes to the driver."""
    each = rows.select(F.col(label).alias("label"), _mark(key, text).alias("mark")).distinct()
    return {r["label"]: r["n"] for r in each.groupBy("label").agg(F.count("*").alias("n")).collect()}


def _mark(key: str, text: str) -> Column:
    return F.xxhash64(F.col(key), F.col(text), F.lit("sample"))


def bounded(rows: DataFrame, key: str, text: str, label: str, sizes: dict, most: int, least: int = LEAST) -> DataFrame:
    """Rows (key, text, label), none twice: ``most`` by the shares of the labels (``sizes``: label_sizes), but ``least`` of each label or all it has.

    So at most ``most`` rows and ``least`` per label, however often a key or null repeats. Those of a label
    with the smallest hashes of key and text are taken: any pair is as likely. A first cut by the hash
    alone, with room to spare, leaves few rows to rank.
    """
    if not sum(sizes.values()):
        return rows.limit(0)
    return _least(rows.select(key, text, label, _mark(key, text).alias("_mark")), label, sizes, most, least).select(key, text, label)


def _least(rows: DataFrame, label: str, sizes: dict, most: int, least: int) -> DataFrame:
    """Of the rows (with a column _mark) of each label those with the smallest marks, none twice."""
    total = sum(sizes.values())
    quotas = {x: min(n, max(least, most * n // total)) for x, n in sizes.items()}
    cuts = [(x, q, min(2**63 - 1, int((1.2 * q + 50) / sizes[x] * 2**64) - 2**63)) for x, q in quotas.items()]
    schema = StructType([StructField("_label", rows.schema[label].dataType), StructField("_quota", LongType()), StructField("_cut", LongType())])
    table = F.broadcast(rows.sparkSession.createDataFrame(cuts, schema))  # one row per label
    near = rows.join(table, F.col(label) == F.col("_label")).filter("_mark <= _cut").distinct()  # combined before the shuffle
    place = F.row_number().over(Window.partitionBy("_label").orderBy("_mark"))
    return near.withColumn("_place", place).filter("_place <= _quota")


def bounded_by_marks(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, most: int, least: int = LEAST) -> DataFrame:
    """The sample of ``bounded`` where texts and labels (distinct key and label) are two tables: rows (key, text, label).

    Only keys and hashes meet the labels; the texts of the rows picked, at most ``most`` and ``least`` per
    label, are fetched by a broadcast of their hashes.
    """
    marks = docs.select(key, _mark(key, text).alias("_mark")).distinct()
    marks = materialize(marks.join(labels, key).select("_mark", label).distinct(), "marks")
    sizes = {r[label]: r["n"] for r in marks.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return docs.select(key, text).limit(0).join(labels.limit(0), key)
    picked = materialize(_least(marks, label, sizes, most, least).select("_mark", label), "picked")
    return docs.select(key, text, _mark(key, text).alias("_mark")).join(F.broadcast(picked), "_mark").select(key, text, label).distinct()


def held_out(labels: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``order`` in two parts: four of five rows of each label, and the fifth (one row of two to nine; a label's only row is in the first part)."""
    held = np.zeros(len(order), bool)
    for label in np.unique(labels):
        at = np.flatnonzero(labels[order] == label)
        held[at[: max(len(at) // 5, len(at) > 1)]] = True
    return order[~held], order[held]


def rows_with(docs: DataFrame, ids: DataFrame, id: str, most: int = 1_000_000) -> DataFrame:
    """The rows of ``docs`` whose id is in ``ids``, null in none."""
    return docs.join(sized(ids.select(F.col(id)).filter(F.col(id).isNotNull()).distinct(), most), id, "left_semi")


def sized(rows: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``rows`` (narrow ones) written once, and sent to every task where a join asks for them if they are at most ``most``; else the sides meet by a shuffle."""
    rows = materialize(rows, "sized")
    return F.broadcast(rows) if rows.limit(most + 1).count() <= most else rows

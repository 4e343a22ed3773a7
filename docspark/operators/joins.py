"""Joins of rows with one row of another table each."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.functions.rows import row_hash
from docspark.session import materialize

# A key that owns a larger share of the rows than this is split; so there are at most 1 / SHARE such keys.
SHARE = 1e-3
SALTS = 64


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> list[Any]:
    """Every key with more than ``share`` of the rows, and maybe some with fewer: at most 1 / ``share`` of them.

    A frequent-item sketch over the key column alone finds them; nothing is shuffled.
    """
    return [k for k in df.select(key).freqItems([key], share).first()[0] if k is not None]


def left_join_unique(left: DataFrame, right: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """Left join to a table with at most one row per key, by one plan for all sizes; hot left keys are split.

    Content-derived ids repeat for exact copies, so one id may own a large share of the left side.
    Rows of such an id get a salt and the matching right rows one copy per salt. (The adaptive skew
    join did not see to it in a test, likely because the right side came from an aggregation on the
    key.) Rows without a key match nothing and are spread the same way. The
    salt is a hash of the row, so a re-run task sends each row to the same place.
    """
    schema = left.select(F.col(key), F.lit(True).alias("_hot")).schema
    table = left.sparkSession.createDataFrame([(k, True) for k in hot_keys(left, key)], schema)  # at most 1 / SHARE rows
    spread = F.pmod(row_hash(left), F.lit(salts)).cast("int")
    hot = F.col(key).isNull() | F.coalesce("_hot", F.lit(False))
    marked = left.withColumn("_spread", spread).join(F.broadcast(table), key, "left")
    marked = marked.withColumn("_salt", F.when(hot, F.col("_spread")).otherwise(F.lit(0))).drop("_hot", "_spread")
    every = F.sequence(F.lit(0), F.lit(salts - 1))
    copies = right.join(F.broadcast(table), key, "left")
    copies = copies.withColumn("_salt", F.explode(F.when(F.col("_hot"), every).otherwise(F.array(F.lit(0))))).drop("_hot")
    return marked.join(copies, [key, "_salt"], "left").drop("_salt")


def lookup(df: DataFrame, table: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``columns`` of ``table`` beside every row of ``df`` with its key; null where there is none.

    A key that the table holds more than once counts with its smallest row, so no row of ``df`` is
    multiplied. The reduced table is written, so that its size is known: Spark broadcasts it below its own
    bound, and else splits hot keys of ``df`` (a written side can be read twice, an aggregated one not).
    """
    one = table.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row"))
    one = materialize(one.select(key, *[F.col(f"_row.`{c}`").alias(c) for c in columns]), "lookup")
    return df.join(one, key, "left")

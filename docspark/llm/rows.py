"""Results joined to whole input rows without a clash of names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_columns(rows: DataFrame, docs: DataFrame, new: dict[str, Column]) -> DataFrame:
    """The columns of ``docs``, which ``rows`` carries in the struct ``row``, with ``new`` put in place or added."""
    kept = [new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns]
    return rows.select(*kept, *[c.alias(n) for n, c in new.items() if n not in docs.columns])

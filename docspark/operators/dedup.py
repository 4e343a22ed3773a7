"""Equal records: one of each kept, found by the hash of the whole record."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.operators.enrich import record_hash


def dedup_records(df: DataFrame, fields: list[str], order: list[str]) -> DataFrame:
    """The first row in ``order`` of every record, records being equal in all ``fields``; ``copies`` counts them.

    Records are grouped by their 256-bit hash; a task keeps one row per record before the shuffle,
    so a record that owns a third of all rows sends one row per task. Rows without any field are one record.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    groups = df.groupBy(record_hash(df, fields).alias("record_hash")).agg(
        F.min_by(whole, F.struct(*order)).alias("_row"), F.count("*").alias("copies")
    )
    return groups.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns], "record_hash", "copies")


def dedup_stream(df: DataFrame, fields: list[str], time: str, delay: str) -> DataFrame:
    """The same on a stream: the first row of a record that arrives within ``delay`` of event time, in bounded state.

    State goes when the watermark (the latest event time less ``delay``) has passed a record by ``delay``. Rows that are older than
    the watermark when they arrive are late and left out, repeated or not: choose ``delay`` above the lateness to be expected.
    """
    return df.withColumn("record_hash", record_hash(df, fields)).withWatermark(time, delay).dropDuplicatesWithinWatermark(["record_hash"])

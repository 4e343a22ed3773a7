"""Input layout."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Rows of a table with fewer input splits than cores, dealt out to all cores.

    For work that is heavy per row (parsing, patterns, model calls) one big row group would keep
    one core busy and the others idle. A table with enough splits is returned as it is: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df

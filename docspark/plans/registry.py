"""The query catalogue: name, Spark query, and the same result as DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docspark.functions.text import WHITESPACE
from docspark.sources.tables import spread as spread_rows

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` computes the same rows in DuckDB."""

    def add(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A parquet table; ``spread`` for heavy work per row (see ``sources.tables.spread``)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread_rows(df) if spread else df


def sql_strip(x: str) -> str:
    """DuckDB: trim white space of any kind."""
    return f"trim({x}, '{WHITESPACE}')"


def sql_float(x: str) -> str:
    """DuckDB: text to DOUBLE by Python's rules."""
    digits = r"[0-9]+(_[0-9]+)*"
    syntax = rf"[+-]?(({digits}(\.({digits})?)?|\.{digits})([eE][+-]?{digits})?|(?i:nan|inf(inity)?))"
    text = sql_strip(x)
    return f"CASE WHEN regexp_full_match({text}, '{syntax}') THEN TRY_CAST(replace({text}, '_', '') AS DOUBLE) END"

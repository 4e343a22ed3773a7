"""Record shapes handed to targets: JSON envelope, SQL rows, API payload, load log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- Fixed values: load log texts ---
SKIPPED = "skipped"
FAILED_WRITE = "error"
FAILED_QUALITY = "Quality validation failed"

LOG = ["document_id", "destination", "success", "records_written", "error"]


def record_data(fields: list[str] | None) -> Column:
    """The record as a struct: the given columns, or the ``data`` column of a finished flow."""
    return F.struct(*[F.col(f"`{f}`") for f in fields]) if fields else F.col("data")


def envelope(df: DataFrame, fields: list[str] | None = None, loaded_at: Column | None = None) -> DataFrame:
    """document_id, data and loaded_at, as stored in JSON files."""
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.select("document_id", record_data(fields).alias("data"), stamp.alias("loaded_at"))


def table_rows(df: DataFrame, fields: list[str] | None = None, schema_name: str = "", loaded_at: Column | None = None) -> DataFrame:
    """Rows of the SQL target: the record as JSON text beside its schema name, score and metadata."""
    score = F.col("overall") if "overall" in df.columns else F.lit(0.0)
    meta = F.to_json("metadata") if "metadata" in df.columns else F.lit("{}")
    stamp = loaded_at if loaded_at is not None else F.current_timestamp()
    return df.select(
        "document_id",
        F.to_json(record_data(fields)).alias("data"),
        F.lit(schema_name).alias("schema_name"),
        score.alias("quality_score"),
        stamp.alias("loaded_at"),
        meta.alias("metadata"),
    )


def api_payload(fields: list[str] | None = None) -> Column:
    """One request body per record."""
    return F.to_json(F.struct(F.col("document_id"), record_data(fields).alias("data")))


def written(df: DataFrame, destination: str | Column) -> DataFrame:
    """Load log of records a sink has committed."""
    target = destination if isinstance(destination, Column) else F.lit(destination)
    return df.select(
        "document_id",
        target.alias("destination"),
        F.lit(True).alias("success"),
        F.lit(1).alias("records_written"),
        F.lit(None).cast("string").alias("error"),
    )


def skipped(df: DataFrame) -> DataFrame:
    """Load log of records that did not pass."""
    return df.select(
        "document_id",
        F.lit(SKIPPED).alias("destination"),
        F.lit(False).alias("success"),
        F.lit(0).alias("records_written"),
        F.lit(FAILED_QUALITY).alias("error"),
    )


def failed(df: DataFrame, message: str) -> DataFrame:
    """Load log of records whose sink failed."""
    return df.select(
        "document_id",
        F.lit(FAILED_WRITE).alias("destination"),
        F.lit(False).alias("success"),
        F.lit(0).alias("records_written"),
        F.lit(message).alias("error"),
    )


def load_log(judged: DataFrame, destination: str) -> DataFrame:
    """Load log of a whole judged batch in one projection: written where passed, skipped elsewhere."""
    ok = F.col("passed")
    return judged.select(
        "document_id",
        F.when(ok, destination).otherwise(SKIPPED).alias("destination"),
        ok.alias("success"),
        F.when(ok, 1).otherwise(0).alias("records_written"),
        F.when(~ok, FAILED_QUALITY).alias("error"),
    )

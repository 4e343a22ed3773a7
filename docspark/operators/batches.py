"""Fixed-size batches, per-batch results, progress, and delivery outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docspark.functions.rows import row_hash
from docspark.session import materialize

# --- Fixed values ---
BATCH_SIZES = {"base": 10, "development": 3, "production": 50}
DELIVERED = [200, 201, 202]
MAX_RETRIES = 3
RETRY_DELAY = 1.0
RETRIES_USED_UP = "Max retries exceeded"
HTTP_ERROR = "HTTP {}: {}"


def assign_batches(df: DataFrame, size: int, order: list[str], partitions: int | None = None) -> DataFrame:
    """Add ``batch_id``: contiguous slices of ``size`` rows in the given order, the last may be short.

    No task sees the whole order. Rows are range-partitioned (a hash of the row breaks ties, so one
    repeated key still spreads over tasks), sorted inside each partition and written once with
    their partition and position; one count per partition then gives the offsets.
    """
    ranged = df.withColumn("_tie", row_hash(df))
    keys = [*order, "_tie"]
    ranged = ranged.repartitionByRange(partitions, *keys) if partitions else ranged.repartitionByRange(*keys)
    placed = materialize(
        ranged.sortWithinPartitions(*keys).drop("_tie").withColumn("_pos", F.monotonically_increasing_id()), "batches"
    )
    # upper bits of _pos: partition, lower 33 bits: row in the partition
    part, row = F.shiftrightunsigned("_pos", 33), F.col("_pos").bitwiseAND((1 << 33) - 1)
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per partition: small enough to list on the driver
    offsets, start = [], 0
    for r in sorted(counts.collect(), key=lambda r: r["_part"]):
        offsets.append((r["_part"], start))
        start += r["_n"]
    table = df.sparkSession.createDataFrame(offsets, "_part bigint, _start bigint")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(table), "_part")
        .withColumn("batch_id", F.floor((F.col("_start") + row) / size).cast("bigint"))
        .drop("_part", "_start", "_pos")
    )


def batch_results(
    df: DataFrame, batch: str = "batch_id", success: str = "success", crashed: str | None = None, at: str | None = None, error: str | None = None
) -> DataFrame:
    """One row per batch: documents, successes, failures and status; a crashed batch fails as a whole.

    With the time ``at`` of each record also started and ended, and with ``error`` the earliest message of a batch.
    """
    ok = F.count_if(F.col(success))
    agg = df.groupBy(batch).agg(
        F.count("*").alias("total_documents"),
        ok.alias("_ok"),
        (F.bool_or(crashed) if crashed else F.lit(False)).alias("_crashed"),
        *([F.min(at).alias("started"), F.max(at).alias("ended")] if at else []),
        *([F.min(F.when(F.col(error).isNotNull(), F.struct(*([at] if at else []), error)))[error].alias("error")] if error else []),
    )
    good = F.when(F.col("_crashed"), F.lit(0).cast("bigint")).otherwise(F.col("_ok"))
    return agg.select(
        batch,
        "total_documents",
        good.alias("successful"),
        (F.col("total_documents") - good).alias("failed"),
        F.when(F.col("_crashed"), "failed").otherwise("completed").alias("status"),
        *(["started", "ended"] if at else []),
        *(["error"] if error else []),
    )


def seconds(start: Column, end: Column) -> Column:
    """Seconds from one time to another, with a fraction."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def progress(results: DataFrame, total_documents: int | None = None, elapsed: float | None = None) -> DataFrame:
    """Totals over finished batches, percent done and documents per second.

    Without ``elapsed`` the time is that from the first start to the last end that ``results`` records.
    """
    timed = elapsed is None and {"started", "ended"} <= set(results.columns)
    totals = results.agg(
        F.coalesce(F.sum("total_documents"), F.lit(0)).alias("processed"),
        F.coalesce(F.sum("successful"), F.lit(0)).alias("successful"),
        F.coalesce(F.sum("failed"), F.lit(0)).alias("failed"),
        F.count("*").alias("batches"),
        (seconds(F.min("started"), F.max("ended")) if timed else F.lit(float(elapsed or 0.0))).alias("_elapsed"),
    )
    elapsed = F.col("_elapsed")
    whole = F.lit(total_documents) if total_documents is not None else F.col("processed")
    return totals.withColumns(
        {
            "progress_percent": F.when(whole > 0, F.bround(F.col("processed") / whole * 100, 1)).otherwise(0.0),
            "documents_per_second": F.when(elapsed > 0, F.bround(F.col("processed") / elapsed, 2)).otherwise(0.0),
        }
    ).drop("_elapsed")


def delivery_outcome(
    attempts: DataFrame, key: str | list[str] = "document_id", max_retries: int | None = None, delay: float = RETRY_DELAY
) -> DataFrame:
    """Outcome per document of a delivery log (key, attempt, status, error).

    The first terminal attempt decides: 200, 201 and 202 deliver; 429, 5xx and transport errors
    (null status) are retried after ``delay * 2**attempt`` seconds; any other status fails for good.
    If none is terminal the last one decides. With ``max_retries`` attempts from that number on never
    happened, and a document whose attempts are used up says so (or has its last transport error).
    Entries that repeat an attempt count once. They are combined before the first shuffle, however long a
    log gets; the second, on the document, carries one row per attempt, and the outcome needs no join.
    """
    keys = [key] if isinstance(key, str) else key
    if max_retries is not None:
        attempts = attempts.filter(F.col("attempt") < max_retries)
    each = attempts.groupBy(*keys, "attempt").agg(F.min(F.struct("status", "error")).alias("_answer"))
    status = F.col("_answer.status")
    retried = status.isNull() | (status == 429) | (status >= 500)
    whole = Window.partitionBy(*keys)
    ends = {"_first": F.min(F.when(~retried, F.col("attempt"))).over(whole), "_last": F.max("attempt").over(whole)}
    seen = each.withColumns(ends).withColumn("_ended", F.coalesce("_first", "_last")).filter(F.col("attempt") <= F.col("_ended"))
    waits = retried if max_retries is not None else retried & (F.col("attempt") < F.col("_ended"))
    if max_retries is not None:  # no wait behind the last transport error
        waits = waits & ~(status.isNull() & (F.col("attempt") == max_retries - 1))
    df = seen.groupBy(*keys).agg(
        F.count("*").cast("int").alias("_used"),
        F.sum(F.when(waits, F.pow(F.lit(2.0), F.col("attempt")) * delay).otherwise(0.0)).alias("_waited"),
        F.max_by("_answer", "attempt").alias("_answer"),
        F.max(F.col("_first").isNotNull()).alias("_decided"),
        F.max("_last").alias("_last"),
    )
    delivered = F.coalesce(F.col("_answer.status").isin(DELIVERED), F.lit(False))
    before, between, _ = HTTP_ERROR.split("{}")
    http = F.concat(F.lit(before), F.col("_answer.status").cast("string"), F.lit(between), F.coalesce("_answer.error", F.lit("")))
    last = F.lit(True) if max_retries is None else F.col("_last") == max_retries - 1
    error = F.when(delivered, F.lit(None)).when(F.col("_answer.status").isNull() & last, F.col("_answer.error"))
    if max_retries is not None:
        error = error.when(~F.col("_decided"), RETRIES_USED_UP)
    return df.select(
        *keys,
        delivered.alias("success"),
        F.col("_used").alias("attempts"),
        F.col("_waited").alias("waited_seconds"),
        F.when(delivered, 1).otherwise(0).alias("records_written"),
        error.otherwise(http).alias("error"),
    )

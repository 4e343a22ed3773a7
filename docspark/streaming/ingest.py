"""Incremental ingest: bounded micro-batches through the same operators as a batch run."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from docspark.sources.documents import as_documents

FILE = "path string, modificationTime timestamp, length bigint, content binary"
REPORT = "batch_id bigint, total_documents bigint, successful bigint, failed bigint, status string, started timestamp, ended timestamp, error string"

# Not fixed: the bytes of raw files in one micro-batch
BATCH_BYTES = 128 << 20


def file_stream(spark: SparkSession, path: str, schema: str, format: str = "parquet", files_per_batch: int | None = 100, **options: str) -> DataFrame:
    """A stream over files that arrive in ``path``; at most ``files_per_batch`` files per micro-batch, with None all that are there."""
    reader = spark.readStream.format(format).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", str(files_per_batch))
    return reader.options(**options).load(path)


def table_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = 100) -> DataFrame:
    """A stream over the Parquet files of a table, which is one file or a folder of them."""
    path = path.rstrip("/")
    # a plain path has to be a folder, a pattern may match either
    return file_stream(spark, f"{path[:-1]}[{path[-1]}]", schema, files_per_batch=files_per_batch)


def document_files(spark: SparkSession, path: str, format: str, glob: str | None = None, files_per_batch: int | None = None) -> DataFrame:
    """A stream of documents, one per raw file that arrives in ``path``, as ``read_files`` gives them; ``path`` stays as a column.

    A micro-batch takes ``files_per_batch`` files or, without that, as many as make BATCH_BYTES (one at least): raw files are mostly
    small, and the number of batches is to grow with the bytes.
    """
    options = {"pathGlobFilter": glob} if glob else {}
    if not files_per_batch:
        options["maxBytesPerTrigger"] = str(BATCH_BYTES)
    files = file_stream(spark, path, FILE, "binaryFile", files_per_batch, **options)
    name = F.regexp_extract("path", r"[^/]+\z", 0).alias("filename")
    return as_documents(files.select("content", F.lit(format).alias("format"), name, "path"))


def ingest(
    source: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    route: str = "route",
    success: str = "success",
    on_progress: Callable[[dict], None] | None = None,
    keep_going: bool = False,
) -> StreamingQuery:
    """Run ``process`` on each micro-batch and write its rows by route, then a report row.

    Rows go to ``out/records/batch_id=N/<route>=...`` and the report to ``out/reports/batch_id=N``;
    a batch that runs again after a failure replaces its own folders. ``out`` and ``checkpoint``
    belong together: a new checkpoint numbers its batches from 0 and needs a new ``out``. The
    report has the start and end of the batch and counts observed while its rows are written: nothing runs or is read twice. With ``keep_going`` a batch that fails is stored
    as it came under ``out/failed`` and reported, and the stream moves on.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder, started, error = f"batch_id={batch_id}", datetime.now(UTC), None
        try:
            done = process(batch)
            counts = _written(done, F.count_if(success), lambda w: w.partitionBy(route).parquet(f"{out}/records/{folder}"))
        except Exception as e:
            if not keep_going:
                raise
            error = str(e)
            counts = _written(batch, F.lit(0) * F.count("*"), lambda w: w.parquet(f"{out}/failed/{folder}"))
        total, good = counts["total"], counts["good"]
        row = (batch_id, total, good, total - good, "completed" if error is None else "failed", started, datetime.now(UTC), error)
        report = spark.createDataFrame([row], REPORT)
        report.drop("batch_id").write.mode("overwrite").parquet(f"{out}/reports/{folder}")
        if on_progress:
            try:
                on_progress(report.first().asDict())
            except Exception:  # a broken callback must not stop the stream
                pass

    return (
        source.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _written(df: DataFrame, good: Column, write: Callable[[DataFrameWriter], None]) -> dict[str, int]:
    """Write ``df`` and count its rows on the way."""
    seen = Observation()
    write(df.observe(seen, F.count("*").alias("total"), good.alias("good")).write.mode("overwrite"))
    return seen.get


def append_json(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of a stream to JSON lines files, each exactly once."""
    writer = rows.writeStream.format("json").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(path)


def read_reports(spark: SparkSession, out: str) -> DataFrame:
    """The report rows of all batches so far."""
    return spark.read.schema(REPORT).parquet(f"{out}/reports")


def read_records(spark: SparkSession, out: str, schema) -> DataFrame:
    """The rows of all batches so far, with their ``batch_id``."""
    return spark.read.schema(schema).option("basePath", f"{out}/records").parquet(f"{out}/records")

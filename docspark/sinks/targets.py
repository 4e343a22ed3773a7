"""Targets: JSON files, SQL tables, and a caller's own function.

Any object with ``write(df, batch_id) -> load log`` can be used as a sink. Writes name their batch,
so running a batch again replaces it instead of adding to it (files), or is visible as such (SQL).
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators.batches import MAX_RETRIES, RETRY_DELAY, delivery_outcome
from docspark.session import materialize
from docspark.sinks.records import api_payload, envelope, table_rows, written

NO_ID = "Record has no document id"
ATTEMPTS = pa.schema([("record", pa.int64()), ("document_id", pa.string()), ("attempt", pa.int32()), ("status", pa.int32()), ("error", pa.string())])


class Sink(Protocol):
    def write(self, df: DataFrame, batch_id: str) -> DataFrame: ...


@dataclass(frozen=True)
class JsonSink:
    """JSON lines below ``path/batch=<id>``; with ``per_document`` one folder per document.

    One file per document suits small audited sets only; otherwise the files follow the partitions.
    """

    path: str
    fields: list[str] | None = None
    per_document: bool = False

    def write(self, df: DataFrame, batch_id: str) -> DataFrame:
        target = f"{self.path.rstrip('/')}/batch={batch_id}"
        writer = envelope(df, self.fields).write.mode("overwrite")
        if self.per_document:
            # the id is also kept inside the file
            writer = envelope(df, self.fields).withColumn("id", F.col("document_id")).write.mode("overwrite").partitionBy("id")
        writer.json(target)
        return written(df.sparkSession.read.schema("document_id string").json(target), target)


@dataclass(frozen=True)
class StagedSink:
    """JSON lines that count only once their batch is committed, with a status per row.

    A batch is written to a folder of its own attempt, refused rows with their reason, the others with their data; then one small
    file named after the batch says which attempt counts. It is created only if it is not there (one atomic step on
    file systems such as HDFS), so of two attempts at a batch, one after the other or at the same time, one counts: the later
    gets the log of the first. A job that fails before the commit leaves rows that nothing reads. ``refuse`` gives the
    reason to refuse a row, or null. Rows without document id are refused.
    """

    path: str
    fields: list[str] | None = None
    refuse: Callable[[DataFrame], Column] | None = None

    def write(self, df: DataFrame, batch_id: str) -> DataFrame:
        spark = df.sparkSession
        if self._committed(spark, batch_id) is None:
            attempt = uuid.uuid4().hex
            reason = F.when(F.col("document_id").isNull(), NO_ID)
            reason = F.coalesce(reason, self.refuse(df)) if self.refuse else reason
            marked = envelope(df.withColumn("_reason", reason), self.fields, F.col("_reason")).withColumnRenamed("loaded_at", "error")
            ok = F.col("error").isNull()
            rows = marked.select("document_id", F.when(ok, F.col("data")).alias("data"), ok.alias("success"), "error")
            rows.write.json(f"{self._root}/rows/batch={batch_id}/attempt={attempt}")
            self._commit(spark, batch_id, attempt)
        log = self.read(spark, "document_id string, success boolean, error string", self._committed(spark, batch_id), batch_id)
        return log.select("document_id", F.lit(self._root).alias("destination"), "success", F.col("success").cast("int").alias("records_written"), "error")

    def read(self, spark: SparkSession, schema: str, attempt: str | None = None, batch_id: str | None = None) -> DataFrame:
        """Rows of all committed batches, or of one attempt: the columns of ``schema`` and the batch."""
        if attempt is not None:
            return spark.read.schema(schema).json(f"{self._root}/rows/batch={batch_id}/attempt={attempt}")
        rows = spark.read.schema(f"{schema}, batch string, attempt string").json(f"{self._root}/rows")
        done = spark.read.option("wholetext", "true").text(f"{self._root}/commits")
        done = done.select(F.regexp_extract(F.col("_metadata.file_path"), r"batch=([^/]+)\z", 1).alias("batch"), F.col("value").alias("attempt"))
        return rows.join(done, ["batch", "attempt"], "left_semi").drop("attempt")

    @property
    def _root(self) -> str:
        return self.path.rstrip("/")

    def _file(self, spark: SparkSession, batch_id: str):
        file = spark._jvm.org.apache.hadoop.fs.Path(f"{self._root}/commits/batch={batch_id}")
        return file, file.getFileSystem(spark._jsc.hadoopConfiguration())

    def _committed(self, spark: SparkSession, batch_id: str) -> str | None:
        file, system = self._file(spark, batch_id)
        return spark.read.option("wholetext", "true").text(file.toString()).first()["value"] if system.exists(file) else None

    def _commit(self, spark: SparkSession, batch_id: str, attempt: str) -> None:
        file, system = self._file(spark, batch_id)
        try:
            out = system.create(file, False)
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return  # another attempt was first
        out.write(bytearray(attempt.encode()))
        out.close()


@dataclass(frozen=True)
class JdbcSink:
    """Append to a SQL table through JDBC, one transaction per partition.

    A task that is tried again has its open transaction rolled back; to make a whole batch
    repeatable, load a staging table named after the batch and merge it in the database.
    """

    url: str
    table: str
    fields: list[str] | None = None
    schema_name: str = ""
    properties: dict[str, str] = field(default_factory=dict)
    batch_size: int = 1000

    def write(self, df: DataFrame, batch_id: str) -> DataFrame:
        rows = table_rows(df, self.fields, self.schema_name)
        rows.write.format("jdbc").mode("append").options(
            url=self.url, dbtable=self.table, batchsize=str(self.batch_size), **self.properties
        ).save()
        return written(df, f"{self.table}@{self.url.split('@')[-1] if '@' in self.url else 'local'}")


@dataclass(frozen=True)
class FunctionSink:
    """Hand every record to a caller's function, with retries and a cap on the rate.

    ``make`` runs once per task and returns ``send(payload) -> (status, text)``. Every attempt is
    logged and written once, under a number that every record has for itself (equal documents share
    an id); the outcome per record is then an aggregation over that log.
    ``rate_per_second`` is shared out evenly among the tasks that can run at once. A task may run
    twice, so the receiver should treat the document id as a key.
    """

    make: Callable[[], Callable[[str], tuple[int | None, str | None]]]
    destination: str
    fields: list[str] | None = None
    max_retries: int = MAX_RETRIES
    delay: float = RETRY_DELAY
    tasks: int | None = None
    rate_per_second: float = 10.0

    def attempts(self, df: DataFrame) -> DataFrame:
        rows = df.select("document_id", api_payload(self.fields).alias("payload"))
        rows = rows.repartition(self.tasks) if self.tasks else rows
        rows = rows.select(F.monotonically_increasing_id().alias("record"), "document_id", "payload")
        make, retries, delay = self.make, self.max_retries, self.delay
        at_once = df.sparkSession.sparkContext.defaultParallelism
        at_once = min(self.tasks, at_once) if self.tasks else at_once
        pause = at_once / self.rate_per_second if self.rate_per_second else 0.0

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            send, last = make(), 0.0
            for batch in batches:
                log = []
                for record, doc, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                    for attempt in range(retries):
                        if pause:
                            time.sleep(max(0.0, last + pause - time.monotonic()))
                            last = time.monotonic()
                        try:
                            status, text = send(payload)
                        except Exception as e:  # a transport error counts as an attempt
                            status, text = None, str(e)
                        log.append({"record": record, "document_id": doc, "attempt": attempt, "status": status, "error": text})
                        retry = status is None or status == 429 or status >= 500
                        if not retry or attempt == retries - 1:
                            break
                        time.sleep(delay * 2**attempt)
                yield pa.RecordBatch.from_pylist(log, schema=ATTEMPTS)

        return rows.mapInArrow(run, "record long, document_id string, attempt int, status int, error string")

    def write(self, df: DataFrame, batch_id: str) -> DataFrame:
        log = materialize(self.attempts(df), f"attempts-{batch_id}")
        outcome = delivery_outcome(log, ["record", "document_id"], max_retries=self.max_retries, delay=self.delay)
        return outcome.select(
            "document_id", F.lit(self.destination).alias("destination"), "success", "records_written", "error"
        )

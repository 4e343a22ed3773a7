"""Batches, sinks, delivery, streaming, and the flow with a model."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators.batches import assign_batches, batch_results, delivery_outcome as outcome, progress, seconds
from docspark.operators.clean import FieldRule
from docspark.operators.dedup import dedup_stream
from docspark.operators.extract import ExtractionSchema
from docspark.operators.ledger import ReplyLedger, prompt_key
from docspark.operators.quality import LOAD, THRESHOLDS, reply_agreement
from docspark.plans.parse_queries import written_files
from docspark.plans.flow import DocumentFlow, FlowResult, run_errors
from docspark.plans.quality_queries import SQL_JUDGED, SQL_PAGES, checked_pages, judged
from docspark.plans.registry import query, table
from docspark.session import materialize, scratch_dir
from docspark.sinks.records import api_payload as payload, load_log as log_of, skipped, table_rows as rows_of
from docspark.sinks.targets import FunctionSink, JsonSink, StagedSink
from docspark.sources.documents import as_documents, parse
from docspark.sources.tables import spread
from docspark.streaming.ingest import append_json, document_files, file_stream, ingest, read_records, read_reports, table_stream

# ---- batches ----

SQL_BATCHES = "SELECT doc_id, n_chars, (row_number() OVER (ORDER BY doc_id) - 1) // 10 AS batch_id FROM documents"


@query("batch_assign", f"SELECT doc_id, batch_id FROM ({SQL_BATCHES})")
def batch_assign(spark: SparkSession, sf: str) -> DataFrame:
    return assign_batches(table(spark, sf, "documents").select("doc_id"), 10, ["doc_id"])


SQL_RESULTS = """SELECT batch_id, total_documents, CASE WHEN crashed THEN 0 ELSE ok END AS successful, CASE WHEN crashed THEN total_documents ELSE total_documents - ok END AS failed,
    CASE WHEN crashed THEN 'failed' ELSE 'completed' END AS status, started, ended, (ended - started) / 1e6 AS elapsed_seconds, error
  FROM (SELECT batch_id, count(*) AS total_documents, count(*) FILTER (event_type <> 'error') AS ok, bool_or(event_type = 'error' AND value > 150) AS crashed,
          epoch_us(min(ts)) AS started, epoch_us(max(ts)) AS ended, arg_min(props, (ts, props)) FILTER (event_type = 'error') AS error
        FROM (SELECT *, (row_number() OVER (ORDER BY event_id) - 1) // 3 AS batch_id FROM events) GROUP BY batch_id)"""


def event_batches(spark: SparkSession, sf: str) -> DataFrame:
    """Results of batches of three events: an error event fails, one of a high value takes its batch with it."""
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value", "props")
    failed = F.col("event_type") == "error"
    marked = assign_batches(events, 3, ["event_id"]).withColumns(
        {"success": ~failed, "crash": failed & (F.col("value") > 150), "error": F.when(failed, F.col("props"))}
    )
    return batch_results(marked, crashed="crash", at="ts", error="error")


@query("batch_report", f"SELECT batch_id, total_documents, successful, failed, status, elapsed_seconds, error FROM ({SQL_RESULTS})")
def batch_report(spark: SparkSession, sf: str) -> DataFrame:
    results = event_batches(spark, sf)
    return results.select("batch_id", "total_documents", "successful", "failed", "status", seconds(F.col("started"), F.col("ended")).alias("elapsed_seconds"), "error")


@query(
    "batch_progress",
    f"""SELECT sum(total_documents)::BIGINT AS processed, sum(successful)::BIGINT AS successful, sum(failed)::BIGINT AS failed, count(*) AS batches,
          100.0::DOUBLE AS progress_percent, round_even(sum(total_documents) / ((max(ended) - min(started)) / 1e6), 2)::DOUBLE AS documents_per_second FROM ({SQL_RESULTS})""",
)
def batch_progress(spark: SparkSession, sf: str) -> DataFrame:
    return progress(event_batches(spark, sf))


# ---- sinks ----


@query(
    "load_log",
    f"""SELECT doc_id::VARCHAR AS document_id, CASE WHEN passed THEN 'notes' ELSE 'skipped' END AS destination, passed AS success, passed::INT AS records_written,
          CASE WHEN NOT passed THEN 'Quality validation failed' END AS error FROM ({SQL_JUDGED})""",
)
def load_log(spark: SparkSession, sf: str) -> DataFrame:
    return log_of(judged(spark, sf).withColumn("document_id", F.col("doc_id").cast("string")), "notes")


@query(
    "api_payload",
    """SELECT '{"document_id":"' || c_custkey || '","data":{"name":"' || c_name || '","balance":' || c_acctbal || ',"segment":"' || c_mktsegment || '"}}' AS payload FROM customer""",
)
def api_payload(spark: SparkSession, sf: str) -> DataFrame:
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("document_id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment")
    )
    return customers.select(payload(["name", "balance", "segment"]).alias("payload"))


@query(
    "sink_table_rows",
    f"""SELECT doc_id::VARCHAR AS document_id, '{{"lang":"' || lang || '","doc_id":' || doc_id || '}}' AS data, 'note' AS schema_name, overall AS quality_score,
          '{{"lang":"' || lang || '"}}' AS metadata FROM ({SQL_JUDGED}) WHERE passed""",
)
def sink_table_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as the SQL target stores them (the JDBC write itself needs a database)."""
    done = materialize(judged(spark, sf), "judged").filter("passed").withColumns(
        {"document_id": F.col("doc_id").cast("string"), "metadata": F.create_map(F.lit("lang"), F.col("lang"))}
    )
    return rows_of(done, ["lang", "doc_id"], "note").drop("loaded_at")


@query(
    "sink_json",
    f"""SELECT doc_id::VARCHAR AS document_id, lang, CASE WHEN passed THEN text END AS text, passed AS success FROM ({SQL_JUDGED})""",
)
def sink_json(spark: SparkSession, sf: str) -> DataFrame:
    """Passed records written as JSON lines and read back, beside the log of all records."""
    done = materialize(judged(spark, sf).withColumn("document_id", F.col("doc_id").cast("string")), "judged")
    path = scratch_dir(spark, "json")
    sink = JsonSink(path, ["lang", "text"])
    log = sink.write(done.filter(F.col("route") == LOAD), "0").unionByName(skipped(done.filter(F.col("route") != LOAD)))
    stored = spark.read.schema("document_id string, data struct<lang:string,text:string>").json(f"{path}/batch=0")
    langs = done.select("document_id", "lang")
    return (
        log.select("document_id", "success").join(langs, "document_id")
        .join(stored.select("document_id", "data.text"), "document_id", "left").select("document_id", "lang", "text", "success")
    )


@query(
    "sink_staged",
    """SELECT 'notes-' || (doc_id % 2) AS batch, doc_id::VARCHAR AS document_id, CASE WHEN length(text) <= 2000 THEN text END AS text, length(text) <= 2000 AS success,
         CASE WHEN length(text) > 2000 THEN 'Text of ' || length(text) || ' characters' END AS error FROM documents""",
)
def sink_staged(spark: SparkSession, sf: str) -> DataFrame:
    """Two batches, of which one runs twice: every row once, refused ones with their reason."""
    docs = table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("document_id"), "text")
    size = F.length("text")
    too_long = F.when(size > 2000, F.concat(F.lit("Text of "), size.cast("string"), F.lit(" characters")))
    sink = StagedSink(scratch_dir(spark, "staged"), ["text"], lambda df: too_long)
    for k in (0, 1, 1):
        sink.write(docs.filter(F.col("doc_id") % 2 == k), f"notes-{k}")
    return sink.read(spark, "document_id string, data struct<text:string>, success boolean, error string").select("batch", "document_id", "data.text", "success", "error")


def flaky_target():
    """Answers by the customer number in the payload: accepted, busy once, broken, refused, unreachable."""
    seen: dict[str, int] = {}

    def send(body: str) -> tuple[int | None, str | None]:
        doc = json.loads(body)["document_id"]
        attempt = seen[doc] = seen.get(doc, -1) + 1
        kind = int(doc) % 6
        if kind == 0:
            return 201, None
        if kind == 1:
            return (429, "busy") if attempt == 0 else (200, None)
        if kind == 2:
            return 503, "down"
        if kind == 3:
            return 404, "no such place " + "x" * 300
        if kind == 4 and attempt == 2:
            raise ConnectionError("unreachable")
        return (500, "oops") if attempt < 2 else (202, None)

    return send


@query(
    "sink_function",
    """SELECT c_custkey::VARCHAR AS document_id, 'target' AS destination, c_custkey % 6 IN (0, 1, 5) AS success, (c_custkey % 6 IN (0, 1, 5))::INT AS records_written,
         CASE c_custkey % 6 WHEN 2 THEN 'Max retries exceeded' WHEN 3 THEN 'HTTP 404: no such place ' || repeat('x', 300) WHEN 4 THEN 'unreachable' END AS error FROM customer""",
)
def sink_function(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer handed to a caller's function, with retries; outcome per record."""
    customers = table(spark, sf, "customer", spread=True).select(F.col("c_custkey").cast("string").alias("document_id"), "c_name")
    sink = FunctionSink(flaky_target, "target", ["c_name"], delay=0.0, rate_per_second=0.0)
    return sink.write(customers, "0")


SQL_ATTEMPTS = """SELECT event_id // 4 AS document_id, (event_id % 4)::INT AS attempt, event_type AS error,
    CASE user_id % 7 WHEN 0 THEN 200 WHEN 1 THEN 429 WHEN 2 THEN 503 WHEN 3 THEN 404 WHEN 4 THEN NULL WHEN 5 THEN 500 ELSE 202 END AS status FROM events"""


@query(
    "delivery_outcome",
    f"""WITH a AS ({SQL_ATTEMPTS}), r AS (SELECT *, (status IS NULL OR status = 429 OR status >= 500) AS retry FROM a),
        t AS (SELECT document_id, coalesce(min(attempt) FILTER (NOT retry), max(attempt)) AS ended FROM r GROUP BY document_id),
        j AS (SELECT r.*, ended FROM r JOIN t USING (document_id) WHERE attempt <= ended),
        o AS (SELECT document_id, count(*)::INT AS attempts, coalesce(sum(CASE WHEN retry AND attempt < ended THEN 2.0 ** attempt END), 0.0)::DOUBLE AS waited_seconds,
                max(status) FILTER (attempt = ended) AS code, max(error) FILTER (attempt = ended) AS said FROM j GROUP BY document_id)
        SELECT document_id, coalesce(code, 0) IN (200, 201, 202) AS success, attempts, waited_seconds, (coalesce(code, 0) IN (200, 201, 202))::INT AS records_written,
          CASE WHEN coalesce(code, 0) IN (200, 201, 202) THEN NULL WHEN code IS NULL THEN said ELSE 'HTTP ' || code || ': ' || said END AS error FROM o""",
)
def delivery_outcome(spark: SparkSession, sf: str) -> DataFrame:
    log = table(spark, sf, "events").select(
        F.floor(F.col("event_id") / 4).alias("document_id"), (F.col("event_id") % 4).cast("int").alias("attempt"), F.col("event_type").alias("error"),
        F.expr("case user_id % 7 when 0 then 200 when 1 then 429 when 2 then 503 when 3 then 404 when 4 then null when 5 then 500 else 202 end").alias("status"),
    )
    return outcome(log)


# ---- streaming ----


@query("stream_pages", f"SELECT page_id, host, title, links::INT AS links_count, route FROM ({SQL_PAGES})")
def stream_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The page flow as a stream: same operators, rows read back from what the stream stored."""
    work = scratch_dir(spark, "stream")
    source = table_stream(spark, f"{sf}/pages.parquet", "page_id bigint, url string, html string")
    shown = ["page_id", "host", "title", "links_count", "success", "route"]
    ingest(source, lambda df: checked_pages(spread(df)).select(*shown), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    done = read_records(spark, f"{work}/out", "page_id bigint, host string, title string, links_count int, success boolean, route string")
    return done.select("page_id", "host", "title", "links_count", "route")


@query("stream_report", "SELECT 0::BIGINT AS batch_id, count(*) AS total_documents, count(*) FILTER (n_chars % 4 <> 0) AS successful, count(*) FILTER (n_chars % 4 = 0) AS failed, 'completed' AS status FROM documents")
def stream_report(spark: SparkSession, sf: str) -> DataFrame:
    """Progress of a document stream: one row, as one batch takes all files of the table."""
    work = scratch_dir(spark, "stream")
    source = table_stream(spark, f"{sf}/documents.parquet", "doc_id bigint, n_chars bigint", files_per_batch=None)
    mark = lambda df: df.withColumns({"success": F.col("n_chars") % 4 != 0, "route": F.lit(LOAD)})
    ingest(source, mark, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return read_reports(spark, f"{work}/out").select("batch_id", "total_documents", "successful", "failed", "status")


@query("stream_dedup", "SELECT user_id, event_type, value FROM events GROUP BY ALL")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Events that come in waves, a part of them once more in the next wave and late: each record once."""
    work = scratch_dir(spark, "dedup")
    events = table(spark, sf, "events").select(F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value", "event_id")
    events = events.withColumn("wave", F.floor((F.dayofmonth("ts") - 1) / 8))
    again = events.filter(F.col("event_id") % 3 == 0).withColumn("wave", F.col("wave") + 1)
    events.unionByName(again).drop("event_id").write.partitionBy("wave").parquet(f"{work}/in")
    schema = "ts timestamp, user_id bigint, event_type string, value double"
    source = file_stream(spark, f"{work}/in", schema, files_per_batch=2)
    fields = ["user_id", "event_type", "value"]
    append_json(dedup_stream(source, fields, "ts", "40 days").select(*fields), f"{work}/out", f"{work}/checkpoint").awaitTermination()
    return spark.read.schema("user_id bigint, event_type string, value double").json(f"{work}/out")


@query(
    "stream_documents",
    """SELECT bucket, sum(octet_length(encode(line)) + 1)::BIGINT + 9 AS size_bytes, count(*) AS row_count, 2 AS column_count
       FROM (SELECT o_orderkey // 5000 AS bucket, o_orderkey || ',"' || o_orderpriority || chr(10) || o_orderstatus || '"' AS line FROM orders) GROUP BY bucket""",
)
def stream_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Raw CSV files that arrive in a folder, 128 MB per micro-batch, parsed as one document each."""
    work = scratch_dir(spark, "files")
    line = F.concat(F.col("o_orderkey").cast("string"), F.lit(',"'), "o_orderpriority", F.lit("\n"), "o_orderstatus", F.lit('"'))
    orders = table(spark, sf, "orders").select(F.floor(F.col("o_orderkey") / 5000).alias("bucket"), F.col("o_orderkey").alias("place"), line.alias("record"))
    source = document_files(spark, written_files(orders, "key,note", f"{work}/in"), "csv", "*.txt")
    bucket = F.regexp_extract("path", "bucket=([0-9]+)", 1).cast("bigint").alias("bucket")

    def parsed(batch: DataFrame) -> DataFrame:
        done = parse(batch, formats=("csv",))
        counts = [F.col(f"metadata.{c}").cast(t).alias(c) for c, t in (("row_count", "bigint"), ("column_count", "int"))]
        return done.select(bucket, "size_bytes", *counts, F.col("parse_error").isNull().alias("success"), F.lit(LOAD).alias("route"))

    ingest(source, parsed, f"{work}/out", f"{work}/checkpoint").awaitTermination()
    done = read_records(spark, f"{work}/out", "bucket bigint, size_bytes bigint, row_count bigint, column_count int, success boolean, route string")
    return done.filter("success").select("bucket", "size_bytes", "row_count", "column_count")


# ---- the whole flow, on recorded replies ----

NOTE = ExtractionSchema(
    name="note",
    fields={"type": "object", "properties": {"heading": {"type": "string"}, "letters": {"type": "string"}}},
    columns={"heading": "string", "letters": "string", "kind": "string"},
)


def note_replies(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Recorded replies on the notes: heading and length of each text in printable ASCII, scores by the digits of the length.

    Every note has two attempts, of which the second counts; parse errors have a reply that is no JSON,
    tiny texts a failed call.
    """
    text = F.regexp_replace("content", r"[^\x20-\x7E\n\t]", " ")
    notes = documents.select("document_id", "format", text.alias("t"), F.explode(F.array(F.lit(0), F.lit(1))).alias("attempt"))
    fields = F.struct(
        F.concat(F.lit("  "), F.substring_index("t", "\n", 1), F.lit(" ")).alias("heading"), F.format_number(F.length("t"), 0).alias("letters"), F.lit("").alias("kind")
    )
    reply = F.concat(F.lit("```json\n"), F.to_json(fields), F.lit("\n```"))
    bad, tiny, last = F.col("format") == "text", F.length("t") < 40, F.col("attempt") == 1
    replies = notes.select(
        "document_id", "attempt", F.when(bad | ~last, "no idea").when(~tiny, reply).alias("reply"), F.when(~bad & tiny & last, "text too short").alias("call_error")
    )
    size = F.length("t")
    scores = F.format_string("COMPLETENESS: %s\nACCURACY: %s\nISSUES: %d", (size % 10 / 10).cast("string"), F.when(size % 3 != 0, "1.0").otherwise("0.2"), size)
    return replies, notes.select("document_id", "attempt", F.when(last, scores).otherwise("?").alias("reply"), F.lit(None).cast("string").alias("call_error"))


def note_flow() -> DocumentFlow:
    return DocumentFlow(
        schema=NOTE, clean_rules={"heading": FieldRule(uppercase=True)},
        mapping={"letters": "size"}, types={"size": "int"}, defaults={"kind": "note"}, thresholds=THRESHOLDS["development"],
        formats=("pdf",), stamp=False,
    )


def note_documents(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", spread=True).select(
        "doc_id", F.when(F.col("doc_id") % 5 == 4, "text").otherwise("pdf").alias("format"), F.translate("text", "\t", " ").alias("content")
    )
    return as_documents(docs, id="doc_id")


def run_notes(spark: SparkSession, sf: str, sink=None) -> FlowResult:
    notes = note_documents(spark, sf)
    replies, judgements = note_replies(notes)
    return note_flow().run(notes, sink=sink, replies=replies, judgements=judgements)


SQL_NOTES = r"""WITH t AS (SELECT doc_id, doc_id % 5 = 4 AS bad, regexp_replace(text, '[^\x20-\x7E\n\t]', ' ', 'g') AS t FROM documents),
  s AS (SELECT doc_id, bad, length(t) AS n, NOT bad AND length(t) >= 40 AS success,
     nullif(upper(trim(regexp_replace(string_split(t, chr(10))[1], ' {2,}', ' ', 'g'))), '') AS heading FROM t),
  q AS (SELECT *, CASE WHEN success THEN (n % 10) / 10 ELSE 0 END AS completeness, CASE WHEN success THEN CASE WHEN n % 3 <> 0 THEN 1.0 ELSE 0.2 END ELSE 0 END AS accuracy FROM s),
  p AS (SELECT *, success AND completeness >= 0.7 AND accuracy >= 0.9 AS passed, (completeness + accuracy) / 2 AS overall FROM q),
  r AS (SELECT *, NOT passed AND (NOT success OR overall > 0.5) AS flagged FROM p)"""


@query(
    "flow_records",
    f"""{SQL_NOTES} SELECT doc_id::VARCHAR AS document_id, success, CASE WHEN success THEN heading END AS heading, CASE WHEN success THEN n END AS size,
          CASE WHEN success THEN 'note' END AS kind, CASE WHEN success THEN 'pdf' END AS source_format,
          CASE WHEN NOT success AND NOT bad THEN 'text too short' END AS extract_error, completeness::DOUBLE AS completeness, accuracy::DOUBLE AS accuracy, overall::DOUBLE AS overall,
          CASE WHEN passed THEN 'load' WHEN flagged THEN 'review' ELSE 'reject' END AS route FROM r""",
)
def flow_records(spark: SparkSession, sf: str) -> DataFrame:
    """Parse, extract, clean, normalize, enrich, judge and route every document."""
    return run_notes(spark, sf).records.select(
        "document_id", "success", "data.heading", "data.size", "data.kind", F.col("data._source.format").alias("source_format"), "extract_error",
        "completeness", "accuracy", "overall", "route",
    )


@query(
    "flow_report",
    f"""{SQL_NOTES} SELECT count(*) AS total_documents, count(*) FILTER (passed) AS passed_count, count(*) FILTER (NOT passed AND NOT flagged) AS failed_count,
          count(*) FILTER (flagged) AS flagged_count, round_even(sum(completeness::DECIMAL(18,17))::DOUBLE / count(*), 3) AS average_completeness,
          round_even(sum(accuracy::DECIMAL(18,17))::DOUBLE / count(*), 3) AS average_accuracy, count(*) FILTER (passed) / count(*) AS pass_rate FROM r""",
)
def flow_report(spark: SparkSession, sf: str) -> DataFrame:
    return run_notes(spark, sf).report


@query(
    "flow_summary",
    f"""{SQL_NOTES} SELECT count(*) AS total_documents, count(*) FILTER (success) AS successful_extractions,
          count(*) FILTER (NOT success) AS failed_extractions, 'completed' AS status FROM r""",
)
def flow_summary(spark: SparkSession, sf: str) -> DataFrame:
    return run_notes(spark, sf).summary.drop("run_id")


@query(
    "flow_errors",
    f"""{SQL_NOTES} SELECT 'parse' AS stage, 'No parser available for format: text' AS error, count(*) AS documents FROM r WHERE bad HAVING count(*) > 0
        UNION ALL SELECT 'extract', 'text too short', count(*) FROM r WHERE NOT success AND NOT bad HAVING count(*) > 0""",
)
def flow_errors(spark: SparkSession, sf: str) -> DataFrame:
    """What went wrong in a run, and how often."""
    return run_errors(run_notes(spark, sf).records)


@query(
    "flow_batches",
    f"""{SQL_NOTES}, b AS (SELECT *, (row_number() OVER (ORDER BY doc_id::VARCHAR) - 1) // 50 AS batch_id FROM r)
        SELECT batch_id, count(*) AS total_documents, count(*) FILTER (success) AS successful, count(*) FILTER (NOT success) AS failed, 'completed' AS status FROM b GROUP BY batch_id""",
)
def flow_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The flow over numbered batches of 50 documents: one result row per batch."""
    notes = note_documents(spark, sf)
    replies, judgements = note_replies(notes)
    return note_flow().run_batches(notes, 50, ["document_id"], replies=replies, judgements=judgements).summary


@query(
    "flow_load_log",
    f"""{SQL_NOTES} SELECT doc_id::VARCHAR AS document_id, passed AS success, passed::INT AS records_written, CASE WHEN passed THEN NULL ELSE 'Quality validation failed' END AS error FROM r""",
)
def flow_load_log(spark: SparkSession, sf: str) -> DataFrame:
    """The flow with a JSON sink: one log row per document."""
    sink = JsonSink(scratch_dir(spark, "notes"))
    return run_notes(spark, sf, sink).load_log.drop("destination")


# ---- replies kept over runs ----

SETTINGS_TEXT = '["", {"max_tokens": 4096, "temperature": 0.1}]'


@query(
    "ledger_pending",
    """WITH p AS (SELECT doc_id, sha256('@S@' || chr(10) || 'Summarize: ' || text) AS prompt_key FROM documents),
         l AS (SELECT p.prompt_key, bool_or(quality = 1) AS answered FROM labels JOIN p USING (doc_id) GROUP BY p.prompt_key)
       SELECT prompt_key, count(*) AS documents FROM p WHERE prompt_key NOT IN (SELECT prompt_key FROM l WHERE answered) GROUP BY prompt_key""".replace("@S@", SETTINGS_TEXT),
)
def ledger_pending(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts still to ask after a run that answered those of the labelled documents of quality 1 and failed on the others."""
    ledger = ReplyLedger(scratch_dir(spark, "ledger"))
    prompts = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("Summarize: "), "text").alias("prompt"))
    keyed = materialize(prompts.select("doc_id", prompt_key(F.col("prompt")).alias("prompt_key")), "prompt-keys")
    run = keyed.join(table(spark, sf, "labels"), "doc_id").select(
        "prompt_key", F.when(F.col("quality") == 1, "good").alias("reply"), F.lit(1.0).alias("call_ms"), F.when(F.col("quality") != 1, "busy").alias("call_error")
    )
    ledger.record(run)
    pending = ledger.pending(prompts).select("prompt_key")
    return keyed.join(pending, "prompt_key").groupBy("prompt_key").agg(F.count("*").alias("documents"))


@query(
    "reply_consistency",
    """WITH r AS (SELECT user_id, event_type = 'error' AS bad, {'kind': event_type, 'size': CASE WHEN value > 50 THEN 'big' ELSE 'small' END, 'note': CASE WHEN value < 100 THEN props END} AS v FROM events),
         t AS (SELECT user_id, count(*) AS replies, count(*) FILTER (NOT bad) AS usable FROM r GROUP BY user_id),
         c AS (SELECT user_id, f.k AS k, f.v AS v, count(*) AS n
               FROM (SELECT user_id, unnest([{'k': 'kind', 'v': v.kind}, {'k': 'size', 'v': v.size}, {'k': 'note', 'v': v.note}]) AS f FROM r WHERE NOT bad) WHERE f.v IS NOT NULL GROUP BY ALL),
         m AS (SELECT user_id, k, max(n) AS most, sum(n) AS present FROM c GROUP BY ALL),
         s AS (SELECT user_id, count(*) AS fields, sum(greatest(most, usable - present))::BIGINT AS best FROM m JOIN t USING (user_id) GROUP BY user_id)
       SELECT user_id, replies, usable, coalesce(fields, 0) AS fields, CASE WHEN usable > 0 THEN best / (fields * usable) END AS consistency FROM t LEFT JOIN s USING (user_id)""",
)
def reply_consistency(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as one attempt to describe its user: how far the attempts agree; an error event is no JSON."""
    fields = F.struct(
        F.col("event_type").alias("kind"), F.when(F.col("value") > 50, "big").otherwise("small").alias("size"), F.when(F.col("value") < 100, F.col("props")).alias("note")
    )
    reply = F.when(F.col("event_type") == "error", "no idea").otherwise(F.to_json(fields))
    return reply_agreement(table(spark, sf, "events").select("user_id", reply.alias("reply")), "user_id")

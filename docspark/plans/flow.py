"""Documents to judged, routed records: parse, extract, transform, judge, load, report."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from datetime import UTC, datetime
from typing import Any, NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.operators.batches import assign_batches, batch_results
from docspark.operators.clean import FieldRule, clean
from docspark.operators.enrich import SetWhen, enrich
from docspark.operators.extract import (
    JUDGE_SETTINGS, CallSettings, ExtractionSchema, call_model, extraction_prompt, infer_columns,
    join_replies, judge_prompt, parse_reply, typed_fields,
)
from docspark.operators.ledger import ReplyLedger
from docspark.operators.normalize import normalize
from docspark.operators.quality import LOAD, Thresholds, judge, quality_report, skip_judging
from docspark.session import materialize
from docspark.sinks.records import failed, skipped
from docspark.sinks.targets import Sink
from docspark.sources.documents import PARSERS, parse

ASIDE = "__doc_"
NO_REPLY = "No recorded reply"
ERROR_COLUMNS = {"parse": "parse_error", "extract": "extract_error", "judge": "judge_error"}

Model = Callable[[], Callable[[str, CallSettings], str]]


class FlowResult(NamedTuple):
    parsed: DataFrame  # documents with their text
    records: DataFrame  # one row per document: its data, scores and route
    report: DataFrame  # quality report, one row per run or batch
    summary: DataFrame  # run result, one row per run or batch
    load_log: DataFrame | None  # one row per document when a sink was given
    started: datetime | None = None
    ended: datetime | None = None  # models have answered, the sink has written


@dataclass(frozen=True)
class DocumentFlow:
    """Configuration of a run; ``model`` and ``judge_model`` are made once per task (see ``call_model``)."""

    schema: ExtractionSchema
    model: Model | None = None  # none: every reply comes from a table given to run
    judge_model: Model | None = None
    clean_rules: Mapping[str, FieldRule] = field(default_factory=dict)
    mapping: Mapping[str, str] = field(default_factory=dict)
    types: Mapping[str, str] = field(default_factory=dict)
    defaults: Mapping[str, Any] = field(default_factory=dict)
    computed: Mapping[str, Any] = field(default_factory=dict)
    set_rules: tuple[SetWhen, ...] = ()
    thresholds: Thresholds = Thresholds()
    settings: CallSettings = CallSettings()
    text_passthrough: bool = False
    formats: tuple[str, ...] = tuple(PARSERS)
    carry: tuple[str, ...] = ()  # further document columns to keep
    tasks: int | None = None
    stamp: bool = True
    log_sink_errors: bool = False
    ledger: ReplyLedger | None = None  # remembers replies over runs

    def run(
        self,
        documents: DataFrame,
        sink: Sink | None = None,
        run_id: str | None = None,
        replies: DataFrame | None = None,
        judgements: DataFrame | None = None,
    ) -> FlowResult:
        """Run all stages on a documents table (see ``sources.documents.as_documents``).

        ``replies`` and ``judgements`` are tables of recorded replies (document_id, attempt, reply,
        call_error), of which the latest of each document counts; where they are given no model is asked.

        What the models return is parsed and written once, so the report, the log and any later
        action reuse it. Documents whose extraction failed skip the transforms and the judge but
        stay in the result. Sinks file their output under ``run_id``: give the same one to replace
        the output of an earlier run, none to add to it.
        """
        run_id, started = run_id or uuid.uuid4().hex, datetime.now(UTC)
        parsed = parse(documents, text_passthrough=self.text_passthrough, formats=self.formats)
        keep = ("document_id", "format", "metadata", "parse_error", *self.carry, "source_text")
        asked = parsed.withColumns(
            {
                "source_text": F.col("raw_content"),
                "prompt": extraction_prompt(F.col("raw_content"), self.schema),
            }
        )
        answered = parse_reply(self._replies(asked, self.model, keep, self.settings, replies)).drop("reply", "call_error").withColumnRenamed("call_ms", "extract_ms")
        extracted = materialize(answered, f"{run_id}-extracted")
        columns = self.schema.columns or infer_columns(extracted)

        good, fields = self._transform(extracted.filter("success"), columns)
        bad = extracted.filter("not success").drop("extracted")
        judged = materialize(self._judge(good, bad, fields, judgements), f"{run_id}-judged")

        log = self._load(judged, sink, run_id) if sink is not None else None
        return FlowResult(parsed, judged, quality_report(judged), run_summary(judged, run_id), log, started, datetime.now(UTC))

    def run_batches(
        self, documents: DataFrame, size: int, order: list[str], sink: Sink | None = None, run_id: str | None = None, **recorded: DataFrame
    ) -> FlowResult:
        """The same over numbered batches of ``size`` documents; report and summary have one row per batch.

        The batches are labels on one job, not jobs of their own: tasks follow the partitions.
        """
        flow = replace(self, carry=(*self.carry, "batch_id"))
        result = flow.run(assign_batches(documents, size, order), sink, run_id, **recorded)
        summary = batch_results(result.records)
        return result._replace(report=quality_report(result.records, ["batch_id"]), summary=summary)

    def _replies(self, asked: DataFrame, model: Model | None, keep: tuple[str, ...], settings: CallSettings, recorded: DataFrame | None) -> DataFrame:
        """The columns ``keep`` with reply, call_ms and call_error: from recorded replies, the ledger, or the model."""
        if recorded is not None:
            known = recorded.select("document_id", "attempt", "reply", "call_error")
            rows = join_replies(asked.select(*keep), known).withColumn("call_ms", F.lit(None).cast("double"))
            none = F.when(F.col("reply").isNull(), NO_REPLY)
            return rows.select(*keep, "reply", "call_ms", F.coalesce("call_error", none).alias("call_error"))
        if model is None:
            raise ValueError("a flow without a model needs recorded replies")
        ask = self.ledger.ask if self.ledger else call_model
        return ask(asked, model, keep=keep, settings=settings, tasks=self.tasks)

    def _load(self, judged: DataFrame, sink: Sink, run_id: str) -> DataFrame:
        """Write what passed and log every document; with ``log_sink_errors`` a failed write is logged, not raised."""
        ready = judged.filter(F.col("route") == LOAD)
        try:
            done = sink.write(ready, run_id)
        except Exception as e:
            if not self.log_sink_errors:
                raise
            done = failed(ready, str(e))
        return done.unionByName(skipped(judged.filter(F.col("route") != LOAD)))

    def _transform(self, df: DataFrame, columns: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
        """Clean, normalize and enrich the extracted fields into a ``data`` struct; returns the field names too.

        The document's own columns step aside meanwhile, so a field may have any name.
        """
        own = [c for c in df.columns if c != "extracted"]
        df = df.select("extracted", *[F.col(c).alias(ASIDE + c) for c in own])
        df = typed_fields(df.withColumnRenamed("extracted", f"{ASIDE}extracted"), columns, f"{ASIDE}extracted")
        df = clean(df.drop(f"{ASIDE}extracted"), self.clean_rules, list(columns))
        df = normalize(df, self.mapping, self.types, defaults=self.defaults)
        kept_text = {f"{t}_raw" for t in self.types}
        fields = [c for c in df.columns if not c.startswith(ASIDE) and c not in kept_text]
        df = enrich(df, fields, metadata=f"{ASIDE}metadata", computed=self.computed, rules=list(self.set_rules), stamp=self.stamp)
        data = F.struct(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(ASIDE)])
        return df.select(*[F.col(ASIDE + c).alias(c) for c in own], data.alias("data")), fields

    def _judge(self, good: DataFrame, bad: DataFrame, fields: list[str], judgements: DataFrame | None) -> DataFrame:
        bad = bad.drop("source_text")
        if self.judge_model is None and judgements is None:
            return skip_judging(good.drop("source_text").unionByName(bad, allowMissingColumns=True))
        record = {f: (F.col("data")[f], good.schema["data"].dataType[f].dataType) for f in fields}
        asked = good.withColumn("prompt", judge_prompt(F.col("source_text"), record)).drop("source_text")
        keep = tuple(c for c in asked.columns if c != "prompt")
        replies = self._replies(asked, self.judge_model, keep, JUDGE_SETTINGS, judgements)
        replies = replies.withColumnsRenamed({"reply": "judge_reply", "call_error": "judge_error", "call_ms": "judge_ms"})
        return judge(replies.unionByName(bad, allowMissingColumns=True), "judge_reply", self.thresholds)


def run_errors(records: DataFrame) -> DataFrame:
    """The errors of a run and how many documents have each: (stage, error, documents)."""
    kinds = [F.struct(F.lit(stage).alias("stage"), F.col(c).alias("error")) for stage, c in ERROR_COLUMNS.items() if c in records.columns]
    found = records.select(F.explode(F.array(*kinds)).alias("e")).filter("e.error is not null")
    return found.groupBy("e.stage", "e.error").agg(F.count("*").alias("documents"))


def run_summary(records: DataFrame, run_id: str) -> DataFrame:
    """One row on a finished run; it failed if it has documents and none of them succeeded."""
    total, good = F.count("*"), F.count_if("success")
    return records.agg(
        F.lit(run_id).alias("run_id"),
        F.count("*").alias("total_documents"),
        F.count_if("success").alias("successful_extractions"),
        F.count_if(~F.col("success")).alias("failed_extractions"),
        F.when((total > 0) & (good == 0), "failed").otherwise("completed").alias("status"),
    )

"""Model-backed extraction and judging: prompts, the model job, reply parsing, joining replies."""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.render import py_repr_fields
from docspark.functions.text import parse_float, strip
from docspark.operators.joins import left_join_unique

# --- Fixed values: prompt texts, call settings, reply keys and fallbacks ---
EXTRACT_HEAD = "Extract structured data from the following text.\n\n"
EXTRACT_TAIL = "Respond with ONLY valid JSON matching the schema."
JUDGE_HEAD = "Evaluate the quality of this data extraction.\n\n"
JUDGE_TAIL = (
    "Score on:\n"
    "1. COMPLETENESS (0-1): Are all relevant fields captured?\n"
    "2. ACCURACY (0-1): Are extracted values correct?\n"
    "3. ISSUES: List any problems found.\n\n"
    "Format:\nCOMPLETENESS: 0.X\nACCURACY: 0.X\nISSUES: list"
)
DEFAULT_SCORE = 0.5
FENCE = "```"


@dataclass(frozen=True)
class CallSettings:
    """Passed to the model function with every prompt."""

    max_tokens: int = 4096
    temperature: float = 0.1


JUDGE_SETTINGS = CallSettings(max_tokens=512, temperature=0.1)


@dataclass(frozen=True)
class ExtractionSchema:
    """What to extract: ``fields`` goes into the prompt, ``columns`` are the typed result columns.

    Without ``columns`` they are inferred from the replies (see ``infer_columns``).
    """

    name: str
    fields: Mapping[str, Any]
    columns: Mapping[str, str] | None = None
    instructions: str = ""
    version: str = "1.0"
    examples: tuple[Mapping[str, Any], ...] = ()


def extraction_prompt(text: Column, schema: ExtractionSchema) -> Column:
    """The prompt for one document with its whole text; everything but the text is a literal.

    A model with a small window gets its text in parts: see ``split_text`` and ``merge_parts``.
    """
    instructions = f"Instructions: {schema.instructions}" if schema.instructions else ""
    examples = ""
    if schema.examples:
        examples = "Examples:\n" + "\n".join(json.dumps(e) for e in schema.examples) + "\n\n"
    head = f"{EXTRACT_HEAD}Schema: {json.dumps(schema.fields, indent=2)}\n{instructions}\n\n{examples}Text:\n"
    return F.concat(F.lit(head), text, F.lit("\n\n" + EXTRACT_TAIL))


def judge_prompt(source: Column, record: dict[str, tuple[Column, T.DataType]]) -> Column:
    """The prompt asking for scores of a record against its source text; null fields are left out."""
    return F.concat(
        F.lit(JUDGE_HEAD + "Source text:\n"),
        source,
        F.lit("\n\nExtracted data:\n"),
        py_repr_fields(record, drop_null=True),
        F.lit("\n\n" + JUDGE_TAIL),
    )


def split_text(df: DataFrame, text: str, chars: int, overlap: int = 0) -> DataFrame:
    """One row per window of at most ``chars`` characters of ``text``, numbered in ``part`` from 0.

    Windows share ``overlap`` characters with the one before; together they hold the whole text. An
    empty or null text is one part. Other columns ride along.
    """
    if not 0 <= overlap < chars:
        raise ValueError("overlap must be smaller than the window")
    step = chars - overlap
    last = F.greatest(F.ceil((F.length(text) - chars) / step), F.lit(0))
    parts = F.sequence(F.lit(0).cast("bigint"), F.coalesce(last.cast("bigint"), F.lit(0).cast("bigint")))
    rows = df.withColumn("part", F.explode(parts))
    return rows.withColumn(text, F.substring(F.col(text), (F.col("part") * step + 1).cast("int"), F.lit(chars)))


def merge_parts(parsed: DataFrame, columns: Mapping[str, str], key: str = "document_id", part: str = "part") -> DataFrame:
    """Typed fields of the parts' replies to one row per document: of each field the value of its first part that has one.

    The aggregation keeps one value per field and document, so it combines before the shuffle.
    """
    typed = typed_fields(parsed, columns)
    first = [F.min_by(F.col(f"`{c}`"), F.when(F.col(f"`{c}`").isNotNull(), F.col(part))).alias(c) for c in columns]
    return typed.groupBy(key).agg(F.count("*").alias("parts"), F.count_if("success").alias("answered"), *first)


def call_model(
    df: DataFrame,
    make: Callable[[], Callable[[str, CallSettings], str]],
    prompt: str = "prompt",
    keep: tuple[str, ...] = ("document_id",),
    settings: CallSettings = CallSettings(),
    tasks: int | None = None,
) -> DataFrame:
    """Send ``prompt`` of every row to a model and add reply, call time and error.

    ``make`` runs once per task and returns the function to call, so a client is opened per task,
    not per row. Only ``keep`` and the prompt cross into Python. A failing call gives its row an
    error and no reply; the job goes on. ``tasks`` spreads (and bounds) the calls in flight.
    Write the result once (``session.materialize``): each new action would call the model again.
    """
    rows = df.select(*keep, prompt)
    if tasks:
        rows = rows.repartition(tasks)
    added = [("reply", T.StringType()), ("call_ms", T.DoubleType()), ("call_error", T.StringType())]
    schema = T.StructType([*rows.drop(prompt).schema.fields, *[T.StructField(n, t) for n, t in added]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()
        for batch in batches:
            replies, times, errors = [], [], []
            for text in batch.column(prompt).to_pylist():
                start = time.perf_counter()
                reply = error = None
                try:
                    reply = call(text, settings)
                except Exception as e:  # one bad call must not stop the job
                    error = str(e)
                replies.append(reply)
                errors.append(error)
                times.append((time.perf_counter() - start) * 1000)
            columns = [batch.column(n) for n in keep]
            columns += [pa.array(replies, pa.string()), pa.array(times, pa.float64()), pa.array(errors, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, [*keep, "reply", "call_ms", "call_error"])

    return rows.mapInArrow(run, schema)


def strip_fence(reply: Column) -> Column:
    """The reply without a surrounding code fence.

    The first line goes when the text opens with a fence; the last line goes when it opens with one.
    """
    text = strip(reply)
    inner = F.regexp_replace(text, r"\A```[^\n]*(?:\n|\z)", "")
    inner = F.regexp_replace(inner, r"(?:\A|\n)```[^\n]*\z", "")
    return F.when(text.startswith(FENCE), inner).otherwise(text)


def parse_reply(df: DataFrame, reply: str = "reply") -> DataFrame:
    """Add ``extracted`` (MAP of VARIANT), ``success`` and ``extract_error``.

    Success means a JSON object with at least one key. Trailing text after the object makes
    the reply invalid: it is parsed as the only item of a list.
    """
    df = df.withColumn("_json", strip_fence(F.coalesce(F.col(reply), F.lit(""))))
    df = df.withColumn("_json", F.try_parse_json(F.concat(F.lit("["), F.col("_json"), F.lit("]"))))
    only = F.try_variant_get(F.col("_json"), "$[1]", "variant").isNull()
    df = df.withColumn("_item", F.when(only, F.try_variant_get(F.col("_json"), "$[0]", "variant")))
    df = df.withColumn("extracted", F.col("_item").try_cast("map<string,variant>"))
    success = F.coalesce(F.size("extracted") > 0, F.lit(False))
    not_object = F.col("_item").isNotNull() & F.col("extracted").isNull()
    error = F.when(not_object, "reply is not a JSON object")
    if "call_error" in df.columns:
        success = success & F.col("call_error").isNull()
        error = F.coalesce(F.col("call_error"), error)
    return df.withColumns({"success": success, "extract_error": error}).drop("_json", "_item")


def infer_columns(df: DataFrame, extracted: str = "extracted") -> dict[str, str]:
    """Field names and types found in the parsed replies.

    The types are merged by an aggregation; one row comes to the driver. Numbers with a fraction
    are doubles, fields of mixed types are text.
    """
    records = df.filter(F.size(extracted) > 0).select(F.to_variant_object(extracted).alias("v"))
    found = records.agg(F.schema_of_variant_agg("v").alias("s")).first()["s"]
    if not found or not found.startswith("OBJECT<"):
        return {}
    merged = T.StructType.fromDDL(f"r {found.replace('OBJECT<', 'STRUCT<')}")["r"].dataType
    return {f.name: _plain_type(f.dataType).simpleString() for f in merged.fields}


def _plain_type(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.DecimalType):
        return T.DoubleType()
    if isinstance(dtype, (T.VariantType, T.NullType)):
        return T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_plain_type(dtype.elementType))
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _plain_type(f.dataType)) for f in dtype.fields])
    return dtype


def typed_fields(df: DataFrame, columns: Mapping[str, str], extracted: str = "extracted") -> DataFrame:
    """One typed column per declared field of the parsed reply; a value of another type gives null."""
    return df.withColumns(
        {
            name: F.try_variant_get(F.try_element_at(F.col(extracted), F.lit(name)), "$", dtype)
            for name, dtype in columns.items()
        }
    )


def _lines_of(reply: Column, key: str, parse: Callable[[Column], Column]) -> Column:
    """Values after ``key:`` of all lines where one can be read."""
    lines = F.split(reply, "\n")
    values = F.transform(
        F.filter(lines, lambda line: strip(F.upper(line)).startswith(f"{key}:")),
        lambda line: parse(strip(F.regexp_replace(line, r"(?s)\A[^:]*:", ""))),
    )
    return F.array_compact(values)


def _last_line(reply: Column, key: str, parse: Callable[[Column], Column]) -> Column:
    """The last of them."""
    return F.try_element_at(_lines_of(reply, key, parse), F.lit(-1))


def parse_judgement(reply: Column) -> dict[str, Column]:
    """completeness, accuracy (0.5 unless given) and all issues of a judge's reply."""
    reply = F.coalesce(reply, F.lit(""))
    return {
        "completeness": F.coalesce(_last_line(reply, "COMPLETENESS", parse_float), F.lit(DEFAULT_SCORE)),
        "accuracy": F.coalesce(_last_line(reply, "ACCURACY", parse_float), F.lit(DEFAULT_SCORE)),
        "issues": _lines_of(reply, "ISSUES", lambda c: c),
    }


def join_replies(docs: DataFrame, replies: DataFrame, order: str = "attempt", key: str = "document_id") -> DataFrame:
    """Attach pre-computed replies: the latest one per document, null where there is none.

    The reply table is cut to one row per document before the join (``max_by`` combines on the
    map side), so repeated replies neither multiply documents nor pile up in a task.
    """
    others = [c for c in replies.columns if c not in (key, order)]
    latest = replies.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_latest"))
    latest = latest.select(key, *[F.col(f"_latest.{c}").alias(c) for c in others])
    return left_join_unique(docs, latest, key)

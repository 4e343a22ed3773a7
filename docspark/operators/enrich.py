"""Enrichment: record hash, completeness, source info, computed and conditional fields, text analytics."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.guard import Guarded
from docspark.functions.render import sorted_json_fields
from docspark.functions.rows import literal
from docspark.functions.text import WORD, WS, word_count

# --- Fixed values: what the text analytics look for ---
EMAIL = rf"[{WORD}.-]@[{WORD}.-]+\.[{WORD}]"  # one character each side is enough, and keeps long words linear
PHONE = rf"\p{{Nd}}(?<![{WORD}]\p{{Nd}})\p{{Nd}}{{2}}[-.]?\p{{Nd}}{{3}}[-.]?\p{{Nd}}{{4}}(?![{WORD}])"
URL = rf"https?://[^{WS}]"

TEXT_STATS = "struct<length:int,word_count:int,has_email:boolean,has_phone:boolean,has_url:boolean>"


@dataclass(frozen=True)
class SetWhen:
    """Set fields when ``if_field`` equals a value."""

    if_field: str
    equals: Any
    then_set: Mapping[str, Any] = field(default_factory=dict)


def _col(name: str) -> Column:
    return F.col(f"`{name}`")


def record_hash(df: DataFrame, fields: list[str], presence: str = "non_null") -> Column:
    """SHA-256 of the record's sorted-key JSON, in hex."""
    columns = {n: (_col(n), df.schema[n].dataType) for n in fields}
    text = sorted_json_fields(columns, drop_null=presence == "non_null")
    return F.sha2(text, 256)


def field_count(fields: list[str], presence: str = "non_null") -> Column:
    """How many fields the record has."""
    if presence == "declared":
        return F.lit(len(fields))
    return reduce(lambda a, b: a + b, [_col(n).isNotNull().cast("int") for n in fields], F.lit(0))


def completeness(df: DataFrame, fields: list[str], presence: str = "non_null") -> Column:
    """Share of the record's fields that are filled, to 3 places; white space counts as filled."""

    def filled(name: str) -> Column:
        dtype = df.schema[name].dataType
        some = _col(name).isNotNull()
        if isinstance(dtype, T.StringType):
            some = some & (_col(name) != "")
        if isinstance(dtype, T.ArrayType):
            some = some & (F.size(_col(name)) > 0)
        return some.cast("int")

    n = field_count(fields, presence)
    total = reduce(lambda a, b: a + b, [filled(f) for f in fields], F.lit(0))
    return F.when(n > 0, F.bround(total / n, 3)).otherwise(F.lit(0.0))


def source_info(metadata: Column) -> Column:
    """Format and ingest time from a metadata map; null for an empty map."""
    return F.when(
        F.size(metadata) > 0,
        F.struct(
            F.coalesce(F.try_element_at(metadata, F.lit("parser")), F.lit("unknown")).alias("format"),
            F.coalesce(F.try_element_at(metadata, F.lit("ingested_at")), F.lit("")).alias("ingested_at"),
        ),
    )


def set_when(df: DataFrame, rules: list[SetWhen], presence: str = "non_null") -> DataFrame:
    """Apply the rules in order; a later rule sees what an earlier one set."""
    for rule in rules:
        if rule.if_field not in df.columns:
            continue
        hit = _equals(df, rule, presence)
        new = {}
        for target, value in rule.then_set.items():
            if target in df.columns:
                new[target] = F.when(hit, literal(value, df.schema[target].dataType, target)).otherwise(_col(target))
            else:
                new[target] = F.when(hit, F.lit(value))
        df = df.withColumns(new)
    return df


def _equals(df: DataFrame, rule: SetWhen, presence: str) -> Column:
    if rule.equals is None:
        return _col(rule.if_field).isNull() if presence == "declared" else F.lit(False)
    # text never equals a number
    if isinstance(df.schema[rule.if_field].dataType, T.StringType) != isinstance(rule.equals, str):
        return F.lit(False)
    return _col(rule.if_field).eqNullSafe(F.lit(rule.equals))


def text_stats(c: Column) -> Column:
    """Length, word count and e-mail, phone, URL hits of one text.

    Each pattern sits behind a plain substring test, which settles most texts without a regex.
    """
    return F.struct(
        F.length(c).alias("length"),
        word_count(c).alias("word_count"),
        (c.contains("@") & c.rlike(EMAIL)).alias("has_email"),
        c.rlike(PHONE).alias("has_phone"),
        (c.contains("://") & c.rlike(URL)).alias("has_url"),
    )


def add_text_analytics(df: DataFrame, fields: list[str], out: str = "_text_analytics", longer_than: int | None = None) -> DataFrame:
    """Add a MAP of field name to ``text_stats`` for the texts of the record; null when there are none.

    ``longer_than`` leaves out texts of at most so many characters.

    The stats get columns of their own first: they run in generated code, and only the assembly
    of the map, which is cheap, does not.
    """
    texts = [n for n in fields if isinstance(df.schema[n].dataType, T.StringType) and not n.startswith("_")]
    if not texts:
        return df.withColumn(out, F.lit(None).cast(f"map<string,{TEXT_STATS}>"))
    stats = {f"_stats_{i}": F.when(F.length(_col(n)) > (-1 if longer_than is None else longer_than), text_stats(_col(n))) for i, n in enumerate(texts)}
    df = df.withColumns(stats)
    entries = [
        F.when(F.col(s).isNotNull(), F.struct(F.lit(n).alias("key"), F.col(s).alias("value")))
        for s, n in zip(stats, texts)
    ]
    some = F.coalesce(*stats).isNotNull()
    return df.withColumn(out, F.when(some, F.map_from_entries(F.array_compact(F.array(*entries))))).drop(*stats)


def list_text_analytics(enriched: DataFrame, keys: list[str]) -> DataFrame:
    """One row per text of a record (outer explode plus filter, so nothing is evaluated twice)."""
    rows = enriched.select(*keys, F.explode_outer("_text_analytics").alias("field", "_stats"))
    return rows.filter(F.col("field").isNotNull()).select(*keys, "field", "_stats.*")


def enrich(
    df: DataFrame,
    fields: list[str],
    metadata: str | None = None,
    computed: Mapping[str, str | Callable[[DataFrame], Column] | Guarded] | None = None,
    rules: list[SetWhen] | None = None,
    presence: str = "non_null",
    stamp: bool = True,
    longer_than: int | None = None,
) -> DataFrame:
    """Add ``_enrichment``, ``_source``, computed and conditional fields and ``_text_analytics``.

    ``fields`` are the record's own columns; other columns ride along. Computed fields (a SQL
    expression, a function of the DataFrame, or a ``Guarded`` Python function of the record as a dict, whose
    failure leaves null and the reason in ``<field>_error``) see the record as it came in. With ``presence``
    "non_null" a null field counts as absent, with "declared" as present but empty.
    """
    info = [F.current_timestamp().alias("processed_at")] if stamp else []
    info += [
        record_hash(df, fields, presence).alias("record_hash"),
        field_count(fields, presence).alias("field_count"),
        completeness(df, fields, presence).alias("completeness"),
    ]
    before = set(df.columns)
    guarded = {n: f for n, f in (computed or {}).items() if isinstance(f, Guarded)}
    if guarded:  # each gets a column first, so that it is called once
        record = F.struct(*[_col(f) for f in fields])
        df = df.withColumns({f"_{n}_result": f(record) for n, f in guarded.items()})
    new: dict[str, Column] = {"_enrichment": F.struct(*info)}
    if metadata is not None:
        new["_source"] = source_info(_col(metadata))
    for name, how in (computed or {}).items():
        if name in guarded:
            new[name] = F.col(f"`_{name}_result`.value")
            new[f"{name}_error"] = F.col(f"`_{name}_result`.error")
            continue
        new[name] = F.expr(how) if isinstance(how, str) else how(df)
    df = set_when(df.withColumns(new).drop(*[f"_{n}_result" for n in guarded]), rules or [], presence)
    added = [n for n in df.columns if n not in before and n not in fields and n not in {f"{g}_error" for g in guarded}]
    return add_text_analytics(df, [*fields, *added], longer_than=longer_than)

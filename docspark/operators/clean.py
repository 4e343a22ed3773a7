"""Cleaning: white space, tags, case, dates, patterns, empty fields."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.dates import reformat_date
from docspark.functions.text import collapse_blanks, drop_tags, java_regex


@dataclass(frozen=True)
class FieldRule:
    """What to do with one field besides white-space cleaning; steps run in this order."""

    strip_html: bool = False
    lowercase: bool = False
    uppercase: bool = False
    date_format: str | None = None
    pattern: str | None = None


Rules = Mapping[str, FieldRule]
_NO_RULE = FieldRule()


def _text_steps(rule: FieldRule) -> list[Callable[[Column], Column]]:
    """The steps for one string. A step may use its input more than once, so inputs are bound first."""

    def whole_text(c: Column) -> Column:
        c = collapse_blanks(c)
        if rule.strip_html:
            c = drop_tags(c)
        if rule.lowercase:
            c = F.lower(c)
        return F.upper(c) if rule.uppercase else c

    steps = [whole_text]
    if rule.date_format:
        steps.append(lambda c: reformat_date(c, rule.date_format))
    if rule.pattern:
        pattern = java_regex(rule.pattern)
        steps.append(lambda c: F.when(c.rlike(pattern), F.regexp_extract(c, pattern, 0)).otherwise(c))
    steps.append(lambda c: F.when(c != "", c))
    return steps


def clean_value(c: Column, dtype: T.DataType, key: str, rules: Rules) -> Column:
    """Clean a value of any declared type; rules are looked up by the innermost field name."""
    if isinstance(dtype, T.StringType):
        first, *others = _text_steps(rules.get(key, _NO_RULE))
        # each result is bound to a lambda variable, so no step is evaluated twice
        return reduce(lambda acc, step: F.transform(F.array(acc), step)[0], others, first(c))
    if not _holds_text(dtype):
        return c
    if isinstance(dtype, T.StructType):
        fields = [clean_value(c.getField(f.name), f.dataType, f.name, rules).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(dtype, T.ArrayType):
        # null items go before cleaning; items that become empty stay as null
        return F.transform(
            F.filter(c, lambda x: x.isNotNull()), lambda x: clean_value(x, dtype.elementType, key, rules)
        )
    cleaned = F.transform_values(c, lambda k, v: _by_key(k, v, dtype.valueType, rules))
    return F.map_filter(cleaned, lambda k, v: v.isNotNull())


def _by_key(k: Column, v: Column, dtype: T.DataType, rules: Rules) -> Column:
    plain = clean_value(v, dtype, "", {})
    return reduce(lambda acc, name: F.when(k == name, clean_value(v, dtype, name, rules)).otherwise(acc), rules, plain)


def _holds_text(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_holds_text(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return True  # null items are dropped whatever the item type
    if isinstance(dtype, T.MapType):
        return True
    return isinstance(dtype, T.StringType)


def clean(df: DataFrame, rules: Rules | None = None, fields: list[str] | None = None) -> DataFrame:
    """Clean ``fields`` (default: all columns); a null field is an absent one.

    Strings at the top level go step by step through stacked projections, which Catalyst keeps
    apart where a step uses its input twice: each pattern runs once per value, in generated code.
    """
    rules = rules or {}
    names = fields if fields is not None else df.columns
    text = {n: _text_steps(rules.get(n, _NO_RULE)) for n in names if isinstance(df.schema[n].dataType, T.StringType)}
    nested = {n: clean_value(F.col(f"`{n}`"), df.schema[n].dataType, n, rules) for n in names if n not in text}
    if nested:
        df = df.withColumns(nested)
    for i in range(max((len(steps) for steps in text.values()), default=0)):
        df = df.withColumns({n: steps[i](F.col(f"`{n}`")) for n, steps in text.items() if i < len(steps)})
    return df


def present_count(columns: list[Column]) -> Column:
    """How many of the columns hold a value."""
    return reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in columns], F.lit(0))


def clean_summary(df: DataFrame, rules: Rules | None = None, fields: list[str] | None = None) -> DataFrame:
    """Cleaned fields plus ``original_fields`` and ``cleaned_fields`` counts per record."""
    names = fields if fields is not None else df.columns
    counted = df.withColumn("original_fields", present_count([F.col(f"`{n}`") for n in names]))
    cleaned = clean(counted, rules, names)
    return cleaned.withColumn("cleaned_fields", present_count([F.col(f"`{n}`") for n in names]))

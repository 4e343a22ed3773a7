"""Declarative validation rules, all evaluated in one pass over a record."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.guard import Guarded
from docspark.functions.render import py_str
from docspark.functions.text import is_blank, java_regex, parse_float
from docspark.operators.normalize import truthy

# --- Fixed values: severities and messages ---
ERROR, WARNING, INFO = "error", "warning", "info"
IS_REQUIRED = "Field '{}' is required"
BAD_FORMAT = "Field '{}' does not match expected format"
OUT_OF_RANGE = "Field '{}' is out of expected range"
NOT_NUMERIC = "Field '{}' is not numeric"
BELOW_MINIMUM = "below minimum"
ABOVE_MAXIMUM = "above maximum"
MUST_EQUAL = "'{}' must equal '{}'"
MUST_BE_GREATER = "'{}' must be greater than '{}'"
REQUIRED_WHEN_SET = "'{}' required when '{}' is set"
CUSTOM_ERROR = "Custom validation error"


@dataclass(frozen=True)
class Rule:
    """One check on one field. Errors make a record invalid, warnings flag it, infos only inform."""

    name: str
    field: str
    check: str  # required, format, range, custom, cross_field
    severity: str = ERROR
    message: str = ""
    pattern: str = ""
    min: float | None = None
    max: float | None = None
    other: str | None = None
    condition: str | None = None  # equals, greater_than, not_empty_if
    predicate: Callable[[Column], Column] | None = None  # or a Guarded Python function: one that fails makes a warning


def required(field: str, message: str = "", severity: str = ERROR) -> Rule:
    return Rule(f"required_{field}", field, "required", severity, message or IS_REQUIRED.format(field))


def matches(field: str, pattern: str, message: str = "", severity: str = ERROR) -> Rule:
    message = message or BAD_FORMAT.format(field)
    return Rule(f"format_{field}", field, "format", severity, message, pattern=pattern)


def in_range(field: str, min: float | None = None, max: float | None = None, message: str = "", severity: str = ERROR) -> Rule:
    message = message or OUT_OF_RANGE.format(field)
    return Rule(f"range_{field}", field, "range", severity, message, min=min, max=max)


VIOLATION = "struct<rule:string,field:string,severity:string,message:string,actual_value:string>"


class _Record:
    """Typed access to the fields of a DataFrame; an unknown field is null."""

    def __init__(self, df: DataFrame):
        self._schema = df.schema

    def get(self, name: str) -> tuple[Column, T.DataType]:
        if name in self._schema.names:
            return F.col(f"`{name}`"), self._schema[name].dataType
        return F.lit(None).cast("string"), T.StringType()


def _violation(rule: Rule, message: str | Column, actual: Column, severity: str | None = None) -> Column:
    return F.struct(
        F.lit(rule.name).alias("rule"),
        F.lit(rule.field).alias("field"),
        F.lit(severity or rule.severity).alias("severity"),
        (message if isinstance(message, Column) else F.lit(message)).alias("message"),
        actual.cast("string").alias("actual_value"),
    )


def _required(rule: Rule, record: _Record) -> Column:
    c, dtype = record.get(rule.field)
    missing = c.isNull() | is_blank(c) if isinstance(dtype, T.StringType) else c.isNull()
    return F.when(missing, _violation(rule, rule.message, py_str(c, dtype)))


def _format(rule: Rule, record: _Record) -> Column:
    c, dtype = record.get(rule.field)
    text = py_str(c, dtype)
    fits = text.rlike(rf"\A(?:{java_regex(rule.pattern)})")
    return F.when(c.isNotNull() & ~fits, _violation(rule, rule.message, text))


def _range(rule: Rule, record: _Record) -> Column:
    c, dtype = record.get(rule.field)
    actual = py_str(c, dtype)
    if isinstance(dtype, T.StringType):
        number = parse_float(c)
    elif isinstance(dtype, (T.NumericType, T.BooleanType)):
        number = c.cast("double")
    else:
        number = F.lit(None).cast("double")
    out = F.when(
        c.isNotNull() & number.isNull(), _violation(rule, NOT_NUMERIC.format(rule.field), actual)
    )
    shown = py_str(number, T.DoubleType())
    for bound, outside, word in ((rule.min, number < F.lit(rule.min), BELOW_MINIMUM),
                                 (rule.max, number > F.lit(rule.max), ABOVE_MAXIMUM)):
        if bound is not None:
            message = rule.message or F.concat(F.lit("Value "), shown, F.lit(f" {word} {bound}"))
            # not-a-number compares as largest in Spark but is never out of range
            out = out.when(~F.isnan(number) & outside, _violation(rule, message, actual))
    return out


def _custom(rule: Rule, record: _Record) -> Column | None:
    if rule.predicate is None:
        return None
    c, dtype = record.get(rule.field)
    ok = rule.predicate(c)
    actual = py_str(c, dtype)
    if isinstance(rule.predicate, Guarded):
        error = F.concat(F.lit(f"{CUSTOM_ERROR}: "), ok["error"])
        return F.when(error.isNotNull(), _violation(rule, error, actual, WARNING)).when(
            ~F.coalesce(ok["value"], F.lit(False)), _violation(rule, rule.message, actual)
        )
    return F.when(ok.isNull(), _violation(rule, CUSTOM_ERROR, actual, WARNING)).when(
        ~ok, _violation(rule, rule.message, actual)
    )


def _cross_field(rule: Rule, record: _Record) -> Column | None:
    if not rule.other or not rule.condition:
        return None
    (a, a_type), (b, b_type) = record.get(rule.field), record.get(rule.other)
    if rule.condition == "equals":
        message = rule.message or MUST_EQUAL.format(rule.field, rule.other)
        both = F.concat(
            F.coalesce(py_str(a, a_type), F.lit("None")), F.lit(" vs "), F.coalesce(py_str(b, b_type), F.lit("None"))
        )
        mixed = isinstance(a_type, T.StringType) != isinstance(b_type, T.StringType)
        same = a.isNull() & b.isNull() if mixed else a.eqNullSafe(b)  # text never equals a number
        return F.when(~same, _violation(rule, message, both))
    if rule.condition == "greater_than":
        message = rule.message or MUST_BE_GREATER.format(rule.field, rule.other)
        both = F.concat(py_str(a, a_type), F.lit(" vs "), py_str(b, b_type))
        if isinstance(a_type, T.StringType) != isinstance(b_type, T.StringType):
            a, b = a.try_cast("double"), b.try_cast("double")  # text that is no number compares with none
        return F.when(~(a > b), _violation(rule, message, both))
    if rule.condition == "not_empty_if":
        message = rule.message or REQUIRED_WHEN_SET.format(rule.other, rule.field)
        return F.when(truthy(a, a_type) & ~truthy(b, b_type), _violation(rule, message, py_str(b, b_type)))
    return None


CHECKS = {"required": _required, "format": _format, "range": _range, "custom": _custom, "cross_field": _cross_field}


def violations(df: DataFrame, rules: list[Rule]) -> list[Column]:
    """One nullable violation per rule, in rule order; rules with an unknown check are ignored."""
    record = _Record(df)
    found = [CHECKS[r.check](r, record) for r in rules if r.check in CHECKS]
    return [v for v in found if v is not None]


def validate(df: DataFrame, rules: list[Rule], out: str = "validation") -> DataFrame:
    """Add a struct ``out`` of valid, error_count, warning_count and violations.

    Each rule gets a column first, so that all checks run once and in generated code; counting
    and listing only look at those columns.
    """
    checks = {f"_{out}_{i}": v for i, v in enumerate(violations(df, rules))}
    df = df.withColumns(checks)

    def count(severity: str) -> Column:
        hits = [F.coalesce((F.col(c)["severity"] == severity).cast("int"), F.lit(0)) for c in checks]
        return reduce(lambda a, b: a + b, hits, F.lit(0))

    listed = F.array_compact(F.array(*checks)) if checks else F.array().cast(f"array<{VIOLATION}>")
    verdict = F.struct(
        (count(ERROR) == 0).alias("valid"),
        count(ERROR).alias("error_count"),
        count(WARNING).alias("warning_count"),
        listed.alias("violations"),
    )
    return df.withColumn(out, verdict).drop(*checks)


def list_violations(checked: DataFrame, keys: list[str], validation: str = "validation") -> DataFrame:
    """One row per violation.

    The outer form of explode plus a filter: for the plain form Spark infers a filter on the array
    and would evaluate every rule twice.
    """
    rows = checked.select(*keys, F.explode_outer(f"{validation}.violations").alias("_v"))
    return rows.filter(F.col("_v").isNotNull()).select(*keys, "_v.*")


def rule_route(validation: Column) -> Column:
    """Errors block loading, warnings ask for review."""
    return (
        F.when(validation["error_count"] > 0, "reject").when(validation["warning_count"] > 0, "review").otherwise("load")
    )

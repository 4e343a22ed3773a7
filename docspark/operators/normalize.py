"""Schema alignment: rename, coerce, custom transforms, defaults, strict column set."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.guard import Guarded
from docspark.functions.render import py_str
from docspark.functions.rows import literal
from docspark.functions.text import parse_float, strip

# --- Fixed values ---
TRUE_WORDS = ["true", "yes", "1", "y", "on"]
LIST_DELIMITERS = [",", ";", "|", "\n"]


def _without(c: Column, chars: str) -> Column:
    return F.translate(c, chars, "")


def to_float(c: Column, dtype: T.DataType) -> Column:
    """DOUBLE; commas, blanks and dollar signs in text are ignored, bad text is null."""
    if isinstance(dtype, T.StringType):
        return parse_float(_without(c, ", $"))
    return c.try_cast("double") if _is_number(dtype) else F.lit(None).cast("double")


def to_int(c: Column, dtype: T.DataType) -> Column:
    """BIGINT, cut towards zero; commas and blanks in text are ignored, bad text is null."""
    if isinstance(dtype, T.IntegralType):
        return c.cast("bigint")
    value = parse_float(_without(c, ", ")) if isinstance(dtype, T.StringType) else to_float(c, dtype)
    return F.when(~F.isnan(value), value).try_cast("bigint")


def to_bool(c: Column, dtype: T.DataType) -> Column:
    """BOOLEAN; for text only the listed words are true, other values by being non-empty; null stays null."""
    if isinstance(dtype, T.StringType):
        return strip(F.lower(c)).isin(TRUE_WORDS)
    return F.when(c.isNotNull(), truthy(c, dtype))


def to_list(c: Column, dtype: T.DataType) -> Column:
    """ARRAY: text is split at the first kind of delimiter it holds; other values become one item."""
    if isinstance(dtype, T.ArrayType):
        return c
    if not isinstance(dtype, T.StringType):
        return F.when(c.isNotNull(), F.array(c))
    out = F.when(c.isNotNull(), F.array(c))
    for delimiter in reversed(LIST_DELIMITERS):
        items = F.transform(F.split(c, f"[{delimiter}]"), strip)
        out = F.when(c.contains(delimiter), F.filter(items, lambda x: x != "")).otherwise(out)
    return out


COERCIONS: dict[str, Callable[[Column, T.DataType], Column]] = {
    "int": to_int,
    "float": to_float,
    "str": py_str,
    "bool": to_bool,
    "list": to_list,
}


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def truthy(c: Column, dtype: T.DataType) -> Column:
    """True unless the value is null, zero, false, or an empty string or collection."""
    if isinstance(dtype, T.BooleanType):
        some = c
    elif isinstance(dtype, T.NumericType):
        some = c != 0
    elif isinstance(dtype, T.StringType):
        some = c != ""
    elif isinstance(dtype, (T.ArrayType, T.MapType)):
        some = F.size(c) > 0
    else:
        some = c.isNotNull()
    return F.coalesce(some, F.lit(False))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename fields; when several end up under one name the last non-null one wins."""
    sources: dict[str, list[str]] = {}
    for name in df.columns:
        sources.setdefault(mapping.get(name, name), []).append(name)
    return df.select(
        *[F.coalesce(*[F.col(f"`{n}`") for n in reversed(names)]).alias(target) if len(names) > 1
          else F.col(f"`{names[0]}`").alias(target) for target, names in sources.items()]
    )


def coerce(df: DataFrame, types: Mapping[str, str], keep_raw: bool = True) -> DataFrame:
    """Cast fields to int, float, str, bool or list.

    A value that cannot be cast leaves the typed column null and stays readable in ``<field>_raw``
    (only int and float can fail). Unknown targets and unknown fields are left alone.
    """
    new: dict[str, Column] = {}
    for name, target in types.items():
        if name not in df.columns or target not in COERCIONS:
            continue
        c, dtype = F.col(f"`{name}`"), df.schema[name].dataType
        typed = COERCIONS[target](c, dtype)
        new[name] = typed
        if keep_raw and target in ("int", "float") and not isinstance(dtype, T.IntegralType):
            new[f"{name}_raw"] = F.when(typed.isNull(), py_str(c, dtype))
    return df.withColumns(new)


def transform_fields(df: DataFrame, transforms: Mapping[str, Callable[[Column], Column]]) -> DataFrame:
    """Apply a Column function, a pandas UDF or a ``Guarded`` Python function to each named field that exists.

    Where a guarded function fails the field keeps its value (as the function's type; null if it does not fit), and
    ``<field>_error`` says why.
    """
    plain = {n: f for n, f in transforms.items() if n in df.columns and not isinstance(f, Guarded)}
    guarded = {n: f for n, f in transforms.items() if n in df.columns and isinstance(f, Guarded)}
    df = df.withColumns({n: f(F.col(f"`{n}`")) for n, f in plain.items()})
    if not guarded:
        return df
    # the function's result gets a column first, so that it is called once
    df = df.withColumns({f"_{n}_result": f(F.col(f"`{n}`")) for n, f in guarded.items()})
    new: dict[str, Column] = {}
    for n, f in guarded.items():
        value, error = (F.col(f"`_{n}_result`.{part}") for part in ("value", "error"))
        new[n] = F.when(error.isNull(), value).otherwise(F.col(f"`{n}`").try_cast(f.returns))
        new[f"{n}_error"] = error
    return df.withColumns(new).drop(*[f"_{n}_result" for n in guarded])


def fill_defaults(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Give missing or null fields a default; "" is a value and stays.

    A field whose cast failed still has its original text, so it is not filled.
    """
    new: dict[str, Column] = {}
    for name, value in defaults.items():
        if name not in df.columns:
            new[name] = F.lit(value)
            continue
        c = F.col(f"`{name}`")
        filled = F.coalesce(c, literal(value, df.schema[name].dataType, name))
        if f"{name}_raw" in df.columns:
            filled = F.when(F.col(f"`{name}_raw`").isNull(), filled)
        new[name] = filled
    return df.withColumns(new)


def normalize(
    df: DataFrame,
    mapping: Mapping[str, str] | None = None,
    types: Mapping[str, str] | None = None,
    transforms: Mapping[str, Callable[[Column], Column]] | None = None,
    defaults: Mapping[str, Any] | None = None,
    only: list[str] | None = None,
) -> DataFrame:
    """Rename, coerce, transform, fill defaults; ``only`` then drops every other field."""
    df = rename(df, mapping or {})
    df = coerce(df, types or {})
    df = transform_fields(df, transforms or {})
    df = fill_defaults(df, defaults or {})
    return df.select(*only) if only else df

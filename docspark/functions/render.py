"""Values as text the way Python prints them: str(), repr() and sorted-key JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _float_text(c: Column) -> Column:
    """repr() of a double: positional between 1e-4 and 1e16, else d.ddde+XX."""
    s, size = c.cast("string"), F.abs(c)
    positional = F.regexp_replace(c.cast("decimal(38,22)").cast("string"), r"(\.[0-9]+?)0*\z", "$1")
    science = F.regexp_replace(F.regexp_replace(s, r"(?:\.0)?E(?=[0-9])", "e+"), r"(?:\.0)?E-", "e-")
    return (
        F.when((c == 0) | ((size >= 1e-3) & (size < 1e7)), s)  # no exponent in either language
        .when(F.isnan(c), "nan")
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when((size >= 1e-4) & (size < 1e16), positional)
        .otherwise(F.regexp_replace(science, r"e([+-])([0-9])\z", "e$10$2"))
    )


def _time_text(c: Column) -> Column:
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(c, "SSSSSS")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def _escape_runs(c: Column, bad: str, good: str, escape) -> Column:
    """Rewrite the runs of ``bad`` characters."""
    runs = F.regexp_extract_all(c, F.lit(f"{good}+|{bad}+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(rf"\A{good}"), r).otherwise(escape(r))), "")


def _utf16_escapes(run: Column) -> Column:
    return F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")


def _short_escapes(c: Column, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda acc, p: F.replace(acc, F.lit(p[0]), F.lit(p[1])), pairs, c)


# Characters with a short escape in JSON and in repr().
JSON_SHORT = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\f", "\\f"), ("\b", "\\b")]
REPR_SHORT = [("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")]


def _json_string(c: Column) -> Column:
    """A JSON string in ASCII: other characters as UTF-16 escapes, in lower case.

    Spark's own JSON writer does the common escapes; the few control characters it writes in
    upper case take the longer way.
    """
    quoted = F.to_json(F.array(c))
    body = F.substring(quoted, F.lit(3), F.length(quoted) - 4)
    body = (
        F.when(~c.rlike(r'[^ !#-\[\]-~]'), c)
        .when(c.rlike(r"[\x0b\x0e\x0f\x1a-\x1f]"), _escape_runs(_short_escapes(c, JSON_SHORT), "[^ -~]", "[ -~]", _utf16_escapes))
        .when(~c.rlike(r"[^\x00-~]"), body)
        .otherwise(_escape_runs(body, "[^ -~]", "[ -~]", _utf16_escapes))
    )
    return F.when(c.isNotNull(), F.concat(F.lit('"'), body, F.lit('"')))


def _repr_string(c: Column) -> Column:
    """repr() of a string: unprintable characters escaped, letters of every script kept."""
    short = _short_escapes(c, REPR_SHORT)
    bad, good = r"[\p{C}\p{Z}&&[^ ]]", r"[[^\p{C}\p{Z}] ]"
    to_hex = lambda run: F.regexp_replace(_utf16_escapes(run), r"\\u00", r"\\x")
    body = F.when(~c.rlike(r"[\p{C}\p{Z}\\&&[^ ]]"), c).otherwise(_escape_runs(short, bad, good, to_hex))
    double = F.concat(F.lit('"'), body, F.lit('"'))
    single = F.concat(F.lit("'"), F.replace(body, F.lit("'"), F.lit("\\'")), F.lit("'"))
    return F.when(c.contains("'") & ~c.contains('"'), double).otherwise(single)


def py_str(c: Column, dtype: T.DataType) -> Column:
    """str(value); null stays null."""
    if isinstance(dtype, T.StringType):
        return c
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return _float_text(c.cast("double"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _time_text(c)
    if isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        return F.when(c.isNotNull(), py_repr(c, dtype))
    return c.cast("string")


def py_repr(c: Column, dtype: T.DataType) -> Column:
    """repr(value); null is None."""
    if isinstance(dtype, T.StringType):
        text = _repr_string(c)
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda x: py_repr(x, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.StructType):
        text = F.when(c.isNotNull(), py_repr_fields({f.name: (c.getField(f.name), f.dataType) for f in dtype.fields}))
    elif isinstance(dtype, T.MapType):
        items = F.transform(
            F.map_entries(c),
            lambda e: F.concat(py_repr(e["key"], dtype.keyType), F.lit(": "), py_repr(e["value"], dtype.valueType)),
        )
        text = F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    else:
        text = py_str(c, dtype)
    return F.coalesce(text, F.lit("None"))


def py_repr_fields(fields: dict[str, tuple[Column, T.DataType]], drop_null: bool = False) -> Column:
    """repr() of a record given as columns; ``drop_null`` leaves null fields out."""
    parts = []
    for name, (c, dtype) in fields.items():
        part = F.concat(F.lit(repr(name) + ": "), py_repr(c, dtype))
        parts.append(F.when(c.isNotNull(), part) if drop_null else part)
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))


def sorted_json(c: Column, dtype: T.DataType) -> Column:
    """JSON text with keys sorted at every depth, ", " and ": " between parts; null is null.

    Two records give the same text exactly when they hold the same keys and values.
    """
    if isinstance(dtype, T.StringType):
        text = _json_string(c)
    elif isinstance(dtype, T.BooleanType):
        text = F.when(c, "true").when(~c, "false")
    elif isinstance(dtype, (T.DoubleType, T.FloatType)):
        plain = _float_text(c.cast("double"))
        text = F.when(plain == "nan", "NaN").when(plain == "inf", "Infinity").when(plain == "-inf", "-Infinity")
        text = text.otherwise(plain)
    elif isinstance(dtype, T.IntegralType):
        text = c.cast("string")
    elif isinstance(dtype, T.ArrayType):
        items = F.transform(c, lambda x: sorted_json(x, dtype.elementType))
        text = F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
    elif isinstance(dtype, T.StructType):
        text = F.when(c.isNotNull(), sorted_json_fields({f.name: (c.getField(f.name), f.dataType) for f in dtype.fields}))
    elif isinstance(dtype, T.MapType):
        items = F.transform(
            F.array_sort(F.map_keys(c)),
            lambda k: F.concat(_json_string(k), F.lit(": "), sorted_json(F.element_at(c, k), dtype.valueType)),
        )
        text = F.concat(F.lit("{"), F.array_join(items, ", "), F.lit("}"))
    else:
        text = _json_string(py_str(c, dtype))
    return F.coalesce(text, F.lit("null"))


def sorted_json_fields(fields: dict[str, tuple[Column, T.DataType]], drop_null: bool = False) -> Column:
    """``sorted_json`` of a record given as columns; ``drop_null`` leaves null fields out."""
    parts = []
    for name in sorted(fields):
        c, dtype = fields[name]
        part = F.concat(_json_string(F.lit(name)), F.lit(": "), sorted_json(c, dtype))
        parts.append(F.when(c.isNotNull(), part) if drop_null else part)
    return F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}"))

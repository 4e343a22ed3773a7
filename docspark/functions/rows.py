"""Whole-row helpers."""

from __future__ import annotations

from decimal import Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of all columns, the same whenever a task runs again."""
    return F.xxhash64(*[_hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema])


def _hashable(c: Column, dtype: T.DataType) -> Column:
    text = dtype.simpleString()
    return F.to_json(c) if "map<" in text or "variant" in text else c


def literal(value: Any, dtype: T.DataType, field: str) -> Column:
    """A constant for a column of this type; one that does not fit is an error of the plan, never of a row."""
    fits = True
    if isinstance(dtype, (T.NumericType, T.BooleanType)) and isinstance(value, str):
        fits = False
    elif isinstance(dtype, T.BooleanType):
        fits = value is None or isinstance(value, bool)
    elif isinstance(dtype, T.IntegralType):
        bits = {"tinyint": 8, "smallint": 16, "int": 32, "bigint": 64}[dtype.simpleString()]
        fits = value is None or (isinstance(value, int) and -(1 << bits - 1) <= value < 1 << bits - 1)
    elif isinstance(dtype, T.NumericType):
        fits = value is None or isinstance(value, (int, float, Decimal))
    if not fits:
        raise ValueError(f"{field} is of type {dtype.simpleString()}: {value!r} is no value of it")
    return F.lit(value).try_cast(dtype)

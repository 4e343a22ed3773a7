"""A caller's Python function over a column: a record it fails on keeps the reason, all others go on."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

import pandas as pd
from pyspark.sql import Column, Row
from pyspark.sql import functions as F

#: What a function may return, and the Python types that hold it.
RETURNS: dict[str, tuple[type, ...]] = {"string": (str,), "long": (int,), "double": (float, int), "boolean": (bool,)}


@dataclass(frozen=True)
class Guarded:
    """``function`` as a Column function with the result struct<value, error>: error is null where it worked.

    The function sees one Python value at a time, null as None, a struct as a dict; with ``whole`` it sees a pandas Series of
    many and returns one as long. Values go over in Arrow batches. If a whole Series fails it is cut in halves
    until the rows that fail stand alone, so that k bad rows of n cost about k * log(n) further calls.
    ``returns``: string, long, double or boolean; a result of another kind is that row's error. A
    predicate's result counts by its truth.
    """

    function: Callable[[Any], Any]
    returns: str = "string"
    whole: bool = False

    def __post_init__(self) -> None:
        if self.returns not in RETURNS:
            raise ValueError(f"a guarded function returns one of {sorted(RETURNS)}")

    def __call__(self, c: Column) -> Column:
        function, returns = self.function, self.returns

        def checked(value: Any) -> Any:
            value = value.item() if hasattr(value, "item") else value
            if value is None or (returns != "double" and isinstance(value, float) and math.isnan(value)):
                return None
            if returns == "boolean":
                return bool(value)
            kinds = RETURNS[returns]
            if not isinstance(value, kinds) or isinstance(value, bool) or (returns == "long" and not -(2**63) <= value < 2**63):
                raise TypeError(f"returned {type(value).__name__}, not {returns}")
            return float(value) if returns == "double" else value

        if self.whole:
            return F.pandas_udf(lambda s: _halved(function, checked, s), f"value {returns}, error string")(c)

        def one(value: Any) -> tuple:
            try:
                return checked(function(value.asDict() if isinstance(value, Row) else value)), None
            except Exception as e:  # one bad record must not stop the job
                return None, str(e) or type(e).__name__

        return F.udf(one, f"struct<value:{returns},error:string>", useArrow=True)(c)


def _halved(function: Callable, checked: Callable, s: pd.Series) -> pd.DataFrame:
    out: list[tuple] = []
    todo = [s]
    while todo:
        part = todo.pop()
        try:
            result = list(function(part))
            if len(result) != len(part):
                raise ValueError(f"{len(result)} results for {len(part)} rows")
            out += [(checked(x), None) for x in result]
        except Exception as e:
            if len(part) == 1:
                out.append((None, str(e) or type(e).__name__))
            else:
                middle = len(part) // 2
                todo += [part.iloc[middle:], part.iloc[:middle]]
    return pd.DataFrame({"value": pd.Series([v for v, _ in out], dtype=object), "error": pd.Series([e for _, e in out], dtype=object)})


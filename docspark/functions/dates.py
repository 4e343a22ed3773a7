"""Date text in the supported spellings, re-printed in one format."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from docspark.functions.text import WS, strip

# --- Fixed values: spellings tried in this order (month/day wins over day/month) ---
_MONTHS = "january|february|march|april|may|june|july|august|september|october|november|december"
_MONTHS_SHORT = "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec"
_DAY = r"(?:\d{1,2}|\x20\d)"  # a one-digit day may be padded with a blank
_YMD, _HMS = rf"\d{{4}}-\d{{1,2}}-{_DAY}", r"\d{1,2}:\d{1,2}:\d{1,2}"
DATE_SPELLINGS = [
    (_YMD, "yyyy-M-d"),
    (rf"\d{{1,2}}/{_DAY}/\d{{4}}", "M/d/yyyy"),
    (r"\d{1,2}/\d{1,2}/\d{4}", "d/M/yyyy"),
    (rf"(?:{_MONTHS}) \d{{1,2}}, \d{{4}}", "MMMM d, yyyy"),
    (rf"(?:{_MONTHS_SHORT}) \d{{1,2}}, \d{{4}}", "MMM d, yyyy"),
    (rf"{_YMD}T{_HMS}", "yyyy-M-d'T'H:m:s"),
    (rf"{_YMD} {_HMS}", "yyyy-M-d H:m:s"),
]

# --- Fixed values: strftime directives and their Spark letters ---
DIRECTIVES = {
    "Y": "y", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss", "y": "yy",
    "B": "MMMM", "b": "MMM", "A": "EEEE", "a": "EEE", "I": "hh", "p": "a", "j": "DDD", "f": "SSSSSS",
}


def spark_format(strftime: str) -> str:
    """A strftime format as a Spark datetime pattern."""
    out, text = [], ""
    for literal, directive in re.findall(r"([^%]+)|%(.)", strftime):
        if literal or directive == "%":
            text += literal or "%"
            continue
        if directive not in DIRECTIVES:
            raise ValueError(f"unsupported date directive: %{directive}")
        out.append(_quoted(text) + DIRECTIVES[directive])
        text = ""
    return "".join(out) + _quoted(text)


def _quoted(text: str) -> str:
    return re.sub(r"[A-Za-z']+", lambda m: "'" + m.group(0).replace("'", "''") + "'", text)


def parse_date(c: Column) -> Column:
    """Timestamp of the first spelling that fits the whole text, else null.

    The guard patterns run on the text itself, which is only rewritten once one of them fits.
    """
    single_blanks = F.regexp_replace(F.regexp_replace(strip(c), f"[{WS}]+", " "), "([-/]) ", "$1")
    tries = [
        F.when(
            c.rlike(rf"(?i)\A[{WS}]*(?!0000){guard.replace(' ', f'[{WS}]+')}[{WS}]*\z"),
            F.try_to_timestamp(single_blanks, F.lit(fmt)),
        )
        for guard, fmt in DATE_SPELLINGS
    ]
    return F.coalesce(*tries)


def reformat_date(c: Column, strftime: str) -> Column:
    """The date in ``strftime`` form; text that is no date is returned unchanged."""
    return F.coalesce(F.date_format(parse_date(c), spark_format(strftime)), c)

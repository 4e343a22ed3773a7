"""Readable text of PDF bytes; decoding of the PDF format itself is left to the caller."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import or_placeholder

# --- Fixed values ---
UNREADABLE = r"[^\x20-\x7E\n\t]"
EMPTY_PDF = "(empty PDF)"


def parse(df: DataFrame, content: str = "content", prefix: str = "") -> DataFrame:
    """Add raw_content and meta_pages; unreadable characters become blanks.

    Form feeds are unreadable too, so any text counts as one page.
    """
    text = f"{prefix}raw_content"
    df = df.withColumn(text, F.regexp_replace(F.col(content), UNREADABLE, " "))
    pages = F.when(F.col(text) == "", 0).otherwise(F.regexp_count(text, F.lit(r"\x0c")) + 1)
    df = df.withColumn(f"{prefix}meta_pages", pages)
    return df.withColumn(text, or_placeholder(F.col(text), EMPTY_PDF))

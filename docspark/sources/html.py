"""HTML pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import EMPTY_HTML, html_title, html_to_text, link_count, or_placeholder


def parse(df: DataFrame, content: str = "content", prefix: str = "") -> DataFrame:
    """Add raw_content, meta_title and meta_links_count (column names take ``prefix``)."""
    raw, text = F.col(content), f"{prefix}raw_content"
    df = df.withColumns(
        {text: html_to_text(raw), f"{prefix}meta_title": html_title(raw), f"{prefix}meta_links_count": link_count(raw)}
    )
    return df.withColumn(text, or_placeholder(F.col(text), EMPTY_HTML))

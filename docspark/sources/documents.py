"""Raw document tables, format dispatch, parse errors, previews."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docspark.functions.text import is_blank
from docspark.sources import csv, email, html, pdf

# --- Fixed values ---
FORMATS = ["pdf", "email", "html", "csv", "text"]
PREVIEW_CHARS = 500
NO_PARSER = "No parser available for format: "
BLANK_CONTENT = "Document raw_content must not be empty"
PARSE_ERROR = "(parse error: {})"
META = "map<string,string>"
BROKEN_REQUEST = "Request body is not valid JSON with a list of documents"
NO_DOCUMENTS = "Request body has no documents"
REQUEST_FORMAT = "request"
REQUEST = "documents array<struct<text:string,format:string>>"


def read_files(spark: SparkSession, path: str, format: str, glob: str | None = None) -> DataFrame:
    """Files as documents: content as bytes, the file name in the metadata."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return as_documents(reader.load(path).select("content", F.lit(format).alias("format"),
                                                 F.regexp_extract("path", r"[^/]+\z", 0).alias("filename")))


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """JSON request bodies ``{"documents": [{"text", "format"}]}``, one per line, as documents; unknown formats are text.

    Every line leaves its trace: see ``parse_requests``.
    """
    return request_documents(parse_requests(spark.read.text(path), "value"))


def parse_requests(df: DataFrame, body: str = "body") -> DataFrame:
    """Request bodies held as text in ``body`` to their ``documents``, with the other columns of ``df``.

    A body that is no JSON, or has something else than a list of texts and formats, keeps its text in ``broken`` and
    the reason in ``request_error``; so does one without ``documents``. Blank lines are no bodies.
    """
    rest = [c for c in df.columns if c != body]
    df = df.filter(~is_blank(F.col(body)))
    parsed = F.from_json(F.col(body), f"{REQUEST}, _broken string", {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"})
    df = df.withColumn("_request", parsed)
    error = F.when(F.col("_request._broken").isNotNull() | F.col("_request").isNull(), BROKEN_REQUEST).when(F.col("_request.documents").isNull(), NO_DOCUMENTS)
    return df.select(
        *rest, F.when(error.isNull(), F.col("_request.documents")).alias("documents"), F.when(error.isNotNull(), F.col(body)).alias("broken"), error.alias("request_error")
    )


def request_documents(body: DataFrame) -> DataFrame:
    """The documents of parsed request bodies; a broken body is one document of format "request" that carries its error to ``parse``."""
    item = "struct<text:string,format:string>"
    if "broken" not in body.columns:
        body = body.withColumns({"broken": F.lit(None).cast("string"), "request_error": F.lit(None).cast("string")})
    rest = [c for c in body.columns if c not in ("documents", "broken", "request_error")]
    failed = F.col("request_error").isNotNull()
    whole = F.array(F.struct(F.col("broken").alias("text"), F.lit(REQUEST_FORMAT).alias("format")).cast(item))
    items = body.select(*rest, "request_error", F.explode(F.when(failed, whole).otherwise(F.col("documents"))).alias("d"))
    format = F.when(failed, F.col("d.format")).otherwise(known_format(F.col("d.format")))
    return as_documents(items.select(*rest, F.coalesce("d.text", F.lit("")).alias("content"), format.alias("format"), "request_error"))


def known_format(c: Column) -> Column:
    return F.when(c.isin(FORMATS), c).otherwise("text")


def as_documents(df: DataFrame, id: str | None = None) -> DataFrame:
    """content and format columns to document_id, format, content, size_bytes and metadata.

    Without a key the id is the SHA-256 of the content: stable when a task runs again, and equal
    for exact copies.
    """
    raw = F.col("content")
    binary = isinstance(df.schema["content"].dataType, T.BinaryType)
    text = F.make_valid_utf8(raw.cast("string")) if binary else raw
    size = F.octet_length(raw) if not binary else F.when(F.col("format") == "pdf", F.octet_length(raw)).otherwise(F.octet_length(text))
    meta = F.create_map(F.lit("filename"), F.col("filename")) if "filename" in df.columns else F.create_map().cast(META)
    rest = [c for c in df.columns if c not in ("content", "format", "filename", id)]
    return df.select(
        (F.col(id).cast("string") if id else F.sha2(raw, 256)).alias("document_id"),
        "format",
        text.alias("content"),
        size.cast("bigint").alias("size_bytes"),
        meta.alias("metadata"),
        *rest,
    )


PARSERS = {"html": html.parse, "email": email.parse, "csv": csv.parse, "pdf": pdf.parse}


def parse(
    df: DataFrame,
    text_passthrough: bool = False,
    max_size_mb: float | None = None,
    formats: tuple[str, ...] = tuple(PARSERS),
) -> DataFrame:
    """Documents to ``raw_content`` and metadata, each format by its own expressions.

    One pass over the input and no shuffle: every parser sees the content of its own format and
    null elsewhere. A document that cannot be parsed stays, with the reason in ``parse_error``,
    in its metadata and as its text. ``formats`` names the parsers to plan for; naming only those
    in use keeps the plan small.
    """
    known = [*formats, *(["text"] if text_passthrough else [])]
    no_parser = F.concat(F.lit(NO_PARSER), F.coalesce("format", F.lit("None")))
    error = F.when(F.col("format").isNull() | ~F.col("format").isin(known), no_parser)
    if max_size_mb:
        limit = int(max_size_mb * 1024 * 1024)
        error = F.when(F.col("size_bytes") > limit, f"Document exceeds {max_size_mb} MB").otherwise(error)
    if "request_error" in df.columns:  # a broken request body
        error = F.coalesce("request_error", error)
    base = [c for c in df.columns if c != "request_error"]
    df = df.withColumn("parse_error", error)
    texts, metas = [], []
    for name in formats:
        parser = PARSERS[name]
        own = f"_{name}_"
        mine = F.col("parse_error").isNull() & (F.col("format") == name)
        df = parser(df.withColumn(own, F.when(mine, F.col("content"))), own, own)
        texts.append(F.col(f"{own}raw_content"))
        metas.append(F.when(mine, _metadata(df, name, own)))
    if text_passthrough:
        texts.append(F.when(F.col("parse_error").isNull() & (F.col("format") == "text"), F.col("content")))
    df = df.withColumns({"raw_content": F.coalesce(*texts), "metadata": F.coalesce(*metas, F.col("metadata"))})
    df = df.select(*[c for c in base if c != "content"], "raw_content", "parse_error")
    return mark_errors(df)


def _metadata(df: DataFrame, parser: str, prefix: str) -> Column:
    """The document's metadata with the parser's fields laid over it."""
    meta = f"{prefix}meta_"
    names = ["parser", *[c[len(meta):] for c in df.columns if c.startswith(meta)]]
    entries = [F.lit("parser"), F.lit(parser)]
    for n in names[1:]:
        entries += [F.lit(n), F.col(meta + n).cast("string")]
    return F.map_concat(F.map_filter("metadata", lambda k, v: ~k.isin(names)), F.create_map(*entries))


def mark_errors(df: DataFrame) -> DataFrame:
    """Blank content is an error too; erroneous rows carry the message as their text."""
    blank = F.coalesce(is_blank(F.col("raw_content")), F.lit(True))
    df = df.withColumn(
        "parse_error", F.coalesce("parse_error", F.when(blank, BLANK_CONTENT))
    )
    failed = F.col("parse_error").isNotNull()
    before, after = PARSE_ERROR.split("{}")
    message = F.concat(F.lit(before), F.col("parse_error"), F.lit(after))
    return df.withColumns(
        {
            "raw_content": F.when(failed, message).otherwise(F.col("raw_content")),
            "metadata": F.when(failed, F.create_map(F.lit("error"), F.col("parse_error"))).otherwise(F.col("metadata")),
        }
    )


def preview(parsed: DataFrame) -> DataFrame:
    """Text length, first 500 characters and metadata of parsed documents."""
    return parsed.select(
        "document_id",
        "format",
        F.length("raw_content").alias("text_length"),
        F.substring("raw_content", 1, PREVIEW_CHARS).alias("preview"),
        "metadata",
    )

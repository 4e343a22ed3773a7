"""E-mail messages: headers, body choice, attachments; all inside the row, nothing is exploded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docspark.functions.text import strip, tags_to_blanks

# --- Fixed values: message syntax ---
NEWLINE = r"(?:\r\n|\r|\n)"
HEADER_BLOCK = rf"\A(?:(?:From |[!-9;-~]*:|[ \t])[^\r\n]*+(?:\r\n|\r|\n|\z))*+"
NODES = "array<struct<head:string,body:string,open:boolean>>"
ATTACHMENTS = "[Attachments: {}]"
SHOWN_HEADERS = ["From", "To", "Subject", "Date"]
HEADERS = ["from", "to", "subject", "date", "cc"]
MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"
MAIL_DATE = (
    r"(?i)\A(?:[a-z]{3},?[ \t]+)?([0-9]{1,2})[ \t]+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*[ \t]+"
    r"([0-9]{4})[ \t]+([0-9]{1,2}):([0-9]{2})(?::([0-9]{2}))?[ \t]+([+-][0-9]{4})\z"
)
# header lines that open a level of parts, and types whose body is a message of its own
CONTAINER = rf"(?im)^content-type:\s*(?:multipart/|message/)"
STATUS_REPORT = "message/delivery-status"


def _entity(text: Column) -> Column:
    """Header block (unfolded, "\\n" line ends) and body of a message or message part."""
    block = F.regexp_extract(text, HEADER_BLOCK, 0)
    head = F.regexp_replace(F.regexp_replace(block, r"\r\n?", "\n"), r"\n(?=[ \t])", "")
    body = F.regexp_extract(text, rf"(?s){HEADER_BLOCK}{NEWLINE}?(.*+)", 1)
    return F.struct(head.alias("head"), body.alias("body"))


def _header(head: Column, name: str) -> Column:
    """First value of a header, "" when it is missing."""
    return strip(F.regexp_extract(head, rf"(?imd)^{name}:([^\n]*)", 1))


def _param(head: Column, header: str, name: str) -> Column:
    """A parameter of a header, quoted or not, "" when it is missing."""
    return F.regexp_extract(head, rf'(?imd)^{header}:[^\n]*?;[ \t]*{name}[ \t]*=[ \t]*"?([^";\n]+)"?', 1)


def _date(value: Column) -> Column:
    """A well-formed date in its canonical spelling (own weekday, two-digit day); other text as is."""

    def part(i: int) -> Column:
        return F.regexp_extract(value, MAIL_DATE, i)

    month = (F.instr(F.lit(MONTHS), F.initcap(part(2))) + 2) / 3
    day = F.try_to_date(F.concat_ws("-", part(3), month.cast("int").cast("string"), part(1)), "yyyy-M-d")
    clock = F.concat_ws(":", F.lpad(part(4), 2, "0"), part(5), F.lpad(part(6), 2, "0"))
    # a time that does not exist leaves the text alone, like a wrong date
    real = (part(4).try_cast("int") < 24) & (part(5).try_cast("int") < 60) & (F.coalesce(part(6).try_cast("int"), F.lit(0)) < 60)
    text = F.concat(F.date_format(day, "EEE, dd MMM yyyy"), F.lit(" "), clock, F.lit(" "), part(7))
    return F.when(value.rlike(MAIL_DATE) & real, F.coalesce(text, value)).otherwise(value)


def _boundary(head: Column) -> Column:
    is_multipart = F.lower(_header(head, "content-type")).startswith("multipart/")
    return F.when(is_multipart, F.nullif(F.rtrim(_param(head, "content-type", "boundary")), F.lit("")))


def _kind(head: Column) -> Column:
    kind = F.lower(F.trim(F.regexp_extract(head, r"(?imd)^content-type:([^;\n]*)", 1)))
    return F.when(kind.rlike(r"\A[^/]+/[^/]+\z"), kind).otherwise("text/plain")


def _parts(head: Column, body: Column) -> Column:
    """Texts of the parts of a multipart body: no preamble, nothing after the closing line."""
    mark = F.concat(F.lit(rf"{NEWLINE}--\Q"), _boundary(head), F.lit(r"\E"))
    closing = F.concat(F.lit("(?s)"), mark, F.lit(r"--[ \t]*(?:[\r\n].*)?\z"))
    opening = F.concat(mark, F.lit(r"[ \t]*(?=[\r\n]|\z)"))
    pieces = F.split(F.regexp_replace(F.concat(F.lit("\n"), body), closing, F.lit("")), opening)
    return F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0)))


def _node(text: Column) -> Column:
    """A part that has not been looked into yet."""
    entity = _entity(text)
    return F.struct(entity["head"].alias("head"), entity["body"].alias("body"), F.lit(True).alias("open"))


def _expand(node: Column) -> Column:
    """The node itself, closed, followed by its parts when it is a multipart or an enclosed message."""
    head, body = node["head"], node["body"]
    closed = F.array(F.struct(head.alias("head"), body.alias("body"), F.lit(False).alias("open")))
    enclosed = _kind(head).startswith("message/") & (_kind(head) != STATUS_REPORT)
    texts = F.when(_boundary(head).isNotNull(), _parts(head, body)).when(enclosed, F.array(body))
    inner = F.transform(texts, lambda t: _node(F.regexp_replace(t, rf"\A{NEWLINE}", "")))
    return F.when(node["open"], F.concat(closed, F.coalesce(inner, F.array().cast(NODES)))).otherwise(F.array(node))


def _walk(root: Column, text: Column) -> Column:
    """All parts of a message, depth first.

    One round opens one more level; a message cannot be deeper than it has container headers.
    """
    rounds = F.array_repeat(F.lit(1), F.regexp_count(text, F.lit(CONTAINER)))
    return F.aggregate(rounds, F.array(root).cast(NODES), lambda nodes, _: F.flatten(F.transform(nodes, _expand)).cast(NODES))


def _decode(head: Column, body: Column) -> Column:
    """Body text with base64 and quoted-printable undone."""
    encoding = F.lower(_header(head, "content-transfer-encoding"))
    base64 = F.try_to_binary(F.regexp_replace(body, "[^A-Za-z0-9+/=]", ""), F.lit("base64"))
    return (
        F.when(encoding == "base64", F.coalesce(F.make_valid_utf8(base64.cast("string")), body))
        .when(encoding == "quoted-printable", _unquote(body))
        .otherwise(body)
    )


def _unquote(body: Column) -> Column:
    joined = F.regexp_replace(body, r"=[ \t]*(?:\r\n|\n)", "")
    runs = F.regexp_extract_all(joined, F.lit(r"(?:=[0-9A-Fa-f]{2})++|[^=]++|="), F.lit(0))
    return F.array_join(
        F.transform(
            runs,
            lambda r: F.when(
                F.length(r) >= 3,
                F.when(r.startswith("="), F.make_valid_utf8(F.unhex(F.replace(r, F.lit("="), F.lit(""))).cast("string"))).otherwise(r),
            ).otherwise(r),
        ),
        "",
    )


def _leaf(node: Column) -> Column:
    """Type, decoded text and file name of one part."""
    head = node["head"]
    name = F.coalesce(
        F.nullif(_param(head, "content-disposition", "filename"), F.lit("")),
        F.nullif(_param(head, "content-type", "name"), F.lit("")),
    )
    return F.struct(_kind(head).alias("kind"), _decode(head, node["body"]).alias("text"), name.alias("file"))


def _chosen_text(leaves: Column) -> Column:
    """All plain parts; an HTML part only when it comes before any other text."""
    bodies = F.filter(leaves, lambda p: p["kind"].isin("text/plain", "text/html") & (p["text"] != ""))
    kept = F.filter(bodies, lambda p, i: (p["kind"] == "text/plain") | (i == 0))
    texts = F.transform(kept, lambda p: F.when(p["kind"] == "text/html", tags_to_blanks(p["text"])).otherwise(p["text"]))
    return F.array_join(texts, "\n")


def parse(df: DataFrame, content: str = "content", prefix: str = "") -> DataFrame:
    """Add raw_content, meta_from, meta_to, meta_subject, meta_date, meta_cc and meta_attachment_count.

    Each value is computed in its own projection and then referred to by name, so no pattern runs twice.
    """
    p = prefix
    root, nodes, leaves, files, body = (f"{p}_{n}" for n in ("root", "nodes", "leaves", "files", "body"))
    raw, head = F.col(content), F.col(f"{root}.head")
    df = df.withColumn(root, F.when(raw.isNotNull(), _node(raw)))
    df = df.withColumn(nodes, F.when(raw.isNotNull(), _walk(F.col(root), raw)))
    df = df.withColumn(leaves, F.when(F.size(nodes) > 1, F.transform(F.col(nodes), _leaf)))
    df = df.withColumns(
        {
            body: F.coalesce(_chosen_text(F.col(leaves)), _decode(head, F.col(f"{root}.body"))),
            files: F.coalesce(
                F.filter(F.transform(F.col(leaves), lambda x: x["file"]), lambda f: f.isNotNull()),
                F.array().cast("array<string>"),
            ),
            **{f"{p}meta_{h}": _header(head, h) for h in HEADERS},
        }
    )
    meta = {h: F.col(f"{p}meta_{h}") for h in HEADERS}
    df = df.withColumn(f"{p}meta_date", _date(meta["date"]))
    before, after = ATTACHMENTS.split("{}")
    listed = F.concat(F.lit("\n\n" + before), F.array_join(files, ", "), F.lit(after))
    shown = [F.concat(F.lit(f"{h}: "), meta[h.lower()]) for h in SHOWN_HEADERS]
    text = F.concat(
        F.concat_ws("\n", *shown, F.lit(""), F.col(body)), F.when(F.size(files) > 0, listed).otherwise("")
    )
    text = F.when(raw.isNotNull(), text)
    df = df.withColumns({f"{p}raw_content": text, f"{p}meta_attachment_count": F.size(files)})
    return df.drop(root, nodes, leaves, files, body)

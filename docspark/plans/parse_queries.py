"""Parsing: HTML, e-mail, CSV, page text, dispatch by format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.operators.clean import FieldRule, clean
from docspark.plans.registry import query, sql_strip, table
from docspark.session import scratch_dir
from docspark.sources import csv, documents, email, html, pdf

# ---- HTML ----


def sql_html_text(x: str) -> str:
    for pattern, to in (
        (r"<script[^>]*>.*?</script>", ""), (r"<style[^>]*>.*?</style>", ""),
        (r"<(p|div|br|h[1-6]|li|tr)[^>]*>", "\n"), (r"<[^>]+>", " "),
    ):
        x = f"regexp_replace({x}, '{pattern}', '{to}', 'gis')"
    for a, b in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&nbsp;", " "), ("&quot;", '"')):
        x = f"replace({x}, '{a}', '{b}')"
    x = f"regexp_replace({x}, '[ \t]+', ' ', 'g')"
    x = sql_strip(f"regexp_replace({x}, '\n{{3,}}', '\n\n', 'g')")
    return f"coalesce(nullif({x}, ''), '(empty HTML)')"


SQL_TITLE = sql_strip(r"regexp_extract(html, '<title[^>]*>(.*?)</title>', 1, 'is')")
SQL_LINKS = r"len(regexp_extract_all(html, '(?i)<a\s'))"


@query("html_text", f"SELECT page_id, {sql_html_text('html')} AS raw_content FROM pages")
def html_text(spark: SparkSession, sf: str) -> DataFrame:
    return html.parse(table(spark, sf, "pages", spread=True), "html").select("page_id", "raw_content")


@query("html_meta", f"SELECT page_id, {SQL_TITLE} AS title, {SQL_LINKS}::INT AS links_count FROM pages")
def html_meta(spark: SparkSession, sf: str) -> DataFrame:
    parsed = html.parse(table(spark, sf, "pages", spread=True), "html")
    return parsed.select("page_id", F.col("meta_title").alias("title"), F.col("meta_links_count").alias("links_count"))


def sql_collapse(x: str) -> str:
    x = rf"regexp_replace(regexp_replace({x}, '[\t\r\x0b\x0c]+', ' ', 'g'), ' {{2,}}', ' ', 'g')"
    return rf"regexp_replace({sql_strip(x)}, '[\x00-\x08\x0e-\x1f\x7f]', '', 'g')"


@query(
    "clean_strip_html",
    f"SELECT page_id, nullif({sql_strip('regexp_replace(' + sql_collapse('html') + ', $$<[^>]+>$$, $$$$, $$g$$)')}, '') AS html FROM pages",
)
def clean_strip_html(spark: SparkSession, sf: str) -> DataFrame:
    return clean(table(spark, sf, "pages", spread=True).select("page_id", "html"), {"html": FieldRule(strip_html=True)}, ["html"])


# ---- e-mail: messages wrapped around the conversation turns ----


def mail_id() -> F.Column:
    return F.concat_ws("-", "conv_id", "turn")


SQL_MAIL_ID = "conv_id || '-' || turn"
SQL_MAIL_DATE = "strftime(DATE '2024-01-01' + CAST(conv_id % 300 AS INT), '%a, %d %b %Y') || ' 0' || (turn % 10) || ':30:00 +0000'"


def plain_mails(conversations: DataFrame) -> DataFrame:
    """One message per turn: folded subject, one-digit day and wrong weekday in the date, CRLF on odd turns."""
    day = F.expr("date_add(date'2024-01-01', cast(conv_id % 300 as int))")
    head = F.concat(
        F.lit("From: "), F.col("role"), F.lit("@example.com\nTo: desk"), F.col("conv_id").cast("string"),
        F.lit("@example.org\nSubject: Turn"), F.when(F.col("turn") % 2 == 0, "\n ").otherwise(" "),
        F.col("turn").cast("string"), F.lit("\nDate: Xxx, "), F.date_format(day, "d MMM yyyy"), F.lit(" 0"),
        (F.col("turn") % 10).cast("string"), F.lit(":30 +0000\n"),
        F.when(F.col("conv_id") % 3 == 0, "Cc: team@example.com\n").otherwise(""),
    )
    head = F.when(F.col("turn") % 2 == 1, F.replace(head, F.lit("\n"), F.lit("\r\n"))).otherwise(head)
    end = F.when(F.col("turn") % 2 == 1, "\r\n").otherwise("\n")
    return conversations.select(mail_id().alias("document_id"), F.concat(head, end, "text").alias("content"))


@query(
    "email_headers",
    f"""SELECT {SQL_MAIL_ID} AS document_id, role || '@example.com' AS sender, 'desk' || conv_id || '@example.org' AS recipient,
        'Turn ' || turn AS subject, {SQL_MAIL_DATE} AS sent,
        CASE WHEN conv_id % 3 = 0 THEN 'team@example.com' ELSE '' END AS cc,
        'From: ' || role || '@example.com' || chr(10) || 'To: desk' || conv_id || '@example.org' || chr(10) || 'Subject: Turn ' || turn
          || chr(10) || 'Date: ' || {SQL_MAIL_DATE} || chr(10) || chr(10) || text AS raw_content
        FROM conversations""",
)
def email_headers(spark: SparkSession, sf: str) -> DataFrame:
    parsed = email.parse(plain_mails(table(spark, sf, "conversations", spread=True)))
    return parsed.select(
        "document_id", F.col("meta_from").alias("sender"), F.col("meta_to").alias("recipient"),
        F.col("meta_subject").alias("subject"), F.col("meta_date").alias("sent"), F.col("meta_cc").alias("cc"), "raw_content",
    )


def multipart_mails(conversations: DataFrame) -> DataFrame:
    """Multipart messages: plain + HTML, HTML first, HTML only, base64, nested, with and without files."""
    html_part = "concat('Content-Type: text/html; charset=utf-8\\n\\n<p>', role, ' &amp; <b>', text, '</b></p>')"
    plain_part = "concat('Content-Type: text/plain; charset=\"utf-8\"\\n\\n', text)"
    base64_part = (
        "concat('Content-Type: text/plain\\nContent-Transfer-Encoding: base64\\n\\n', base64(encode(text, 'UTF-8')))"
    )
    quoted_part = (
        "concat('Content-Type: text/plain\\nContent-Transfer-Encoding: quoted-printable\\n\\n', "
        "replace(text, '=', '=3D'), '=\\n=C3=A9')"
    )
    file_part = (
        "concat('Content-Type: application/pdf; name=\"n', turn, '.pdf\"\\nContent-Disposition: attachment;\\n "
        "filename=\"file ', turn, '.pdf\"\\nContent-Transfer-Encoding: base64\\n\\naGk=')"
    )
    nested = f"concat('Content-Type: multipart/alternative; boundary=\"in-ner\"\\n\\n--in-ner\\n', {plain_part}, '\\n--in-ner\\n', {html_part}, '\\n--in-ner--\\n')"
    sep = "'\\n--=_b.1\\n'"
    parts = (
        f"case conv_id % 6 when 0 then concat({plain_part}, {sep}, {html_part}) "
        f"when 1 then concat({html_part}, {sep}, {plain_part}) "
        f"when 2 then concat({html_part}, {sep}, {file_part}) "
        f"when 3 then concat({base64_part}, {sep}, {file_part}, {sep}, {html_part}) "
        f"when 4 then concat({nested}, {sep}, {file_part}) "
        f"else {quoted_part} end"
    )
    return conversations.select(
        mail_id().alias("document_id"),
        F.expr(
            "concat('From: ', role, '@example.com\\nMIME-Version: 1.0\\nContent-Type: multipart/mixed;\\n boundary=\"=_b.1\"\\n\\n"
            f"preamble, not shown\\n--=_b.1\\n', {parts}, '\\n--=_b.1--\\nepilogue')"
        ).alias("content"),
    )


SQL_HTML_BODY = sql_strip(
    r"regexp_replace(regexp_replace('<p>' || role || ' &amp; <b>' || text || '</b></p>', '<[^>]+>', ' ', 'g'), '[\s\x0b]+', ' ', 'g')"
)


@query(
    "email_multipart",
    f"""SELECT {SQL_MAIL_ID} AS document_id,
        CASE conv_id % 6 WHEN 0 THEN text WHEN 1 THEN {SQL_HTML_BODY} || chr(10) || text WHEN 2 THEN {SQL_HTML_BODY}
             WHEN 3 THEN text WHEN 4 THEN text ELSE text || 'é' END
          || CASE WHEN conv_id % 6 IN (2, 3, 4) THEN chr(10) || chr(10) || '[Attachments: file ' || turn || '.pdf]' ELSE '' END AS body,
        CASE WHEN conv_id % 6 IN (2, 3, 4) THEN 1 ELSE 0 END AS attachment_count
        FROM conversations""",
)
def email_multipart(spark: SparkSession, sf: str) -> DataFrame:
    parsed = email.parse(multipart_mails(table(spark, sf, "conversations", spread=True)))
    return parsed.select(
        "document_id",
        F.regexp_replace("raw_content", r"\AFrom: [^\n]*\nTo: \nSubject: \nDate: \n\n", "").alias("body"),
        F.col("meta_attachment_count").alias("attachment_count"),
    )


# ---- CSV ----


def csv_documents(docs: DataFrame) -> DataFrame:
    """Each text as a small CSV file: one quoted row per line, a short row at the end."""
    line = "concat('\"', replace(l, '\"', '\"\"'), '\",', length(l), ',', i, case when i % 4 = 3 then ',extra' else '' end)"
    body = f"array_join(transform(split(text, '\\n'), (l, i) -> {line}), '\\n')"
    return docs.select("doc_id", F.expr(f"concat('line,size,place\\n', {body}, '\\nlast')").alias("content"))


SQL_CSV_LINES = "list_transform(string_split(text, chr(10)), lambda l, i: 'Row ' || i || ': line: ' || l || ' | size: ' || length(l) || ' | place: ' || (i - 1) || CASE WHEN (i - 1) % 4 = 3 THEN ' | col_3: extra' ELSE '' END)"


@query(
    "csv_doc_text",
    f"""WITH r AS (SELECT doc_id, list_append({SQL_CSV_LINES}, 'Row ' || (len(string_split(text, chr(10))) + 1) || ': line: last') AS lines FROM documents)
        SELECT doc_id, 'Columns: line, size, place' || chr(10) || 'Total rows: ' || len(lines) || chr(10) || chr(10)
          || array_to_string(lines, chr(10)) AS raw_content,
          len(lines)::INT AS row_count, 3 AS column_count
        FROM r""",
)
def csv_doc_text(spark: SparkSession, sf: str) -> DataFrame:
    parsed = csv.parse(csv_documents(table(spark, sf, "documents", spread=True)))
    return parsed.select(
        "doc_id", "raw_content", F.col("meta_row_count").alias("row_count"), F.col("meta_column_count").alias("column_count")
    )


@query(
    "csv_table_text",
    """WITH r AS (SELECT o_orderpriority AS file, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS i,
                 'o_orderkey: ' || o_orderkey || ' | o_custkey: ' || o_custkey || ' | o_orderstatus: ' || o_orderstatus AS line FROM orders),
            n AS (SELECT file, count(*) AS row_count FROM r GROUP BY file)
       SELECT n.file, (i - 1) // 1000 AS part, row_count, 3 AS column_count,
         'Columns: o_orderkey, o_custkey, o_orderstatus' || chr(10) || 'Total rows: ' || row_count || chr(10) || chr(10)
         || string_agg('Row ' || i || ': ' || line, chr(10) ORDER BY i) AS raw_content
       FROM n JOIN r ON n.file = r.file GROUP BY n.file, row_count, part""",
)
def csv_table_text(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").withColumn("file", F.col("o_orderpriority"))
    out = csv.table_text(orders, "file", ["o_orderkey"], ["o_orderkey", "o_custkey", "o_orderstatus"])
    return out.select("file", "part", "row_count", "column_count", "raw_content")


def written_files(rows: DataFrame, head: str, work: str) -> str:
    """(bucket, place, record) as CSV files of one bucket each, header first; buckets are of bounded size."""
    heads = rows.select("bucket").distinct().select("bucket", F.lit(None).cast("bigint").alias("place"), F.lit(head).alias("record"))
    files = heads.unionByName(rows).repartition("bucket").sortWithinPartitions("bucket", F.asc_nulls_first("place"))
    files.select("bucket", F.col("record").alias("value")).write.partitionBy("bucket").text(work)
    return f"{work}/*"


BUCKET = "bigint(regexp_extract(file, 'bucket=([0-9]+)', 1)) AS bucket"


@query(
    "csv_file_rows",
    """SELECT doc_id // 500 AS bucket, doc_id::VARCHAR AS id, text AS body, CASE WHEN doc_id % 4 = 3 THEN 'extra|5" wide' ELSE '' END AS extra FROM documents
       UNION ALL SELECT doc_id // 500, NULL, NULL, '' FROM documents WHERE doc_id % 10 = 0""",
)
def csv_file_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as CSV files with quoted line breaks, blank lines and cells too many, and read back."""
    docs = table(spark, sf, "documents").select(
        F.floor(F.col("doc_id") / 500).alias("bucket"), F.col("doc_id").alias("place"),
        F.concat(
            F.col("doc_id").cast("string"), F.lit(',"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'),
            F.when(F.col("doc_id") % 4 == 3, ',extra,5" wide').otherwise(""), F.when(F.col("doc_id") % 10 == 0, "\n").otherwise(""),
        ).alias("record"),
    )
    rows = csv.read_rows(spark, written_files(docs, "id,body", scratch_dir(spark, "csv")), ["id", "body"])
    return rows.select(F.expr(BUCKET), "id", "body", F.array_join("extra_cells", "|").alias("extra"))


@query(
    "csv_files_text",
    """WITH r AS (SELECT o_orderkey // 5000 AS bucket, row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) AS i,
                 'key: ' || o_orderkey || ' | note: ' || o_orderpriority || chr(10) || '"' || o_orderstatus || '"' || CASE WHEN o_orderkey % 3 = 0 THEN ' | col_2: ' || o_custkey ELSE '' END AS line FROM orders),
            n AS (SELECT bucket, count(*) AS row_count FROM r GROUP BY bucket)
       SELECT n.bucket, (i - 1) // 1000 AS part, row_count, 2 AS column_count,
         'Columns: key, note' || chr(10) || 'Total rows: ' || row_count || chr(10) || chr(10) || string_agg('Row ' || i || ': ' || line, chr(10) ORDER BY i) AS raw_content
       FROM n JOIN r ON n.bucket = r.bucket GROUP BY n.bucket, row_count, part""",
)
def csv_files_text(spark: SparkSession, sf: str) -> DataFrame:
    """Orders written as CSV files with quoted line breaks; the text of each file in parts."""
    note = F.concat("o_orderpriority", F.lit('\n""'), "o_orderstatus", F.lit('""'))
    more = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit(","), F.col("o_custkey").cast("string"))).otherwise("")
    orders = table(spark, sf, "orders").select(
        F.floor(F.col("o_orderkey") / 5000).alias("bucket"), F.col("o_orderkey").alias("place"),
        F.concat(F.col("o_orderkey").cast("string"), F.lit(',"'), note, F.lit('"'), more).alias("record"),
    )
    texts = csv.files_text(spark, written_files(orders, "key,note", scratch_dir(spark, "csv")))
    return texts.select(F.expr(BUCKET), "part", "row_count", "column_count", "raw_content")


@query(
    "csv_counts",
    "SELECT c_mktsegment, count(*) AS row_count, 3 AS column_count FROM customer GROUP BY c_mktsegment",
)
def csv_counts(spark: SparkSession, sf: str) -> DataFrame:
    return csv.counts(table(spark, sf, "customer"), "c_mktsegment", ["c_custkey", "c_name", "c_acctbal"])


# ---- page text, dispatch, preview ----


@query(
    "pdf_fallback",
    r"""WITH t AS (SELECT doc_id, regexp_replace(text, '[^\x20-\x7E\n\t]', ' ', 'g') AS t FROM documents)
        SELECT doc_id, CASE WHEN trim(t, chr(32) || chr(9) || chr(10)) = '' THEN '(empty PDF)' ELSE t END AS raw_content,
               CASE WHEN t = '' THEN 0 ELSE 1 END AS pages FROM t""",
)
def pdf_fallback(spark: SparkSession, sf: str) -> DataFrame:
    parsed = pdf.parse(table(spark, sf, "documents", spread=True), "text")
    return parsed.select("doc_id", "raw_content", F.col("meta_pages").alias("pages"))


def mixed_documents(docs: DataFrame) -> DataFrame:
    """Every text as a document of some format, one in six of an unknown one, one in seven left blank."""
    text = F.when(F.col("doc_id") % 7 == 6, F.lit(" ")).otherwise(F.translate("text", '"', "'"))
    kind = F.get(F.array(*[F.lit(f) for f in ("html", "email", "csv", "pdf", "text", "docx")]), (F.col("doc_id") % 6).cast("int"))
    content = (
        F.when(kind == "html", F.concat(F.lit("<p>"), text, F.lit("</p>")))
        .when(kind == "email", F.concat(F.lit("Subject: s\n\n"), text))
        .otherwise(text)
    )
    return docs.select("doc_id", documents.known_format(kind).alias("format"), content.alias("content"))


SQL_MIXED = """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'html' WHEN 1 THEN 'email' WHEN 2 THEN 'csv' WHEN 3 THEN 'pdf' ELSE 'text' END AS format,
    CASE WHEN doc_id % 7 = 6 THEN ' ' ELSE replace(text, '"', '''') END AS t FROM documents"""


@query(
    "format_dispatch",
    f"""WITH m AS ({SQL_MIXED}),
        c AS (SELECT *, CASE format WHEN 'html' THEN '<p>' || t || '</p>' WHEN 'email' THEN 'Subject: s' || chr(10) || chr(10) || t ELSE t END AS content,
              list_filter(string_split(t, chr(10)), lambda x, i: i < len(string_split(t, chr(10))) OR x <> '') AS recs FROM m),
        h AS (SELECT *, string_split(recs[1], ',') AS head,
              list_transform(recs[2:], lambda x, i: 'Row ' || i || ': ' || CASE WHEN x = '' THEN '' ELSE
                array_to_string(list_transform(string_split(x, ','), lambda v, j: coalesce(string_split(recs[1], ',')[j], 'col_' || (j - 1)) || ': ' || v), ' | ') END) AS shown FROM c)
        SELECT doc_id::VARCHAR AS document_id, format, strlen(content)::BIGINT AS size_bytes,
          CASE format WHEN 'html' THEN {sql_html_text('content')}
            WHEN 'email' THEN 'From: ' || chr(10) || 'To: ' || chr(10) || 'Subject: s' || chr(10) || 'Date: ' || chr(10) || chr(10) || t
            WHEN 'csv' THEN 'Columns: ' || array_to_string(head, ', ') || chr(10) || 'Total rows: ' || (len(recs) - 1) || chr(10)
              || CASE WHEN len(recs) > 1 THEN chr(10) || array_to_string(shown, chr(10)) ELSE '' END
            WHEN 'pdf' THEN CASE WHEN {sql_strip('t')} = '' THEN '(empty PDF)' ELSE regexp_replace(t, '[^\\x20-\\x7E\\n\\t]', ' ', 'g') END
            ELSE '(parse error: No parser available for format: text)' END AS raw_content,
          CASE WHEN format = 'text' THEN 'No parser available for format: text' END AS parse_error
        FROM h""",
)
def format_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents.as_documents(mixed_documents(table(spark, sf, "documents", spread=True)), id="doc_id")
    return documents.parse(docs).select("document_id", "format", "size_bytes", "raw_content", "parse_error")


@query(
    "parse_preview",
    f"""WITH p AS (SELECT page_id, {sql_html_text('html')} AS t, {SQL_TITLE} AS title, {SQL_LINKS} AS links, url FROM pages)
        SELECT page_id::VARCHAR AS document_id, length(t)::INT AS text_length, substr(t, 1, 500) AS preview,
               title, links::VARCHAR AS links_count, 'html' AS parser, url AS filename FROM p""",
)
def parse_preview(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages", spread=True).select(
        "page_id", F.encode("html", "UTF-8").alias("content"), F.lit("html").alias("format"), F.col("url").alias("filename")
    )
    shown = documents.preview(documents.parse(documents.as_documents(pages, id="page_id")))
    meta = {n: F.col("metadata")[n].alias(n) for n in ("title", "links_count", "parser", "filename")}
    return shown.select("document_id", "text_length", "preview", *meta.values())


# ---- request bodies ----


def request_bodies(conversations: DataFrame) -> DataFrame:
    """One JSON request per turn: the text as HTML and as an unknown format, every fourth without any document."""
    body = (
        "to_json(named_struct('documents', if(turn % 4 = 3, cast(array() as array<struct<text:string,format:string>>), array("
        "named_struct('text', concat('<li>', text), 'format', 'html'), named_struct('text', role, 'format', if(conv_id % 2 = 0, 'docx', null))))))"
    )
    return conversations.select("conv_id", "turn", F.expr(body).alias("body"))


@query(
    "request_documents",
    f"""WITH d AS (SELECT 'html' AS format, '<li>' || text AS content FROM conversations WHERE turn % 4 <> 3
                   UNION ALL SELECT 'text', role FROM conversations WHERE turn % 4 <> 3)
        SELECT sha256(content) AS document_id, format, CASE WHEN format = 'html' THEN {sql_html_text('content')}
          ELSE '(parse error: No parser available for format: text)' END AS raw_content FROM d""",
)
def request_documents(spark: SparkSession, sf: str) -> DataFrame:
    bodies = request_bodies(table(spark, sf, "conversations", spread=True))
    parsed = bodies.select(F.from_json("body", documents.REQUEST).alias("body")).select("body.*")
    return documents.parse(documents.request_documents(parsed)).select("document_id", "format", "raw_content")


@query(
    "request_errors",
    """WITH b AS (SELECT conv_id, turn, role, text, CASE WHEN conv_id % 5 = 1 AND turn % 3 = 0 THEN 1 WHEN conv_id % 5 = 2 AND turn % 2 = 0 THEN 2 WHEN conv_id % 5 = 3 AND turn = 1 THEN 3 ELSE 0 END AS kind FROM conversations),
       d AS (SELECT conv_id, turn, kind, 'html' AS format, '<li>' || text AS content FROM b WHERE kind = 0 AND turn % 4 <> 3
             UNION ALL SELECT conv_id, turn, kind, 'text', role FROM b WHERE kind = 0 AND turn % 4 <> 3
             UNION ALL SELECT conv_id, turn, kind, 'request', CASE kind WHEN 1 THEN '{"documents": [{"text": "' || role WHEN 2 THEN '{"documents": "' || role || '"}' ELSE '{}' END FROM b WHERE kind > 0)
       SELECT conv_id, turn, sha256(content) AS document_id, format, CASE kind WHEN 0 THEN CASE WHEN format = 'text' THEN 'No parser available for format: text' END
         WHEN 3 THEN 'Request body has no documents' ELSE 'Request body is not valid JSON with a list of documents' END AS parse_error FROM d""",
)
def request_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Requests of which some are cut off, of a wrong type or without documents: none vanishes."""
    conversations = table(spark, sf, "conversations", spread=True)
    bodies = request_bodies(conversations).join(conversations.select("conv_id", "turn", "role"), ["conv_id", "turn"])
    broken = F.when((F.col("conv_id") % 5 == 1) & (F.col("turn") % 3 == 0), F.concat(F.lit('{"documents": [{"text": "'), "role"))
    broken = broken.when((F.col("conv_id") % 5 == 2) & (F.col("turn") % 2 == 0), F.concat(F.lit('{"documents": "'), "role", F.lit('"}')))
    broken = broken.when((F.col("conv_id") % 5 == 3) & (F.col("turn") == 1), "{}")
    bodies = bodies.select("conv_id", "turn", F.coalesce(broken, "body").alias("body"))
    return documents.parse(documents.request_documents(documents.parse_requests(bodies))).select("conv_id", "turn", "document_id", "format", "parse_error")

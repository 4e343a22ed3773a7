"""Parsers on small known documents, files and request bodies."""

import json
import time

import pytest
from pyspark.sql import functions as F

from docspark.sources import csv, documents


def parsed(spark, rows, **options):
    df = spark.createDataFrame(rows, "content string, format string")
    return documents.parse(documents.as_documents(df), **options).collect()


def one(spark, content, format, **options):
    return parsed(spark, [(content, format)], **options)[0]


def test_html_basic(spark):
    r = one(spark, "<html><head><title>Test</title></head><body><p>Hello world</p></body></html>", "html")
    assert "Hello world" in r.raw_content and r.metadata["title"] == "Test" and r.metadata["parser"] == "html"


def test_html_script_and_style(spark):
    r = one(spark, "<html><script>var x = 1;</script><style>.foo { color: red }</style>\n<p>Visible content</p></html>", "html")
    assert "var x" not in r.raw_content and "color" not in r.raw_content and "Visible content" in r.raw_content


def test_html_blocks_links_entities(spark):
    r = one(spark, "<div>First</div><DIV>Second</DIV><pre>a &amp;lt; b&nbsp;c &quot;d&quot;</pre><a href=x>1</a><A\nhref=y>2</A><abbr>n</abbr>", "html")
    assert r.raw_content == 'First \nSecond \na < b c "d" 1 2 n' and r.metadata["links_count"] == "2"


def test_empty_documents(spark):
    rows = parsed(spark, [("<html><body></body></html>", "html"), ("", "csv"), ("", "pdf"), ("  ", "html")])
    assert [r.raw_content for r in rows] == ["(empty HTML)", "(empty CSV)", "(empty PDF)", "(empty HTML)"]
    assert rows[2].metadata["pages"] == "0"


def test_csv_counts_and_cut(spark):
    r = one(spark, "name,age,city\nAlice,30,NYC\nBob,25,LA", "csv")
    assert "Alice" in r.raw_content and r.metadata["row_count"] == "2" and r.metadata["column_count"] == "3"
    r = one(spark, "col1,col2\n" + "\n".join(f"val{i},data{i}" for i in range(100)), "csv")
    assert r.raw_content.count("\nRow ") == 100 and r.metadata["row_count"] == "100"


def test_csv_long_record_does_not_overflow(spark):
    r = one(spark, "a\n" + '"x ""y"" ",' * 200_000 + '"open quote', "csv")
    assert r.metadata["row_count"] == "1"


def test_email(spark):
    text = "From: sender@example.com\r\nTo: r@example.com\r\nSubject: Test Email\r\nDate: Mon, 1 Jan 2024 12:00:00 +0000\r\n\r\nHello, test email body."
    r = one(spark, text, "email")
    assert r.metadata["subject"] == "Test Email" and "sender@example.com" in r.raw_content and "test email body" in r.raw_content
    assert r.metadata["date"] == "Mon, 01 Jan 2024 12:00:00 +0000" and r.metadata["attachment_count"] == "0"
    r = one(spark, "From: a@b.com\r\nTo: c@d.com\r\nSubject: Hi\r\nCc: e@f.com\r\n\r\nBody", "email")
    assert (r.metadata["from"], r.metadata["to"], r.metadata["cc"]) == ("a@b.com", "c@d.com", "e@f.com")


def test_email_keeps_other_scripts(spark):
    r = one(spark, "Subject: s\n\nGrüße, 世界", "email")
    assert r.raw_content.endswith("Grüße, 世界")


def test_unknown_format_keeps_the_row(spark):
    r = one(spark, "x", "text")
    assert r.parse_error.startswith("No parser available") and r.raw_content == f"(parse error: {r.parse_error})"
    assert r.metadata == {"error": r.parse_error}
    assert one(spark, "x", "text", text_passthrough=True).raw_content == "x"
    assert "must not be empty" in one(spark, "   ", "text", text_passthrough=True).parse_error


def test_missing_format_or_content(spark):
    rows = parsed(spark, [("x", None), (None, "html")])
    assert [r.parse_error for r in rows] == ["No parser available for format: None", "Document raw_content must not be empty"]


def test_size_limit(spark):
    rows = parsed(spark, [("x" * 2000, "pdf"), ("x", "pdf")], max_size_mb=0.001)
    assert [r.parse_error is None for r in rows] == [False, True]


def test_user_metadata_is_kept_and_parser_wins(spark):
    df = spark.createDataFrame([("<title>t</title>x", "html", "f.html")], "content string, format string, filename string")
    docs = documents.as_documents(df).withColumn("metadata", F.map_concat("metadata", F.create_map(F.lit("title"), F.lit("old"))))
    r = documents.parse(docs).first()
    assert r.metadata["filename"] == "f.html" and r.metadata["title"] == "t"


def test_files_bytes_and_ids(spark, tmp_path):
    (tmp_path / "a.html").write_bytes(b"<p>caf\xc3\xa9 \xff</p>")
    (tmp_path / "b.html").write_bytes(b"<p>caf\xc3\xa9 \xff</p>")
    docs = documents.read_files(spark, str(tmp_path), "html", glob="*.html")
    rows = documents.parse(docs).collect()
    assert sorted(r.metadata["filename"] for r in rows) == ["a.html", "b.html"]
    assert rows[0].raw_content == "café �" and rows[0].document_id == rows[1].document_id
    assert rows[0].size_bytes == len("<p>café �</p>".encode())


def test_requests(spark, tmp_path):
    body = {"documents": [{"text": "<p>x</p>", "format": "html"}, {"text": "y", "format": "docx"}, {"text": "z"}]}
    (tmp_path / "r.json").write_text(json.dumps(body))
    rows = documents.read_requests(spark, str(tmp_path)).collect()
    assert [r.format for r in rows] == ["html", "text", "text"]


def test_preview(spark):
    df = spark.createDataFrame([("é" * 700, "html"), ("é" * 700, "text")], "content string, format string")
    rows = documents.preview(documents.parse(documents.as_documents(df), text_passthrough=True)).collect()
    assert [(r.text_length, len(r.preview)) for r in rows] == [(700, 500), (700, 500)]


@pytest.fixture
def csv_folder(tmp_path):
    for name, n in (("one", 120), ("two", 3)):
        (tmp_path / f"{name}.csv").write_text("id,label\n" + "".join(f'{i},"{name}, {i}"\n' for i in range(n)))
    return str(tmp_path)


def test_csv_files_as_rows_and_text(spark, csv_folder):
    rows = csv.read_rows(spark, csv_folder, ["id", "label"])
    out = {r.file.split("/")[-1]: r for r in csv.table_text(rows, "file", ["ordinal"], ["id", "label"]).collect()}
    assert out["one.csv"].row_count == 120 and out["two.csv"].row_count == 3
    lines = out["one.csv"].raw_content.split("\n")
    assert lines[:4] == ["Columns: id, label", "Total rows: 120", "", "Row 1: id: 0 | label: one, 0"]
    assert lines[-1] == "Row 120: id: 119 | label: one, 119"
    assert out["two.csv"].raw_content.endswith("Row 3: id: 2 | label: two, 2")


def test_csv_file_split_over_tasks_keeps_its_order(spark, csv_folder):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = csv.read_rows(spark, csv_folder, ["id", "label"])
        assert rows.rdd.getNumPartitions() > 4
        lead = csv.first_rows(rows, "file", ["ordinal"], 50).filter(F.col("file").endswith("one.csv"))
        assert [r.id for r in lead.orderBy("row").collect()] == [str(i) for i in range(50)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("unit", ["<script>x", "<", "<p", "<title>", "<style>"])
def test_unclosed_tags_take_linear_time(spark, unit):
    page = "<b>a</b>" + unit * (1_000_000 // len(unit))
    start = time.perf_counter()
    r = one(spark, page, "html")
    assert time.perf_counter() - start < 20 and r.raw_content.startswith("a")


def test_long_csv_is_whole(spark):
    r = one(spark, "n,m\n" + "\n".join(f"{i},x" for i in range(10_000)), "csv")
    assert r.raw_content.endswith("Row 10000: n: 9999 | m: x")


RECORDS = [
    "a,b\n1,2\n",
    'a,b\r\n1,"x\r\ny"\r\n\r\n2,3,4,5\r\n',
    'a,"b\nc"\n\n"1,\n""2""\n",3\nz 5" w,"q" t"r\n"\n\n\n",""\nlast',
    'a\n"open\nto, the "" end\nof it',
    "a,b\r1,2\r\"x\r\ny\",3\r",
    '"x"\n' * 40 + '"y\n' * 30 + '"y',
    "only",
    "\n\nx\n",
    'a,b\n' + '"' + "line, of a cell\n" * 60 + '",2\n3,4\n',
]


@pytest.mark.parametrize("split", [23, 1 << 20])
def test_files_in_splits_give_what_the_whole_text_gives(spark, tmp_path, split):
    for k, text in enumerate(RECORDS):
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
    (tmp_path / "none.csv").write_bytes(b"")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {r.file.split("/")[-1]: r for r in csv.files_text(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    texts = spark.createDataFrame(list(enumerate(RECORDS)), "k int, content string")
    for r in csv.parse(texts).collect():
        mine = got.pop(f"{r.k}.csv")
        assert (mine.raw_content, mine.row_count, mine.column_count) == (r.raw_content, r.meta_row_count, r.meta_column_count), r.k
    assert not got


def test_last_line_feed_of_an_open_quote(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a\n"x\ny\n')
    assert [r.a for r in csv.read_rows(spark, str(tmp_path), ["a"]).collect()] == ["x\ny"]

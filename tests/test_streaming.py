"""The stream gives what the batch gives, once, and survives bad batches."""

import json

import pytest
from pyspark.sql import functions as F

from docspark.operators.extract import ExtractionSchema
from docspark.plans.flow import DocumentFlow
from docspark.operators.dedup import dedup_records, dedup_stream
from docspark.sources.documents import as_documents, read_files
from docspark.plans.delivery_queries import stream_pages, stream_report
from docspark.plans.quality_queries import checked_pages
from docspark.streaming.ingest import append_json, document_files, file_stream, ingest, read_records, read_reports

COLUMNS = ["page_id", "host", "title", "links_count", "success", "route"]
SCHEMA = "page_id bigint, host string, title string, links_count int, success boolean, route string"
PAGES = "page_id bigint, url string, html string"


@pytest.fixture
def pages(spark, tmp_path):
    df = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    df.repartition(5).write.parquet(str(tmp_path / "in"))
    return df, str(tmp_path / "in"), tmp_path


def process(df):
    return checked_pages(df).select(*COLUMNS)


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stream_equals_batch_and_continues(spark, pages):
    df, folder, tmp = pages
    seen = []

    def run():
        ingest(file_stream(spark, folder, PAGES, files_per_batch=2), process, f"{tmp}/out", f"{tmp}/cp", on_progress=seen.append).awaitTermination()

    run()
    assert rows(read_records(spark, f"{tmp}/out", SCHEMA)) == rows(process(df))
    reports = read_reports(spark, f"{tmp}/out").collect()
    assert len(reports) == 3 and sum(r.total_documents for r in reports) == df.count() == sum(s["total_documents"] for s in seen)
    run()  # nothing new: nothing added
    assert read_records(spark, f"{tmp}/out", SCHEMA).count() == df.count()
    df.limit(3).write.mode("append").parquet(folder)
    run()
    assert read_records(spark, f"{tmp}/out", SCHEMA).count() == df.count() + 3


def test_json_lines_are_appended_once(spark, pages):
    df, folder, tmp = pages
    for _ in range(2):
        rows = process(file_stream(spark, folder, PAGES)).select("page_id", "route")
        append_json(rows, f"{tmp}/json", f"{tmp}/cp").awaitTermination()
    assert spark.read.json(f"{tmp}/json").count() == df.count()


def test_the_whole_flow_on_a_stream(spark, pages):
    df, folder, tmp = pages

    def titles():
        return lambda prompt, settings: json.dumps({"start": prompt.split("Text:\n")[1][:20]})

    flow = DocumentFlow(ExtractionSchema("t", {}, {"start": "string"}), titles, formats=("html",))

    def process_documents(batch):
        docs = as_documents(batch.select("page_id", F.col("html").alias("content"), F.lit("html").alias("format")), id="page_id")
        return flow.run(docs).records.select("document_id", "success", "route", "data.start")

    ingest(file_stream(spark, folder, PAGES, files_per_batch=3), process_documents, f"{tmp}/out", f"{tmp}/cp").awaitTermination()
    done = read_records(spark, f"{tmp}/out", "document_id string, success boolean, start string, route string")
    assert done.filter("success and route = 'load' and start is not null").select("document_id").distinct().count() == df.count()


def test_bad_batches_are_kept_and_reported(spark, pages):
    df, folder, tmp = pages

    def fragile(batch):
        if batch.filter("page_id = 7").count():
            raise RuntimeError("page 7")
        return process(batch)

    def broken_callback(report):
        raise ValueError("never mind")

    ingest(file_stream(spark, folder, PAGES, files_per_batch=1), fragile, f"{tmp}/out", f"{tmp}/cp", on_progress=broken_callback, keep_going=True).awaitTermination()
    reports = read_reports(spark, f"{tmp}/out")
    failed = reports.filter("status = 'failed'").collect()
    assert len(failed) == 1 and failed[0].error == "page 7" and failed[0].failed == failed[0].total_documents > 0
    kept = spark.read.schema(PAGES).parquet(f"{tmp}/out/failed")
    assert kept.count() + read_records(spark, f"{tmp}/out", SCHEMA).count() == df.count()
    assert reports.agg(F.sum("total_documents")).first()[0] == df.count()


def test_bad_batches_stop_the_stream_by_default(spark, pages):
    _, folder, tmp = pages

    def fail(batch):
        raise RuntimeError("broken")

    query = ingest(file_stream(spark, folder, PAGES), fail, f"{tmp}/out", f"{tmp}/cp")
    with pytest.raises(Exception, match="broken"):
        query.awaitTermination()


def test_documents_stream_equals_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(5):
        (folder / f"{k}.csv").write_text(f'a,b\n{k},"x\ny"\n')
    (folder / "other.txt").write_text("no")

    def one(df):
        return sorted(map(tuple, df.select("document_id", "format", "content", "size_bytes", F.col("metadata.filename")).collect()))

    def plain(batch):
        return batch.select("document_id", "format", "content", "size_bytes", F.col("metadata.filename"), F.lit(True).alias("success"), F.lit("load").alias("route"))

    ingest(document_files(spark, str(folder), "csv", "*.csv", files_per_batch=2), plain, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = read_records(spark, f"{tmp_path}/out", "document_id string, format string, content string, size_bytes bigint, filename string")
    assert sorted(map(tuple, got.select("document_id", "format", "content", "size_bytes", "filename").collect())) == one(read_files(spark, str(folder), "csv", "*.csv"))
    reports = read_reports(spark, f"{tmp_path}/out").collect()
    assert len(reports) == 3 and all(r.status == "completed" and r.started <= r.ended and r.successful == r.total_documents for r in reports)


def test_dedup_over_micro_batches(spark, tmp_path):
    """Repeats in the same batch, in later ones, and late: each record once while the watermark is behind it."""
    hour = "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, t)"
    waves = [[(0, "a"), (0, "a"), (5, "b")], [(30, "c"), (1, "a"), (4, "b")], [(31, "c"), (2, "d"), (30, "e")]]
    for wave in waves:  # one batch per wave: each is written when the one before is done
        spark.createDataFrame(wave, "t int, v string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        rows = file_stream(spark, f"{tmp_path}/in", "t int, v string", files_per_batch=1).withColumn("at", F.expr(hour))
        append_json(dedup_stream(rows, ["v"], "at", "48 hours").select("v"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    got = sorted(r.v for r in spark.read.json(f"{tmp_path}/out").collect())
    batch = dedup_records(spark.createDataFrame(sum(waves, []), "t int, v string"), ["v"], ["t"])
    assert got == sorted(r.v for r in batch.collect()) == list("abcde")


def test_records_older_than_the_watermark_are_late(spark, tmp_path):
    hour = "timestamp'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, t)"
    for wave in [[(0, "a")], [(100, "b")], [(1, "a"), (2, "c"), (101, "b")]]:
        spark.createDataFrame(wave, "t int, v string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        rows = file_stream(spark, f"{tmp_path}/in", "t int, v string", files_per_batch=1).withColumn("at", F.expr(hour))
        append_json(dedup_stream(rows, ["v"], "at", "10 hours").select("v"), f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    assert sorted(r.v for r in spark.read.json(f"{tmp_path}/out").collect()) == ["a", "b"]


def test_tables_in_parts_are_streamed_whole(spark, tmp_path):
    """A table may be one file or a folder of files; the report is of one batch, however many files there are."""
    sizes = [(k, k % 10) for k in range(240)]
    docs = spark.createDataFrame(sizes, "doc_id bigint, n_chars bigint")
    pages = spark.createDataFrame([(k, f"http://h{k}.org/", f"<title>t{k}</title>") for k in range(9)], "page_id bigint, url string, html string")
    docs.repartition(120).write.parquet(f"{tmp_path}/parts/documents.parquet")
    pages.repartition(3).write.parquet(f"{tmp_path}/parts/pages.parquet")
    (tmp_path / "one").mkdir()
    docs.toPandas().to_parquet(f"{tmp_path}/one/documents.parquet")
    pages.toPandas().to_parquet(f"{tmp_path}/one/pages.parquet")
    good = sum(n % 4 != 0 for _, n in sizes)
    for folder in ("parts", "one"):
        assert [tuple(r) for r in stream_report(spark, f"{tmp_path}/{folder}").collect()] == [(0, 240, good, 240 - good, "completed")]
    parts, one = (sorted(map(tuple, stream_pages(spark, f"{tmp_path}/{f}").collect())) for f in ("parts", "one"))
    assert parts == one and [r[0] for r in parts] == list(range(9))


def test_many_small_files_make_few_batches(spark, tmp_path, monkeypatch):
    """Without a number of files a batch is bounded by its bytes, so the number of batches does not grow with that of the files."""
    from docspark.streaming import ingest as module

    folder = tmp_path / "in"
    folder.mkdir()
    for k in range(130):
        (folder / f"{k}.csv").write_text(f"a,b\n{k},x\n")

    def stream(out):
        plain = lambda batch: batch.select("content", F.lit(True).alias("success"), F.lit("load").alias("route"))
        ingest(document_files(spark, str(folder), "csv"), plain, f"{tmp_path}/{out}", f"{tmp_path}/{out}-cp").awaitTermination()
        reports = sorted(r.total_documents for r in read_reports(spark, f"{tmp_path}/{out}").collect())
        return reports, read_records(spark, f"{tmp_path}/{out}", "content string").distinct().count()

    assert stream("whole") == ([130], 130)
    monkeypatch.setattr(module, "BATCH_BYTES", 700)  # about 1,000 bytes of files
    reports, rows = stream("bounded")
    assert len(reports) == 2 and sum(reports) == rows == 130

"""Replies, scores, routing, reports, sinks, delivery."""

import json
import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from docspark.operators.batches import batch_results, delivery_outcome, progress
from docspark.operators.extract import CallSettings, ExtractionSchema, call_model, extraction_prompt, infer_columns, join_replies, merge_parts, parse_reply, split_text, typed_fields
from docspark.operators.quality import Thresholds, judge, passes, quality_report, reply_agreement
from docspark.plans.flow import DocumentFlow
from docspark.session import materialize
from docspark.sinks.targets import FunctionSink, JdbcSink, JsonSink, StagedSink
from docspark.sources.documents import as_documents


def test_thresholds(spark):
    df = spark.createDataFrame([(0.9, 0.95), (0.5, 0.95), (0.9, 0.5), (None, 1.0), (0.7, 0.9), (math.nan, 1.0)], "c double, a double")
    got = df.select(passes(F.col("c"), F.col("a"), Thresholds(0.7, 0.9)).alias("p")).collect()
    assert [r.p for r in got] == [True, False, False, False, True, False]


def test_reply_parsing(spark):
    replies = ['{"a": 1}', '```json\n{"a": 1}\n```', '```\n{"a": 1}', '{"a": 1', '[{"a": 1}]', '{"a": 1} x', "{}", "", None, ' {"a": 2, "a": 1} ', "null",
               '```json {"a": 1} ```', '{"a": 1}, {"b": 2}', "3"]
    df = spark.createDataFrame(list(enumerate(replies)), "i int, reply string")
    got = typed_fields(parse_reply(df), {"a": "int", "b": "string"}).orderBy("i").collect()
    assert [r.success for r in got] == [True, True, True, False, False, False, False, False, False, True, False, False, False, False]
    assert [r.a for r in got if r.success] == [1, 1, 1, 1]
    assert [r.i for r in got if r.extract_error] == [4, 10, 13]


def test_inferred_columns(spark):
    rows = [('{"a": 1, "b": "x", "c": {"d": [1, 2.5]}, "e f": true}',), ('{"a": 2.5, "b": 3, "g": null}',), ("nope",)]
    parsed = parse_reply(spark.createDataFrame(rows, "reply string"))
    columns = infer_columns(parsed)
    assert columns == {"a": "double", "b": "string", "c": "struct<d:array<double>>", "e f": "boolean", "g": "string"}
    got = typed_fields(parsed, columns).select("a", "b", "c", "`e f`", "g").collect()
    assert [tuple(r) for r in got] == [(1.0, "x", (([1.0, 2.5]),), True, None), (2.5, "3", None, None, None), (None,) * 5]
    assert infer_columns(parsed.filter("not success")) == {}


def judged(spark, rows, **kw):
    return judge(spark.createDataFrame(rows, "judge_reply string, success boolean"), **kw).collect()


def test_routes(spark):
    rows = [("COMPLETENESS: 0.9\nACCURACY: 0.95\nISSUES: x", True), ("COMPLETENESS: 0.9\nACCURACY: 0.2", True), ("COMPLETENESS: 0.1\nACCURACY: 0.2", True),
            ("COMPLETENESS: 1.5\nACCURACY: 1", True), ("COMPLETENESS: 1\nACCURACY: 1", False), ("nothing", True), ("completeness: nan", True)]
    got = judged(spark, rows)
    assert [r.route for r in got] == ["load", "review", "reject", "review", "review", "reject", "review"]
    assert got[0].issues == ["x"] and got[3].completeness == 0.0 and got[5].completeness == 0.5


def test_report(spark):
    df = spark.createDataFrame([(True, False, 1.0, 1.0), (False, True, 0.0, 0.5), (False, False, 0.5, 0.0)], "passed boolean, flagged boolean, completeness double, accuracy double")
    assert tuple(quality_report(df).first()) == (3, 1, 1, 1, 0.5, 0.5, 1 / 3)
    assert tuple(quality_report(df.filter("false")).first()) == (0, 0, 0, 0, 0.0, 0.0, 0.0)


def test_prompt_has_examples_and_the_whole_text(spark):
    schema = ExtractionSchema("s", {"type": "object"}, {}, examples=({"a": 1},))
    text = spark.createDataFrame([("x" * 7000,)], "t string").select(extraction_prompt(F.col("t"), schema).alias("p")).first().p
    assert "x" * 7000 in text and '{"a": 1}' in text and "Instructions" not in text


def test_model_calls_isolate_errors(spark):
    def make():
        def call(prompt, settings):
            assert settings == CallSettings(7, 0.5)
            if "bad" in prompt:
                raise ValueError("no")
            return prompt.upper()

        return call

    df = spark.createDataFrame([("1", "ok", {"k": "v"}), ("2", "bad", {})], "document_id string, prompt string, m map<string,string>")
    got = call_model(df, make, keep=("document_id", "m"), settings=CallSettings(7, 0.5), tasks=2).orderBy("document_id").collect()
    assert [(r.reply, r.call_error, r.m) for r in got] == [("OK", None, {"k": "v"}), (None, "no", {})] and got[0].call_ms >= 0


def test_joined_replies_are_the_latest_and_unique(spark):
    docs = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "document_id string")
    replies = spark.createDataFrame([("1", 0, "a"), ("1", 3, "b"), ("9", 0, "c"), ("2", 1, None)], "document_id string, attempt int, reply string")
    got = sorted((r.document_id or "", r.reply) for r in join_replies(docs, replies).collect())
    assert got == [("", None), ("1", "b"), ("2", None), ("2", None)]


def test_batches_and_progress(spark):
    df = spark.createDataFrame([(0, True, False), (0, False, False), (1, True, True), (1, True, False)], "batch_id int, success boolean, crash boolean")
    results = batch_results(df, crashed="crash").orderBy("batch_id")
    assert [tuple(r) for r in results.collect()] == [(0, 2, 1, 1, "completed"), (1, 2, 0, 2, "failed")]
    assert tuple(progress(results, total_documents=8, elapsed=3.0).first()) == (4, 1, 3, 2, 50.0, 1.33)
    assert tuple(progress(results.filter("false")).first()) == (0, 0, 0, 0, 0.0, 0.0)


def test_delivery(spark):
    log = [("ok", 0, 201, None), ("late", 0, 503, "x"), ("late", 1, 429, "x"), ("late", 2, 200, None), ("never", 0, 500, "x"), ("never", 1, 500, "x"), ("never", 2, 500, "x"),
           ("gone", 0, 404, "y" * 300), ("net", 0, None, "a"), ("net", 1, None, "b"), ("net", 2, None, "c"), ("over", 0, 500, "x"), ("over", 5, 200, None)]
    df = spark.createDataFrame(log, "document_id string, attempt int, status int, error string")
    free = {r.document_id: tuple(r)[1:] for r in delivery_outcome(df).collect()}
    assert free["over"] == (True, 2, 1.0, 1, None) and free["never"] == (False, 3, 3.0, 0, "HTTP 500: x") and free["net"] == (False, 3, 3.0, 0, "c")
    got = {r.document_id: tuple(r)[1:] for r in delivery_outcome(df, max_retries=3).collect()}
    assert got == {
        "ok": (True, 1, 0.0, 1, None), "late": (True, 3, 3.0, 1, None), "never": (False, 3, 7.0, 0, "Max retries exceeded"),
        "gone": (False, 1, 0.0, 0, "HTTP 404: " + "y" * 300), "net": (False, 3, 3.0, 0, "c"), "over": (False, 1, 1.0, 0, "Max retries exceeded"),
    }


def test_json_sink(spark, tmp_path):
    df = spark.createDataFrame([("doc-001", "Alice", 30), ("doc-002", "Bob", None)], "document_id string, name string, age int")
    for sink in (JsonSink(str(tmp_path / "a"), ["name", "age"]), JsonSink(str(tmp_path / "b"), ["name", "age"], per_document=True)):
        for _ in range(2):  # writing a batch again replaces it
            log = sink.write(df, "7").collect()
        assert sorted(r.document_id for r in log) == ["doc-001", "doc-002"] and all(r.success and r.records_written == 1 for r in log)
        lines = [json.loads(line) for f in (tmp_path / sink.path[-1] / "batch=7").rglob("*.json") for line in f.read_text().splitlines()]
        assert sorted((x["document_id"], x["data"]["name"]) for x in lines) == [("doc-001", "Alice"), ("doc-002", "Bob")] and all(x["loaded_at"] for x in lines)


def test_function_sink(spark):
    def make():
        def send(payload):
            doc = json.loads(payload)
            assert doc["data"] == {"v": int(doc["document_id"])}
            if doc["document_id"] == "2":
                raise OSError("net down")
            return (200, None) if doc["document_id"] == "1" else (400, "bad request")

        return send

    df = spark.createDataFrame([("1", 1), ("2", 2), ("3", 3)], "document_id string, v int")
    sink = FunctionSink(make, "http://target", ["v"], delay=0.0, rate_per_second=0.0, tasks=2)
    got = {r.document_id: (r.success, r.error) for r in sink.write(df, "x").collect()}
    assert got == {"1": (True, None), "2": (False, "net down"), "3": (False, "HTTP 400: bad request")}


def test_materialized_table_is_fixed(spark):
    df = materialize(spark.range(100).withColumn("r", F.rand()), "t")
    assert df.collect() == df.collect()


@pytest.mark.parametrize("judging,declared", [(True, True), (False, True), (True, False)])
def test_flow(spark, tmp_path, judging, declared):
    def model():
        return lambda prompt, settings: json.dumps({"Name": " ann ", "Age": "1,200", "note": "", "success": "no", "format": "x"}) if "Ann" in prompt else "?"

    def judge_model():
        def call(prompt, settings):
            assert settings.max_tokens == 512
            assert all(x in prompt for x in ("'name': 'ann'", "'age': 1200", "'city': 'n/a'}", "'success': 'no'", "'format': 'x'")) and "note" not in prompt
            return "COMPLETENESS: 0.9\nACCURACY: 0.95\nISSUES: none"

        return call

    names = {n: "string" for n in ("Name", "Age", "note", "success", "format")}
    flow = DocumentFlow(
        ExtractionSchema("p", {}, names if declared else None), model, judge_model if judging else None,
        mapping={"Name": "name", "Age": "age"}, types={"age": "int"}, defaults={"city": "n/a"},
    )
    docs = spark.createDataFrame([("a", "<p>Ann</p>", "html"), ("b", "<p>Bob</p>", "html"), ("c", "Ann", "text")], "k string, content string, format string")
    sink = JsonSink(str(tmp_path / "out"))
    result = flow.run(as_documents(docs, id="k"), sink=sink, run_id="run")
    rows = {r.document_id: r for r in result.records.collect()}
    data = rows["a"].data
    assert (data.name, data.age, data.city, data["_source"]["format"], data.success, data.format) == ("ann", 1200, "n/a", "html", "no", "x")
    assert data["_enrichment"]["field_count"] == 5 and rows["a"].success is True and rows["a"].format == "html"
    assert not rows["b"].success and not rows["c"].success and rows["c"].parse_error and rows["b"].data is None
    assert [rows[k].route for k in "abc"] == (["load", "review", "review"] if judging else ["load"] * 3)
    assert tuple(result.summary.first()) == ("run", 3, 1, 2, "completed")
    log = {r.document_id: r.success for r in result.load_log.collect()}
    assert log == ({"a": True, "b": False, "c": False} if judging else {"a": True, "b": True, "c": True})
    batches = flow.run_batches(as_documents(docs, id="k"), 2, ["document_id"])
    assert sorted(tuple(r) for r in batches.summary.collect()) == [(0, 2, 1, 1, "completed"), (1, 1, 0, 1, "completed")]
    assert sorted((r.batch_id, r.total_documents, r.passed_count) for r in batches.report.collect()) == [(0, 2, 1 if judging else 2), (1, 1, 0 if judging else 1)]
    flow.run(as_documents(docs, id="k"), sink=sink)  # another run adds, the same run id replaces
    flow.run(as_documents(docs, id="k"), sink=sink, run_id="run")
    assert len(list((tmp_path / "out").iterdir())) == 2
    stored = [json.loads(x) for f in (tmp_path / "out").rglob("*.json") for x in f.read_text().splitlines()]
    assert [x["data"]["age"] for x in stored if x["document_id"] == "a"] == [1200, 1200]


class BrokenSink:
    def write(self, df, batch_id):
        raise OSError("disk full")


def test_sink_failures(spark):
    flow = DocumentFlow(ExtractionSchema("p", {}, {"a": "string"}), lambda: lambda prompt, settings: '{"a": "x"}', formats=("pdf",))
    docs = as_documents(spark.createDataFrame([("1", "text", "pdf")], "k string, content string, format string"), id="k")
    with pytest.raises(OSError):
        flow.run(docs, sink=BrokenSink())
    log = replace(flow, log_sink_errors=True).run(docs, sink=BrokenSink()).load_log.collect()
    assert [tuple(r) for r in log] == [("1", "error", False, 0, "disk full")]


def test_jdbc_options(spark, monkeypatch):
    """Without a database: what is handed to the JDBC writer, and the log that follows."""
    from pyspark.sql.readwriter import DataFrameWriter

    seen = {}

    def options(self, **given):
        seen.update(given)
        return self

    monkeypatch.setattr(DataFrameWriter, "options", options)
    monkeypatch.setattr(DataFrameWriter, "format", lambda self, name: seen.update(format=name) or self)
    monkeypatch.setattr(DataFrameWriter, "save", lambda self: seen.update(columns=self._df.columns))
    df = spark.createDataFrame([("1", {"v": 3}, 0.9)], "document_id string, data struct<v:int>, overall double")
    log = JdbcSink("jdbc:postgresql://u@db/x", "records", schema_name="s", properties={"driver": "d"}).write(df, "b").collect()
    assert seen["format"] == "jdbc" and seen["dbtable"] == "records" and seen["url"].endswith("db/x") and seen["driver"] == "d"
    assert seen["columns"] == ["document_id", "data", "schema_name", "quality_score", "loaded_at", "metadata"]
    assert [tuple(r) for r in log] == [("1", "records@db/x", True, 1, None)]


def test_long_texts_in_parts(spark):
    text = "a" * 2_000_000 + "\nthe last line"
    docs = spark.createDataFrame([("1", text), ("2", ""), ("3", None), ("4", "x" * 1000)], "document_id string, text string")
    parts = split_text(docs, "text", 1000, 100)
    got = parts.groupBy("document_id").agg(F.count("*").alias("n"), F.max("part").alias("last"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))),
        lambda p: F.when(p["part"] == 0, p["text"]).otherwise(F.substring(p["text"], 101, 900))), "").alias("text")).collect()
    assert {r.document_id: r.text for r in got} == {"1": text, "2": "", "3": "", "4": "x" * 1000}
    assert {r.document_id: r.last + 1 for r in got} == {r.document_id: r.n for r in got} and min(r.n for r in got) == 1
    replies = parts.select("document_id", "part", F.when(F.col("text").contains("last line"), '{"end": "found"}').when(F.col("part") == 0, '{"start": 1}').alias("reply"))
    done = {r.document_id: (r.start, r.end) for r in merge_parts(parse_reply(replies), {"start": "int", "end": "string"}).collect()}
    assert done["1"] == (1, "found") and done["2"] == (1, None)


def test_equal_documents_have_outcomes_of_their_own(spark):
    def make():
        answers = iter([200, 404, 200])
        return lambda payload: (next(answers), "no")

    df = spark.createDataFrame([("same",), ("same",), ("other",)], "document_id string").coalesce(1).withColumn("v", F.lit(1))
    rows = FunctionSink(make, "t", ["v"], delay=0.0, rate_per_second=0.0).write(df, "x").collect()
    assert sorted((r.document_id, r.success) for r in rows) == [("other", True), ("same", False), ("same", True)]


def test_reply_agreement(spark):
    rows = [(1, '{"a": 1, "b": "x"}'), (1, '{"a": 1, "b": "y"}'), (1, '{"a": 2}'), (1, "none"), (2, '{"a": null}'), (3, "x"), (3, None), (None, '{"a": [1]}'), (None, '{"a": [1]}')]
    got = {r.k: tuple(r)[1:] for r in reply_agreement(spark.createDataFrame(rows, "k int, reply string"), "k").collect()}
    assert got[1][:3] == (4, 3, 2) and abs(got[1][3] - (2 / 3 + 1 / 3) / 2) < 1e-12
    assert got[2] == (1, 1, 1, 1.0) and got[3] == (2, 0, 0, None) and got[None] == (2, 2, 1, 1.0)
    assert reply_agreement(spark.createDataFrame([], "document_id int, reply string")).count() == 0


def test_batches_with_times_and_errors(spark):
    rows = [(1, 10.0, True, None), (1, 12.5, False, "late"), (1, 11.0, False, "first"), (2, 13.0, True, None)]
    df = spark.createDataFrame(rows, "batch_id int, s double, success boolean, error string").withColumn("at", F.col("s").cast("timestamp"))
    results = batch_results(df, at="at", error="error")
    one, two = results.orderBy("batch_id").collect()
    assert one.error == "first" and two.error is None and two.started == two.ended
    assert progress(results).first().documents_per_second == 1.33  # 4 rows in 3 seconds


def test_staged_batches_count_once(spark, tmp_path):
    df = spark.createDataFrame([("a", "x"), ("b", None), (None, "y")], "document_id string, v string")
    sink = StagedSink(str(tmp_path), ["v"], lambda d: F.when(F.col("v").isNull(), "no v"))
    schema = "document_id string, success boolean, error string"

    def broken(d):
        return F.raise_error(F.lit("down"))

    with pytest.raises(Exception, match="down"):
        StagedSink(str(tmp_path), ["v"], broken).write(df, "1")  # nothing is committed
    first = sorted(map(tuple, sink.write(df, "1").collect()), key=repr)
    again = sorted(map(tuple, sink.write(df.union(df), "1").collect()), key=repr)
    assert first == again and [(r[0], r[2], r[3], r[4]) for r in first] == [("a", True, 1, None), ("b", False, 0, "no v"), (None, False, 0, "Record has no document id")]
    rows = df.write.json  # an attempt that lost the race: staged, not committed
    rows(f"{tmp_path}/rows/batch=1/attempt=other")
    sink._commit(spark, "1", "other")
    sink.write(df.limit(1), "2")
    assert sorted(map(tuple, sink.read(spark, schema).select("batch", "document_id").collect()), key=repr) == [("1", "a"), ("1", "b"), ("1", None), ("2", "a")]

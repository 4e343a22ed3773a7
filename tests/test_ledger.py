"""Replies kept over runs: the second run asks nothing; flows on recorded replies and on a ledger."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from docspark.operators.extract import CallSettings, ExtractionSchema
from docspark.operators.ledger import ReplyLedger, prompt_key
from docspark.plans.flow import NO_REPLY, DocumentFlow
from docspark.sources.documents import as_documents


def counting(folder):
    """A model that leaves one file per call; it fails on prompts with "bad" while the file "broken" is there."""

    def make():
        def call(prompt: str, settings: CallSettings) -> str:
            with open(os.path.join(folder, f"call-{uuid.uuid4().hex}"), "w") as f:
                f.write(prompt)
            if "bad" in prompt and os.path.exists(os.path.join(folder, "broken")):
                raise ConnectionError("busy")
            return f'{{"size": {len(prompt)}}}'

        return call

    return make


@pytest.fixture
def calls(tmp_path):
    folder = str(tmp_path / "calls")
    os.mkdir(folder)

    def made():
        return len([f for f in os.listdir(folder) if f.startswith("call-")])

    made.folder = folder
    return made


def prompts(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "document_id int, prompt string").repartition(4)


def test_second_run_asks_nothing(spark, tmp_path, calls):
    ledger = ReplyLedger(str(tmp_path / "ledger"), "m")
    first = prompts(spark, ["a", "bb", "a", None, "ccc"])
    out = {r.document_id: (r.reply, r.call_error) for r in ledger.ask(first, counting(calls.folder)).collect()}
    assert calls() == 3 and out[0] == out[2] == ('{"size": 1}', None) and out[3] == (None, None)
    again = {r.document_id: (r.reply, r.call_error) for r in ledger.ask(first, counting(calls.folder)).collect()}
    assert calls() == 3 and again == out
    ledger.ask(prompts(spark, ["a", "dddd"]), counting(calls.folder)).collect()
    assert calls() == 4
    # other settings or another model are other prompts
    ledger.ask(first, counting(calls.folder), settings=CallSettings(max_tokens=1)).collect()
    ReplyLedger(ledger.path, "other").ask(first, counting(calls.folder)).collect()
    assert calls() == 10


def test_failed_calls_are_asked_again(spark, tmp_path, calls):
    ledger = ReplyLedger(str(tmp_path / "ledger"))
    open(os.path.join(calls.folder, "broken"), "w").close()
    docs = prompts(spark, ["bad", "good"])
    out = {r.document_id: (r.reply, r.call_error) for r in ledger.ask(docs, counting(calls.folder)).collect()}
    assert out == {0: (None, "busy"), 1: ('{"size": 4}', None)} and calls() == 2
    os.remove(os.path.join(calls.folder, "broken"))
    out = {r.document_id: (r.reply, r.call_error) for r in ledger.ask(docs, counting(calls.folder)).collect()}
    assert out == {0: ('{"size": 3}', None), 1: ('{"size": 4}', None)} and calls() == 3
    assert ledger.read(spark).count() == 3


def test_keys_and_empty_ledger(spark, tmp_path):
    ledger = ReplyLedger(str(tmp_path / "none"))
    assert ledger.read(spark).count() == 0 and ledger.replies(spark).count() == 0
    docs = prompts(spark, ["x", "x", None])
    assert [r.prompt for r in ledger.pending(docs).collect()] == ["x"]
    key = [r[0] for r in docs.select(prompt_key(F.col("prompt"))).collect()]
    assert key.count(None) == 1 and len(set(key)) == 2


def notes(spark):
    return as_documents(spark.createDataFrame([(k, "pdf", f"text number {k}") for k in range(6)], "id int, format string, content string"), id="id")


SCHEMA = ExtractionSchema("note", fields={"type": "object"}, columns={"size": "int"})


def test_flow_with_a_ledger_asks_once(spark, tmp_path, calls):
    flow = DocumentFlow(SCHEMA, counting(calls.folder), ledger=ReplyLedger(str(tmp_path / "ledger")), formats=("pdf",), stamp=False)
    one = flow.run(notes(spark)).records
    assert calls() == 6 and one.filter("success").count() == 6
    two = flow.run(notes(spark)).records
    assert calls() == 6
    assert sorted(r["data"]["size"] for r in one.collect()) == sorted(r["data"]["size"] for r in two.collect())


def test_flow_on_recorded_replies(spark):
    replies = spark.createDataFrame(
        [("0", 0, '{"size": 1}', None), ("0", 1, '{"size": 2}', None), ("1", 0, None, "timeout"), ("2", 0, "no json", None), ("9", 0, '{"size": 9}', None)],
        "document_id string, attempt int, reply string, call_error string",
    )
    flow = DocumentFlow(SCHEMA, formats=("pdf",), stamp=False)
    got = {r.document_id: (r.success, r["data"] and r["data"]["size"], r.extract_error) for r in flow.run(notes(spark), replies=replies).records.collect()}
    assert len(got) == 6 and got["0"] == (True, 2, None) and got["1"] == (False, None, "timeout")
    assert got["2"][0] is False and got["3"] == (False, None, NO_REPLY)
    with pytest.raises(ValueError):
        flow.run(notes(spark))

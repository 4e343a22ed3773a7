"""Python functions that fail on single records, and requests that are broken."""

import json

import pytest
from pyspark.sql import functions as F

from docspark.functions.guard import Guarded
from docspark.operators.enrich import enrich
from docspark.operators.normalize import normalize, transform_fields
from docspark.operators.rules import Rule, list_violations, rule_route, validate
from docspark.sources import documents

VALUES = [4, 0, None, 2, -1, 10**6]


@pytest.fixture(scope="module")
def numbers(spark):
    return spark.createDataFrame([(k, v, str(v)) for k, v in enumerate(VALUES)], "id int, x long, text string").repartition(3)


def rows(df, *columns):
    return [tuple(r) for r in df.orderBy("id").select(*columns).collect()]


def test_transform_keeps_the_value_and_says_why(numbers):
    out = transform_fields(numbers, {"x": Guarded(lambda v: 100 // v, "long"), "absent": Guarded(lambda v: v)})
    assert out.columns == ["id", "x", "text", "x_error"]
    got = rows(out, "x", "x_error")
    assert [v for v, _ in got] == [25, 0, None, 50, -100, 0]
    assert [e is None for _, e in got] == [True, False, False, True, True, True]
    assert "zero" in got[1][1] and "NoneType" in got[2][1]


@pytest.mark.parametrize("returns", ["string", "long", "double", "boolean"])
def test_results_of_another_kind_are_errors(numbers, returns):
    out = rows(numbers.withColumn("r", Guarded(lambda v: {4: "a", 0: 1, 2: 1.5, -1: None, 10**6: 2**70}[v], returns)(F.col("x"))), "r.value", "r.error")
    want = {"string": ["a", None, None, None, None, None], "long": [None, 1, None, None, None, None], "double": [None, 1.0, None, 1.5, None, float(2**70)], "boolean": [True, True, None, True, None, True]}[returns]
    assert [v for v, _ in out] == want
    assert [e is None for v, e in out] == [v is not None or k == 4 for k, v in enumerate(want)]


def test_a_series_that_fails_is_halved(numbers):
    def fails(s):
        if s.isna().any() or (s == 0).any():
            raise ValueError("a bad row")
        return s * 2

    out = rows(numbers.withColumn("r", Guarded(fails, "double", whole=True)(F.col("x"))), "r.value", "r.error")
    assert out == [(8.0, None), (None, "a bad row"), (None, "a bad row"), (4.0, None), (-2.0, None), (2e6, None)]
    short = rows(numbers.withColumn("r", Guarded(lambda s: s.head(0), "double", whole=True)(F.col("x"))), "r.error")
    assert {e for (e,) in short} == {"0 results for 1 rows"}


def test_unknown_kind_is_an_error():
    with pytest.raises(ValueError):
        Guarded(str, "date")


def test_rule_that_fails_is_a_warning(numbers):
    checked = validate(numbers, [Rule("big", "x", "custom", message="too small", predicate=Guarded(lambda v: 10 // v > 1, "boolean"))])
    found = {r.id: (r.severity, r.message, r.actual_value) for r in list_violations(checked, ["id"]).collect()}
    assert set(found) == {1, 2, 4, 5}
    assert found[1][0] == "warning" and found[1][1].startswith("Custom validation error: ") and found[1][2] == "0"
    assert found[4] == ("error", "too small", "-1")
    assert rows(checked.withColumn("route", rule_route(F.col("validation"))), "route") == [("load",), ("review",), ("review",), ("load",), ("reject",), ("reject",)]


def test_computed_field_of_the_whole_record(numbers):
    out = enrich(numbers, ["x", "text"], computed={"both": Guarded(lambda r: r["text"] + str(1 // r["x"]))}, stamp=False)
    assert not [c for c in out.columns if c.endswith("_result")]
    got = rows(out, "both", "both_error")
    assert [v for v, _ in got] == ["40", None, None, "20", "-1-1", "10000000"]
    assert [e is None for _, e in got] == [True, False, False, True, True, True]


def test_normalize_goes_on_after_a_failure(numbers):
    out = normalize(numbers, mapping={"text": "t"}, transforms={"x": Guarded(lambda v: 8 // v, "long")}, defaults={"x": 7})
    assert rows(out, "x") == [(2,), (0,), (7,), (4,), (-8,), (0,)]


def test_broken_requests_leave_a_trace(spark, tmp_path):
    good = json.dumps({"documents": [{"text": "<p>x</p>", "format": "html"}, {"text": "y"}]})
    lines = [good, '{"documents": [{"text": "cut', '{"documents": 5}', "{}", "", "no json", '{"documents": []}']
    (tmp_path / "r.json").write_text("\n".join(lines))
    found = documents.parse(documents.read_requests(spark, str(tmp_path))).collect()
    errors = [r.parse_error for r in found if r.format == "request"]
    assert sorted(errors) == sorted([documents.BROKEN_REQUEST] * 3 + [documents.NO_DOCUMENTS])
    assert len(found) == 6 and {r.format for r in found} == {"html", "text", "request"}
    assert all(r.raw_content == f"(parse error: {r.parse_error})" for r in found if r.parse_error)

"""Cleaning, normalizing, enriching and rules on small known records."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from docspark.functions.dates import spark_format
from docspark.operators.clean import FieldRule, clean, clean_summary
from docspark.operators.dedup import dedup_records
from docspark.operators.enrich import SetWhen, enrich
from docspark.operators.joins import lookup
from docspark.operators.normalize import coerce, fill_defaults, normalize, rename, to_bool
from docspark.operators.rules import WARNING, Rule, in_range, matches, required, validate


def frame(spark, schema, *rows):
    return spark.createDataFrame(list(rows), schema)


# ---- cleaning ----


def test_clean_white_space(spark):
    r = clean(frame(spark, "name string, city string", ("  John   Doe  ", "\tNew York\t"))).first()
    assert (r.name, r.city) == ("John Doe", "New York")


def test_clean_empty_fields(spark):
    r = clean_summary(frame(spark, "name string, empty string, none_val string, zero int", ("Alice", "", None, 0))).first()
    assert (r.name, r.empty, r.none_val, r.zero, r.original_fields, r.cleaned_fields) == ("Alice", None, None, 0, 3, 2)


def test_clean_nested_values(spark):
    schema = "person struct<name:string,age:int>, tags array<string>, notes map<string,string>, nums array<int>, rows array<struct<city:string>>"
    r = clean(
        frame(spark, schema, (("  Bob  ", 30), [" a ", None, " "], {"k": " v ", "e": " "}, [1, None], [(" X ",), None])), {"city": FieldRule(lowercase=True), "k": FieldRule(uppercase=True)}
    ).first()
    assert r.person.name == "Bob" and r.person.age == 30 and r.tags == ["a", None] and r.notes == {"k": "V"}
    assert r.nums == [1] and r.rows[0].city == "x" and len(r.rows) == 1


def test_clean_rules_at_any_depth(spark):
    df = frame(spark, "text string, inner struct<text:string>, text_list array<string>", ("<b>Bold</b> text", ("<i>x</i>",), ["<u>y</u>"]))
    r = clean(df, {"text": FieldRule(strip_html=True), "text_list": FieldRule(strip_html=True)}).first()
    assert (r.text, r.inner.text, r.text_list) == ("Bold text", "x", ["y"])


def test_clean_dates_and_patterns(spark):
    df = frame(spark, "d string, p string, q string", ("01/15/2024", "order 77 of 9", "none"))
    r = clean(df, {"d": FieldRule(date_format="%Y-%m-%d"), "p": FieldRule(pattern=r"\d+"), "q": FieldRule(pattern=r"x*")}).first()
    assert (r.d, r.p, r.q) == ("2024-01-15", "77", None)


def test_date_formats():
    assert spark_format("%d.%m.%Y at %H:%M") == "dd.MM.y 'at' HH:mm"
    with pytest.raises(ValueError):
        spark_format("%Q")


# ---- normalizing ----


def test_rename(spark):
    df = rename(frame(spark, "first_name string, amt string", ("Alice", "100")), {"first_name": "name", "amt": "amount"})
    assert df.columns == ["name", "amount"]


def test_rename_collision_keeps_the_last_value(spark):
    df = frame(spark, "a string, b string, c int", ("x", "y", 1), ("x", None, 2))
    assert [r.v for r in rename(df, {"a": "v", "b": "v"}).orderBy("c").collect()] == ["y", "x"]


def test_coercions(spark):
    df = frame(spark, "amount string, price string, active string, tags string, n int", ("1,234", "$99.99", "yes", "python, data, etl", 5))
    r = coerce(df, {"amount": "int", "price": "float", "active": "bool", "tags": "list", "n": "str", "x": "int"}).first()
    assert (r.amount, r.price, r.active, r.tags, r.n) == (1234, 99.99, True, ["python", "data", "etl"], "5")


def test_failed_coercion_keeps_the_text_and_blocks_the_default(spark):
    df = normalize(frame(spark, "a string", ("$5",), (None,), ("-7.9",)), types={"a": "int"}, defaults={"a": 1})
    assert [(r.a, r.a_raw) for r in df.collect()] == [(None, "$5"), (1, None), (-7, None)]


def test_truth_of_other_types(spark):
    df = frame(spark, "a int, b double, c array<int>", (0, 0.0, []), (3, 0.5, [0]))
    got = df.select(*[to_bool(F.col(f.name), f.dataType) for f in df.schema]).collect()
    assert [tuple(r) for r in got] == [(False, False, False), (True, True, True)]


def test_defaults_transforms_and_only(spark):
    df = normalize(
        frame(spark, "name string, email string, other int", ("Test", "  USER@EXAMPLE.COM  ", 1)),
        transforms={"email": lambda c: F.trim(F.lower(c)), "missing": F.lower}, defaults={"status": "active", "score": 0}, only=["name", "email", "status", "score"],
    )
    assert tuple(df.first()) == ("Test", "user@example.com", "active", 0) and df.columns == ["name", "email", "status", "score"]


def test_empty_text_is_no_missing_value(spark):
    assert fill_defaults(frame(spark, "a string", ("",)), {"a": "x"}).first().a == ""


# ---- enriching ----


def test_enrichment_block(spark):
    r = enrich(frame(spark, "name string, email string", ("Alice", "alice@example.com")), ["name", "email"]).first()
    want = hashlib.sha256(json.dumps({"name": "Alice", "email": "alice@example.com"}, sort_keys=True).encode()).hexdigest()
    assert r["_enrichment"]["record_hash"] == want and r["_enrichment"]["field_count"] == 2 and r["_enrichment"]["processed_at"]


def test_completeness_modes(spark):
    df = frame(spark, "a string, b string, c string, d string", ("value", None, "value", ""))
    assert enrich(df, df.columns, presence="declared").first()["_enrichment"]["completeness"] == 0.5
    assert enrich(df, df.columns).first()["_enrichment"]["completeness"] == 0.667
    assert enrich(frame(spark, "a string", (None,)), ["a"]).first()["_enrichment"]["completeness"] == 0.0


def test_computed_and_conditional_fields(spark):
    df = frame(spark, "first string, last string, status string", ("John", "Doe", "premium"), ("Jane", "Roe", None))
    done = enrich(
        df, df.columns, computed={"full_name": "concat(first, ' ', last)", "n": lambda d: F.length(d["first"])},
        rules=[SetWhen("status", "premium", {"tier": "gold"}), SetWhen("tier", "gold", {"status": "vip"}), SetWhen("status", None, {"tier": "none"})],
    ).collect()
    assert [(r.full_name, r.n, r.tier, r.status) for r in done] == [("John Doe", 4, "gold", "vip"), ("Jane Roe", 4, None, None)]
    declared = enrich(df, df.columns, rules=[SetWhen("status", None, {"tier": "none"})], presence="declared").collect()
    assert [r.tier for r in declared] == [None, "none"]


def test_source_info(spark):
    df = frame(spark, "name string, m map<string,string>", ("Test", {"parser": "html", "ingested_at": "2024-01-01"}), ("x", {}), ("y", {"q": "1"}))
    assert [r["_source"] and tuple(r["_source"]) for r in enrich(df, ["name"], metadata="m").collect()] == [("html", "2024-01-01"), None, ("unknown", "")]


def test_text_analytics_only_for_long_texts(spark):
    long = "mail me at a.b@c.org or 555-123-4567, see https://x.org now please"
    df = frame(spark, "a string, _b string, c string", (long, long, "x" * 50), ("short", long, "x" * 51))
    first, second = [r["_text_analytics"] for r in enrich(df, df.columns, computed={"d": "concat(a, ' ')"}, longer_than=50).collect()]
    assert set(first) == {"a", "d"} and tuple(first["a"]) == (len(long), len(long.split()), True, True, True)
    assert set(second) == {"c"} and tuple(second["c"]) == (51, 1, False, False, False)
    assert enrich(frame(spark, "a string", ("short",)), ["a"], longer_than=50).first()["_text_analytics"] is None
    assert tuple(enrich(frame(spark, "a string", ("",)), ["a"]).first()["_text_analytics"]["a"]) == (0, 0, False, False, False)


# ---- rules ----


def verdicts(spark, schema, rows, rules):
    return [r.validation for r in validate(frame(spark, schema, *rows), rules).collect()]


def test_required(spark):
    got = verdicts(spark, "name string", [("Alice",), (None,), ("   ",)], [required("name")])
    assert [v.valid for v in got] == [True, False, False] and got[1].error_count == 1


def test_required_on_missing_column_and_empty_list(spark):
    got = verdicts(spark, "tags array<int>", [([],)], [required("tags"), required("nothing")])
    assert [x.rule for x in got[0].violations] == ["required_nothing"]


def test_format(spark):
    rule = matches("email", r"^[\w.-]+@[\w.-]+\.\w+$")
    got = verdicts(spark, "email string", [("user@example.com",), ("not-an-email",), (None,), ("é@ü.de",)], [rule])
    assert [v.valid for v in got] == [True, False, True, True]


def test_range(spark):
    got = verdicts(spark, "age int", [(30,), (-1,), (200,), (0,), (150,), (None,)], [in_range("age", 0, 150)])
    assert [v.valid for v in got] == [True, False, False, True, True, True]
    got = verdicts(spark, "x string", [("nan",), (" 7 ",), ("x",), ("9",)], [Rule("r", "x", "range", max=8)])
    assert [v.violations and v.violations[0].message for v in got] == [[], [], "Field 'x' is not numeric", "Value 9.0 above maximum 8"]


def test_custom(spark):
    got = verdicts(spark, "count int", [(4,), (3,), (None,)], [Rule("even", "count", "custom", message="odd", predicate=lambda c: c % 2 == 0)])
    assert [v.valid for v in got] == [True, False, True] and got[2].warning_count == 1


def test_cross_field(spark):
    rule = Rule("zip", "city", "cross_field", other="zip", condition="not_empty_if")
    got = verdicts(spark, "city string, zip string", [("NYC", "10001"), ("NYC", None), (None, None), (" ", "")], [rule])
    assert [v.valid for v in got] == [True, False, True, False]
    got = verdicts(spark, "a string, b int", [("1", 1), (None, None)], [Rule("eq", "a", "cross_field", other="b", condition="equals")])
    assert [v.valid for v in got] == [False, True] and got[0].violations[0].actual_value == "1 vs 1"


def test_many_rules_and_severities(spark):
    rules = [required("name"), matches("email", r".+@.+"), in_range("age", 0, 150), required("phone", severity=WARNING), Rule("x", "name", "mystery")]
    got = verdicts(spark, "name string, email string, age int", [("A", "a@b", 3), (None, "bad", -5)], rules)
    assert got[0].valid and got[0].warning_count == 1
    assert not got[1].valid and got[1].error_count == 3 and [v.rule for v in got[1].violations] == ["required_name", "format_email", "range_age", "required_phone"]


def test_null_is_no_false(spark):
    from docspark.operators.normalize import coerce

    df = spark.createDataFrame([(0, None, None), (2, True, "no")], "a int, b boolean, c string")
    assert [tuple(r) for r in coerce(df, {"a": "bool", "b": "bool", "c": "bool"}).select("a", "b", "c").collect()] == [(False, None, None), (True, True, False)]


def test_constants_that_do_not_fit_fail_the_plan(spark):
    df = frame(spark, "a int, b string", (1, "x"), (None, None))
    for value in ("n/a", 1 << 40, 2.5):
        with pytest.raises(ValueError, match="a is of type int"):
            fill_defaults(df, {"a": value})
    with pytest.raises(ValueError, match="a is of type int"):
        enrich(df, ["a"], rules=[SetWhen("b", "x", {"a": "high"})])
    assert [tuple(r) for r in fill_defaults(df, {"a": 7, "b": 3}).collect()] == [(1, "x"), (7, "3")]


def test_failing_expressions_leave_their_record_alone(spark):
    df = frame(spark, "a int, b string", (0, "x"), (5, "3"))
    got = enrich(df, ["a"], computed={"c": "10 / a", "d": "cast(b as int)"}).collect()
    assert [(r.c, r.d) for r in got] == [(None, None), (2.0, 3)]


def test_equal_records_and_lookups(spark):
    df = frame(spark, "k int, a string, b int", (3, "x", 1), (1, "x", 1), (2, "x", None), (4, None, None), (5, None, None))
    got = sorted((r.k, r.copies) for r in dedup_records(df, ["a", "b"], ["k"]).collect())
    assert got == [(1, 2), (2, 1), (4, 2)] and all(len(r.record_hash) == 64 for r in dedup_records(df, ["a"], ["k"]).collect())
    assert dedup_records(df.filter("false"), ["a"], ["k"]).count() == 0
    names = frame(spark, "b int, n string", (1, "q"), (1, "p"), (None, "z"))
    assert sorted(((r.k, r.n) for r in lookup(df, names, "b", ["n"]).collect())) == [(1, "p"), (2, None), (3, "p"), (4, None), (5, None)]

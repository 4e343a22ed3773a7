"""Rules, prompts, replies, scores, routing, reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.guard import Guarded
from docspark.operators.clean import FieldRule, clean
from docspark.operators.enrich import enrich
from docspark.operators.extract import (
    ExtractionSchema, extraction_prompt, join_replies, judge_prompt, merge_parts, parse_judgement, parse_reply, split_text, typed_fields,
)
from docspark.operators.quality import THRESHOLDS, extract_response as respond
from docspark.operators.quality import batch_responses, judge, passes, quality_report as report, skip_judging
from docspark.operators.rules import INFO, WARNING, Rule, in_range, list_violations, matches, required, rule_route, validate
from docspark.plans.parse_queries import SQL_LINKS, SQL_TITLE, sql_html_text
from docspark.plans.record_queries import SQL_CODES, SQL_SPARSE, order_codes, sparse_customers, sql_int_error
from docspark.plans.registry import query, sql_float, sql_strip, table
from docspark.sources import html

# ---- rules; each query lists the violations it finds ----


def found(df: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    return list_violations(validate(df, rules), [key])


@query(
    "rule_required",
    f"""SELECT c_custkey, 'required_name' AS rule, 'name' AS field, 'error' AS severity, 'Field ''name'' is required' AS message, name AS actual_value
          FROM ({SQL_SPARSE}) WHERE name IS NULL OR trim(name) = ''
        UNION ALL SELECT c_custkey, 'required_balance', 'balance', 'info', 'no balance', NULL FROM ({SQL_SPARSE}) WHERE balance IS NULL
        UNION ALL SELECT c_custkey, 'required_phone', 'phone', 'warning', 'Field ''phone'' is required', NULL FROM customer""",
)
def rule_required(spark: SparkSession, sf: str) -> DataFrame:
    rules = [required("name"), required("balance", "no balance", INFO), required("phone", severity=WARNING)]
    return found(sparse_customers(spark, sf), rules, "c_custkey")


@query(
    "rule_format",
    f"""SELECT c_custkey, 'format_name' AS rule, 'name' AS field, 'error' AS severity, 'Field ''name'' does not match expected format' AS message, name AS actual_value
          FROM ({SQL_SPARSE}) WHERE NOT regexp_matches(name, '^( Customer#\\d{{8}}[0-4])')
        UNION ALL SELECT c_custkey, 'format_balance', 'balance', 'error', 'Field ''balance'' does not match expected format', balance::VARCHAR
          FROM ({SQL_SPARSE}) WHERE NOT regexp_matches(balance::VARCHAR, '^(\\d+\\.\\d\\d$)')""",
)
def rule_format(spark: SparkSession, sf: str) -> DataFrame:
    rules = [matches("name", r" Customer#\d{8}[0-4]"), matches("balance", r"\d+\.\d\d$"), matches("phone", r"\d+")]
    return found(sparse_customers(spark, sf), rules, "c_custkey")


SQL_READING = """SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'nan' WHEN 1 THEN 'high' WHEN 2 THEN ' ' || value || ' ' WHEN 3 THEN NULL ELSE value::VARCHAR END AS reading, value FROM events"""


@query(
    "rule_range",
    f"""WITH e AS ({SQL_READING}), f AS (SELECT *, {sql_float('reading')} AS n FROM e)
        SELECT event_id, 'range_reading' AS rule, 'reading' AS field, 'error' AS severity,
          CASE WHEN n IS NULL THEN 'Field ''reading'' is not numeric' ELSE 'Field ''reading'' is out of expected range' END AS message, reading AS actual_value
          FROM f WHERE reading IS NOT NULL AND (n IS NULL OR (NOT isnan(n) AND (n < 2 OR n > 20)))
        UNION ALL SELECT event_id, 'top', 'value', 'warning', CASE WHEN value < 1 THEN 'Value ' || value || ' below minimum 1.0' ELSE 'Value ' || value || ' above maximum 30' END, value::VARCHAR
          FROM f WHERE value < 1 OR value > 30""",
)
def rule_range(spark: SparkSession, sf: str) -> DataFrame:
    reading = F.expr(
        "case event_id % 7 when 0 then 'nan' when 1 then 'high' when 2 then concat(' ', value, ' ') when 3 then null else cast(value as string) end"
    )
    events = table(spark, sf, "events", spread=True).select("event_id", reading.alias("reading"), "value")
    rules = [in_range("reading", 2, 20), Rule("top", "value", "range", WARNING, min=1.0, max=30), in_range("missing", 0, 1)]
    return found(events, rules, "event_id")


@query(
    "rule_cross_equals",
    f"""SELECT c_custkey, 'same' AS rule, 'name' AS field, 'error' AS severity, '''name'' must equal ''segment''' AS message,
          coalesce(name, 'None') || ' vs ' || coalesce(segment, 'None') AS actual_value
        FROM ({SQL_SPARSE}) WHERE name IS DISTINCT FROM segment""",
)
def rule_cross_equals(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("same", "name", "cross_field", other="segment", condition="equals")]
    return found(sparse_customers(spark, sf), rules, "c_custkey")


@query(
    "rule_cross_not_empty",
    f"""SELECT c_custkey, 'needs_segment' AS rule, 'name' AS field, 'error' AS severity, '''segment'' required when ''name'' is set' AS message, segment AS actual_value
          FROM ({SQL_SPARSE}) WHERE name <> '' AND coalesce(segment, '') = ''
        UNION ALL SELECT c_custkey, 'needs_balance', 'c_nationkey', 'warning', 'balance missing', balance::VARCHAR
          FROM ({SQL_SPARSE}) WHERE c_nationkey <> 0 AND coalesce(balance, 0) = 0""",
)
def rule_cross_not_empty(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        Rule("needs_segment", "name", "cross_field", other="segment", condition="not_empty_if"),
        Rule("needs_balance", "c_nationkey", "cross_field", WARNING, "balance missing", other="balance", condition="not_empty_if"),
    ]
    return found(sparse_customers(spark, sf), rules, "c_custkey")


@query(
    "rule_cross_greater",
    """SELECT l_orderkey, 'dearer' AS rule, 'l_quantity' AS field, 'error' AS severity, '''l_quantity'' must be greater than ''l_linenumber''' AS message,
         l_quantity || ' vs ' || l_linenumber AS actual_value FROM lineitem WHERE NOT l_quantity > l_linenumber""",
)
def rule_cross_greater(spark: SparkSession, sf: str) -> DataFrame:
    rules = [Rule("dearer", "l_quantity", "cross_field", other="l_linenumber", condition="greater_than")]
    return found(table(spark, sf, "lineitem"), rules, "l_orderkey")


@query(
    "rule_custom",
    f"""SELECT c_custkey, 'even' AS rule, 'c_nationkey' AS field, 'error' AS severity, 'must be even' AS message, c_nationkey::VARCHAR AS actual_value
          FROM customer WHERE c_nationkey % 2 <> 0
        UNION ALL SELECT c_custkey, 'rich', 'balance', CASE WHEN balance IS NULL THEN 'warning' ELSE 'info' END,
          CASE WHEN balance IS NULL THEN 'Custom validation error' ELSE 'not rich' END, balance::VARCHAR
          FROM ({SQL_SPARSE}) WHERE balance IS NULL OR balance <= 5000""",
)
def rule_custom(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        Rule("even", "c_nationkey", "custom", message="must be even", predicate=lambda c: c % 2 == 0),
        Rule("rich", "balance", "custom", INFO, "not rich", predicate=lambda c: c > 5000),
    ]
    return found(sparse_customers(spark, sf), rules, "c_custkey")


@query(
    "rule_guarded",
    f"""SELECT o_orderkey, 'even' AS rule, 'code' AS field, CASE WHEN TRY_CAST(code AS BIGINT) IS NULL THEN 'warning' ELSE 'error' END AS severity,
          CASE WHEN TRY_CAST(code AS BIGINT) IS NULL THEN 'Custom validation error: ' || {sql_int_error('code')} ELSE 'must be even' END AS message, code AS actual_value
        FROM ({SQL_CODES}) WHERE TRY_CAST(code AS BIGINT) IS NULL OR TRY_CAST(code AS BIGINT) % 2 <> 0""",
)
def rule_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """A Python predicate: records it fails on get a warning with the reason."""
    rules = [Rule("even", "code", "custom", message="must be even", predicate=Guarded(lambda v: int(v) % 2 == 0, "boolean"))]
    return found(order_codes(spark, sf), rules, "o_orderkey")


@query(
    "rules_suite",
    f"""WITH v AS (SELECT c_custkey, (name IS NULL OR trim(name) = '') AS a, coalesce(balance < 0 OR balance > 9000, false) AS b,
            coalesce(NOT regexp_matches(segment, '^(?:[A-Z]+$)'), false) AS c, (c_nationkey % 2 <> 0) AS d FROM ({SQL_SPARSE}))
        SELECT c_custkey, NOT (a OR b) AS valid, a::INT + b::INT AS error_count, c::INT AS warning_count,
          array_to_string(list_filter([CASE WHEN a THEN 'required_name' END, CASE WHEN c THEN 'format_segment' END, CASE WHEN b THEN 'range_balance' END,
            CASE WHEN d THEN 'even' END], lambda x: x IS NOT NULL), ',') AS rules,
          CASE WHEN a OR b THEN 'reject' WHEN c THEN 'review' ELSE 'load' END AS route FROM v""",
)
def rules_suite(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        required("name"),
        matches("segment", r"[A-Z]+$", severity=WARNING),
        in_range("balance", 0, 9000),
        Rule("even", "c_nationkey", "custom", INFO, "odd nation", predicate=lambda c: c % 2 == 0),
        Rule("ignored", "name", "no_such_check"),
    ]
    checked = validate(sparse_customers(spark, sf), rules)
    v = F.col("validation")
    return checked.select(
        "c_custkey", v["valid"].alias("valid"), v["error_count"].alias("error_count"), v["warning_count"].alias("warning_count"),
        F.array_join(F.transform(v["violations"], lambda x: x["rule"]), ",").alias("rules"), rule_route(v).alias("route"),
    )


# ---- prompts ----

NOTE_SCHEMA = ExtractionSchema(
    name="note",
    fields={"type": "object", "properties": {"title": {"type": "string"}, "words": {"type": "integer"}}},
    columns={"title": "string", "words": "bigint"},
    instructions="Use the first line as title.",
)
SQL_EXTRACT_PROMPT = """'Extract structured data from the following text.' || chr(10) || chr(10) || 'Schema: {
  "type": "object",
  "properties": {
    "title": {
      "type": "string"
    },
    "words": {
      "type": "integer"
    }
  }
}
Instructions: Use the first line as title.

Text:
' || text || '

Respond with ONLY valid JSON matching the schema.'"""


@query("prompt_build", f"SELECT doc_id, {SQL_EXTRACT_PROMPT} AS prompt FROM documents")
def prompt_build(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents", spread=True).select("doc_id", extraction_prompt(F.col("text"), NOTE_SCHEMA).alias("prompt"))


@query(
    "judge_prompt",
    """SELECT doc_id, 'Evaluate the quality of this data extraction.

Source text:
' || text || '

Extracted data:
{''lang'': ''' || lang || ''', ' || CASE WHEN doc_id % 2 = 0 THEN '''source'': "it''s ' || source || '", ' ELSE '' END || '''score'': ' || (n_chars / 4)::VARCHAR
  || ', ''tags'': [''' || lang || ''', None, ' || CASE WHEN n_chars > 500 THEN '''a\\nb''' ELSE '''ok''' END || '], ''long'': ' || CASE WHEN n_chars > 500 THEN 'True' ELSE 'False' END || '}

Score on:
1. COMPLETENESS (0-1): Are all relevant fields captured?
2. ACCURACY (0-1): Are extracted values correct?
3. ISSUES: List any problems found.

Format:
COMPLETENESS: 0.X
ACCURACY: 0.X
ISSUES: list' AS prompt FROM documents""",
)
def judge_prompts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents", spread=True).select(
        "doc_id", "text", "lang",
        F.when(F.col("doc_id") % 2 == 0, F.concat(F.lit("it's "), F.col("source"))).alias("source"),
        (F.col("n_chars") / 4).alias("score"),
        F.array("lang", F.lit(None), F.when(F.col("n_chars") > 500, "a\nb").otherwise("ok")).alias("tags"),
        (F.col("n_chars") > 500).alias("long"),
    )
    record = {n: (F.col(n), docs.schema[n].dataType) for n in ("lang", "source", "score", "tags", "long")}
    return docs.select("doc_id", judge_prompt(F.col("text"), record).alias("prompt"))


# ---- replies ----


def order_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Extraction replies made from orders: plain, fenced, half-fenced, broken, list, trailing text, empty, none."""
    body = "to_json(named_struct('status', o_orderstatus, 'total', o_totalprice, 'priority', o_orderpriority))"
    reply = (
        f"case o_orderkey % 9 when 0 then {body} when 1 then concat('```json\\n', {body}, '\\n```') when 2 then concat('\\n```\\n', {body}) "
        f"when 3 then substring({body}, 1, length({body}) - 1) when 4 then concat('[', {body}, ']') when 5 then concat({body}, ' done') "
        f"when 6 then '{{}}' when 7 then null else concat('{{\"status\": \"x\", \"total\": \"n/a\", \"more\": [1], \"status\": \"', o_orderstatus, '\"}}') end"
    )
    return table(spark, sf, "orders", spread=True).select("o_orderkey", F.expr(reply).alias("reply"))


@query(
    "extract_parse",
    """SELECT o_orderkey, o_orderkey % 9 IN (0, 1, 2, 8) AS success, CASE WHEN o_orderkey % 9 IN (0, 1, 2, 8) THEN o_orderstatus END AS status,
         CASE WHEN o_orderkey % 9 IN (0, 1, 2) THEN o_totalprice END AS total, CASE WHEN o_orderkey % 9 IN (0, 1, 2) THEN o_orderpriority END AS priority,
         CASE WHEN o_orderkey % 9 IN (0, 1, 2, 8) THEN 3 WHEN o_orderkey % 9 = 6 THEN 0 END AS n_fields,
         CASE WHEN o_orderkey % 9 = 4 THEN 'reply is not a JSON object' END AS error FROM orders""",
)
def extract_parse(spark: SparkSession, sf: str) -> DataFrame:
    parsed = typed_fields(
        parse_reply(order_replies(spark, sf)), {"status": "string", "total": "double", "priority": "string"}
    )
    return parsed.select(
        "o_orderkey", "success", "status", "total", "priority",
        F.when(F.col("extracted").isNotNull(), F.size("extracted")).alias("n_fields"), F.col("extract_error").alias("error"),
    )


SCORE_LINES = {
    0: "'COMPLETENESS: ' || x || chr(10) || 'ACCURACY: ' || y || chr(10) || 'ISSUES: none: really'",
    1: "' completeness:' || x || chr(10) || 'Accuracy :  1.0' || chr(10) || 'accuracy: ' || y || chr(13)",
    2: "'COMPLETENESS: 0.1' || chr(10) || 'COMPLETENESS: ' || x || chr(10) || 'ACCURACY: high' || chr(10) || 'ISSUES: a' || chr(10) || 'ISSUES: b'",
    3: "'ACCURACY: ' || y || chr(10) || 'ACCURACY: n/a'",
    4: "'COMPLETENESS: 1' || x || chr(10) || 'ACCURACY: ' || y",
    5: "'COMPLETENESS: nan' || chr(10) || 'ACCURACY: ' || y",
    6: "'Scores -> COMPLETENESS: ' || x || chr(10) || 'ISSUES:'",
}
SQL_REPLIES = (
    "SELECT doc_id, lang, text, quality, doc_id % 13 <> 5 AS success, CASE doc_id % 7 "
    + " ".join(f"WHEN {k} THEN {v}" for k, v in SCORE_LINES.items())
    + " END AS reply FROM (SELECT d.doc_id, d.lang, d.text, l.quality, ((d.doc_id * 7 % 11) / 10.0)::DOUBLE::VARCHAR AS x, "
    "(CASE WHEN l.quality = 1 THEN 0.95 WHEN l.quality = 0 THEN 0.45 ELSE (d.doc_id * 3 % 21) / 20.0 END)::DOUBLE::VARCHAR AS y "
    "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"
)


def judge_replies(spark: SparkSession, sf: str) -> DataFrame:
    """Judge replies in many spellings; the accuracy follows the quality label where there is one."""
    docs = table(spark, sf, "documents", spread=True).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    docs = docs.select(
        "doc_id", "lang", "text", "quality", (F.col("doc_id") % 13 != 5).alias("success"),
        F.expr("cast(cast((doc_id * 7 % 11) / 10.0 as double) as string)").alias("x"),
        F.expr("cast(cast(case when quality = 1 then 0.95 when quality = 0 then 0.45 else (doc_id * 3 % 21) / 20.0 end as double) as string)").alias("y"),
    )
    text = "case doc_id % 7 " + " ".join(f"when {k} then {v}" for k, v in SCORE_LINES.items()) + " end"
    return docs.withColumn("judge_reply", F.expr(text)).drop("x", "y")


def sql_score(key: str) -> str:
    line = sql_strip("regexp_replace(l, '^[^:]*:', '')")
    return (
        f"coalesce(list_filter(list_transform(list_filter(string_split(reply, chr(10)), lambda l: starts_with(upper({sql_strip('l')}), '{key}:')), "
        f"lambda l: {sql_float(line)}), lambda v: v IS NOT NULL)[-1], 0.5)"
    )


SQL_ISSUES = f"""array_to_string(list_transform(list_filter(string_split(reply, chr(10)), lambda l: starts_with(upper({sql_strip('l')}), 'ISSUES:')),
  lambda l: {sql_strip("regexp_replace(l, '^[^:]*:', '')")}), chr(10))"""
SQL_PARSED = f"SELECT *, {sql_score('COMPLETENESS')} AS pc, {sql_score('ACCURACY')} AS pa, {SQL_ISSUES} AS issue FROM ({SQL_REPLIES})"


@query("judge_parse", f"SELECT doc_id, pc AS completeness, pa AS accuracy, issue AS issues FROM ({SQL_PARSED})")
def judge_parse(spark: SparkSession, sf: str) -> DataFrame:
    scores = parse_judgement(F.col("judge_reply"))
    return judge_replies(spark, sf).select(
        "doc_id", scores["completeness"].alias("completeness"), scores["accuracy"].alias("accuracy"),
        F.array_join(scores["issues"], "\n").alias("issues"),
    )


def sql_passes(c: str, a: str, tc: float, ta: float) -> str:
    return f"(NOT isnan({c}) AND NOT isnan({a}) AND {c} >= {tc} AND {a} >= {ta})"


@query(
    "threshold_gate",
    f"""SELECT doc_id, {sql_passes('pc', 'pa', 0.8, 0.9)} AS base, {sql_passes('pc', 'pa', 0.7, 0.9)} AS development,
          {sql_passes('pc', 'pa', 0.9, 0.95)} AS production, false AS missing FROM ({SQL_PARSED})""",
)
def threshold_gate(spark: SparkSession, sf: str) -> DataFrame:
    scores = parse_judgement(F.col("judge_reply"))
    df = judge_replies(spark, sf).select("doc_id", scores["completeness"].alias("c"), scores["accuracy"].alias("a"))
    gates = {env: passes(F.col("c"), F.col("a"), t) for env, t in THRESHOLDS.items()}
    gates["missing"] = passes(F.lit(None).cast("double"), F.col("a"), THRESHOLDS["base"])
    return df.select("doc_id", *[c.alias(env) for env, c in gates.items()])


SQL_JUDGED = f"""SELECT *, CASE WHEN passed THEN 'load' WHEN flagged THEN 'review' ELSE 'reject' END AS route FROM (
    SELECT *, NOT passed AND (NOT ok OR overall > 0.5) AS flagged FROM (
      SELECT *, ok AND completeness >= 0.7 AND accuracy >= 0.9 AS passed, (completeness + accuracy) / 2 AS overall FROM (
        SELECT *, CASE WHEN ok THEN pc ELSE 0 END AS completeness, CASE WHEN ok THEN pa ELSE 0 END AS accuracy, CASE WHEN ok THEN issue ELSE '' END AS issues FROM (
          SELECT *, success AND NOT isnan(pc) AND NOT isnan(pa) AND pc BETWEEN 0 AND 1 AND pa BETWEEN 0 AND 1 AS ok FROM ({SQL_PARSED})))))"""


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return judge(judge_replies(spark, sf), t=THRESHOLDS["development"])


@query("quality_route", f"SELECT doc_id, completeness, accuracy, overall, issues, passed, flagged, route FROM ({SQL_JUDGED})")
def quality_route(spark: SparkSession, sf: str) -> DataFrame:
    return judged(spark, sf).select(
        "doc_id", "completeness", "accuracy", "overall", F.array_join("issues", "\n").alias("issues"), "passed", "flagged", "route"
    )


@query(
    "quality_skip",
    "SELECT doc_id, 0.0::DOUBLE AS completeness, 0.0::DOUBLE AS accuracy, 1.0::DOUBLE AS overall, true AS passed, false AS flagged, 'load' AS route FROM documents",
)
def quality_skip(spark: SparkSession, sf: str) -> DataFrame:
    done = skip_judging(table(spark, sf, "documents").select("doc_id"))
    return done.select("doc_id", "completeness", "accuracy", "overall", "passed", "flagged", "route")


SQL_REPORT = """count(*) AS total_documents, count(*) FILTER (passed) AS passed_count, count(*) FILTER (NOT passed AND NOT flagged) AS failed_count,
  count(*) FILTER (flagged) AS flagged_count, round_even(coalesce(sum(completeness::DECIMAL(18,17))::DOUBLE / nullif(count(*), 0), 0), 3) AS average_completeness,
  round_even(coalesce(sum(accuracy::DECIMAL(18,17))::DOUBLE / nullif(count(*), 0), 0), 3) AS average_accuracy, coalesce(count(*) FILTER (passed) / nullif(count(*), 0), 0.0) AS pass_rate"""


@query("quality_report", f"SELECT {SQL_REPORT} FROM ({SQL_JUDGED})")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return report(judged(spark, sf))


@query("quality_report_by_lang", f"SELECT lang, {SQL_REPORT} FROM ({SQL_JUDGED}) GROUP BY lang")
def quality_report_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return report(judged(spark, sf), ["lang"])


@query(
    "extract_response",
    f"""SELECT doc_id, CASE WHEN success THEN (pc + pa) / 2 END AS quality_score, CASE WHEN success THEN {sql_passes('pc', 'pa', 0.8, 0.9)} END AS passed_validation,
          CASE WHEN success THEN issue ELSE '' END AS issues, CASE WHEN NOT success THEN 'Extraction produced no results' END AS error FROM ({SQL_PARSED})""",
)
def extract_response(spark: SparkSession, sf: str) -> DataFrame:
    done = respond(judge_replies(spark, sf))
    return done.select("doc_id", "quality_score", "passed_validation", F.array_join("issues", "\n").alias("issues"), "error")


@query(
    "batch_response",
    f"SELECT doc_id::VARCHAR AS document_id, lang AS extracted_lang, overall AS quality_score, passed AS passed_validation, issues FROM ({SQL_JUDGED})",
)
def batch_response(spark: SparkSession, sf: str) -> DataFrame:
    done = judged(spark, sf).withColumns({"document_id": F.col("doc_id").cast("string"), "data": F.struct("lang")})
    return batch_responses(done).select(
        "document_id", F.col("extracted_data.lang").alias("extracted_lang"), "quality_score", "passed_validation",
        F.array_join("issues", "\n").alias("issues"),
    )


@query(
    "join_responses",
    """WITH r AS (SELECT user_id, arg_max(event_type || ' ' || value, event_id) AS reply FROM events GROUP BY user_id)
       SELECT d.doc_id, d.source, r.reply FROM documents d LEFT JOIN r ON d.doc_id = r.user_id""",
)
def join_responses(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the latest of several logged replies."""
    replies = table(spark, sf, "events").select(
        F.col("user_id").alias("doc_id"), F.col("event_id").alias("attempt"), F.concat_ws(" ", "event_type", F.col("value").cast("string")).alias("reply")
    )
    return join_replies(table(spark, sf, "documents").select("doc_id", "source"), replies, key="doc_id")


# ---- pages end to end, no model needed ----

PAGE_RULES = [
    required("title"),
    matches("url", r"https?://"),
    in_range("links_count", 1, None, severity=WARNING),
    Rule("long_text", "raw_content", "custom", WARNING, "short page", predicate=lambda c: F.length(c) >= 200),
]


def checked_pages(pages: DataFrame) -> DataFrame:
    """Parse, clean, enrich, validate and route raw pages, all in narrow steps."""
    parsed = html.parse(pages, "html").drop("html").withColumnsRenamed({"meta_title": "title", "meta_links_count": "links_count"})
    cleaned = clean(parsed, {"title": FieldRule(strip_html=True)}, ["title", "raw_content", "url"])
    enriched = enrich(
        cleaned, ["title", "raw_content", "url", "links_count"], stamp=False,
        computed={"host": r"regexp_extract(url, '^https?://([^/]+)', 1)"},
    )
    checked = validate(enriched, PAGE_RULES)
    return checked.withColumns({"route": rule_route(F.col("validation")), "success": F.lit(True)})


SQL_PAGES = f"""SELECT page_id, host, title, links, len(w) AS word_count, length(t) AS chars,
    CASE WHEN title IS NULL THEN 'reject' WHEN links < 1 OR length(t) < 200 THEN 'review' ELSE 'load' END AS route,
    (2 + (title IS NOT NULL)::INT + (t IS NOT NULL)::INT) AS field_count FROM (
      SELECT *, CASE WHEN length(t) > 50 THEN regexp_extract_all(t, '[^\\s\\x0b]+') END AS w FROM (
        SELECT page_id, regexp_extract(url, '^https?://([^/]+)', 1) AS host, {SQL_LINKS} AS links,
          nullif(trim(regexp_replace(regexp_replace({SQL_TITLE}, ' +', ' ', 'g'), '<[^>]+>', '', 'g')), '') AS title,
          nullif({sql_strip("regexp_replace(regexp_replace(" + sql_html_text('html') + ", '[\\t\\r\\x0b\\x0c]+', ' ', 'g'), ' {2,}', ' ', 'g')")}, '') AS t FROM pages))"""


@query("page_records", f"SELECT page_id, host, title, links::INT AS links_count, word_count::INT AS word_count, route, field_count FROM ({SQL_PAGES})")
def page_records(spark: SparkSession, sf: str) -> DataFrame:
    done = checked_pages(table(spark, sf, "pages", spread=True))
    return done.select(
        "page_id", "host", "title", "links_count", F.try_element_at("_text_analytics", F.lit("raw_content"))["word_count"].alias("word_count"),
        "route", F.col("_enrichment.field_count").alias("field_count"),
    )


@query(
    "page_quality",
    f"""SELECT host, count(*) AS pages, count(*) FILTER (route = 'load') AS loaded, count(*) FILTER (route = 'review') AS review,
          count(*) FILTER (route = 'reject') AS rejected, sum(links)::BIGINT AS links, sum(word_count)::BIGINT AS words FROM ({SQL_PAGES}) GROUP BY host""",
)
def page_quality(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: raw pages to a quality report per host."""
    done = checked_pages(table(spark, sf, "pages", spread=True))
    words = F.try_element_at("_text_analytics", F.lit("raw_content"))["word_count"]
    return done.groupBy("host").agg(
        F.count("*").alias("pages"),
        *[F.count_if(F.col("route") == r).alias(n) for r, n in (("load", "loaded"), ("review", "review"), ("reject", "rejected"))],
        F.sum("links_count").alias("links"), F.sum(words).alias("words"),
    )


@query(
    "extract_windows",
    """WITH p AS (SELECT doc_id, part, substr(text, part * 900 + 1, 1000) AS t FROM (SELECT doc_id, text, unnest(range(greatest(ceil((length(text) - 1000) / 900.0), 0)::BIGINT + 1)) AS part FROM documents))
       SELECT doc_id::VARCHAR AS document_id, count(*) AS parts, count(*) FILTER (regexp_matches(t, '[0-9]')) AS answered,
         arg_min(regexp_extract(t, '[0-9]+'), part) FILTER (regexp_matches(t, '[0-9]')) AS number,
         arg_min(length(t), part) FILTER (regexp_matches(t, '[0-9]')) AS size FROM p GROUP BY doc_id""",
)
def extract_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Whole texts in overlapping windows, a recorded reply to each window, and one record per document: each field from its first window that has it."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("document_id"), "text")
    windows = split_text(docs, "text", 1000, 100)
    number = F.nullif(F.regexp_extract("text", "[0-9]+", 0), F.lit(""))
    reply = F.when(number.isNull(), "none here").otherwise(F.to_json(F.struct(number.alias("number"), F.length("text").alias("size"))))
    replies = windows.select("document_id", "part", reply.alias("reply"))
    return merge_parts(parse_reply(replies), {"number": "string", "size": "int"})

"""Records: cleaning, normalizing, enriching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.functions.guard import Guarded
from docspark.operators.clean import FieldRule, clean, clean_summary
from docspark.operators.dedup import dedup_records as one_of_each
from docspark.operators.enrich import SetWhen, enrich, list_text_analytics
from docspark.operators.joins import lookup
from docspark.operators.normalize import coerce, fill_defaults, normalize, rename, transform_fields
from docspark.plans.parse_queries import sql_collapse
from docspark.plans.registry import query, sql_float, sql_strip, table

# ---- cleaning ----

DIRTY = "concat('\\t ', replace(text, 'e ', 'e\\t\\r  '), char(1), char(31), ' \\n')"
SQL_DIRTY = "chr(9) || ' ' || replace(text, 'e ', 'e' || chr(9) || chr(13) || '  ') || chr(1) || chr(31) || ' ' || chr(10)"


@query(
    "clean_strings",
    f"""WITH d AS (SELECT doc_id, {sql_collapse(SQL_DIRTY)} AS t FROM documents)
        SELECT doc_id, nullif(t, '') AS plain, nullif(lower(t), '') AS lowered, nullif(upper(replace(t, 'ß', 'ss')), '') AS uppered FROM d""",
)
def clean_strings(spark: SparkSession, sf: str) -> DataFrame:
    dirty = F.expr(DIRTY)
    docs = table(spark, sf, "documents", spread=True).select("doc_id", *[dirty.alias(n) for n in ("plain", "lowered", "uppered")])
    rules = {"lowered": FieldRule(lowercase=True), "uppered": FieldRule(lowercase=True, uppercase=True)}
    return clean(docs, rules, ["plain", "lowered", "uppered"])


SPARSE = {
    "name": "case when c_custkey % 11 = 0 then null when c_custkey % 7 = 0 then '  ' else concat(' ', c_name, ' ') end",
    "segment": "case when c_custkey % 5 = 0 then '' when c_custkey % 3 = 0 then null else c_mktsegment end",
    "balance": "case when c_custkey % 13 = 0 then null else c_acctbal end",
}
SQL_SPARSE = "SELECT c_custkey, c_nationkey, " + ", ".join(f"{v} AS {k}" for k, v in SPARSE.items()) + " FROM customer"


def sparse_customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey", *[F.expr(v).alias(k) for k, v in SPARSE.items()]
    )


@query(
    "clean_nulls",
    f"""WITH s AS ({SQL_SPARSE}),
        c AS (SELECT c_custkey, nullif(trim(name), '') AS name, nullif(segment, '') AS segment, balance,
              (name IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT AS original_fields FROM s)
        SELECT *, (name IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT AS cleaned_fields FROM c""",
)
def clean_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return clean_summary(sparse_customers(spark, sf).drop("c_nationkey"), fields=["name", "segment", "balance"])


@query(
    "clean_nested",
    """SELECT o_orderkey, lower(o_orderpriority) AS priority, nullif(trim(CASE WHEN o_orderkey % 4 = 0 THEN ' ' ELSE o_orderstatus END), '') AS status,
         o_custkey, CASE WHEN o_orderkey % 3 = 0 THEN 2 ELSE 3 END AS n_tags, o_orderstatus AS first_tag,
         CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS last_tag,
         CASE WHEN o_orderkey % 5 = 0 THEN 'note' ELSE 'blank,note' END AS keys
       FROM orders""",
)
def clean_nested(spark: SparkSession, sf: str) -> DataFrame:
    nested = table(spark, sf, "orders", spread=True).select(
        "o_orderkey",
        F.expr(
            "named_struct('priority', concat(' ', o_orderpriority, '\\t'), 'inner', named_struct('status', "
            "case when o_orderkey % 4 = 0 then ' ' else o_orderstatus end, 'custkey', o_custkey))"
        ).alias("info"),
        F.expr("array(o_orderstatus, null, ' ', case when o_orderkey % 3 <> 0 then o_orderpriority end)").alias("tags"),
        F.expr("map('note', 'x  y', 'blank', case when o_orderkey % 5 = 0 then ' ' else 'z' end)").alias("extra"),
    )
    done = clean(nested, {"priority": FieldRule(lowercase=True)}, ["info", "tags", "extra"])
    return done.select(
        "o_orderkey",
        F.col("info.priority").alias("priority"),
        F.col("info.inner.status").alias("status"),
        F.col("info.inner.custkey").alias("o_custkey"),
        F.size("tags").alias("n_tags"),
        F.col("tags")[0].alias("first_tag"),
        F.when(F.size("tags") == 3, F.col("tags")[2]).alias("last_tag"),
        F.array_join(F.array_sort(F.map_keys("extra")), ",").alias("keys"),
    )


DATE_FORMS = [
    ("yyyy-MM-dd", "%Y-%m-%d"), ("MM/dd/yyyy", "%m/%d/%Y"), ("dd/MM/yyyy", "%d/%m/%Y"), ("MMMM d, yyyy", "%B %-d, %Y"),
    ("MMM dd, yyyy", "%b %d, %Y"), ("yyyy-MM-dd'T'HH:mm:ss", "%Y-%m-%dT%H:%M:%S"), ("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
    ("yyyy.MM.dd", "%Y.%m.%d"),
]
SQL_DATE_TEXT = "CASE o_orderkey % 8 " + " ".join(f"WHEN {i} THEN strftime(o_orderdate, '{f[1]}')" for i, f in enumerate(DATE_FORMS)) + " END"


@query(
    "clean_date",
    f"""SELECT o_orderkey, {SQL_DATE_TEXT} AS raw, CASE
          WHEN o_orderkey % 8 = 7 THEN {SQL_DATE_TEXT}
          WHEN o_orderkey % 8 = 2 AND day(o_orderdate) <= 12 THEN strftime(o_orderdate, '%Y/%d/%m 00:00')
          ELSE strftime(o_orderdate, '%Y/%m/%d %H:%M') END AS o_date FROM orders""",
)
def clean_date(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.lit(None).cast("string")
    for i, (form, _) in enumerate(DATE_FORMS):
        raw = F.when(F.col("o_orderkey") % 8 == i, F.date_format("o_orderdate", form)).otherwise(raw)
    orders = table(spark, sf, "orders", spread=True).select("o_orderkey", raw.alias("raw")).withColumn("o_date", F.col("raw"))
    return clean(orders, {"o_date": FieldRule(date_format="%Y/%m/%d %H:%M")}, ["o_date"])


@query(
    "clean_pattern",
    r"""SELECT p_partkey, coalesce(nullif(regexp_extract(p_name, '(widget|bolt|ring)s?$'), ''), p_name) AS p_name,
          regexp_extract(p_brand, '[0-9]+') AS p_brand FROM part""",
)
def clean_pattern(spark: SparkSession, sf: str) -> DataFrame:
    parts = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    rules = {"p_name": FieldRule(pattern=r"(?P<kind>widget|bolt|ring)s?\Z"), "p_brand": FieldRule(pattern=r"\d+")}
    return clean(parts, rules, ["p_name", "p_brand"])


# ---- normalizing ----


@query("normalize_rename", "SELECT c_custkey AS id, coalesce(c_mktsegment, c_name) AS label, c_acctbal, c_nationkey FROM customer")
def normalize_rename(spark: SparkSession, sf: str) -> DataFrame:
    return rename(table(spark, sf, "customer"), {"c_custkey": "id", "c_name": "label", "c_mktsegment": "label"})


@query(
    "normalize_defaults",
    f"""SELECT c_custkey, c_nationkey, coalesce(name, 'unknown') AS name, coalesce(segment, 'NONE') AS segment,
          coalesce(balance, 0) AS balance, 'active' AS status FROM ({SQL_SPARSE})""",
)
def normalize_defaults(spark: SparkSession, sf: str) -> DataFrame:
    defaults = {"name": "unknown", "segment": "NONE", "balance": 0, "status": "active"}
    return fill_defaults(sparse_customers(spark, sf), defaults)


@query(
    "normalize_full",
    f"""SELECT c_custkey AS id, upper(coalesce(name, '')) AS title, {sql_float("replace(replace(amount, ',', ''), '$', '')")} AS amount,
          coalesce(segment, 'NONE') AS segment, 'new' AS status
        FROM (SELECT *, CASE WHEN c_custkey % 17 = 0 THEN 'n/a' ELSE '$ ' || round(balance, 2) END AS amount FROM ({SQL_SPARSE}))""",
)
def normalize_full(spark: SparkSession, sf: str) -> DataFrame:
    amount = F.when(F.col("c_custkey") % 17 == 0, "n/a").otherwise(F.concat(F.lit("$ "), F.col("balance").cast("string")))
    raw = sparse_customers(spark, sf).withColumn("balance", F.when(F.col("balance").isNull() & (F.col("c_custkey") % 17 != 0), None).otherwise(amount))
    return normalize(
        raw,
        mapping={"c_custkey": "id", "name": "title", "balance": "amount"},
        types={"amount": "float"},
        transforms={"title": lambda c: F.upper(F.coalesce(c, F.lit("")))},
        defaults={"segment": "NONE", "status": "new"},
        only=["id", "title", "amount", "segment", "status"],
    )


MONEY = {
    0: "cast(o_totalprice as string)",
    1: "concat('$', format_number(o_totalprice, 2))",
    2: "concat(' ', format_number(o_totalprice, 2), ' ')",
    3: "concat('-', cast(o_orderkey as string), '_000')",
    4: "concat(cast(o_orderkey as string), 'e2')",
    5: "concat(cast(o_orderkey as string), 'd')",
    6: "'n/a'",
    7: "case when o_orderkey % 16 = 7 then 'NaN' else '-Infinity' end",
}
SQL_MONEY = """CASE o_orderkey % 8 WHEN 0 THEN printf('%.2f', o_totalprice) WHEN 1 THEN '$' || printf('%,.2f', o_totalprice)
  WHEN 2 THEN ' ' || printf('%,.2f', o_totalprice) || ' ' WHEN 3 THEN '-' || o_orderkey || '_000' WHEN 4 THEN o_orderkey || 'e2'
  WHEN 5 THEN o_orderkey || 'd' WHEN 6 THEN 'n/a' ELSE CASE WHEN o_orderkey % 16 = 7 THEN 'NaN' ELSE '-Infinity' END END"""


def money(spark: SparkSession, sf: str) -> DataFrame:
    text = "case o_orderkey % 8 " + " ".join(f"when {k} then {v}" for k, v in MONEY.items()) + " end"
    text = text.replace("cast(o_totalprice as string)", "format_number(o_totalprice, '0.00')")
    return table(spark, sf, "orders", spread=True).select("o_orderkey", F.expr(text).alias("raw"))


@query(
    "coerce_int",
    f"""WITH m AS (SELECT o_orderkey, {SQL_MONEY} AS raw FROM orders), v AS (SELECT *, {sql_float("replace(replace(raw, ',', ''), ' ', '')")} AS f FROM m),
        i AS (SELECT *, CASE WHEN isfinite(f) THEN trunc(f)::BIGINT END AS value FROM v)
        SELECT o_orderkey, raw, value, CASE WHEN value IS NULL THEN raw END AS value_raw FROM i""",
)
def coerce_int(spark: SparkSession, sf: str) -> DataFrame:
    return coerce(money(spark, sf).withColumn("value", F.col("raw")), {"value": "int"})


@query(
    "coerce_float",
    f"""WITH m AS (SELECT o_orderkey, {SQL_MONEY} AS raw FROM orders),
        v AS (SELECT *, {sql_float("replace(replace(replace(raw, ',', ''), ' ', ''), '$', '')")} AS value FROM m)
        SELECT o_orderkey, raw, value, CASE WHEN value IS NULL THEN raw END AS value_raw FROM v""",
)
def coerce_float(spark: SparkSession, sf: str) -> DataFrame:
    return coerce(money(spark, sf).withColumn("value", F.col("raw")), {"value": "float"})


@query(
    "coerce_str",
    """SELECT l_orderkey, l_linenumber, l_extendedprice::VARCHAR AS price, l_discount::VARCHAR AS discount,
         CASE WHEN l_tax > 0.04 THEN 'True' ELSE 'False' END AS taxed, l_partkey::VARCHAR AS part,
         CASE WHEN l_quantity > 25 THEN l_quantity || 'e+' ELSE '0.000' END AS scale_head,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS shipped FROM lineitem""",
)
def coerce_str(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem", spread=True).select(
        "l_orderkey", "l_linenumber", F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("discount"),
        (F.col("l_tax") > 0.04).alias("taxed"), F.col("l_partkey").alias("part"),
        F.when(F.col("l_quantity") > 25, F.col("l_quantity") * 1e17).otherwise(F.col("l_quantity") / 1e5).alias("scale"),
        F.col("l_shipdate").alias("shipped"),
    )
    names = ("price", "discount", "taxed", "part", "scale", "shipped")
    done = coerce(items, {n: "str" for n in names})
    # 2.6e+18 and 0.00012: the mantissa is rebuilt so the check does not depend on rounding
    head = F.when(
        F.col("scale").contains("e+18"), F.concat((F.split("scale", "e")[0].cast("double") * 10).cast("string"), F.lit("e+"))
    ).otherwise(F.when(F.col("scale").startswith("0.000") | F.col("scale").endswith("e-05"), "0.000").otherwise(F.col("scale")))
    return done.withColumn("scale_head", head).drop("scale")


@query(
    "coerce_bool",
    """SELECT event_id, lower(trim(raw)) IN ('true', 'yes', '1', 'y', 'on') AS flag, value <> 0 AS nonzero FROM (
         SELECT event_id, value, CASE event_id % 9 WHEN 0 THEN ' YES ' WHEN 1 THEN 'true' WHEN 2 THEN '1' WHEN 3 THEN 'On' WHEN 4 THEN 'no'
           WHEN 5 THEN '' WHEN 6 THEN 'yess' WHEN 7 THEN 'Y' ELSE event_type END AS raw FROM events)""",
)
def coerce_bool(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(
        "case event_id % 9 when 0 then ' YES ' when 1 then 'true' when 2 then '1' when 3 then 'On' when 4 then 'no' "
        "when 5 then '' when 6 then 'yess' when 7 then 'Y' else event_type end"
    )
    events = table(spark, sf, "events").select("event_id", raw.alias("flag"), F.col("value").alias("nonzero"))
    return coerce(events, {"flag": "bool", "nonzero": "bool"})


@query(
    "coerce_list",
    f"""WITH r AS (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN replace(text, ',', '') WHEN 1 THEN text WHEN 2 THEN replace(replace(text, ',', ''), ' ', ' ; ')
             WHEN 3 THEN replace(translate(text, ',;', ''), ' ', '|') ELSE lang END AS raw FROM documents),
        l AS (SELECT doc_id, CASE WHEN contains(raw, ',') THEN string_split(raw, ',') WHEN contains(raw, ';') THEN string_split(raw, ';')
             WHEN contains(raw, '|') THEN string_split(raw, '|') WHEN contains(raw, chr(10)) THEN string_split(raw, chr(10)) END AS parts, raw FROM r),
        c AS (SELECT doc_id, CASE WHEN parts IS NULL THEN [raw] ELSE list_filter(list_transform(parts, lambda p: {sql_strip('p')}), lambda p: p <> '') END AS items FROM l)
        SELECT doc_id, len(items)::INT AS n_items, items[1] AS first_item, array_to_string(items, '#') AS items FROM c""",
)
def coerce_list(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.expr(
        "case doc_id % 5 when 0 then replace(text, ',', '') when 1 then text when 2 then replace(replace(text, ',', ''), ' ', ' ; ') "
        "when 3 then replace(translate(text, ',;', ''), ' ', '|') else lang end"
    )
    docs = coerce(table(spark, sf, "documents", spread=True).select("doc_id", raw.alias("items")), {"items": "list"})
    return docs.select(
        "doc_id", F.size("items").alias("n_items"), F.get("items", F.lit(0)).alias("first_item"), F.array_join("items", "#").alias("items")
    )


# ---- enriching ----


@query(
    "enrich_hash",
    f"""SELECT c_custkey, sha256('{{' || array_to_string(list_filter([
          '"balance": ' || balance, '"c_nationkey": ' || c_nationkey, '"name": "' || name || '"', '"segment": "' || segment || '"'],
          lambda x: x IS NOT NULL), ', ') || '}}') AS record_hash,
        (1 + (name IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT) AS field_count
        FROM ({SQL_SPARSE})""",
)
def enrich_hash(spark: SparkSession, sf: str) -> DataFrame:
    done = enrich(sparse_customers(spark, sf), ["segment", "name", "c_nationkey", "balance"])
    return done.select("c_custkey", F.col("_enrichment.record_hash").alias("record_hash"), F.col("_enrichment.field_count").alias("field_count"))


SQL_JSON_TEXT = r"""array_to_string(list_transform(string_split(replace(replace(replace(text, '\', '\\'), '"', '\"'), chr(10), '\n'), ''),
  lambda c: CASE WHEN c BETWEEN ' ' AND '~' THEN c ELSE '\u' || printf('%04x', unicode(c)) END), '')"""


@query(
    "enrich_hash_text",
    f"""SELECT doc_id, sha256('{{"lang": "' || lang || '", "text": "' || {SQL_JSON_TEXT} || '"}}') AS record_hash FROM documents""",
)
def enrich_hash_text(spark: SparkSession, sf: str) -> DataFrame:
    done = enrich(table(spark, sf, "documents", spread=True).select("doc_id", "lang", "text"), ["lang", "text"])
    return done.select("doc_id", F.col("_enrichment.record_hash").alias("record_hash"))


@query(
    "enrich_completeness",
    f"""SELECT c_custkey, 4 AS field_count, round_even((1 + coalesce(name <> '', false)::INT + coalesce(segment <> '', false)::INT
          + (balance IS NOT NULL)::INT) / 4, 3) AS completeness,
          round_even((1 + coalesce(name <> '', false)::INT + coalesce(segment <> '', false)::INT + (balance IS NOT NULL)::INT)
            / (1 + (name IS NOT NULL)::INT + (segment IS NOT NULL)::INT + (balance IS NOT NULL)::INT), 3) AS present_completeness
        FROM ({SQL_SPARSE})""",
)
def enrich_completeness(spark: SparkSession, sf: str) -> DataFrame:
    fields = ["c_nationkey", "name", "segment", "balance"]
    declared = enrich(sparse_customers(spark, sf), fields, presence="declared").withColumnRenamed("_enrichment", "declared")
    both = enrich(declared, fields).select(
        "c_custkey",
        F.col("declared.field_count").alias("field_count"),
        F.col("declared.completeness").alias("completeness"),
        F.col("_enrichment.completeness").alias("present_completeness"),
    )
    return both


@query(
    "enrich_source",
    f"""SELECT page_id, CASE WHEN page_id % 4 <> 3 THEN CASE WHEN page_id % 4 = 2 THEN 'unknown' ELSE 'html' END END AS format,
          CASE WHEN page_id % 4 <> 3 THEN CASE WHEN page_id % 4 = 1 THEN '2024-01-01' ELSE '' END END AS ingested_at FROM pages""",
)
def enrich_source(spark: SparkSession, sf: str) -> DataFrame:
    meta = F.expr(
        "case page_id % 4 when 0 then map('parser', 'html') when 1 then map('parser', 'html', 'ingested_at', '2024-01-01') "
        "when 2 then map('url', url) else cast(map() as map<string,string>) end"
    )
    pages = table(spark, sf, "pages", spread=True).select("page_id", "url", meta.alias("metadata"))
    done = enrich(pages, ["url"], metadata="metadata")
    return done.select("page_id", F.col("_source.format").alias("format"), F.col("_source.ingested_at").alias("ingested_at"))


@query(
    "enrich_computed",
    """SELECT c_custkey, c_name || ' (' || c_mktsegment || ')' AS label, length(c_name)::INT AS name_length FROM customer""",
)
def enrich_computed(spark: SparkSession, sf: str) -> DataFrame:
    done = enrich(
        table(spark, sf, "customer"),
        ["c_name", "c_mktsegment"],
        computed={"label": "concat(c_name, ' (', c_mktsegment, ')')", "name_length": lambda df: F.length(df["c_name"])},
    )
    return done.select("c_custkey", "label", "name_length")


@query(
    "enrich_conditional",
    """SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'gold' WHEN c_mktsegment = 'MACHINERY' THEN 'silver' END AS tier,
         CASE WHEN c_mktsegment = 'BUILDING' THEN 1 WHEN c_nationkey = 3 THEN 5 END AS priority,
         CASE WHEN c_nationkey = 3 THEN 'CHANGED' ELSE c_mktsegment END AS c_mktsegment FROM customer""",
)
def enrich_conditional(spark: SparkSession, sf: str) -> DataFrame:
    rules = [
        SetWhen("c_mktsegment", "BUILDING", {"tier": "gold"}),
        SetWhen("c_mktsegment", "MACHINERY", {"tier": "silver"}),
        SetWhen("c_nationkey", 3, {"c_mktsegment": "CHANGED", "priority": 5}),
        SetWhen("tier", "gold", {"priority": 1}),  # sees what the first rule set
        SetWhen("c_nationkey", "3", {"tier": "never"}),  # text is no number
        SetWhen("no_such_field", 1, {"tier": "never"}),
    ]
    done = enrich(table(spark, sf, "customer"), ["c_mktsegment", "c_nationkey"], rules=rules)
    return done.select("c_custkey", "tier", "priority", "c_mktsegment")


SQL_W = r"[\p{L}\p{N}_]"


def sql_stats(x: str) -> str:
    return rf"""length({x})::INT AS length, len(regexp_extract_all({x}, '[^\s\x0b\x1c-\x1f\x{{85}}\x{{a0}}\x{{2000}}-\x{{200a}}\x{{2028}}\x{{2029}}\x{{202f}}\x{{205f}}\x{{3000}}]+'))::INT AS word_count,
      regexp_matches({x}, '[\p{{L}}\p{{N}}_.-]+@[\p{{L}}\p{{N}}_.-]+\.{SQL_W}+') AS has_email,
      regexp_matches({x}, '(^|[^\p{{L}}\p{{N}}_])\d{{3}}[-.]?\d{{3}}[-.]?\d{{4}}($|[^\p{{L}}\p{{N}}_])') AS has_phone,
      regexp_matches({x}, 'https?://\S+') AS has_url"""


@query(
    "text_analytics",
    f"""SELECT doc_id, 'text' AS field, {sql_stats('text')} FROM documents WHERE text IS NOT NULL
        UNION ALL SELECT doc_id, 'lang' AS field, {sql_stats('lang')} FROM documents WHERE lang IS NOT NULL
        UNION ALL SELECT doc_id, 'contact' AS field, {sql_stats('contact')} FROM
          (SELECT doc_id, 'call ' || printf('%03d-%03d.%04d', doc_id % 1000, doc_id % 997, doc_id % 9973) || ' or see http' || CASE WHEN doc_id % 3 = 0 THEN 's' ELSE '' END
             || CASE WHEN doc_id % 2 = 0 THEN '://' ELSE ':/' END || source || ' or write ' || lang || '@' || source || CASE WHEN doc_id % 5 = 0 THEN '' ELSE '.org' END
             || CASE WHEN doc_id % 7 = 0 THEN '' ELSE ' any time of the day' END AS contact FROM documents)""",
)
def text_analytics(spark: SparkSession, sf: str) -> DataFrame:
    contact = F.expr(
        "concat('call ', format_string('%03d-%03d.%04d', doc_id % 1000, doc_id % 997, doc_id % 9973), ' or see http', if(doc_id % 3 = 0, 's', ''), "
        "if(doc_id % 2 = 0, '://', ':/'), source, ' or write ', lang, '@', source, if(doc_id % 5 = 0, '', '.org'), if(doc_id % 7 = 0, '', ' any time of the day'))"
    )
    docs = table(spark, sf, "documents", spread=True).select("doc_id", "text", "lang", contact.alias("contact"))
    done = enrich(docs, ["text", "lang", "contact"])
    return list_text_analytics(done, ["doc_id"])


# ---- equal records, lookups ----


@query("dedup_records", "SELECT min(doc_id) AS doc_id, lang, text, count(*) AS copies FROM documents GROUP BY lang, text")
def dedup_records(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "lang", "text")
    return one_of_each(docs, ["lang", "text"], ["doc_id"]).select("doc_id", "lang", "text", "copies")


@query("enrich_lookup", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_nationkey % 5 <> 0")
def enrich_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer with the name of its nation; some nations are not known."""
    nations = table(spark, sf, "nation").filter("n_nationkey % 5 <> 0").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return lookup(table(spark, sf, "customer").select("c_custkey", "c_nationkey"), nations, "c_nationkey", ["n_name"]).select("c_custkey", "n_name")


# ---- a caller's Python functions that fail on some records ----

SQL_CODES = """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 3 THEN o_orderpriority WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_custkey::VARCHAR END AS code,
    CASE WHEN o_orderkey % 97 = 3 THEN o_orderpriority ELSE o_custkey::VARCHAR END AS batch_code FROM orders"""


def order_codes(spark: SparkSession, sf: str) -> DataFrame:
    number = F.col("o_custkey").cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 3, F.col("o_orderpriority")).when(F.col("o_orderkey") % 11 == 5, None).otherwise(number).alias("code"),
        F.when(F.col("o_orderkey") % 97 == 3, F.col("o_orderpriority")).otherwise(number).alias("batch_code"),
    )


def sql_int_error(x: str) -> str:
    """DuckDB: what Python says about text that is no int."""
    return f"""CASE WHEN {x} IS NULL THEN 'int() argument must be a string, a bytes-like object or a real number, not ''NoneType'''
        WHEN TRY_CAST({x} AS BIGINT) IS NULL THEN 'invalid literal for int() with base 10: ''' || {x} || '''' END"""


@query(
    "transform_guarded",
    f"""SELECT o_orderkey, coalesce((TRY_CAST(code AS BIGINT) * 2)::VARCHAR, code) AS code, {sql_int_error('code')} AS code_error,
          coalesce((TRY_CAST(batch_code AS BIGINT) + 1)::VARCHAR, batch_code) AS batch_code, {sql_int_error('batch_code')} AS batch_code_error FROM ({SQL_CODES})""",
)
def transform_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """Two Python functions, of one value and of a Series: records they fail on keep their value and say why."""
    one, many = Guarded(lambda v: str(int(v) * 2)), Guarded(lambda s: (s.astype("int64") + 1).astype(str), whole=True)
    return transform_fields(order_codes(spark, sf), {"code": one, "batch_code": many})


@query("computed_guarded", f"SELECT o_orderkey, TRY_CAST(code AS BIGINT) + o_orderkey AS total, {sql_int_error('code')} AS total_error FROM ({SQL_CODES})")
def computed_guarded(spark: SparkSession, sf: str) -> DataFrame:
    """A computed field by a Python function of the whole record."""
    total = Guarded(lambda record: int(record["code"]) + record["o_orderkey"], "long")
    return enrich(order_codes(spark, sf), ["o_orderkey", "code"], computed={"total": total}, stamp=False).select("o_orderkey", "total", "total_error")

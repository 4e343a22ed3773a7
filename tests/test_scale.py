"""Plans and hot groups: what must hold when one key owns a large share of the rows."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from docspark.operators.batches import assign_batches
from docspark.functions.rows import row_hash
from docspark.operators.joins import hot_keys, left_join_unique
from docspark.plans import catalogue
from docspark.session import SETTINGS, scratch_dir
from docspark.sources.csv import first_rows, table_text
from docspark.sources.tables import spread

SF = "/root/testdata/sf0.001"

# queries that hand rows to a caller's Python function
WITH_PYTHON = {"sink_function", "transform_guarded", "computed_guarded", "rule_guarded"}
# queries that write tables while they are being built
WITH_JOBS = WITH_PYTHON | {"sink_json", "stream_pages", "stream_report", "batch_assign", "batch_report", "batch_progress",
                           "flow_records", "flow_report", "flow_summary", "flow_batches", "flow_load_log", "ledger_pending"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(catalogue.QUERIES) - WITH_JOBS))
def test_plans_stay_in_the_jvm_and_never_pair_all_rows(spark, name):
    text = plan(catalogue.QUERIES[name](spark, SF))
    for bad in ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "NestedLoopJoin", "Exchange SinglePartition, REPARTITION"):
        assert bad not in text, name


def test_scans_read_only_what_is_used(spark):
    assert "ReadSchema: struct<page_id:bigint,html:string>" in plan(catalogue.QUERIES["html_text"](spark, SF))
    assert "ReadSchema: struct<c_mktsegment:string>" in plan(catalogue.QUERIES["csv_counts"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan(spark.read.parquet(f"{SF}/lineitem.parquet").filter("l_quantity > 3"))


def test_unused_outputs_are_not_computed(spark):
    text = plan(catalogue.QUERIES["html_meta"](spark, SF))
    assert "script" not in text  # the text of the page is not asked for


def test_patterns_run_once_per_value(spark):
    text = plan(catalogue.QUERIES["html_text"](spark, SF))
    assert text.count("</script>") == 1
    assert plan(catalogue.QUERIES["rules_suite"](spark, SF)).count("[A-Z]+") == 1
    assert plan(catalogue.QUERIES["text_analytics"](spark, SF)).count(r"\p{Nd}{4}") == 3  # one per text field


def test_first_rows_are_cut_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.lit("hot").alias("file"), F.col("id").alias("ordinal"), F.col("id").cast("string").alias("v"))
    lead = first_rows(df, "file", ["ordinal"], 50)
    assert plan(lead).count("WindowGroupLimit") >= 2
    assert [r.ordinal for r in lead.orderBy("row").collect()] == list(range(50))


def test_table_text_of_a_hot_file(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 100)).alias("file"), F.col("id").alias("ordinal"))
    out = table_text(df, "file", ["ordinal"], ["ordinal"]).collect()
    hot = sorted((r for r in out if r.file == "hot"), key=lambda r: r.part)
    assert [r.part for r in hot] == list(range(40)) and all(r.row_count == 40_000 and r.raw_content.count("\n") == 1002 for r in hot)
    assert hot[-1].raw_content.endswith("Row 40000: ordinal: 59999") and len({r.file for r in out}) == 101


def test_hot_keys_are_split_in_joins(spark):
    left = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None).otherwise(F.col("id").cast("string")).alias("document_id"), F.col("id").alias("n")
    )
    right = left.select("document_id").distinct().filter("document_id is not null").withColumn("v", F.length("document_id"))
    assert "hot" in hot_keys(left, "document_id") and len(hot_keys(left, "document_id")) <= 1000
    got = left_join_unique(left, right, "document_id", salts=16)
    want = left.join(right, "document_id", "left")
    assert sorted(map(tuple, got.select("n", "v").collect()), key=str) == sorted(map(tuple, want.select("n", "v").collect()), key=str)
    salts = left.filter("document_id = 'hot'").groupBy(F.pmod(row_hash(left), F.lit(16))).count().collect()
    assert len(salts) == 16 and max(r["count"] for r in salts) < 1000


def test_row_hash_takes_every_type(spark):
    df = spark.sql("select 1 a, map('k', 1) m, parse_json('[1]') v, named_struct('m', map('x', array(1))) s")
    assert df.select(row_hash(df)).first()[0] is not None


@pytest.mark.parametrize("partitions", [1, 7])
def test_batches_with_repeated_keys(spark, partitions):
    df = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, 5_000).otherwise(F.col("id")).alias("k"), F.col("id").alias("n"))
    got = assign_batches(df, 50, ["k"], partitions)
    rows = got.collect()
    assert sorted(r.n for r in rows) == list(range(10_000))
    sizes = {}
    for r in rows:
        sizes.setdefault(r.batch_id, []).append(r.k)
    assert sorted(sizes) == list(range(200)) and all(len(v) == 50 for v in sizes.values())
    tops = [(min(sizes[i]), max(sizes[i])) for i in range(200)]
    assert all(a[1] <= b[0] for a, b in zip(tops, tops[1:]))


def test_spread_only_moves_few_splits(spark):
    few = spread(spark.range(10, numPartitions=1))
    many = spread(spark.range(100, numPartitions=50))
    assert "RoundRobin" in plan(few) and "Exchange" not in plan(many)


class FakeSession:
    """A session on a cluster, with or without the shared folder."""

    def __init__(self, folder, master="spark://host:7077"):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return {}


def test_scratch_follows_the_cluster_setting():
    assert scratch_dir(FakeSession("hdfs://shared/cp/"), "x").startswith("hdfs://shared/cp/docspark/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(None), "x")
    assert scratch_dir(FakeSession(None, "local[2]"), "x") != scratch_dir(FakeSession(None, "local[2]"), "x")


def test_driver_contract(spark):
    df = driver.entry(spark)
    assert df.columns == ["host", "pages", "loaded", "review", "rejected", "links", "words"] and df.count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert all(spark.conf.get(k) == v for k, v in SETTINGS.items())

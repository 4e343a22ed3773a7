"""Every query against its DuckDB equivalent."""

import os

import pytest
from compare import connect, duck_rows, spark_rows

import __spark_entry__ as driver
from docspark.plans import catalogue

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = driver.oracle_sql()
NAMES = sorted(catalogue.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = connect(SF_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    columns, rows = spark_rows(driver.queries()[name](spark, SF_DIR))
    assert rows
    assert (columns, rows) == duck_rows(duck, ORACLES[name])


@pytest.mark.parametrize("name", ["csv_doc_text", "extract_windows", "format_dispatch", "request_errors"])
def test_long_texts(spark, name):
    """Texts long enough for many CSV rows and windows, which the smallest tables do not hold."""
    con = connect("/root/testdata/sf0.01")
    columns, rows = spark_rows(driver.queries()[name](spark, "/root/testdata/sf0.01"))
    assert (columns, rows) == duck_rows(con, ORACLES[name])

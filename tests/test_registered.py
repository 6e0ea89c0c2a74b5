"""Every registered query against its checking SQL on the smallest test tables."""

import os
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry_points
from loanbook.catalog.queries import registered

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["customer", "orders", "lineitem"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


@pytest.fixture(scope="module")
def checker():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def test_every_query_has_its_check():
    assert set(registered()) <= set(entry_points.queries())
    assert set(registered()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(registered()))
def test_matches_the_checking_sql(spark, checker, name):
    rows = entry_points.queries()[name](spark, SF_DIR)
    expected = checker.sql(entry_points.oracle_sql()[name])
    assert sorted(rows.columns) == sorted(expected.columns)
    assert canonical(rows.columns, rows.collect()) == canonical(expected.columns, expected.fetchall())


def test_every_order_is_a_loan(spark, checker):
    orders = checker.sql("select count(*), count(distinct o_orderkey) from orders").fetchall()[0]
    loans = entry_points.queries()["stg_loans"](spark, SF_DIR)
    assert loans.count() == orders[1]


@pytest.mark.parametrize("name", ["mart_credit_installments", "mart_credit_loans", "mart_kpis_daily", "mart_kpis_vintage"])
def test_marts_look_for_latest_rows_once(spark, name):
    """They read cleaned tables that were stored: no window picks rows again."""
    plan = registered()[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "row_number" not in plan


@pytest.mark.parametrize("left_out", [["loanbook/llm"], ["loanbook/llm", "corpus_pipeline.py"], ["corpus_pipeline.py"]])
def test_queries_without_the_text_operators(tmp_path, left_out):
    """A copy without them still has every query of the reference's operators."""
    root = os.path.dirname(os.path.abspath(entry_points.__file__))
    skip = lambda folder, names: [x for x in names if os.path.relpath(os.path.join(folder, x), root) in left_out]
    shutil.copytree(f"{root}/loanbook", tmp_path / "loanbook", ignore=skip)
    for name in {"__spark_entry__.py", "corpus_pipeline.py"} - set(left_out):
        if os.path.exists(f"{root}/{name}"):
            shutil.copy(f"{root}/{name}", tmp_path)
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    said = subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    names, checked = (set(line.split()) for line in said.stdout.splitlines()[-2:])
    assert set(registered()) <= names and set(registered()) <= checked <= names
    assert "pipeline" not in names
    if "loanbook/llm" in left_out:
        assert names == set(registered())


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6

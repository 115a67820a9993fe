"""The entry point without the text operators: it imports, and the other queries are all there."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__  # noqa: F401 (fills QUERIES)
from checks import fixtures
from checks.registered import QUERIES

ROOT = Path(__file__).resolve().parent.parent
COUNT = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"


@pytest.mark.parametrize("gone", [
    ("tidemark/llm", "tests/llm"), ("tidemark/llm", "tests/llm", "corpus_pipeline.py"),
])
def test_import_without_the_text_operators(tmp_path, gone):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names
        if n in (".git", "__pycache__") or str((Path(folder) / n).relative_to(ROOT)) in gone
    ])
    out = subprocess.run([sys.executable, "-c", COUNT], cwd=copy, capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert out.stdout.split() == [str(len(QUERIES)), str(len(QUERIES)), "False"]


@pytest.fixture
def client_days(spark, tmp_path):
    """A folder with one line item and its order."""
    items = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double"
    spark.createDataFrame([(1, 1, 10, 3, 5.0)], items).write.parquet(str(tmp_path / "lineitem.parquet"))
    spark.createDataFrame([(1, "2-HIGH")], "o_orderkey long, o_orderpriority string").write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_only_numbers_go_through_the_join_of_the_client_days(spark, client_days):
    plan = fixtures.clients(spark, client_days)._jdf.queryExecution().optimizedPlan()
    while plan.getClass().getSimpleName() != "Join":
        plan = plan.children().apply(0)
    for side in (plan.left(), plan.right()):
        assert "string" not in side.schema().simpleString()


def test_registry_days_are_parsed_behind_the_first_grouping(spark, client_days):
    plan = fixtures._registry_records(spark, client_days)._jdf.queryExecution().optimizedPlan().toString()
    head, below = plan.split("Aggregate")[1:]
    assert "gettimestamp" in head and "RLIKE" in head
    assert "gettimestamp" not in below and "RLIKE" not in below

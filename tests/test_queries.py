"""Every registered query against its SQL, with groups cut into slices, and the shape of the plans."""

import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from clickfeat.operators.slices import SLICE_ROWS_CONF
from clickfeat.registry.base import QUERIES, SQL

# Queries with a driver step while they are built (fits, stores) have no single plan to look at.
EAGER = ("model_", "training_table", "selected_features", "deltas_", "counts_of_both", "counts_written", "csv_", "history_features", "stored_", "smooth", "rate_metrics", "appended_")


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def sorted_rows(table):
    columns = sorted(table.column_names)
    return columns, sorted(map(repr, zip(*[table.column(c).to_pylist() for c in columns])))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, db, sf_dir, name):
    spark.conf.set(SLICE_ROWS_CONF, "60")
    try:
        mine = QUERIES[name](spark, sf_dir).toArrow()
    finally:
        spark.conf.unset(SLICE_ROWS_CONF)
    assert sorted_rows(mine) == sorted_rows(db.sql(SQL[name]).to_arrow_table())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_query_without_sql_returns_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_plan_has_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan


def test_entry_has_every_registered_query():
    assert set(QUERIES) <= set(entry.queries()) and SQL.items() <= entry.oracle_sql().items()


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == ["rid", "ip", "day", "hour", "ip_day_hour_count"] and found.count() > 0


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = QUERIES["ip_day_hour_count"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for schema in [line for line in plan.splitlines() if "ReadSchema" in line]:
        assert "props" not in schema and "value" not in schema.split("ReadSchema")[1]


def test_core_queries_without_a_package_of_the_text_operators():
    """A missing package that only the text operators need leaves the others in place."""
    code = """
import sys
class Missing:
    def find_spec(self, name, path=None, target=None):
        if name == "sentencepiece":
            raise ModuleNotFoundError(f"No module named {name}", name=name)
sys.meta_path.insert(0, Missing())
import __spark_entry__ as entry
print(len(entry.queries()))
"""
    root = str(Path(entry.__file__).parent)
    said = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert said.returncode == 0, said.stderr
    assert int(said.stdout.split()[-1]) >= len(QUERIES)

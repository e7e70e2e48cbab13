"""Queries of the text operators against their SQL."""

from pathlib import Path

import duckdb
import pytest

from clickfeat.llm.queries import SQL, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def rows(table):
    columns = sorted(table.column_names)
    return columns, sorted(map(repr, zip(*[table.column(c).to_pylist() for c in columns])))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in sorted(Path(SF_DIR).glob("*.parquet")):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    mine = QUERIES[name](spark, SF_DIR).toArrow()
    assert rows(mine) == rows(db.execute(SQL[name]).to_arrow_table())

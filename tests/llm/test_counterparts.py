"""The training-data queries against their DuckDB counterparts."""

from pathlib import Path

import duckdb
import pytest

from gleanery.llm.workload import ORACLES, QUERIES


def plain(rows, columns, order):
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(row[columns.index(c)]) for c in order) for row in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_counterpart(spark, sf_dir, name):
    connection = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    ours, theirs = QUERIES[name](spark, sf_dir), connection.sql(ORACLES[name])
    order = sorted(ours.columns)
    assert sorted(theirs.columns) == order
    assert plain(ours.collect(), ours.columns, order) == plain(theirs.fetchall(), theirs.columns, order)

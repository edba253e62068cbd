"""The registered queries and their SQL counterparts."""

import math
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from gleanery.workload.oracles import ORACLES  # noqa: E402
from gleanery.workload.queries import QUERIES  # noqa: E402


def as_rows(frame):
    def plain(value):
        missing = value is None or value != value
        return "" if missing else f"{value:.9g}" if isinstance(value, float) and math.isfinite(value) else str(value)

    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(plain, row)) for row in frame[columns].itertuples(index=False, name=None))


def compare(spark_frame, sql, folder):
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    assert as_rows(spark_frame.toPandas()) == as_rows(connection.sql(sql).df())


def test_every_query_has_a_counterpart():
    assert QUERIES.keys() == ORACLES.keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark, sf_dir):
    compare(contract.entry(spark), contract.oracle_sql()["top10_category"], sf_dir)


@pytest.mark.parametrize(
    "name",
    ["clean_text_of_pages", "extract_links_of_pages", "extract_articles", "json_records", "validate_errors",
     "normalise_scores", "source_stats", "run_counts", "rank_in_category", "upsert_audit", "incremental_ingest"],
)
def test_query(spark, sf_dir, name):
    compare(contract.queries()[name](spark, sf_dir), contract.oracle_sql()[name], sf_dir)


@pytest.mark.parametrize("name", ["catalogue_items", "quote_items", "spiders_by_name"])
def test_pages_of_a_small_file_are_read_by_many_tasks(spark, sf_dir, name):
    """A table of one row group would otherwise be one task's work, whatever its rows are worth."""
    found = contract.queries()[name](spark, sf_dir)
    sizes = [row["count"] for row in found.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) * 4 <= sum(sizes)

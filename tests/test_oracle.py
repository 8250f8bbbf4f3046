"""Every registered query against its DuckDB twin."""

import duckdb
import pytest

import __spark_entry__ as entry
from kartotek.plans import all_queries
from tests.oracle import compare, connect

QUERIES, SQL = all_queries.QUERIES, all_queries.ORACLES


@pytest.fixture(scope="module")
def con(data_dir):
    return connect(data_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, data_dir, name):
    assert compare(spark, con, QUERIES[name], SQL.get(name), data_dir) == ""


def test_entry(spark):
    assert entry.entry(spark).columns == ["kpi", "dim_id", "cat_id", "ordinal", "label"]


def test_every_query_has_a_twin():
    assert set(SQL) == set(QUERIES) <= set(entry.queries())


def test_notes_of_odd_texts(spark, tmp_path):
    """Blank and missing texts, and blanks that only one of trim and strip takes."""
    texts = [None, "", " ", "\n\n", " \t\r\n a \x0b", " a\x1c", "a\n \nb\n", "|\n|", "\x0c\nx", " "]
    rows = [(2 * i + odd, text) for i, text in enumerate(texts) for odd in (0, 1)] + [(None, None), (None, "x\ny ")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, QUERIES["fn_note"], SQL["fn_note"], str(tmp_path)) == ""

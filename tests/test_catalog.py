"""Every registered query against its SQL twin, on the smallest tables."""

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as entry_points  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{FOLDER}/{name}'")
    return connection


def rounded(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", entry_points.oracle_sql())
def test_equals_sql(spark, tables, name):
    df = entry_points.queries()[name](spark, FOLDER)
    result = tables.execute(entry_points.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    expected = sorted((tuple(map(rounded, r)) for r in result.fetchall()), key=repr)
    assert sorted((tuple(rounded(r[c]) for c in columns) for r in df.collect()), key=repr) == expected


def test_entry(spark):
    rows = entry_points.entry(spark).collect()
    assert rows and rows[0]["rank"] == 1


def test_ranked_results_of_pages_with_one_address(spark, tables, tmp_path):
    rows = [(1, "http://a/x.html", "<title>T</title>tion"), (2, "http://a/x.html", "html from"), (3, None, "from"), (4, "", "tion tion")]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    found = entry_points.queries()["ranked_results"](spark, str(tmp_path)).select("rank", "file_name", "display_title", "path").collect()
    assert [r["rank"] for r in found] == [1, 2, 3, 4]
    shown = sorted(((r["file_name"], r["display_title"], r["path"]) for r in found), key=repr)
    assert shown == sorted([("x.html", "T", "http://a/x.html"), ("x.html", "", "http://a/x.html"), (None, None, None), ("", None, "")], key=repr)

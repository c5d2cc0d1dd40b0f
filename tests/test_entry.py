"""The driver contract, on the smallest tables: every query with SQL equals it."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from rawscan.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
needs_data = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def plain(value):
    if value is None or isinstance(value, (str, bool)):
        return value
    return round(float(value), 6) if isinstance(value, (int, float)) or hasattr(value, "as_integer_ratio") else str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@needs_data
def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@needs_data
@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = catalog.queries()[name](spark, SF)
    found = duck.execute(catalog.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(df.columns) == sorted(columns)
    assert table_of(df.columns, df.collect()) == table_of(columns, found.fetchall())


def test_multiline_round_trip_of_every_text(spark, tmp_path):
    texts = [None, "plain", 'a "quoted" word', '"', '""', "\\", 'C:\\dir\\"x"\\\\', "two\nlines; one\n\nafter a blank", "", "é" * 5000, 'long "text"\\ ' * 20_000]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    found = catalog.queries()["csv_multiline"](spark, f"file://{tmp_path}").collect()
    assert sorted((r.doc_id, r.text) for r in found) == [(i, t or "") for i, t in enumerate(texts)]

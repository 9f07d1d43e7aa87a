"""Every query against its SQL in DuckDB on the small tables."""

import math
import os

import pytest

import __spark_entry__ as entry
from provenir.functions.text import plain_text
from provenir.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v if v is None or isinstance(v, (bool, int, str)) else str(v)


def rows(names, found):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    got = catalogue.QUERIES[name](spark, SF)
    found = got.collect()
    assert found
    if name in catalogue.ORACLES:
        wanted = duck.execute(catalogue.ORACLES[name])
        names = [d[0] for d in wanted.description]
        assert sorted(names) == sorted(got.columns)
        assert rows(got.columns, found) == rows(names, wanted.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_root():
    assert os.path.exists(os.path.join(os.path.dirname(entry.__file__), "provenir"))


def test_html_is_cleaned_whole(spark, tmp_path):
    pages = {1: "<p>" + "some &amp; more <b>words</b> " * 500 + "</p>", 2: "short", 3: None}
    spark.createDataFrame(list(pages.items()), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in catalogue.QUERIES["clean_html_text"](spark, str(tmp_path)).collect()}
    assert got == {k: plain_text(v) for k, v in pages.items()} and len(got[1]) > 8000

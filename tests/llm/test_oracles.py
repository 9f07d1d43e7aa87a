"""Operators against their SQL in DuckDB on the small tables."""

import pytest

from provenir.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, duck, name):
    got = queries.QUERIES[name](spark, SF)
    wanted = duck.execute(queries.ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == sorted(got.columns)
    key = lambda row: repr(tuple(row))
    assert sorted(map(tuple, got.select(*names).collect()), key=key) == sorted(wanted.fetchall(), key=key)


def test_oracle_of_plain_cases(duck):
    """What the SQL says of empty and short texts and of vectors that cannot be compared."""
    import duckdb

    c = duckdb.connect()
    c.execute("CREATE TABLE documents AS SELECT * FROM (VALUES (3, NULL), (4, ' '), (5, 'A b'), (2, 'a B'), (6, 'a b c')) AS t(doc_id, text)")
    assert sorted(c.execute(queries.ORACLES["op6_jaccard"]).fetchall()) == [(2, 1, 2), (3, 0, 3), (4, 0, 4), (5, 1, 2), (6, 1, 6)]
    c.execute("CREATE TABLE embeddings AS SELECT * FROM (VALUES (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [0.0, 0.0], 1), (4, [1.0, NULL], 1), (5, [1.0, 0.0], NULL), (6, NULL, 1)) AS t(vec_id, embedding, label)")
    assert sorted(c.execute(queries.ORACLES["op8_embeddings"]).fetchall()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True)]

"""Every query of the library against its SQL on DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest

from tracewright import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def comparable(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda k: names[k])
    value = lambda x: round(x, 9) if isinstance(x, float) and not math.isnan(x) else x
    return sorted((tuple(value(r[k]) for k in order) for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_query_gives_what_its_sql_gives(spark, duck, sf_dir, name):
    df = catalog.QUERIES[name](spark, sf_dir)
    got = comparable(df.columns, df.collect())
    found = duck.execute(catalog.ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(columns)
    want = comparable(columns, found.fetchall())
    assert len(got) == len(want) and len(got) > 0
    assert got == want


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE_SQL)))
def test_other_queries_run_alike_twice(spark, sf_dir, name):
    first, second = (sorted(map(str, catalog.QUERIES[name](spark, sf_dir).collect())) for _ in range(2))
    assert first and first == second

"""Every registered query of the library's own operators against its SQL on DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from sievewright.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

catalog.load_all()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(value: object) -> str:
    return repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_against_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    answer = duck.execute(catalog.SQL[name])
    columns = [d[0] for d in answer.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(plain(r[c]) for c in sorted(columns)) for r in df.collect())
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    want = sorted(tuple(plain(r[i]) for i in order) for r in answer.fetchall())
    assert got == want


@pytest.mark.skipif(not Path(SF).exists(), reason="no test data")
@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL)))
def test_runs(spark, name):
    assert catalog.QUERIES[name](spark, SF).count() > 0


def test_entry_imports():
    import __spark_entry__

    assert set(catalog.SQL) <= set(__spark_entry__.oracle_sql())
    assert set(catalog.QUERIES) <= set(__spark_entry__.queries())

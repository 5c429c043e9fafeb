"""Every registered query with an oracle gives the same rows as DuckDB; the others run."""

import duckdb
import pytest
from partwise.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return con


def plain(value):
    return "nan" if value != value else repr(round(value, 9)) if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf_small, duck, name):
    df = catalog.QUERIES[name](spark, sf_small)
    columns = sorted(df.columns)
    rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in catalog.ORACLE_SQL:
        result = duck.execute(catalog.ORACLE_SQL[name])
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        assert sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall()) == rows

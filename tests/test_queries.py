"""Every registered query against its SQL on the smallest driver tables."""

import duckdb
import pytest

from datasheaf.plans import queries as plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    return str(value.tolist() if hasattr(value, "tolist") else value)


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{data}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", list(plans.QUERIES))
def test_query(spark, data, duck, name):
    df = plans.QUERIES[name](spark, data)
    got = sorted(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    assert got
    if name not in plans.SQL:
        return
    cursor = duck.execute(plans.SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    at = [columns.index(c) for c in sorted(columns)]
    assert got == sorted(tuple(plain(r[i]) for i in at) for r in cursor.fetchall())


def test_entry(spark, data):
    import __spark_entry__

    assert __spark_entry__.entry(spark).take(1)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

"""Compares queries with their SQL in DuckDB on the smallest tables."""

import os

FOLDER = os.environ.get("LOOMGRAPH_TESTDATA", "/root/testdata/sf0.001")


def connect():
    import duckdb

    c = duckdb.connect()
    c.execute("SET TimeZone = 'UTC'")
    for f in sorted(os.listdir(FOLDER)):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{f}'")
    return c


def _plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def same(spark, connection, query, sql) -> None:
    df = query(spark, FOLDER)
    names = sorted(df.columns)
    ours = sorted(tuple(_plain(r[n]) for n in names) for r in df.collect())
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    theirs = sorted(tuple(_plain(r[columns.index(n)]) for n in names) for r in result.fetchall())
    assert ours == theirs

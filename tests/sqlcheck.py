"""Compares a query with its SQL."""

import os


def same_as_sql(spark, data, query, sql):
    """Compares a query with its SQL as multisets of rows."""
    from collections import Counter

    import duckdb
    import numpy as np

    def norm(v):
        if isinstance(v, (list, tuple, np.ndarray)):
            return tuple(norm(x) for x in v)
        if isinstance(v, float):
            return None if v != v else round(v, 6)
        return str(v) if hasattr(v, "isoformat") else v

    con = duckdb.connect()
    for f in os.listdir(data):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{data}/{f}')")
    df = query(spark, data)
    cols = sorted(df.columns)
    got = Counter(tuple(norm(x) for x in r) for r in df.select(*cols).collect())
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    assert sorted(names) == cols
    want = Counter(tuple(norm(r[names.index(c)]) for c in cols) for r in res.fetchall())
    assert got == want

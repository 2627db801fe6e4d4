"""Driver contract: entry() runs; every SQL oracle agrees with its Spark query."""
import duckdb

import __spark_entry__ as E
from revlens.sources.tables import TABLES

from .conftest import SF001


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["label", "n"] and len(rows) >= 1


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v


def test_queries_match_oracle_sf0001(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    qs, sqls = E.queries(), E.oracle_sql()
    bad = []
    for name, sql in sqls.items():
        sdf = qs[name](spark, SF001)
        cols = sorted(sdf.columns)
        a = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
        res = con.execute(sql)
        names = [d[0] for d in res.description]
        if sorted(names) != cols:
            bad.append((name, "columns"))
            continue
        b = sorted((tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in res.fetchall()), key=repr)
        if a != b:
            bad.append((name, len(a), len(b)))
    assert not bad, bad

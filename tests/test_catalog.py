import math
import os

import duckdb
import pytest

from docketry.plans.catalog import oracle_sql, queries

FOLDER = "/root/testdata/sf0.001"


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    fix = lambda v: None if isinstance(v, float) and math.isnan(v) else round(v, 6) if isinstance(v, float) else v
    return sorted(repr([fix(r[i]) for i in order]) for r in rows)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, name):
    df = queries()[name](spark, FOLDER)
    got = _rows(df.columns, df.collect())
    if name in oracle_sql():
        con = duckdb.connect()
        con.execute("SET timezone='UTC'")
        for f in os.listdir(FOLDER):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
        cur = con.execute(oracle_sql()[name])
        assert got == _rows([d[0] for d in cur.description], cur.fetchall())

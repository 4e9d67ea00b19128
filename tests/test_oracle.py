"""Every registered query against its DuckDB oracle at sf0.001."""

from __future__ import annotations

import duckdb
import pytest

from starlattice.plans.oracle import oracle_sql
from starlattice.plans.registry import queries

from conftest import SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


def _canon(cols, rows):
    import datetime as dt
    import decimal
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, (float, decimal.Decimal, int)) and not isinstance(v, bool):
            return float(f"{float(v):.9g}")
        if isinstance(v, (dt.date, dt.datetime)):
            return v.isoformat()
        return v
    return sorted((tuple(norm(r[i]) for i in order) for r in rows),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_rows_only_queries_run(spark, name):
    assert queries()[name](spark, SMALL).count() > 0


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = queries()[name](spark, SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    cur = con.execute(oracle_sql()[name])
    dcols, drows = [c[0] for c in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert _canon(cols, rows) == _canon(dcols, drows)

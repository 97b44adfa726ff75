"""Every registered query with an oracle against its DuckDB SQL at sf0.001
(scripts/oracle_check.py does the same at any scale, with --strict)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from riskspark.plans.registry import REGISTRY
from tests.conftest import SF001

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
ALL = sorted(name for name, q in REGISTRY.items() if q.sql)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 5)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_oracle_or_is_a_model_job():
    missing = {name for name, q in REGISTRY.items() if not q.sql}
    assert set(REGISTRY) <= set(E.queries())
    assert all(m.startswith("m") for m in missing)


@pytest.mark.parametrize("name", ALL)
def test_query_matches_duckdb(spark, con, name):
    sdf = E.queries()[name](spark, SF001)
    cols = sorted(sdf.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(dcols) == cols
    idx = [dcols.index(c) for c in cols]
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert got == want


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "ato_proxy" in df.columns

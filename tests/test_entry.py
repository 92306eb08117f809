"""Driver contract: entry smoke, registry/oracle coverage, oracle parity on the smallest scale."""

import os
import sys

import duckdb
import pytest

from conftest import ROOT, SF_TINY

sys.path.insert(0, os.path.join(ROOT, "scripts"))
import __spark_entry__ as entry  # noqa: E402
from check_oracle import rows_of  # noqa: E402
from dimfold.sources.tables import TABLES, table_path  # noqa: E402

# models, hashes and token files: tested against brute force in tests/llm
NO_ORACLE = {k for k in entry.queries() if k.startswith("op") or k == "pipeline"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["user_id", "date", "datelist_int", "dim_datelist", "dim_is_monthly_active",
                          "dim_is_weekly_active"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(entry.queries()) - set(entry.oracle_sql()) == NO_ORACLE
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = table_path(SF_TINY, t)
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_oracle_parity(spark, duck, key):
    sdf = entry.queries()[key](spark, SF_TINY)
    res = duck.execute(entry.oracle_sql()[key])
    d_cols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(d_cols)
    assert rows_of(sdf.columns, [tuple(r) for r in sdf.collect()]) == rows_of(d_cols, res.fetchall())

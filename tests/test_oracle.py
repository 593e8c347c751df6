"""Every registered query against its DuckDB oracle on the smallest tables
(the same check the correctness gate runs at sf0.01)."""
import math
import os

import duckdb
import pytest

from tests.conftest import SMOKE
from __spark_entry__ import entry
from vitrine.plans.catalog import lh, oracle_sql, queries
from vitrine.sources.testdata import TABLES


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


DUCK_TO_SPARK = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string",
                 "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMOKE}/{t}.parquet'")
    return c


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and "faturamento" in df.columns


@pytest.mark.parametrize("key", sorted(queries()))
def test_query_matches_oracle(spark, con, key):
    df = queries()[key](spark, SMOKE)
    srows = [tuple(r) for r in df.collect()]
    sql = oracle_sql().get(key)
    if sql is None:  # sizes of the written base, checked against the file system
        assert key == "table_file_size"
        folder = lh(spark, SMOKE).landing_path()
        sizes = [os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder) if f.endswith(".parquet")]
        assert srows == [(len(sizes), round(sum(sizes) / (1024 * 1024), 2))] and sizes
        return
    types = {r[0]: DUCK_TO_SPARK.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert dict(df.dtypes) == types  # same names and same types
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, srows) == _rows(ocols, cur.fetchall())

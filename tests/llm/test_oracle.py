"""The registered queries against their DuckDB SQL: names, types and values."""
import duckdb
import pytest

from tests.test_oracle import DUCK_TO_SPARK, _rows
from vitrine.llm.oracle import ORACLE_SQL
from vitrine.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, key):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df, sql = QUERIES[key](spark, SF), ORACLE_SQL[key]
    types = {r[0]: DUCK_TO_SPARK.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    assert dict(df.dtypes) == types
    cur = con.execute(sql)
    want = _rows([d[0] for d in cur.description], cur.fetchall())
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w) if any(isinstance(x, float) for x in g) else g == w

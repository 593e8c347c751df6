"""Silver dedup against a Python implementation of its ordering (brute force
over random rows with duplicate keys, NULL ranks and ties that only the last
columns decide)."""
import random
from datetime import date

from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from vitrine.constants import LANDING_COLUMNS
from vitrine.operators import silver as S

RANKED = ["data", "id_anuncio", "posicao_ranking", "faturamento_estimado_dia", "qtd_vendas_estimadas_dia",
          "loja_oficial", "parcelamento", "titulo_produto"]
TYPES = ["date", "string", "int", "double", "int", "string", "string", "string"]
REST = [c for c in LANDING_COLUMNS if c not in RANKED]


def rows_of(seed):
    """Distinct rows over few keys; most ties are left to the last columns."""
    rnd = random.Random(seed)
    pick = rnd.choice
    return sorted({(pick([date(2026, 9, 1), date(2026, 9, 2)]), pick(["A", "B", None]), pick([None, 1, 2]),
                    pick([None, 1.0]), pick([None, 0]), pick("xy"), pick(["1x", "2x"]), "t",
                    *[pick([None, "p", "q"]) if rnd.random() < .3 else "p" for _ in REST]) for _ in range(400)},
                  key=repr)


def key(r):
    """Sort key of the dedup order (rank asc NULLS FIRST, revenue and units
    desc NULLS LAST, then shop, instalments, title and all others asc)."""
    _, _, rank, fat, qtd, loja, parc, tit, *rest = r
    return ((rank is not None, rank or 0), (fat is None, -(fat or 0)), (qtd is None, -(qtd or 0)),
            loja, parc, tit, [(v is not None, v or "") for v in rest])


@settings(max_examples=2, deadline=None, phases=[Phase.generate])  # no shrinking: each run is a Spark job
@given(st.integers(0, 1 << 32))
def test_dedup_matches_python(spark, seed):
    rows = rows_of(seed)
    names = RANKED + REST
    schema = ", ".join(f"{n} {t}" for n, t in zip(names, TYPES + ["string"] * len(REST)))
    df = spark.createDataFrame(rows, schema)
    got = {(r["data"], r["id_anuncio"]): tuple(r) for r in
           S.dedup_first(df, S.DEDUP_KEYS, S.dedup_order()).collect()}
    want = {}
    for r in rows:
        k = (r[0], r[1])
        if k not in want or key(r) < key(want[k]):
            want[k] = r
    assert got == want

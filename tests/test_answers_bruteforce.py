"""Answers against a per-question recomputation in pandas (brute force): each
routed question's rows are derived directly from its intent, period and
entity, with exact cent sums, and compared with the Spark answer rows."""
from decimal import Decimal

import pandas as pd

from tests.conftest import SMOKE
from vitrine.plans.lakehouse import lakehouse


def _money(cents):
    return None if cents is None else float(Decimal(int(cents)) / 100)


def _expected(q, a):
    if q.kind in ("mtd", "ytd"):
        rows = a[(a.ano == q.p_ano) & ((pd.isna(q.p_mes)) | (a.mes == q.p_mes)) & (a.data <= q.fim)]
    else:
        rows = a[a.data == q.inicio]
    def agg(df, keys):
        g = df.groupby(keys, dropna=False).agg(c=("cents", "sum"), v=("qtd_vendas_num", "sum"))
        return g.reset_index()
    if q.intent == "total":
        return [(None, None, None, None, _money(rows.cents.sum()) if len(rows) else None,
                 int(rows.qtd_vendas_num.sum()) if len(rows) else None)]
    if q.intent == "categoria":
        g = agg(rows[rows.categoria == q.categoria], ["categoria"])
        return [(r.categoria, None, None, None, _money(r.c), int(r.v)) for r in g.itertuples()]
    if q.intent == "subcategoria":
        sel = rows[(rows.subcategoria == q.subcategoria)
                   & ((q.categoria is None) | (rows.categoria == q.categoria))]
        g = agg(sel, ["categoria", "subcategoria"])
        return [(r.categoria, r.subcategoria, None, None, _money(r.c), int(r.v)) for r in g.itertuples()]
    if q.intent == "ranking_categorias":
        g = agg(rows, ["categoria"])
        return [(r.categoria, None, None, None, _money(r.c), int(r.v)) for r in g.itertuples()]
    if q.intent == "ranking_subcategorias":
        g = agg(rows, ["categoria", "subcategoria"]).sort_values(
            ["c", "categoria", "subcategoria"], ascending=[False, True, True]).head(5)
        return [(r.categoria, r.subcategoria, None, None, _money(r.c), int(r.v)) for r in g.itertuples()]
    if q.intent == "ranking_produtos":
        keys = ["titulo_produto", "marca", "categoria", "subcategoria"]
        g = agg(rows, keys).sort_values(["c"] + keys, ascending=[False, True, True, True, True]).head(5)
        return [(r.categoria, r.subcategoria, r.titulo_produto, r.marca, _money(r.c), int(r.v))
                for r in g.itertuples()]
    return None


def test_answers_match_direct_recomputation(spark):
    L = lakehouse(spark, SMOKE)
    a = L.analytic().toPandas()
    a["cents"] = (a.fat_num * 100).round().astype("int64")
    routed = L.routed().filter("status = 'ok'").toPandas()
    got = {}
    for r in L.answers().toPandas().itertuples():
        got.setdefault(r.q_id, []).append((r.categoria, r.subcategoria, r.titulo_produto, r.marca,
                                           None if pd.isna(r.faturamento) else r.faturamento,
                                           None if pd.isna(r.vendas) else int(r.vendas)))
    checked = 0
    for q in routed.itertuples():
        want = _expected(q, a)
        if want is None:
            continue
        norm = lambda rows: sorted(rows, key=lambda t: tuple(str(x) for x in t))
        clean = lambda rows: [tuple(None if (isinstance(x, float) and pd.isna(x)) else x for x in t)
                              for t in rows]
        assert norm(clean(got.get(q.q_id, []))) == norm(clean(want)), (q.q_id, q.text, q.intent)
        checked += 1
    assert checked > 100

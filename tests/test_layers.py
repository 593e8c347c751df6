"""Bronze / silver / gold semantics on inline rows."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from vitrine.constants import LANDING_COLUMNS, LANDING_TYPES
from vitrine.operators import bronze as B
from vitrine.operators import gold as G
from vitrine.operators import quality as Q
from vitrine.operators import silver as S
from vitrine.operators.keys import dense_key, ordered_index


def landing_rows(spark, rows):
    """rows: list of dicts with some landing columns; the rest NULL."""
    ddl = ", ".join(f"{c} {LANDING_TYPES[c]}" for c in LANDING_COLUMNS)
    full = [tuple(r.get(c) for c in LANDING_COLUMNS) for r in rows]
    return spark.createDataFrame(full, ddl)


def test_strict_and_lenient_bronze(spark):
    df = spark.createDataFrame([(date(2026, 1, 1), "x")], "data date, produto string")
    with pytest.raises(B.MissingColumnsError):
        B.select_contract(df, strict=True)
    out = B.select_contract(df)
    assert out.columns == LANDING_COLUMNS
    assert dict(out.dtypes)["preco_atual"] == "string" and dict(out.dtypes)["ano"] == "int"
    assert len(B.missing_columns(df)) == 24


def test_dedup_null_rank_wins_and_defaults_after(spark):
    d = date(2026, 9, 18)
    rows = [dict(data=d, id_anuncio=" MLB1 ", posicao_ranking=2, categoria=" Casa ",
                 faturamento_estimado_dia="10,00"),
            dict(data=d, id_anuncio="MLB1", posicao_ranking=None, categoria=None,
                 faturamento_estimado_dia="20,00"),
            dict(data=d, id_anuncio="MLB2", posicao_ranking=1, categoria="",
                 faturamento_estimado_dia=None)]
    silver = S.silver(B.bronze(landing_rows(spark, rows), "t"), processing_time=False)
    got = {r["id_anuncio"]: r for r in silver.collect()}
    assert len(got) == 2  # trimmed ids collide, dedup keeps one
    assert got["MLB1"]["faturamento_estimado_dia"] == 20.0  # the NULL rank row won
    assert got["MLB1"]["categoria"] == "Sem Categoria"  # default applied after dedup
    assert got["MLB2"]["categoria"] == ""  # '' is not NULL
    assert got["MLB2"]["faturamento_estimado_dia"] == 0.0
    assert got["MLB2"]["preco_original"] is None  # no default for it


def test_dedup_best_rank_option(spark):
    d = date(2026, 9, 18)
    rows = [dict(data=d, id_anuncio="A", posicao_ranking=None, marca="n"),
            dict(data=d, id_anuncio="A", posicao_ranking=3, marca="r")]
    typed = S.typed(landing_rows(spark, rows))
    out = S.dedup_first(typed, S.DEDUP_KEYS, S.dedup_order(nulls_first_rank=False)).first()
    assert out["marca"] == "r"


def test_calendar_attributes(spark):
    df = spark.createDataFrame([(date(2024, 12, 30),), (date(2025, 1, 5),), (date(2027, 1, 1),)],
                               "data date")
    cal = {r["data"]: r for r in G.dim_calendar(df).collect()}
    a, b, c = cal[date(2024, 12, 30)], cal[date(2025, 1, 5)], cal[date(2027, 1, 1)]
    assert (a["dia_semana_num"], a["semana_do_ano"], a["dia_semana"]) == (2, 1, "Segunda")
    assert (b["dia_semana_num"], b["semana_do_ano"], b["is_fim_semana"]) == (1, 1, True)
    assert (c["dia_semana_num"], c["semana_do_ano"], c["nome_mes"]) == (6, 53, "Janeiro")
    assert c["trimestre"] == 1 and c["ano_mes"] == "2027-01"


def test_ordered_index_matches_row_number_under_skew(spark):
    """One group holds a third of all rows; the index equals a plain row_number."""
    from pyspark.sql import Window
    n = 3000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string"))
        .alias("g"), ((F.col("id") * 7919) % 1000).alias("v"), F.col("id"))
    got = ordered_index(df, [F.col("v").desc(), F.col("id").asc()], "ix", by=["g"],
                        num_partitions=8)
    w = Window.partitionBy("g").orderBy(F.col("v").desc(), F.col("id").asc())
    want = df.withColumn("ix", F.row_number().over(w).cast("long"))
    assert got.select("g", "id", "ix").exceptAll(want.select("g", "id", "ix")).count() == 0
    assert got.count() == n


def test_dense_key_is_dense_and_ordered(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",), ("c",)], "k string")
    rows = dense_key(df, ["k"], "sk").orderBy("sk").collect()
    assert [(r["sk"], r["k"]) for r in rows] == [(1, None), (2, "a"), (3, "b"), (4, "c")]


def test_fact_null_listing_and_reconcile(spark):
    d = date(2026, 9, 18)
    rows = [dict(data=d, id_anuncio=None, posicao_ranking=1, categoria="C", subcategoria="S",
                 faturamento_estimado_dia="1.000,10", qtd_vendas_estimadas_dia="3"),
            dict(data=d, id_anuncio="X", posicao_ranking=2, categoria="C", subcategoria="S",
                 faturamento_estimado_dia="5,05", qtd_vendas_estimadas_dia="1")]
    silver = S.silver(B.bronze(landing_rows(spark, rows), "t"), processing_time=False)
    cat, prod = G.dim_category(silver), G.dim_product(silver)
    fact = G.fact_sales(silver, cat, prod)
    by_rank = {r["posicao_ranking"]: r for r in fact.collect()}
    assert by_rank[1]["sk_produto"] is None and by_rank[2]["sk_produto"] is not None
    assert prod.count() == 2  # the NULL listing still has a product row
    rec = {r["metrica"]: r for r in Q.reconcile(silver, fact).collect()}
    assert all(r["status"] == "OK" for r in rec.values())
    assert rec["faturamento"]["prata"] == 1005.15


def test_null_counts_single_pass(spark):
    df = spark.createDataFrame([(None, "a", "m", 1, 1.0), ("c", None, None, None, 2.0)],
                               "categoria string, subcategoria string, marca string, "
                               "qtd_vendas_estimadas_dia int, faturamento_estimado_dia double")
    got = {r["coluna"]: r["nulos"] for r in Q.null_counts(df).collect()}
    assert got == {"categoria": 1, "subcategoria": 1, "marca": 1, "qtd_vendas_estimadas_dia": 1,
                   "faturamento_estimado_dia": 0}


def test_ordered_index_with_aqe_coalescing(spark):
    """No explicit partition count: AQE coalesces neighbouring range
    partitions; the index must still equal a plain row_number."""
    from pyspark.sql import Window
    df = spark.range(5000).select((F.col("id") % 7).alias("g"),
                                  ((F.col("id") * 104729) % 997).alias("v"), "id")
    got = ordered_index(df, [F.col("v").asc(), F.col("id").desc()], "ix", by=["g"])
    w = Window.partitionBy("g").orderBy(F.col("v").asc(), F.col("id").desc())
    want = df.withColumn("ix", F.row_number().over(w).cast("long"))
    assert got.select("g", "id", "ix").exceptAll(want.select("g", "id", "ix")).count() == 0
    # a global order (no groups) gives 1..n
    r = ordered_index(df, [F.col("id").asc()], "k").agg(F.min("k"), F.max("k"),
                                                          F.countDistinct("k")).first()
    assert tuple(r) == (1, 5000, 5000)


def test_empty_base_periods(spark):
    """An empty base has no reference date: totals are one NULL row, rankings
    are empty, nothing fails."""
    from vitrine.operators import metrics as M
    from vitrine.operators.periods import resolve
    from vitrine.constants import ANALYTIC_COLUMNS
    ddl = ("data date, ano int, mes int, ano_mes string, posicao_ranking int, categoria string, "
           "subcategoria string, titulo_produto string, marca string, qtd_vendas_num int, "
           "fat_num double, preco_num double, is_full boolean, frete_gratis boolean")
    empty = spark.createDataFrame([], ddl).select(*ANALYTIC_COLUMNS)
    for kind in ["today", "yesterday", "mtd", "ytd"]:
        p = resolve(kind, None)
        t = M.totals(empty, p).collect()
        assert len(t) == 1 and t[0]["faturamento_total"] is None
        assert M.ranking_categories(empty, p).count() == 0

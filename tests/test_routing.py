"""Question routing on the example questions and the documented fixes."""
from datetime import date

import pytest
from pyspark.sql import functions as F

from vitrine.operators import routing as R
from vitrine.sources import dictionary as Dic

REF = date(2026, 9, 27)


@pytest.fixture(scope="module")
def ctx(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("dic") / "dicionario.json")
    Dic.write_dictionary_file(path)
    dic = Dic.read_dictionary(spark, path)
    flat = Dic.taxonomy_flat(dic)
    cats = flat.groupBy("categoria").agg(F.min("pos_cat").alias("pos"))
    pairs = flat.select("categoria", "subcategoria").distinct()
    return dict(lexicon=Dic.fixed_lexicon(spark), glossary=Dic.glossary(dic), cats=cats,
                pairs=pairs, flat=flat)


def route(spark, ctx, texts):
    qs = spark.createDataFrame([(i, "Ana", t) for i, t in enumerate(texts)],
                               "q_id long, user_name string, text string")
    out = R.route_questions(qs, ctx["lexicon"], ctx["glossary"], ctx["cats"], ctx["pairs"], REF)
    return {r["q_id"]: r for r in out.collect()}


def test_dictionary_load(ctx):
    flat = ctx["flat"]
    assert flat.select("categoria").distinct().count() == 5
    assert flat.select("categoria", "subcategoria").distinct().count() == 60
    assert flat.filter(F.col("marca").isNotNull()).count() == 175
    assert flat.select("marca").distinct().count() == 136
    assert ctx["glossary"].count() == 30


def test_examples(spark, ctx):
    r = route(spark, ctx, [
        "Qual a quantidade de vendas total até agora no MTD?",
        "Quantos produtos no total da Apple venderam hoje?",
        "Qual o faturamento total de hoje?",
        "Qual o produto mais vendido de informatica?",
        "Qual a data mais recente da base?",
    ])
    assert (r[0]["intent"], r[0]["kind"]) == ("total", "mtd")
    assert r[0]["periodo"] == "MTD (Acumulado no Mês 09/2026 até 2026-09-27)"
    assert (r[1]["intent"], r[1]["kind"]) == ("ranking_produtos", "today")
    assert (r[2]["intent"], r[2]["periodo"]) == ("total", "Hoje (2026-09-27)")
    assert (r[3]["intent"], r[3]["categoria"]) == ("categoria", "Informática")
    assert r[4]["intent"] == "metadados"


def test_subcategory_precedence_and_warnings(spark, ctx):
    r = route(spark, ctx, [
        "quanto vendeu móveis no ytd",
        "qual a categoria smartphones hoje",
        "subcategoria informatica no mtd",
        "faturamento de cozinha ontem",
    ])
    assert (r[0]["intent"], r[0]["categoria"], r[0]["subcategoria"]) == \
        ("subcategoria", "Casa, Móveis e Decoração", "Móveis")
    assert r[0]["periodo"].startswith("YTDA 2026")
    assert "Celulares e Telefones" in r[1]["aviso"] and r[1]["intent"] == "subcategoria"
    assert "Categoria principal" in r[2]["aviso"] and r[2]["intent"] == "categoria"
    assert (r[3]["categoria"], r[3]["subcategoria"], r[3]["kind"]) == (None, "Cozinha", "yesterday")


def test_period_fixes(spark, ctx):
    r = route(spark, ctx, [
        "faturamento total em 18/09/2024",
        "vendas totais no ano passado",
        "total em 31/02",
        "vendas de anteontem",
        "vendas em 2026-09-01",
        "vendas no mesmo período",
    ])
    assert (r[0]["kind"], r[0]["inicio"], r[0]["periodo"]) == \
        ("date", date(2024, 9, 18), "Data 18/09/2024")
    assert r[1]["kind"] == "today"
    assert (r[2]["status"], r[2]["periodo"]) == ("invalid_period", "Data 31/02/2026")
    assert r[3]["kind"] == "today"
    assert (r[4]["kind"], r[4]["periodo"]) == ("date", "Data 2026-09-01")
    assert r[5]["kind"] == "today"


def test_dictionary_intents(spark, ctx):
    r = route(spark, ctx, ["oi", "quais são as categorias?", "subcategorias de informática",
                           "o que é ytda?", "mom", "Δ x", "nada a ver"])
    assert r[0]["intent"] == "saudacao"
    assert r[1]["intent"] == "listar_categorias"
    assert (r[2]["intent"], r[2]["lista_categoria"]) == ("listar_subcategorias", "Informática")
    assert (r[3]["intent"], r[3]["sigla"], r[3]["definicao"]) == ("glossario", "YTDA", "Acumulado Ano")
    assert (r[4]["intent"], r[4]["sigla"]) == ("glossario", "MoM")
    assert r[6]["intent"] == "sem_resposta" and r[6]["status"] == "unanswered"


def test_first_keyword_by_declaration_order(spark, ctx):
    """'fones' is declared before 'fone'; 'cabos' before 'cabo': first declared wins."""
    r = route(spark, ctx, ["vendas de cabo e fones hoje"])
    assert r[0]["subcategoria"] == "Áudio Mobile"


def test_generic_reply_formats(spark):
    from vitrine.operators.answers import format_result
    one = spark.createDataFrame([(1234567.891,)], "faturamento_total double")
    r = format_result(one, [F.col("faturamento_total")], "q?", "Ana", "2026-09-27").first()
    assert "📦 *Faturamento Total:* `R$ 1.234.567,89`" in r["resposta"] and r["n_linhas"] == 1
    cnt = spark.createDataFrame([(1234,)], "total_pedidos long")
    r = format_result(cnt, [F.col("total_pedidos")], "q?", "Ana", "2026-09-27").first()
    assert "`1.234`" in r["resposta"]
    many = spark.createDataFrame([(f"m{i}", float(i), i) for i in range(10)],
                                 "marca string, fat double, vendas long")
    r = format_result(many, [F.col("vendas").desc()], "q?", "Ana", "2026-09-27").first()
    lines = [x for x in r["resposta"].split("\n") if x.startswith("• ")]
    assert len(lines) == 8 and lines[0].startswith("• *Marca:* m9 | *Fat:* R$ 9,00")
    assert "e mais 2 registros" in r["resposta"]
    empty = many.filter("vendas < 0")
    r = format_result(empty, [F.col("vendas")], "q?", "Ana", "2026-09-27").first()
    assert r["n_linhas"] == 0 and r["resposta"].startswith("Fala Ana!")


def test_routing_without_reference_date(spark, ctx):
    qs = spark.createDataFrame([(1, "Ana", "qual o faturamento total de hoje?")],
                               "q_id long, user_name string, text string")
    r = R.route_questions(qs, ctx["lexicon"], ctx["glossary"], ctx["cats"], ctx["pairs"],
                          None).first()
    assert (r["intent"], r["status"]) == ("total", "no_data")

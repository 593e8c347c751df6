"""Glossary terms are found anywhere in a text; lists are complete."""
from vitrine.constants import TAXONOMY
from vitrine.operators import answers as A
from vitrine.operators import routing as R
from vitrine.sources.dictionary import fixed_glossary


def test_every_concept_phrase_of_a_text_counts(spark):
    rows = [(1, "u", "o que é isso? o que é mtd"), (2, "u", "bom dia, o que é bom?\no que é yoy"),
            (3, "u", "o que é isso?"), (4, "u", "x " * 5000 + "significado de mtd")]
    q = R.normalize(spark.createDataFrame(rows, "q_id long, user_name string, text string"))
    got = {r.q_id: r.sigla for r in R.glossary_lookup(q, fixed_glossary(spark)).collect()}
    assert set(got) == {1, 2, 4} and got[1] == got[4] == "MTD" and got[2].lower() == "yoy"


def test_a_listing_holds_every_name(spark):
    flat = spark.createDataFrame([(c, s, "m") for c, subs in TAXONOMY.items() for s in subs],
                                 "categoria string, subcategoria string, marca string")
    big = max(TAXONOMY, key=lambda c: len(TAXONOMY[c]))
    assert len(TAXONOMY[big]) > 8
    routed = spark.createDataFrame(
        [(1, "u", "t", "listar_subcategorias", "ok", big, None, None, None),
         (2, "u", "t", "listar_categorias", "ok", None, None, None, None)],
        "q_id long, user_name string, text string, intent string, status string, "
        "lista_categoria string, sigla string, termo string, definicao string")
    got = {r.q_id: r.resposta for r in A.dictionary_replies(routed, flat, "2001-01-01", 5).collect()}
    assert all(s in got[1] for s in TAXONOMY[big]) and got[1].count("•") == len(TAXONOMY[big])
    assert all(c in got[2] for c in TAXONOMY)

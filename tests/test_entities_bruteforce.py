"""Keyword matching (n-gram equi-join + exact check) against a first-match
regex loop over the lexicon in declaration order (brute force)."""
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine import constants as K
from vitrine.functions.formatting import word_pattern
from vitrine.operators import routing as R
from vitrine.sources.dictionary import fixed_lexicon

WORDS = ([k for k, _, _ in K.SUBCATEGORY_KEYWORDS[::3]] + [k for k, _ in K.CATEGORY_KEYWORDS[::2]]
         + ["automóveis", "cabos_usb", "fone-de-ouvido", "fone  de ouvido", "casas", "ti?",
            "quanto", "vendeu", "hoje", "no", "de", "a", "Ar Condicionado", "(móveis)", "3d"])


def first_match(t: str):
    sub = next(((k, c, s) for k, c, s in K.SUBCATEGORY_KEYWORDS
                if regex.search(word_pattern(k), t)), None)
    cat = next(((k, c) for k, c in K.CATEGORY_KEYWORDS if regex.search(word_pattern(k), t)), None)
    return sub, cat


@settings(max_examples=1, deadline=None)
@given(st.lists(st.lists(st.sampled_from(WORDS), min_size=1, max_size=6), min_size=200,
                max_size=200))
def test_match_entities_matches_regex_loop(spark, texts):
    rows = [(i, " ".join(parts)) for i, parts in enumerate(texts)]
    q = R.normalize(spark.createDataFrame(rows, "q_id long, text string"))
    got = {r["q_id"]: r for r in R.match_entities(q, fixed_lexicon(spark)).collect()}
    for i, text in rows:
        sub, cat = first_match(text.lower().strip())
        r = got.get(i)
        g_sub = (r["sub_keyword"], r["sub_parent"], r["sub_name"]) if r and r["sub_name"] else None
        g_cat = (r["cat_keyword"], r["cat_name"]) if r and r["cat_name"] else None
        assert (g_sub, g_cat) == (sub, cat), text

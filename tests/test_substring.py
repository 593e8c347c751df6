"""Substring lookup by postings against a loop over all pairs."""
import random

from vitrine.operators import substring as S


def lookup(spark, names, terms):
    posted = S.postings(spark.createDataFrame(list(enumerate(names)), "n long, name string"), "name")
    t = spark.createDataFrame(list(enumerate(terms)), "q long, term string")
    found = S.containing(S.keyed(t, "term", S.frequencies(posted), ["q"]), "term", posted, "name")
    return sorted((r.q, r.n) for r in found.collect())


def test_lookup_equals_all_pairs(spark):
    rnd = random.Random(8)
    text = lambda n: "".join(rnd.choice("abé ") for _ in range(n))
    names = [text(rnd.randrange(12)) for _ in range(80)] + [None, "", "a", "aaaaaa", "%_\\E.*", "móveis pc"]
    terms = [text(rnd.randrange(6)) for _ in range(60)] + [None, "", "aaa", "é", "_\\E", ".", "pc", "not there", "%"]
    want = sorted((q, n) for q, t in enumerate(terms) for n, name in enumerate(names)
                  if t is not None and name is not None and t in name)
    assert lookup(spark, names, terms) == want and len(want) > 100
    assert lookup(spark, [], ["a"]) == lookup(spark, ["a"], []) == []

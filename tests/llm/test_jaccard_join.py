import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tests.llm.helpers import documents
from vitrine.llm import jaccard_join as J
from vitrine.llm.queries import op3_jaccard_join

SF = "/root/testdata/sf0.01"


def shingles(text):
    w = [x.lower() for x in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(rows):
    """(id, set size, smallest linked id) by comparing all pairs that share a shingle."""
    sets = [shingles(t) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in enumerate(sets):
        for j in {j for x in s for j in holders[x] if j > i}:
            shared = len(s & sets[j])
            if 100 * shared >= 75 * (len(s) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        key = (d is None, d)
        if root(i) not in best or key < best[root(i)]:
            best[root(i)] = key
    return sorted(((d, len(sets[i]), best[root(i)][1]) for i, (d, _) in enumerate(rows)), key=str)


def joined(df):
    return sorted((tuple(r) for r in J.components(df).collect()), key=str)


def test_components_of_the_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in op3_jaccard_join(spark, SF).collect()), key=str)
    assert got == brute(rows) and any(d != c for d, _, c in got)


def family(rnd, n, words, edits):
    """Near copies: the same words, with up to ``edits`` of them changed."""
    base = [f"w{rnd.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            w[rnd.randrange(words)] = f"x{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_large_groups_at_all_distances(spark, seed, monkeypatch):
    # Families whose members lie on both sides of the threshold from any pivot,
    # one passage in all documents, and exact copies; tiny tables force every path.
    rnd = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(60))
    texts = family(rnd, 120, 100, 6) + family(rnd, 80, 40, 4) + family(rnd, 60, 12, 2)
    texts += [f"{passage} {' '.join(f'o{rnd.randrange(10**6)}' for _ in range(n))}" for n in range(5, 45)]
    texts += [texts[0]] * 40
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    df = documents(spark, rows).repartition(3)
    want = brute(rows)
    assert joined(df) == want
    monkeypatch.setattr(J, "ORDERED", 5)
    monkeypatch.setattr(J, "COUNT_CHUNK", 500)
    assert joined(df) == want


def test_regions_join_exactly_whatever_the_distances(spark):
    """The recursion alone, on sets drawn to fill every range of distances."""
    rng = np.random.default_rng(4)
    core = np.arange(40)
    sets = {}
    for i in range(90):
        keep = rng.random(40) < rng.choice([0.5, 0.8, 0.95])
        sets[i + 1] = sorted({*core[keep].tolist(), *(100 + rng.integers(0, 30, rng.integers(0, 12))).tolist()})
    frame = spark.createDataFrame([(k, v) for k, v in sets.items()],
                                  T.StructType([T.StructField("class", T.LongType()),
                                                T.StructField("set", T.ArrayType(T.LongType()))]))
    regions = frame.select(F.lit(7).cast("long").alias("region"), "class", F.lit(True).alias("own"),
                           F.col("class").alias("root"), F.lit(0.0).alias("rank"),
                           F.lit(None).cast("double").alias("d0"))
    found, regions = J._voronoi(regions, frame)
    links, pivots, steps = {(r.a, r.b) for r in found.collect()}, 4, 0
    while not regions.isEmpty():
        found, regions = J._recurse(regions, frame, pivots)
        links |= {(r.a, r.b) for r in found.collect()}
        pivots, steps = pivots * J.PIVOT_GROWTH, steps + 1
    assert steps >= 2
    parent = {k: k for k in sets}

    def root(i):
        return i if parent[i] == i else root(parent[i])

    for a, b in links:
        x, y = set(sets[a]), set(sets[b])
        assert 100 * len(x & y) >= 75 * len(x | y)
        parent[root(a)] = root(b)
    for a in sets:
        for b in sets:
            x, y = set(sets[a]), set(sets[b])
            if 100 * len(x & y) >= 75 * len(x | y):
                assert root(a) == root(b)


def test_long_chain_of_links_is_one_class(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    got = {r["class"]: r.root for r in J._connected(edges).collect()}
    assert got == {i: 0 for i in range(301)}


def test_edge_rows_and_keep_one(spark):
    near = [f"w{i}" for i in range(40)]
    rows = [(1, None), (2, ""), (3, " \t "), (4, "a"), (5, "A"), (6, "a b"), (None, " ".join(near)),
            (8, " ".join(near)), (8, " ".join(near)), (9, " ".join(near[:-1])), (9, "else where"),
            (None, "only null"), (None, "only null"), (10, "x " * 50000), (11, "x " * 50), (2, "")]
    df = documents(spark, rows).withColumnRenamed("lang", "class").withColumnRenamed("source", "__id")
    assert joined(df) == brute(rows)
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    want = [(1, None), (2, ""), (2, ""), (3, " \t "), (4, "a"), (6, "a b"), (8, " ".join(near)),
            (9, "else where"), (None, "only null"), (10, "x " * 50000)]
    assert got == sorted(want, key=str)
    assert joined(df.limit(0)) == [] and J.keep_one(df.limit(0)).count() == 0

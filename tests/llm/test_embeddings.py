"""Whitening and hard negatives against brute force."""
import random
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm import hard_negatives as H
from vitrine.llm import whitening as W
from vitrine.llm.queries import op12_whitening, op13_hard_negatives

SF = "/root/testdata/sf0.01"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType())),
                       T.StructField("label", T.IntegerType())])


def embeddings(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def integers(v):
    return tuple(int(np.floor(256 * np.float64(c))) for c in v)


def given(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet")
            .select("vec_id", "embedding", "label").collect()]


def fine(v):
    return v is not None and len(v) > 0 and all(c is not None and np.isfinite(c) for c in v)


# --- whitening


def brute_whiten(rows, k=4):
    x = [(i, integers(v)) for i, v, _ in rows if fine(v)]
    fit = sorted({v for _, v in x})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    z = np.array(fit, np.longdouble) - np.array(sums, np.longdouble) / n
    v = (z.T @ z / n).astype(float)
    values, vectors = np.linalg.eigh(v)
    out = {}
    for i, xi in x:
        dev = sum((n * c - s) ** 2 for c, s in zip(xi, sums))
        for c in range(k):
            e, u = values[-1 - c], vectors[:, -1 - c]
            w = float((np.array(xi) - np.array(sums) / n) @ u / np.sqrt(e))
            out.setdefault((i, c + 1), []).append((n, dev, w, e / np.trace(v)))
    return out


def check_whitened(got, want):
    assert len(got) == sum(map(len, want.values()))
    sign = {}
    for r in got:
        n, dev, w, explained = want[r.vec_id, r.component][0]
        assert (r.n, r.deviation) == (n, dev)
        assert r.explained == pytest.approx(explained, rel=1e-9) and r.identity_error < 1e-9
        if abs(w) > 1e-3:
            assert abs(r.whitened) == pytest.approx(abs(w), rel=1e-7)
            sign.setdefault(r.component, set()).add(np.sign(w) * np.sign(r.whitened))
    assert all(len(s) == 1 for s in sign.values())


def test_whitening_of_the_table(spark):
    check_whitened(op12_whitening(spark, SF).collect(), brute_whiten(given(spark)))


def test_whitening_of_awkward_rows(spark):
    rnd = random.Random(4)
    rows = [(i, [rnd.gauss(1000, 5), rnd.gauss(-40, 2), rnd.gauss(0, .9), rnd.gauss(3, .4), rnd.random() / 9], 0)
            for i in range(200)]
    rows += [rows[0]] * 30 + [(None, rows[1][1], 1), (900, None, 1), (901, [], 1), (902, [1.0, None, 2., 3., 4.], 0),
                              (903, [float("nan")] * 5, 0), (904, [float("inf"), 0., 0., 0., 0.], 0), (905, [1.0], 0)]
    df = embeddings(spark, rows).withColumn("x", F.lit("t")).withColumn("n", F.lit(0)).repartition(5)
    keep = [r for r in rows if fine(r[1]) and len(r[1]) == 5]
    check_whitened(W.whiten(df).collect(), brute_whiten(keep))


def test_whitening_without_spread(spark):
    assert W.whiten(embeddings(spark, [])).collect() == []
    assert W.whiten(embeddings(spark, [(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)])).collect() == []
    flat = W.whiten(embeddings(spark, [(i, [float(i), 2.0 * i, 0.0], 0) for i in range(9)])).collect()
    assert {r.component for r in flat} == {1} and len(flat) == 9
    assert flat[0].explained == pytest.approx(1, rel=1e-12)


def test_whitening_of_huge_entries(spark):
    rows = [(i, [1e30 * (i % 3), float(i), i * 7919 % 31 / 3], 0) for i in range(40)]
    got = W.whiten(embeddings(spark, rows)).collect()
    assert len(got) >= 40 and all(r.n == 40 for r in got)
    assert all(np.isfinite(r.whitened) for r in got)


def spectrum(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2).astype(np.longdouble).astype(float))
    return (q * values) @ q.T


@pytest.mark.parametrize("values", [
    [5.0, 3.0, 2.0, 1.0], [3.0, 3.0 - 1e-9, 3.0 - 2e-9, 1.0, 0.5], [2.0, 2.0, 2.0, 1.0, 1.0],
    [1.0 + 1e-12, 1.0, 1e-3, 1e-3 - 1e-13], [1e6, 1.0, 1e-6], list(np.linspace(1, 2, 60)),
    [1.0] * 30 + list(1 + np.arange(30) * 1e-10)])
def test_refinement_reaches_double_precision(values):
    v = spectrum(np.array(values), len(values)).astype(np.longdouble)
    v = (v + v.T) / 2
    e, x = W.eigenvectors(v)
    x = x.astype(np.longdouble)
    assert float(np.abs(x.T @ x - np.eye(len(e))).max()) < 1e-14
    assert float(np.abs(v @ x - x * e).max()) < 1e-14 * np.abs(values).max() * 4
    start = np.linalg.eigh(v.astype(np.float32))[1].astype(np.longdouble)
    assert float(np.abs(start.T @ start - np.eye(len(e))).max()) > 1e-9  # float32 alone is far off


def test_covariance_is_exact():
    fit = [(10**9, 3), (10**9 + 1, -2), (10**9 + 5, 7)]
    n, sums = 3, [sum(c) for c in zip(*fit)]
    centre = [round(Fraction(s, n)) for s in sums]
    scattered = [[sum((r[i] - centre[i]) * (r[j] - centre[j]) for r in fit) for j in (0, 1)] for i in (0, 1)]
    v = W.covariance(scattered, centre, n, sums)
    for i in (0, 1):
        for j in (0, 1):
            want = sum((Fraction(r[i]) - Fraction(sums[i], n)) * (Fraction(r[j]) - Fraction(sums[j], n)) for r in fit) / n
            assert float(v[i, j]) == pytest.approx(float(want), rel=1e-15)


# --- hard negatives


def brute_mine(rows, is_anchor, positives=5, negatives=5):
    best = {}
    for i, v, label in rows:
        if i is not None and label is not None and fine(v):
            best[i] = min(best.get(i, (label, integers(v))), (label, integers(v)))
    out = []
    for a, (label, x) in best.items():
        if not is_anchor(a):
            continue
        score = {i: sum(p * q for p, q in zip(x, y)) for i, (_, y) in best.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if best[i][0] == label][:positives]:
            window = [i for i in order if best[i][0] != label and 80 * score[p] <= 100 * score[i] <= 100 * score[p]]
            out += [(a, p, r + 1, n, score[p], score[n]) for r, n in enumerate(window[:negatives])]
    return sorted(out)


def test_hard_negatives_of_the_table(spark):
    rows = [(i, v, (label + 1) % 10 if i % 7 == 0 else label) for i, v, label in given(spark)]
    got = sorted(map(tuple, op13_hard_negatives(spark, SF).collect()))
    assert got == brute_mine(rows, lambda i: i % 100 == 0) and got


def clustered(seed, n=600, d=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in range(n):
        v = centres[0 if i % 3 else rng.integers(6)] + rng.normal(size=d) * rng.choice([.01, .3])
        rows.append((i, [float(c) for c in v * rng.choice([1, 1, 3])], int(rng.integers(4))))
    return rows


@pytest.mark.parametrize("block", [37, 4096])
def test_hard_negatives_of_clusters(spark, monkeypatch, block):
    monkeypatch.setattr(H, "BLOCK_ROWS", block)
    monkeypatch.setattr(H, "TILE", 8)
    rows = clustered(2)
    got = H.mine(embeddings(spark, rows), F.col("vec_id") % 5 == 0)
    assert sorted(map(tuple, got.collect())) == brute_mine(rows, lambda i: i % 5 == 0)


def test_hard_negatives_of_awkward_rows(spark):
    rnd = random.Random(3)
    rows = [(i, [rnd.choice([0.0, .25, .5, -.5]) for _ in range(6)], rnd.randrange(3)) for i in range(150)]
    rows += [(i, [0.0] * 6, i % 2) for i in range(200, 206)] + rows[:9] + [(3, [.5] * 6, 1), (-20, [.25] * 6, 0)]
    rows += [(None, [.5] * 6, 1), (300, None, 1), (310, [], 1), (320, [.5] * 5 + [None], 1), (330, [.5] * 6, None),
             (340, [float("nan")] * 6, 0), (350, [float("inf")] * 6, 0)]
    df = embeddings(spark, rows).withColumn("x", F.lit(1)).withColumn("cell", F.lit("c")).repartition(3)
    got = sorted(map(tuple, H.mine(df, F.col("vec_id") % 10 == 0).collect()))
    assert got == brute_mine(rows, lambda i: i % 10 == 0)
    assert H.mine(embeddings(spark, rows + [(360, [.5], 0)]), F.lit(False)).collect() == []


def test_hard_negatives_of_nothing_and_little(spark):
    every = F.lit(True)
    assert H.mine(embeddings(spark, []), every).collect() == []
    assert H.mine(embeddings(spark, [(1, [0.0, 0.0], 0), (2, [0.0, 0.0], 1)]), every).collect() == []
    rows = [(1, [1.0, 0.0], 0), (2, [1.0, 0.0], 0), (3, [.9, 0.0], 1)]
    assert sorted(map(tuple, H.mine(embeddings(spark, rows), every).collect())) == brute_mine(rows, lambda i: True)


def test_bounds_cut_rows_of_clusters(monkeypatch):
    """On clustered rows most scores are never computed."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(16, 24)) * 256
    x = np.floor(centres[rng.integers(16, size=4000)] + rng.normal(size=(4000, 24)) * 9).astype(np.int64)
    refs = centres / np.linalg.norm(centres, axis=1)[:, None]
    norms, angles = H.measures(x, refs)
    rows = H.Rows(np.arange(4000), rng.integers(3, size=4000), x, angles, norms)
    cell = angles.argmin(axis=1)
    anchors = rows.take(np.arange(0, 4000, 40))
    search = H.Positives(anchors, np.full(100, -H.LONG), 5)
    done = 0
    real = H.scores

    def counted(a, b):
        nonlocal done
        done += len(a) * len(b)
        return real(a, b)

    monkeypatch.setattr(H, "scores", counted)
    monkeypatch.setattr(H, "TILE", 8)
    own = [H.Positives(anchors.take(np.flatnonzero(cell[::40] == c)), np.full((cell[::40] == c).sum(), -H.LONG), 5)
           for c in range(16)]
    for c in range(16):
        at = np.flatnonzero(cell == c)
        block = rows.take(at[np.argsort(angles[at, c], kind="stable")])
        own[c].meet(block, c)
    done = 0
    for c in range(16):
        at = np.flatnonzero(cell == c)
        block = rows.take(at[np.argsort(angles[at, c], kind="stable")])
        for s in own:
            s.meet(block, c)
    assert done < 100 * 4000 / 5

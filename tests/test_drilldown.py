"""The drill-down against plain comparison, and that only branches that differ are read."""
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from vitrine.operators import drilldown as D

ROWS = "mes string, dia int, item string, valor bigint, qtd int"
KEYS = ["mes", "dia", "item"]


def _both():
    return {"valor": (F.col("valor"),) * 2, "qtd": (F.col("qtd"),) * 2}


def _rows(seed, n=300):
    rnd = random.Random(seed)
    return [(rnd.choice(["m1", "m2", "m3", None]), rnd.choice([1, 2, 3, None]), rnd.choice("abcdefgh"),
             rnd.choice([None, 0, rnd.randrange(100)]), rnd.choice([None, 0, 5])) for _ in range(n)]


def _brute(a, b):
    sides = []
    for rows in (a, b):
        by = defaultdict(Counter)
        for r in rows:
            by[r[:3]][r[3:]] += 1
        sides.append(by)
    out = {}
    for k in set(sides[0]) | set(sides[1]):
        x, y = sides[0][k], sides[1][k]
        if x != y:
            def total(c, i):
                v = [m[i] * n for m, n in c.items() if m[i] is not None]
                return sum(v) if v else None
            out[k] = (sum(x.values()), sum(y.values()), total(x, 0), total(y, 0), total(x, 1), total(y, 1))
    return out


def _found(spark, a, b):
    got = D.divergences(spark.createDataFrame(a, ROWS), spark.createDataFrame(b, ROWS), KEYS, _both()).collect()
    assert len({tuple(r)[:3] for r in got}) == len(got)
    return {tuple(r)[:3]: tuple(r)[3:] for r in got}


def _changed(rows):
    out = list(rows)
    m, d, i, _, q = out[7]
    out[7] = (m, d, i, 999, q)              # another value
    out.append(out[20])                     # a row twice
    out.append(("m9", 1, "z", 1, 1))        # a month of one side only
    first = [k for k, r in enumerate(out) if r[3] == 0][0]
    out[first] = (*out[first][:3], None, out[first][4])  # NULL for 0
    del out[40]
    return out


@pytest.mark.parametrize("listed", [1000, 0])
def test_differences_are_those_of_a_plain_comparison(spark, monkeypatch, listed):
    monkeypatch.setattr(D, "LISTED_KEYS", listed)
    rows = _rows(1)
    changed = _changed(rows)
    random.Random(2).shuffle(changed)
    want = _brute(rows, changed)
    assert len(want) >= 4 and _found(spark, rows, changed) == want


def test_offsetting_changes_in_one_day_are_found(spark):
    a = [("m", 1, "x", 10, 1), ("m", 1, "y", 20, 1), ("m", 2, "x", 5, 1)]
    b = [("m", 1, "x", 20, 1), ("m", 1, "y", 10, 1), ("m", 2, "x", 5, 1)]
    assert set(_found(spark, a, b)) == {("m", 1, "x"), ("m", 1, "y")}


def test_equal_and_empty_tables_have_no_rows(spark):
    rows = _rows(3)
    assert _found(spark, rows, rows[::-1]) == {}
    assert _found(spark, [], []) == {}
    assert _found(spark, [], rows) == _brute([], rows)


def test_one_planted_row_opens_its_month_only(spark, tmp_path):
    rows = [(f"m{i % 12}", i % 28, str(i), i, 1) for i in range(2000)]
    changed = [(*r[:3], 7777, 1) if r[2] == "500" else r for r in rows]
    paths = []
    for name, data in (("a", rows), ("b", changed)):
        paths.append(str(tmp_path / name))
        spark.createDataFrame(data, ROWS).write.partitionBy("mes").parquet(paths[-1])
    a, b = (spark.read.parquet(p) for p in paths)
    found = D.divergences(a, b, KEYS, _both())
    assert [tuple(r)[:3] for r in found.collect()] == [("m8", 24, "500")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert scans and all("m8" in s and "PartitionFilters: []" not in s for s in scans)

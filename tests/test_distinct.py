"""Stored sketches: error on every period, any range, and the edge cases."""
import random
from collections import defaultdict
from datetime import date, timedelta

from vitrine.operators import distinct as D

ROWS = "data date, categoria string, item string"
RANGES = "r int, escopo string, inicio date, fim date"


def _rows(n=6000):
    rnd = random.Random(5)
    out = []
    for _ in range(n):
        d = date(2023, 11, 20) + timedelta(days=rnd.choice([3, rnd.randrange(800)]))
        out.append((rnd.choice([d] * 30 + [None]), rnd.choice(["a", "b", None]),
                    rnd.choice([None, f"i{rnd.randrange(3000)}", f"i{rnd.randrange(40)}"])))
    return out + [(date(2026, 7, 1), "c", None)] + out[:50]


def test_every_calendar_period_is_exact_and_estimated_within_the_bound(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, ROWS)
    want = defaultdict(set)
    for d, c, i in rows:
        if d is not None:
            for t, start in (("mes", d.replace(day=1)), ("ano", date(d.year, 1, 1)),
                             ("trimestre", date(d.year, 3 * ((d.month - 1) // 3) + 1, 1))):
                want[t, start, c].update({i} - {None})
    got = D.counts_by_period(df, D.sketch_index(df, "item"), "item").collect()
    assert {(r.tipo, r.inicio, r.categoria): r.exato for r in got} == {k: len(v) for k, v in want.items()}
    assert len(got) == len(want)
    for r in got:
        assert abs(r.estimativa - r.exato) <= max(1, D.ERROR_BOUND * r.exato), r


def test_any_range_merges_the_sketches_of_its_days(spark):
    rows = _rows()
    rnd = random.Random(6)
    asked = [(i, "d", date(2023, 11, 20) + timedelta(days=a), date(2023, 11, 20) + timedelta(days=a + rnd.randrange(400)))
             for i, a in enumerate(rnd.randrange(800) for _ in range(20))]
    index = D.sketch_index(spark.createDataFrame(rows, ROWS), "item")
    got = {r.r: r.estimativa for r in
           D.estimated_counts(index, spark.createDataFrame(asked, RANGES), "r").collect()}
    for i, _, first, last in asked:
        items = {x for d, _, x in rows if d is not None and first <= d <= last and x is not None}
        assert abs(got.get(i, 0) - len(items)) <= max(1, D.ERROR_BOUND * len(items))


def test_empty_table(spark):
    df = spark.createDataFrame([], ROWS)
    assert D.counts_by_period(df, D.sketch_index(df, "item"), "item").count() == 0


def test_exact_counts_move_each_item_once(spark):
    """Rows without a date lie in no period; NULL items and keys, and items of several months."""
    day = date
    rows = [(day(2024, 1, 31), "a", "x"), (day(2024, 2, 1), "a", "x"), (day(2024, 2, 9), "a", "x"),
            (day(2024, 7, 1), "a", "x"), (day(2024, 2, 1), "a", "y"), (day(2025, 1, 1), "a", None),
            (day(2024, 2, 1), None, "x"), (None, "a", "z")]
    out = D.exact_counts(spark.createDataFrame(rows, "data date, categoria string, i string"), "i")
    want = {(t, s, "a"): n for t, s, n in [
        ("mes", day(2024, 1, 1), 1), ("mes", day(2024, 2, 1), 2), ("mes", day(2024, 7, 1), 1),
        ("trimestre", day(2024, 1, 1), 2), ("trimestre", day(2024, 7, 1), 1), ("ano", day(2024, 1, 1), 2),
        ("mes", day(2025, 1, 1), 0), ("trimestre", day(2025, 1, 1), 0), ("ano", day(2025, 1, 1), 0)]}
    want |= {("mes", day(2024, 2, 1), None): 1, ("trimestre", day(2024, 1, 1), None): 1, ("ano", day(2024, 1, 1), None): 1}
    assert {(r.tipo, r.inicio, r.categoria): r.exato for r in out.collect()} == want
    # rows by (key, item), then counts: no shuffle of rows spread over the periods
    p = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert p.count("Exchange hashpartitioning") == 2

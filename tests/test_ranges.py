"""The range index against brute force: covers, sums of any range, stored periods
that differ from the date, and the plan that answers are computed by."""
import random
import re
from datetime import date, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import SMOKE
from vitrine.operators import ranges as R
from vitrine.operators.answers import answer_questions
from vitrine.operators.metrics import period_cube
from vitrine.operators.periods import KINDS, period_match, periods_table
from vitrine.plans.lakehouse import lakehouse

ORIGIN = date(1, 1, 1)
ROWS = "data date, ano int, mes int, categoria string, subcategoria string, fat_num double, qtd_vendas_num int"
RANGES = "r int, escopo string, inicio date, fim date"


def _rows(seed=3, n=400):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        d = date(2024, 1, 1) + timedelta(days=rnd.choice([5, rnd.randrange(900)]))  # one hot day
        year, month = rnd.choice([(d.year, d.month)] * 6 + [(d.year + 1, d.month), (None, d.month), (d.year, None)])
        out.append((rnd.choice([d] * 9 + [None]), year, month, rnd.choice(["a", "b", None]),
                    rnd.choice(["x", "y", None]), rnd.choice([None, rnd.randrange(10 ** 6) / 100]),
                    rnd.choice([None, rnd.randrange(50)])))
    return out + out[:20]


def test_cover_is_the_range_in_few_disjoint_intervals(spark):
    rnd = random.Random(1)
    ranges = [(date(2024, 2, 29), date(2024, 2, 29)), (date(2024, 3, 2), date(2024, 3, 1)),
              (ORIGIN, ORIGIN), (None, date(12, 5, 6)), (date(9990, 1, 1), date(9999, 12, 31))]
    for _ in range(60):
        a = date(1990, 1, 1) + timedelta(days=rnd.randrange(9000))
        ranges.append((a, a + timedelta(days=rnd.randrange(4000))))
    df = spark.createDataFrame([(i, "d", a, b) for i, (a, b) in enumerate(ranges)], RANGES)
    got = {}
    for r in R.cover(df, "r").collect():
        assert r.escopo == "d"
        got.setdefault(r.r, []).append((r.nivel, r.no))
    for i, (a, b) in enumerate(ranges):
        nodes = got.get(i, [])
        days = [d for k, n in nodes for d in range(n << k, (n + 1) << k)]
        assert sorted(days) == list(range(((a or ORIGIN) - ORIGIN).days, (b - ORIGIN).days + 1))
        assert len(nodes) <= 2 * R.LEVELS + len(days) // 2 ** (R.LEVELS - 1)


def test_any_range_sums_equal_brute_force(spark):
    rows = _rows()
    index = R.range_index(spark.createDataFrame(rows, ROWS)).checkpoint()
    rnd = random.Random(2)
    ranges = [(i, "d", date(2024, 1, 1) + timedelta(days=a), date(2024, 1, 1) + timedelta(days=a + rnd.randrange(400)))
              for i, a in enumerate(rnd.randrange(-30, 900) for _ in range(25))]
    asked = spark.createDataFrame(ranges, RANGES)

    def total(values):
        known = [v for v in values if v is not None]
        return sum(known) if known else None

    for by in ([], ["categoria"], ["categoria", "subcategoria"]):
        want = {}
        for i, _, a, b in ranges:
            for d, _, _, c, s, fat, qtd in rows:
                if d is not None and a <= d <= b:
                    key = (i, *{0: (), 1: (c,), 2: (c, s)}[len(by)])
                    want.setdefault(key, []).append((None if fat is None else Decimal(f"{fat:.2f}"), qtd))
        got = {tuple(r)[:-2]: tuple(r)[-2:] for r in R.range_sums(index, asked, "r", by).collect()}
        assert got == {k: (total([f for f, _ in v]), total([q for _, q in v])) for k, v in want.items()}


def test_cube_by_stored_periods_equals_the_period_condition(spark):
    """Stored year and month decide MTD and YTD, also where they differ from the date."""
    rows, ref = spark.createDataFrame(_rows(), ROWS), date(2025, 3, 17)
    periods = periods_table(spark, ref)
    direct = (rows.join(F.broadcast(periods), period_match(rows, periods))
              .groupBy("periodo", "categoria", "subcategoria")
              .agg(F.sum(F.col("fat_num").cast("decimal(28,2)")).cast("double").alias("fat"),
                   F.sum("qtd_vendas_num").alias("qtd")))
    cube = period_cube(spark, rows, ref).filter("gid = 0").drop("gid")
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, cube.collect()), key=key) == sorted(map(tuple, direct.collect()), key=key)
    assert {r.periodo for r in cube.select("periodo").distinct().collect()} <= \
        {r.periodo for r in periods.collect()} and len(KINDS) == periods.count()


def test_empty_table(spark):
    index = R.range_index(spark.createDataFrame([], ROWS))
    asked = spark.createDataFrame([(1, "d", date(2024, 1, 1), date(2024, 2, 1))], RANGES)
    assert R.range_sums(index, asked, "r").count() == 0
    assert R.trailing_totals(index, (7, 30)).count() == 0


def test_answers_scan_the_table_once_and_join_by_equality(spark):
    L = lakehouse(spark, SMOKE)
    ref = L.reference()
    answers = answer_questions(L.routed(), L.analytic(), ref.last_date, ref.rows, L.range_index())
    p = answers._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in p and "CartesianProduct" not in p
    for column in ("titulo_produto", "fat_num"):  # only the answer table has these
        scans = [line for line in p.split("\n") if "FileScan parquet" in line and re.search(rf"{column}#\d+", line)]
        assert len(scans) == 1

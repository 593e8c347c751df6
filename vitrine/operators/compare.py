"""Period comparisons from the metric glossary: MoM (same month last year),
YoY, M-1 / M+1, LY, absolute and percent change, running MTD / YTD.

Each series is first reduced to one row per month / year / day (partial
aggregation before the shuffle). Every such row is then emitted under its own
period and under the periods it is compared with, and one group-by puts them
side by side: one scan, no join, and not lag(), so gaps never pair the wrong
neighbours.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.functions.parsing import money_exact


def _fat(c="fat_num") -> Column:
    return F.sum(money_exact(c))


def _delta(cur: str, prev: str) -> tuple[Column, Column]:
    d = F.col(cur) - F.col(prev)
    return (d.cast("double").alias("delta_abs"),
            F.try_divide(d.cast("double"), F.col(prev).cast("double")).alias("delta_pct"))


def monthly(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.trunc("data", "month").alias("mes_ref"))
            .agg(_fat().alias("fat"), F.sum("qtd_vendas_num").cast("long").alias("vendas")))


def yearly(df: DataFrame) -> DataFrame:
    return (df.groupBy(F.year("data").alias("ano"))
            .agg(_fat().alias("fat"), F.sum("qtd_vendas_num").cast("long").alias("vendas")))


def daily(df: DataFrame) -> DataFrame:
    return (df.groupBy("data")
            .agg(_fat().alias("fat"), F.sum("qtd_vendas_num").cast("long").alias("vendas")))


def _beside(cur: DataFrame, key: str, partners: dict[str, tuple[Callable, Callable]],
            keys: tuple[str, ...] = ()) -> DataFrame:
    """``cur`` (one row per ``key`` and ``keys``) with fat / vendas of other periods.

    ``partners``: suffix -> (shift, inverse); ``shift`` gives the period that a
    row is compared with, ``inverse`` an array of the periods that may be
    compared with it (those whose shift is another period are left out)."""
    def at(period, role):
        return F.struct(period.alias(key), F.lit(role).alias("_role"))

    def compared_at(suffix, shift, inverse):
        fitting = F.filter(inverse(F.col(key)), lambda c: shift(c) == F.col(key))
        return F.transform(fitting, lambda c: at(c, suffix))

    places = [F.array(at(F.col(key), ""))]
    for suffix, partner in partners.items():
        places.append(compared_at(suffix, *partner))
    rows = cur.select(F.inline(F.concat(*places)), *keys, "fat", "vendas")
    values = [F.max(F.when(F.col("_role") == role, F.col(c))).alias(c + role)
              for role in ["", *partners] for c in ("fat", "vendas")]
    own = F.max(F.col("_role") == "").alias("_own")
    return rows.groupBy(key, *keys).agg(*values, own).where("_own").drop("_own")


def _months(n: int) -> tuple[Callable, Callable]:
    """Shift by ``n`` months. Up to four days of a month's end share one shifted
    day, so the inverse looks at that many."""
    return (lambda c: F.add_months(c, n),
            lambda c: F.transform(F.sequence(F.lit(0), F.lit(3)),
                                  lambda d: F.date_add(F.add_months(c, -n), d)))


def _years(n: int) -> tuple[Callable, Callable]:
    return lambda c: c + n, lambda c: F.array(c - n)


def mom_same_month_ly(df: DataFrame) -> DataFrame:
    """MoM as the glossary defines it: this month / same month last year."""
    j = _beside(monthly(df), "mes_ref", {"_ly": _months(-12)})
    return j.select("mes_ref", F.col("fat").cast("double").alias("faturamento"),
                    F.col("fat_ly").cast("double").alias("faturamento_ly"),
                    "vendas", "vendas_ly", *_delta("fat", "fat_ly"))


def yoy(df: DataFrame) -> DataFrame:
    j = _beside(yearly(df), "ano", {"_ly": _years(-1)})
    return j.select("ano", F.col("fat").cast("double").alias("faturamento"),
                    F.col("fat_ly").cast("double").alias("faturamento_ly"),
                    "vendas", "vendas_ly", *_delta("fat", "fat_ly"))


def month_offset(df: DataFrame) -> DataFrame:
    """M-1 (previous month) and M+1 (next month) next to each month."""
    j = _beside(monthly(df), "mes_ref", {"_m1": _months(-1), "_p1": _months(1)})
    return j.select("mes_ref", F.col("fat").cast("double").alias("faturamento"),
                    F.col("fat_m1").cast("double").alias("faturamento_m_1"),
                    F.col("fat_p1").cast("double").alias("faturamento_m_mais_1"))


def last_year(df: DataFrame) -> DataFrame:
    """Each day next to the same day one year earlier (29/02 -> 28/02)."""
    j = _beside(daily(df), "data", {"_ly": _months(-12)})
    return j.select("data", F.col("fat").cast("double").alias("faturamento"),
                    F.col("fat_ly").cast("double").alias("faturamento_ly"),
                    "vendas", "vendas_ly")


def delta_abs_pct(df: DataFrame, ref: date, keys=("categoria",)) -> DataFrame:
    """Year-to-date per key against the same range one year earlier."""
    y0 = date(ref.year, 1, 1)
    ly_end = F.add_months(F.lit(ref), -12)
    cur = (F.col("data") >= F.lit(y0)) & (F.col("data") <= F.lit(ref))
    prev = (F.col("data") >= F.lit(date(ref.year - 1, 1, 1))) & (F.col("data") <= ly_end)
    agg = (df.filter(cur | prev).groupBy(*keys)
           .agg(F.sum(F.when(cur, money_exact("fat_num"))).alias("atual"),
                F.sum(F.when(prev, money_exact("fat_num"))).alias("anterior")))
    return agg.select(*keys, F.col("atual").cast("double").alias("faturamento_atual"),
                      F.col("anterior").cast("double").alias("faturamento_ly"),
                      *_delta("atual", "anterior"))


def running_mtd_ytd(df: DataFrame) -> DataFrame:
    """Daily totals with month-to-date and year-to-date running sums. The
    window runs over the per-day table, partitioned by year."""
    d = daily(df).withColumns({"_y": F.year("data"), "_m": F.month("data")})
    upto = Window.unboundedPreceding
    wy = Window.partitionBy("_y").orderBy("data").rowsBetween(upto, 0)
    wm = Window.partitionBy("_y", "_m").orderBy("data").rowsBetween(upto, 0)
    return d.select("data", F.col("fat").cast("double").alias("faturamento_dia"),
                    F.sum("fat").over(wm).cast("double").alias("faturamento_mtd"),
                    F.sum("fat").over(wy).cast("double").alias("faturamento_ytd"),
                    F.col("vendas").alias("vendas_dia"),
                    F.sum("vendas").over(wm).cast("long").alias("vendas_mtd"),
                    F.sum("vendas").over(wy).cast("long").alias("vendas_ytd"))


def compare(df: DataFrame, grain: str = "month", offset: int = -12,
            keys: tuple[str, ...] = ()) -> DataFrame:
    """Generic period comparison: each (period, keys) next to the period
    ``offset`` steps away (months for grain='month' and 'day', years for
    'year'), with absolute and percent change. MoM-as-defined (-12 months),
    M-1 (-1), YoY (-1 year) and LY (-12 months on days) are special cases."""
    if grain == "month":
        period, partner = F.trunc("data", "month"), _months(offset)
    elif grain == "year":
        period, partner = F.year("data"), _years(offset)
    elif grain == "day":
        period, partner = F.col("data"), _months(offset)
    else:
        raise ValueError(f"unknown grain {grain!r}")
    cur = (df.groupBy(period.alias("periodo_ref"), *keys)
           .agg(_fat().alias("fat"), F.sum("qtd_vendas_num").cast("long").alias("vendas")))
    j = _beside(cur, "periodo_ref", {"_prev": partner}, keys)
    return j.select("periodo_ref", *keys, F.col("fat").cast("double").alias("faturamento"),
                    F.col("fat_prev").cast("double").alias("faturamento_anterior"),
                    "vendas", "vendas_prev", *_delta("fat", "fat_prev"))

"""Sums over any date range from dyadic intervals.

Days are numbered from 0001-01-01. Level k cuts them into intervals of 2^k days;
the index holds one row of sums for each interval and key that has rows. A range
is the disjoint union of at most two intervals a level, so its sums are those of
O(log days) rows, found by an equi-join on the interval: no range condition meets
the answer table.

Cumulative periods select by the stored ``ano`` / ``mes`` columns, which may differ
from the date, so each interval is kept in three scopes: all rows, those of a stored
year, and those of a stored year and month. Rows are reduced to days before they
are given their intervals; the index has about six rows for each day and key.

Rows without a date lie in no range; a NULL stored year or month lies in no such
scope. Sums are exact decimals, so regrouping does not change them; where all
values are NULL the sum is NULL. An empty range (end before start) has no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.functions.parsing import money_exact
from vitrine.operators.keys import broadcast_if_small

# Intervals of 1, 2, 4 ... 2048 days; longer ranges take several of the longest.
LEVELS = 12
FIRST_DAY = "0001-01-01"
INTERVAL = ["escopo", "nivel", "no"]


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit(FIRST_DAY).cast("date"))


def number_day(n: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), n)


def every_day() -> Column:
    return F.lit("d")


def stored_year(ano: Column) -> Column:
    return F.concat(F.lit("a"), ano.cast("string"))


def stored_month(ano: Column, mes: Column) -> Column:
    return F.concat(F.lit("m"), ano.cast("string"), F.lit("-"), mes.cast("string"))


def period_scope(periods: DataFrame) -> Column:
    """The scope of a period row: stored month (MTD), stored year (YTD), any (a day)."""
    return (F.when(periods["kind"] == "mtd", stored_month(periods["p_ano"], periods["p_mes"]))
            .when(periods["kind"] == "ytd", stored_year(periods["p_ano"]))
            .otherwise(every_day()))


def _sums(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("fat").alias("fat"), F.sum("qtd").alias("qtd"))


def range_index(rows: DataFrame, keys: Sequence[str] = ("categoria", "subcategoria")) -> DataFrame:
    """(escopo, nivel, no, *keys, fat, qtd) of the answer table ``rows``."""
    daily = (rows.filter(F.col("data").isNotNull()).groupBy("data", "ano", "mes", *keys)
             .agg(F.sum(money_exact("fat_num")).alias("fat"), F.sum("qtd_vendas_num").alias("qtd")))
    scopes = F.array(every_day(), stored_year(F.col("ano")), stored_month(F.col("ano"), F.col("mes")))
    scoped = daily.select(F.explode(F.array_compact(scopes)).alias("escopo"),
                          day_number(F.col("data")).alias("_dia"), *keys, "fat", "qtd")
    levels = F.sequence(F.lit(0), F.lit(LEVELS - 1))
    nodes = (scoped.select("*", F.explode(levels).alias("nivel"))
             .withColumn("no", F.expr("shiftright(_dia, nivel)")))
    return _sums(nodes, [*INTERVAL, *keys])


def _on_level(k: int):
    return lambda n: F.struct(F.lit(k).alias("nivel"), n.alias("no"))


def cover(ranges: DataFrame, key: str) -> DataFrame:
    """(key, escopo, nivel, no): the intervals of each range ``key, escopo, inicio,
    fim`` (days, both included; a NULL ``inicio`` is unbounded)."""
    start = F.coalesce(day_number(F.col("inicio")), F.lit(0))
    end = day_number(F.col("fim")) + 1
    levels = []
    for k in range(LEVELS):
        first, after = F.shiftright(start + (2 ** k - 1), k), F.shiftright(end, k)
        if k == LEVELS - 1:
            found = F.sequence(first, after - 1)
        else:
            found = F.array_compact(F.array(F.when(first % 2 == 1, first),
                                            F.when(after % 2 == 1, after - 1)))
        found = F.when(first < after, found).otherwise(F.array().cast("array<int>"))
        levels.append(F.transform(found, _on_level(k)))
    return (ranges.select(key, "escopo", F.explode(F.flatten(F.array(*levels))).alias("_i"))
            .select(key, "escopo", "_i.nivel", "_i.no"))


def range_sums(index: DataFrame, ranges: DataFrame, key: str, by: Sequence[str] = ()) -> DataFrame:
    """(key, *by, fat, qtd) of each range that has rows. ``by`` may be fewer keys
    than the index has: its intervals are summed up to them first."""
    have = [c for c in index.columns if c not in (*INTERVAL, "fat", "qtd")]
    nodes = index if list(by) == have else _sums(index, [*INTERVAL, *by])
    return _sums(nodes.join(broadcast_if_small(cover(ranges, key)), INTERVAL), [key, *by])


def days_with_rows(index: DataFrame, periods: DataFrame, key: str) -> DataFrame:
    """(key, data, p_ano, p_mes): the days on which each period may have rows, of a
    cumulative period those that its scope has; p_ano and p_mes are NULL where a row
    need not have them. For joins of finer rows, by date."""
    cumulative = F.col("kind").isin("mtd", "ytd")
    day = periods.filter(~cumulative).select(
        key, F.col("inicio").alias("data"), F.lit(None).cast("int").alias("p_ano"),
        F.lit(None).cast("int").alias("p_mes"))
    of = periods.filter(cumulative).withColumn("escopo", period_scope(periods))
    known = index.filter("nivel = 0").select("escopo", "no").distinct()
    days = (known.join(broadcast_if_small(of), "escopo").filter(F.col("no") <= day_number(F.col("fim")))
            .select(key, number_day(F.col("no")).alias("data"), "p_ano", "p_mes"))
    return day.unionByName(days)


def period_ranges(periods: DataFrame, key: str) -> DataFrame:
    """Period rows as ranges. Cumulative ones have no first day: their scope bounds them."""
    return periods.select(key, period_scope(periods).alias("escopo"),
                          F.when(~F.col("kind").isin("mtd", "ytd"), F.col("inicio")).alias("inicio"), "fim")


def trailing_totals(index: DataFrame, days: Sequence[int]) -> DataFrame:
    """(data, dias, faturamento, vendas): for each day with rows and each length, the
    totals of that many days up to it."""
    dates = index.filter((F.col("escopo") == every_day()) & (F.col("nivel") == 0)).select(
        number_day(F.col("no")).alias("fim")).distinct()
    ranges = (dates.select("fim", F.explode(F.array(*[F.lit(d) for d in days])).alias("dias"))
              .select(F.struct("fim", "dias").alias("_r"), every_day().alias("escopo"),
                      F.date_sub("fim", F.col("dias") - 1).alias("inicio"), "fim"))
    return range_sums(index, ranges, "_r").select(
        F.col("_r.fim").alias("data"), F.col("_r.dias").alias("dias"),
        F.col("fat").cast("double").alias("faturamento"), F.col("qtd").cast("long").alias("vendas"))

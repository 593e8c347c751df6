"""Distinct counts over any period from stored sketches.

Distinct counts of days do not add up, sketches of them merge. Each day and key is
reduced to one HyperLogLog sketch by Spark's own sketch aggregates; like the sums of
:mod:`vitrine.operators.ranges`, sketches are kept for the dyadic intervals of days,
so a period merges O(log days) of them and no row is read again. A sketch takes at
most 2^``LG_K`` bytes, whatever it has seen.

``exact_counts`` counts the same periods from the rows, in one pass for all of them.
The relative standard error of a sketch is 1.04 / sqrt(2^LG_K), 1.6 %; ``ERROR_BOUND``
is five of these.

Rows without a date lie in no period, NULL items are not counted, a NULL key is a key.
A period with rows of a key but no item counts 0; one without rows has no row.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.keys import broadcast_if_small
from vitrine.operators.ranges import INTERVAL, LEVELS, cover, day_number, every_day, number_day

LG_K = 12
ERROR_BOUND = 5 * 1.04 / math.sqrt(2 ** LG_K)

# Calendar periods: name, unit of ``trunc``, months.
CALENDAR = (("mes", "month", 1), ("trimestre", "quarter", 3), ("ano", "year", 12))


def calendar_periods(day: Column) -> Column:
    """Array of the calendar periods (tipo, inicio, fim) that hold ``day``."""
    def period(tipo: str, unit: str, months: int) -> Column:
        start = F.trunc(day, unit)
        return F.struct(F.lit(tipo).alias("tipo"), start.alias("inicio"),
                        F.date_sub(F.add_months(start, months), 1).alias("fim"))
    return F.array(*[period(*p) for p in CALENDAR])


def sketch_index(rows: DataFrame, item: str, keys: Sequence[str] = ("categoria",)) -> DataFrame:
    """(escopo, nivel, no, *keys, sketch) of ``rows`` (``data``, the keys, ``item``)."""
    daily = (rows.filter(F.col("data").isNotNull()).groupBy("data", *keys)
             .agg(F.hll_sketch_agg(item, LG_K).alias("sketch")))
    nodes = (daily.select(every_day().alias("escopo"), day_number(F.col("data")).alias("_dia"),
                          F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("nivel"),
                          *keys, "sketch")
             .withColumn("no", F.expr("shiftright(_dia, nivel)")))
    return nodes.groupBy(*INTERVAL, *keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_counts(index: DataFrame, ranges: DataFrame, key: str,
                     by: Sequence[str] = ()) -> DataFrame:
    """(key, *by, estimativa) of each range ``key, escopo, inicio, fim`` with rows."""
    return (index.join(broadcast_if_small(cover(ranges, key)), INTERVAL).groupBy(key, *by)
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimativa")))


def exact_counts(rows: DataFrame, item: str, by: Sequence[str] = ("categoria",)) -> DataFrame:
    """(tipo, inicio, *by, exato) of every calendar period. Rows are reduced to the
    months of each (key, item) first, in one shuffle: a hot key is spread by its items,
    a hot item is one row of each map task, and longer periods follow from the months."""
    months = (rows.filter(F.col("data").isNotNull()).groupBy(*by, F.col(item).alias("_item"))
              .agg(F.collect_set(F.trunc("data", "month")).alias("_months")))
    def starts(unit: str) -> Column:
        return F.array_distinct(F.transform("_months", lambda month: F.trunc(month, unit)))

    periods = F.array(*[F.struct(F.lit(tipo).alias("tipo"), starts(unit).alias("starts"))
                        for tipo, unit, _ in CALENDAR])
    each = (months.select(*by, "_item", F.explode(periods).alias("_p"))
            .select("_p.tipo", F.explode("_p.starts").alias("inicio"), *by, "_item"))
    return each.groupBy("tipo", "inicio", *by).agg(F.count("_item").alias("exato"))


def counts_by_period(rows: DataFrame, index: DataFrame, item: str,
                     by: Sequence[str] = ("categoria",)) -> DataFrame:
    """(tipo, inicio, *by, exato, estimativa) of every calendar period with rows."""
    days = index.filter("nivel = 0").select("no").distinct()
    ranges = (days.select(F.explode(calendar_periods(number_day(F.col("no")))).alias("_p"))
              .distinct().select("_p", every_day().alias("escopo"), "_p.inicio", "_p.fim"))
    found = estimated_counts(index, ranges, "_p", by).select(
        F.col("_p.tipo").alias("_tipo"), F.col("_p.inicio").alias("_inicio"),
        *[F.col(c).alias(f"_{c}") for c in by], "estimativa")
    exact = exact_counts(rows, item, by)
    on = [exact[c].eqNullSafe(found[f"_{c}"]) for c in ("tipo", "inicio", *by)]
    return exact.join(found, on, "left").select("tipo", "inicio", *by, "exato", "estimativa")


def within_bound(exact: Column, estimate: Column) -> Column:
    """Whether an estimate keeps ``ERROR_BOUND`` (one item is always allowed)."""
    return F.coalesce(F.abs(estimate - exact) <= F.greatest(F.lit(1.0), exact * ERROR_BOUND), F.lit(False))

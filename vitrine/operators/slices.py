"""A table cut into ranges of days, so that a pass over one range moves a bounded
number of rows.

Steps that work within a day (daily ranks, the silver dedup) or row by row (joins to
the dimensions) give the same rows range by range. What a pass shuffles is freed when
it is written, so disk holds one range at a time beside the written layers.

The rows of each day are counted once; the counts (one row a day, bounded by the
calendar) come to the driver. The ranges are half-open and cover every value: NULL
days belong to the first. A day is never cut: a range has at most ``most`` rows, or one
day.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Slice:
    """Days after ``after`` up to ``upto`` (None: unbounded, NULL days before all), and its rows."""
    after: Any
    upto: Any
    rows: int

    def of(self, df: DataFrame, day: str = "data") -> DataFrame:
        c = F.col(day)
        if self.after is not None:
            df = df.filter(c > F.lit(self.after))
        if self.upto is not None:
            upto = c <= F.lit(self.upto)
            df = df.filter(upto if self.after is not None else upto | c.isNull())
        return df


def runs(counts: Sequence[tuple[Any, int]], most: int) -> list[list[tuple[Any, int]]]:
    """Neighbours of ``counts`` (key, rows) joined up to ``most`` rows a run."""
    out: list[list[tuple[Any, int]]] = []
    rows = 0
    for key, n in counts:
        if not out or rows + n > most:
            out.append([])
            rows = 0
        out[-1].append((key, n))
        rows += n
    return out


def day_slices(df: DataFrame, most: int, day: str = "data") -> list[Slice]:
    """Slices of ``df`` with at most ``most`` rows each, or one day."""
    found = df.groupBy(F.col(day).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy("d").collect()
    nulls = sum(r["n"] for r in found if r["d"] is None)
    days = [(r["d"], r["n"]) for r in found if r["d"] is not None]
    if days:
        days[0] = (days[0][0], days[0][1] + nulls)
    cut = runs(days, most)
    if len(cut) < 2:
        return [Slice(None, None, nulls if not days else sum(n for _, n in days))]
    ends = [None, *(run[-1][0] for run in cut[:-1]), None]
    return [Slice(a, b, sum(n for _, n in run)) for a, b, run in zip(ends, ends[1:], cut)]

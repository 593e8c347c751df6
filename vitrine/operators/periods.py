"""Reporting periods relative to the base's last date ("today" is data-driven)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StringType, StructField, StructType

from vitrine.constants import (LABEL_BR_DATE, LABEL_ISO_DATE, LABEL_MTD, LABEL_TODAY,
                               LABEL_YESTERDAY, LABEL_YTD)

KINDS = ("today", "yesterday", "mtd", "ytd")


@dataclass(frozen=True)
class Period:
    kind: str
    label: str
    start: date
    end: date
    ano: int | None = None  # MTD/YTD use the stored period columns
    mes: int | None = None
    empty: bool = False  # the base has no rows: nothing can match

    def condition(self) -> Column:
        """Filter on bare columns so it reaches the Parquet scan (partition
        pruning on ano/mes, row-group pruning on data)."""
        if self.empty:
            return F.lit(False)
        if self.kind == "mtd":
            return (F.col("ano") == self.ano) & (F.col("mes") == self.mes) & \
                (F.col("data") <= F.lit(self.end))
        if self.kind == "ytd":
            return (F.col("ano") == self.ano) & (F.col("data") <= F.lit(self.end))
        return F.col("data") == F.lit(self.start)


NO_DATA = "sem dados"


def resolve(kind: str, ref: date | None, day: date | None = None, br_text: bool = False) -> Period:
    """The period ``kind`` relative to the base's last date ``ref``. With an
    empty base (``ref`` is None) the period matches no row."""
    if ref is None or (kind == "date" and day is None):
        return Period(kind, f"{kind} ({NO_DATA})", date.min, date.min, empty=True)
    if kind == "today":
        return Period(kind, LABEL_TODAY.format(ref=ref.isoformat()), ref, ref)
    if kind == "yesterday":
        y = ref - timedelta(days=1)
        return Period(kind, LABEL_YESTERDAY.format(day=y.isoformat()), y, y)
    if kind == "mtd":
        return Period(kind, LABEL_MTD.format(mm=f"{ref.month:02d}", yyyy=ref.year,
                                             ref=ref.isoformat()),
                      ref.replace(day=1), ref, ref.year, ref.month)
    if kind == "ytd":
        return Period(kind, LABEL_YTD.format(yyyy=ref.year, ref=ref.isoformat()),
                      ref.replace(month=1, day=1), ref, ref.year, None)
    if kind == "date":
        assert day is not None
        label = (LABEL_BR_DATE.format(dd=f"{day.day:02d}", mm=f"{day.month:02d}", yyyy=day.year)
                 if br_text else LABEL_ISO_DATE.format(day=day.isoformat()))
        return Period(kind, label, day, day)
    raise ValueError(f"unknown period kind {kind!r}")


# Month of ``data`` as a partition column of the written answer tables. The
# source's own ano / mes columns may be missing or wrong for a row; this one is
# derived from the date, so single days can be pruned by it.
DAY_PARTITION = "_mes_data"


def day_partition(day: Column) -> Column:
    return F.date_format(day, "yyyyMM")


def in_period(df: DataFrame, period: Period) -> DataFrame:
    """Rows of a period. A single day also filters on the date-derived
    partition where the table has it, so other months' files stay closed."""
    rows = df.filter(period.condition())
    if period.kind not in ("mtd", "ytd") and not period.empty and DAY_PARTITION in df.columns:
        rows = rows.filter(F.col(DAY_PARTITION) == period.start.strftime("%Y%m"))
    return rows


PERIOD_SCHEMA = StructType([
    StructField("periodo", StringType(), False), StructField("kind", StringType(), False),
    StructField("inicio", DateType(), False), StructField("fim", DateType(), False),
    StructField("p_ano", IntegerType(), True), StructField("p_mes", IntegerType(), True)])


def periods_table(spark: SparkSession, ref: date, kinds=KINDS) -> DataFrame:
    """The standard periods as a 4-row table (a fixed size: safe to broadcast)."""
    rows = [(p.label, p.kind, p.start, p.end, p.ano, p.mes)
            for p in (resolve(k, ref) for k in kinds)]
    return spark.createDataFrame(rows, PERIOD_SCHEMA)


def period_match(rows: DataFrame, periods: DataFrame) -> Column:
    """Join condition of a row to a period row (same semantics as Period.condition)."""
    cumulative = (periods["kind"].isin("mtd", "ytd")
                  & (rows["ano"] == periods["p_ano"])
                  & (periods["p_mes"].isNull() | (rows["mes"] == periods["p_mes"]))
                  & (rows["data"] <= periods["fim"]))
    single_day = (~periods["kind"].isin("mtd", "ytd")) & (rows["data"] == periods["inicio"])
    return cumulative | single_day

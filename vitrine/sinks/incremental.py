"""A base that is rebuilt day by day: only days whose content changed.

A drop is a full file. For each day of it the rows are summed up free of their
order: their number and the sums of two independent 64-bit hashes over all
columns. Days whose sums differ from those of the version before are built
again; all others keep the files they have.

Files of a version lie below ``dias/v<version>/dia=<day>``; a version's manifest
says for every day which version's files hold it, with the day's sums. Publishing
the manifest (one marker file) makes the version current. Nothing is
overwritten, so a reader keeps the version it began with, and a refresh that fails
half-way leaves no trace: its folder is written anew by the next one.

``build`` has to work within a day, of which it keeps at least one row (as the
silver dedup by day and listing does). A day of any size is written by several
tasks. Days are built in runs of a bounded number of rows, what one has shuffled is
freed before the next.
The sums are one partial aggregation over the drop; days that changed are read a
second time. The manifest has a row for each day and is the one table collected
to the driver: its size is bounded by the calendar. NULL is a day of its own.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from vitrine.operators.keys import broadcast_if_small
from vitrine.operators.slices import runs
from vitrine.session import TASK_ROWS, freed, slice_rows
from vitrine.sinks import writers as Wr

NO_DAY = "sem-data"
MANIFEST = "dia string, versao int, linhas long, soma_a decimal(38,0), soma_b decimal(38,0)"


DAY, MONTH = "yyyy-MM-dd", "yyyy-MM"


def day_text(day: str, unit: str = DAY):
    return F.coalesce(F.date_format(F.col(day), unit), F.lit(NO_DAY))


def content_sums(df: DataFrame, day: str, unit: str = DAY) -> DataFrame:
    """Rows and order-free content sums of every day (or month). Equal rows add up, so a row
    that comes twice differs from one that comes once."""
    columns = [F.col(f"`{c}`") for c in sorted(df.columns)]
    # a hash skips NULLs: flags tell (NULL, x) from (x, NULL)
    flags = F.array(*[c.isNull() for c in columns])
    a, b = (F.xxhash64(F.lit(seed), flags, *columns).cast("decimal(38,0)") for seed in (1, 2))
    return df.groupBy(day_text(day, unit).alias("dia")).agg(
        F.count(F.lit(1)).alias("linhas"), F.sum(a).alias("soma_a"), F.sum(b).alias("soma_b"))


def _manifest(spark: SparkSession, base_dir: str, version: int | None) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{base_dir}/manifesto/v{version:06d}")


def _span(drop: DataFrame, day: str, days: Sequence[str]) -> Column | None:
    """A range of dates that holds the rows of ``days`` (texts in order), for the scan to
    prune by; None where the texts are not plain dates."""
    plain = [d for d in days if d != NO_DAY]
    if not isinstance(drop.schema[day].dataType, DateType) or not plain \
            or not all(re.fullmatch(r"\d{4}-\d\d(-\d\d)?", d) for d in plain):
        return None
    first, last = ([int(x) for x in d.split("-")] for d in (plain[0], plain[-1]))
    end = last[2] if len(last) > 2 else calendar.monthrange(*last)[1]
    span = F.col(day).between(F.lit(date(*first[:2], first[2] if len(first) > 2 else 1)),
                              F.lit(date(*last[:2], end)))
    return span if len(plain) == len(days) else span | F.col(day).isNull()


def refresh_days(drop: DataFrame, base_dir: str, build: Callable[[DataFrame], DataFrame],
                 day: str = "data", unit: str = DAY) -> tuple[int, list[str]]:
    """Make ``drop`` the current base. Returns the version and the days built.
    With ``unit=MONTH`` months take the place of days throughout: for long
    histories of small days, whose files would be many and tiny."""
    spark = drop.sparkSession
    old = Wr.current_version(spark, base_dir)
    version = (old or 0) + 1
    before = _manifest(spark, base_dir, old).select(
        "dia", "versao", *[F.col(c).alias(f"_{c}") for c in ("linhas", "soma_a", "soma_b")])
    same = (F.col("linhas") == F.col("_linhas")) & (F.col("soma_a") == F.col("_soma_a")) \
        & (F.col("soma_b") == F.col("_soma_b"))
    manifest = (content_sums(drop, day, unit).join(before, "dia", "left")
                .withColumn("versao", F.when(same, F.col("versao")).otherwise(F.lit(version)).cast("int"))
                .select("dia", "versao", "linhas", "soma_a", "soma_b"))
    path = f"{base_dir}/manifesto/v{version:06d}"
    manifest.coalesce(1).write.mode("overwrite").parquet(path)
    changed = spark.read.schema(MANIFEST).parquet(path).where(F.col("versao") == version).select(
        F.col("dia").alias("_vx_dia"), F.greatest(F.lit(1), F.ceil(F.col("linhas") / TASK_ROWS)).alias("_vx_parts"),
        F.col("linhas").alias("_vx_n"))
    counts = [(r["_vx_dia"], r["_vx_n"]) for r in changed.orderBy("_vx_dia").collect()]
    days = [d for d, _ in counts]
    cut = runs(counts, slice_rows(spark))
    for i, run in enumerate(cut):
        with freed(spark):
            some, span = changed.drop("_vx_n"), None
            if len(cut) > 1:
                some = some.where(F.col("_vx_dia").between(run[0][0], run[-1][0]))
                span = _span(drop, day, [d for d, _ in run])
            some = broadcast_if_small(some)
            rows = drop if span is None else drop.filter(span)
            rows = rows.withColumn("_vx_dia", day_text(day, unit)).join(some, "_vx_dia", "left_semi")
            built = build(rows.drop("_vx_dia"))
            # dealt by hash into parts of bounded rows, whose number the manifest tells: no
            # bounds to be sampled, for which all rows would be built twice
            row = F.xxhash64(*[F.col(f"`{c}`") for c in built.columns])
            part = F.pmod(row, F.coalesce("_vx_parts", F.lit(1)))
            (built.withColumn("dia", day_text(day, unit)).join(some, F.col("dia") == F.col("_vx_dia"), "left")
             .withColumn("_vx_part", part).repartition("dia", "_vx_part").drop("_vx_dia", "_vx_parts", "_vx_part")
             .write.mode("append" if i else "overwrite").partitionBy("dia")
             .parquet(f"{base_dir}/dias/v{version:06d}"))
    Wr.publish(spark, base_dir, version)
    return version, days


def read_days(spark: SparkSession, base_dir: str, version: int | None = None) -> DataFrame:
    """The base as of a version (default: the current one)."""
    version = version or Wr.current_version(spark, base_dir)
    if version is None:
        raise FileNotFoundError(f"no version published under {base_dir}")
    places = _manifest(spark, base_dir, version).select("dia", "versao").collect()  # a row a day
    if not places:
        raise FileNotFoundError(f"version {version} of {base_dir} has no day")
    paths = sorted(f"{base_dir}/dias/v{r['versao']:06d}/dia={r['dia']}" for r in places)
    return spark.read.parquet(*paths)

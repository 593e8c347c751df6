"""Writers: managed/external tables, ZSTD Parquet, several destinations,
versioned full refresh."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.operators.slices import Slice
from vitrine.session import freed, row_tasks


def save_table(df: DataFrame, name: str, path: str | None = None, fmt: str = "parquet",
               replace_schema: bool = True) -> DataFrame:
    """Overwrite a table (schema replaced). With ``replace_schema=False`` the
    write is refused when the schema differs from the existing table."""
    spark = df.sparkSession
    if not replace_schema and spark.catalog.tableExists(name):
        old = spark.table(name).schema.simpleString()
        if old != df.schema.simpleString():
            raise ValueError(f"schema of {name} would change: {old} -> {df.schema.simpleString()}")
    writer = df.write.mode("overwrite").format(fmt)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return spark.table(name)


def write_parquet(df: DataFrame, path: str, codec: str = "zstd",
                  sort: Sequence[str] | None = None, partitions: int | None = None,
                  slices: Sequence[Slice] | None = None) -> None:
    """Parquet with a codec; optional sort as range partitions + a local sort
    (ordered files, no single-task global sort). Without ``partitions`` their
    number follows the size of the data. With several ``slices`` of the first sort
    column they are written one by one, so that one at a time lies in a shuffle."""
    spark = df.sparkSession
    many = list(slices or []) if sort and len(slices or []) > 1 else [None]
    for i, part in enumerate(many):
        with freed(spark):
            out = df
            if part is not None:
                out, partitions = part.of(df, sort[0]), row_tasks(spark, part.rows)
            if sort:
                keys = [F.col(c).asc_nulls_first() for c in sort]
                out = out.repartitionByRange(*([partitions] if partitions else []), *keys) \
                         .sortWithinPartitions(*sort)
            out.write.mode("append" if i else "overwrite").option("compression", codec).parquet(path)


def write_all(df: DataFrame, targets: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Write one result to several ``(name, format, path)`` destinations, then
    report the rows each holds. It is computed once: the first Parquet target is
    written first, and the others are copied from it."""
    spark = df.sparkSession
    source = df
    for _, fmt, path in sorted(targets, key=lambda t: t[1] != "parquet"):
        w = source.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True).option("sep", ";")
        w.save(path)
        if source is df and fmt == "parquet":
            source = spark.read.schema(df.schema).parquet(path)
    counts = None
    for name, fmt, path in targets:
        r = spark.read.format(fmt)
        if fmt == "csv":
            r = r.option("header", True).option("sep", ";")
        c = r.load(path).agg(F.count(F.lit(1)).alias("registros")).select(
            F.lit(name).alias("destino"), "registros")
        counts = c if counts is None else counts.unionByName(c)
    return counts


MARKERS = "_published"


def _folder(spark: SparkSession, path: str):
    """The file system and path object of a folder in any store Spark can write."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Version numbers that entries of a folder are named by; none if it is absent."""
    fs, p = _folder(spark, path)
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    return [int(n[1:]) for n in names if re.fullmatch(r"v\d{6,}", n)]


def version_path(base_dir: str, version: int) -> str:
    return f"{base_dir}/v{version:06d}"


def published_versions(spark: SparkSession, base_dir: str) -> list[int]:
    return sorted(_numbers(spark, f"{base_dir}/{MARKERS}"))


def current_version(spark: SparkSession, base_dir: str) -> int | None:
    """The highest published version; None before the first one. A store that
    cannot be listed is an error, not an empty base."""
    return max(_numbers(spark, f"{base_dir}/{MARKERS}"), default=None)


def publish(spark: SparkSession, base_dir: str, version: int) -> None:
    """Make a written version current: one new marker file, nothing overwritten."""
    fs, p = _folder(spark, f"{base_dir}/{MARKERS}/v{version:06d}")
    if not fs.exists(p):
        fs.create(p, False).close()


def refresh(df: DataFrame, base_dir: str, fmt: str = "parquet") -> int:
    """Versioned full refresh: write the new base beside the old ones, then
    publish it. Its number is above every folder there, published or not, so
    no version is ever written over."""
    spark = df.sparkSession
    new = max([*_numbers(spark, base_dir), *_numbers(spark, f"{base_dir}/{MARKERS}")], default=0) + 1
    df.write.format(fmt).save(version_path(base_dir, new))
    publish(spark, base_dir, new)
    return new


def read_current(spark: SparkSession, base_dir: str, fmt: str = "parquet") -> DataFrame:
    v = current_version(spark, base_dir)
    if v is None:
        raise FileNotFoundError(f"no version published under {base_dir}")
    return spark.read.format(fmt).load(version_path(base_dir, v))

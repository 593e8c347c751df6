"""Delimited text in and out (``;``-separated exports of the base)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType, TimestampType

from vitrine.session import TASK_ROWS

CORRUPT = "_corrupt_record"


def read_delimited(spark: SparkSession, path: str | list[str], schema: StructType, sep: str = ";",
                   header: bool = True) -> tuple[DataFrame, DataFrame]:
    """Typed read with quarantine: rows that do not fit ``schema`` (bad value,
    wrong field count) go to the second DataFrame with their raw text.

    Values are read as they are written: no quoting, so a title that starts
    with a quote stays a title. What makes a row bad shows only when all its
    columns are read, and a later query may read a few: both parts are filtered
    by a condition over all columns, so every scan parses whole rows and no
    parsed copy is kept. The files have to stay as they are while it is used."""
    full = StructType(list(schema.fields) + [StructField(CORRUPT, StringType(), True)])
    parsed = (spark.read.option("sep", sep).option("header", header)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("enforceSchema", True)  # header names may be decorated (Table[col])
              .option("quote", "").option("escape", "")
              .schema(full).csv(path))
    # true for every row; the optimizer cannot know, so no column is pruned
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in schema.fields]) >= F.lit(-2 ** 63)
    good = parsed.filter(F.col(CORRUPT).isNull() & whole).drop(CORRUPT)
    bad = parsed.filter(F.col(CORRUPT).isNotNull() & whole).select(CORRUPT)
    return good, bad


def export_columns(df: DataFrame, sep: str = ";") -> list:
    """Cells as text: dates ``yyyy-MM-dd``, separator -> ',', CR/LF -> space,
    NULL -> empty."""
    from vitrine.functions.formatting import sanitize_text
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(sanitize_text(c, sep).alias(f.name))
    return cols


def write_delimited(df: DataFrame, path: str, sep: str = ";",
                    header_template: str = "{col}") -> None:
    """Write a ``sep``-delimited export with a header line per part file.
    Values are written as they are (no quoting, no whitespace trimming). Files are
    gzip, which one task reads whole: their rows are bounded."""
    out = df.select(*export_columns(df, sep))
    out = out.toDF(*[header_template.format(col=c) for c in out.columns])
    (out.write.mode("overwrite").option("sep", sep).option("header", True)
     .option("compression", "gzip").option("maxRecordsPerFile", TASK_ROWS)
     .option("quote", "").option("escape", "").option("emptyValue", "").option("nullValue", "")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def read_lines(spark: SparkSession, path: str, header_line: str) -> DataFrame:
    """Data lines of a delimited export (header lines dropped)."""
    return spark.read.text(path).filter(F.col("value") != header_line).withColumnRenamed(
        "value", "linha")


_BRACKET = re.compile(r"\[(.*)\]")


def clean_header(df: DataFrame) -> DataFrame:
    """Export headers such as ``Table[col]`` become ``col``."""
    names = []
    for c in df.columns:
        m = _BRACKET.search(c)
        names.append(m.group(1) if m else c)
    return df.toDF(*names)

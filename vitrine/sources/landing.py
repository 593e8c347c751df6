"""Landing source with an ordered fallback and a provenance tag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from vitrine.constants import ORIGIN_TABLE_SNAPSHOT


class NoSourceError(RuntimeError):
    pass


def read_landing(spark: SparkSession, candidates: Sequence[tuple[str, str]],
                 fallback_table: str | None = None, fmt: str = "parquet") -> tuple[DataFrame, str]:
    """Read the first readable candidate ``(path, origin_tag)``; else the last
    saved table (tagged as a table snapshot); else fail.

    Only the file footer / schema is touched here; no data is read."""
    errors = []
    for path, origin in candidates:
        try:
            df = spark.read.format(fmt).load(path)
            df.schema  # resolves the files now, so a missing path falls through
            return df, origin
        except AnalysisException as e:
            errors.append(f"{path}: {e.getCondition() or type(e).__name__}")
    if fallback_table and spark.catalog.tableExists(fallback_table):
        return spark.table(fallback_table), ORIGIN_TABLE_SNAPSHOT
    raise NoSourceError("no landing data found; tried " + "; ".join(errors))

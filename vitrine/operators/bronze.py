"""Bronze: contract projection of the landing rows plus audit columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.constants import LANDING_COLUMNS, LANDING_TYPES


class MissingColumnsError(ValueError):
    pass


def select_contract(df: DataFrame, strict: bool = False) -> DataFrame:
    """Keep the 25 contract columns in contract order.

    strict: fail when a column is missing. lenient: a missing column becomes a
    typed NULL (so silver's casts still resolve) and is reported through
    :func:`missing_columns`; extra columns (``produto``) are dropped."""
    missing = missing_columns(df)
    if strict and missing:
        raise MissingColumnsError(f"landing file lacks columns: {missing}")
    return df.select(*[F.col(c) if c in df.columns
                       else F.lit(None).cast(LANDING_TYPES[c]).alias(c)
                       for c in LANDING_COLUMNS])


def missing_columns(df: DataFrame) -> list[str]:
    return [c for c in LANDING_COLUMNS if c not in df.columns]


def with_audit(df: DataFrame, origin: str) -> DataFrame:
    """``_data_ingestao`` (load time) and ``_arquivo_origem`` (provenance tag)."""
    return df.withColumns({"_data_ingestao": F.current_timestamp(),
                           "_arquivo_origem": F.lit(origin)})


def bronze(df: DataFrame, origin: str, strict: bool = False) -> DataFrame:
    return with_audit(select_contract(df, strict=strict), origin)

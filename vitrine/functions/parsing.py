"""Parsing of Brazilian-formatted landing values into typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money_br_raw(c: str | Column, trim: bool = True) -> Column:
    """``'1.500,00'`` -> 1500.0: drop every ``.``, turn ``,`` into ``.``.

    ``try_cast`` gives NULL for text that is not a number (``''``, ``abc``,
    ``R$ 10,00``) instead of failing the job under ANSI mode."""
    s = F.trim(_col(c)) if trim else _col(c)
    # character edits, no regex: delete every '.', then ',' -> '.'
    return F.translate(F.translate(s, ".", ""), ",", ".").try_cast("double")


def money_br(df: DataFrame, name: str) -> Column:
    """Money parser that is only applied to text columns.

    A numeric column is passed through as double: re-running the parser on an
    already-typed value (1500.5) would otherwise drop its decimal point."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, StringType):
        return money_br_raw(name)
    if isinstance(dtype, NumericType):
        return F.col(name).cast("double")
    return F.col(name).cast("string").try_cast("double")


def rating_br(df: DataFrame, name: str) -> Column:
    """``'4,8'`` -> 4.8; only the comma is replaced, so ``'4.8'`` stays 4.8."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, NumericType):
        return F.col(name).cast("double")
    return F.translate(F.trim(F.col(name).cast("string")), ",", ".").try_cast("double")


MONEY_TYPE = "decimal(28,2)"


def money_exact(c: str | Column) -> Column:
    """A double as an exact amount for sums. The type holds 26 digits before
    the point; anything beyond becomes NULL (``quality.parse_losses`` counts
    such values) instead of failing the aggregate."""
    return _col(c).try_cast(MONEY_TYPE)


def to_boolean(c: str | Column) -> Column:
    """0 -> false, any other number -> true, NULL and other text -> NULL."""
    return _col(c).try_cast("boolean")


def to_int(c: str | Column) -> Column:
    """Integer typing; malformed text becomes NULL instead of failing."""
    return _col(c).try_cast("int")

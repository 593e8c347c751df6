"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.session import ensure_checkpoint_dir

# Bytes a join side may have to be broadcast; measured, never guessed.
BROADCAST_BYTES = 32 * 1024 * 1024

# The ASCII separators between words: space and 0x09-0x0D.
SPACES = "\\x20\\x09-\\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/llm-{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage
    in a way that survives lost executors, and lets later steps read only the
    columns they need."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def value_bytes(value: Column, kind: T.DataType) -> Column:
    """Bytes of a value, nested fields, elements and entries included."""
    if isinstance(kind, T.StructType):
        parts = [value_bytes(value.getField(f.name), f.dataType) for f in kind.fields]
        return sum(parts, F.lit(16).cast("long"))
    if isinstance(kind, T.MapType):
        return (value_bytes(F.map_keys(value), T.ArrayType(kind.keyType))
                + value_bytes(F.map_values(value), T.ArrayType(kind.valueType)))
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.StringType, T.BinaryType, T.StructType, T.ArrayType, T.MapType)):
            total = F.aggregate(value, F.lit(16).cast("long"),
                                lambda acc, v: acc + value_bytes(v, kind.elementType))
        else:
            total = F.size(value).cast("long") * 16 + 16
        return F.coalesce(total, F.lit(16).cast("long"))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)).cast("long") + 16
    return F.lit(16).cast("long")


def small_side(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast hint for ``df`` if its measured size allows one; beyond that
    the join stays a shuffle join, whose hot keys AQE splits. ``df`` should be
    cheap to read twice (staged or aggregated)."""
    width = sum((value_bytes(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields),
                F.lit(0).cast("long"))
    size = df.agg(F.sum(width)).first()[0] or 0
    return F.broadcast(df) if size <= limit else df


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text; NULL gives no words."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\x0c\r"))
    return (F.when(inner == "", F.array().cast("array<string>"))
            .otherwise(F.split(inner, f"[{SPACES}]+")))


def free_name(df: DataFrame, stem: str, *more: str) -> str:
    """A column name that ``df`` (which may have any extra columns) lacks."""
    taken = {c.lower() for c in (*df.columns, *more)}
    name = f"_{stem}"
    while name.lower() in taken:
        name = f"_{name}"
    return name


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once for each row, where ``body``
    uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)

"""Ordered row numbers and dense surrogate keys without a single-task window.

``row_number() over (order by k)`` with no ``partitionBy`` moves every row to
one task. Here the rows are range-partitioned on (group, order) keys, so a hot
group (even a third of all rows) is spread over many tasks. The partitioned,
sorted rows are written once (``session.held``, so positions are stable if an executor
is lost and the lineage is replayed), then a small per-partition count table
gives each partition its offset inside each group:

    index = position inside partition - first position of the group there
            + rows of the same group in earlier partitions + 1

The count table holds at most (partitions + groups) rows; it is broadcast only
after its size has been checked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.session import ensure_checkpoint_dir, held

# Upper bounds for broadcasting a helper table: rows, and estimated bytes.
BROADCAST_ROW_LIMIT = 2_000_000
BROADCAST_BYTE_LIMIT = 64 * 1024 * 1024


def _row_width(dtype) -> int:
    from pyspark.sql import types as T
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return 32
    if isinstance(dtype, T.StructType):
        return sum(_row_width(f.dataType) for f in dtype.fields)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return 128
    return 8


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT,
             max_bytes: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether a count proves ``df`` small (rows, and rows x estimated row width)."""
    n = df.count()
    return n <= max_rows and n * _row_width(df.schema) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROW_LIMIT,
                       max_bytes: int = BROADCAST_BYTE_LIMIT) -> DataFrame:
    """Broadcast ``df`` only when a count proves it small (rows, and rows x
    estimated row width); otherwise leave the join to the planner (shuffle
    join; AQE may still switch to a broadcast from runtime sizes)."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def ordered_index(df: DataFrame, order: Sequence[Column], out: str,
                  by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Add ``out`` = 1-based row number inside ``by`` groups, ordered by
    ``order`` (give a total order for a deterministic result)."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    keys = [F.col(c).asc_nulls_first() for c in by] + list(order)
    # Without an explicit count AQE may coalesce neighbouring range partitions;
    # they stay contiguous and ordered, and the partition id / position are
    # read in the same task, so the offsets remain exact.
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    staged = held(ranged
                  .sortWithinPartitions(*keys)
                  .withColumn("_vx_pid", F.spark_partition_id())
                  .withColumn("_vx_pos", F.monotonically_increasing_id()))
    counts = (staged.groupBy("_vx_pid", *by)
              .agg(F.count(F.lit(1)).alias("_vx_n"), F.min("_vx_pos").alias("_vx_first")))
    w = Window.partitionBy(*by).orderBy("_vx_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held(counts.withColumn("_vx_off", F.coalesce(F.sum("_vx_n").over(w), F.lit(0)))
                   .drop("_vx_n"))
    small = broadcast_if_small(offsets)
    if by:
        # NULL group keys do not match in an equi-join; match them null-safely.
        cond = [staged["_vx_pid"] == small["_vx_pid"]] + [
            staged[c].eqNullSafe(small[c]) for c in by]
        joined = staged.join(small, on=cond, how="inner").drop(
            small["_vx_pid"], *[small[c] for c in by])
    else:
        joined = staged.join(small, on=["_vx_pid"], how="inner")
    return (joined.withColumn(out, (F.col("_vx_pos") - F.col("_vx_first")
                                    + F.col("_vx_off") + 1).cast("long"))
            .drop("_vx_pid", "_vx_pos", "_vx_first", "_vx_off"))


def dense_key(df: DataFrame, key_cols: Sequence[str], out: str,
              num_partitions: int | None = None) -> DataFrame:
    """Dense surrogate key 1..n over the distinct ``key_cols`` values, ordered
    by them (NULL first). Equal to ``row_number() over (order by keys)``."""
    distinct = df.select(*key_cols).distinct()
    return ordered_index(distinct, [F.col(c).asc_nulls_first() for c in key_cols], out,
                         num_partitions=num_partitions)

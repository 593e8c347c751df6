"""Surrogate keys that stay: an append-only key register.

``keys.dense_key`` numbers all names by their order, so a name that arrives
renumbers those after it and older facts point elsewhere. The register numbers
only names that it does not hold: a load takes the block that starts after the
highest key in use and numbers its new names inside it, in name order. Keys are
so dense over all loads, never change and are never used twice.

The register is a folder of published versions, one for each load with new names,
which holds those names alone. A load writes its block beside the others and
publishes it by one marker file: a load that fails before is not seen, and is
written anew by the next one. A load reads the register once (the anti-join
with its own names) and shuffles names, not facts.

One load runs at a time; of two that run together one fails at its marker or
folder and has to be run again. NULL is a name of its own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators.keys import ordered_index
from vitrine.sinks import writers as Wr


def read_register(spark: SparkSession, folder: str, schema: T.StructType) -> DataFrame:
    """All registered names with their key, and ``carga``, the load that brought them."""
    versions = Wr.published_versions(spark, folder)
    paths = [Wr.version_path(folder, v) for v in versions]
    if not paths:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*paths)


def register_keys(names: DataFrame, folder: str, key_cols: Sequence[str], out: str) -> DataFrame:
    """Give every new combination of ``key_cols`` a key, and return the register:
    ``out``, the names, ``carga``."""
    spark = names.sparkSession
    schema = T.StructType([T.StructField(out, T.LongType()), *[names.schema[c] for c in key_cols],
                           T.StructField("carga", T.IntegerType())])
    known = read_register(spark, folder, schema)
    held = known.select(*[F.col(c).alias(f"_vx_{c}") for c in key_cols])
    same = [F.col(c).eqNullSafe(F.col(f"_vx_{c}")) for c in key_cols]
    new = names.select(*key_cols).distinct().join(held, same, "left_anti")
    top = known.agg(F.max(out)).first()[0] or 0
    load = (Wr.current_version(spark, folder) or 0) + 1
    numbered = ordered_index(new, [F.col(c).asc_nulls_first() for c in key_cols], "_vx_n")
    block = numbered.select((F.col("_vx_n") + top).cast("long").alias(out), *key_cols,
                            F.lit(load).cast("int").alias("carga"))
    path = Wr.version_path(folder, load)
    block.write.mode("overwrite").parquet(path)  # not published: what lies there is a failed load's
    if not spark.read.schema(schema).parquet(path).isEmpty():
        Wr.publish(spark, folder, load)
    return read_register(spark, folder, schema)

"""The size check of broadcasts counts nested values."""
import pytest
from pyspark.sql import functions as F

from vitrine.llm.common import small_side


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("kind", [
    "struct<a:string>", "array<string>", "map<int,string>", "struct<a:array<struct<b:string>>>"])
def test_long_nested_values_refuse_a_broadcast(spark, kind):
    text = F.repeat(F.lit("x"), 1000)
    value = {"struct<a:string>": F.struct(text.alias("a")), "array<string>": F.array(text),
             "map<int,string>": F.create_map(F.lit(1), text),
             "struct<a:array<struct<b:string>>>": F.struct(F.array(F.struct(text.alias("b"))).alias("a"))}[kind]
    df = spark.range(100).select("id", value.cast(kind).alias("v"))
    assert not hinted(small_side(df, 100_000)) and hinted(small_side(df, 200_000))


def test_nulls_and_empty_tables_are_small(spark):
    df = spark.range(10).select(F.lit(None).cast("array<struct<a:string>>").alias("v"))
    assert hinted(small_side(df)) and hinted(small_side(df.limit(0)))

"""Sources and sinks: delimited quarantine, header clean-up, fallback, refresh."""
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from vitrine.constants import ORIGIN_EXISTING_FILE, ORIGIN_TABLE_SNAPSHOT
from vitrine.sinks import writers as Wr
from vitrine.sources import delimited as D
from vitrine.sources import landing as Ld


def test_delimited_quarantine(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text("a;b\n1;2\n3;x\n4;5;6\n7;8\n")
    schema = StructType([StructField("a", IntegerType()), StructField("b", IntegerType())])
    good, bad = D.read_delimited(spark, str(p), schema)
    assert sorted(tuple(r) for r in good.collect()) == [(1, 2), (7, 8)]
    assert bad.count() == 2


def test_export_and_clean_header(spark, tmp_path):
    df = spark.createDataFrame([(1, " a;b ", None)], "x int, s string, n string")
    out = str(tmp_path / "exp")
    D.write_delimited(df, out, header_template="T[{col}]")
    lines = [r[0] for r in spark.read.text(out).collect()]
    assert "T[x];T[s];T[n]" in lines and "1; a,b ;" in lines
    back = D.clean_header(spark.read.option("header", True).option("sep", ";").csv(out))
    assert back.columns == ["x", "s", "n"]


def test_fallback_order(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.range(3).write.parquet(good)
    df, origin = Ld.read_landing(spark, [(str(tmp_path / "missing"), "fresh"),
                                         (good, ORIGIN_EXISTING_FILE)])
    assert origin == ORIGIN_EXISTING_FILE and df.count() == 3
    spark.range(2).write.mode("overwrite").saveAsTable("vitrine_fallback_t")
    df, origin = Ld.read_landing(spark, [(str(tmp_path / "missing"), "fresh")],
                                 fallback_table="vitrine_fallback_t")
    assert origin == ORIGIN_TABLE_SNAPSHOT and df.count() == 2
    with pytest.raises(Ld.NoSourceError):
        Ld.read_landing(spark, [(str(tmp_path / "missing"), "fresh")])


def test_versioned_refresh_keeps_old_version(spark, tmp_path):
    base = str(tmp_path / "base")
    assert Wr.refresh(spark.range(5), base) == 1
    assert Wr.refresh(spark.range(7), base) == 2
    assert Wr.read_current(spark, base).count() == 7
    assert spark.read.parquet(Wr.version_path(base, 1)).count() == 5


def test_zstd_codec(spark, tmp_path):
    import pyarrow.parquet as pq
    out = str(tmp_path / "z")
    Wr.write_parquet(spark.range(100).withColumn("d", F.col("id") % 7), out, sort=["d"])
    f = next(p for p in (tmp_path / "z").iterdir() if p.suffix == ".parquet")
    assert pq.ParquetFile(str(f)).metadata.row_group(0).column(0).compression == "ZSTD"


def test_schema_guard(spark, tmp_path):
    spark.range(2).write.mode("overwrite").saveAsTable("vitrine_guard_t")
    with pytest.raises(ValueError):
        Wr.save_table(spark.range(2).withColumn("x", F.lit(1)), "vitrine_guard_t",
                      replace_schema=False)

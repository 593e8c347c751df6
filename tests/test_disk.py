"""Disk that a query takes: passes over ranges of days, shuffle files that go with their
statement, and smaller files. Results are those of one pass."""
import datetime as dt
import os
import time

import pytest
from pyspark.sql import functions as F

from vitrine import session
from vitrine.operators import drilldown as Dr
from vitrine.operators import silver as S
from vitrine.operators.keys import ordered_index
from vitrine.operators.slices import Slice, day_slices, runs
from vitrine.plans.lakehouse import Lakehouse
from vitrine.sinks import incremental as Inc
from vitrine.sinks import writers as Wr
from vitrine.sources import delimited as D

SMALL = "/root/testdata/sf0.001"
D0 = dt.date(2024, 1, 30)
SCHEMA = "data date, id int, v int"


def _rows(spark, n=240):
    days = [None, *(D0 + dt.timedelta(days=i) for i in range(11))]
    return spark.createDataFrame([(days[i % 12], i, i % 7) for i in range(n)], SCHEMA)


def _bag(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def test_slices_hold_every_row_once(spark):
    df = _rows(spark)
    cut = day_slices(df, 50)
    assert len(cut) > 2 and sum(s.rows for s in cut) == df.count()
    assert [s.of(df).count() for s in cut] == [s.rows for s in cut]
    assert sorted(r.id for s in cut for r in s.of(df).collect()) == [*range(240)]
    assert day_slices(df, 1000) == [Slice(None, None, 240)]
    nulls = df.filter("data IS NULL")
    assert [s.of(nulls).count() for s in day_slices(nulls, 1)] == [nulls.count()]
    assert [s.of(df).count() for s in day_slices(df.limit(0), 1)] == [240]


def test_a_day_is_not_cut():
    assert runs([("a", 9), ("b", 1), ("c", 1), ("d", 5)], 5) == [[("a", 9)], [("b", 1), ("c", 1)], [("d", 5)]]


def test_layers_of_several_passes_are_those_of_one(spark, tmp_path, monkeypatch):
    names = ["landing", "silver", "dim_product", "fact", "analytic"]
    one = Lakehouse(spark, SMALL, root=str(tmp_path / "one"))
    want = {n: _bag(getattr(one, n)(), "_data_processamento") for n in names}
    monkeypatch.setattr(session, "SLICE_ROWS", 500)
    L = Lakehouse(spark, SMALL, root=str(tmp_path / "many"))
    assert len(L.slices()) > 2 and len(one.slices()) == 1
    assert {n: _bag(getattr(L, n)(), "_data_processamento") for n in names} == want
    assert L.silver().select("_data_processamento").distinct().count() == 1
    assert L.silver().schema == one.silver().schema


def test_layers_of_a_given_landing_in_several_passes(spark, tmp_path, monkeypatch):
    landing = Lakehouse(spark, SMALL, root=str(tmp_path / "l")).landing()
    landing = landing.withColumn("data", F.when(F.col("posicao_ranking") > 2, F.col("data"))).unionByName(landing)
    one = Lakehouse(spark, "x", root=str(tmp_path / "one"), landing_builder=lambda: landing)
    want = _bag(one.silver(), "_data_processamento"), _bag(one.analytic())
    monkeypatch.setattr(session, "SLICE_ROWS", 500)
    L = Lakehouse(spark, "x", root=str(tmp_path / "many"), landing_builder=lambda: landing)
    assert (_bag(L.silver(), "_data_processamento"), _bag(L.analytic())) == want
    assert len(L.slices()) > 2


def _shuffle_files(spark) -> set[str]:
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in disk.localDirs() for _, _, fs in os.walk(d.toString()) for f in fs if f.startswith("shuffle_")}


def test_a_layer_leaves_no_shuffle_files_and_nothing_held(spark, tmp_path):
    L = Lakehouse(spark, SMALL, root=str(tmp_path / "layers"))
    before = _shuffle_files(spark)
    L.dim_product()
    for _ in range(50):
        if not (left := _shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left
    held = f"{session.work_root(spark)}/held"
    assert not os.path.exists(held) or not os.listdir(held)
    assert spark.conf.get(session._FREE) == "false"


def test_held_rows_are_checkpointed_where_nobody_frees_them(spark):
    df = spark.range(9).select("id", (F.col("id") % 2).alias("g"))
    kept = ordered_index(df, [F.col("id").desc()], "ix", by=["g"])
    with session.freed(spark):
        out = _bag(ordered_index(df, [F.col("id").desc()], "ix", by=["g"]))
    assert _bag(kept) == out


def test_layers_are_written_with_zstd(spark, tmp_path):
    old = spark.conf.get(session._CODEC)
    try:
        spark.conf.set(session._CODEC, "snappy")
        L = Lakehouse(spark, SMALL, root=str(tmp_path / "layers"))
        L._materialize("x", lambda: spark.range(5))
        assert all(".zstd." in f for f in os.listdir(tmp_path / "layers" / "x") if f.endswith("parquet"))
        spark.conf.set(session._CODEC, "gzip")  # a choice stays
        session.bound_tasks(spark)
        assert spark.conf.get(session._CODEC) == "gzip"
    finally:
        spark.conf.set(session._CODEC, old)


def test_export_is_compressed_in_files_of_bounded_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(D, "TASK_ROWS", 100)
    df = _rows(spark).coalesce(1)
    D.write_delimited(df, str(tmp_path / "x"))
    files = [f for f in os.listdir(tmp_path / "x") if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    good, bad = D.read_delimited(spark, str(tmp_path / "x"), df.schema)
    assert _bag(good) == _bag(df) and bad.count() == 0
    assert D.read_lines(spark, str(tmp_path / "x"), "data;id;v").count() == 240


def test_sorted_parquet_in_several_passes(spark, tmp_path):
    df, out = _rows(spark), str(tmp_path / "x")
    Wr.write_parquet(df, out, sort=["data", "id"], slices=day_slices(df, 50))
    assert _bag(spark.read.parquet(out)) == _bag(df)
    spans = []
    for f in os.listdir(out):
        if f.endswith(".parquet"):
            days = [str(r.data or "") for r in spark.read.parquet(f"{out}/{f}").collect()]
            assert days == sorted(days)
            spans += [(days[0], days[-1])] if days else []
    assert all(a[1] <= b[0] for a, b in zip(sorted(spans), sorted(spans)[1:]))


@pytest.mark.parametrize("unit", [Inc.DAY, Inc.MONTH])
def test_days_built_in_runs(spark, tmp_path, monkeypatch, unit):
    df = _rows(spark)
    build = lambda rows: S.dedup_first(rows, ["data", "v"], [F.col("id").asc()])
    Inc.refresh_days(df, str(tmp_path / "one"), build, unit=unit)
    monkeypatch.setattr(Inc, "slice_rows", lambda spark: 45)
    _, days = Inc.refresh_days(df, str(tmp_path / "runs"), build, unit=unit)
    assert len(days) == (12 if unit == Inc.DAY else 3)
    assert _bag(Inc.read_days(spark, str(tmp_path / "runs"))) == _bag(Inc.read_days(spark, str(tmp_path / "one")))


def test_only_differing_parts_of_a_branch_are_shuffled(spark, monkeypatch):
    """Every day differs, in one of its 300 items."""
    a = spark.range(3000).select(F.lit("m").alias("mes"), (F.col("id") % 10).alias("dia"),
                                 (F.col("id") / 10).cast("int").cast("string").alias("item"), F.col("id").alias("v"))
    b = a.withColumn("v", F.when(F.col("item") == "7", F.lit(None)).otherwise(F.col("v")))
    found = Dr.divergences(a, b, ["mes", "dia", "item"], {"v": (F.col("v"),) * 2})
    assert "_parte" in found._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r.dia, r.item, r.registros_a, r.registros_b, r.v_a, r.v_b) for r in found.collect())
    assert got == [(d, "7", 1, 1, 70 + d, None) for d in range(10)]
    monkeypatch.setattr(Dr, "is_small", lambda df: False)  # too many parts: all rows are compared
    assert sorted((r.dia, r.item, r.registros_a, r.registros_b, r.v_a, r.v_b) for r in Dr.divergences(
        a, b, ["mes", "dia", "item"], {"v": (F.col("v"),) * 2}).collect()) == got

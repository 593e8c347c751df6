"""Bounds of what a task reads and sorts, and rows that are not moved."""
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from vitrine import session
from vitrine.operators import drilldown as Dr
from vitrine.operators import silver as S
from vitrine.sinks import writers as Wr

FILES, ADVISORY, INITIAL = session._FILES, session._ADVISORY, session._INITIAL


@pytest.fixture
def plain_conf(spark):
    """Spark's own settings for the test, the session's again after it."""
    old = {k: spark.conf.get(k, None) for k in (FILES, ADVISORY, INITIAL)}
    spark.conf.set(FILES, "128MB")
    spark.conf.set(ADVISORY, "64m")
    spark.conf.unset(INITIAL)
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_task_bounds_follow_the_rows(spark, plain_conf):
    session.bound_tasks(spark)
    assert int(spark.conf.get(FILES)) == session.TASK_FILE_BYTES
    assert int(spark.conf.get(ADVISORY)) == session.TASK_SHUFFLE_BYTES
    assert spark.conf.get(INITIAL, None) is None
    session.bound_tasks(spark, 40 * session.TASK_ROWS)
    assert spark.conf.get(INITIAL) == "40"
    assert "hashpartitioning(k" in (p := plan(spark.range(9).withColumn("k", F.col("id") % 3).groupBy("k").count()))
    assert ", 40)" in p
    session.bound_tasks(spark, session.TASK_ROWS)  # a smaller input lowers nothing
    assert spark.conf.get(INITIAL) == "40"


def test_tighter_settings_stay(spark, plain_conf):
    spark.conf.set(FILES, "1m")
    spark.conf.set(ADVISORY, "16k")
    spark.conf.set(INITIAL, "77")
    session.bound_tasks(spark, session.TASK_ROWS)
    assert [spark.conf.get(k) for k in (FILES, ADVISORY, INITIAL)] == ["1m", "16k", "77"]


def test_a_lakehouse_bounds_its_tasks(spark, plain_conf, tmp_path):
    from vitrine.plans.lakehouse import Lakehouse
    Lakehouse(spark, str(tmp_path), root=str(tmp_path / "layers"))
    assert int(spark.conf.get(FILES)) <= session.TASK_FILE_BYTES


def test_written_layers_are_sorted_in_tasks_of_bounded_rows(spark, plain_conf, tmp_path, monkeypatch):
    """However few bytes the rows take in the shuffle."""
    from vitrine.plans.lakehouse import Lakehouse
    L = Lakehouse(spark, str(tmp_path), root=str(tmp_path / "layers"))
    L._rows = 30 * session.TASK_ROWS
    rows = spark.range(3000).select((F.col("id") % 9).alias("d"), "id")
    L._materialize("x", lambda: rows, range_on=["d", "id"])
    assert len([f for f in os.listdir(tmp_path / "layers" / "x") if f.endswith(".parquet")]) == 30
    assert session.row_tasks(spark, 0) == session.parallelism(spark)


def test_sorted_parquet_gets_tasks_by_its_size(spark, plain_conf, tmp_path):
    spark.conf.set(INITIAL, "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spark.conf.set(ADVISORY, "1k")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1k")
    try:
        rows = spark.range(20000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("t"))
        Wr.write_parquet(rows, str(tmp_path / "z"), sort=["id"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.minPartitionSize")
    files = [f for f in os.listdir(tmp_path / "z") if f.endswith(".parquet")]
    assert len(files) > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert spark.read.parquet(str(tmp_path / "z")).count() == 20000


DAY = dt.date(2024, 1, 1)


def _rows(spark):
    rows = [(DAY, f"i{n}", n) for n in range(50)] + [(DAY, "i7", -1), (None, None, 3), (None, None, 2), (DAY, None, 5)]
    return spark.createDataFrame(rows, "data date, id string, v int")


def test_dedup_shuffles_only_rows_of_repeated_keys(spark):
    out = S.dedup_first(_rows(spark), ["data", "id"], [F.col("v").asc()])
    got = {(r.data, r.id): r.v for r in out.collect()}
    want = {(DAY, f"i{n}"): n for n in range(50)} | {(DAY, "i7"): -1, (None, None): 2, (DAY, None): 5}
    assert got == want and out.count() == len(want)
    # the rows of single keys are joined to a broadcast and meet no exchange
    single = plan(out).split("LeftAnti")[1].split("Window")[0]
    assert "BroadcastExchange" in single and "Exchange hashpartitioning" not in single


def test_dedup_of_many_repeated_keys(spark, monkeypatch):
    monkeypatch.setattr(S, "REPEATED_KEYS", 1)  # too many to be broadcast: all rows are compared
    out = S.dedup_first(_rows(spark), ["data", "id"], [F.col("v").asc()])
    assert "LeftAnti" not in plan(out)
    assert {r.v for r in out.collect()} == {*range(50), -1} - {7} and out.count() == 52


def test_opened_keys_are_broadcast(spark):
    a = _rows(spark).withColumn("m", F.lit(1))
    b = a.where("v <> 5 OR id IS NOT NULL")
    found = Dr.divergences(a, b, ["m", "data", "id"], {"v": (F.col("v").cast("long"),) * 2})
    p = plan(found)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert [(r.data, r.id, r.v_a, r.v_b) for r in found.collect()] == [(DAY, None, 5, None)]


def test_without_joined_neighbours_the_partitions_follow_the_rows(spark, plain_conf):
    joined, partitions = session._ADAPTIVE[1], session._PARTITIONS
    old = {k: spark.conf.get(k) for k in (joined, partitions)}
    try:
        spark.conf.set(joined, "false")
        session.bound_tasks(spark, 40 * session.TASK_ROWS)
        assert spark.conf.get(partitions) == "40" and spark.conf.get(INITIAL, None) is None
        session.bound_tasks(spark, session.TASK_ROWS)
        assert spark.conf.get(partitions) == "40"
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_changed_settings_are_bounded_again(spark, plain_conf, tmp_path):
    """Layers are kept for the application, settings may be set anew between two queries."""
    from vitrine.plans.lakehouse import lakehouse
    L = lakehouse(spark, str(tmp_path))
    L._rows = 40 * session.TASK_ROWS
    spark.conf.set(FILES, "128MB")
    spark.conf.unset(INITIAL)
    assert lakehouse(spark, str(tmp_path)) is L
    assert int(spark.conf.get(FILES)) == session.TASK_FILE_BYTES and spark.conf.get(INITIAL) == "40"


def test_a_task_sorts_little(spark):
    """Rows of the base have some 18 bytes in files and 450 in a sort."""
    assert session.TASK_ROWS * 450 <= 100 << 20

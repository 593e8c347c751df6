"""Late, replayed and interrupted deliveries: no update is lost, each has one reply."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from vitrine.operators import taxonomy as T
from vitrine.operators.routing import Router
from vitrine.plans.catalog import lh
from vitrine.sources import updates as U
from vitrine.sources.dictionary import fixed_glossary
from vitrine.streaming import jobs as J


@pytest.fixture(scope="module")
def base(spark):
    L, r = lh(spark, SMOKE), lh(spark, SMOKE).reference()
    router = Router(L.lexicon(), fixed_glossary(spark), L.categories(), L.dim_category(), r.last_date)
    return J.Base(1, L.analytic(), r.last_date, r.rows, router, T.taxonomy_flat(L.silver()), L.range_index())


def feed(spark):
    rows = U.updates_from_conversations(lh(spark, SMOKE).raw("conversations"))
    return rows.where("message.text IS NOT NULL").orderBy("update_id").limit(20).persist()


def ids(df, name="q_id"):
    return sorted(r[0] for r in df.select(name).collect())


def test_late_updates_are_routed_and_replied_to_once(spark, tmp_path, base):
    first = feed(spark)
    late = (first.withColumn("update_id", -F.col("update_id") - 1)
            .withColumn("ts", F.col("ts") - F.expr("INTERVAL 3 HOURS")))
    out = str(tmp_path / "out")
    for name, drop in (("a", first), ("b", late.unionByName(first))):
        drop.write.json(f"{tmp_path}/in/{name}")
        J.route_stream(spark, f"{tmp_path}/in/*", out, f"{tmp_path}/ckpt", base)
    want = ids(U.parse_updates(first.unionByName(late)), "update_id")
    assert ids(J.read_routed(spark, out)) == want and len(want) > 10
    got = J.read_committed(spark, out, "replies")
    assert ids(got) == want and got.where("resposta = '' OR resposta IS NULL").isEmpty()


def test_failed_batch_and_new_checkpoint(spark, tmp_path, base, monkeypatch):
    first, out = feed(spark), str(tmp_path / "out")
    first.write.json(f"{tmp_path}/in/a")
    run = lambda ckpt: J.route_stream(spark, f"{tmp_path}/in/*", out, f"{tmp_path}/{ckpt}", base)
    real, calls = J.every_reply, []

    def broken(*args):
        calls.append(args)
        raise RuntimeError("lost between route and reply")

    monkeypatch.setattr(J, "every_reply", broken)
    with pytest.raises(Exception, match="lost between route and reply"):
        run("one")
    assert calls and J.committed(spark, out) == []  # routed, yet not visible
    monkeypatch.setattr(J, "every_reply", real)
    run("one")
    want = ids(U.parse_updates(first), "update_id")
    assert ids(J.read_committed(spark, out, "replies")) == ids(J.read_routed(spark, out)) == want
    run("two")  # a new stream reads the whole feed again
    more = first.withColumn("update_id", F.col("update_id") + 1_000_000_007)
    more.write.json(f"{tmp_path}/in/b")
    run("two")
    run("one")  # and the old one sees what the other answered as new: same folder, two streams
    streams = {s for s, _, _ in J.committed(spark, out)}
    replies = J.read_committed(spark, out, "replies")
    assert len(streams) == 2
    assert set(ids(replies)) == {*want, *ids(U.parse_updates(more), "update_id")}
    assert [i for i in ids(replies) if i in want] == want


def test_a_new_drop_is_answered_from_while_the_loop_runs(spark, tmp_path):
    from vitrine.plans.catalog import REGISTRY
    L = lh(spark, SMOKE)
    landing = L.landing()
    last = L.reference(raw=True).last_date
    live = J.LiveBase(spark, f"{tmp_path}/base")
    rows = [r.asDict(recursive=True) for r in feed(spark).collect()]
    for n, (drop, text) in enumerate([(landing.filter(F.col("data") < F.lit(last)), "qual o total no ytd"),
                                      (landing, "qual o total no ytd"), (None, "qual o total no ytd")], 1):
        if drop is not None:
            drop.write.parquet(f"{tmp_path}/drops/drop_{n:04d}")
            J.refresh_stream(spark, f"{tmp_path}/drops/*", f"{tmp_path}/base", f"{tmp_path}/profile",
                             f"{tmp_path}/base_ckpt", landing.schema)
        for r in rows[:3]:
            r["update_id"] += 1 << 50
            r["message"]["text"] = text
        spark.createDataFrame(rows[:3], U.UPDATE_SCHEMA).write.json(f"{tmp_path}/in/{n}")
        J.route_stream(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/ckpt", live)
    got = J.read_committed(spark, f"{tmp_path}/out", "replies").collect()
    dates = {v: {r.data_ref for r in got if r.versao == v} for v in (1, 2)}
    assert [len([r for r in got if r.versao == v]) for v in (1, 2)] == [3, 6] and live.built == 2
    assert dates[2] == {last} and max(dates[1]) < last
    assert all(str(r.data_ref) in r.resposta for r in got)
    assert "stream_live_base" in REGISTRY


def test_late_events_are_kept(spark, tmp_path):
    rows = [(1, "2024-01-01 10:00:00"), (2, "2024-01-01 10:01:00")]
    for name, drop in (("a", rows), ("b", rows + [(3, "2024-01-01 06:00:00"), (None, None)]),
                       ("c", [(4, "2023-01-01 06:00:00"), (None, None)])):
        df = spark.createDataFrame(drop, "event_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        df.write.parquet(f"{tmp_path}/in/{name}")
        J.dedup_stream(spark, f"{tmp_path}/in/*", f"{tmp_path}/out", f"{tmp_path}/ckpt", df.schema)
    got = [r.event_id for r in J.read_committed(spark, f"{tmp_path}/out", "rows").collect()]
    assert sorted(got, key=lambda i: i or 0) == [None, 1, 2, 3, 4]


def test_a_batch_does_not_read_what_earlier_ones_wrote(spark, tmp_path):
    """After 100 batches the output is out of reach; a replay is still known."""
    schema = "event_id long, v string"
    spark.range(300).selectExpr("id AS event_id", "'x' AS v").repartition(100).write.parquet(f"{tmp_path}/in/a")
    opened = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    J._once(spark, opened, "event_id", f"{tmp_path}/out", f"{tmp_path}/ckpt", state_partitions=2)
    assert len(J.committed(spark, f"{tmp_path}/out")) >= 100
    assert ids(J.read_committed(spark, f"{tmp_path}/out", "rows"), "event_id") == list(range(300))
    spark.range(200, 320).selectExpr("id AS event_id", "'x' AS v").write.parquet(f"{tmp_path}/in/b")
    J._once(spark, opened, "event_id", f"{tmp_path}/elsewhere", f"{tmp_path}/ckpt", state_partitions=2)
    assert ids(J.read_committed(spark, f"{tmp_path}/elsewhere", "rows"), "event_id") == list(range(300, 320))

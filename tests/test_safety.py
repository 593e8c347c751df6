"""Values that once failed a job or made a result depend on the row order."""
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from vitrine.functions.parsing import to_boolean
from vitrine.operators import compare as C
from vitrine.operators import metrics as M
from vitrine.operators import quality as Q
from vitrine.operators import silver as S
from vitrine.operators.periods import resolve
from vitrine.plans.lakehouse import lakehouse
from vitrine.sources.delimited import read_delimited


def test_huge_amount_does_not_fail_the_sums(spark):
    df = lakehouse(spark, SMOKE).analytic()
    big = df.limit(1).withColumn("fat_num", F.lit(1e20)).unionByName(
        df.limit(1).withColumn("fat_num", F.lit(1e40)))
    ref = df.agg(F.max("data")).first()[0]
    one = df.unionByName(big.withColumn("data", F.lit(ref)))
    assert M.totals(one, resolve("today", ref)).first().faturamento_total > 1e19
    assert C.yoy(one).count() > 0


def test_losses_are_counted(spark):
    bronze = lakehouse(spark, SMOKE).bronze().limit(3)
    bad = bronze.withColumn("preco_atual", F.lit("abc")).withColumn(
        "faturamento_estimado_dia", F.lit("9" * 40)).withColumn("is_full", F.lit("sim"))
    got = {r.coluna: (r.invalidos, r.fora_da_faixa) for r in Q.parse_losses(bad).collect()}
    assert got["preco_atual"] == (3, 0) and got["faturamento_estimado_dia"] == (0, 3)
    assert got["is_full"] == (3, 0) and got["preco_original"] == (0, 0)


def test_boolean_text_is_null_not_an_error(spark):
    df = spark.createDataFrame([("sim",), ("1",), (None,)], "b string")
    assert [r[0] for r in df.select(to_boolean("b")).collect()] == [None, True, None]


def test_dedup_survivor_does_not_depend_on_row_order(spark):
    row = S.typed(lakehouse(spark, SMOKE).bronze().drop("_data_ingestao", "_arquivo_origem")).limit(1)
    a, b = row.withColumn("categoria", F.lit("A")), row.withColumn("categoria", F.lit("B"))
    keep = [S.dedup_first(x.coalesce(1), S.DEDUP_KEYS, S.dedup_order()).first().categoria
            for x in (a.unionByName(b), b.unionByName(a))]
    assert keep == ["A", "A"]


def test_a_title_that_starts_with_a_quote_is_read(spark, tmp_path):
    p = tmp_path / "in.csv"
    p.write_text('a;t\n1;"abc\n2;x\n')
    good, bad = read_delimited(spark, str(p), spark.createDataFrame([], "a int, t string").schema)
    assert sorted(tuple(r) for r in good.collect()) == [(1, '"abc'), (2, "x")] and bad.count() == 0


def test_single_day_reads_one_month_and_comparisons_scan_once(spark):
    L = lakehouse(spark, SMOKE)
    table = L.analytic(with_partition=True)
    day = L.reference().last_date
    plan = M.totals(table, resolve("today", day))._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.split("\n") if "FileScan" in x)
    assert "PartitionFilters: []" not in scan and "_mes_data" in scan.split("PartitionFilters")[1]
    for fn in (C.mom_same_month_ly, C.yoy, C.month_offset, C.last_year):
        plan = fn(L.analytic())._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan") == 1 and "Join" not in plan


def test_checkpoint_folder_must_be_named_on_a_cluster(monkeypatch):
    from vitrine import session

    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "spark://host:7077"}.get(key, default)

    class Context:
        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())


def test_a_lost_marker_folder_never_reuses_a_version(spark, tmp_path):
    from vitrine.sinks import writers as W
    base = str(tmp_path / "base")
    assert W.current_version(spark, base) is None
    assert [W.refresh(spark.range(n), base) for n in (1, 2, 3)] == [1, 2, 3]
    (tmp_path / "base" / W.MARKERS).rename(tmp_path / "elsewhere")
    assert W.refresh(spark.range(4), base) == 4 and W.read_current(spark, base).count() == 4
    assert spark.read.parquet(W.version_path(base, 1)).count() == 1


def test_an_unfinished_drop_is_not_published(spark, tmp_path):
    from vitrine.sinks import writers as W
    from vitrine.streaming.jobs import publish_newest
    landing = lakehouse(spark, SMOKE).landing()
    base, prof = str(tmp_path / "base"), str(tmp_path / "prof")
    landing.limit(5).write.parquet(str(tmp_path / "in" / "drop_0007"))
    landing.limit(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        str(tmp_path / "in" / "drop_0008"))
    where = str(tmp_path / "in" / "*")
    assert publish_newest(spark, where, base, prof, landing.schema) == 7
    assert publish_newest(spark, where, base, prof, landing.schema) is None
    (tmp_path / "in" / "drop_0008" / "_SUCCESS").touch()
    assert publish_newest(spark, where, base, prof, landing.schema) == 8
    assert W.read_current(spark, base).count() == 9

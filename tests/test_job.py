"""The end-to-end job on a landing file (here: one written from the smoke tables)."""
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from vitrine.job import answer, run_etl
from vitrine.plans.lakehouse import lakehouse


def test_run_etl_and_answer(spark, tmp_path):
    landing = str(tmp_path / "Fato_MaisVendidos.parquet")
    lakehouse(spark, SMOKE).landing().write.parquet(landing)
    lh, audits = run_etl(spark, [str(tmp_path / "missing.parquet"), landing],
                         out=str(tmp_path / "lake"))
    assert {r["status"] for r in audits["gold_reconcile"].collect()} == {"OK"}
    counts = {r["tabela"]: r["registros"] for r in audits["gold_row_counts"].collect()}
    assert counts["ouro_fato_vendas"] == lh.silver().count()
    assert lh.bronze().select("_arquivo_origem").distinct().count() == 1
    qs = spark.createDataFrame([(1, "Ana", "qual o faturamento total de hoje?"),
                                (2, "Ana", "ranking por categoria no mtd")],
                               "q_id long, user_name string, text string")
    routed, rows, replies = answer(lh, qs)
    got = {r["q_id"]: r["intent"] for r in routed.collect()}
    assert got == {1: "total", 2: "ranking_categorias"}
    texts = {r["q_id"]: r["resposta"] for r in replies.collect()}
    assert "Faturamento Total" in texts[1] and "Atualizado até" in texts[2]


def test_cli_prints_audits(spark, tmp_path):
    """``python -m vitrine.job`` end to end in its own process."""
    import os
    import subprocess
    import sys
    landing = str(tmp_path / "landing.parquet")
    lakehouse(spark, SMOKE).landing().write.parquet(landing)
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_CPUS="2", PYTHONPATH=repo)
    out = subprocess.run([sys.executable, "-m", "vitrine.job", "--landing", landing,
                          "--out", str(tmp_path / "lake")], cwd=repo, env=env,
                         capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "== gold_reconcile" in out.stdout and "ERRO" not in out.stdout
    assert "== gold_audit" in out.stdout

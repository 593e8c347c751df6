"""End-to-end jobs on a real landing file.

    python -m vitrine.job --landing <parquet> [--landing <older parquet>] \
        [--fallback-table <table>] [--out <folder>] [--questions <parquet>]

``run_etl`` reads the first readable landing candidate (or the last saved
table), writes bronze, silver, the star schema and the answer table under
``out`` (default: the shared checkpoint folder), and returns the layers plus
the audit tables the source prints (period audit, silver totals, silver vs
gold reconciliation, gold audit, row counts). ``answer`` routes a table of
questions (q_id, user_name, text) and renders the replies.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from vitrine.constants import ORIGIN_EXISTING_FILE
from vitrine.operators import quality as Q
from vitrine.operators.answers import answer_questions, every_reply
from vitrine.operators.routing import Router
from vitrine.operators.taxonomy import taxonomy_flat
from vitrine.plans.lakehouse import Lakehouse
from vitrine.sources.dictionary import fixed_glossary
from vitrine.sources.landing import read_landing


def run_etl(spark: SparkSession, landing_paths: Sequence[str], out: str | None = None,
            fallback_table: str | None = None) -> tuple[Lakehouse, dict[str, DataFrame]]:
    candidates = [(p, ORIGIN_EXISTING_FILE) for p in landing_paths]
    landing, origin = read_landing(spark, candidates, fallback_table)
    lh = Lakehouse(spark, landing_paths[0] if landing_paths else "landing", root=out,
                   landing_builder=lambda: landing, origin=origin)
    silver, fact = lh.silver(), lh.fact()
    audits = {
        "bronze_period_audit": Q.period_audit(lh.bronze()),
        "silver_totals": Q.silver_totals(silver),
        "silver_null_counts": Q.null_counts(silver),
        "gold_reconcile": Q.reconcile(silver, fact),
        "gold_audit": Q.gold_audit(fact),
        "gold_row_counts": Q.row_counts({"ouro_dim_calendario": lh.dim_calendar(),
                                         "ouro_dim_categoria": lh.dim_category(),
                                         "ouro_dim_produto": lh.dim_product(),
                                         "ouro_fato_vendas": fact}),
    }
    lh.analytic()
    return lh, audits


def answer(lh: Lakehouse, questions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(routed, answer rows, replies) for a question table; every question has a reply."""
    ref = lh.reference()
    router = Router(lh.lexicon(), fixed_glossary(lh.spark), lh.categories(), lh.dim_category(),
                    ref.last_date)
    # routed once to the shared checkpoint folder: later steps read it several
    # times, and routing + answering fused into one stage is too large to compile
    routed = router.route(questions).checkpoint(eager=True)
    rows = answer_questions(routed, lh.analytic(), ref.last_date, ref.rows, lh.range_index())
    replies = every_reply(rows, routed, taxonomy_flat(lh.silver()), str(ref.last_date), ref.rows)
    return routed, rows, replies.drop("origem")


def main(argv: Sequence[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--landing", action="append", default=[], help="landing Parquet, in order")
    ap.add_argument("--fallback-table")
    ap.add_argument("--out")
    ap.add_argument("--questions", help="Parquet with q_id, user_name, text")
    args = ap.parse_args(argv)
    from vitrine.session import build_session
    spark = build_session()
    lh, audits = run_etl(spark, args.landing, args.out, args.fallback_table)
    for name, df in audits.items():
        print(f"== {name}")
        df.show(truncate=False)
    if args.questions:
        _, _, replies = answer(lh, spark.read.parquet(args.questions))
        replies.show(truncate=False)
    spark.stop()


if __name__ == "__main__":
    main()

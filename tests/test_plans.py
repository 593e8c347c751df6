"""Plan checks: pruning, pushdown, pre-shuffle reduction, broadcast choices and
the absence of cartesian products (what the physical plan must look like,
not only what it returns)."""
import re

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMOKE
from vitrine.plans.catalog import queries
from vitrine.operators import gold as G
from vitrine.operators import silver as S
from vitrine.plans.lakehouse import lakehouse


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def scan_lines(p: str):
    return [line for line in p.split("\n") if "FileScan parquet" in line]


def test_mtd_prunes_partitions_and_pushes_date(spark):
    p = plan(queries()["totals_mtd"](spark, SMOKE))
    scan = scan_lines(p)[0]
    assert re.search(r"PartitionFilters: \[.*\(ano#\d+ = \d+\).*\(mes#\d+ = \d+\)", scan)
    assert "LessThanOrEqual(data," in scan


def test_today_pushes_date_filter(spark):
    scan = scan_lines(plan(queries()["totals_today"](spark, SMOKE)))[0]
    assert "EqualTo(data," in scan


def test_projection_pruned_at_scan(spark):
    scan = scan_lines(plan(queries()["ranking_categories"](spark, SMOKE)))[0]
    cols = re.search(r"ReadSchema: struct<([^>]*)>", scan).group(1)
    assert "titulo_produto" not in cols and "fat_num" in cols


def test_dedup_reduces_before_shuffle(spark):
    L = lakehouse(spark, SMOKE)
    p = plan(S.dedup_first(S.typed(L.bronze()), S.DEDUP_KEYS, S.dedup_order()))
    # a partial limit below the exchange and a final one above it
    assert p.count("WindowGroupLimit") >= 2


def test_fact_broadcasts_category_dim_only_after_check(spark):
    L = lakehouse(spark, SMOKE)
    p = final_plan(G.fact_sales(L.silver(), L.dim_category(), L.dim_product()))
    assert "BroadcastHashJoin" in p


def test_topk_is_take_ordered(spark):
    p = plan(queries()["ranking_subcategories_top5"](spark, SMOKE))
    assert "TakeOrderedAndProject" in p


@pytest.mark.parametrize("key", [k for k in sorted(queries()) if not k.startswith("stream_")])
def test_no_cartesian_or_python(spark, key):
    p = plan(queries()[key](spark, SMOKE))
    assert "CartesianProduct" not in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_nested_loop_joins_only_against_small_sides(spark):
    """The few theta joins (period ranges, category containment) broadcast a
    small side; the large side is streamed."""
    for key in ["period_cube", "taxonomy_match"]:
        p = final_plan(queries()[key](spark, SMOKE))
        if "BroadcastNestedLoopJoin" in p:
            assert re.search(r"BroadcastNestedLoopJoin BuildRight", p)


def test_routing_has_no_pairwise_join(spark):
    """The operator itself, not the read of its written layer."""
    from vitrine.operators.routing import Router
    from vitrine.plans.catalog import lh
    from vitrine.sources.dictionary import fixed_glossary
    L = lh(spark, SMOKE)
    router = Router(L.lexicon(), fixed_glossary(spark), L.categories(), L.dim_category(), L.reference().last_date)
    p = plan(router.route(L.questions()))
    assert "Join" in p and "NestedLoopJoin" not in p and "CartesianProduct" not in p


def _windows_fed_by_single_partition(p: str) -> list[str]:
    """Window operators whose input arrives through a single-partition exchange."""
    lines = p.split("\n")
    bad = []
    for i, line in enumerate(lines):
        if "Window [" in line and "WindowGroupLimit" not in line:
            for below in lines[i + 1:]:
                if "Exchange" in below:
                    if "SinglePartition" in below:
                        bad.append(line.strip()[:120])
                    break
    return bad


@pytest.mark.parametrize("key", [k for k in sorted(queries()) if not k.startswith("stream_")])
def test_no_single_partition_window(spark, key):
    assert _windows_fed_by_single_partition(plan(queries()[key](spark, SMOKE))) == []


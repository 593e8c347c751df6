"""Write OPERATORS.md: every SURVEY §2 operator id -> registered key(s) ->
implementation, with the oracle status of each key."""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vitrine.plans.catalog import oracle_sql, queries  # noqa: E402

# id, what, keys, implementation
ROWS = [
    ("S1", "Parquet scan", ["scan_parquet"], "spark.read.parquet (plans/lakehouse)"),
    ("S2/S6", "named table scan / full extract", ["table_roundtrip", "star_sales_by_quarter"], "sinks/writers.save_table, Lakehouse.register_views"),
    ("S3", "source with fallback + provenance", ["source_fallback"], "sources/landing.read_landing"),
    ("S4", "delimited scan with quarantine", ["csv_ingest", "csv_quarantine"], "sources/delimited.read_delimited"),
    ("S5", "ordered warehouse pull", ["sorted_export"], "DataFrame.orderBy (range-partitioned sort)"),
    ("S7", "nested JSON dictionary", ["taxonomy_coverage"], "sources/dictionary.read_dictionary, taxonomy_flat"),
    ("S8", "file drop replaces base, profile", ["refresh_profile", "stream_refresh", "silver_incremental"], "sinks/writers.refresh, streaming/jobs.refresh_stream, sinks/incremental.refresh_days"),
    ("S9", "chat updates (JSON)", ["parse_updates"], "sources/updates.parse_updates"),
    ("K1/K2", "overwrite table (schema replaced / guarded)", ["table_roundtrip", "schema_guard"], "sinks/writers.save_table"),
    ("K3", "delimited export, sanitized", ["csv_export_sanitize"], "sources/delimited.write_delimited"),
    ("K4", "Parquet ZSTD", ["parquet_zstd_roundtrip"], "sinks/writers.write_parquet"),
    ("K5", "several destinations", ["multi_sink"], "sinks/writers.write_all"),
    ("K6/Q8", "schema as a table", ["schema_profile"], "operators/quality.schema_profile"),
    ("K7", "in-memory answer table", ["fact_raw_projection", "adhoc_sql"], "Lakehouse.analytic (+ views)"),
    ("P1", "strict column list", ["bronze_select_strict"], "operators/bronze.select_contract(strict=True)"),
    ("P2", "lenient column list", ["bronze_select_lenient"], "operators/bronze.select_contract"),
    ("P3", "audit columns", ["bronze_audit_columns"], "operators/bronze.with_audit"),
    ("P4/P5", "drop control cols, processing time", ["silver_full"], "operators/silver.silver"),
    ("P6/P7", "rename measures, narrow", ["gold_fact_sales"], "operators/gold.fact_sales"),
    ("P8", "header clean-up Table[col]", ["header_clean"], "sources/delimited.clean_header"),
    ("P9", "answer-table projection (raw)", ["fact_raw_projection", "totals_ytd_raw", "ranking_categories_raw", "ranking_products_top5_raw"], "operators/gold.analytic_from_raw"),
    ("P10", "period label column", ["totals_today"], "operators/periods.resolve"),
    ("F1-F2", "rank = 1, is null", ["silver_dedup_best_rank", "silver_null_counts"], "operators/silver.dedup_first, quality.null_counts"),
    ("F3-F7", "today / yesterday / MTD / YTD / ISO date", ["totals_today", "totals_yesterday", "totals_mtd", "totals_ytd", "totals_on_date"], "operators/periods + metrics.totals"),
    ("F8", "BR date in a question", ["resolve_period"], "operators/routing.resolve_period"),
    ("F9-F11", "category / subcategory filters", ["category_period", "subcategory_period", "subcategory_any_parent"], "operators/metrics.by_keys"),
    ("F12", "ILIKE lookup", ["subcategory_lookup"], "operators/metrics.lookup_subcategory"),
    ("F13", "brand / product ILIKE", ["brand_period", "product_period"], "operators/metrics.brand_period, product_period"),
    ("F14", "weekend membership", ["gold_dim_calendar"], "operators/gold.dim_calendar"),
    ("J1-J3", "star-key resolution", ["fact_lookup_category", "fact_lookup_product", "gold_fact_sales"], "operators/gold.fact_sales"),
    ("J4", "question x keywords", ["match_entities"], "operators/routing.match_entities (n-gram equi-join)"),
    ("J5", "question x glossary", ["glossary_lookup"], "operators/routing.glossary_lookup"),
    ("J6", "category name match", ["taxonomy_match"], "operators/routing.taxonomy_match"),
    ("J7", "rows with reference scalars", ["period_cube"], "Lakehouse.reference + literals"),
    ("A1-A2", "count, min/max date", ["table_profile", "bronze_period_audit"], "operators/quality.profile_line, period_audit"),
    ("A3-A4", "sums, distinct categories", ["silver_totals", "distinct_listings"], "operators/quality.silver_totals, operators/distinct"),
    ("A5", "rows per category", ["bronze_category_distribution"], "groupBy.count.orderBy"),
    ("A6-A8", "sums per category / pair / product", ["ranking_categories", "ranking_subcategories_top5", "ranking_products_top5"], "operators/metrics.by_keys"),
    ("A9-A10", "distinct dates / pairs", ["gold_dim_calendar", "gold_dim_category"], "operators/gold"),
    ("A11", "conversion-check total", ["bronze_money_total"], "gold.raw_money + decimal sum"),
    ("A12-A13", "dictionary counts", ["taxonomy_categories", "taxonomy_profile"], "operators/taxonomy"),
    ("W1", "dedup best rank", ["silver_dedup_best_rank"], "operators/silver.dedup_first"),
    ("W2", "latest row per listing", ["gold_dim_product"], "operators/gold.latest_per_listing"),
    ("W3", "dense surrogate keys", ["gold_dim_category", "gold_dim_product", "gold_stable_keys"], "operators/keys.dense_key / ordered_index, operators/registry.register_keys"),
    ("O1-O2", "sorted dimensions", ["gold_dim_calendar", "gold_dim_category"], "orderBy"),
    ("O3-O4", "ranking, top 5", ["ranking_categories", "ranking_subcategories_top5", "ranking_products_top5"], "orderBy + limit (TakeOrderedAndProject)"),
    ("O5", "any one match, made deterministic", ["subcategory_lookup"], "orderBy + limit 1"),
    ("O6", "sample rows", ["sample_rows"], "limit"),
    ("O7", "first 8 rows + N more", ["format_result_rows", "format_adhoc_reply"], "operators/answers.format_result_rows / format_result"),
    ("O8", "first 15 rows as pipe table", ["pipe_table"], "operators/answers.pipe_table"),
    ("O9", "global order for export", ["sorted_export"], "orderBy"),
    ("Q1", "post-load audit", ["bronze_period_audit"], "operators/quality.period_audit"),
    ("Q2", "duplicates removed", ["silver_dedup_delta"], "operators/quality.dedup_delta"),
    ("Q3", "null counts (one pass)", ["silver_null_counts"], "operators/quality.null_counts"),
    ("Q4", "silver totals", ["silver_totals", "silver_parse_losses"], "operators/quality.silver_totals"),
    ("Q5", "silver vs gold reconcile", ["gold_reconcile", "gold_divergence", "dedup_divergence"], "operators/quality.reconcile, operators/drilldown"),
    ("Q6", "gold audit", ["gold_audit"], "operators/quality.gold_audit"),
    ("Q7", "row counts of gold tables", ["gold_row_counts"], "operators/quality.row_counts"),
    ("Q9", "profile OK|min|max|count", ["table_profile"], "operators/quality.profile_line"),
    ("Q10", "base metadata", ["base_metadata"], "operators/quality.base_metadata"),
    ("Q11", "revenue = price x units", ["revenue_rule_check"], "operators/quality.revenue_rule"),
    ("Q12", "values missing from dictionary", ["taxonomy_coverage"], "operators/taxonomy.coverage"),
    ("Q13", "file size", ["table_file_size"], "operators/quality.file_size_mb"),
    ("Q14", "ano/mes/ano_mes vs data", ["period_columns_check"], "operators/quality.period_columns_check"),
    ("M1", "period total", ["totals_today", "totals_yesterday", "totals_mtd", "totals_ytd", "totals_on_date"], "operators/metrics.totals"),
    ("M2-M3", "category / subcategory in period", ["category_period", "subcategory_period", "subcategory_any_parent"], "operators/metrics"),
    ("M4", "brand or product in period", ["brand_period", "product_period"], "operators/metrics"),
    ("M5-M7", "rankings", ["ranking_subcategories_top5", "ranking_categories", "ranking_products_top5"], "operators/metrics"),
    ("M8", "top product per category", ["top_product_in_category"], "operators/metrics.top_product_per_category"),
    ("M9", "average price", ["average_price"], "operators/metrics.average_price"),
    ("M10", "FULL / free-shipping shares", ["full_share", "free_shipping_share"], "operators/metrics.flag_share"),
    ("M11", "dynamic subcategory lookup", ["subcategory_lookup", "route_questions"], "metrics.lookup_subcategory, routing.dynamic_subcategory"),
    ("M12", "all periods x levels in one pass", ["period_cube", "trailing_totals"], "operators/metrics.period_cube, operators/ranges"),
    ("M13", "ad-hoc SQL", ["adhoc_sql", "format_adhoc_reply"], "operators/metrics.adhoc_sql"),
    ("C1", "MoM (same month last year)", ["mom_same_month_ly"], "operators/compare.mom_same_month_ly"),
    ("C2", "YoY", ["yoy", "yoy_by_category"], "operators/compare.yoy / compare"),
    ("C3", "M-1, M+1", ["month_offset"], "operators/compare.month_offset"),
    ("C4", "LY", ["last_year"], "operators/compare.last_year"),
    ("C5", "delta abs / pct", ["delta_abs_pct"], "operators/compare.delta_abs_pct"),
    ("C6", "running MTD / YTD", ["running_mtd_ytd"], "operators/compare.running_mtd_ytd"),
    ("2.11", "money / rating / booleans / ints / trim / defaults", ["silver_money_br", "silver_rating", "silver_booleans", "silver_int_typing", "silver_trim", "silver_null_defaults"], "functions/parsing, operators/silver"),
    ("2.11", "date and number text, markup", ["format_date_br", "format_brl", "strip_markup"], "functions/formatting"),
    ("R1-R3", "taxonomy listings", ["taxonomy_categories", "taxonomy_subcategories", "taxonomy_flat"], "operators/taxonomy"),
    ("R4", "glossary answer", ["glossary_lookup", "format_dictionary_replies"], "routing.glossary_lookup, answers.dictionary_replies"),
    ("R5-R10", "flags, entities, warning, period, intent", ["route_questions", "match_entities", "level_warning", "resolve_period"], "operators/routing"),
    ("R11", "answer a batch", ["answer_questions"], "operators/answers.answer_questions, operators/ranges"),
    ("R12", "reply text", ["format_result_rows", "format_dictionary_replies", "format_adhoc_reply"], "operators/answers"),
    ("ST1", "message loop (route, answer, reply)", ["stream_route_questions", "stream_replies", "stream_live_base", "stream_dedup_events"], "streaming/jobs.route_stream, dedup_stream"),
    ("ST2", "base drop -> reload + profile", ["stream_refresh"], "streaming/jobs.refresh_stream"),
]


def main() -> None:
    qs, sq = queries(), oracle_sql()
    lines = ["# Operator inventory (SURVEY §2) -> registered queries", "",
             "Generated by `tools/operators_doc.py`. ✓ = DuckDB oracle, r = rows-only check.",
             "", "| id | operator | keys | implementation |", "|---|---|---|---|"]
    missing = []
    for oid, what, keys, impl in ROWS:
        marks = []
        for k in keys:
            if k not in qs:
                missing.append(k)
            marks.append(f"`{k}` {'✓' if k in sq else 'r'}")
        lines.append(f"| {oid} | {what} | {', '.join(marks)} | {impl} |")
    covered = {k for _, _, keys, _ in ROWS for k in keys}
    extra = sorted(set(qs) - covered)
    if extra:
        lines += ["", "Registered keys not listed above: " + ", ".join(f"`{k}`" for k in extra)]
    assert not missing, missing
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "OPERATORS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(lines) + "\n")
    print(f"{len(ROWS)} rows, {len(covered)} keys covered, extra: {extra}")


if __name__ == "__main__":
    main()

"""Registry of named queries: key -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame over the
given tables (through the materialized layers of :mod:`vitrine.plans.lakehouse`).
Fixed query parameters (a category name, a brand term) are plain literals,
like the parameters of a benchmark query; every query reads whole tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from vitrine.constants import (BOOLEAN_COLUMNS, INT_COLUMNS, LANDING_COLUMNS, LANDING_TYPES,
                               MARKUP_CHARS, MONEY_COLUMNS, NULL_CHECK_COLUMNS, NULL_DEFAULTS,
                               ORIGIN_EXISTING_FILE, TRIM_COLUMNS)
from vitrine.operators import bronze as B
from vitrine.operators import compare as C
from vitrine.operators import distinct as Dc
from vitrine.operators import drilldown as Dr
from vitrine.operators import gold as G
from vitrine.operators import metrics as M
from vitrine.operators import quality as Q
from vitrine.operators import ranges as Rg
from vitrine.operators import registry as Kr
from vitrine.operators import silver as S
from vitrine.functions.parsing import money_exact
from vitrine.operators.periods import resolve
from vitrine.plans import oracle as O
from vitrine.plans.lakehouse import lakehouse
from vitrine.session import parallelism
from vitrine.constants import ORIGIN_FRESH
from vitrine.sinks import incremental as Inc
from vitrine.sinks import writers as Wr
from vitrine.sources import delimited as D
from vitrine.sources import dictionary as Dic
from vitrine.sources import landing as Ld
from vitrine.sources import updates as U
from vitrine.operators import taxonomy as T
from vitrine.functions import formatting as Fm
from vitrine.operators import answers as A
from vitrine.operators import routing as R
from vitrine.plans import oracle_routing as OR
from vitrine.streaming import jobs as J


@dataclass(frozen=True)
class Entry:
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = Entry(fn, sql)
        return fn
    return deco


def lh(spark, sf_dir):
    return lakehouse(spark, sf_dir)


# FIXED VALUES: parameters of the registered metric queries.
P_CATEGORY = "PROMO"
P_SUBCATEGORY = "ring"
P_BRAND_TERM = "brand#1"
P_LOOKUP_TERM = "IN"
P_PRODUCT_TERM = "RING"
P_REVENUE_TOLERANCE = 1.0

W = O.with_layers

# ============================================================================
# Sources, bronze
# ============================================================================
register("scan_parquet", f"{W('landing')} SELECT * FROM landing")(
    lambda spark, d: spark.read.parquet(lh(spark, d).landing_path()))

register("bronze_select_strict", f"{W('bronze')} SELECT * FROM bronze")(
    lambda spark, d: B.select_contract(lh(spark, d).landing(), strict=True))

register("bronze_select_lenient", f"{W('bronze')} SELECT * FROM bronze")(
    lambda spark, d: B.select_contract(lh(spark, d).landing(), strict=False))

register("bronze_audit_columns",
         f"{W('bronze')} SELECT *, '{ORIGIN_EXISTING_FILE}' AS _arquivo_origem FROM bronze")(
    lambda spark, d: lh(spark, d).bronze().drop("_data_ingestao"))

register("bronze_period_audit",
         f"{W('bronze')} SELECT count(*) AS total_registros, min(data) AS data_min, "
         f"max(data) AS data_max FROM bronze")(
    lambda spark, d: Q.period_audit(lh(spark, d).bronze()))

register("bronze_category_distribution",
         f"{W('bronze')} SELECT categoria, count(*) AS registros FROM bronze GROUP BY categoria "
         f"ORDER BY registros DESC, categoria ASC NULLS FIRST")(
    lambda spark, d: lh(spark, d).bronze().groupBy("categoria")
    .agg(F.count(F.lit(1)).alias("registros"))
    .orderBy(F.col("registros").desc(), F.col("categoria").asc_nulls_first()))

register("bronze_money_total",
         f"{W('bronze')} SELECT count(*) AS total_registros, "
         f"{O.money_sum(O._money('faturamento_estimado_dia', trim=False))} AS faturamento_total, "
         f"CAST(SUM(TRY_CAST(qtd_vendas_estimadas_dia AS INTEGER)) AS BIGINT) AS vendas_total "
         f"FROM bronze")(
    lambda spark, d: lh(spark, d).bronze().agg(
        F.count(F.lit(1)).alias("total_registros"),
        M.money_total_expr(G.raw_money("faturamento_estimado_dia")).alias("faturamento_total"),
        F.sum(F.col("qtd_vendas_estimadas_dia").try_cast("int")).cast("long").alias("vendas_total")))

# ============================================================================
# Silver steps
# ============================================================================
_KEYS = ["data", "id_anuncio", "posicao_ranking"]


def _typed_sql(cols):
    return f"{W('bronze')} SELECT " + ", ".join(
        [f"{c}" for c in _KEYS if c not in cols] + [f"{O._TYPED_EXPRS[c]} AS {c}" for c in cols]
    ) + " FROM bronze"


register("silver_money_br", _typed_sql(MONEY_COLUMNS))(
    lambda spark, d: S.parse_money(lh(spark, d).bronze()).select(*_KEYS, *MONEY_COLUMNS))

register("silver_rating", _typed_sql(["avaliacao_nota"]))(
    lambda spark, d: S.parse_rating(lh(spark, d).bronze()).select(*_KEYS, "avaliacao_nota"))

register("silver_booleans", _typed_sql(BOOLEAN_COLUMNS))(
    lambda spark, d: S.cast_booleans(lh(spark, d).bronze()).select(*_KEYS, *BOOLEAN_COLUMNS))

register("silver_int_typing",
         f"{W('bronze')} SELECT data, id_anuncio, " + ", ".join(
             f"{O._TYPED_EXPRS[c]} AS {c}" for c in INT_COLUMNS) + " FROM bronze")(
    lambda spark, d: S.cast_ints(lh(spark, d).bronze()).select("data", "id_anuncio", *INT_COLUMNS))

register("silver_trim",
         f"{W('bronze')} SELECT data, posicao_ranking, " + ", ".join(
             f"trim({c}) AS {c}" for c in TRIM_COLUMNS) + " FROM bronze")(
    lambda spark, d: S.trim_all(lh(spark, d).bronze()).select("data", "posicao_ranking",
                                                              *TRIM_COLUMNS))

register("silver_dedup_best_rank", f"{W('dedup')} SELECT * FROM dedup")(
    lambda spark, d: S.dedup_first(S.typed(B.select_contract(lh(spark, d).bronze())),
                                   S.DEDUP_KEYS, S.dedup_order()))

register("silver_null_defaults",
         f"{W('silver')} SELECT data, id_anuncio, " + ", ".join(c for c, _ in NULL_DEFAULTS)
         + " FROM silver")(
    lambda spark, d: lh(spark, d).silver().select("data", "id_anuncio",
                                                  *[c for c, _ in NULL_DEFAULTS]))

register("silver_full", f"{W('silver')} SELECT * FROM silver")(
    lambda spark, d: lh(spark, d).silver().drop("_data_processamento"))



def _silver_by_days(spark, d):
    """Two drops: the last day is still missing in the first one, and half of the
    first day's listings. The second one builds the months of those days only."""
    base, landing = _scratch(spark, d, "silver_days"), B.select_contract(lh(spark, d).bronze())
    ref = lh(spark, d).reference(raw=True)
    early = landing.where((F.col("data") < F.lit(ref.last_date)) & ~(
        (F.col("data") == F.lit(ref.first_date)) & (F.pmod(F.xxhash64("id_anuncio"), F.lit(2)) == 0)))
    if Wr.current_version(spark, base) is None:
        for drop in (early, landing):
            Inc.refresh_days(drop, base, lambda rows: S.silver(rows, processing_time=False), unit=Inc.MONTH)
    return Inc.read_days(spark, base)


register("silver_incremental", f"{W('silver')} SELECT * FROM silver")(_silver_by_days)


def _stable_keys(spark, d):
    """Listings numbered in two loads: the first 30 days, then all."""
    folder, silver = _scratch(spark, d, "listing_keys"), lh(spark, d).silver()
    ref = lh(spark, d).reference()
    middle = ref.first_date + timedelta(days=30)
    if Wr.current_version(spark, folder) is None:
        Kr.register_keys(silver.where(F.col("data") <= F.lit(middle)), folder, ["id_anuncio"], "sk_anuncio")
        Kr.register_keys(silver, folder, ["id_anuncio"], "sk_anuncio")
    return Kr.read_register(spark, folder, StructType.fromDDL("sk_anuncio long, id_anuncio string, carga int"))


register("gold_stable_keys",
         f"{W('silver')}, m AS (SELECT min(data) + 30 AS meio "
         f"FROM silver), f AS (SELECT id_anuncio, CASE WHEN min(data) <= (SELECT meio FROM m) THEN 1 ELSE 2 END "
         f"AS carga FROM silver GROUP BY id_anuncio) SELECT row_number() OVER (ORDER BY carga, id_anuncio ASC "
         f"NULLS FIRST) AS sk_anuncio, id_anuncio, CAST(carga AS INTEGER) AS carga FROM f")(_stable_keys)

register("silver_dedup_delta",
         f"{W('typed')} SELECT count(*) AS antes, "
         f"(SELECT count(*) FROM (SELECT DISTINCT data, id_anuncio FROM typed)) AS depois, "
         f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT data, id_anuncio FROM typed)) "
         f"AS duplicatas_removidas FROM typed")(
    lambda spark, d: Q.dedup_delta(S.typed(B.select_contract(lh(spark, d).bronze()))))

register("silver_null_counts",
         f"{W('silver')} " + " UNION ALL ".join(
             f"SELECT '{c}' AS coluna, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulos "
             f"FROM silver" for c in NULL_CHECK_COLUMNS))(
    lambda spark, d: Q.null_counts(lh(spark, d).silver()))

register("silver_totals",
         f"{W('silver')} SELECT count(*) AS total_registros, "
         f"{O.money_sum('faturamento_estimado_dia')} AS faturamento_total, "
         f"CAST(SUM(qtd_vendas_estimadas_dia) AS BIGINT) AS vendas_total, min(data) AS data_min, "
         f"max(data) AS data_max, count(DISTINCT categoria) AS qtd_categorias FROM silver")(
    lambda spark, d: Q.silver_totals(lh(spark, d).silver()))

# ============================================================================
# Gold
# ============================================================================
register("gold_dim_calendar", f"{W('dim_calendar')} SELECT * FROM dim_calendar ORDER BY data")(
    lambda spark, d: lh(spark, d).dim_calendar().orderBy("data"))

register("gold_dim_category",
         f"{W('dim_category')} SELECT * FROM dim_category ORDER BY categoria, subcategoria")(
    lambda spark, d: lh(spark, d).dim_category().orderBy("categoria", "subcategoria"))

register("gold_dim_product", f"{W('dim_product')} SELECT * FROM dim_product")(
    lambda spark, d: lh(spark, d).dim_product())

register("gold_fact_sales", f"{W('fact')} SELECT * FROM fact")(
    lambda spark, d: lh(spark, d).fact())

register("fact_lookup_category",
         f"{W('silver', 'dim_category')} SELECT s.data, s.id_anuncio, s.categoria, s.subcategoria, "
         f"c.sk_categoria FROM silver s LEFT JOIN dim_category c "
         f"ON s.categoria = c.categoria AND s.subcategoria = c.subcategoria")(
    lambda spark, d: lh(spark, d).silver().select("data", "id_anuncio", "categoria", "subcategoria")
    .join(lh(spark, d).dim_category(), ["categoria", "subcategoria"], "left")
    .select("data", "id_anuncio", "categoria", "subcategoria", "sk_categoria"))

register("fact_lookup_product",
         f"{W('silver', 'dim_product')} SELECT s.data, s.id_anuncio, p.sk_produto FROM silver s "
         f"LEFT JOIN dim_product p ON s.id_anuncio = p.id_anuncio")(
    lambda spark, d: lh(spark, d).silver().select("data", "id_anuncio")
    .join(lh(spark, d).dim_product().select("id_anuncio", "sk_produto"), "id_anuncio", "left")
    .select("data", "id_anuncio", "sk_produto"))

register("fact_raw_projection", f"{W('analytic_raw')} SELECT * FROM analytic_raw")(
    lambda spark, d: lh(spark, d).analytic(raw=True))

register("gold_reconcile",
         f"{W('fact')}, m AS ("
         f"SELECT 'registros' AS metrica, CAST((SELECT count(*) FROM silver) AS DOUBLE) AS prata, "
         f"CAST((SELECT count(*) FROM fact) AS DOUBLE) AS ouro "
         f"UNION ALL SELECT 'faturamento', (SELECT {O.money_sum('faturamento_estimado_dia')} FROM silver), "
         f"(SELECT {O.money_sum('faturamento')} FROM fact) "
         f"UNION ALL SELECT 'vendas', CAST((SELECT SUM(qtd_vendas_estimadas_dia) FROM silver) AS DOUBLE), "
         f"CAST((SELECT SUM(qtd_vendas) FROM fact) AS DOUBLE)) "
         f"SELECT metrica, prata, ouro, CASE WHEN prata IS NOT DISTINCT FROM ouro THEN 'OK' "
         f"ELSE 'ERRO' END AS status FROM m")(
    lambda spark, d: Q.reconcile(lh(spark, d).silver(), lh(spark, d).fact()))



def _divergence_sql(a: str, b: str, keys: list[str], fat: tuple[str, str], qtd: tuple[str, str]) -> str:
    def side(t, x, f, q):
        return (f"{x} AS (SELECT {', '.join(keys)}, count(*) AS n, "
                f"SUM(TRY_CAST({f} AS DECIMAL(28,2))) AS fat, SUM({q}) AS qtd FROM {t} GROUP BY ALL)")
    out = ", ".join(f"coalesce(x.{k}, y.{k}) AS {k}" for k in keys)
    on = " AND ".join(f"x.{k} IS NOT DISTINCT FROM y.{k}" for k in keys)
    return (f"{side(a, 'x', fat[0], qtd[0])}, {side(b, 'y', fat[1], qtd[1])} SELECT {out}, "
            f"coalesce(x.n, 0) AS registros_a, coalesce(y.n, 0) AS registros_b, "
            f"CAST(x.fat AS DOUBLE) AS faturamento_a, CAST(y.fat AS DOUBLE) AS faturamento_b, "
            f"CAST(x.qtd AS BIGINT) AS vendas_a, CAST(y.qtd AS BIGINT) AS vendas_b "
            f"FROM x FULL JOIN y ON {on} WHERE x.n IS DISTINCT FROM y.n "
            f"OR x.fat IS DISTINCT FROM y.fat OR x.qtd IS DISTINCT FROM y.qtd")


def _divergences(left: DataFrame, right: DataFrame, keys: list[str], fat: tuple[str, str],
                 qtd: tuple[str, str]) -> DataFrame:
    found = Dr.divergences(left, right, keys, {
        "faturamento": (money_exact(fat[0]), money_exact(fat[1])),
        "vendas": (F.col(qtd[0]).cast("long"), F.col(qtd[1]).cast("long"))})
    return found.withColumns({c: F.col(c).cast("double") for c in ("faturamento_a", "faturamento_b")})


_BY_LISTING = ["ano_mes", "data", "id_anuncio"]
_BY_RANK = ["ano_mes", "data", "posicao_ranking"]
_TYPED_MEASURES = (("faturamento_estimado_dia",) * 2, ("qtd_vendas_estimadas_dia",) * 2)
_FACT_MEASURES = (("faturamento_estimado_dia", "faturamento"), ("qtd_vendas_estimadas_dia", "qtd_vendas"))

register("dedup_divergence",
         f"{W('silver')}, " + _divergence_sql("typed", "silver", _BY_LISTING, *_TYPED_MEASURES))(
    lambda spark, d: _divergences(S.typed(B.select_contract(lh(spark, d).bronze())),
                                  lh(spark, d).silver(), _BY_LISTING, *_TYPED_MEASURES))

register("gold_divergence",
         f"{W('fact')}, " + _divergence_sql("silver", "fact", _BY_RANK, *_FACT_MEASURES))(
    lambda spark, d: _divergences(lh(spark, d).silver(), lh(spark, d).fact(), _BY_RANK, *_FACT_MEASURES))


def _distinct_sql() -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{tipo}' AS tipo, CAST(date_trunc('{unit}', data) AS DATE) AS inicio, categoria, "
        f"id_anuncio FROM silver WHERE data IS NOT NULL" for tipo, unit, _ in Dc.CALENDAR)
    return (f"{W('silver')}, p AS ({parts}) SELECT tipo, inicio, categoria, "
            f"count(DISTINCT id_anuncio) AS anuncios, TRUE AS dentro_do_limite FROM p GROUP BY ALL")


register("distinct_listings", _distinct_sql())(
    lambda spark, d: Dc.counts_by_period(lh(spark, d).silver(), lh(spark, d).listing_sketches(), "id_anuncio")
    .select("tipo", "inicio", "categoria", F.col("exato").alias("anuncios"),
            Dc.within_bound(F.col("exato"), F.col("estimativa")).alias("dentro_do_limite")))

register("gold_audit",
         f"{W('fact')} SELECT count(*) AS registros, {O.money_sum('faturamento')} AS faturamento, "
         f"CAST(SUM(qtd_vendas) AS BIGINT) AS vendas, min(data) AS data_min, max(data) AS data_max "
         f"FROM fact")(
    lambda spark, d: Q.gold_audit(lh(spark, d).fact()))

register("gold_row_counts",
         f"{W('fact', 'dim_calendar')} "
         "SELECT 'ouro_dim_calendario' AS tabela, count(*) AS registros FROM dim_calendar "
         "UNION ALL SELECT 'ouro_dim_categoria', count(*) FROM dim_category "
         "UNION ALL SELECT 'ouro_dim_produto', count(*) FROM dim_product "
         "UNION ALL SELECT 'ouro_fato_vendas', count(*) FROM fact")(
    lambda spark, d: Q.row_counts({"ouro_dim_calendario": lh(spark, d).dim_calendar(),
                                   "ouro_dim_categoria": lh(spark, d).dim_category(),
                                   "ouro_dim_produto": lh(spark, d).dim_product(),
                                   "ouro_fato_vendas": lh(spark, d).fact()}))

# ============================================================================
# Profiles and checks
# ============================================================================
register("table_profile",
         f"{W('landing')} SELECT min(data) AS data_min, max(data) AS data_max, "
         f"count(*) AS total_registros, 'OK|' || CAST(min(data) AS VARCHAR) || '|' || "
         f"CAST(max(data) AS VARCHAR) || '|' || CAST(count(*) AS VARCHAR) AS status FROM landing")(
    lambda spark, d: Q.profile_line(lh(spark, d).landing()))

register("table_file_size")(lambda spark, d: Q.file_size_mb(spark, lh(spark, d).landing_path()))

register("silver_parse_losses",
         f"{W('bronze')} " + " UNION ALL ".join(
             [f"SELECT '{c}' AS coluna, count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> '' AND "
              f"{O.typed_expr(c)} IS NULL) AS invalidos, count(*) FILTER (WHERE {O.typed_expr(c)} IS NOT "
              f"NULL AND TRY_CAST({O.typed_expr(c)} AS DECIMAL(28,2)) IS NULL) AS fora_da_faixa FROM bronze"
              for c in MONEY_COLUMNS]
             + [f"SELECT '{c}', count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> '' AND "
                f"{O.typed_expr(c)} IS NULL), 0 FROM bronze" for c in [*BOOLEAN_COLUMNS, *INT_COLUMNS]]))(
    lambda spark, d: Q.parse_losses(lh(spark, d).bronze()))

register("base_metadata",
         f"{W('analytic')} SELECT CAST(max(data) AS VARCHAR) AS data_mais_recente, "
         f"count(*) AS total_registros FROM analytic")(
    lambda spark, d: Q.base_metadata(lh(spark, d).analytic()))

register("revenue_rule_check",
         f"{W('silver')} SELECT categoria, count(*) AS linhas, "
         f"count(*) FILTER (WHERE abs(faturamento_estimado_dia - preco_atual * "
         f"qtd_vendas_estimadas_dia) > {P_REVENUE_TOLERANCE}) AS violacoes, "
         f"max(abs(faturamento_estimado_dia - preco_atual * qtd_vendas_estimadas_dia)) AS max_desvio "
         f"FROM silver GROUP BY categoria")(
    lambda spark, d: Q.revenue_rule(lh(spark, d).silver(), P_REVENUE_TOLERANCE))

register("period_columns_check",
         f"{W('silver')} SELECT count(*) AS registros, count(*) FILTER (WHERE year(data) <> ano OR "
         f"month(data) <> mes OR strftime(data, '%Y-%m') <> ano_mes) AS divergentes, "
         f"count(*) FILTER (WHERE ano IS NULL OR mes IS NULL OR ano_mes IS NULL) AS sem_periodo "
         f"FROM silver")(
    lambda spark, d: Q.period_columns_check(lh(spark, d).silver()))

_SPARK_TYPES = ("CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' "
                "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' WHEN 'DATE' THEN 'date' "
                "WHEN 'BOOLEAN' THEN 'boolean' ELSE lower(column_type) END")


def _schema_profile_sql():
    silver_cols = ", ".join(LANDING_COLUMNS)
    nulls = " UNION ALL ".join(
        f"SELECT '{c}' AS coluna, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS nulos "
        f"FROM silver" for c in LANDING_COLUMNS)
    return (f"{W('silver')}, d AS (SELECT CAST(row_number() OVER () AS INTEGER) AS posicao, "
            f"column_name AS coluna, {_SPARK_TYPES} AS tipo FROM (DESCRIBE SELECT {silver_cols} "
            f"FROM silver)), n AS ({nulls}) SELECT d.posicao, d.coluna, d.tipo, n.nulos "
            f"FROM d JOIN n ON d.coluna = n.coluna")


register("schema_profile", _schema_profile_sql())(
    lambda spark, d: Q.schema_profile(spark, lh(spark, d).silver().drop("_data_processamento")))

# ============================================================================
# Metrics over the answer table
# ============================================================================


def _ref(spark, d, raw=False):
    return lh(spark, d).reference(raw).last_date


def _period(kind):
    def get(spark, d):
        r = lh(spark, d).reference()
        if kind == "first_date":
            return resolve("date", r.last_date, day=r.first_date)
        return resolve(kind, r.last_date)
    return get


def _totals_sql(kind, layer="analytic"):
    ref = "ref" if layer == "analytic" else "ref_raw"
    return (f"{W(layer, ref)} SELECT {O.period_label(kind)} AS periodo, "
            f"{O.money_sum('fat_num')} AS faturamento_total, "
            f"CAST(SUM(qtd_vendas_num) AS BIGINT) AS total_pedidos "
            f"FROM ref LEFT JOIN {layer} ON {O.period_where(kind)} GROUP BY r, r0")


for _kind, _key in [("today", "totals_today"), ("yesterday", "totals_yesterday"),
                    ("mtd", "totals_mtd"), ("ytd", "totals_ytd"), ("first_date", "totals_on_date")]:
    register(_key, _totals_sql(_kind))(
        (lambda k: lambda spark, d: M.totals(lh(spark, d).analytic(with_partition=True),
                                             _period(k)(spark, d)))(_kind))


def _raw_totals(spark, d):
    r = lh(spark, d).reference(raw=True)
    return M.totals(lh(spark, d).analytic(raw=True), resolve("ytd", r.last_date))


register("totals_ytd_raw", _totals_sql("ytd", "analytic_raw"))(_raw_totals)


def _by_keys_sql(kind, keys, where=None, n=None, units_first=False, layer="analytic"):
    k = ", ".join(keys)
    measures = ["CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas", f"{O.money_sum('fat_num')} AS faturamento"]
    if not units_first:
        measures.reverse()
    cond = O.period_where(kind) + (f" AND {where}" if where else "")
    order = ", ".join(["faturamento DESC NULLS LAST"] + [f"{c} ASC NULLS FIRST" for c in keys])
    ref = "ref" if layer == "analytic" else "ref_raw"
    return (f"{W(layer, ref)} SELECT {O.period_label(kind)} AS periodo, {k}, "
            f"{', '.join(measures)} FROM {layer}, ref WHERE {cond} GROUP BY r, {k} "
            f"ORDER BY {order}" + (f" LIMIT {n}" if n else ""))


register("category_period", _by_keys_sql("ytd", ["categoria"], f"categoria = '{P_CATEGORY}'"))(
    lambda spark, d: M.category_period(lh(spark, d).analytic(), _period("ytd")(spark, d), P_CATEGORY))

register("subcategory_period",
         _by_keys_sql("ytd", ["categoria", "subcategoria"],
                      f"categoria = '{P_CATEGORY}' AND subcategoria = '{P_SUBCATEGORY}'"))(
    lambda spark, d: M.subcategory_period(lh(spark, d).analytic(), _period("ytd")(spark, d),
                                          P_CATEGORY, P_SUBCATEGORY))

register("subcategory_any_parent",
         _by_keys_sql("ytd", ["categoria", "subcategoria"], f"subcategoria = '{P_SUBCATEGORY}'"))(
    lambda spark, d: M.subcategory_any_parent(lh(spark, d).analytic(), _period("ytd")(spark, d),
                                              P_SUBCATEGORY))

register("brand_period", _by_keys_sql("ytd", ["marca"], f"marca ILIKE '%{P_BRAND_TERM}%'"))(
    lambda spark, d: M.brand_period(lh(spark, d).analytic(), _period("ytd")(spark, d), P_BRAND_TERM))

register("product_period",
         _by_keys_sql("ytd", ["titulo_produto", "marca"], f"titulo_produto ILIKE '%{P_PRODUCT_TERM}%'"))(
    lambda spark, d: M.product_period(lh(spark, d).analytic(), _period("ytd")(spark, d),
                                      P_PRODUCT_TERM))

register("ranking_categories", _by_keys_sql("mtd", ["categoria"]))(
    lambda spark, d: M.ranking_categories(lh(spark, d).analytic(), _period("mtd")(spark, d)))

register("ranking_subcategories_top5", _by_keys_sql("ytd", ["categoria", "subcategoria"], n=5))(
    lambda spark, d: M.ranking_subcategories(lh(spark, d).analytic(), _period("ytd")(spark, d)))

register("ranking_products_top5", _by_keys_sql("ytd", M.PRODUCT_KEYS, n=5, units_first=True))(
    lambda spark, d: M.ranking_products(lh(spark, d).analytic(), _period("ytd")(spark, d)))

register("top_product_in_category",
         f"{W('analytic', 'ref')}, p AS (SELECT titulo_produto, marca, categoria, subcategoria, "
         f"SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas "
         f"FROM analytic, ref WHERE {O.period_where('ytd')} GROUP BY 1, 2, 3, 4) "
         f"SELECT (SELECT {O.period_label('ytd')} FROM ref) AS periodo, categoria, subcategoria, "
         f"titulo_produto, marca, CAST(fat AS DOUBLE) AS faturamento, vendas FROM ("
         f"SELECT *, row_number() OVER (PARTITION BY categoria ORDER BY fat DESC NULLS LAST, "
         f"titulo_produto ASC NULLS FIRST, marca ASC NULLS FIRST, subcategoria ASC NULLS FIRST) AS rn "
         f"FROM p) WHERE rn = 1")(
    lambda spark, d: M.top_product_per_category(lh(spark, d).analytic(), _period("ytd")(spark, d)))

register("average_price",
         f"{W('analytic', 'ref')} SELECT {O.period_label('ytd')} AS periodo, categoria, "
         f"CAST(SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS DOUBLE) / NULLIF(CAST(SUM(qtd_vendas_num) AS DOUBLE), 0) "
         f"AS preco_medio, CAST(SUM(TRY_CAST(preco_num AS DECIMAL(28,2))) AS DOUBLE) / "
         f"NULLIF(CAST(count(preco_num) AS DOUBLE), 0) AS preco_medio_anuncio "
         f"FROM analytic, ref WHERE {O.period_where('ytd')} GROUP BY r, categoria")(
    lambda spark, d: M.average_price(lh(spark, d).analytic(), _period("ytd")(spark, d)))


def _share_sql(flag, prefix):
    return (f"{W('analytic', 'ref')} SELECT {O.period_label('ytd')} AS periodo, categoria, "
            f"CAST(COALESCE(SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) FILTER (WHERE {flag}), 0) AS DOUBLE) / "
            f"NULLIF(CAST(SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS DOUBLE), 0) AS {prefix}_faturamento, "
            f"CAST(COALESCE(SUM(qtd_vendas_num) FILTER (WHERE {flag}), 0) AS DOUBLE) / "
            f"NULLIF(CAST(SUM(qtd_vendas_num) AS DOUBLE), 0) AS {prefix}_vendas, "
            f"CAST(count(*) FILTER (WHERE {flag}) AS DOUBLE) / NULLIF(CAST(count(*) AS DOUBLE), 0) "
            f"AS {prefix}_linhas FROM analytic, ref WHERE {O.period_where('ytd')} GROUP BY r, categoria")


register("full_share", _share_sql("is_full", "share_full"))(
    lambda spark, d: M.full_share(lh(spark, d).analytic(), _period("ytd")(spark, d)))

register("free_shipping_share", _share_sql("frete_gratis", "share_frete_gratis"))(
    lambda spark, d: M.free_shipping_share(lh(spark, d).analytic(), _period("ytd")(spark, d)))

register("subcategory_lookup",
         f"{W('analytic')} SELECT DISTINCT categoria, subcategoria FROM analytic "
         f"WHERE subcategoria ILIKE '%{P_LOOKUP_TERM}%' "
         f"ORDER BY categoria ASC NULLS FIRST, subcategoria ASC NULLS FIRST LIMIT 1")(
    lambda spark, d: M.lookup_subcategory(lh(spark, d).dim_category(), P_LOOKUP_TERM))


def _cube_ctes():
    kinds = ["today", "yesterday", "mtd", "ytd"]
    parts = " UNION ALL ".join(
        f"SELECT {O.period_label(k)} AS periodo, categoria, subcategoria, fat_num, qtd_vendas_num "
        f"FROM analytic, ref WHERE {O.period_where(k)}" for k in kinds)
    return (f"{W('analytic', 'ref')}, rows_ AS ({parts}), cube AS ({_cube_select()})")


def _cube_sql():
    return f"{_cube_ctes()} SELECT * FROM cube"


def _cube_select():
    return (f"SELECT periodo, categoria, subcategoria, "
            f"CAST(GROUPING(categoria) * 2 + GROUPING(subcategoria) AS INTEGER) AS gid, "
            f"{O.money_sum('fat_num')} AS faturamento, CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas "
            f"FROM rows_ GROUP BY GROUPING SETS ((periodo, categoria, subcategoria), "
            f"(periodo, categoria), (periodo))")


register("period_cube", _cube_sql())(
    lambda spark, d: M.period_cube(spark, lh(spark, d).analytic(), _ref(spark, d), lh(spark, d).range_index()))

# FIXED VALUES: lengths in days of the registered trailing totals.
P_TRAILING_DAYS = (7, 30, 90, 365)


def _trailing_sql():
    daily = ("daily AS (SELECT data, SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, "
             "SUM(qtd_vendas_num) AS qtd FROM analytic WHERE data IS NOT NULL GROUP BY data)")
    return (f"{W('analytic')}, {daily} SELECT e.data, CAST(n.dias AS INTEGER) AS dias, "
            f"CAST(SUM(d.fat) AS DOUBLE) AS faturamento, CAST(SUM(d.qtd) AS BIGINT) AS vendas "
            f"FROM daily e CROSS JOIN (SELECT unnest({list(P_TRAILING_DAYS)}) AS dias) n "
            f"JOIN daily d ON d.data <= e.data AND d.data > e.data - CAST(n.dias AS INTEGER) "
            f"GROUP BY e.data, n.dias")


register("trailing_totals", _trailing_sql())(
    lambda spark, d: Rg.trailing_totals(lh(spark, d).range_index(), P_TRAILING_DAYS))

# FIXED VALUES: the ad-hoc query text used by the registered ``adhoc_sql`` key.
ADHOC_SQL = ("SELECT marca, CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas, "
             "COUNT(DISTINCT titulo_produto) AS produtos FROM fato_ml "
             "WHERE qtd_vendas_num >= {min_units} GROUP BY marca")

register("adhoc_sql", f"{W('analytic')} " + ADHOC_SQL.replace("fato_ml", "analytic")
         .replace("{min_units}", "10"))(
    lambda spark, d: M.adhoc_sql(spark, lh(spark, d).analytic(),
                                 ADHOC_SQL.replace("{min_units}", ":min_units"),
                                 args={"min_units": 10}))

# ============================================================================
# Period comparisons
# ============================================================================
_MONTHLY = ("monthly AS (SELECT CAST(date_trunc('month', data) AS DATE) AS mes_ref, "
            "SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas "
            "FROM analytic GROUP BY 1)")
_YEARLY = ("yearly AS (SELECT CAST(year(data) AS INTEGER) AS ano, "
           "SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas "
           "FROM analytic GROUP BY 1)")
_DAILY = ("daily AS (SELECT data, SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, "
          "CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas FROM analytic GROUP BY data)")


def _delta_sql(cur, prev):
    return (f"CAST({cur} - {prev} AS DOUBLE) AS delta_abs, "
            f"CAST({cur} - {prev} AS DOUBLE) / NULLIF(CAST({prev} AS DOUBLE), 0) AS delta_pct")


register("mom_same_month_ly",
         f"{W('analytic', extra=[_MONTHLY])} SELECT c.mes_ref, CAST(c.fat AS DOUBLE) AS faturamento, "
         f"CAST(p.fat AS DOUBLE) AS faturamento_ly, c.vendas, p.vendas AS vendas_ly, "
         f"{_delta_sql('c.fat', 'p.fat')} FROM monthly c LEFT JOIN monthly p "
         f"ON p.mes_ref = CAST(c.mes_ref - INTERVAL 12 MONTH AS DATE)")(
    lambda spark, d: C.mom_same_month_ly(lh(spark, d).analytic()))

register("yoy",
         f"{W('analytic', extra=[_YEARLY])} SELECT c.ano, CAST(c.fat AS DOUBLE) AS faturamento, "
         f"CAST(p.fat AS DOUBLE) AS faturamento_ly, c.vendas, p.vendas AS vendas_ly, "
         f"{_delta_sql('c.fat', 'p.fat')} FROM yearly c LEFT JOIN yearly p ON p.ano = c.ano - 1")(
    lambda spark, d: C.yoy(lh(spark, d).analytic()))

register("month_offset",
         f"{W('analytic', extra=[_MONTHLY])} SELECT c.mes_ref, CAST(c.fat AS DOUBLE) AS faturamento, "
         f"CAST(p.fat AS DOUBLE) AS faturamento_m_1, CAST(n.fat AS DOUBLE) AS faturamento_m_mais_1 "
         f"FROM monthly c LEFT JOIN monthly p ON p.mes_ref = CAST(c.mes_ref - INTERVAL 1 MONTH AS DATE) "
         f"LEFT JOIN monthly n ON n.mes_ref = CAST(c.mes_ref + INTERVAL 1 MONTH AS DATE)")(
    lambda spark, d: C.month_offset(lh(spark, d).analytic()))

register("last_year",
         f"{W('analytic', extra=[_DAILY])} SELECT c.data, CAST(c.fat AS DOUBLE) AS faturamento, "
         f"CAST(p.fat AS DOUBLE) AS faturamento_ly, c.vendas, p.vendas AS vendas_ly "
         f"FROM daily c LEFT JOIN daily p ON p.data = CAST(c.data - INTERVAL 12 MONTH AS DATE)")(
    lambda spark, d: C.last_year(lh(spark, d).analytic()))

register("delta_abs_pct",
         f"{W('analytic', 'ref')}, a AS (SELECT categoria, "
         f"SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) FILTER (WHERE data >= make_date(year(r), 1, 1) "
         f"AND data <= r) AS atual, "
         f"SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) FILTER (WHERE data >= make_date(year(r) - 1, 1, 1) "
         f"AND data <= CAST(r - INTERVAL 12 MONTH AS DATE)) AS anterior "
         f"FROM analytic, ref WHERE (data >= make_date(year(r), 1, 1) AND data <= r) OR "
         f"(data >= make_date(year(r) - 1, 1, 1) AND data <= CAST(r - INTERVAL 12 MONTH AS DATE)) "
         f"GROUP BY categoria) SELECT categoria, CAST(atual AS DOUBLE) AS faturamento_atual, "
         f"CAST(anterior AS DOUBLE) AS faturamento_ly, {_delta_sql('atual', 'anterior')} FROM a")(
    lambda spark, d: C.delta_abs_pct(lh(spark, d).analytic(), _ref(spark, d)))

register("running_mtd_ytd",
         f"{W('analytic', extra=[_DAILY])} SELECT data, CAST(fat AS DOUBLE) AS faturamento_dia, "
         f"CAST(SUM(fat) OVER (PARTITION BY year(data), month(data) ORDER BY data ROWS BETWEEN "
         f"UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS faturamento_mtd, "
         f"CAST(SUM(fat) OVER (PARTITION BY year(data) ORDER BY data ROWS BETWEEN UNBOUNDED "
         f"PRECEDING AND CURRENT ROW) AS DOUBLE) AS faturamento_ytd, vendas AS vendas_dia, "
         f"CAST(SUM(vendas) OVER (PARTITION BY year(data), month(data) ORDER BY data ROWS BETWEEN "
         f"UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS vendas_mtd, "
         f"CAST(SUM(vendas) OVER (PARTITION BY year(data) ORDER BY data ROWS BETWEEN UNBOUNDED "
         f"PRECEDING AND CURRENT ROW) AS BIGINT) AS vendas_ytd FROM daily")(
    lambda spark, d: C.running_mtd_ytd(lh(spark, d).analytic()))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: e.fn for k, e in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: e.sql for k, e in REGISTRY.items() if e.sql is not None}

# ============================================================================
# Sources and sinks
# ============================================================================


def _scratch(spark, d, name):
    return lh(spark, d).path(f"scratch/{name}")


def _source_fallback(spark, d):
    missing = _scratch(spark, d, "fresh_download_absent")
    df, origin = Ld.read_landing(spark, [(missing, ORIGIN_FRESH),
                                         (lh(spark, d).landing_path(), ORIGIN_EXISTING_FILE)])
    return B.bronze(df, origin).drop("_data_ingestao")


register("source_fallback",
         f"{W('bronze')} SELECT *, '{ORIGIN_EXISTING_FILE}' AS _arquivo_origem FROM bronze")(
    _source_fallback)

_EXPORT_HEADER = ";".join(f"Fato_MaisVendidos[{c}]" for c in LANDING_COLUMNS)


def _export(spark, d):
    return lh(spark, d).export_path()


def _sanitize_sql(c):
    return (f"COALESCE(replace(replace(replace(CAST({c} AS VARCHAR), ';', ','), chr(13), ' '), "
            f"chr(10), ' '), '')")


register("csv_export_sanitize",
         f"{W('bronze')} SELECT concat_ws(';', " + ", ".join(
             _sanitize_sql(f"strftime(data, '%Y-%m-%d')" if c == "data" else c)
             for c in LANDING_COLUMNS) + ") AS linha FROM bronze")(
    lambda spark, d: D.read_lines(spark, _export(spark, d), _EXPORT_HEADER))


def _landing_schema():
    from pyspark.sql.types import StructType
    return StructType.fromDDL(", ".join(f"{c} {LANDING_TYPES[c]}" for c in LANDING_COLUMNS))


def _csv_ingest(spark, d):
    good, _ = D.read_delimited(spark, _export(spark, d), _landing_schema())
    return good


_NULLIF_EMPTY = ", ".join(f"NULLIF({c}, '') AS {c}" if LANDING_TYPES[c] == "string" else c
                          for c in LANDING_COLUMNS)

register("csv_ingest", f"{W('bronze')} SELECT {_NULLIF_EMPTY} FROM bronze")(_csv_ingest)


def _csv_quarantine(spark, d):
    """Rows read and rows set apart, of an export with two damaged lines added."""
    path = _scratch(spark, d, "damaged_csv")
    damaged = spark.createDataFrame(
        [(_EXPORT_HEADER,), ("not-a-date" + ";" * (len(LANDING_COLUMNS) - 1),), ("2001-01-01;too;few",)],
        "value string")
    damaged.coalesce(1).write.mode("overwrite").text(path)
    good, bad = D.read_delimited(spark, [_export(spark, d), path], _landing_schema())
    counted = good.select(F.lit("good").alias("k")).unionByName(bad.select(F.lit("bad").alias("k")))
    return counted.agg(F.count(F.when(F.col("k") == "good", 1)).alias("registros"),
                       F.count(F.when(F.col("k") == "bad", 1)).alias("quarentena"))


register("csv_quarantine", f"{W('bronze')} SELECT count(*) AS registros, CAST(2 AS BIGINT) AS quarentena FROM bronze")(
    _csv_quarantine)


def _header_clean(spark, d):
    raw = spark.read.option("header", True).option("sep", ";").csv(_export(spark, d))
    return D.clean_header(raw)


register("header_clean",
         f"{W('bronze')} SELECT " + ", ".join(
             f"NULLIF(CAST({c} AS VARCHAR), '') AS {c}" for c in LANDING_COLUMNS) + " FROM bronze")(
    _header_clean)


def _zstd(spark, d):
    path = _scratch(spark, d, "silver_zstd")
    Wr.write_parquet(lh(spark, d).silver().drop("_data_processamento"), path, codec="zstd",
                     sort=["data", "posicao_ranking"], partitions=lh(spark, d).tasks(),
                     slices=lh(spark, d).slices())
    return spark.read.parquet(path)


register("parquet_zstd_roundtrip", f"{W('silver')} SELECT * FROM silver")(_zstd)

register("sorted_export",
         f"{W('bronze')} SELECT * FROM bronze ORDER BY data ASC NULLS FIRST, "
         f"posicao_ranking ASC NULLS FIRST")(
    lambda spark, d: B.select_contract(lh(spark, d).bronze())
    .orderBy(F.col("data").asc_nulls_first(), F.col("posicao_ranking").asc_nulls_first()))


def _table_roundtrip(spark, d):
    from vitrine.session import _RUN_ID
    name = f"prata_mais_vendidos_{_RUN_ID}"
    return Wr.save_table(lh(spark, d).silver().drop("_data_processamento"), name,
                         path=_scratch(spark, d, "table_prata")).drop("_data_processamento")


register("table_roundtrip", f"{W('silver')} SELECT * FROM silver")(_table_roundtrip)


def _multi_sink(spark, d):
    return Wr.write_all(lh(spark, d).silver().drop("_data_processamento"),
                        [("parquet", "parquet", _scratch(spark, d, "multi_parquet")),
                         ("csv", "csv", _scratch(spark, d, "multi_csv"))])


def _schema_guard(spark, d):
    """A guarded table, then a write with the same columns and one with another type."""
    from vitrine.session import _RUN_ID
    name, path = f"v{_RUN_ID}_dias_guardados", _scratch(spark, d, "guarded")
    days = lh(spark, d).silver().groupBy("data").agg(F.count(F.lit(1)).alias("registros"))
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    Wr.save_table(days, name, path)
    out = []
    for label, df in (("mesmo esquema", days), ("outro tipo", days.withColumn("registros", F.col("registros").cast("int")))):
        try:
            Wr.save_table(df, name, path, replace_schema=False)
            reason = None
        except ValueError as refused:
            reason = str(refused).replace(name, "tabela")
        held = spark.table(name).agg(F.sum("registros")).first()[0]  # what the table has after the try
        out.append((label, reason, held))
    return spark.createDataFrame(out, "tentativa string, motivo string, registros long")


register("schema_guard",
         f"{W('silver')} SELECT 'mesmo esquema' AS tentativa, NULL AS motivo, count(*) AS registros FROM silver "
         f"UNION ALL SELECT 'outro tipo', 'schema of tabela would change: struct<data:date,registros:bigint> -> "
         f"struct<data:date,registros:int>', count(*) FROM silver")(_schema_guard)

register("multi_sink",
         f"{W('silver')} SELECT 'parquet' AS destino, count(*) AS registros FROM silver "
         f"UNION ALL SELECT 'csv', count(*) FROM silver")(_multi_sink)


def _refresh(spark, d):
    base = _scratch(spark, d, "versioned_base")
    src = lh(spark, d).analytic(raw=True)
    Wr.refresh(src.filter(F.col("data") < F.lit(lh(spark, d).reference(raw=True).last_date)), base)
    Wr.refresh(src, base)  # the new drop replaces the base; metadata recomputed
    cur = Wr.read_current(spark, base)
    return Q.period_audit(cur).select("data_min", "data_max", "total_registros")


register("refresh_profile",
         f"{W('analytic_raw')} SELECT min(data) AS data_min, max(data) AS data_max, "
         f"count(*) AS total_registros FROM analytic_raw")(_refresh)


def _parse_updates(spark, d):
    path = _scratch(spark, d, "updates_json")
    U.updates_from_conversations(lh(spark, d).raw("conversations")).write.mode("overwrite").json(path)
    return U.parse_updates(spark.read.schema(U.UPDATE_SCHEMA).json(path))


register("parse_updates",
         f"SELECT conv_id * {U.TURN_ID_FACTOR} + turn AS update_id, "
         f"TIMESTAMP '{U.FEED_EPOCH}' + to_minutes(CAST(conv_id AS BIGINT)) + "
         f"to_seconds(CAST(turn AS BIGINT)) AS ts, conv_id AS chat_id, "
         f"CASE WHEN conv_id % {U.ANONYMOUS_EVERY} = 0 THEN 'Parceiro' "
         f"ELSE 'Cliente ' || CAST(conv_id AS VARCHAR) END AS first_name, text "
         f"FROM conversations WHERE role = 'user' AND text IS NOT NULL AND conv_id IS NOT NULL")(
    _parse_updates)

_SAMPLE_ORDER = ["data", "id_anuncio", *[c for c in LANDING_COLUMNS if c not in ("data", "id_anuncio")]]

register("sample_rows",
         f"{W('silver')} SELECT * FROM silver ORDER BY "
         + ", ".join(f"{c} ASC NULLS FIRST" for c in _SAMPLE_ORDER) + " LIMIT 10")(
    lambda spark, d: lh(spark, d).silver().drop("_data_processamento")
    .orderBy(*[F.col(c).asc_nulls_first() for c in _SAMPLE_ORDER]).limit(10))

# ============================================================================
# Taxonomy (derived from the data) and the fixed dictionary
# ============================================================================

register("taxonomy_flat",
         f"{W('silver')} SELECT DISTINCT categoria, subcategoria, marca FROM silver")(
    lambda spark, d: T.taxonomy_flat(lh(spark, d).silver()))

register("taxonomy_categories",
         f"{W('silver')} SELECT categoria, count(DISTINCT subcategoria) AS n_subcategorias "
         f"FROM silver GROUP BY categoria")(
    lambda spark, d: T.categories_summary(T.taxonomy_flat(lh(spark, d).silver())))

register("taxonomy_subcategories",
         f"{W('silver')}, f AS (SELECT DISTINCT categoria, subcategoria, marca FROM silver), "
         f"r AS (SELECT *, row_number() OVER (PARTITION BY categoria, subcategoria ORDER BY "
         f"marca ASC NULLS FIRST) AS rn FROM f) "
         f"SELECT categoria, subcategoria, count(marca) AS n_marcas, "
         f"string_agg(marca, ', ' ORDER BY rn) FILTER (WHERE rn <= {T.EXAMPLE_BRANDS}) AS exemplos "
         f"FROM r GROUP BY categoria, subcategoria")(
    lambda spark, d: T.subcategories_summary(T.taxonomy_flat(lh(spark, d).silver())))

register("taxonomy_profile",
         f"{W('silver')}, f AS (SELECT DISTINCT categoria, subcategoria, marca FROM silver) "
         f"SELECT count(DISTINCT categoria) AS n_categorias, "
         f"(SELECT count(*) FROM (SELECT DISTINCT categoria, subcategoria FROM f "
         f"WHERE categoria IS NOT NULL AND subcategoria IS NOT NULL)) AS n_subcategorias, "
         f"count(DISTINCT marca) AS n_marcas, count(*) AS n_entradas FROM f")(
    lambda spark, d: T.taxonomy_profile(T.taxonomy_flat(lh(spark, d).silver())))


def _fixed_pairs_sql():
    from vitrine.constants import TAXONOMY
    vals = ", ".join("('" + c.replace("'", "''") + "', '" + s.replace("'", "''") + "')"
                     for c, subs in TAXONOMY.items() for s in subs)
    return f"tax AS (SELECT * FROM (VALUES {vals}) v(categoria, subcategoria))"


def _coverage(spark, d):
    path = Dic.publish_dictionary(spark, _scratch(spark, d, "dicionario_json"))
    flat = Dic.taxonomy_flat(Dic.read_dictionary(spark, path))
    return T.coverage(lh(spark, d).silver(), flat, Dic.fixed_lexicon(spark))


def _fixed_words_sql():
    from vitrine.constants import SUBCATEGORY_KEYWORDS
    vals = ", ".join("(" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in (c, s)) + ")"
                     for _, c, s in SUBCATEGORY_KEYWORDS)
    return f"words AS (SELECT DISTINCT * FROM (VALUES {vals}) v(categoria, subcategoria))"


def _lacking(left, right):
    return (f"NOT EXISTS (SELECT 1 FROM {right} r WHERE r.categoria = {left}.categoria "
            f"AND r.subcategoria = {left}.subcategoria)")


register("taxonomy_coverage",
         f"{W('silver', extra=[_fixed_pairs_sql(), _fixed_words_sql()])} SELECT 'dados' AS lado, categoria, "
         f"subcategoria, count(*) AS registros FROM silver WHERE {_lacking('silver', 'tax')} GROUP BY ALL "
         f"UNION ALL SELECT 'dicionario', categoria, subcategoria, NULL FROM tax WHERE {_lacking('tax', 'words')} "
         f"UNION ALL SELECT 'lexico', categoria, subcategoria, NULL FROM words WHERE {_lacking('words', 'tax')}")(
    _coverage)

# ============================================================================
# Scalar rendering
# ============================================================================

register("format_date_br",
         f"{W('dim_calendar')} SELECT data, strftime(data, '%d/%m/%Y') AS data_br FROM dim_calendar")(
    lambda spark, d: lh(spark, d).dim_calendar().select("data",
                                                        Fm.format_date_br("data").alias("data_br")))


def _format_brl(spark, d):
    cat = M.by_keys(lh(spark, d).analytic(), _period("ytd")(spark, d), ["categoria"])
    return cat.select("categoria", "faturamento", "vendas",
                      Fm.format_brl("faturamento").alias("faturamento_txt"),
                      Fm.format_int_br("vendas").alias("vendas_txt"))


register("format_brl",
         f"{W('analytic', 'ref')}, c AS (SELECT categoria, {O.money_sum('fat_num')} AS faturamento, "
         f"CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas FROM analytic, ref "
         f"WHERE {O.period_where('ytd')} GROUP BY categoria) SELECT categoria, faturamento, vendas, "
         f"'R$ ' || translate(format('{{:,.2f}}', faturamento), ',.', '.,') AS faturamento_txt, "
         f"translate(format('{{:,.0f}}', CAST(vendas AS DOUBLE)), ',.', '.,') AS vendas_txt FROM c")(
    _format_brl)

register("strip_markup",
         "SELECT conv_id, turn, translate(text, '" + MARKUP_CHARS
         + "', '') AS texto_limpo FROM conversations")(
    lambda spark, d: lh(spark, d).raw("conversations").select(
        "conv_id", "turn", Fm.strip_markup("text").alias("texto_limpo")))


def _pipe(spark, d):
    from vitrine.operators.answers import pipe_table
    cube = M.period_cube(spark, lh(spark, d).analytic(), _ref(spark, d), lh(spark, d).range_index()).filter("gid = 0")
    return pipe_table(cube, "periodo",
                      [F.col("faturamento").desc_nulls_last(), F.col("categoria").asc_nulls_first(),
                       F.col("subcategoria").asc_nulls_first()],
                      ["categoria", "subcategoria", "faturamento", "vendas"])


def _pipe_sql():
    from vitrine.constants import PIPE_TABLE_ROWS
    cols = ["categoria", "subcategoria", "faturamento", "vendas"]
    header = " | ".join(cols)
    line = ("concat_ws(' | ', COALESCE(categoria, 'NULL'), COALESCE(subcategoria, 'NULL'), "
            "COALESCE(printf('%.2f', faturamento), 'NULL'), COALESCE(CAST(vendas AS VARCHAR), 'NULL'))")
    return (f"{_cube_ctes()}, r AS (SELECT *, row_number() OVER (PARTITION BY periodo ORDER BY "
            f"faturamento DESC NULLS LAST, categoria ASC NULLS FIRST, subcategoria ASC NULLS FIRST) "
            f"AS rn FROM cube WHERE gid = 0) SELECT periodo, '{header}' || chr(10) || "
            f"'{'-' * len(header)}' || chr(10) || string_agg({line}, chr(10) ORDER BY rn) AS tabela "
            f"FROM r WHERE rn <= {PIPE_TABLE_ROWS} GROUP BY periodo")


register("pipe_table", _pipe_sql())(_pipe)

# ============================================================================
# Question routing and answers
# ============================================================================


def _qn(spark, d):
    return R.normalize(lh(spark, d).questions())


register("match_entities", OR.MATCH_ENTITIES)(
    lambda spark, d: R.match_entities(_qn(spark, d), lh(spark, d).lexicon()))

register("glossary_lookup", OR.GLOSSARY_LOOKUP)(
    lambda spark, d: R.glossary_lookup(_qn(spark, d), Dic.fixed_glossary(spark)))

register("taxonomy_match", OR.TAXONOMY_MATCH)(
    lambda spark, d: R.taxonomy_match(_qn(spark, d), lh(spark, d).categories()))

register("resolve_period", OR.RESOLVE_PERIOD)(
    lambda spark, d: R.resolve_period(_qn(spark, d), _ref(spark, d)).select(
        "q_id", "kind", "periodo", "inicio", "fim", "p_ano", "p_mes", "period_status"))

register("route_questions", OR.ROUTE_QUESTIONS)(lambda spark, d: lh(spark, d).routed())

register("level_warning", OR.LEVEL_WARNING)(
    lambda spark, d: lh(spark, d).routed().filter(F.col("aviso").isNotNull())
    .select("q_id", "intent", "aviso"))

register("answer_questions", OR.ANSWER_QUESTIONS)(lambda spark, d: lh(spark, d).answers())

register("format_result_rows", OR.FORMAT_RESULT_ROWS)(
    lambda spark, d: A.format_result_rows(lh(spark, d).answers(), lh(spark, d).routed(),
                                          str(_ref(spark, d))))

# ============================================================================
# Streaming
# ============================================================================


def _stream_run(spark, d):
    """Run the message-loop stream once per input (two deliveries: the feed
    and a full replay) and return its output folder."""
    L = lh(spark, d)
    key = "stream_message_loop"
    if key not in L._paths:
        in_dir, out = _scratch(spark, d, "st_updates_in"), _scratch(spark, d, "st_routed")
        ckpt = _scratch(spark, d, "st_routed_ckpt")
        feed = U.updates_from_conversations(L.raw("conversations"))
        r = L.reference()
        router = R.Router(L.lexicon(), Dic.fixed_glossary(spark), L.categories(), L.dim_category(), r.last_date)
        base = J.Base(1, L.analytic(), r.last_date, r.rows, router, T.taxonomy_flat(L.silver()))
        parts = parallelism(spark)
        feed.write.mode("overwrite").json(f"{in_dir}/drop_0001")
        J.route_stream(spark, f"{in_dir}/*", out, ckpt, base, state_partitions=parts)
        feed.write.mode("overwrite").json(f"{in_dir}/drop_0002")  # a full replay of the feed
        J.route_stream(spark, f"{in_dir}/*", out, ckpt, base, state_partitions=parts)
        L._paths[key] = out
    return L._paths[key]


def _stream_route(spark, d):
    return J.read_routed(spark, _stream_run(spark, d))


def _stream_replies(spark, d):
    return J.read_committed(spark, _stream_run(spark, d), "replies").select(
        "q_id", "n_linhas", "resposta", "origem")


register("stream_route_questions", OR.STREAM_ROUTE_QUESTIONS)(_stream_route)
register("stream_replies", OR.STREAM_REPLIES)(_stream_replies)


def _stream_refresh(spark, d):
    L = lh(spark, d)
    in_dir, base = _scratch(spark, d, "st_drops"), _scratch(spark, d, "st_base")
    prof, ckpt = _scratch(spark, d, "st_profile"), _scratch(spark, d, "st_refresh_ckpt")
    landing = L.landing()
    last = L.reference(raw=True).last_date
    # two complete drops wait, and a third that its writer has not finished
    landing.filter(F.col("data") < F.lit(last)).write.mode("overwrite").parquet(f"{in_dir}/drop_0001")
    landing.write.mode("overwrite").parquet(f"{in_dir}/drop_0002")
    (landing.filter(F.col("data") == F.lit(last)).write.mode("overwrite")
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{in_dir}/drop_0003"))
    J.refresh_stream(spark, f"{in_dir}/*", base, prof, ckpt, landing.schema)
    return spark.read.parquet(prof).select("versao", "data_min", "data_max", "total_registros")


register("stream_refresh",
         f"{W('analytic_raw')} SELECT 2 AS versao, min(data) AS data_min, max(data) AS data_max, "
         f"count(*) AS total_registros FROM analytic_raw")(
    _stream_refresh)


def _stream_live_base(spark, d):
    """The loop under a base that is replaced while it runs: the updates of even
    conversations come after the first drop, the others after the second."""
    L = lh(spark, d)
    name = lambda part: _scratch(spark, d, f"st_live_{part}")
    landing, feed = L.landing(), U.updates_from_conversations(L.raw("conversations"))
    last = L.reference(raw=True).last_date
    base = J.LiveBase(spark, name("base"))
    steps = [(landing.filter(F.col("data") < F.lit(last)), 0), (landing, 1)]
    for n, (drop, odd) in enumerate(steps, 1):
        drop.write.mode("overwrite").parquet(f"{name('drops')}/drop_{n:04d}")
        J.refresh_stream(spark, f"{name('drops')}/*", name("base"), name("profile"), name("base_ckpt"), landing.schema)
        (feed.where(F.pmod(F.col("message.chat.id"), F.lit(2)) == odd)
         .write.mode("overwrite").json(f"{name('in')}/drop_{n:04d}"))
        J.route_stream(spark, f"{name('in')}/*", name("out"), name("ckpt"), base,
                       state_partitions=parallelism(spark))
    return J.read_committed(spark, name("out"), "replies").select("q_id", "versao", "data_ref")


register("stream_live_base",
         f"{W('analytic_raw')}, b AS (SELECT max(data) AS ultima FROM analytic_raw), "
         "v AS (SELECT 0 AS resto, 1 AS versao, max(data) AS data_ref FROM analytic_raw, b WHERE data < ultima "
         "UNION ALL SELECT 1, 2, ultima FROM b) "
         "SELECT DISTINCT CAST(conv_id * 4294967296 + turn AS BIGINT) AS q_id, versao, data_ref FROM conversations "
         "JOIN v ON ((conv_id % 2) + 2) % 2 = resto WHERE role = 'user' AND text IS NOT NULL")(_stream_live_base)


def _stream_dedup(spark, d):
    L = lh(spark, d)
    in_dir, out = _scratch(spark, d, "st_events_in"), _scratch(spark, d, "st_events_out")
    ckpt = _scratch(spark, d, "st_events_ckpt")
    events = L.raw("events")
    events.write.mode("overwrite").parquet(f"{in_dir}/drop_0001")
    parts = parallelism(spark)
    J.dedup_stream(spark, f"{in_dir}/*", out, ckpt, events.schema, state_partitions=parts)
    events.write.mode("overwrite").parquet(f"{in_dir}/drop_0002")  # replayed delivery
    J.dedup_stream(spark, f"{in_dir}/*", out, ckpt, events.schema, state_partitions=parts)
    return J.read_committed(spark, out, "rows").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("eventos"), F.count_distinct("event_id").alias("ids"))


register("stream_dedup_events",
         "SELECT event_type, count(*) AS eventos, count(DISTINCT event_id) AS ids FROM events "
         "GROUP BY event_type")(_stream_dedup)

register("yoy_by_category",
         f"{W('analytic')}, y AS (SELECT CAST(year(data) AS INTEGER) AS periodo_ref, categoria, "
         f"SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, CAST(SUM(qtd_vendas_num) AS BIGINT) AS vendas "
         f"FROM analytic GROUP BY ALL) SELECT c.periodo_ref, c.categoria, "
         f"CAST(c.fat AS DOUBLE) AS faturamento, CAST(p.fat AS DOUBLE) AS faturamento_anterior, "
         f"c.vendas, p.vendas AS vendas_prev, {_delta_sql('c.fat', 'p.fat')} FROM y c LEFT JOIN y p "
         f"ON p.periodo_ref = c.periodo_ref - 1 AND p.categoria IS NOT DISTINCT FROM c.categoria")(
    lambda spark, d: C.compare(lh(spark, d).analytic(), "year", -1, ("categoria",)))

# FIXED VALUES: the question shown with the registered ad-hoc reply.
ADHOC_QUESTION = "Quais marcas mais venderam?"
ADHOC_USER = "Parceiro"


def _adhoc_reply(spark, d):
    res = REGISTRY["adhoc_sql"].fn(spark, d)
    return A.format_result(res, [F.col("vendas").desc(), F.col("marca").asc()], ADHOC_QUESTION,
                           ADHOC_USER, str(_ref(spark, d)))


def _adhoc_reply_sql():
    from vitrine import constants as K
    q = OR.q
    n = K.BULLET_ROWS
    num = "translate(format('{{:,.0f}}', CAST({c} AS DOUBLE)), ',.', '.,')"
    bullet = ("'• ' || concat_ws(' | ', '*Marca:* ' || COALESCE(NULLIF(CAST(marca AS VARCHAR), ''), '-'), "
              f"'*Vendas:* ' || {num.format(c='vendas')}, '*Produtos:* ' || {num.format(c='produtos')})")
    head = q(K.REPLY_HEADER.format(user=ADHOC_USER) + K.REPLY_QUESTION.format(question=ADHOC_QUESTION))
    foot = K.REPLY_FOOTER.split("{ref}")
    footer = f"{q(foot[0])} || (SELECT CAST(max(data) AS VARCHAR) FROM analytic) || {q(foot[1])}"
    adhoc = ADHOC_SQL.replace("fato_ml", "analytic").replace("{min_units}", "10")
    return (f"{W('analytic')}, res AS ({adhoc}), top AS (SELECT *, row_number() OVER (ORDER BY "
            f"vendas DESC NULLS LAST, marca ASC NULLS FIRST) AS rn FROM res), "
            f"b AS (SELECT string_agg({bullet}, chr(10) ORDER BY rn) AS bullets FROM top WHERE rn <= {n}), "
            f"c AS (SELECT count(*) AS n_linhas FROM res) "
            f"SELECT n_linhas, CASE WHEN n_linhas = 0 THEN {q(K.REPLY_EMPTY.format(user=ADHOC_USER))} "
            f"ELSE {head} || bullets || CASE WHEN n_linhas > {n} THEN chr(10) || '_... e mais ' || "
            f"CAST(n_linhas - {n} AS VARCHAR) || ' registros encontrados._' ELSE '' END || {footer} END "
            f"AS resposta FROM c, b")


register("format_adhoc_reply", _adhoc_reply_sql())(_adhoc_reply)


def _dict_replies(spark, d):
    L = lh(spark, d)
    r = L.reference()
    return A.dictionary_replies(L.routed(), T.taxonomy_flat(L.silver()), str(r.last_date), r.rows)


register("format_dictionary_replies", OR.DICTIONARY_REPLIES)(_dict_replies)


# Parity with the chat service, which answers from the raw file (no trim,
# dedup or defaults): NULL categories and duplicate rows show up here.
def _raw_period(kind):
    def get(spark, d):
        return resolve(kind, lh(spark, d).reference(raw=True).last_date)
    return get


register("ranking_categories_raw", _by_keys_sql("ytd", ["categoria"], layer="analytic_raw"))(
    lambda spark, d: M.ranking_categories(lh(spark, d).analytic(raw=True), _raw_period("ytd")(spark, d)))

register("ranking_products_top5_raw",
         _by_keys_sql("ytd", M.PRODUCT_KEYS, n=5, units_first=True, layer="analytic_raw"))(
    lambda spark, d: M.ranking_products(lh(spark, d).analytic(raw=True), _raw_period("ytd")(spark, d)))

# ============================================================================
# Star-schema SQL over the gold tables (what a BI model queries)
# ============================================================================
STAR_SQL = """
SELECT c.categoria, d.ano, d.trimestre,
       CAST(SUM(TRY_CAST(f.faturamento AS DECIMAL(28,2))) AS DOUBLE) AS faturamento,
       CAST(SUM(f.qtd_vendas) AS BIGINT) AS vendas,
       COUNT(DISTINCT f.sk_produto) AS produtos,
       CAST(SUM(CASE WHEN d.is_fim_semana THEN TRY_CAST(f.faturamento AS DECIMAL(28,2)) END)
            AS DOUBLE) AS faturamento_fim_semana
FROM ouro_fato_vendas f
JOIN ouro_dim_calendario d ON f.data = d.data
LEFT JOIN ouro_dim_categoria c ON f.sk_categoria = c.sk_categoria
GROUP BY c.categoria, d.ano, d.trimestre
"""


def _star(spark, d):
    from vitrine.session import _RUN_ID
    prefix = f"v{_RUN_ID}_"
    lh(spark, d).register_views(prefix)
    sql = STAR_SQL
    for name in lh(spark, d).VIEW_NAMES:
        sql = sql.replace(f" {name} ", f" {prefix}{name} ")
    return spark.sql(sql)


register("star_sales_by_quarter",
         f"{W('fact', 'dim_calendar')} " + STAR_SQL.replace("ouro_fato_vendas", "fact")
         .replace("ouro_dim_calendario", "dim_calendar").replace("ouro_dim_categoria", "dim_category"))(
    _star)

"""Gold: calendar, category and product dimensions and the sales fact."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vitrine.constants import (FACT_COLUMNS, MONTH_NAMES, PRODUCT_COLUMNS, WEEKDAY_NAMES,
                               WEEKEND_DAYS)
from vitrine.operators.keys import broadcast_if_small, dense_key
from vitrine.session import held


def _name_map(names: list[str]):
    return F.create_map(*[x for i, n in enumerate(names, 1) for x in (F.lit(i), F.lit(n))])


def dim_calendar(silver: DataFrame) -> DataFrame:
    """Dates present in silver (gaps stay gaps) with their attributes."""
    d = F.col("data")
    return (silver.select("data").distinct().select(
        d,
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.dayofmonth(d).alias("dia"),
        F.date_format(d, "yyyy-MM").alias("ano_mes"),
        _name_map(MONTH_NAMES)[F.month(d)].alias("nome_mes"),
        F.quarter(d).alias("trimestre"),
        _name_map(WEEKDAY_NAMES)[F.dayofweek(d)].alias("dia_semana"),
        F.dayofweek(d).alias("dia_semana_num"),
        F.when(F.dayofweek(d).isin(*WEEKEND_DAYS), True).otherwise(False).alias("is_fim_semana"),
        F.weekofyear(d).alias("semana_do_ano"),
    ))


def dim_category(silver: DataFrame) -> DataFrame:
    """Distinct (categoria, subcategoria) with a dense key in name order."""
    keyed = dense_key(silver, ["categoria", "subcategoria"], "sk_categoria")
    return keyed.select("sk_categoria", "categoria", "subcategoria")


def latest_per_listing(silver: DataFrame) -> DataFrame:
    """Most recent silver row per listing (the WindowGroupLimit keeps only the
    top row per listing in each map task before the shuffle)."""
    w = Window.partitionBy("id_anuncio").orderBy(F.col("data").desc_nulls_last())
    return (silver.withColumn("_vx_rn", F.row_number().over(w))
            .filter("_vx_rn = 1").select(*PRODUCT_COLUMNS))


def dim_product(silver: DataFrame, passes: int = 1) -> DataFrame:
    """Latest attributes per listing with a dense key in listing-id order. In several
    ``passes``, each over the listings of one hash, less is shuffled at a time."""
    from vitrine.operators.keys import ordered_index
    one = F.pmod(F.xxhash64("id_anuncio"), F.lit(passes))
    latest = (latest_per_listing(silver) if passes == 1 else reduce(DataFrame.unionByName, [
        held(latest_per_listing(silver.filter(one == i))) for i in range(passes)]))
    keyed = ordered_index(latest, [F.col("id_anuncio").asc_nulls_first()], "sk_produto")
    return keyed.select("sk_produto", *PRODUCT_COLUMNS)


def fact_sales(silver: DataFrame, dim_cat: DataFrame, dim_prod: DataFrame) -> DataFrame:
    """Star-key resolution: left joins to the dimensions, then narrow/rename.

    The category dimension is broadcast after a size check; the product
    dimension grows with the listings, so its join is left to the planner
    (shuffle join, with AQE splitting a hot listing). As in the source, a NULL
    listing id finds no product key."""
    cat = broadcast_if_small(dim_cat.select("sk_categoria", "categoria", "subcategoria"))
    prod = dim_prod.select("sk_produto", "id_anuncio")
    return (silver.join(cat, on=["categoria", "subcategoria"], how="left")
            .join(prod, on=["id_anuncio"], how="left")
            .select("data", "sk_produto", "sk_categoria", "posicao_ranking",
                    F.col("qtd_vendas_estimadas_dia").alias("qtd_vendas"),
                    F.col("faturamento_estimado_dia").alias("faturamento"),
                    "preco_atual", "preco_original", "desconto_pct", "parcelamento",
                    "tipo_dado", "ano_mes")
            .select(*FACT_COLUMNS))


def analytic_from_silver(silver: DataFrame) -> DataFrame:
    """The 14-column answer table over cleaned data."""
    return silver.select(
        "data", "ano", "mes", "ano_mes", "posicao_ranking", "categoria", "subcategoria",
        "titulo_produto", "marca",
        F.col("qtd_vendas_estimadas_dia").alias("qtd_vendas_num"),
        F.col("faturamento_estimado_dia").alias("fat_num"),
        F.col("preco_atual").alias("preco_num"),
        "is_full", "frete_gratis")


def raw_money(c: str):
    """Money conversion of the chat service: no trim, NULL when not a number."""
    return F.translate(F.translate(F.col(c), ".", ""), ",", ".").try_cast("double")


def analytic_from_raw(landing: DataFrame) -> DataFrame:
    """The 14-column answer table as the chat service builds it: straight from
    the raw file, with safe conversions only (no trim, dedup or defaults)."""
    money = raw_money
    return landing.select(
        "data", "ano", "mes", "ano_mes", "posicao_ranking", "categoria", "subcategoria",
        "titulo_produto", "marca",
        F.col("qtd_vendas_estimadas_dia").try_cast("int").alias("qtd_vendas_num"),
        money("faturamento_estimado_dia").alias("fat_num"),
        money("preco_atual").alias("preco_num"),
        "is_full", "frete_gratis")

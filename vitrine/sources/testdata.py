"""The landing file derived from the driver's TPC-H-style tables.

One landing row per ``lineitem`` row (the "listing per day" shape), built with
plain expressions that DuckDB reproduces exactly, so every derived query has a
SQL oracle. ``posicao_ranking`` is the daily best-seller position, computed
with the skew-safe ordered index (a hot day is split across tasks).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.formatting import br_number_text
from vitrine.operators.keys import ordered_index
from vitrine.operators.slices import Slice

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]

# FIXED VALUES: fixture conventions (category NULLed for one part type, padded
# listing id to exercise trimming, data-type labels by line status).
NULL_CATEGORY_TYPE = "ECONOMY"
LISTING_PREFIX = " MLB"
LISTING_SUFFIX = " "
IMAGE_PREFIX = "img/"
PRODUCT_PREFIX = "item/"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def listing_day(spark: SparkSession, sf_dir: str, part_of: Slice | None = None,
                num_partitions: int | None = None) -> DataFrame:
    """Landing rows: 25 contract columns + the ignored ``produto`` column. Ranks are
    those of whole days, so a slice of days gives the same rows as the whole."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_shipdate").cast("date").alias("l_shipdate"))
    if part_of is not None:
        li = part_of.of(li, "l_shipdate")
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    # nation is the fixed 25-row TPC-H table: a proven size bound for broadcast.
    nation = F.broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))

    # part / supplier grow with the scale factor: the planner picks broadcast
    # or shuffle from their size; AQE splits a hot part key if one appears.
    rows = (li.join(part, li.l_partkey == part.p_partkey)
            .join(supplier, li.l_suppkey == supplier.s_suppkey)
            .join(nation, supplier.s_nationkey == nation.n_nationkey))

    # Rank first, on the raw joined columns (cheap to sample, shuffle and
    # checkpoint); the text formatting runs once, after the ranking.
    raw = rows.select(
        F.col("l_shipdate").alias("data"), "l_extendedprice", "l_orderkey",
        "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "p_name", "p_brand", "p_type", "p_size", "p_retailprice",
        "s_name", "n_name")
    ranked = ordered_index(
        raw,
        [F.col("l_extendedprice").desc_nulls_last(), F.col("l_orderkey").asc_nulls_first(),
         F.col("l_linenumber").asc_nulls_first(), F.col("l_partkey").asc_nulls_first(),
         F.col("l_suppkey").asc_nulls_first()],
        "_rank", by=["data"], num_partitions=num_partitions)
    data = F.col("data")
    landing = ranked.select(
        data,
        F.year(data).alias("ano"),
        F.month(data).alias("mes"),
        F.date_format(data, "yyyy-MM").alias("ano_mes"),
        F.col("_rank").cast("int").alias("posicao_ranking"),
        F.nullif(F.col("p_type"), F.lit(NULL_CATEGORY_TYPE)).alias("categoria"),
        F.try_element_at(F.split("p_name", " "), F.lit(2)).alias("subcategoria"),
        F.concat(F.lit(LISTING_PREFIX), F.col("l_partkey").cast("string"),
                 F.lit(LISTING_SUFFIX)).alias("id_anuncio"),
        F.col("p_name").alias("titulo_produto"),
        F.col("p_brand").alias("marca"),
        br_number_text(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0))
                       ).alias("preco_atual"),
        br_number_text("p_retailprice").alias("preco_original"),
        F.round(F.col("l_discount") * 100).cast("int").alias("desconto_pct"),
        F.concat(F.col("l_linenumber").cast("string"), F.lit("x")).alias("parcelamento"),
        F.col("l_quantity").cast("int").cast("string").alias("qtd_vendas_estimadas_dia"),
        br_number_text("l_extendedprice").alias("faturamento_estimado_dia"),
        br_number_text(F.lit(1.0) + F.col("l_tax") * 50).alias("avaliacao_nota"),
        F.col("p_size").alias("qtd_avaliacoes"),
        (F.col("l_linestatus") == "F").cast("bigint").alias("is_full"),
        (F.col("l_returnflag") == "N").cast("bigint").alias("frete_gratis"),
        F.col("s_name").alias("loja_oficial"),
        F.col("n_name").alias("reputacao_vendedor"),
        F.concat(F.lit(IMAGE_PREFIX), F.col("l_partkey").cast("string")).alias("url_imagem"),
        F.concat(F.lit(PRODUCT_PREFIX), F.col("l_partkey").cast("string")).alias("url_produto"),
        F.when(F.col("l_linestatus") == "F", F.lit("Oficial")).otherwise(F.lit("Sintetico"))
        .alias("tipo_dado"),
        F.col("p_name").alias("produto"),  # extra column of the file, dropped by bronze
    )
    from vitrine.constants import LANDING_COLUMNS
    return landing.select(*LANDING_COLUMNS, "produto")

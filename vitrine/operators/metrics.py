"""Sales questions over the answer table: totals, rankings, shares, cube.

Money is summed as DECIMAL(28,2) (exact and order-independent, so totals are
the same whatever the partitioning) and returned as double.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitrine.functions.parsing import money_exact
from vitrine.operators.periods import Period, in_period, periods_table
from vitrine.operators.ranges import period_ranges, range_index, range_sums


def money_sum(c: str) -> Column:
    return F.sum(money_exact(c))


def money_total(c: str) -> Column:
    return money_sum(c).cast("double")


def money_total_expr(col: Column) -> Column:
    return F.sum(money_exact(col)).cast("double")


def units_total(c: str) -> Column:
    return F.sum(F.col(c)).cast("long")


def totals(df: DataFrame, period: Period) -> DataFrame:
    """Period total; over no rows it is one row of NULLs (a global aggregate)."""
    return (in_period(df, period)
            .agg(money_total("fat_num").alias("faturamento_total"),
                 units_total("qtd_vendas_num").alias("total_pedidos"))
            .select(F.lit(period.label).alias("periodo"), "faturamento_total", "total_pedidos"))


def by_keys(df: DataFrame, period: Period, keys: Sequence[str], where: Column | None = None,
            n: int | None = None, units_first: bool = False) -> DataFrame:
    """Sums per ``keys`` in ``period``, ordered by revenue (ties by keys), top ``n``."""
    rows = in_period(df, period)
    if where is not None:
        rows = rows.filter(where)
    measures = [money_total("fat_num").alias("faturamento"),
                units_total("qtd_vendas_num").alias("vendas")]
    agg = rows.groupBy(*keys).agg(*measures)
    cols = ["vendas", "faturamento"] if units_first else ["faturamento", "vendas"]
    out = agg.select(F.lit(period.label).alias("periodo"), *keys, *cols)
    ordered = out.orderBy(F.col("faturamento").desc_nulls_last(),
                          *[F.col(k).asc_nulls_first() for k in keys])
    return ordered.limit(n) if n else ordered


def category_period(df, period, categoria):
    return by_keys(df, period, ["categoria"], F.col("categoria") == categoria)


def subcategory_period(df, period, categoria, subcategoria):
    return by_keys(df, period, ["categoria", "subcategoria"],
                   (F.col("categoria") == categoria) & (F.col("subcategoria") == subcategoria))


def subcategory_any_parent(df, period, subcategoria):
    return by_keys(df, period, ["categoria", "subcategoria"], F.col("subcategoria") == subcategoria)


def brand_period(df, period, term):
    """Brand (or product) filter by case-insensitive containment."""
    return by_keys(df, period, ["marca"], F.col("marca").ilike(f"%{term}%"))


def product_period(df, period, term):
    """Products whose title contains ``term`` (case-insensitive), with brand."""
    return by_keys(df, period, ["titulo_produto", "marca"], F.col("titulo_produto").ilike(f"%{term}%"))


def ranking_categories(df, period):
    return by_keys(df, period, ["categoria"])


def ranking_subcategories(df, period, n=5):
    return by_keys(df, period, ["categoria", "subcategoria"], n=n)


PRODUCT_KEYS = ["titulo_produto", "marca", "categoria", "subcategoria"]


def ranking_products(df, period, n=5):
    return by_keys(df, period, PRODUCT_KEYS, n=n, units_first=True)


def top_product_per_category(df: DataFrame, period: Period) -> DataFrame:
    """Best product by revenue inside each category (ties by product keys).
    row_number = 1 per category: the partial WindowGroupLimit keeps one row per
    category and map task before the exchange."""
    agg = (in_period(df, period).groupBy(*PRODUCT_KEYS)
           .agg(money_sum("fat_num").alias("_fat"), units_total("qtd_vendas_num").alias("vendas")))
    w = Window.partitionBy("categoria").orderBy(
        F.col("_fat").desc_nulls_last(), F.col("titulo_produto").asc_nulls_first(),
        F.col("marca").asc_nulls_first(), F.col("subcategoria").asc_nulls_first())
    return (agg.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
            .select(F.lit(period.label).alias("periodo"), "categoria", "subcategoria",
                    "titulo_produto", "marca", F.col("_fat").cast("double").alias("faturamento"),
                    "vendas"))


def average_price(df: DataFrame, period: Period, keys: Sequence[str] = ("categoria",)) -> DataFrame:
    """Revenue per unit (sum of revenue / sum of units) and the plain mean of
    the listed price."""
    agg = (in_period(df, period).groupBy(*keys)
           .agg(money_sum("fat_num").alias("_fat"), F.sum("qtd_vendas_num").alias("_qtd"),
                money_sum("preco_num").alias("_preco"), F.count("preco_num").alias("_npreco")))
    return agg.select(
        F.lit(period.label).alias("periodo"), *keys,
        F.try_divide(F.col("_fat").cast("double"), F.col("_qtd").cast("double")).alias("preco_medio"),
        F.try_divide(F.col("_preco").cast("double"), F.col("_npreco").cast("double"))
        .alias("preco_medio_anuncio"))


def flag_share(df: DataFrame, period: Period, flag: str, prefix: str,
               keys: Sequence[str] = ("categoria",)) -> DataFrame:
    """Share of revenue, units and rows where ``flag`` is true."""
    on = F.col(flag)
    agg = (in_period(df, period).groupBy(*keys).agg(
        F.sum(F.when(on, money_exact("fat_num"))).alias("_fat_on"),
        money_sum("fat_num").alias("_fat"),
        F.sum(F.when(on, F.col("qtd_vendas_num"))).alias("_qtd_on"),
        F.sum("qtd_vendas_num").alias("_qtd"),
        F.count(F.when(on, F.lit(1))).alias("_n_on"),
        F.count(F.lit(1)).alias("_n")))

    def share(a, b):
        return F.try_divide(F.coalesce(F.col(a), F.lit(0)).cast("double"), F.col(b).cast("double"))
    return agg.select(F.lit(period.label).alias("periodo"), *keys,
                      share("_fat_on", "_fat").alias(f"{prefix}_faturamento"),
                      share("_qtd_on", "_qtd").alias(f"{prefix}_vendas"),
                      share("_n_on", "_n").alias(f"{prefix}_linhas"))


def full_share(df, period):
    return flag_share(df, period, "is_full", "share_full")


def free_shipping_share(df, period):
    return flag_share(df, period, "frete_gratis", "share_frete_gratis")


def lookup_subcategory(df: DataFrame, term: str) -> DataFrame:
    """First (categoria, subcategoria) whose subcategory contains ``term``
    (case-insensitive), in name order."""
    return (df.filter(F.col("subcategoria").ilike(f"%{term}%"))
            .select("categoria", "subcategoria").distinct()
            .orderBy(F.col("categoria").asc_nulls_first(), F.col("subcategoria").asc_nulls_first())
            .limit(1))


def period_cube(spark: SparkSession, df: DataFrame, ref, index: DataFrame | None = None) -> DataFrame:
    """All standard periods x (total, category, category+subcategory) in one pass.

    Each period is a few intervals of the range index (``index``, or built from
    ``df``), matched by an equi-join; a rollup then gives every level, told apart
    by ``gid`` (0 = category+subcategory, 1 = category, 3 = period total)."""
    index = index if index is not None else range_index(df)
    matched = range_sums(index, period_ranges(periods_table(spark, ref), "periodo"), "periodo",
                         ["categoria", "subcategoria"])
    cube = (matched.rollup("periodo", "categoria", "subcategoria")
            .agg(F.sum("fat").cast("double").alias("faturamento"),
                 F.sum("qtd").cast("long").alias("vendas"),
                 F.grouping("periodo").alias("_gp"),
                 (F.grouping("categoria") * 2 + F.grouping("subcategoria")).cast("int").alias("gid")))
    return cube.filter("_gp = 0").select("periodo", "categoria", "subcategoria", "gid",
                                         "faturamento", "vendas")


def adhoc_sql(spark: SparkSession, df: DataFrame, sql: str, view: str = "fato_ml",
              args: dict | None = None) -> DataFrame:
    """Caller-written SQL over the answer table registered as a view; values
    are passed as named parameters, never pasted into the text."""
    df.createOrReplaceTempView(view)
    return spark.sql(sql, args=args or {})

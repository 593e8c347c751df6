"""Taxonomy, lexicon and question corpus derived from the data.

The data dictionary describes the categories present in the base. Here it is
rebuilt from the cleaned rows (so it grows with them): a flat table of
(categoria, subcategoria, marca), per-level summaries, and a keyword lexicon
(lower-cased names) that is appended after the fixed lexicon's priorities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


EXAMPLE_BRANDS = 3
DATA_LEXICON_BASE = 100_000  # data keywords rank after every fixed keyword


def taxonomy_flat(silver: DataFrame) -> DataFrame:
    return silver.select("categoria", "subcategoria", "marca").distinct()


def categories_summary(flat: DataFrame) -> DataFrame:
    """Categories with their number of subcategories."""
    return (flat.select("categoria", "subcategoria").distinct().groupBy("categoria")
            .agg(F.count(F.lit(1)).alias("n_subcategorias")))


def subcategories_summary(flat: DataFrame, n_examples: int = EXAMPLE_BRANDS) -> DataFrame:
    """Subcategories with brand count and the first brands in name order.
    Only ``n_examples`` brands per subcategory are collected (row_number
    filter first), never the whole brand list of a group."""
    w = Window.partitionBy("categoria", "subcategoria").orderBy(F.col("marca").asc_nulls_first())
    ranked = flat.withColumn("_rn", F.row_number().over(w))
    counts = flat.groupBy("categoria", "subcategoria").agg(F.count("marca").alias("n_marcas"))
    examples = (ranked.filter(F.col("_rn") <= n_examples)
                .groupBy("categoria", "subcategoria")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_rn", "marca"))),
                                              lambda s: s["marca"]), ", ").alias("exemplos")))
    return counts.join(examples, ["categoria", "subcategoria"], "left")


def taxonomy_profile(flat: DataFrame) -> DataFrame:
    return flat.agg(F.countDistinct("categoria").alias("n_categorias"),
                    F.count_distinct(F.col("categoria"), F.col("subcategoria")).alias("n_subcategorias"),
                    F.countDistinct("marca").alias("n_marcas"),
                    F.count(F.lit(1)).alias("n_entradas"))


def data_lexicon(dim_category: DataFrame) -> DataFrame:
    """Keywords from the data's own names. A subcategory name shared by several
    categories has no fixed parent (NULL), like the shared names of the fixed
    lexicon. Priorities follow the dense category key (name order)."""
    subs = (dim_category.groupBy("subcategoria")
            .agg(F.min("sk_categoria").alias("_k"), F.count_distinct("categoria").alias("_n"),
                 F.min("categoria").alias("_parent"))
            .select((F.lit(DATA_LEXICON_BASE) + F.col("_k")).cast("int").alias("priority"),
                    F.lower("subcategoria").alias("keyword"),
                    F.when(F.col("_n") == 1, F.col("_parent")).alias("categoria"),
                    F.col("subcategoria"), F.lit("subcategoria").alias("nivel")))
    cats = (dim_category.groupBy("categoria").agg(F.min("sk_categoria").alias("_k"))
            .select((F.lit(2 * DATA_LEXICON_BASE) + F.col("_k")).cast("int").alias("priority"),
                    F.lower("categoria").alias("keyword"), F.col("categoria"),
                    F.lit(None).cast("string").alias("subcategoria"),
                    F.lit("categoria").alias("nivel")))
    return subs.unionByName(cats).filter(F.col("keyword").isNotNull() & (F.col("keyword") != ""))


def lexicon(spark, dim_category: DataFrame) -> DataFrame:
    """Fixed lexicon first (declaration order), then the data's names."""
    from vitrine.sources.dictionary import fixed_lexicon
    return fixed_lexicon(spark).unionByName(data_lexicon(dim_category))


def coverage(silver: DataFrame, taxonomy_pairs: DataFrame, lexicon_rows: DataFrame) -> DataFrame:
    """(categoria, subcategoria) pairs that one side has and the other lacks, by
    left anti joins of pre-aggregated pairs. ``lado``: 'dados' (pairs of the data
    that the dictionary lacks, with their row counts), 'dicionario' (pairs that no
    keyword leads to) and 'lexico' (keyword pairs that the dictionary lacks)."""
    key = ["categoria", "subcategoria"]
    pairs = silver.groupBy(*key).agg(F.count(F.lit(1)).alias("registros"))
    known = taxonomy_pairs.select(*key).distinct()
    words = lexicon_rows.where(F.col("nivel") == "subcategoria").select(*key).distinct()

    def only(left: DataFrame, right: DataFrame, side: str, rows) -> DataFrame:
        return left.join(right, key, "left_anti").select(F.lit(side).alias("lado"), *key, rows.alias("registros"))

    none = F.lit(None).cast("long")
    return (only(pairs, known, "dados", F.col("registros"))
            .unionByName(only(known, words, "dicionario", none)).unionByName(only(words, known, "lexico", none)))


# ----------------------------------------------------------------------------
# Question corpus
# ----------------------------------------------------------------------------
# FIXED VALUES: question templates filled with the data's names and dates.
PAIR_TEMPLATES = [
    ("quanto vendeu a subcategoria ", "sub", " no mtd?"),
    ("qual o faturamento da categoria ", "cat", " hoje?"),
    ("vendas de ", "sub", " ontem"),
    ("qual o total de ", "cat", " no ytd"),
    ("quais as subcategorias de ", "cat", ""),
]
DATE_TEMPLATES = [
    ("qual o faturamento total em ", "br", "?"),
    ("ranking das categorias em ", "iso", ""),
]
FIXED_QUESTIONS = [
    "quais são as categorias?",
    "ranking de subcategorias no mtd",
    "quais os produtos mais vendidos no ytd",
    "qual a data mais recente da base?",
    "o que é mtd",
    "yoy",
    "faturamento total de ontem",
    "quanto vendeu a categoria de smartphones hoje?",
    "vendas da subcategoria promo no ano passado",
    "total vendido em 31/02/2001",
    "oi",
    "o que é isso? o que é mtd",
    "bom dia, o que é bom?\no que é yoy",
]
QID_CONVERSATION_FACTOR = 1 << 32  # turns of any number keep ids of their own
QID_PAIR_BASE = 10_000_000_000
QID_DATE_BASE = 20_000_000_000
QID_FIXED_BASE = 30_000_000_000


def questions(conversations: DataFrame, dim_category: DataFrame, dim_calendar: DataFrame,
              spark) -> DataFrame:
    """Questions = user turns of the conversations table, plus questions
    generated from every category pair and every calendar date, plus a few
    fixed phrasings. Columns: q_id, user_name, text."""
    conv = (conversations.filter((F.col("role") == "user") & F.col("text").isNotNull())
            .select((F.col("conv_id") * QID_CONVERSATION_FACTOR + F.col("turn")).alias("q_id"),
                    F.concat(F.lit("Cliente "), F.col("conv_id").cast("string")).alias("user_name"),
                    F.col("text")))
    names = {"sub": F.lower("subcategoria"), "cat": F.lower("categoria")}
    pair_q = None
    for i, (pre, what, post) in enumerate(PAIR_TEMPLATES):
        q = dim_category.select(
            (-(F.lit(QID_PAIR_BASE) + F.col("sk_categoria") * 10 + i)).alias("q_id"),
            F.lit("Parceiro").alias("user_name"),
            F.concat(F.lit(pre), names[what], F.lit(post)).alias("text"))
        pair_q = q if pair_q is None else pair_q.unionByName(q)
    fmt = {"br": F.date_format("data", "dd/MM/yyyy"), "iso": F.date_format("data", "yyyy-MM-dd")}
    date_q = None
    for i, (pre, what, post) in enumerate(DATE_TEMPLATES):
        q = dim_calendar.select(
            (-(F.lit(QID_DATE_BASE) + F.date_format("data", "yyyyMMdd").cast("long") * 10 + i))
            .alias("q_id"),
            F.lit("Parceiro").alias("user_name"),
            F.concat(F.lit(pre), fmt[what], F.lit(post)).alias("text"))
        date_q = q if date_q is None else date_q.unionByName(q)
    fixed = spark.createDataFrame(
        [(-(QID_FIXED_BASE + i), "Parceiro", t) for i, t in enumerate(FIXED_QUESTIONS)],
        "q_id long, user_name string, text string")
    return conv.unionByName(pair_q).unionByName(date_q).unionByName(fixed)

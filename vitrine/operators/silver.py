"""Silver: typing, trimming, deduplication and defaults, in the source order.

Order matters: values are trimmed *before* deduplication, and NULL defaults
are applied *after* it (so a NULL category survives dedup as NULL and then
becomes 'Sem Categoria'). Each step is one ``select`` so the plan stays a
handful of projections around a single window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.constants import (BOOLEAN_COLUMNS, INT_COLUMNS, LANDING_COLUMNS, MONEY_COLUMNS,
                               NULL_DEFAULTS, RATING_COLUMN, TRIM_COLUMNS)
from vitrine.functions.parsing import money_br, rating_br, to_boolean, to_int
from vitrine.operators.keys import is_small
from vitrine.session import ensure_checkpoint_dir, held

DEDUP_KEYS = ["data", "id_anuncio"]
_RANKED = ["loja_oficial", "parcelamento", "titulo_produto"]
DEDUP_TIE_BREAK = _RANKED + [c for c in LANDING_COLUMNS if c not in (
    *DEDUP_KEYS, *_RANKED, "posicao_ranking", "faturamento_estimado_dia", "qtd_vendas_estimadas_dia")]

# Keys that occur more than once, up to which they are broadcast: rows, estimated bytes.
REPEATED_KEYS = 4_000_000
REPEATED_BYTES = 160 * 1024 * 1024


def _replace(df: DataFrame, exprs: dict[str, Column]) -> DataFrame:
    return df.select(*[exprs[c].alias(c) if c in exprs else F.col(c) for c in df.columns])


def parse_money(df: DataFrame) -> DataFrame:
    return _replace(df, {c: money_br(df, c) for c in MONEY_COLUMNS if c in df.columns})


def parse_rating(df: DataFrame) -> DataFrame:
    return _replace(df, {RATING_COLUMN: rating_br(df, RATING_COLUMN)})


def cast_booleans(df: DataFrame, cols: Sequence[str] = BOOLEAN_COLUMNS) -> DataFrame:
    return _replace(df, {c: to_boolean(c) for c in cols})


def cast_ints(df: DataFrame, cols: Sequence[str] = INT_COLUMNS) -> DataFrame:
    return _replace(df, {c: to_int(c) for c in cols})


def trim_all(df: DataFrame, cols: Sequence[str] = TRIM_COLUMNS) -> DataFrame:
    return _replace(df, {c: F.trim(F.col(c)) for c in cols})


def typed(df: DataFrame) -> DataFrame:
    """All per-row conversions (money, rating, booleans, ints, trim) in one projection."""
    exprs: dict[str, Column] = {}
    for c in MONEY_COLUMNS:
        exprs[c] = money_br(df, c)
    exprs[RATING_COLUMN] = rating_br(df, RATING_COLUMN)
    for c in BOOLEAN_COLUMNS:
        exprs[c] = to_boolean(c)
    for c in INT_COLUMNS:
        exprs[c] = to_int(c)
    for c in TRIM_COLUMNS:
        exprs[c] = F.trim(F.col(c))
    return _replace(df, exprs)


def dedup_order(nulls_first_rank: bool = True) -> list[Column]:
    """Best rank first. The source sorts ascending with Spark's default, where
    a NULL rank comes first and therefore wins; kept as the default. All other
    columns follow, so the order is total: rows that tie are equal rows."""
    rank = (F.col("posicao_ranking").asc_nulls_first() if nulls_first_rank
            else F.col("posicao_ranking").asc_nulls_last())
    first = [rank,
             F.col("faturamento_estimado_dia").desc_nulls_last(),
             F.col("qtd_vendas_estimadas_dia").desc_nulls_last()]
    return first + [F.col(c).asc_nulls_first() for c in DEDUP_TIE_BREAK]


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row per key.

    A key that occurs once needs no comparison. A count over the key columns finds
    the others, and only their rows are sorted and shuffled: ``row_number`` + ``= 1``
    lets Catalyst add a partial WindowGroupLimit before that shuffle, so a hot key is
    cut down to one row per map task before it is exchanged. Where more keys occur
    twice than a broadcast may hold, all rows go that way. NULL is a key of its own."""
    w = Window.partitionBy(*keys).orderBy(*order)

    def best(rows: DataFrame) -> DataFrame:
        return rows.withColumn("_vx_rn", F.row_number().over(w)).filter("_vx_rn = 1").drop("_vx_rn")

    ensure_checkpoint_dir(df.sparkSession)
    twice = held(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_vx_n")).filter("_vx_n > 1")
                 .select(*[F.col(k).alias(f"_vx_{k}") for k in keys]))
    if not is_small(twice, REPEATED_KEYS, REPEATED_BYTES):
        return best(df)
    repeated = F.broadcast(twice)
    on = [F.col(k).eqNullSafe(F.col(f"_vx_{k}")) for k in keys]
    return df.join(repeated, on, "left_anti").unionByName(best(df.join(repeated, on, "left_semi")))


def null_defaults(df: DataFrame, defaults=NULL_DEFAULTS) -> DataFrame:
    return _replace(df, {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults})


def silver(bronze_df: DataFrame, nulls_first_rank: bool = True,
           processing_time: bool = True) -> DataFrame:
    df = typed(bronze_df)
    df = dedup_first(df, DEDUP_KEYS, dedup_order(nulls_first_rank))
    df = null_defaults(df)
    df = df.drop("_data_ingestao", "_arquivo_origem")
    if processing_time:
        df = df.withColumn("_data_processamento", F.current_timestamp())
    return df

"""DuckDB SQL oracles: the same results written as plain SQL over the raw
tables (views ``lineitem``, ``part``, ``supplier``, ``nation``, ...).

Each oracle is ``WITH <the layers it needs> SELECT ...``. The CTE texts mirror
the Spark operators step by step; null ordering is always written out because
the engines' defaults differ (Spark asc = NULLS FIRST, DuckDB = NULLS LAST).
"""

from __future__ import annotations

from vitrine.constants import (LANDING_COLUMNS, MONTH_NAMES, NULL_CHECK_COLUMNS, TRIM_COLUMNS,
                               WEEKDAY_NAMES)
from vitrine.sources.testdata import (IMAGE_PREFIX, LISTING_PREFIX, LISTING_SUFFIX,
                                      NULL_CATEGORY_TYPE, PRODUCT_PREFIX)


def _br(x: str) -> str:
    return f"translate(format('{{:,.2f}}', {x}), ',.', '.,')"


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


LANDING = f"""landing AS (
  SELECT
    CAST(l_shipdate AS DATE) AS data,
    CAST(year(l_shipdate) AS INTEGER) AS ano,
    CAST(month(l_shipdate) AS INTEGER) AS mes,
    strftime(CAST(l_shipdate AS DATE), '%Y-%m') AS ano_mes,
    CAST(row_number() OVER (PARTITION BY CAST(l_shipdate AS DATE)
         ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey ASC NULLS FIRST,
                  l_linenumber ASC NULLS FIRST, l_partkey ASC NULLS FIRST,
                  l_suppkey ASC NULLS FIRST) AS INTEGER) AS posicao_ranking,
    NULLIF(p_type, '{NULL_CATEGORY_TYPE}') AS categoria,
    CASE WHEN len(string_split(p_name, ' ')) >= 2 THEN string_split(p_name, ' ')[2] END AS subcategoria,
    '{LISTING_PREFIX}' || CAST(l_partkey AS VARCHAR) || '{LISTING_SUFFIX}' AS id_anuncio,
    p_name AS titulo_produto,
    p_brand AS marca,
    {_br('l_extendedprice / NULLIF(l_quantity, 0.0)')} AS preco_atual,
    {_br('p_retailprice')} AS preco_original,
    CAST(round(l_discount * 100) AS INTEGER) AS desconto_pct,
    CAST(l_linenumber AS VARCHAR) || 'x' AS parcelamento,
    CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qtd_vendas_estimadas_dia,
    {_br('l_extendedprice')} AS faturamento_estimado_dia,
    {_br('1.0 + l_tax * 50')} AS avaliacao_nota,
    p_size AS qtd_avaliacoes,
    CAST(l_linestatus = 'F' AS BIGINT) AS is_full,
    CAST(l_returnflag = 'N' AS BIGINT) AS frete_gratis,
    s_name AS loja_oficial,
    n_name AS reputacao_vendedor,
    '{IMAGE_PREFIX}' || CAST(l_partkey AS VARCHAR) AS url_imagem,
    '{PRODUCT_PREFIX}' || CAST(l_partkey AS VARCHAR) AS url_produto,
    CASE WHEN l_linestatus = 'F' THEN 'Oficial' ELSE 'Sintetico' END AS tipo_dado,
    p_name AS produto
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

BRONZE = f"""bronze AS (SELECT {', '.join(LANDING_COLUMNS)} FROM landing)"""


def _money(c: str, trim: bool = True) -> str:
    inner = f"trim({c})" if trim else c
    return f"TRY_CAST(replace(replace({inner}, '.', ''), ',', '.') AS DOUBLE)"


_TYPED_EXPRS = {
    "preco_atual": _money("preco_atual"),
    "preco_original": _money("preco_original"),
    "faturamento_estimado_dia": _money("faturamento_estimado_dia"),
    "avaliacao_nota": "TRY_CAST(replace(trim(avaliacao_nota), ',', '.') AS DOUBLE)",
    "is_full": "TRY_CAST(is_full AS BOOLEAN)",
    "frete_gratis": "TRY_CAST(frete_gratis AS BOOLEAN)",
    **{c: f"TRY_CAST({c} AS INTEGER)" for c in
       ["ano", "mes", "posicao_ranking", "desconto_pct", "qtd_vendas_estimadas_dia",
        "qtd_avaliacoes"]},
    **{c: f"trim({c})" for c in TRIM_COLUMNS},
}

def typed_expr(column: str) -> str:
    """The typed value of a bronze column."""
    return _TYPED_EXPRS.get(column, column)


TYPED = "typed AS (SELECT " + ", ".join(
    f"{_TYPED_EXPRS.get(c, c)} AS {c}" for c in LANDING_COLUMNS) + " FROM bronze)"

_DEDUP_FIRST = ["posicao_ranking ASC NULLS FIRST", "faturamento_estimado_dia DESC NULLS LAST",
                "qtd_vendas_estimadas_dia DESC NULLS LAST", "loja_oficial ASC NULLS FIRST",
                "parcelamento ASC NULLS FIRST", "titulo_produto ASC NULLS FIRST"]
DEDUP_ORDER = ", ".join(_DEDUP_FIRST + [
    f"{c} ASC NULLS FIRST" for c in LANDING_COLUMNS
    if c not in {x.split()[0] for x in _DEDUP_FIRST} | {"data", "id_anuncio"}])

DEDUP = f"""dedup AS (
  SELECT {', '.join(LANDING_COLUMNS)} FROM (
    SELECT *, row_number() OVER (PARTITION BY data, id_anuncio ORDER BY {DEDUP_ORDER}) AS rn_
    FROM typed) WHERE rn_ = 1
)"""

_DEFAULTS = {
    "categoria": "COALESCE(categoria, 'Sem Categoria')",
    "subcategoria": "COALESCE(subcategoria, 'Sem Subcategoria')",
    "marca": "COALESCE(marca, 'Sem Marca')",
    "qtd_vendas_estimadas_dia": "COALESCE(qtd_vendas_estimadas_dia, 0)",
    "faturamento_estimado_dia": "COALESCE(faturamento_estimado_dia, 0.0)",
    "preco_atual": "COALESCE(preco_atual, 0.0)",
}

SILVER = "silver AS (SELECT " + ", ".join(
    f"{_DEFAULTS.get(c, c)} AS {c}" for c in LANDING_COLUMNS) + " FROM dedup)"

DIM_CALENDAR = f"""dim_calendar AS (
  SELECT data,
    CAST(year(data) AS INTEGER) AS ano,
    CAST(month(data) AS INTEGER) AS mes,
    CAST(dayofmonth(data) AS INTEGER) AS dia,
    strftime(data, '%Y-%m') AS ano_mes,
    {_list(MONTH_NAMES)}[month(data)] AS nome_mes,
    CAST(quarter(data) AS INTEGER) AS trimestre,
    {_list(WEEKDAY_NAMES)}[dayofweek(data) + 1] AS dia_semana,
    CAST(dayofweek(data) + 1 AS INTEGER) AS dia_semana_num,
    COALESCE(dayofweek(data) IN (0, 6), false) AS is_fim_semana,
    CAST(weekofyear(data) AS INTEGER) AS semana_do_ano
  FROM (SELECT DISTINCT data FROM silver)
)"""

DIM_CATEGORY = """dim_category AS (
  SELECT CAST(row_number() OVER (ORDER BY categoria ASC NULLS FIRST, subcategoria ASC NULLS FIRST)
              AS BIGINT) AS sk_categoria, categoria, subcategoria
  FROM (SELECT DISTINCT categoria, subcategoria FROM silver)
)"""

_PRODUCT_COLS = ("id_anuncio, titulo_produto, marca, avaliacao_nota, qtd_avaliacoes, is_full, "
                 "frete_gratis, loja_oficial, reputacao_vendedor, url_imagem, url_produto")

DIM_PRODUCT = f"""dim_product AS (
  SELECT CAST(row_number() OVER (ORDER BY id_anuncio ASC NULLS FIRST) AS BIGINT) AS sk_produto,
         {_PRODUCT_COLS}
  FROM (SELECT {_PRODUCT_COLS} FROM (
          SELECT *, row_number() OVER (PARTITION BY id_anuncio ORDER BY data DESC NULLS LAST) AS rn_
          FROM silver) WHERE rn_ = 1)
)"""

FACT = """fact AS (
  SELECT s.data, p.sk_produto, c.sk_categoria, s.posicao_ranking,
         s.qtd_vendas_estimadas_dia AS qtd_vendas, s.faturamento_estimado_dia AS faturamento,
         s.preco_atual, s.preco_original, s.desconto_pct, s.parcelamento, s.tipo_dado, s.ano_mes
  FROM silver s
  LEFT JOIN dim_category c ON s.categoria = c.categoria AND s.subcategoria = c.subcategoria
  LEFT JOIN dim_product p ON s.id_anuncio = p.id_anuncio
)"""

ANALYTIC = """analytic AS (
  SELECT data, ano, mes, ano_mes, posicao_ranking, categoria, subcategoria, titulo_produto, marca,
         qtd_vendas_estimadas_dia AS qtd_vendas_num, faturamento_estimado_dia AS fat_num,
         preco_atual AS preco_num, is_full, frete_gratis
  FROM silver
)"""

ANALYTIC_RAW = f"""analytic_raw AS (
  SELECT data, ano, mes, ano_mes, posicao_ranking, categoria, subcategoria, titulo_produto, marca,
         TRY_CAST(qtd_vendas_estimadas_dia AS INTEGER) AS qtd_vendas_num,
         {_money('faturamento_estimado_dia', trim=False)} AS fat_num,
         {_money('preco_atual', trim=False)} AS preco_num, is_full, frete_gratis
  FROM landing
)"""

REF = "ref AS (SELECT max(data) AS r, min(data) AS r0 FROM analytic)"
REF_RAW = "ref AS (SELECT max(data) AS r, min(data) AS r0 FROM analytic_raw)"

_ORDER = ["landing", "bronze", "typed", "dedup", "silver", "dim_calendar", "dim_category",
          "dim_product", "fact", "analytic", "analytic_raw", "ref", "ref_raw"]
_CTES = {"landing": LANDING, "bronze": BRONZE, "typed": TYPED, "dedup": DEDUP, "silver": SILVER,
         "dim_calendar": DIM_CALENDAR, "dim_category": DIM_CATEGORY, "dim_product": DIM_PRODUCT,
         "fact": FACT, "analytic": ANALYTIC, "analytic_raw": ANALYTIC_RAW, "ref": REF,
         "ref_raw": REF_RAW}
_DEPS = {"bronze": ["landing"], "typed": ["bronze"], "dedup": ["typed"], "silver": ["dedup"],
         "dim_calendar": ["silver"], "dim_category": ["silver"], "dim_product": ["silver"],
         "fact": ["silver", "dim_category", "dim_product"], "analytic": ["silver"],
         "analytic_raw": ["landing"], "ref": ["analytic"], "ref_raw": ["analytic_raw"]}


def with_layers(*layers: str, extra: list[str] | None = None) -> str:
    """``WITH`` clause holding ``layers`` and everything they depend on."""
    need: set[str] = set()

    def add(n):
        if n not in need:
            need.add(n)
            for d in _DEPS.get(n, []):
                add(d)
    for n in layers:
        add(n)
    parts = [_CTES[n] for n in _ORDER if n in need]
    if "ref_raw" in need and "ref" in need:
        raise ValueError("ref and ref_raw are exclusive")
    return "WITH " + ",\n".join(parts + (extra or []))


# -- periods ------------------------------------------------------------------
def _iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def period_label(kind: str) -> str:
    if kind == "today":
        return f"'Hoje (' || {_iso('r')} || ')'"
    if kind == "yesterday":
        return f"'Ontem (' || {_iso('CAST(r - INTERVAL 1 DAY AS DATE)')} || ')'"
    if kind == "mtd":
        return (f"'MTD (Acumulado no Mês ' || lpad(CAST(month(r) AS VARCHAR), 2, '0') || '/' || "
                f"CAST(year(r) AS VARCHAR) || ' até ' || {_iso('r')} || ')'")
    if kind == "ytd":
        return f"'YTDA ' || CAST(year(r) AS VARCHAR) || ' (Acumulado no Ano até ' || {_iso('r')} || ')'"
    if kind == "first_date":
        return f"'Data ' || {_iso('r0')}"
    raise ValueError(kind)


def period_where(kind: str) -> str:
    if kind == "today":
        return "data = r"
    if kind == "yesterday":
        return "data = CAST(r - INTERVAL 1 DAY AS DATE)"
    if kind == "mtd":
        return "ano = year(r) AND mes = month(r) AND data <= r"
    if kind == "ytd":
        return "ano = year(r) AND data <= r"
    if kind == "first_date":
        return "data = r0"
    raise ValueError(kind)


MONEY_SUM = "CAST(SUM(TRY_CAST({c} AS DECIMAL(28,2))) AS DOUBLE)"


def money_sum(c: str) -> str:
    return MONEY_SUM.format(c=c)


def null_check_columns() -> list[str]:
    return list(NULL_CHECK_COLUMNS)

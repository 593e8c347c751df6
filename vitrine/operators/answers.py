"""Answering a batch of routed questions and rendering the replies.

Aggregates are computed once per distinct question period (not per question).
Sums by category and subcategory come from the range index (``operators/ranges``):
a period is a few intervals of days, found by equi-joins. Only the periods of
product rankings read the answer table, in one scan joined on the date. Each
question then picks its rows with equi-joins on the period key and its entities.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine import constants as K
from vitrine.functions.formatting import br_number_text, fill
from vitrine.functions.parsing import money_exact
from vitrine.operators.keys import broadcast_if_small
from vitrine.operators.ranges import days_with_rows, period_ranges, range_index, range_sums

TOP_N = 5
ANSWER_COLUMNS = ["q_id", "intent", "linha", "periodo", "categoria", "subcategoria",
                  "titulo_produto", "marca", "faturamento", "vendas", "data_mais_recente",
                  "total_registros"]


def _pkey(df: DataFrame) -> Column:
    return F.concat_ws("|", df["kind"], df["inicio"].cast("string"), df["fim"].cast("string"))


def answer_questions(routed: DataFrame, analytic: DataFrame, last_date, total_rows: int,
                     index: DataFrame | None = None) -> DataFrame:
    """Result rows per answerable question (``linha`` = row order).
    ``last_date`` / ``total_rows`` are the base's reference scalars, ``index`` its
    written range index (built from ``analytic`` where not given)."""
    if index is None:
        index = range_index(analytic).checkpoint(eager=True)  # read several times below
    q = routed.filter(F.col("status") == "ok").withColumn("pkey", _pkey(routed))
    periods = (q.filter(F.col("intent").isin("subcategoria", "categoria", "ranking_subcategorias",
                                              "ranking_categorias", "total"))
               .select("pkey", "kind", "inicio", "fim", "p_ano", "p_mes").distinct())
    cs = range_sums(index, period_ranges(periods, "pkey"), "pkey", ["categoria", "subcategoria"])
    cat = cs.groupBy("pkey", "categoria").agg(F.sum("fat").alias("fat"), F.sum("qtd").alias("qtd"))
    tot = cs.groupBy("pkey").agg(F.sum("fat").alias("fat"), F.sum("qtd").alias("qtd"))
    ranked = (q.filter(F.col("intent") == "ranking_produtos")
              .select("pkey", "kind", "inicio", "fim", "p_ano", "p_mes").distinct())
    days = broadcast_if_small(days_with_rows(index, ranked, "pkey"))
    of_period = ((days["p_ano"].isNull() | (analytic["ano"] == days["p_ano"]))
                 & (days["p_mes"].isNull() | (analytic["mes"] == days["p_mes"])))
    rows = analytic.join(days, (analytic["data"] == days["data"]) & of_period)
    prod = (rows.groupBy("pkey", "titulo_produto", "marca", "categoria", "subcategoria")
            .agg(F.sum(money_exact("fat_num")).alias("fat"),
                 F.sum("qtd_vendas_num").alias("qtd")))
    wprod = Window.partitionBy("pkey").orderBy(
        F.col("fat").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in
                                          ("titulo_produto", "marca", "categoria", "subcategoria")])
    prod_top = prod.withColumn("_r", F.row_number().over(wprod)).filter(F.col("_r") <= TOP_N) \
                   .drop("_r")
    wcs = Window.partitionBy("pkey").orderBy(
        F.col("fat").desc_nulls_last(), F.col("categoria").asc_nulls_first(),
        F.col("subcategoria").asc_nulls_first())
    cs_top = cs.withColumn("_r", F.row_number().over(wcs)).filter(F.col("_r") <= TOP_N).drop("_r")
    qk = q.select("q_id", "intent", "periodo", "pkey", F.col("categoria").alias("q_cat"),
                  F.col("subcategoria").alias("q_sub"))

    def pick(intent, table, keys=(), cond=None):
        """Rows of ``table`` for questions of ``intent``: equi-join on the
        period key plus the question's entity keys, so a question only meets
        its own rows (never all rows of its period, then a filter)."""
        sel = qk.filter(F.col("intent") == intent)
        on = [sel["pkey"] == table["pkey"]] + [sel[q] == table[t] for q, t in keys]
        j = sel.join(table, on).drop(table["pkey"])
        return j.filter(cond) if cond is not None else j

    parts = [
        pick("subcategoria", cs, [("q_sub", "subcategoria")],
             F.col("q_cat").isNull() | (F.col("categoria") == F.col("q_cat"))),
        pick("categoria", cat, [("q_cat", "categoria")])
        .withColumn("subcategoria", F.lit(None).cast("string")),
        pick("ranking_subcategorias", cs_top),
        pick("ranking_categorias", cat).withColumn("subcategoria", F.lit(None).cast("string")),
    ]
    full_cols = ["q_id", "intent", "periodo", "categoria", "subcategoria", "titulo_produto",
                 "marca", "fat", "qtd"]
    parts = [x.withColumns({"titulo_produto": F.lit(None).cast("string"),
                            "marca": F.lit(None).cast("string")}).select(*full_cols) for x in parts]
    parts.append(pick("ranking_produtos", prod_top).select(*full_cols))
    # a period total is one row even over no matching rows (NULL measures)
    totals = (qk.filter(F.col("intent") == "total").join(tot, "pkey", "left")
              .withColumns({c: F.lit(None).cast("string") for c in
                            ("categoria", "subcategoria", "titulo_produto", "marca")})
              .select(*full_cols))
    parts.append(totals)
    found = reduce(lambda a, b: a.unionByName(b), parts)
    w = Window.partitionBy("q_id").orderBy(
        F.col("fat").desc_nulls_last(), *[F.col(c).asc_nulls_first() for c in
                                          ("categoria", "subcategoria", "titulo_produto", "marca")])
    out = found.withColumn("linha", F.row_number().over(w)).select("q_id", "intent", "linha", "periodo", "categoria", "subcategoria",
                        "titulo_produto", "marca", F.col("fat").cast("double").alias("faturamento"),
                        F.col("qtd").cast("long").alias("vendas"),
                        F.lit(None).cast("string").alias("data_mais_recente"),
                        F.lit(None).cast("long").alias("total_registros"))
    md = (q.filter(F.col("intent") == "metadados")
          .select("q_id", "intent", F.lit(1).alias("linha"),
                  *[F.lit(None).cast(t).alias(c) for c, t in
                    (("periodo", "string"), ("categoria", "string"), ("subcategoria", "string"),
                     ("titulo_produto", "string"), ("marca", "string"),
                     ("faturamento", "double"), ("vendas", "long"))],
                  F.lit(None if last_date is None else str(last_date)).cast("string")
                  .alias("data_mais_recente"),
                  F.lit(total_rows).cast("long").alias("total_registros")))
    return out.unionByName(md).select(*ANSWER_COLUMNS)


# FIXED VALUES: displayed columns per intent, in display order.
DISPLAY = {
    "total": [("periodo", "s"), ("faturamento_total", "m"), ("total_pedidos", "i")],
    "categoria": [("periodo", "s"), ("categoria", "s"), ("faturamento", "m"), ("vendas", "i")],
    "subcategoria": [("periodo", "s"), ("categoria", "s"), ("subcategoria", "s"),
                     ("faturamento", "m"), ("vendas", "i")],
    "ranking_subcategorias": [("periodo", "s"), ("categoria", "s"), ("subcategoria", "s"),
                              ("faturamento", "m"), ("vendas", "i")],
    "ranking_categorias": [("periodo", "s"), ("categoria", "s"), ("faturamento", "m"),
                           ("vendas", "i")],
    "ranking_produtos": [("periodo", "s"), ("titulo_produto", "s"), ("marca", "s"),
                         ("categoria", "s"), ("subcategoria", "s"), ("vendas", "i"),
                         ("faturamento", "m")],
    "metadados": [("data_mais_recente", "s"), ("total_registros", "i")],
}
_SOURCE = {"faturamento_total": "faturamento", "total_pedidos": "vendas"}


def _cell(name: str, kind: str) -> Column:
    v = F.col(_SOURCE.get(name, name))
    if kind == "m":
        txt = F.concat(F.lit("R$ "), br_number_text(v, 2))
    elif kind == "i":
        txt = br_number_text(v, 0)
    else:
        txt = F.nullif(v, F.lit(""))
    title = name.replace("_", " ").title()
    return F.concat(F.lit(f"*{title}:* "), F.coalesce(txt, F.lit("-")))


def bullet_line() -> Column:
    expr = None
    for intent, cols in DISPLAY.items():
        line = F.concat(F.lit("• "), F.concat_ws(" | ", *[_cell(n, k) for n, k in cols]))
        expr = (F.when(F.col("intent") == intent, line) if expr is None
                else expr.when(F.col("intent") == intent, line))
    return expr


def format_result_rows(answers: DataFrame, routed: DataFrame, ref_text: str,
                       n: int = K.BULLET_ROWS) -> DataFrame:
    """Reply text per answered question: header, optional warning, the
    question, up to ``n`` bullet rows (sorted), "... e mais N", footer.
    Only the first ``n`` rows of a question are collected."""
    shown = answers.filter(F.col("linha") <= n).withColumn("bullet", bullet_line())
    per_q = (shown.groupBy("q_id")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("linha", "bullet"))),
                                           lambda s: s["bullet"]), "\n").alias("bullets")))
    counts = answers.groupBy("q_id").agg(F.count(F.lit(1)).alias("n_linhas"))
    q = routed.filter(F.col("intent").isin(*DISPLAY.keys()) & (F.col("status") == "ok")) \
              .select("q_id", "user_name", "text", "aviso")
    j = q.join(per_q, "q_id", "left").join(counts, "q_id", "left")
    header = fill(K.REPLY_HEADER, user="user_name")
    question = fill(K.REPLY_QUESTION, question="text")
    more = F.when(F.col("n_linhas") > n, fill(
        K.REPLY_MORE, n=(F.col("n_linhas") - n).cast("string"))).otherwise(F.lit(""))
    footer = F.lit(K.REPLY_FOOTER.format(ref=ref_text))
    body = F.concat(header, F.when(F.col("aviso").isNotNull(),
                                   F.concat(F.col("aviso"), F.lit("\n"))).otherwise(F.lit("")),
                    question, F.col("bullets"), more, footer)
    empty = fill(K.REPLY_EMPTY, user="user_name")
    return j.select("q_id", F.coalesce("n_linhas", F.lit(0)).alias("n_linhas"),
                    F.when(F.col("bullets").isNull(), empty).otherwise(body).alias("resposta"))


def pipe_table(df: DataFrame, group: str, order: list[Column], cols: list[str],
               n: int = K.PIPE_TABLE_ROWS) -> DataFrame:
    """First ``n`` rows of each group as a pipe table (header, dashes, rows;
    NULL shown as 'NULL', doubles with two decimals)."""
    w = Window.partitionBy(group).orderBy(*order)
    header = " | ".join(cols)

    def cell(c):
        dt = dict(df.dtypes)[c]
        v = F.format_string("%.2f", F.col(c)) if dt == "double" else F.col(c).cast("string")
        return F.coalesce(v, F.lit("NULL"))
    rows = (df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n)
            .withColumn("_line", F.concat_ws(" | ", *[cell(c) for c in cols])))
    return (rows.groupBy(group)
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "_line"))),
                                          lambda s: s["_line"]), "\n").alias("_body"))
            .select(group, F.concat(F.lit(header + "\n" + "-" * len(header) + "\n"),
                                    F.col("_body")).alias("tabela")))


def _generic_cell(name: str, dtype: str, single: bool) -> Column:
    """Render one value like the reply formatter: money (by column name) as
    'R$ 1.234,56', other numbers as '1.235', text as-is ('-' / '0' if empty)."""
    v = F.col(f"`{name}`")
    low = name.lower()
    is_float = dtype in ("double", "float")
    is_num = is_float or dtype in ("int", "bigint", "smallint", "tinyint") or dtype.startswith("decimal")
    money_parts = K.MONEY_NAME_PARTS_SINGLE if single else K.MONEY_NAME_PARTS_LIST
    money = any(p in low for p in money_parts) and (is_num if single else is_float)
    if money:
        return F.concat(F.lit("R$ "), br_number_text(v.cast("double"), 2))
    if is_num:
        return br_number_text(v.cast("double"), 0)
    empty = "0" if single else "-"
    return F.coalesce(F.nullif(v.cast("string"), F.lit("")), F.lit(empty))


def format_result(result: DataFrame, order: list[Column], question: str, user_name: str,
                  ref_text: str, alert: str | None = None, n: int = K.BULLET_ROWS) -> DataFrame:
    """Reply text for one question's result table (any columns): a single
    cell for a 1x1 result, else up to ``n`` bullet rows in ``order`` and
    "... e mais N". Only the first ``n`` rows and a count are read (top-k),
    never the whole result. Returns one row (n_linhas, resposta)."""
    cols = result.dtypes
    single = len(cols) == 1
    top = result.orderBy(*order).limit(n).withColumn("_i", F.monotonically_increasing_id())
    bullet = F.concat(F.lit("• "), F.concat_ws(" | ", *[
        F.concat(F.lit(f"*{c.replace('_', ' ').title()}:* "), _generic_cell(c, t, False))
        for c, t in cols]))
    one = (F.concat(F.lit(f"📦 *{cols[0][0].replace('_', ' ').title()}:* `"),
                    _generic_cell(cols[0][0], cols[0][1], True), F.lit("`\n")) if single
           else F.lit(None).cast("string"))
    body = (top.select("_i", bullet.alias("b"), one.alias("one"))
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_i", "b"))),
                                          lambda s: s["b"]), "\n").alias("bullets"),
                 F.first("one").alias("one")))
    count = result.agg(F.count(F.lit(1)).alias("n_linhas"))
    head = K.REPLY_HEADER.format(user=user_name) + (f"{alert}\n" if alert else "") + \
        K.REPLY_QUESTION.format(question=question)
    text = (F.when(F.col("n_linhas") == 0, F.lit(K.REPLY_EMPTY.format(user=user_name)))
            .when((F.col("n_linhas") == 1) & F.lit(single),
                  F.concat(F.lit(head), F.col("one"), F.lit(K.REPLY_FOOTER.format(ref=ref_text))))
            .otherwise(F.concat(F.lit(head), F.col("bullets"),
                                F.when(F.col("n_linhas") > n, F.concat(
                                    F.lit("\n_... e mais "), (F.col("n_linhas") - n).cast("string"),
                                    F.lit(" registros encontrados._"))).otherwise(F.lit("")),
                                F.lit(K.REPLY_FOOTER.format(ref=ref_text)))))
    return _attach(count, body, text)


def _attach(count: DataFrame, body: DataFrame, text: Column) -> DataFrame:
    """Both inputs are single-row aggregates; attach them on a constant key."""
    k = F.lit(1).alias("_k")
    return (count.select(k, "n_linhas").join(body.select(k, "bullets", "one"), "_k", "left")
            .select("n_linhas", text.alias("resposta")))


def every_reply(rows: DataFrame, routed: DataFrame, flat: DataFrame | None, ref_text: str,
                total_rows: int) -> DataFrame:
    """One reply for each routed question: from its result rows (``origem``
    'linhas'), the dictionary, where ``flat`` is given ('dicionario'), or, for
    all that neither answers, the reply for no data found ('padrao')."""
    cols = ["q_id", "n_linhas", "resposta"]
    found = format_result_rows(rows, routed, ref_text).select(*cols, F.lit("linhas").alias("origem"))
    if flat is not None:
        found = found.unionByName(dictionary_replies(routed, flat, ref_text, total_rows)
                                  .select(*cols, F.lit("dicionario").alias("origem")))
    found = found.checkpoint(eager=True)  # read twice, and too large a plan to fuse with the rest
    rest = (routed.join(found.select(F.col("q_id").alias("_q")), F.col("q_id").eqNullSafe(F.col("_q")), "left_anti")
            .select("q_id", F.lit(0).cast("long").alias("n_linhas"),
                    fill(K.REPLY_EMPTY, user="user_name").alias("resposta"), F.lit("padrao").alias("origem")))
    return found.unionByName(rest)


def dictionary_replies(routed: DataFrame, flat: DataFrame, ref_text: str, total_rows: int) -> DataFrame:
    """Replies for the dictionary intents: the category list, a category's
    subcategories (with example brands), a glossary term, the greeting.

    Lists are complete; the row limit of result tables does not apply to them.
    Each list is rendered once, not for each question: the category list, joined
    to its questions on the intent, and one list for each category, joined on
    the category. A list holds a line for each name of the taxonomy level."""
    from vitrine.operators.taxonomy import categories_summary, subcategories_summary
    cats = categories_summary(flat)
    cat_line = F.concat(F.lit("• *Categoria:* "), F.coalesce("categoria", F.lit("-")),
                        F.lit(" | *Subcategorias:* "), F.col("n_subcategorias").cast("string"))
    cat_body = (cats.groupBy(F.lit("listar_categorias").alias("intent"))
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                    F.struct("categoria", cat_line.alias("b")))), lambda s: s["b"]), "\n").alias("bullets")))
    cat_count = cats.agg(F.count(F.lit(1)).alias("n_linhas")) \
                    .withColumn("intent", F.lit("listar_categorias"))
    subs = subcategories_summary(flat)
    sub_line = F.concat(F.lit("• *Subcategoria:* "), F.coalesce("subcategoria", F.lit("-")),
                        F.lit(" | *Marcas:* "), F.col("n_marcas").cast("string"),
                        F.lit(" | *Exemplos:* "), F.coalesce("exemplos", F.lit("-")))
    sub_body = (subs.groupBy("categoria")
                .agg(F.array_join(F.transform(F.array_sort(F.collect_list(
                    F.struct("subcategoria", sub_line.alias("b")))), lambda s: s["b"]), "\n").alias("bullets")))
    sub_count = subs.groupBy("categoria").agg(F.count(F.lit(1)).alias("n_linhas"))

    head = F.concat(fill(K.REPLY_HEADER, user="user_name"), fill(K.REPLY_QUESTION, question="text"))
    foot = F.lit(K.REPLY_FOOTER.format(ref=ref_text))
    listing = F.concat(head, F.col("bullets"), foot)
    cols = ["q_id", "n_linhas", "resposta"]
    lc = (routed.filter((F.col("intent") == "listar_categorias") & (F.col("status") == "ok"))
          .join(cat_body, "intent").join(cat_count, "intent")
          .select("q_id", "n_linhas", listing.alias("resposta")))
    ls = (routed.filter(F.col("intent") == "listar_subcategorias")
          .join(sub_body, F.col("lista_categoria") == sub_body["categoria"])
          .drop(sub_body["categoria"])
          .join(sub_count, F.col("lista_categoria") == sub_count["categoria"])
          .select("q_id", "n_linhas", listing.alias("resposta")))
    gl = (routed.filter(F.col("intent") == "glossario")
          .select("q_id", F.lit(1).cast("long").alias("n_linhas"),
                  fill(K.REPLY_GLOSSARY, sigla=F.upper("sigla"), termo="termo",
                       definicao="definicao").alias("resposta")))
    hi = (routed.filter(F.col("intent") == "saudacao")
          .select("q_id", F.lit(1).cast("long").alias("n_linhas"),
                  fill(K.REPLY_GREETING, user="user_name", ref=F.lit(ref_text),
                       rows=F.lit(f"{total_rows:,}".replace(",", "."))).alias("resposta")))
    return lc.select(*cols).unionByName(ls.select(*cols)).unionByName(gl).unionByName(hi)

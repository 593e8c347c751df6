"""DuckDB oracles for the question-routing keys.

Where the Spark side uses an n-gram equi-join to avoid testing every keyword
against every question, the oracle does exactly that brute-force test (every
question x every keyword), so the two are independent computations of the
same definition.
"""

from __future__ import annotations

from vitrine import constants as K
from vitrine.functions.formatting import fill_sql, word_pattern
from vitrine.operators import answers as A
from vitrine.operators import routing as R
from vitrine.operators import taxonomy as T
from vitrine.plans import oracle as O


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _any_contains(words, t="t") -> str:
    return "(" + " OR ".join(f"contains({t}, {q(w)})" for w in words) + ")"


NW = R.NW


def updates_questions_cte() -> str:
    """Questions as they arrive through the update feed (one per user turn)."""
    from vitrine.sources import updates as U
    return (f"questions AS (SELECT conv_id * {U.TURN_ID_FACTOR} + turn AS q_id, "
            f"CASE WHEN conv_id % {U.ANONYMOUS_EVERY} = 0 THEN {q(K.DEFAULT_USER_NAME)} "
            f"ELSE 'Cliente ' || CAST(conv_id AS VARCHAR) END AS user_name, text "
            f"FROM conversations WHERE role = 'user' AND text IS NOT NULL AND conv_id IS NOT NULL), "
            "qn AS (SELECT q_id, user_name, text, lower(trim(text)) AS t FROM questions)")


def questions_cte() -> str:
    parts = [f"SELECT conv_id * {T.QID_CONVERSATION_FACTOR} + turn AS q_id, "
             f"'Cliente ' || CAST(conv_id AS VARCHAR) AS user_name, text FROM conversations "
             f"WHERE role = 'user' AND text IS NOT NULL"]
    names = {"sub": "lower(subcategoria)", "cat": "lower(categoria)"}
    for i, (pre, what, post) in enumerate(T.PAIR_TEMPLATES):
        parts.append(f"SELECT -({T.QID_PAIR_BASE} + sk_categoria * 10 + {i}), 'Parceiro', "
                     f"{q(pre)} || {names[what]} || {q(post)} FROM dim_category")
    fmts = {"br": "strftime(data, '%d/%m/%Y')", "iso": "strftime(data, '%Y-%m-%d')"}
    for i, (pre, what, post) in enumerate(T.DATE_TEMPLATES):
        parts.append(f"SELECT -({T.QID_DATE_BASE} + CAST(strftime(data, '%Y%m%d') AS BIGINT) * 10 "
                     f"+ {i}), 'Parceiro', {q(pre)} || {fmts[what]} || {q(post)} FROM dim_calendar")
    vals = ", ".join(f"({-(T.QID_FIXED_BASE + i)}, 'Parceiro', {q(t)})"
                     for i, t in enumerate(T.FIXED_QUESTIONS))
    parts.append(f"SELECT * FROM (VALUES {vals})")
    return ("questions AS (" + " UNION ALL ".join(parts) + "), "
            "qn AS (SELECT q_id, user_name, text, lower(trim(text)) AS t FROM questions)")


def lexicon_cte() -> str:
    rows = [(i, k, c, s, "subcategoria") for i, (k, c, s) in enumerate(K.SUBCATEGORY_KEYWORDS)]
    base = len(rows)
    rows += [(base + i, k, c, None, "categoria") for i, (k, c) in enumerate(K.CATEGORY_KEYWORDS)]

    def v(x):
        return "NULL" if x is None else (str(x) if isinstance(x, int) else q(x))
    vals = ", ".join("(" + ", ".join(v(x) for x in r) + ")" for r in rows)
    b = T.DATA_LEXICON_BASE
    return (f"lexicon AS (SELECT * FROM (VALUES {vals}) v(priority, keyword, categoria, "
            f"subcategoria, nivel) "
            f"UNION ALL SELECT CAST({b} + min(sk_categoria) AS INTEGER), lower(subcategoria), "
            f"CASE WHEN count(DISTINCT categoria) = 1 THEN min(categoria) END, subcategoria, "
            f"'subcategoria' FROM dim_category GROUP BY subcategoria "
            f"HAVING lower(subcategoria) IS NOT NULL AND lower(subcategoria) <> '' "
            f"UNION ALL SELECT CAST({2 * b} + min(sk_categoria) AS INTEGER), lower(categoria), "
            f"categoria, NULL, 'categoria' FROM dim_category GROUP BY categoria "
            f"HAVING lower(categoria) IS NOT NULL AND lower(categoria) <> '')")


def ents_cte() -> str:
    """Whole-word keyword hits, brute force over every (question, keyword).

    With every non-word character mapped to a space (one constant regex, so
    nothing is compiled per pair), a keyword made of word characters and
    single spaces occurs as a whole word exactly when `` keyword `` occurs in
    the padded, mapped text (and the keyword occurs in the raw text)."""
    return ("qm AS (SELECT q_id, t, ' ' || regexp_replace(t, '" + NW + "', ' ', 'g') || ' ' AS tm "
            "FROM qn), "
            "hits AS (SELECT qm.q_id, l.* FROM qm JOIN lexicon l ON "
            "contains(qm.tm, ' ' || l.keyword || ' ') AND contains(qm.t, l.keyword)), "
            "ents AS (SELECT q_id, "
            "arg_min({'k': keyword, 'c': categoria, 's': subcategoria}, priority) "
            "FILTER (WHERE nivel = 'subcategoria') AS s_, "
            "arg_min({'k': keyword, 'c': categoria}, priority) FILTER (WHERE nivel = 'categoria') AS c_ "
            "FROM hits GROUP BY q_id), "
            "ents2 AS (SELECT q_id, s_.k AS sub_keyword, s_.c AS sub_parent, s_.s AS sub_name, "
            "c_.k AS cat_keyword, c_.c AS cat_name FROM ents)")


def glossary_cte() -> str:
    vals = ", ".join(f"({i}, {q(t)}, {q(s)}, {q(e)})" for i, (t, s, e) in enumerate(K.GLOSSARY))
    concept = R.CONCEPT_RE
    forms = ("SELECT pos, ls AS form FROM g UNION ALL SELECT pos, lt FROM g")
    return (f"g AS (SELECT pos, termo, sigla, explicacao, lower(trim(sigla)) AS ls, "
            f"lower(trim(termo)) AS lt FROM (VALUES {vals}) v(pos, termo, sigla, explicacao)), "
            f"gexact AS (SELECT qn.q_id, g.pos FROM qn JOIN g ON length(g.ls) >= 3 AND qn.t IN "
            f"(g.ls, 'o que e ' || g.ls, 'o que é ' || g.ls, g.ls || '?')), "
            f"gforms AS ({forms}), "
            f"gpref AS (SELECT r.q_id, f.pos FROM qn r JOIN gforms f ON regexp_matches(r.t, {q(concept)}) AND "
            f"length(regexp_replace(f.form, '{NW}+', '', 'g')) > 0 AND regexp_matches(r.t, "
            f"{q(concept)} || regexp_replace(f.form, '([.^$*+?()\\[\\]{{}}|\\\\/-])', '\\\\\\1', 'g') || "
            f"'({NW}|$)')), "
            f"ghits AS (SELECT * FROM gexact UNION ALL SELECT * FROM gpref), "
            f"gl AS (SELECT h.q_id, arg_min({{'s': g.sigla, 't': g.termo, 'e': g.explicacao}}, g.pos) AS b "
            f"FROM ghits h JOIN g ON h.pos = g.pos GROUP BY h.q_id), "
            f"gl2 AS (SELECT q_id, b.s AS sigla, b.t AS termo, "
            f"COALESCE(NULLIF(trim(b.e), ''), b.t) AS definicao FROM gl)")


def taxmatch_cte() -> str:
    return (f"cats AS (SELECT categoria, min(sk_categoria) AS pos FROM dim_category GROUP BY categoria), "
            f"asks AS (SELECT q_id, t, trim(regexp_extract(t, {q(K.SUBCATEGORIES_OF_PATTERN)}, 1)) AS term "
            f"FROM qn), "
            f"tx AS (SELECT a.q_id, arg_min(c.categoria, c.pos) AS lista_categoria FROM asks a JOIN cats c "
            f"ON a.term <> '' AND NOT {_any_contains(K.SALES_WORDS_BLOCKING_LIST, 'a.t')} AND "
            f"(contains(lower(c.categoria), a.term) OR contains(a.term, lower(c.categoria))) "
            f"GROUP BY a.q_id)")


def _period_word(w: str, t: str = "t") -> str:
    return (f"(regexp_matches({t}, {q(word_pattern(w))}) AND NOT regexp_matches({t}, "
            f"{q(word_pattern(w + ' passado'))}) AND NOT regexp_matches({t}, "
            f"{q(word_pattern(w + ' anterior'))}))")


def period_select(ref_sql: str, src: str) -> str:
    """Adds the period columns to ``src`` (must have ``t``); ``ref_sql`` = DATE expr."""
    ytd = " OR ".join(_period_word(w) for w in K.YTD_WORDS)
    mtd = " OR ".join(_period_word(w) for w in K.MTD_WORDS)
    yday = " OR ".join(_period_word(w) for w in K.YESTERDAY_WORDS)
    r = ref_sql
    iso = [f"regexp_extract(t, {q(R.ISO_RE)}, {i})" for i in (2, 3, 4)]
    br = [f"regexp_extract(t, {q(R.BR_RE)}, {i})" for i in (2, 3, 4)]
    return f"""SELECT *,
      CASE WHEN kind_ = 'date' AND day_ IS NULL THEN 'invalid_period' ELSE 'ok' END AS period_status
    FROM (SELECT *,
      CASE kind_ WHEN 'ytd' THEN 'YTDA ' || CAST(year({r}) AS VARCHAR) || ' (Acumulado no Ano até '
             || strftime({r}, '%Y-%m-%d') || ')'
           WHEN 'mtd' THEN 'MTD (Acumulado no Mês ' || lpad(CAST(month({r}) AS VARCHAR), 2, '0') || '/'
             || CAST(year({r}) AS VARCHAR) || ' até ' || strftime({r}, '%Y-%m-%d') || ')'
           WHEN 'yesterday' THEN 'Ontem (' || strftime(CAST({r} - INTERVAL 1 DAY AS DATE), '%Y-%m-%d') || ')'
           WHEN 'date' THEN CASE WHEN iso_y <> '' THEN 'Data ' || iso_y || '-' || iso_m || '-' || iso_d
                 ELSE 'Data ' || lpad(br_d, 2, '0') || '/' || lpad(br_m, 2, '0') || '/' || br_year END
           ELSE 'Hoje (' || strftime({r}, '%Y-%m-%d') || ')' END AS periodo,
      CASE kind_ WHEN 'ytd' THEN make_date(year({r}), 1, 1)
           WHEN 'mtd' THEN make_date(year({r}), month({r}), 1)
           WHEN 'yesterday' THEN CAST({r} - INTERVAL 1 DAY AS DATE)
           WHEN 'date' THEN day_ ELSE {r} END AS inicio,
      CASE WHEN kind_ IN ('ytd', 'mtd', 'today') THEN {r}
           WHEN kind_ = 'yesterday' THEN CAST({r} - INTERVAL 1 DAY AS DATE) ELSE day_ END AS fim,
      CASE WHEN kind_ IN ('ytd', 'mtd') THEN CAST(year({r}) AS INTEGER) END AS p_ano,
      CASE WHEN kind_ = 'mtd' THEN CAST(month({r}) AS INTEGER) END AS p_mes,
      kind_ AS kind
    FROM (SELECT *,
      CASE WHEN {ytd} THEN 'ytd' WHEN {mtd} THEN 'mtd' WHEN {yday} THEN 'yesterday'
           WHEN iso_y <> '' OR br_d <> '' THEN 'date' ELSE 'today' END AS kind_,
      CASE WHEN iso_y <> '' THEN TRY_CAST(iso_y || '-' || iso_m || '-' || iso_d AS DATE)
           WHEN br_d <> '' THEN TRY_CAST(br_year || '-' || lpad(br_m, 2, '0') || '-' || lpad(br_d, 2, '0') AS DATE)
           END AS day_
    FROM (SELECT *, {iso[0]} AS iso_y, {iso[1]} AS iso_m, {iso[2]} AS iso_d,
                    {br[0]} AS br_d, {br[1]} AS br_m,
                    CASE WHEN {br[2]} <> '' THEN {br[2]} ELSE CAST(year({r}) AS VARCHAR) END AS br_year
          FROM {src})))"""


REF_SCALAR = "(SELECT max(data) FROM analytic)"


def routed_cte() -> str:
    t = "t"
    metadata = (f"(contains(t, {q(K.METADATA_WORD)}) AND {_any_contains(K.METADATA_WORDS)} "
                f"AND NOT {_any_contains(K.METADATA_EXCLUSIONS)})")
    dyn_term = f"regexp_extract(t, {q(K.DYNAMIC_SUBCATEGORY_PATTERN)}, 1)"
    for stop in K.DYNAMIC_STOP_PHRASES:
        dyn_term = f"trim(replace({dyn_term}, {q(stop)}, ''))"
    with_parent = fill_sql(K.WARN_SUB_AS_CATEGORY_WITH_PARENT, sub="sub_name", parent="sub_parent")
    no_parent = fill_sql(K.WARN_SUB_AS_CATEGORY, sub="sub_name")
    reverse = fill_sql(K.WARN_CATEGORY_AS_SUB, cat="cat_name")
    analytic_nonmeta = ", ".join(q(i) for i in R.ANALYTIC_INTENTS if i != "metadados")
    return f"""flags AS (SELECT qn.*, {_any_contains(K.SUBCATEGORY_SYNONYMS)} AS disse_subcategoria,
        {_any_contains(K.CATEGORY_SYNONYMS)} AND NOT {_any_contains(K.SUBCATEGORY_SYNONYMS)} AS disse_categoria
      FROM qn),
    base0 AS (SELECT f.*, e.sub_keyword, e.sub_parent, e.sub_name, e.cat_keyword, e.cat_name,
        gl2.sigla, gl2.termo, gl2.definicao, tx.lista_categoria
      FROM flags f LEFT JOIN ents2 e ON f.q_id = e.q_id LEFT JOIN gl2 ON f.q_id = gl2.q_id
      LEFT JOIN tx ON f.q_id = tx.q_id),
    dcand AS (SELECT q_id, trim({dyn_term}) AS term FROM base0
      WHERE disse_subcategoria AND sub_name IS NULL),
    pairs AS (SELECT DISTINCT categoria, subcategoria FROM dim_category),
    dyn AS (SELECT q_id, term AS dyn_term, categoria AS dyn_parent, subcategoria AS dyn_name FROM (
      SELECT d.q_id, d.term, p.categoria, p.subcategoria, row_number() OVER (PARTITION BY d.q_id
        ORDER BY p.categoria, p.subcategoria) AS rn
      FROM dcand d JOIN pairs p ON d.term <> '' AND contains(lower(p.subcategoria), d.term)) WHERE rn = 1),
    base AS (SELECT b.* EXCLUDE (sub_keyword, sub_parent, sub_name),
        COALESCE(b.sub_keyword, d.dyn_term) AS sub_keyword,
        CASE WHEN b.sub_name IS NOT NULL THEN b.sub_parent ELSE d.dyn_parent END AS sub_parent,
        COALESCE(b.sub_name, d.dyn_name) AS sub_name
      FROM base0 b LEFT JOIN dyn d ON b.q_id = d.q_id),
    periods AS ({period_select(REF_SCALAR, 'base')}),
    intents AS (SELECT *,
      CASE WHEN t IN ({', '.join(q(x) for x in K.GREETING_COMMANDS)}) THEN 'saudacao'
        WHEN contains(t, {q(K.DEMO_WORD)}) AND {_any_contains(K.DEMO_CONTEXT_WORDS)} THEN 'demo'
        WHEN {_any_contains(K.LIST_CATEGORIES_PHRASES)} THEN 'listar_categorias'
        WHEN lista_categoria IS NOT NULL THEN 'listar_subcategorias'
        WHEN sigla IS NOT NULL THEN 'glossario'
        WHEN {metadata} THEN 'metadados'
        WHEN sub_name IS NOT NULL THEN 'subcategoria'
        WHEN cat_name IS NOT NULL THEN 'categoria'
        WHEN disse_subcategoria AND {_any_contains(K.RANKING_WORDS_SUBCATEGORY)} THEN 'ranking_subcategorias'
        WHEN disse_categoria AND {_any_contains(K.RANKING_WORDS_CATEGORY)} THEN 'ranking_categorias'
        WHEN {_any_contains(K.PRODUCT_WORDS)} THEN 'ranking_produtos'
        WHEN {_any_contains(K.TOTAL_WORDS)} AND NOT disse_subcategoria AND NOT disse_categoria
          AND sub_name IS NULL AND cat_name IS NULL AND NOT {_any_contains(K.TOTAL_EXCLUSIONS)} THEN 'total'
        ELSE 'sem_resposta' END AS intent,
      CASE WHEN disse_categoria AND sub_name IS NOT NULL AND cat_name IS NULL THEN
             CASE WHEN sub_parent IS NOT NULL THEN {with_parent} ELSE {no_parent} END
           WHEN disse_subcategoria AND cat_name IS NOT NULL AND sub_name IS NULL THEN {reverse}
           END AS aviso
      FROM periods),
    routed AS (SELECT q_id, user_name, text, intent,
        CASE WHEN intent = 'sem_resposta' THEN 'unanswered'
             WHEN intent IN ({analytic_nonmeta}) AND period_status <> 'ok' THEN period_status
             ELSE 'ok' END AS status,
        kind, periodo, inicio, fim, p_ano, p_mes,
        CASE WHEN intent = 'subcategoria' THEN sub_parent WHEN intent = 'categoria' THEN cat_name
             END AS categoria,
        CASE WHEN intent = 'subcategoria' THEN sub_name END AS subcategoria,
        aviso, sigla, termo, definicao, lista_categoria
      FROM intents)"""


def routing_with(*extra: str, source=None) -> str:
    return O.with_layers("analytic", "dim_calendar", "dim_category", extra=[
        (source or questions_cte)(), lexicon_cte(), ents_cte(), glossary_cte(), taxmatch_cte(),
        *extra])


MATCH_ENTITIES = routing_with() + " SELECT * FROM ents2"
GLOSSARY_LOOKUP = routing_with() + " SELECT * FROM gl2"
TAXONOMY_MATCH = routing_with() + " SELECT * FROM tx"
RESOLVE_PERIOD = (routing_with() + " SELECT q_id, kind, periodo, inicio, fim, p_ano, p_mes, "
                  "period_status FROM (" + period_select(REF_SCALAR, "qn") + ")")
ROUTE_QUESTIONS = routing_with(routed_cte()) + " SELECT * FROM routed"
LEVEL_WARNING = (routing_with(routed_cte())
                 + " SELECT q_id, intent, aviso FROM routed WHERE aviso IS NOT NULL")


def answers_cte() -> str:
    top = A.TOP_N
    return f"""rq AS (SELECT *, concat_ws('|', kind, CAST(inicio AS VARCHAR), CAST(fim AS VARCHAR)) AS pkey
      FROM routed WHERE status = 'ok'),
    pset AS (SELECT DISTINCT pkey, kind, inicio, fim, p_ano, p_mes FROM rq WHERE intent IN
      ('subcategoria', 'categoria', 'ranking_subcategorias', 'ranking_categorias', 'ranking_produtos', 'total')),
    prow AS (SELECT p.pkey, a.* FROM analytic a JOIN pset p ON
      (p.kind IN ('mtd', 'ytd') AND a.ano = p.p_ano AND (p.p_mes IS NULL OR a.mes = p.p_mes)
        AND a.data <= p.fim) OR (p.kind NOT IN ('mtd', 'ytd') AND a.data = p.inicio)),
    cs AS (SELECT pkey, categoria, subcategoria, SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat,
      SUM(qtd_vendas_num) AS qtd FROM prow GROUP BY ALL),
    cat AS (SELECT pkey, categoria, SUM(fat) AS fat, SUM(qtd) AS qtd FROM cs GROUP BY ALL),
    tot AS (SELECT pkey, SUM(fat) AS fat, SUM(qtd) AS qtd FROM cs GROUP BY ALL),
    prod AS (SELECT pkey, titulo_produto, marca, categoria, subcategoria,
      SUM(TRY_CAST(fat_num AS DECIMAL(28,2))) AS fat, SUM(qtd_vendas_num) AS qtd FROM prow GROUP BY ALL),
    prodtop AS (SELECT * EXCLUDE (r_) FROM (SELECT *, row_number() OVER (PARTITION BY pkey ORDER BY
      fat DESC NULLS LAST, titulo_produto ASC NULLS FIRST, marca ASC NULLS FIRST,
      categoria ASC NULLS FIRST, subcategoria ASC NULLS FIRST) AS r_ FROM prod) WHERE r_ <= {top}),
    found AS (
      SELECT r.q_id, r.intent, r.periodo, c.categoria, c.subcategoria, NULL::VARCHAR AS titulo_produto,
        NULL::VARCHAR AS marca, c.fat, c.qtd FROM rq r JOIN cs c ON r.pkey = c.pkey
        WHERE r.intent = 'subcategoria' AND c.subcategoria = r.subcategoria
          AND (r.categoria IS NULL OR c.categoria = r.categoria)
      UNION ALL SELECT r.q_id, r.intent, r.periodo, c.categoria, NULL, NULL, NULL, c.fat, c.qtd
        FROM rq r JOIN cat c ON r.pkey = c.pkey WHERE r.intent = 'categoria' AND c.categoria = r.categoria
      UNION ALL SELECT r.q_id, r.intent, r.periodo, c.categoria, c.subcategoria, NULL, NULL, c.fat, c.qtd
        FROM rq r JOIN cs c ON r.pkey = c.pkey WHERE r.intent = 'ranking_subcategorias'
      UNION ALL SELECT r.q_id, r.intent, r.periodo, c.categoria, NULL, NULL, NULL, c.fat, c.qtd
        FROM rq r JOIN cat c ON r.pkey = c.pkey WHERE r.intent = 'ranking_categorias'
      UNION ALL SELECT r.q_id, r.intent, r.periodo, p.categoria, p.subcategoria, p.titulo_produto,
        p.marca, p.fat, p.qtd FROM rq r JOIN prodtop p ON r.pkey = p.pkey WHERE r.intent = 'ranking_produtos'
      UNION ALL SELECT r.q_id, r.intent, r.periodo, NULL, NULL, NULL, NULL, t.fat, t.qtd
        FROM rq r LEFT JOIN tot t ON r.pkey = t.pkey WHERE r.intent = 'total'),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY fat DESC NULLS LAST,
      categoria ASC NULLS FIRST, subcategoria ASC NULLS FIRST, titulo_produto ASC NULLS FIRST,
      marca ASC NULLS FIRST) AS linha FROM found),
    answers AS (
      SELECT q_id, intent, CAST(linha AS INTEGER) AS linha, periodo, categoria, subcategoria,
        titulo_produto, marca,
        CAST(fat AS DOUBLE) AS faturamento, CAST(qtd AS BIGINT) AS vendas,
        NULL::VARCHAR AS data_mais_recente, NULL::BIGINT AS total_registros
      FROM ranked WHERE intent <> 'ranking_subcategorias' OR linha <= {top}
      UNION ALL SELECT q_id, intent, CAST(1 AS INTEGER), NULL, NULL, NULL, NULL, NULL, NULL, NULL,
        (SELECT CAST(max(data) AS VARCHAR) FROM analytic), (SELECT count(*) FROM analytic)
      FROM rq WHERE intent = 'metadados')"""


ANSWER_QUESTIONS = routing_with(routed_cte(), answers_cte()) + " SELECT * FROM answers"


def _cell_sql(name: str, kind: str) -> str:
    src = {"faturamento_total": "faturamento", "total_pedidos": "vendas"}.get(name, name)
    if kind == "m":
        txt = f"'R$ ' || translate(format('{{:,.2f}}', {src}), ',.', '.,')"
    elif kind == "i":
        txt = f"translate(format('{{:,}}', {src}), ',.', '.,')"
    else:
        txt = f"NULLIF({src}, '')"
    title = name.replace("_", " ").title()
    return f"'*{title}:* ' || COALESCE({txt}, '-')"


def format_cte() -> str:
    cases = " ".join(
        f"WHEN intent = {q(i)} THEN '• ' || concat_ws(' | ', {', '.join(_cell_sql(n, k) for n, k in cols)})"
        for i, cols in A.DISPLAY.items())
    n = K.BULLET_ROWS
    header = fill_sql(K.REPLY_HEADER, user="r.user_name")
    question = fill_sql(K.REPLY_QUESTION, question="r.text")
    more = fill_sql(K.REPLY_MORE, n=f"CAST(c.n_linhas - {n} AS VARCHAR)")
    empty = fill_sql(K.REPLY_EMPTY, user="r.user_name")
    footer = q(K.REPLY_FOOTER.split("{ref}")[0]) + " || (SELECT CAST(max(data) AS VARCHAR) FROM analytic) || " \
        + q(K.REPLY_FOOTER.split("{ref}")[1])
    intents = ", ".join(q(i) for i in A.DISPLAY)
    return f"""bl AS (SELECT q_id, linha, CASE {cases} END AS bullet FROM answers WHERE linha <= {n}),
    perq AS (SELECT q_id, string_agg(bullet, chr(10) ORDER BY linha) AS bullets FROM bl GROUP BY q_id),
    cnt AS (SELECT q_id, count(*) AS n_linhas FROM answers GROUP BY q_id),
    replies AS (SELECT r.q_id, COALESCE(c.n_linhas, 0) AS n_linhas,
      CASE WHEN p.bullets IS NULL THEN {empty} ELSE
        {header} || CASE WHEN r.aviso IS NOT NULL THEN r.aviso || chr(10) ELSE '' END || {question}
        || p.bullets || CASE WHEN c.n_linhas > {n} THEN {more} ELSE '' END || {footer} END AS resposta
      FROM routed r LEFT JOIN perq p ON r.q_id = p.q_id LEFT JOIN cnt c ON r.q_id = c.q_id
      WHERE r.intent IN ({intents}) AND r.status = 'ok')"""


FORMAT_RESULT_ROWS = routing_with(routed_cte(), answers_cte(), format_cte()) + " SELECT * FROM replies"


STREAM_ROUTE_QUESTIONS = (routing_with(routed_cte(), source=updates_questions_cte)
                          + " SELECT * FROM routed")

def dictionary_cte() -> str:
    header = fill_sql(K.REPLY_HEADER, user="r.user_name")
    question = fill_sql(K.REPLY_QUESTION, question="r.text")
    foot = K.REPLY_FOOTER.split("{ref}")
    footer = f"{q(foot[0])} || (SELECT CAST(max(data) AS VARCHAR) FROM analytic) || {q(foot[1])}"
    gl = fill_sql(K.REPLY_GLOSSARY, sigla="upper(r.sigla)", termo="r.termo", definicao="r.definicao")
    hi = fill_sql(K.REPLY_GREETING, user="r.user_name", ref="(SELECT CAST(max(data) AS VARCHAR) FROM analytic)",
                  rows="translate(format('{:,}', (SELECT count(*) FROM analytic)), ',', '.')")
    listing = f"{header} || {question} || b.bullets || {footer}"
    return f"""flat AS (SELECT DISTINCT categoria, subcategoria, marca FROM silver),
    catsum AS (SELECT categoria, count(DISTINCT subcategoria) AS n_subcategorias FROM flat GROUP BY categoria),
    catb AS (SELECT string_agg('• *Categoria:* ' || COALESCE(categoria, '-') || ' | *Subcategorias:* '
        || CAST(n_subcategorias AS VARCHAR), chr(10) ORDER BY categoria ASC NULLS FIRST) AS bullets
      FROM catsum),
    catc AS (SELECT count(*) AS n_linhas FROM catsum),
    subr AS (SELECT *, row_number() OVER (PARTITION BY categoria, subcategoria ORDER BY marca ASC NULLS FIRST) AS rn FROM flat),
    subsum AS (SELECT categoria, subcategoria, count(marca) AS n_marcas,
        string_agg(marca, ', ' ORDER BY rn) FILTER (WHERE rn <= 3) AS exemplos FROM subr GROUP BY categoria, subcategoria),
    subb AS (SELECT categoria, string_agg('• *Subcategoria:* ' || COALESCE(subcategoria, '-') || ' | *Marcas:* '
        || CAST(n_marcas AS VARCHAR) || ' | *Exemplos:* ' || COALESCE(exemplos, '-'), chr(10) ORDER BY subcategoria ASC NULLS FIRST) AS bullets
      FROM subsum GROUP BY categoria),
    subc AS (SELECT categoria, count(*) AS n_linhas FROM subsum GROUP BY categoria),
    dict_replies AS (
      SELECT r.q_id, c.n_linhas, {listing} AS resposta FROM routed r, catb b, catc c
        WHERE r.intent = 'listar_categorias' AND r.status = 'ok'
      UNION ALL SELECT r.q_id, c.n_linhas, {listing} FROM routed r JOIN subb b ON b.categoria = r.lista_categoria
        JOIN subc c ON c.categoria = r.lista_categoria WHERE r.intent = 'listar_subcategorias'
      UNION ALL SELECT r.q_id, 1, {gl} FROM routed r WHERE r.intent = 'glossario'
      UNION ALL SELECT r.q_id, 1, {hi} FROM routed r WHERE r.intent = 'saudacao')"""


DICTIONARY_REPLIES = routing_with(routed_cte(), dictionary_cte()) + " SELECT * FROM dict_replies"

# Every reply of the message loop: from result rows, from the dictionary, and the
# reply for no data to all other questions.
STREAM_REPLIES = (routing_with(routed_cte(), answers_cte(), format_cte(), dictionary_cte(),
                               source=updates_questions_cte)
                  + f""", known AS (SELECT q_id, n_linhas, resposta, 'linhas' AS origem FROM replies
      UNION ALL SELECT q_id, n_linhas, resposta, 'dicionario' FROM dict_replies)
    SELECT * FROM known UNION ALL SELECT r.q_id, 0, {fill_sql(K.REPLY_EMPTY, user="r.user_name")}, 'padrao'
      FROM routed r WHERE NOT EXISTS (SELECT 1 FROM known k WHERE k.q_id = r.q_id)""")

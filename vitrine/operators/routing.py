"""Question routing over a table of questions (one row per question).

Steps: normalize -> mention flags -> keyword entities (n-gram equi-join with
the lexicon, then an exact word-boundary check) -> glossary -> taxonomy match
-> dynamic subcategory lookup -> level warning -> period -> intent.

Keyword matching: a naive "every question x every keyword regex" is a cross
product. Instead each question's text is split into word n-grams (n up to the
longest keyword), joined on equality with the keywords' normalized form, and
only those candidates are checked with the exact regex. Priority (the
declaration order of the lexicon) picks the first match with ``min_by``.

Word boundaries are explicit classes, ``[^\\p{L}\\p{M}\\p{N}_]``, identical in
Java regex and RE2, so accents never split a word.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine import constants as K
from vitrine.functions.formatting import fill, regex_escape, word_match, word_pattern_col
from vitrine.operators import substring as Sub
from vitrine.operators.keys import broadcast_if_small

NW = r"[^\p{L}\p{M}\p{N}_]"
TOKEN_SPLIT = NW + "+"
ISO_RE = rf"(^|{NW})(\d{{4}})-(\d{{2}})-(\d{{2}})({NW}|$)"
BR_RE = rf"(^|{NW})(\d{{1,2}})[/.-](\d{{1,2}})(?:[/.-](\d{{4}}))?({NW}|$)"
# A phrase that asks for a term, followed by white space, anywhere in a text.
CONCEPT_RE = (rf"(^|{NW})(" + "|".join(regex_escape(p) for p in K.CONCEPT_PREFIXES)
              + r")[ \t\n\x0B\f\r]+")

ANALYTIC_INTENTS = ["metadados", "subcategoria", "categoria", "ranking_subcategorias",
                    "ranking_categorias", "ranking_produtos", "total"]


def _any_contains(t: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [t.contains(w) for w in words])


def normalize(questions: DataFrame) -> DataFrame:
    return questions.withColumn("t", F.lower(F.trim(F.col("text"))))


def tokens(c: Column) -> Column:
    return F.filter(F.split(c, TOKEN_SPLIT), lambda x: x != "")


def ngrams(df: DataFrame, max_n: int, text: str = "t") -> DataFrame:
    """(q_id, gram): distinct word n-grams (1..max_n) of each question.
    Tokens are computed once per row (a column), not inside the lambda."""
    toks = F.col("_toks")

    def gram_at(n):  # one-argument lambda: transform() reads two as (element, index)
        return lambda i: F.array_join(F.slice(toks, i + 1, n), " ")
    per_n = [F.when(F.size(toks) >= n, F.transform(F.sequence(F.lit(0), F.size(toks) - n),
                                                    gram_at(n)))
             .otherwise(F.array().cast("array<string>")) for n in range(1, max_n + 1)]
    return (df.select("q_id", tokens(F.col(text)).alias("_toks"))
            .select("q_id", F.explode(F.array_distinct(F.flatten(F.array(*per_n)))).alias("gram")))


def prepare_lexicon(lexicon: DataFrame):
    """Lexicon with its n-gram key, size-checked for broadcast, and the
    longest keyword (in words). Done once per lexicon (e.g. once per stream)."""
    lex = lexicon.withColumn("gram", F.array_join(tokens(F.col("keyword")), " ")) \
                 .filter(F.col("gram") != "")
    max_n = lex.agg(F.max(F.size(tokens(F.col("keyword"))))).first()[0] or 1
    return broadcast_if_small(lex), int(max_n)


def match_entities(q: DataFrame, lexicon: DataFrame, prepared=None) -> DataFrame:
    """First subcategory keyword and first category keyword found in each
    question (by lexicon priority). Output: q_id, sub_keyword, sub_parent,
    sub_name, cat_keyword, cat_name (only questions with a match)."""
    lex, max_n = prepared or prepare_lexicon(lexicon)
    cand = ngrams(q, max_n).join(lex, "gram")
    hits = (cand.join(q.select("q_id", "t"), "q_id")
            .filter(F.regexp_like(F.col("t"), word_pattern_col(F.col("keyword")))))
    is_sub = F.col("nivel") == "subcategoria"
    sub_rank = F.when(is_sub, F.col("priority"))
    cat_rank = F.when(~is_sub, F.col("priority"))
    agg = hits.groupBy("q_id").agg(
        F.min_by(F.struct("keyword", "categoria", "subcategoria"), sub_rank).alias("s"),
        F.min_by(F.struct("keyword", "categoria"), cat_rank).alias("c"),
        F.min(sub_rank).alias("_sr"), F.min(cat_rank).alias("_cr"))
    return agg.select(
        "q_id",
        F.when(F.col("_sr").isNotNull(), F.col("s.keyword")).alias("sub_keyword"),
        F.when(F.col("_sr").isNotNull(), F.col("s.categoria")).alias("sub_parent"),
        F.when(F.col("_sr").isNotNull(), F.col("s.subcategoria")).alias("sub_name"),
        F.when(F.col("_cr").isNotNull(), F.col("c.keyword")).alias("cat_keyword"),
        F.when(F.col("_cr").isNotNull(), F.col("c.categoria")).alias("cat_name"))


def prepare_glossary(glossary: DataFrame):
    """Glossary forms for the equality path and n-gram keys for the prefix
    path (both size-checked for broadcast), plus the longest form in words."""
    g = glossary.select("pos", "termo", "sigla", "explicacao",
                        F.lower(F.trim("sigla")).alias("ls"), F.lower(F.trim("termo")).alias("lt"))
    forms = g.filter(F.length("ls") >= 3).select(
        "pos", F.explode(F.array(F.col("ls"), F.concat(F.lit("o que e "), "ls"),
                                 F.concat(F.lit("o que é "), "ls"),
                                 F.concat("ls", F.lit("?")))).alias("t"))
    keys = g.select("pos", F.explode(F.array("ls", "lt")).alias("form")) \
            .withColumn("gram", F.array_join(tokens(F.col("form")), " ")).filter("gram != ''")
    max_n = keys.agg(F.max(F.size(tokens(F.col("form"))))).first()[0] or 1
    return broadcast_if_small(g), broadcast_if_small(forms), broadcast_if_small(keys), int(max_n)


def glossary_lookup(q: DataFrame, glossary: DataFrame, prepared=None) -> DataFrame:
    """First glossary entry (by position) asked about: "o que é <sigla|termo>"
    and its variants, or the bare sigla (3+ characters). The definition falls
    back to the term when empty."""
    g, forms, keys, max_n = prepared or prepare_glossary(glossary)
    # (a) whole-text forms of the sigla: equality join on the question text
    exact = q.select("q_id", "t").join(forms, "t").select("q_id", "pos")
    # (b) "<prefix> <sigla|termo>" after any prefix of the whole text: the text's
    # word n-grams equi-joined with the forms, then the exact pattern
    asks = q.filter(F.regexp_like("t", F.lit(CONCEPT_RE))).select("q_id", "t")
    pref = (ngrams(asks, max_n).join(keys, "gram").join(asks, "q_id")
            .filter(F.regexp_like(F.col("t"), F.concat(F.lit(CONCEPT_RE + r"\Q"), F.col("form"),
                                                       F.lit(r"\E(" + NW + "|$)"))))
            .select("q_id", "pos").distinct())
    hits = exact.unionByName(pref).join(g, "pos")
    best = hits.groupBy("q_id").agg(
        F.min_by(F.struct("sigla", "termo", "explicacao"), F.col("pos")).alias("g"))
    return best.select("q_id", F.col("g.sigla").alias("sigla"), F.col("g.termo").alias("termo"),
                       F.coalesce(F.nullif(F.trim("g.explicacao"), F.lit("")), F.col("g.termo"))
                       .alias("definicao"))


def prepare_categories(categories: DataFrame):
    """Category names posted under their character runs, how often each run occurs,
    and the names keyed by their own rarest one (to be found inside terms)."""
    names = categories.select("categoria", "pos", F.lower("categoria").alias("lc"))
    posted, counts = prepare_names(names, "lc")
    inner = Sub.keyed(names, "lc", counts, ["categoria", "pos"])
    return posted, counts, broadcast_if_small(inner)


def prepare_names(names: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    posted = Sub.postings(names, column)
    return broadcast_if_small(posted), broadcast_if_small(Sub.frequencies(posted))


def taxonomy_match(q: DataFrame, categories: DataFrame, prepared=None) -> DataFrame:
    """"subcategorias de X" (not a sales question): the first category (by
    position) whose lower-cased name contains X or is contained in X."""
    term = F.trim(F.regexp_extract("t", K.SUBCATEGORIES_OF_PATTERN, 1))
    asks = (q.select("q_id", "t", term.alias("term"))
            .filter((F.col("term") != "") & ~_any_contains(F.col("t"), K.SALES_WORDS_BLOCKING_LIST)))
    posted, counts, inner = prepared or prepare_categories(categories)
    asks = asks.select("q_id", "term")
    around = Sub.containing(Sub.keyed(asks, "term", counts, ["q_id"]), "term", posted, "lc")
    inside = Sub.containing(inner, "lc", Sub.postings(asks, "term"), "term")
    j = around.select("q_id", "categoria", "pos").unionByName(inside.select("q_id", "categoria", "pos"))
    return j.groupBy("q_id").agg(F.min_by("categoria", "pos").alias("lista_categoria"))


def prepare_pairs(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    return prepare_names(pairs.select("categoria", "subcategoria").distinct()
                         .withColumn("ls", F.lower("subcategoria")), "ls")


def dynamic_subcategory(q: DataFrame, pairs: DataFrame, prepared=None) -> DataFrame:
    """For "subcategoria X" questions without a lexicon hit: the first
    (categoria, subcategoria) in name order whose subcategory contains X."""
    term = F.regexp_extract("t", K.DYNAMIC_SUBCATEGORY_PATTERN, 1)
    for stop in K.DYNAMIC_STOP_PHRASES:
        term = F.trim(F.replace(term, F.lit(stop), F.lit("")))
    cand = q.select("q_id", F.trim(term).alias("term")).filter("term != ''")
    posted, counts = prepared or prepare_pairs(pairs)
    j = Sub.containing(Sub.keyed(cand, "term", counts, ["q_id"]), "term", posted, "ls")
    best = j.groupBy("q_id", "term").agg(F.min(F.struct("categoria", "subcategoria")).alias("m"))
    return best.select("q_id", F.col("term").alias("dyn_term"),
                       F.col("m.categoria").alias("dyn_parent"),
                       F.col("m.subcategoria").alias("dyn_name"))


def _period_word(t: Column, w: str) -> Column:
    return word_match(t, w) & ~word_match(t, w + " passado") & ~word_match(t, w + " anterior")


def resolve_period(q: DataFrame, ref: date) -> DataFrame:
    """Adds kind, periodo (label), inicio, fim, p_ano, p_mes, period_status.
    Order: YTD > MTD > yesterday > ISO date > BR date > today. Period words
    must stand as whole words and not be followed by "passado"/"anterior".

    Each regex is evaluated once per question (stage 1 columns); kind, date
    and label are derived from those columns in later projections. With an
    empty base (no reference date) every period has status ``no_data``."""
    if ref is None:
        return _no_reference_period(q)
    t = F.col("t")
    stage1 = q.withColumns({
        "_ytd": reduce(lambda a, b: a | b, [_period_word(t, w) for w in K.YTD_WORDS]),
        "_mtd": reduce(lambda a, b: a | b, [_period_word(t, w) for w in K.MTD_WORDS]),
        "_yday": reduce(lambda a, b: a | b, [_period_word(t, w) for w in K.YESTERDAY_WORDS]),
        "_iso": F.regexp_extract_all(t, F.lit(ISO_RE), 0),
        "_br": F.regexp_extract_all(t, F.lit(BR_RE), 0),
    })
    # the first match of each date pattern, split into its parts
    stage2 = stage1.withColumns({
        "_iso1": F.try_element_at("_iso", F.lit(1)), "_br1": F.try_element_at("_br", F.lit(1))})
    stage3 = stage2.withColumns({
        "_iso_y": F.regexp_extract(F.coalesce("_iso1", F.lit("")), ISO_RE, 2),
        "_iso_m": F.regexp_extract(F.coalesce("_iso1", F.lit("")), ISO_RE, 3),
        "_iso_d": F.regexp_extract(F.coalesce("_iso1", F.lit("")), ISO_RE, 4),
        "_br_d": F.regexp_extract(F.coalesce("_br1", F.lit("")), BR_RE, 2),
        "_br_m": F.regexp_extract(F.coalesce("_br1", F.lit("")), BR_RE, 3),
        "_br_y0": F.regexp_extract(F.coalesce("_br1", F.lit("")), BR_RE, 4),
    })
    has_iso, has_br = F.col("_iso_y") != "", F.col("_br_d") != ""
    br_year = F.when(F.col("_br_y0") != "", F.col("_br_y0")).otherwise(F.lit(str(ref.year)))
    stage4 = stage3.withColumns({
        "_br_y": br_year,
        "_iso_text": F.concat_ws("-", "_iso_y", "_iso_m", "_iso_d"),
        "kind": (F.when(F.col("_ytd"), "ytd").when(F.col("_mtd"), "mtd")
                 .when(F.col("_yday"), "yesterday").when(has_iso | has_br, "date")
                 .otherwise("today")),
    })
    br_text = F.concat_ws("-", "_br_y", F.lpad("_br_m", 2, "0"), F.lpad("_br_d", 2, "0"))
    stage5 = stage4.withColumn(
        "_day", F.when(has_iso, F.try_to_date("_iso_text", "yyyy-MM-dd"))
        .when(has_br, F.try_to_date(br_text, "yyyy-MM-dd")))
    kind, day = F.col("kind"), F.col("_day")
    yest = ref - timedelta(days=1)
    label = (F.when(kind == "ytd", K.LABEL_YTD.format(yyyy=ref.year, ref=ref.isoformat()))
             .when(kind == "mtd", K.LABEL_MTD.format(mm=f"{ref.month:02d}", yyyy=ref.year,
                                                     ref=ref.isoformat()))
             .when(kind == "yesterday", K.LABEL_YESTERDAY.format(day=yest.isoformat()))
             .when(has_iso, F.concat(F.lit("Data "), F.col("_iso_text")))
             .when(has_br, F.concat(F.lit("Data "), F.lpad("_br_d", 2, "0"), F.lit("/"),
                                    F.lpad("_br_m", 2, "0"), F.lit("/"), F.col("_br_y")))
             .otherwise(K.LABEL_TODAY.format(ref=ref.isoformat())))
    inicio = (F.when(kind == "ytd", F.lit(date(ref.year, 1, 1)))
              .when(kind == "mtd", F.lit(ref.replace(day=1)))
              .when(kind == "yesterday", F.lit(yest)).when(kind == "date", day)
              .otherwise(F.lit(ref)))
    fim = (F.when(kind.isin("ytd", "mtd", "today"), F.lit(ref))
           .when(kind == "yesterday", F.lit(yest)).otherwise(day))
    out = stage5.withColumns({
        "periodo": label, "inicio": inicio, "fim": fim,
        "p_ano": F.when(kind.isin("ytd", "mtd"), F.lit(ref.year)),
        "p_mes": F.when(kind == "mtd", F.lit(ref.month)),
        "period_status": F.when((kind == "date") & day.isNull(), "invalid_period").otherwise("ok"),
    })
    return out.drop("_ytd", "_mtd", "_yday", "_iso", "_br", "_iso1", "_br1", "_iso_y", "_iso_m",
                    "_iso_d", "_br_d", "_br_m", "_br_y0", "_br_y", "_iso_text", "_day")


def _no_reference_period(q: DataFrame) -> DataFrame:
    from vitrine.operators.periods import NO_DATA
    return q.withColumns({
        "kind": F.lit("today"), "periodo": F.lit(f"today ({NO_DATA})"),
        "inicio": F.lit(None).cast("date"), "fim": F.lit(None).cast("date"),
        "p_ano": F.lit(None).cast("int"), "p_mes": F.lit(None).cast("int"),
        "period_status": F.lit("no_data")})


def mention_flags(q: DataFrame) -> DataFrame:
    t = F.col("t")
    sub = _any_contains(t, K.SUBCATEGORY_SYNONYMS)
    cat = _any_contains(t, K.CATEGORY_SYNONYMS) & ~sub
    return q.withColumns({"disse_subcategoria": sub, "disse_categoria": cat})


def level_warning() -> Column:
    """Category asked but a subcategory found (with/without parent), or the
    reverse."""
    sub_found = F.col("sub_name").isNotNull()
    cat_found = F.col("cat_name").isNotNull()
    with_parent = fill(K.WARN_SUB_AS_CATEGORY_WITH_PARENT, sub="sub_name", parent="sub_parent")
    no_parent = fill(K.WARN_SUB_AS_CATEGORY, sub="sub_name")
    reverse = fill(K.WARN_CATEGORY_AS_SUB, cat="cat_name")
    return (F.when(F.col("disse_categoria") & sub_found & ~cat_found,
                   F.when(F.col("sub_parent").isNotNull(), with_parent).otherwise(no_parent))
            .when(F.col("disse_subcategoria") & cat_found & ~sub_found, reverse))


def intent() -> Column:
    t = F.col("t")
    metadata = (t.contains(K.METADATA_WORD) & _any_contains(t, K.METADATA_WORDS)
                & ~_any_contains(t, K.METADATA_EXCLUSIONS))
    sub_found = F.col("sub_name").isNotNull()
    cat_found = F.col("cat_name").isNotNull()
    ds, dc = F.col("disse_subcategoria"), F.col("disse_categoria")
    total_ok = (_any_contains(t, K.TOTAL_WORDS) & ~ds & ~dc & ~sub_found & ~cat_found
                & ~_any_contains(t, K.TOTAL_EXCLUSIONS))
    return (F.when(t.isin(*K.GREETING_COMMANDS), "saudacao")
            .when(t.contains(K.DEMO_WORD) & _any_contains(t, K.DEMO_CONTEXT_WORDS), "demo")
            .when(_any_contains(t, K.LIST_CATEGORIES_PHRASES), "listar_categorias")
            .when(F.col("lista_categoria").isNotNull(), "listar_subcategorias")
            .when(F.col("sigla").isNotNull(), "glossario")
            .when(metadata, "metadados")
            .when(sub_found, "subcategoria")
            .when(cat_found, "categoria")
            .when(ds & _any_contains(t, K.RANKING_WORDS_SUBCATEGORY), "ranking_subcategorias")
            .when(dc & _any_contains(t, K.RANKING_WORDS_CATEGORY), "ranking_categorias")
            .when(_any_contains(t, K.PRODUCT_WORDS), "ranking_produtos")
            .when(total_ok, "total")
            .otherwise("sem_resposta"))


ROUTE_COLUMNS = ["q_id", "user_name", "text", "intent", "status", "kind", "periodo", "inicio",
                 "fim", "p_ano", "p_mes", "categoria", "subcategoria", "aviso", "sigla", "termo",
                 "definicao", "lista_categoria"]


class Router:
    """The static side of routing (lexicon, glossary, categories, pairs),
    prepared and size-checked once; ``route`` then only plans per-question
    work, so a stream pays the preparation once, not per micro-batch."""

    def __init__(self, lexicon: DataFrame, glossary: DataFrame, categories: DataFrame,
                 pairs: DataFrame, ref: date):
        self.ref = ref
        self._cached = [df.cache() for df in (lexicon, glossary, categories, pairs)]
        self.lex = prepare_lexicon(self._cached[0])
        self.gl = prepare_glossary(self._cached[1])
        self.cats = prepare_categories(self._cached[2])
        self.pairs = prepare_pairs(self._cached[3])

    def release(self) -> None:
        """Give back the memory of a router that is replaced."""
        for df in self._cached:
            df.unpersist()

    def route(self, questions: DataFrame) -> DataFrame:
        q = normalize(questions)
        ents = match_entities(q, None, self.lex)
        gl = glossary_lookup(q, None, self.gl)
        tx = taxonomy_match(q, None, self.cats)
        base = mention_flags(q).join(ents, "q_id", "left").join(gl, "q_id", "left") \
                               .join(tx, "q_id", "left")
        # dynamic lookup only for "subcategoria ..." questions without a lexicon hit
        need = base.filter(F.col("disse_subcategoria") & F.col("sub_name").isNull()) \
                   .select("q_id", "t")
        dyn = dynamic_subcategory(need, None, self.pairs)
        base = base.join(dyn, "q_id", "left").withColumns({
            "sub_keyword": F.coalesce("sub_keyword", "dyn_term"),
            "sub_parent": F.when(F.col("sub_name").isNotNull(), F.col("sub_parent"))
                           .otherwise(F.col("dyn_parent")),
            "sub_name": F.coalesce("sub_name", "dyn_name")})
        routed = resolve_period(base, self.ref).withColumns(
            {"intent": intent(), "aviso": level_warning()})
        status = (F.when(F.col("intent") == "sem_resposta", "unanswered")
                  .when(F.col("intent").isin(*ANALYTIC_INTENTS) & (F.col("intent") != "metadados")
                        & (F.col("period_status") != "ok"), F.col("period_status"))
                  .otherwise("ok"))
        return routed.withColumns({
            "status": status,
            "categoria": F.when(F.col("intent") == "subcategoria", F.col("sub_parent"))
                          .when(F.col("intent") == "categoria", F.col("cat_name")),
            "subcategoria": F.when(F.col("intent") == "subcategoria", F.col("sub_name")),
        }).select(*ROUTE_COLUMNS)


def route_questions(questions: DataFrame, lexicon: DataFrame, glossary: DataFrame,
                    categories: DataFrame, pairs: DataFrame, ref: date) -> DataFrame:
    """One routed row per question: intent, period, entity filters, warning."""
    return Router(lexicon, glossary, categories, pairs, ref).route(questions)

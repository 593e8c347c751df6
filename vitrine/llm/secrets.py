"""Secret scan by fixed patterns and character Markov models, in built-in
functions only.

Three base kinds are found by pattern. Further candidates, long runs of token
characters that do not lie within one base span, are scored by two first-order character
Markov models: one of random strings, one of ordinary identifiers. A candidate
is a secret when its log-likelihood ratio, for each transition, reaches
``MIN_RATIO``.

Training covers all rows and has no bound. Random strings are the distinct values
of the base spans, and the base64 and hex digests of all distinct texts, which
are random by construction. Ordinary identifiers are the words of all texts, in
their case and with their digits, hyphens and underscores, and what joins any
two of them: snake case, upper snake case, hyphens, paths, camel case. Spans and
candidates are no words. A join adds only the transitions at a word's ends, so
the identifiers are never written out: the counts of adjacent characters in the
words, at most 2 * (alphabet + 1)^2 rows, give the counts of all forms. The
probabilities are mixed with a uniform one (``UNIFORM``), so a score tends to
a limit as the input grows and ``MIN_RATIO`` means the same at every size.

Spans are (start, kind, end) in code points, end exclusive. Java's matches and
the gaps between them, from ``split``, give the positions. Positions, the test of
candidates against base spans, scores and masks take time about linear in a text's
length and matches (times the logarithm of the matches).

Defined cases: NULL or empty text has no spans; NULL ids and repeated rows are
kept; an empty table gives no rows, and with nothing to train on no candidate
is added; extra columns are kept, whatever their names.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import free_name, let, stage

# FIXED VALUES: the base kinds, in the order in which equal starts are listed.
ASSIGN = ("(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?"
          "([A-Za-z0-9+/_.=-]+)")
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
ASSIGN_CHARS, ACCESS_CHARS, HEX_CHARS = 12, 18, 16

CANDIDATE_CHARS = 20
CANDIDATE = f"[A-Za-z0-9+/_-]{{{CANDIDATE_CHARS},}}={{0,2}}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=."
MIN_RATIO = 0.7
UNIFORM = 0.1  # share of the uniform distribution in each model
BLOCK_CHARS = 1024  # texts are cut in blocks of this length for masking

SPAN = "struct<start:int,kind:int,end:int,value:string>"


def _no_spans() -> Column:
    return F.array().cast(f"array<{SPAN}>")


def running(values: Column, combine) -> Column:
    """Inclusive running ``combine(value, earlier or NULL)`` of an array. Each round
    reaches twice as far back over the whole array, so it takes log2(size) rounds and
    never appends."""
    def of(v: Column) -> Column:
        rounds = F.sequence(F.lit(0), F.length(F.bin(F.size(v))))
        return F.aggregate(rounds, v, lambda a, k: F.transform(a, lambda x, i: combine(
            x, F.get(a, i - F.call_function("shiftleft", F.lit(1), k)))))

    return let(values, of)


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost non-overlapping matches as spans, from the matches and the gaps."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.struct(F.split(text, pattern).alias("gaps"), found.alias("found"))

    def spans(b: Column) -> Column:
        sizes = F.transform(b["found"], lambda m, i: F.length(F.get(b["gaps"], i)) + F.length(m))
        ends = running(sizes, lambda x, y: x + F.coalesce(y, F.lit(0)))
        return let(ends, lambda e: F.transform(b["found"], lambda m, i: F.struct(
            (F.get(e, i) - F.length(m)).alias("start"), F.lit(kind).alias("kind"),
            F.get(e, i).alias("end"), m.alias("value"))))

    return let(both, spans)


def base_spans(text: Column) -> Column:
    """The spans of the base kinds, ordered by start, then kind."""
    assign = F.when((text.contains("=") | text.contains(":")) & text.rlike(ASSIGN), F.filter(
        F.transform(_matches(text, ASSIGN, 0), lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            F.regexp_extract(s["value"], ASSIGN, 2).alias("value"))),
        lambda s: F.length(s["value"]) >= ASSIGN_CHARS)).otherwise(_no_spans())
    access = F.when(text.contains("AKIA"), F.filter(
        _matches(text, ACCESS, 1), lambda s: F.length(s["value"]) >= ACCESS_CHARS)
    ).otherwise(_no_spans())
    # Runs are maximal, so asking for the length in the pattern drops the same matches.
    long_hex = HEX[:-1] + f"{{{HEX_CHARS},}}"
    hexes = F.when(text.rlike(long_hex), _matches(text, long_hex, 2)).otherwise(_no_spans())
    return F.array_sort(F.concat(assign, access, hexes))


def candidate_spans(text: Column, base: Column) -> Column:
    """Runs of token characters that lie in no base span as a whole."""
    found = F.when(text.rlike(CANDIDATE), _matches(text, CANDIDATE, 3)).otherwise(_no_spans())

    def outside(every: Column) -> Column:
        # Base spans sort before a candidate of the same start: those before it start no later.
        reach = running(F.transform(every, lambda s: F.when(s["kind"] < 3, s["end"]).otherwise(0)),
                        lambda x, y: F.greatest(x, y))
        return let(reach, lambda r: F.filter(
            every, lambda s, i: (s["kind"] == 3) & (F.get(r, i) < s["end"])))

    return let(found, lambda f: F.when((F.size(f) == 0) | (F.size(base) == 0), f).otherwise(
        let(F.array_sort(F.concat(base, f)), outside)))


def random_strings(docs: DataFrame, found: DataFrame, text_col: str, spans: str) -> DataFrame:
    """(value): the distinct base values, and two digests of each distinct text."""
    values = found.select(F.explode(f"{spans}.base.value").alias("value")).distinct()
    digests = (docs.where(F.col(text_col).isNotNull())
               .select(F.sha2(text_col, 256).alias("a"), F.sha2(text_col, 224).alias("b")).distinct()
               .select(F.explode(F.array(F.regexp_replace(F.base64(F.unhex("a")), "\\s", ""), F.col("b")))
                       .alias("value")))
    return values.unionByName(digests)


def ordinary_words(docs: DataFrame, text_col: str) -> DataFrame:
    """(value, n): the words outside spans and candidates, and how often they occur."""
    long_value = ASSIGN.replace("]+)", f"]{{{ASSIGN_CHARS},}})")
    spans = f"(?:{long_value})|{CANDIDATE}|{ACCESS[:-1]}{{{ACCESS_CHARS - 4},}}|{HEX[:-1]}{{{HEX_CHARS},}}"
    rest = F.regexp_replace(F.col(text_col), spans, " ")
    return (docs.select(F.explode(F.split(rest, "[^A-Za-z0-9_-]+")).alias("value"))
            .select(F.btrim("value", F.lit("_-")).alias("value")).where("value != ''")
            .groupBy("value").agg(F.count(F.lit(1)).alias("n")))


def transition_counts(random: DataFrame, plain: DataFrame) -> DataFrame:
    """Counts of adjacent characters for each label: 1 the random strings; 0 the
    words between spaces, ``head`` where the pair is a word's first two."""
    def pairs(value: Column) -> Column:
        return let(F.split(value, ""), lambda c: F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(c) - 1, F.lit(1))),
            lambda i: F.concat(F.get(c, i - 1), F.get(c, i))))

    padded = F.concat(F.lit(" "), F.col("value"), F.lit(" "))
    every = (random.select(F.lit(1).alias("label"), F.lit(1).cast("long").alias("n"),
                           F.posexplode(pairs(F.col("value"))).alias("at", "pair"))
             .where(F.col("pair").rlike("^[A-Za-z0-9+/_=.-]{2}$"))
             .unionByName(plain.select(F.lit(0).alias("label"), "n",
                                       F.posexplode(pairs(padded)).alias("at", "pair"))))
    head = (F.col("label") == 0) & (F.col("at") == 1)
    return every.groupBy("label", head.alias("head"), "pair").agg(F.sum("n").alias("n"))


def identifier_counts(plain: list[tuple]) -> Counter:
    """Counts of adjacent characters in the identifiers that the words make, from
    (head, pair, n) of the words between spaces."""
    out, first, last = Counter(), Counter(), Counter()
    for head, (a, b), n in plain:
        if a == " ":
            first[b] += n
        elif b == " ":
            last[a] += n
        else:
            out[a + b] += 4 * n  # the word, hyphened, in a path, first in camel case
            out[(a + b).lower()] += n
            out[(a + b).upper()] += n
            out[(a.upper() if head else a.lower()) + b.lower()] += n
    for ends, side in ((first, lambda x, by: by + x), (last, lambda x, by: x + by)):
        for x, n in ends.items():
            for by, y in (("_", x.lower()), ("_", x.upper()), ("-", x), ("/", x)):
                out[side(y, by)] += n
    for x, n in last.items():
        for y, m in first.items():
            out[x + y.upper()] += n * m / sum(first.values())
    return out


def ratio_table(counts: list) -> list[float] | None:
    """log P(b|a; random) - log P(b|a; identifier) by position a * size + b, with
    one added to every count and ``UNIFORM`` mixed in; None where a label has no
    transitions."""
    size = len(ALPHABET)
    random = Counter({pair: n for label, _, pair, n in counts if label == 1})
    plain = identifier_counts([(head, pair, n) for label, head, pair, n in counts if label == 0])
    if not random or not plain:
        return None

    def logs(n: Counter) -> list[float]:
        total = Counter()
        for pair, k in n.items():
            total[pair[0]] += k
        return [math.log((1 - UNIFORM) * (n[a + b] + 1) / (total[a] + size) + UNIFORM / size)
                for a in ALPHABET for b in ALPHABET]

    return [r - i for r, i in zip(logs(random), logs(plain))]


def mean_ratio(value: Column, table: list[float]) -> Column:
    """The log-likelihood ratio of a string for each of its transitions."""
    size = len(ALPHABET)
    literal = F.split(F.lit(",".join(repr(round(x, 9)) for x in table)), ",").cast("array<double>")
    codes = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    total = let(codes, lambda c: F.aggregate(
        F.sequence(F.lit(1), F.size(c) - 1), F.lit(0.0),
        lambda a, i: a + F.get(literal, F.get(c, i - 1) * size + F.get(c, i))))
    return total / (F.length(value) - 1)


def scan(docs: DataFrame, out: str, id_cols: list[str], text_col: str = "text") -> DataFrame:
    """One row per document: ``id_cols`` and array column ``out`` of all spans,
    (start, kind, end) ordered, kind an index into ``KINDS``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = free_name(docs, "base", out, *id_cols)
    wanted = list(dict.fromkeys([*id_cols, text_col]))
    found = docs.select(*wanted).withColumn(base, base_spans(text))
    found = stage(found.select(*id_cols, F.struct(
        F.col(base).alias("base"), candidate_spans(text, F.col(base)).alias("more")).alias(out)),
        "secrets")
    table = ratio_table(transition_counts(
        random_strings(docs, found, text_col, out), ordinary_words(docs, text_col)).collect())
    more = (F.filter(F.col(out)["more"], lambda c: mean_ratio(c["value"], table) >= MIN_RATIO)
            if table else _no_spans())
    every = F.array_sort(F.concat(F.col(out)["base"], more))
    return found.withColumn(out, F.transform(every, lambda s: F.struct(s["start"], s["kind"], s["end"])))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """The text with every (merged) span replaced by ``mask``."""
    def piece(blocks: Column, start: Column, end: Column) -> Column:
        size = F.lit(BLOCK_CHARS)
        first, last = F.floor(start / size).cast("int"), F.floor(end / size).cast("int")
        return (F.when(start == end, "")
                .when(first == last, F.substring(F.get(blocks, first), start % size + 1, end - start))
                .otherwise(F.concat(
                    F.substring(F.get(blocks, first), start % size + 1, size),
                    F.array_join(F.slice(blocks, first + 2, last - first - 1), ""),
                    F.coalesce(F.substring(F.get(blocks, last), F.lit(1), end % size), F.lit("")))))

    def masked(p: Column) -> Column:
        # A span that starts behind all earlier ends gets a mask, others lengthen the last one.
        def part(s: Column, i: Column) -> Column:
            done = F.coalesce(F.get(p["reach"], i - 1), F.lit(0))
            return F.when(s["start"] >= done, F.concat(piece(p["blocks"], done, s["start"]), F.lit(mask))
                          ).otherwise("")

        return F.concat(F.array_join(F.transform(spans, part), ""),
                        piece(p["blocks"], F.element_at(p["reach"], -1), F.length(text)))

    reach = running(F.transform(spans, lambda s: s["end"]), lambda x, y: F.greatest(x, y))
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK_CHARS}}}"), F.lit(0))
    return F.when(F.size(spans) == 0, text).otherwise(
        let(F.struct(blocks.alias("blocks"), reach.alias("reach")), masked))

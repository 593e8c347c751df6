"""Quality rules with host verdicts, in built-in functions only.

Each document gets word statistics and is held against two sets of rules:

- base rules: fewer than ``MIN_WORDS`` words, or more than half of its words in
  repeated 3-word windows. A document that fails one is rejected.
- host rules: those, or many symbols, many repeated lines, or a mean word
  length out of range.

Failures of the host rules are summed for each host (the ``source`` column). A
beta prior is fitted to all hosts' rates by moments, and each host's rate is
shrunk towards it, so a host with three pages is not judged by three pages. On
a host whose shrunk rate reaches ``HOST_RATE`` the host rules become binding
for its documents; a clean document stays whatever its host.

The statistics are computed once, for every whole text, and written as a table;
only per-host sums are shuffled, and the verdicts of flagged hosts are joined
back (broadcast after measuring them, else a shuffle join).

Defined cases: NULL or empty text has no words and fails; a NULL host is one
host of its own; repeated rows count as rows; an empty table gives no rows;
extra columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import SPACES, free_name, let, small_side, stage, words

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
# Host rules: symbols for each 10 words, repeated lines in percent, mean word length.
SYMBOLS_PER_10_WORDS = 5
DUP_LINE_PERCENT = 30
MEAN_WORD_CHARS = (2, 15)
HOST_RATE = 0.5

STATS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def _repeated_window_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more, from the array of the
    3-word windows' hashes in text order."""
    by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def starts(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (
            ((k > 0) & (x["h"] == F.get(s, k - 1)["h"]))
            | F.coalesce(x["h"] == F.get(s, k + 1)["h"], F.lit(False))))
        return F.array_sort(F.transform(same, lambda x: x["i"]))

    covered = F.aggregate(
        let(by_hash, starts),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"])
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), 0).otherwise(covered)


def with_stats(docs: DataFrame, out: str, text_col: str = "text") -> DataFrame:
    """Add struct column ``out`` with the fields ``STATS`` (all long)."""
    w, grams, lines = (free_name(docs, s, out) for s in ("words", "windows", "lines"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    n = F.size(w)
    df = docs.withColumn(w, words(text)).withColumn(
        lines, F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACES}]")))
    df = df.withColumn(grams, F.transform(
        F.slice(F.col(w), F.lit(1), F.greatest(n - 2, F.lit(0))),
        lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))))
    stats = [n, F.length(F.array_join(w, "")), F.regexp_count(text, F.lit(SYMBOLS)), F.size(lines),
             F.size(lines) - F.size(F.array_distinct(lines)), _repeated_window_words(F.col(grams))]
    return (df.withColumn(out, F.struct(*[c.cast("long").alias(k) for k, c in zip(STATS, stats)]))
            .drop(w, grams, lines))


def base_failed(s: Column) -> Column:
    return ((s["n_words"] < MIN_WORDS)
            | (100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"]))


def host_rule_failed(s: Column) -> Column:
    low, high = MEAN_WORD_CHARS
    return (base_failed(s)
            | (10 * s["n_symbols"] > SYMBOLS_PER_10_WORDS * s["n_words"])
            | (100 * s["n_dup_lines"] > DUP_LINE_PERCENT * s["n_lines"])
            | (s["word_chars"] < low * s["n_words"]) | (s["word_chars"] > high * s["n_words"]))


def host_rates(hosts: DataFrame) -> DataFrame:
    """Add ``rate``, each host's failure rate shrunk by the empirical beta prior.

    ``hosts`` has one row for each host with ``n`` rows and ``k`` failures. The
    prior's mean is the mean rate of the hosts; its strength follows from the
    rates' variance less what sampling alone explains. Where that leaves no
    variance, all hosts share the mean."""
    rate = F.col("k") / F.col("n")
    prior = hosts.agg(F.avg(rate).alias("m"), F.coalesce(F.var_samp(rate), F.lit(0.0)).alias("v"),
                      F.avg(F.lit(1.0) / F.col("n")).alias("inv"))
    spread = F.col("v") - F.col("m") * (1 - F.col("m")) * F.col("inv")
    strength = F.when(spread > 0, F.greatest(F.col("m") * (1 - F.col("m")) / spread - 1, F.lit(1.0)))
    row = prior.select("m", strength.alias("c")).first()
    if row is None or row.m is None:
        return hosts.withColumn("rate", F.lit(None).cast("double"))
    if row.c is None:
        return hosts.withColumn("rate", F.lit(row.m))
    return hosts.withColumn("rate", (F.col("k") + F.lit(row.m * row.c)) / (F.col("n") + F.lit(row.c)))


def host_rules(docs: DataFrame, out: str, text_col: str = "text", host_col: str = "source",
               host_rate: float = HOST_RATE, drop_text: bool = False) -> DataFrame:
    """``docs`` plus struct column ``out``: the statistics, ``base_failed``,
    ``host_flagged`` and ``kept``; without the text where that isn't needed."""
    scored = with_stats(docs, out, text_col)
    scored = stage(scored.drop(text_col) if drop_text else scored, "host-rules")
    s = F.col(out)
    hosts = stage(scored.groupBy(F.col(host_col).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(host_rule_failed(s).cast("long")).alias("k")), "hosts")
    bad, flag = free_name(scored, "host", out), free_name(scored, "flag", out)
    flagged = small_side(host_rates(hosts).where(F.col("rate") >= host_rate)
                         .select(F.col("host").alias(bad), F.lit(True).alias(flag)))
    joined = scored.join(flagged, F.col(host_col).eqNullSafe(F.col(bad)), "left")
    is_flagged = F.coalesce(F.col(flag), F.lit(False))
    kept = ~base_failed(s) & ~(is_flagged & host_rule_failed(s))
    verdict = F.struct(*[s[k].alias(k) for k in STATS], base_failed(s).alias("base_failed"),
                       is_flagged.alias("host_flagged"), kept.alias("kept"))
    return joined.withColumn(out, verdict).drop(bad, flag)

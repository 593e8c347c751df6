"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down the tree domain, language, source. At each node it is
dealt to the children by weight, no child getting more than its capacity (its
subtree's tokens times the allowed epochs); what a short child leaves goes to
its siblings by their weights, and only what a whole family cannot use reaches
the node's own siblings, because a node's capacity is its family's sum. Every
leaf then reads whole seeded epochs while its budget lasts, and a token-prefix
of the next: its documents in the order of a seeded hash up to the one that
reaches the budget, which counts if at least half of it lies within.

The documents are never sorted: a leaf's prefix is a cut-off in hash order,
found by summing tokens for the hash's first two hex digits, then the next two
inside the boundary range, then over the few rows left there. So a leaf may
hold any share of the rows. The leaf table (a row for each source) is joined
back after measuring it.

Defined cases: NULL language or source is a name of its own; NULL or empty text
has no tokens and rides along with its hash; rows equal in id and text enter
together; weights of zero get nothing; an empty table gives no rows; extra
columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import free_name, small_side, stage, words

LEVELS = ("domain", "lang", "source")
DOMAIN_WEIGHTS = {"domain0": 4.0, "domain1": 3.0, "domain2": 2.0, "domain3": 1.0}
LANG_WEIGHTS = {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 2.0}
SHARE, MAX_EPOCHS, SEED = 0.6, 4, 20240


def domain_of(source: Column) -> Column:
    """The domain of a source where the table names none: four by its MD5's first digit."""
    digit = F.conv(F.substring(F.md5(F.coalesce(source, F.lit("")).cast("binary")), 1, 1), 16, 10)
    return F.concat(F.lit("domain"), (digit.cast("int") % 4).cast("string"))


def weight_of(name: Column, weights: dict[str, float] | None) -> Column:
    out = F.lit(1.0)
    for key, value in (weights or {}).items():
        out = F.when(name == key, F.lit(float(value))).otherwise(out)
    return out


def deal(children: DataFrame, parent: list[str], child: str) -> DataFrame:
    """Add ``got``: the parent's ``budget`` dealt to its children by ``weight``,
    none above its ``cap``.

    In order of cap / weight the children that get their whole cap come first.
    The level is what the rest get for each unit of weight: the level at the
    first child whose cap lies above it, the highest of all such."""
    ratio = F.when(F.col("weight") > 0, F.col("cap") / F.col("weight"))
    before = (Window.partitionBy(*parent).orderBy(F.col("_ratio").asc_nulls_last(), child)
              .rowsBetween(Window.unboundedPreceding, -1))
    family = Window.partitionBy(*parent)
    df = children.withColumn("_ratio", ratio)
    rest = F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight = F.sum("weight").over(family) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    df = df.withColumn("_level", F.when(F.col("weight") > 0, rest / weight))
    df = df.withColumn("_level", F.max(F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))).over(family))
    got = (F.when(F.col("weight") <= 0, F.lit(0.0))
           .when(F.col("_level").isNull(), F.col("cap"))
           .otherwise(F.least(F.col("cap"), F.col("_level") * F.col("weight"))))
    return df.withColumn("got", got).drop("_ratio", "_level")


def leaf_budgets(leaves: DataFrame, budget: float, weights: dict[str, dict], max_epochs: int) -> DataFrame:
    """``leaves`` (domain, lang, source, tokens) with ``got`` tokens for each."""
    leaves = leaves.withColumn("cap", F.col("tokens").cast("double") * max_epochs)
    nodes = {}
    for depth in range(1, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        name = F.col(keys[-1])
        nodes[depth] = leaves.groupBy(*keys).agg(
            F.sum("cap").alias("cap"), F.sum("tokens").alias("tokens")).withColumn(
            "weight", weight_of(name, weights.get(keys[-1])))
    top = nodes[1].withColumn("budget", F.lit(float(budget))).withColumn("_root", F.lit(0))
    got = deal(top, ["_root"], "domain").select("domain", "got")
    for depth in range(2, len(LEVELS) + 1):
        keys = list(LEVELS[:depth])
        children = nodes[depth].join(got.withColumnRenamed("got", "budget"), keys[:-1])
        got = deal(children, keys[:-1], keys[-1]).select(*keys, "tokens", "got")
        if depth < len(LEVELS):
            got = got.drop("tokens")
    return got


def _boundary(rows: DataFrame, digits: int, at: int) -> DataFrame:
    """For each leaf the range of ``digits`` hex digits where the prefix ends, with
    the tokens still to take from it."""
    ranges = rows.groupBy("leaf", "rest", F.substring("key", at, digits).alias("range")).agg(
        F.sum("n").alias("n"))
    w = Window.partitionBy("leaf").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("n").over(w), F.lit(0))
    return (ranges.withColumn("rest", F.col("rest") - before).where(F.col("rest") > 0)
            .groupBy("leaf").agg(F.max_by(F.struct("range", "rest"), "range").alias("b"))
            .select("leaf", F.col("b.range").alias("range"), F.col("b.rest").alias("rest")))


def mix(docs: DataFrame, out: str, share: float = SHARE, max_epochs: int = MAX_EPOCHS,
        seed: int = SEED, weights: dict[str, dict] | None = None, domain: Column | None = None,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        source_col: str = "source") -> DataFrame:
    """The chosen rows of ``docs``, once for each epoch that reads them, with
    struct column ``out``: domain, lang, source, n_tokens (words), epoch."""
    weights = weights or {"domain": DOMAIN_WEIGHTS, "lang": LANG_WEIGHTS}
    domain = domain_of(F.col(source_col)) if domain is None else domain
    null = F.lit("\x00null")
    leaf = F.struct(domain.alias("domain"), F.coalesce(F.col(lang_col), null).alias("lang"),
                    F.coalesce(F.col(source_col), null).alias("source"))
    identity = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                           F.md5(F.coalesce(F.col(text_col), F.lit("")).cast("binary")))
    own, mark = free_name(docs, "leaf", out), free_name(docs, "identity", out)
    tokens = free_name(docs, "tokens", out)
    marked = (docs.withColumn(own, leaf).withColumn(mark, identity)
              .withColumn(tokens, F.size(words(F.col(text_col))).cast("long")))
    narrow = stage(marked.select(F.col(own).alias("leaf"), F.col(mark).alias("identity"),
                                 F.col(tokens).alias("n")), "mixing")
    leaves = stage(narrow.groupBy("leaf").agg(F.sum("n").alias("tokens"))
                   .select("leaf.*", "tokens"), "leaves")
    total = leaves.agg(F.sum("tokens")).first()[0] or 0
    got = leaf_budgets(leaves, total * share, weights, max_epochs).where(F.col("got") > 0)
    take = F.floor(F.col("got") + 1e-6)
    plan = stage(got.select(
        F.struct(*LEVELS).alias("leaf"), F.floor(take / F.col("tokens")).cast("int").alias("epochs"),
        (take % F.col("tokens")).cast("long").alias("rest")), "mixing-plan")

    key = F.md5(F.concat_ws(":", F.lit(seed), F.col("epochs"), F.col("identity")).cast("binary"))
    partial = small_side(plan.where(F.col("rest") > 0))
    rows = narrow.join(partial, "leaf").select("leaf", "rest", "n", key.alias("key"))
    first = stage(_boundary(rows, 2, 1), "boundary")
    inside = rows.drop("rest").withColumn("range", F.substring("key", 1, 2)).join(
        small_side(first), ["leaf", "range"]).drop("range")
    second = stage(_boundary(inside, 2, 3), "boundary")
    last = inside.drop("rest").withColumn("range", F.substring("key", 3, 2)).join(
        small_side(second), ["leaf", "range"])
    # Rows of equal key enter together: the sum before a key leaves its peers out.
    keys = last.groupBy("leaf", "rest", "key").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("leaf").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    # The cut lies above the last document's key if that document counts ("~" is
    # above all hex digits), else at it.
    counts = 2 * F.col("before") + F.col("n") <= 2 * F.col("rest")
    ends = (keys.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0)))
            .where(F.col("before") < F.col("rest"))
            .withColumn("cut", F.when(counts, F.concat("key", F.lit("~"))).otherwise(F.col("key")))
            .groupBy("leaf").agg(F.max("cut").alias("cut")))
    full = small_side(stage(plan.join(ends, "leaf", "left").select(
        F.col("leaf").alias(own), F.struct("epochs", "cut").alias(out)), "mixing-cuts"))

    row_key = F.md5(F.concat_ws(":", F.lit(seed), F.col(out)["epochs"], F.col(mark)).cast("binary"))
    times = F.col(out)["epochs"] + F.when(row_key < F.col(out)["cut"], 1).otherwise(0)
    chosen = marked.join(full, own).withColumn(mark, times).where(F.col(mark) > 0)
    chosen = chosen.withColumn(mark, F.explode(F.sequence(F.lit(0), F.col(mark) - 1)))
    return chosen.withColumn(out, F.struct(
        F.col(own)["domain"].alias("domain"), F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"), F.col(tokens).alias("n_tokens"),
        F.col(mark).alias("epoch"))).drop(own, mark, tokens)

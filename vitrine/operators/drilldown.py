"""Where two versions of a table differ, found from the top of a hierarchy down.

Keys go from coarse to fine (month, day, listing). Both tables are read as one, the
second with sign -1, and reduced to a signed row count and a signed sum of content
hashes for each key: zero where the same rows lie on both sides, in any order. Only
keys with another sum are opened: the next level reads the rows below them alone, so
a partitioned table prunes its other folders, and only branches that differ are ever
shuffled by their finest key. Where many branches differ, each in few of its finest keys,
a level of hash parts of a branch comes before the finest one: there are far fewer
parts than keys, and only rows of differing parts are shuffled by their key.

Keys of differing branches come to the driver up to ``LISTED_KEYS`` of them, as a
filter that reaches the scan; more of them stay in a table and a semi-join opens them.
Both are whole. The differing keys of each level are found when the frame is built.

NULL keys are keys like others; a NULL measure differs from 0. Rows that occur twice
count twice. Tables that agree, two empty ones too, give no row. Hash sums of unequal
contents agree with a probability of about 2^-64 a key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.operators.keys import broadcast_if_small, is_small

# Differing keys of a level that are listed in a filter; beyond it, a semi-join.
LISTED_KEYS = 1000

# Rows in a hash part of a branch, and the most parts that a branch has.
PART_ROWS = 16
PARTS = 4096

SIDE = "_lado"
PART, ROWS = "_parte", "_n"


def _content(keys: Sequence[str], measures: Sequence[str]) -> Column:
    """A row's hash; NULLs are marked, since the hash function skips them."""
    cells = [c for m in (*keys, *measures) for c in (F.col(m).isNull(), F.col(m))]
    return F.xxhash64(*cells).cast("decimal(38,0)")


def _differing(both: DataFrame, by: Sequence[str], keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    signed = both.groupBy(*by).agg(
        F.sum(SIDE).alias("_linhas"),
        F.sum(F.col(SIDE) * _content(keys, measures)).alias("_conteudo"), F.count(F.lit(1)).alias(ROWS))
    return signed.filter("_linhas <> 0 OR _conteudo <> 0").select(*by, ROWS)


def _below(both: DataFrame, opened: DataFrame, key: str, parents: Sequence[str]) -> DataFrame:
    """The rows of ``both`` below the differing keys ``opened``."""
    listed = opened.select(key).distinct().limit(LISTED_KEYS + 1).collect()
    if len(listed) <= LISTED_KEYS:
        values = [r[0] for r in listed if r[0] is not None]
        wanted = F.col(key).isin(values) if values else F.lit(False)
        if len(values) < len(listed):
            wanted = wanted | F.col(key).isNull()
        both = both.filter(wanted)
        if not parents:
            return both
    # a broadcast leaves the rows where they are: a hot day is not moved to one task
    o = broadcast_if_small(opened.select(*[F.col(c).alias(f"_o_{c}") for c in (*parents, key)]))
    on = [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in (*parents, key)]
    return both.join(o, on, "left_semi")


def _differing_parts(both: DataFrame, keys: Sequence[str], measures: Sequence[str], parts: int) -> DataFrame:
    """The rows of parts that differ; all rows where too many do, or branches are small.
    A part is known by one hash of its branch and number: parts whose hashes agree are
    opened together, which the sums of the finest keys put right."""
    if parts < 2:
        return both
    marked = [c for k in keys[:-1] for c in (F.col(k).isNull(), F.col(k))]
    both = both.withColumn(PART, F.xxhash64(*marked, F.pmod(F.xxhash64(keys[-1]), F.lit(parts))))
    opened = _differing(both, [PART], keys, measures).select(PART).checkpoint(eager=True)
    if is_small(opened):
        both = both.join(F.broadcast(opened), PART, "left_semi")
    return both.drop(PART)


def divergences(left: DataFrame, right: DataFrame, keys: Sequence[str],
                measures: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """(*keys, registros_a, registros_b, and for each measure its sums ``_a`` and
    ``_b``) of the finest keys whose rows differ. ``measures`` names the compared
    columns and gives each side's expression: exact types, decimals or integers."""
    names = list(measures)

    def side(df: DataFrame, sign: int) -> DataFrame:
        at = 0 if sign > 0 else 1
        return df.select(*keys, *[measures[m][at].alias(m) for m in names],
                         F.lit(sign).alias(SIDE))

    both = side(left, 1).unionByName(side(right, -1))
    for i, key in enumerate(keys[:-1]):
        opened = _differing(both, keys[:i + 1], keys, names).checkpoint(eager=True)
        both = _below(both, opened, key, keys[:i])
    if len(keys) > 1:
        rows = opened.agg(F.avg(ROWS)).first()[0] or 0
        both = _differing_parts(both, keys, names, min(PARTS, int(rows / PART_ROWS)))
    sums = [F.count(F.when(F.col(SIDE) == s, 1)).alias(f"registros_{x}") for x, s in (("a", 1), ("b", -1))]
    sums += [F.sum(F.when(F.col(SIDE) == s, F.col(m))).alias(f"{m}_{x}")
             for m in names for x, s in (("a", 1), ("b", -1))]
    signed = F.sum(F.col(SIDE) * _content(keys, names)).alias("_conteudo")
    return (both.groupBy(*keys).agg(*sums, signed)
            .filter("registros_a <> registros_b OR _conteudo <> 0").drop("_conteudo"))

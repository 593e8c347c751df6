"""Which names contain which terms, by posting lists instead of a pairwise join.

A name is posted under its distinct runs of one, two and three characters. A name
that contains a term of three characters or more has all trigrams of the term, so
the term looks up the postings of its rarest one and tests what it finds exactly;
a trigram without postings ends the search. A shorter term is itself a run, and
its postings are the answer. Both are equi-joins: a term meets the names that share
a rare trigram with it, never all names. The empty term is in every name, so names
are also posted under the empty run.

Postings grow with the characters of the names. NULL names and terms match nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RUN = 3


def runs(text: Column, size: int) -> Column:
    """Runs of ``size`` characters; none for shorter texts."""
    at = F.sequence(F.lit(1), F.greatest(F.length(text) - size + 1, F.lit(1)))
    return F.when(F.length(text) >= size, F.transform(at, lambda i: text.substr(i, F.lit(size)))) \
        .otherwise(F.array().cast("array<string>"))


def postings(names: DataFrame, column: str) -> DataFrame:
    """Rows of ``names`` once under each ``gram`` of ``column``."""
    name = F.col(column)
    every = F.concat(F.array(F.lit("")), *[runs(name, n) for n in range(1, RUN + 1)])
    return names.where(name.isNotNull()).withColumn("gram", F.explode(F.array_distinct(every)))


def frequencies(posted: DataFrame) -> DataFrame:
    return posted.groupBy("gram").agg(F.count(F.lit(1)).alias("gram_n"))


def keyed(terms: DataFrame, term: str, counts: DataFrame, ids: list[str]) -> DataFrame:
    """``terms`` (one row for each ``ids``) with the ``gram`` to look up: the term
    itself up to two characters, else its rarest trigram by ``counts``."""
    value = F.col(term)
    own = F.when(F.length(value) < RUN, F.array(value)).otherwise(F.array_distinct(runs(value, RUN)))
    found = terms.where(value.isNotNull()).select(*ids, term, F.explode(own).alias("gram")).join(counts, "gram", "left")
    return found.groupBy(*ids, term).agg(
        F.min_by("gram", F.struct(F.coalesce("gram_n", F.lit(0)), "gram")).alias("gram"))


def containing(terms: DataFrame, term: str, posted: DataFrame, column: str) -> DataFrame:
    """Keyed terms joined with the posted names that contain them."""
    return terms.join(posted, "gram").where(F.col(column).contains(F.col(term))).drop("gram")

"""SpotSigs document fingerprints, in built-in functions only.

A signature is an anchor, one of a fixed list of very common words, with the
chain of the next content words after it (other anchors are passed over). The
set of a text's signatures is its fingerprint: dates, menus and reordered parts
hardly change it. Fingerprints start with the set's length partition; two sets
can reach a likeness t only if their lengths are within a factor t, so a search
compares neighbouring partitions only, and ``likeness`` prunes by the lengths
before it intersects anything.

Defined cases: a text without anchors uses every word as an anchor; one without
words has the signature of the text itself, so equal texts always have equal
fingerprints; NULL is the empty text; NULL ids come last in descending order;
equal ids are ordered by the text's MD5; repeated rows follow each other; an
empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import let

# FIXED VALUES: common words of four languages, as anchors.
ANCHORS = {
    "en": "the of and to a in is it that for on as with by at from this be are was were or an not "
          "have has had but they you his her its we which will would there their been if",
    "de": "der die das und ist nicht ein eine einer eines den dem des von zu mit sich auf für im "
          "es auch als an wird aus er sie nach bei um am sind noch wie über so zum war hat nur oder",
    "fr": "le la les de des du et un une est en que qui dans pour par sur ne pas au aux avec ce "
          "il elle son sa ses se ou mais plus comme sont nous vous cette été leur",
    "es": "el los las y en que un una es por con para del al lo como su sus se no más pero fue "
          "este esta son entre cuando muy sin sobre también hasta hay donde quien desde",
}
ANCHOR_WORDS = sorted({w for words in ANCHORS.values() for w in words.split()})
CHAIN = 2
REACH = 6
SIGNATURE_CHARS = 8
LEAST_LIKENESS = 0.75


def signatures(text: Column) -> Column:
    """Sorted set of a text's signatures (hex digests of anchor and chain)."""
    text = F.coalesce(text, F.lit(""))
    tokens = F.filter(F.split(F.lower(text), "[^\\p{L}\\p{N}]+"), lambda w: w != "")

    def spots(w: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(w) - 1)
        anchored = F.filter(places, lambda i: F.get(w, i).isin(ANCHOR_WORDS))

        def signature(i: Column) -> Column:
            chain = F.slice(F.filter(F.slice(w, i + 2, F.lit(REACH)),
                                     lambda x: ~x.isin(ANCHOR_WORDS)), 1, CHAIN)
            joined = F.concat_ws(" ", F.get(w, i), chain)
            return F.substring(F.md5(joined.cast("binary")), 1, SIGNATURE_CHARS)

        return F.when(F.size(w) == 0, F.array().cast("array<string>")).otherwise(F.transform(
            let(anchored, lambda a: F.when(F.size(a) > 0, a).otherwise(places)), signature))

    found = F.sort_array(F.array_distinct(let(tokens, spots)))
    whole = F.array(F.substring(F.md5(text.cast("binary")), 1, SIGNATURE_CHARS))
    return let(found, lambda s: F.when(F.size(s) > 0, s).otherwise(whole))


def length_partition(sigs: Column, least: float = LEAST_LIKENESS) -> Column:
    """Sets with a likeness of ``least`` lie in the same or in adjoining partitions."""
    return F.floor(F.log(F.size(sigs).cast("double")) / math.log(1 / least)).cast("int")


def fingerprint(sigs: Column) -> Column:
    """Length partition and signatures as one string."""
    return F.concat(length_partition(sigs).cast("string"), F.lit(":"), F.array_join(sigs, ""))


def likeness(a: Column, b: Column, least: float = 0.0) -> Column:
    """Jaccard likeness of two signature sets; 0 without intersecting where the
    lengths alone rule out ``least``."""
    small, large = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    shared = F.size(F.array_intersect(a, b))
    exact = let(shared, lambda n: n / (F.size(a) + F.size(b) - n))
    return F.when(small < least * large, F.lit(0.0)).otherwise(exact)


def near_pairs(queries: DataFrame, docs: DataFrame, least: float = LEAST_LIKENESS) -> DataFrame:
    """(query_id, doc_id, likeness) of all pairs of at least ``least``, for frames
    with columns ``doc_id`` and ``sigs``.

    A pair shares one of the first ``size - ceil(least * size) + 1`` signatures
    of both sorted sets, so these are joined, within the length partitions, and
    the survivors compared."""
    def prefix(df: DataFrame, name: str) -> DataFrame:
        n = F.size("sigs")
        head = F.slice("sigs", 1, n - F.ceil(least * n - 1e-9).cast("int") + 1)
        return df.select(F.col("doc_id").alias(name), F.col("sigs").alias(f"{name}_sigs"),
                         length_partition(F.col("sigs"), least).alias(f"{name}_part"),
                         F.explode(head).alias("sig"))

    q = prefix(queries, "query_id").withColumn(
        "part", F.explode(F.sequence(F.col("query_id_part") - 1, F.col("query_id_part") + 1)))
    d = prefix(docs, "doc_id").withColumn("part", F.col("doc_id_part"))
    pairs = (q.join(d, ["sig", "part"]).where(~F.col("query_id").eqNullSafe(F.col("doc_id")))
             .dropDuplicates(["query_id", "doc_id"]))
    score = likeness(F.col("query_id_sigs"), F.col("doc_id_sigs"), least)
    return pairs.select("query_id", "doc_id", score.alias("likeness")).where(F.col("likeness") >= least)


def with_next(df: DataFrame, key: str, tie: Column, derived: dict[str, Column],
              carry: list[str]) -> DataFrame:
    """Add the columns ``derived``, and ``next``, a struct of ``carry`` of the row
    that follows in descending order of ``key`` (then ``tie``); the first row
    follows the last.

    Rows are dealt into key ranges, eight for each shuffle partition, and each
    range also gets the first row of the range after it, so one shuffle by range
    serves the order of the whole table and no task sees more than its ranges.
    What can be derived from a row is derived after the shuffle."""
    spark = df.sparkSession
    ranges = 8 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = F.coalesce(F.col(key), F.lit(-(1 << 63)))
    cuts = df.select(F.percentile_approx(
        order, [i / ranges for i in range(1, ranges)], 20 * ranges).alias("cuts")).first().cuts
    bounds = F.split(F.lit(",".join(str(c) for c in sorted(set(cuts or [])))), ",").cast("array<long>")
    n = len(set(cuts or []))

    def search(lo_hi: Column, _) -> Column:
        mid = F.floor((lo_hi["lo"] + lo_hi["hi"]) / 2).cast("int")
        above = F.get(bounds, mid) < order
        done = lo_hi["lo"] >= lo_hi["hi"]
        return F.struct(F.when(~done & above, mid + 1).otherwise(lo_hi["lo"]).alias("lo"),
                        F.when(~done & ~above, mid).otherwise(lo_hi["hi"]).alias("hi"))

    steps = F.sequence(F.lit(1), F.lit(max(1, n.bit_length() + 1)))
    place = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi")), search,
                        lambda a: a["lo"]) if n else F.lit(0)
    keyed = df.withColumn("_order", order).withColumn("_range", place)
    heads = sorted(keyed.groupBy("_range").agg(F.max("_order").alias("top")).collect(),
                   key=lambda r: -r._range)  # at most as many rows as ranges
    if not heads:
        return df.withColumns(derived).withColumn("next", F.struct(*carry))
    # The head of a range also follows the range read before it.
    before = {h.top: heads[i - 1]._range for i, h in enumerate(heads)}
    tops = F.split(F.lit(",".join(str(t) for t in before)), ",").cast("array<long>")
    others = F.split(F.lit(",".join(str(r) for r in before.values())), ",").cast("array<int>")
    spot = F.array_position(tops, F.col("_order"))
    both = F.when(spot > 0, F.array(
        F.struct(F.col("_range").alias("range"), F.lit(0).alias("guest")),
        F.struct(F.get(others, (spot - 1).cast("int")).alias("range"), F.lit(1).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("_range").alias("range"), F.lit(0).alias("guest"))))
    dealt = (keyed.withColumn("_at", F.explode(both)).withColumn("_guest", F.col("_at.guest"))
             .withColumn("_range", F.col("_at.range")).drop("_at")
             .repartition("_range").withColumn("_tie", tie).withColumns(derived))
    w = Window.partitionBy("_range").orderBy("_guest", F.col("_order").desc(), "_tie")
    return (dealt.withColumn("next", F.lead(F.struct(*carry)).over(w)).where("_guest = 0")
            .drop("_order", "_range", "_guest", "_tie"))


def half_replaced(text: Column, other: Column) -> Column:
    """The text whose last half (rounded down) gives way to as many first
    characters of the other text, or all it has."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(other, F.lit(1), half))


def edited_and_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's signatures (``sigs``) beside those of its half-replaced
    text (``edited``, ``edited_sigs``) and of the next document (``next.sigs``)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"))
    dealt = with_next(base, "doc_id", F.md5(F.col("text").cast("binary")),
                      {"sigs": signatures(F.col("text"))}, ["text", "sigs"])
    dealt = dealt.withColumn("edited", half_replaced(F.col("text"), F.col("next.text")))
    return dealt.withColumn("edited_sigs", signatures(F.col("edited")))

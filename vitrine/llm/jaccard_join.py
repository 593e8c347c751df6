"""Exact n-gram Jaccard join in metric space.

Two documents link when their sets of five-word shingles have a Jaccard
likeness of 0.75 or more, that is, lie within R = 0.25 in Jaccard distance. The
result has each document's class: the smallest id reachable by links.

1. Equal sets are one class of documents; everything below works on classes.
2. Coarse regions: where two sets share nothing their distance is 1, and no
   pivot tells them apart. So each class enters a region for every shingle of
   its prefix, the first n - ceil(0.75 n) + l(n) shingles of its n in one global
   order, with l(n) = 1 + n / 10. Linked classes of n and m shingles have at least
   min(l(n), l(m)) prefix shingles in common: the first of their common shingles
   have too many others behind them to lie outside a prefix. So a class that
   shares fewer prefix shingles with all others than its smallest partner would
   need has no link, and leaves; this is done ``PEELS`` times. The order puts
   frequent shingles last. Their counts come from all documents; only the
   ``ORDERED`` most frequent are told apart, which bounds that table and changes
   no result, as any global order is exact. The classes left are held to the
   same test with their whole sets: a partner of m shingles shares at most the
   shingles that some other class of at most m has, and would have to share
   0.75 / 1.75 (n + m). Regions with equal members are one.
3. The first pivot of a region is the class that shares the largest part of its
   prefix, as the original of near copies does. The exact distances of all
   members to it are computed, and the links found join groups of classes over
   all regions. A region whose members are all of one group is done: a large
   group of near copies ends here, without all its pairs. Elsewhere a member x
   within 2R of the pivot p goes to the Voronoi region of p, the others to the
   outer one. Where a partner y of x lies in the region of p, the triangle
   inequality gives d(x, p) <= d(y, p) + R, so an outer x within R of the
   farthest own member is also copied there, as a guest, unless all own members
   are of its own group.
4. The regions left are joined recursively: the members of each region's smallest
   groups become pivots, four times as many in each round, and meet the members
   of other groups in the window |d(x, p) - d(q, p)| <= R that the triangle
   inequality leaves around them. Then they leave, having met all they had to.
5. Links become classes by alternating large-star and small-star steps.

Sets are never all stored: only classes that share a region get theirs, from a
second reading of their text. Members of regions are (hash, size) rows.

A word's, a shingle's and a set's identity is a 64-bit hash of it.

Defined cases: NULL text or a text without words has an empty set and is linked
with nothing, its class is its own id; NULL ids count as larger than all others
(a group without any id has class NULL); rows equal in id and text are
documents of one class; an empty table gives no rows; extra columns are not
read (``keep_one`` keeps them, whatever their names).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import free_name, small_side, stage
from vitrine.llm.shingles import shingle_hashes, word_hashes

PERCENT = 75
ORDERED = 200_000
LOCAL_REPEATS = 3
COUNT_CHUNK = 2_000_000
CLASS_MEMORY = 1_000_000
OUTPUT_ROWS = 200_000
FIRST_PIVOTS, PIVOT_GROWTH = 16, 4
PEELS = 2
EXTRA = 10  # a prefix has one shingle in so many more than linked sets need to meet

_RADIUS = 1 - PERCENT / 100
_LOG_UNIT = 10_000_000  # sizes as whole numbers on a logarithmic scale
_SLACK = 1e-9  # for distances that were rounded; wider windows cost, but lose nothing


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes of the words, A-Z lower-cased."""
    # Lower-casing and splitting bytes touches ASCII letters and separators only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    return np.unique(shingle_hashes(word_hashes(words)))


def class_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63) if len(s) else 0


def prefix(s: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The set's first shingles in the global order: all others by hash, then the
    frequent ones by rank."""
    n = len(s)
    size = n + (-PERCENT * n) // 100 + 1 + n // EXTRA
    if not len(frequent):
        return s[:size]
    at = np.searchsorted(frequent, s)
    at[at == len(frequent)] = 0
    common = frequent[at] == s
    rare = s[~common]
    if len(rare) >= size:
        return rare[:size]
    late = s[common][np.argsort(rank[at[common]], kind="stable")]
    return np.concatenate([rare, late[:size - len(rare)]])


DOCUMENTS = T.StructType([
    T.StructField("text_key", T.LongType()), T.StructField("class", T.LongType()),
    T.StructField("n", T.LongType()), T.StructField("shingle", T.LongType())])
MEMBERS = T.StructType([T.StructField("shingle", T.LongType()), T.StructField("class", T.LongType()),
                        T.StructField("n", T.LongType())])
SETS = T.StructType([T.StructField("class", T.LongType()), T.StructField("set", T.ArrayType(T.LongType()))])


def _classify(texts: DataFrame, id_name: str, id_type) -> DataFrame:
    """A row (id, text_key, class, n) for each document, and rows (shingle, n) for
    shingles repeated among the documents of a chunk."""
    schema = T.StructType([T.StructField(id_name, id_type), *DOCUMENTS.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, seen = [], 0, set()

        def repeats():
            values, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= LOCAL_REPEATS
            k, shingles = int(often.sum()), values[often].view(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.nulls(k, ids.type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                 pa.array(counts[often].astype(np.int64)), pa.array(shingles)], names=schema.names)

        for batch in batches:
            ids, keys = batch.column(0), []
            for text in batch.column(2):
                s = shingle_set(text.as_py())
                keys.append((class_key(s), len(s)))
                if keys[-1][0] not in seen:  # copies count once for each chunk
                    seen.add(keys[-1][0])
                    held.append(s)
                    size += len(s)
                if size >= COUNT_CHUNK:
                    yield repeats()
                    held, size, seen = [], 0, set()
            if keys:
                classes, sizes = map(np.array, zip(*keys))
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column(1), pa.array(classes.astype(np.int64)),
                     pa.array(sizes.astype(np.int64)), pa.nulls(len(keys), pa.int64())],
                    names=schema.names)
        if held:
            yield repeats()

    return texts.mapInArrow(run, schema)


def _prefix_rows(texts: DataFrame, frequent: np.ndarray, rank: np.ndarray) -> DataFrame:
    """(shingle, class, n) for the prefix of every class, once for each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, sizes, seen = [], [], set()

        def out():
            lengths = [len(p) for p in parts]
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(parts).view(np.int64)),
                 pa.array(np.repeat(np.array([k for k, _ in sizes], np.int64), lengths)),
                 pa.array(np.repeat(np.array([n for _, n in sizes], np.int64), lengths))],
                names=MEMBERS.names)

        rows = 0
        for batch in batches:
            for text in batch.column(0):
                s = shingle_set(text.as_py())
                key = class_key(s)
                if not len(s) or key in seen:
                    continue
                if len(seen) >= CLASS_MEMORY:
                    seen.clear()
                seen.add(key)
                parts.append(prefix(s, frequent, rank))
                sizes.append((key, len(s)))
                rows += len(parts[-1])
                if rows >= OUTPUT_ROWS:
                    yield out()
                    parts, sizes, rows = [], [], 0
        if parts:
            yield out()

    return texts.select("text").mapInArrow(run, MEMBERS)


def _sets(texts: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """(class, set) of the wanted classes, from the text of one document of each."""
    chosen = (documents.join(small_side(classes), "class", "left_semi")
              .groupBy("class").agg(F.min(F.struct("id", "text_key")).alias("d")))
    wanted = small_side(stage(chosen.select(F.col("d.id").alias("chosen"), F.col("d.text_key").alias("key")),
                              "jaccard-texts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [s for text in batch.column(0) if len(s := shingle_set(text.as_py()))]
            if sets:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([class_key(s) for s in sets], pa.int64()),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=SETS.names)

    same = F.col("id").eqNullSafe(F.col("chosen")) & (F.col("text_key") == F.col("key"))
    found = stage(texts.join(wanted, same, "left_semi").select("text").mapInArrow(run, SETS), "jaccard-sets")
    total, distinct = found.agg(F.count(F.lit(1)), F.count_distinct("class")).first()
    # Only rows repeated as a whole give a class twice.
    return found if total == distinct else stage(found.dropDuplicates(["class"]), "jaccard-sets")


def _distances(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with ``linked`` and the distance ``d``."""
    pairs = stage(pairs, "jaccard-pairs")
    members = sets.join(small_side(pairs), F.col("class") == F.col("b")).select(
        "a", "b", F.col("set").alias("set_b"))
    first = small_side(pairs.select(F.col("a").alias("class")).distinct())
    firsts = sets.join(first, "class", "left_semi").select(F.col("class").alias("a"), "set")
    both = members.join(firsts, "a")
    shared = F.size(F.array_intersect("set", "set_b")).cast("long")
    union = F.size("set") + F.size("set_b") - F.col("shared")
    measured = both.withColumn("shared", shared).withColumn("union", union)
    return stage(measured.select(
        "a", "b", (100 * F.col("shared") >= PERCENT * F.col("union")).alias("linked"),
        (1 - F.col("shared") / F.col("union")).alias("d")), "jaccard-distances")


def _shared(members: DataFrame) -> DataFrame:
    """Members of shingles that two classes or more have."""
    by = Window.partitionBy("shingle")
    return (members.withColumn("low", F.min("class").over(by)).withColumn("high", F.max("class").over(by))
            .where("low != high").drop("low", "high"))


def _coarse_regions(members: DataFrame) -> DataFrame:
    """(region, class, own, root, rank): classes that share a prefix shingle, in
    order of the unshared part of their prefix. Regions with equal members get
    one name, from their count and two XORs."""
    shared = stage(_shared(members).dropDuplicates(["shingle", "class"]), "jaccard-shared")
    smallest = F.ceil(F.col("n") * PERCENT / 100)
    needed = 1 + F.floor(smallest / EXTRA)
    length = F.col("n") - smallest + 1 + F.floor(F.col("n") / EXTRA)
    for _ in range(PEELS):
        enough = (shared.groupBy("class").agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n"))
                  .where(F.col("k") >= needed).select("class", (1 - F.col("k") / length).alias("rank")))
        left = shared.drop("rank").join(small_side(stage(enough, "jaccard-enough")), "class")
        shared = stage(_shared(left), "jaccard-shared")
    by = Window.partitionBy("shingle")
    name = F.xxhash64(F.count(F.lit(1)).over(by), F.bit_xor("class").over(by),
                      F.bit_xor(F.xxhash64("class")).over(by), F.min("class").over(by))
    return shared.select(name.alias("region"), "class", "rank").dropDuplicates(["region", "class"]).select(
        "region", "class", F.lit(True).alias("own"), F.col("class").alias("root"), "rank",
        F.lit(None).cast("double").alias("d0"))


def _linkable(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Those of ``classes`` whose shared shingles suffice for a link to a class of
    some size. For each shingle the smallest other class counts that is not too
    small; a shingle without any is shared with nobody."""
    n = F.size("set").cast("long")
    rows = sets.join(small_side(classes), "class", "left_semi").select(
        "class", n.alias("n"), (-F.floor(F.log(n.cast("double")) * _LOG_UNIT)).alias("order"), F.explode("set").alias("shingle"))
    not_too_small = Window.partitionBy("shingle").orderBy("order").rangeBetween(
        Window.unboundedPreceding, int(-np.log(PERCENT / 100) * _LOG_UNIT) + 2)
    met = (rows.withColumn("others", F.count(F.lit(1)).over(not_too_small))
           .withColumn("least", F.min("n").over(not_too_small)).where("others > 1"))
    steps = met.groupBy("class", "n", "least").agg(F.count(F.lit(1)).alias("k"))
    upto = Window.partitionBy("class").orderBy("least").rowsBetween(Window.unboundedPreceding, 0)
    enough = F.sum("k").over(upto) * (100 + PERCENT) >= PERCENT * (F.col("n") + F.col("least"))
    return stage(steps.withColumn("enough", enough).where("enough").select("class").distinct(),
                 "jaccard-linkable")


def _open(regions: DataFrame) -> DataFrame:
    """Rows of the regions that still hold an own member and two groups."""
    left = regions.groupBy("region").agg(
        F.max("own").alias("any_own"), F.min("root").alias("low"), F.max("root").alias("high")
    ).where("any_own and low != high").select("region")
    return stage(regions.join(small_side(stage(left, "jaccard-open")), "region", "left_semi"),
                 "jaccard-regions")


def _meet(regions: DataFrame, chosen: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members beside the pivots they have to meet, with the distances; the links
    among them; and the groups that the links join (root, to)."""
    chosen = chosen.select("region", F.col("class").alias("pivot"), F.col("root").alias("pivot_root"),
                           F.col("d0").alias("pivot_d0"))
    pair = F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b")
    window = F.coalesce(F.abs(F.col("d0") - F.col("pivot_d0")) <= _RADIUS + _SLACK, F.lit(True))
    met = regions.join(small_side(chosen), "region").where((F.col("root") != F.col("pivot_root")) & window)
    measured = _distances(met.select(*pair).distinct(), sets)
    met = stage(met.select("*", *pair).join(small_side(measured), ["a", "b"]), "jaccard-met")
    joined = met.where("linked").select(F.col("root").alias("a"), F.col("pivot_root").alias("b")).distinct()
    groups = stage(_connected(joined).select(F.col("class").alias("root"), F.col("root").alias("to")),
                   "jaccard-joined")
    return met, measured.where("linked").select("a", "b"), groups


def _regroup(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(small_side(groups), "root", "left").withColumn("root", F.coalesce("to", "root")).drop("to")


def _voronoi(regions: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links to the central pivot of every region; the Voronoi and outer regions left."""
    central = Window.partitionBy("region").orderBy("rank", "class")
    chosen = stage(regions.withColumn("place", F.row_number().over(central)).where("place = 1"),
                   "jaccard-pivots")
    met, links, groups = _meet(regions, chosen, sets)
    known = _regroup(met, groups)  # a member beside its region's pivot
    mixed = known.groupBy("region").agg(F.min("root").alias("low"), F.max("root").alias("high")
                                        ).where("low != high").select("region")
    known = known.join(small_side(stage(mixed, "jaccard-mixed")), "region", "left_semi")
    # Coarse regions around one pivot are one Voronoi region.
    known = known.dropDuplicates(["pivot", "class"]).withColumn("region", F.xxhash64("pivot"))
    inside = F.col("d") < 2 * _RADIUS
    cell = Window.partitionBy("region")
    known = known.withColumns({
        "radius": F.max(F.when(inside, F.col("d"))).over(cell),
        "low": F.min(F.when(inside, F.col("root"))).over(cell),
        "high": F.max(F.when(inside, F.col("root"))).over(cell)})
    other = (F.col("low") != F.col("high")) | (F.col("root") != F.col("low"))
    guest = ~inside & other & (F.col("d") <= F.col("radius") + _RADIUS + _SLACK)
    cells = known.where(inside | F.coalesce(guest, F.lit(False))).select(
        "region", "class", inside.alias("own"), "root", "rank", F.col("d").alias("d0"))
    outer = known.where(~inside).select(
        F.xxhash64("region", F.lit("outer")).alias("region"), "class", F.lit(True).alias("own"), "root",
        "rank", F.lit(None).cast("double").alias("d0"))
    return links, _open(stage(cells.union(outer), "jaccard-dealt"))


def _recurse(regions: DataFrame, sets: DataFrame, pivots: int) -> tuple[DataFrame, DataFrame]:
    """Links of ``pivots`` members of every region's smallest groups; the regions left."""
    sized = regions.withColumn("size", F.count(F.lit(1)).over(Window.partitionBy("region", "root")))
    small_first = Window.partitionBy("region").orderBy("size", "root", "rank", "class")
    chosen = stage(sized.withColumn("place", F.row_number().over(small_first))
                   .where(F.col("place") <= pivots), "jaccard-pivots")
    _, links, groups = _meet(regions, chosen, sets)
    rest = regions.join(small_side(chosen.select("region", "class")), ["region", "class"], "left_anti")
    return links, _open(stage(_regroup(rest, groups), "jaccard-rest"))


def _connected(links: DataFrame) -> DataFrame:
    """(class, root) for every class with a link, by large-star and small-star
    steps until nothing changes."""
    edges = stage(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                  "jaccard-links")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("a", "b") if not large else e.select("a", "b").union(e.select("b", "a"))
        # Large: every node u with all neighbours. Small: u with its smaller ones.
        around = both.select(F.col("a").alias("u"), F.col("b").alias("v")) if large else both.select(
            F.col("b").alias("u"), F.col("a").alias("v"))
        least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        met = around.join(least, "u")
        new = met.where("v > u").select("v", "m") if large else met.select("v", "m").union(
            least.select(F.col("u").alias("v"), "m"))
        return (new.where("v != m").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct())

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()

    before = mark(edges)
    while True:
        edges = stage(star(stage(star(edges, True), "jaccard-large"), False), "jaccard-small")
        now = mark(edges)
        if now == before:
            return edges.select(F.col("b").alias("class"), F.col("a").alias("root")).union(
                edges.select(F.col("a").alias("class"), F.col("a").alias("root"))).distinct()
        before = now


def _frequent(documents: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``ORDERED`` most frequent shingles, sorted by hash, and their ranks."""
    top = (documents.where("shingle is not null").groupBy("shingle").agg(F.sum("n").alias("n"))
           .orderBy(F.col("n").desc(), "shingle").limit(ORDERED).toArrow())
    shingles = top.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    rank = np.empty(len(shingles), np.int32)
    rank[:] = np.arange(len(shingles))[::-1]  # the most frequent comes last
    return shingles[order], rank[order]


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def documents_and_roots(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, class, n, root) of every document, staged; NULL root for
    classes without a link to another."""
    texts = docs.select(F.col(id_col).alias("id"), _text_key(F.col(text_col)).alias("text_key"),
                        F.col(text_col).alias("text"))
    classified = stage(_classify(texts, "id", docs.schema[id_col].dataType), "jaccard-documents")
    documents = classified.where("class is not null").drop("shingle")
    frequent, rank = _frequent(classified)
    regions = stage(_coarse_regions(_prefix_rows(texts, frequent, rank)), "jaccard-regions")
    links, pivots = None, FIRST_PIVOTS
    if not regions.isEmpty():
        classes = stage(regions.select("class").distinct(), "jaccard-wanted")
        sets = _sets(texts, classes, documents)
        for _ in range(PEELS):
            classes = _linkable(sets, classes)
        links, regions = _voronoi(_open(regions.join(small_side(classes), "class", "left_semi")), sets)
    while not regions.isEmpty():
        found, regions = _recurse(regions, sets, pivots)
        links = links.union(found)
        pivots *= PIVOT_GROWTH
    if links is None:
        return documents.withColumn("root", F.lit(None).cast("long"))
    roots = small_side(stage(_connected(links), "jaccard-roots"))
    return stage(documents.join(roots, "class", "left"), "jaccard-rooted")


def _grouped(rooted: DataFrame) -> DataFrame:
    """``rooted`` with ``first``: the smallest (id, text key) of the document's
    group, NULL where the document is alone."""
    group = F.coalesce("root", "class")
    full = rooted.withColumn("group", F.when(F.col("n") > 0, group))
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key"))
    groups = (full.where("group is not null").groupBy("group")
              .agg(first.alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1").drop("size"))
    return full.join(small_side(stage(groups, "jaccard-groups")), "group", "left")


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component_id) of every row."""
    grouped = _grouped(documents_and_roots(docs, id_col, text_col))
    own = F.when(F.col("first").isNull(), F.col("id")).otherwise(F.col("first.id"))
    return grouped.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                          own.alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents: that with the
    smallest id, of equal ids the one with the smallest text hash, of equal rows
    one. Documents without words all stay."""
    grouped = _grouped(documents_and_roots(docs, id_col, text_col))
    key, gone_id, gone_key = (free_name(docs, x) for x in ("text_key", "gone_id", "gone_key"))
    same = F.col(id_col).eqNullSafe(F.col(gone_id)) & (F.col(key) == F.col(gone_key))
    named = F.col("id").alias(gone_id), F.col("text_key").alias(gone_key)
    gone = grouped.where(F.col("first").isNotNull() & ~(
        F.col("id").eqNullSafe(F.col("first.id")) & (F.col("text_key") == F.col("first.text_key"))))
    gone = stage(gone.select(*named).distinct(), "jaccard-gone")
    again = stage(grouped.where("first is not null").groupBy("id", "text_key").count().where("count > 1")
                  .select(*named), "jaccard-again")
    keyed = docs.withColumn(key, _text_key(F.col(text_col)))
    kept = keyed.join(small_side(gone), same, "left_anti")
    if not again.isEmpty():
        twice = kept.join(small_side(again), same, "left_semi").dropDuplicates([id_col, key])
        kept = kept.join(small_side(again), same, "left_anti").unionByName(twice)
    return kept.drop(key)

"""Hard-negative mining by angular triangle filtering.

Rows are whole-number vectors (``vectors.quantised``) with a label. A score is an
inner product; higher ones come first, ties by the smaller id. An anchor's
positives are its first ``POSITIVES`` other rows of the same label; for each of
them the first ``NEGATIVES`` rows of another label whose score lies in the window
[low, high] percent of the positive's score come back.

Method. Every row stores its angles to ``REFERENCES`` fixed directions. By the
triangle inequality the angle between two vectors lies, for every direction, in
[|s - t|, s + t] of their two stored angles; the cosines of these bounds times
the norms bound the score. Angles are widened by ``SLACK`` and scores by a
relative 1e-9, far above what rounding can do, so a bound never cuts off a score
that counts. The bounds are applied from coarse to fine:

1. Rows are dealt by range of (nearest direction, angle to it) into blocks that
   store the least and largest angle to every direction. A block meets only the
   blocks of anchors whose score windows can overlap its own.
2. In a pair of blocks, anchors whose window misses the block drop out; the rest
   go in tiles along the angle to the block's direction, and a tile meets the
   stretch of rows, found by binary search, that lies in its angular windows.
3. Only those rows are scored, as exact integer products.

Windows narrow as results come in. An anchor starts with the fifth best
same-label score of its own block; each task then carries the best rows so far of
the anchors it meets, and raises the bound with them. Lists from the tasks (at
most five rows a window from each) are merged by a ranking over the anchor.

The anchors are a stated query set that meets all rows in blocks. Blocks are
bounded, so a label, vector or direction that holds a third of all rows only
makes more blocks of it; anchor blocks are broadcast if their measured size
allows it and joined by a shuffle beyond. On directions without any clusters the
bounds cannot exclude much, and the work grows with anchors times rows.

Defined cases: rows with a NULL label, id or vector, an empty vector, or a NULL,
NaN or infinite entry take no part, nor do vectors of another length than most
rows have; of rows that share an id the one with the smallest (label, vector)
counts; a zero vector scores 0; scores beyond a long count as the nearest long;
a positive with a negative score has an empty window; with fewer rows than asked
for, all come back; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitrine.llm.common import small_side, stage
from vitrine.llm.vectors import matrix, of_common_length, peak, products, quantised, whole
from vitrine.session import parallelism

POSITIVES, NEGATIVES = 5, 5
LOW, HIGH = 80, 100
REFERENCES = 16
SAMPLE_ROWS = 512
SLACK = 4e-6
BLOCK_ROWS, BLOCK_BYTES = 4096, 4 << 20
TILE = 256
HELD_BLOCKS = 64
LONG = (1 << 63) - 1

# A block: who is in it (payload) and what its rows have in common.
BLOCK = ("block long, size int, cell int, lo array<double>, hi array<double>, norm_lo double, norm_hi double, "
         "ids binary, labels binary, kind string, x binary, angles binary, norms binary, wanted binary")
SEARCHED = ("cell", "ids", "labels", "kind", "x", "angles", "norms")


def references(rows: DataFrame) -> np.ndarray:
    """Unit directions: a farthest-first walk over the ``SAMPLE_ROWS`` rows with
    the smallest hash. The sample only steers how well bounds cut, never what is
    searched."""
    sample = rows.orderBy(F.xxhash64("x"), "vec_id").limit(SAMPLE_ROWS).select("x").collect()
    x = np.array([r["x"] for r in sample] or [[]], np.float64)
    norms = np.sqrt((x * x).sum(axis=1))
    x = x[norms > 0] / norms[norms > 0][:, None]
    if not len(x):
        return np.zeros((0, 0))
    chosen, near = [0], x @ x[0]
    while len(chosen) < REFERENCES and near.min() < 1 - 1e-9:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, x @ x[chosen[-1]])
    return x[chosen]


def measures(x: np.ndarray, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and angles to all directions (zero vectors: 0)."""
    x = x.astype(np.float64)
    size = np.abs(x).max(axis=1, initial=0)
    safe = np.where(size > 0, size, 1)
    unit = x / safe[:, None]  # no overflow in the squares
    length = np.sqrt((unit * unit).sum(axis=1))
    cos = (unit @ refs.T) / np.where(length > 0, length, 1)[:, None]
    angles = np.where(length[:, None] > 0, np.arccos(np.clip(cos, -1, 1)), 0)
    return length * size, angles


def block_rows(dimension: int) -> int:
    return max(min(BLOCK_ROWS, BLOCK_BYTES // (8 * dimension)), 1)


class Rows:
    """Rows of a block in memory, their stored angles included."""

    def __init__(self, ids, labels, x, angles, norms):
        self.ids, self.labels, self.x, self.angles, self.norms = ids, labels, x, angles, norms

    def take(self, at) -> Rows:
        return Rows(self.ids[at], self.labels[at], self.x[at], self.angles[at], self.norms[at])

    def packed(self, block: int, cell: int) -> dict:
        most = peak(self.x)
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        return {"block": block, "size": len(self.ids), "cell": cell,
                "lo": self.angles.min(axis=0).tolist(), "hi": self.angles.max(axis=0).tolist(),
                "norm_lo": float(self.norms.min()), "norm_hi": float(self.norms.max()),
                "ids": self.ids.astype("<i8").tobytes(), "labels": self.labels.astype("<i8").tobytes(),
                "kind": kind, "x": self.x.astype(kind).tobytes(), "angles": self.angles.astype("<f4").tobytes(),
                "norms": self.norms.astype("<f8").tobytes()}

    @staticmethod
    def unpacked(row: dict, prefix: str = "") -> Rows:
        ids = np.frombuffer(row[prefix + "ids"], "<i8")
        part = lambda name, kind: np.frombuffer(row[prefix + name], kind)
        return Rows(ids, part("labels", "<i8"), part("x", row[prefix + "kind"]).reshape(len(ids), -1),
                    part("angles", "<f4").reshape(len(ids), -1).astype(np.float64), part("norms", "<f8"))


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = products(a, b)
    return np.clip(out, -LONG, LONG).astype(np.int64) if out.dtype == object else out


class Best:
    """The first rows of every slot so far, by falling score, then id."""

    def __init__(self, most: int, floors: np.ndarray):
        self.most, self.floors = most, floors.copy()  # a slot's score must reach its floor
        self.slot = self.score = self.id = np.zeros(0, np.int64)

    def add(self, slot, score, ids) -> None:
        slot, score, ids = (np.concatenate(p) for p in ((self.slot, slot), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.searchsorted(slot, slot)
        place = np.arange(len(slot)) - first
        full = place == self.most - 1
        self.floors[slot[full]] = np.maximum(self.floors[slot[full]], score[full])
        keep = place < self.most
        self.slot, self.score, self.id = slot[keep], score[keep], ids[keep]


def widest(floor: np.ndarray, norms: np.ndarray, norm_hi: float) -> np.ndarray:
    """The largest angle at which a score can reach ``floor``; below 0: none can."""
    reach = norms * norm_hi * (1 + 1e-9)
    cos = np.divide(floor.astype(np.float64), reach, out=np.where(floor > 0, 2.0, -1.0), where=reach > 0)
    angle = np.arccos(np.clip(cos, -1, 1)) + SLACK
    return np.where(cos > 1 + 1e-9, -1.0, np.where(cos <= 0, math.pi, angle))


class Search:
    """One block of anchors against blocks of rows."""

    def __init__(self, anchors: Rows, most: int):
        self.anchors, self.most = anchors, most

    def floors(self) -> np.ndarray:
        """For each anchor, the least score of interest now."""

    def meet(self, rows: Rows, cell: int) -> None:
        a = self.anchors
        floor, cap = self.floors(), self.caps
        angle = widest(floor, a.norms, rows.norms.max())
        lo, hi = rows.angles.min(axis=0) - SLACK, rows.angles.max(axis=0) + SLACK
        gap = np.maximum(np.maximum(lo - a.angles, a.angles - hi), 0).max(axis=1)
        nearest = np.cos(np.minimum(a.angles + hi + SLACK, math.pi)).max(axis=1)
        least = nearest * a.norms * np.where(nearest > 0, rows.norms.min(), rows.norms.max())
        live = np.flatnonzero((gap <= angle) & (least <= cap + 1e-9 * np.abs(cap) + 1))
        live = live[np.argsort(a.angles[live, cell], kind="stable")]
        along = rows.angles[:, cell]  # rows of a block come in this order
        for at in range(0, len(live), TILE):
            tile = live[at:at + TILE]
            low = (a.angles[tile] - angle[tile, None]).min(axis=0) - SLACK
            high = (a.angles[tile] + angle[tile, None]).max(axis=0) + SLACK
            begin, end = np.searchsorted(along, low[cell]), np.searchsorted(along, high[cell], "right")
            near = rows.angles[begin:end]
            found = begin + np.flatnonzero(((near >= low) & (near <= high)).all(axis=1))
            if len(found):
                self.keep(tile, found, rows, scores(a.x[tile], rows.x[found]))


class Positives(Search):
    """The first same-label rows; ``start`` is a score that many already reach."""

    def __init__(self, anchors: Rows, start: np.ndarray, most: int):
        super().__init__(anchors, most)
        self.best = Best(most, start)
        self.caps = np.full(len(anchors.ids), np.inf)

    def floors(self) -> np.ndarray:
        return self.best.floors

    def keep(self, tile, found, rows, score) -> None:
        a = self.anchors
        fit = ((a.labels[tile][:, None] == rows.labels[found]) & (a.ids[tile][:, None] != rows.ids[found])
               & (score >= self.best.floors[tile][:, None]))
        if fit.shape[1] > 4 * self.most:  # what is below the tile's own fifth best is out
            fifth = np.partition(np.where(fit, score, -LONG), -self.most, axis=1)[:, -self.most]
            fit &= score >= fifth[:, None]
        i, j = np.nonzero(fit)
        self.best.add(tile[i], score[i, j], rows.ids[found[j]])

    def results(self) -> pa.RecordBatch:
        b = self.best
        return pa.record_batch([pa.array(self.anchors.ids[b.slot]), pa.array(b.id), pa.array(b.score)],
                               names=["anchor_id", "positive_id", "positive_score"])


class Negatives(Search):
    """The first other-label rows of every positive's window."""

    def __init__(self, anchors: Rows, positives: tuple, low: int, high: int, most: int):
        super().__init__(anchors, most)
        self.owner, self.positive, self.score = positives  # by anchor
        as_int = self.score.tolist()
        self.low = np.array([min(-(-low * p // 100), LONG) for p in as_int], np.int64)
        self.high = np.array([max(high * p // 100, -LONG) for p in as_int], np.int64)
        self.best = Best(most, self.low)
        self.caps = np.full(len(anchors.ids), -np.inf)
        np.maximum.at(self.caps, self.owner, self.high)

    def floors(self) -> np.ndarray:
        out = np.full(len(self.anchors.ids), LONG)
        np.minimum.at(out, self.owner, self.best.floors)
        return out

    def keep(self, tile, found, rows, score) -> None:
        a = self.anchors
        least = self.floors()[tile]
        i, j = np.nonzero((a.labels[tile][:, None] != rows.labels[found]) & (score >= least[:, None])
                          & (score <= self.caps[tile][:, None]))
        if not len(i):
            return
        order = np.lexsort((rows.ids[found[j]], -score[i, j], i))
        i, j = i[order], j[order]
        value, ids, who = score[i, j], rows.ids[found[j]], tile[i]
        rank = np.arange(len(self.owner)) - np.searchsorted(self.owner, self.owner)
        for r in range(int(rank.max()) + 1):  # the windows of an anchor, one after another
            slot_of = np.full(len(a.ids), -1)
            slot_of[self.owner[rank == r]] = np.flatnonzero(rank == r)
            slot = slot_of[who]
            fit = (slot >= 0) & (value >= self.best.floors[slot]) & (value <= self.high[slot])
            s, v, n = slot[fit], value[fit], ids[fit]
            place = np.arange(len(s)) - np.maximum.accumulate(
                np.where(np.concatenate([[True], s[1:] != s[:-1]]), np.arange(len(s)), 0)) if len(s) else s
            top = place < self.most  # candidates come in order within each anchor
            self.best.add(s[top], v[top], n[top])

    def results(self) -> pa.RecordBatch:
        b = self.best
        return pa.record_batch([
            pa.array(self.anchors.ids[self.owner[b.slot]]), pa.array(self.positive[b.slot]), pa.array(b.id),
            pa.array(self.score[b.slot]), pa.array(b.score)],
            names=["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])


def _searched(make):
    """Joined pairs of blocks to results; ``make`` builds a search from a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Search] = {}
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                search = held.get(row["a_block"])
                if search is None:
                    if len(held) >= HELD_BLOCKS:  # hand over what is there; lists are merged later
                        for done in held.values():
                            yield done.results()
                        held.clear()
                    search = held[row["a_block"]] = make(row)
                search.meet(Rows.unpacked(row), row["cell"])
        for done in held.values():
            yield done.results()
    return run


def _row_blocks(rows: DataFrame, refs: np.ndarray) -> DataFrame:
    """Rows in blocks of one nearest direction, ordered by the angle to it."""
    most = block_rows(refs.shape[1])

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                _, angles = measures(matrix(batch.column(2)), refs)
                cell = angles.argmin(axis=1)
                along = angles[np.arange(len(cell)), cell]
                yield pa.record_batch([*batch.columns, pa.array(cell.astype(np.int32)), pa.array(along)],
                                      names=["vec_id", "label", "x", "wanted", "cell", "along"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        base, done = TaskContext.get().partitionId() << 32, 0
        held: list = []

        def block():
            nonlocal done, held
            ids, labels, x, wanted, cell = (np.concatenate([h[i] for h in held]) for i in range(5))
            norms, angles = measures(x, refs)
            out = Rows(ids, labels, x, angles, norms)
            order = np.argsort(angles[:, cell[0]], kind="stable")
            held, done = [], done + 1
            row = out.take(order).packed(base + done, int(cell[0]))
            row["wanted"] = ids[wanted].astype("<i8").tobytes()
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            cells = batch.column(4).to_numpy()
            wanted = batch.column(3).to_numpy(zero_copy_only=False)
            ids, labels = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x = matrix(batch.column(2))
            at = 0
            while at < len(ids):
                if held and (held[0][4][0] != cells[at] or sum(len(h[0]) for h in held) >= most):
                    yield block()
                room = most - sum(len(h[0]) for h in held)
                end = min(at + room, int(np.searchsorted(cells, cells[at], "right")))
                held.append(tuple(v[at:end] for v in (ids, labels, x, wanted, cells)))
                at = end
        if held:
            yield block()

    schema = pa.schema([("block", pa.int64()), ("size", pa.int32()), ("cell", pa.int32()),
                        ("lo", pa.list_(pa.float64())), ("hi", pa.list_(pa.float64())),
                        ("norm_lo", pa.float64()), ("norm_hi", pa.float64()), ("ids", pa.binary()),
                        ("labels", pa.binary()), ("kind", pa.string()), ("x", pa.binary()),
                        ("angles", pa.binary()), ("norms", pa.binary()), ("wanted", pa.binary())])
    spark = rows.sparkSession
    parts = max(rows.count() // (4 * most) + 1, parallelism(spark))
    keyed = rows.mapInArrow(placed, "vec_id long, label long, x array<long>, wanted boolean, cell int, along double")
    return stage(keyed.repartitionByRange(parts, "cell", "along", "vec_id")
                 .sortWithinPartitions("cell", "along", "vec_id").mapInArrow(cut, BLOCK), "mining-rows")


def _anchors(blocks: DataFrame, most: int) -> DataFrame:
    """The anchors with their angles, and the score that their own block already
    holds ``most`` same-label rows of."""
    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n in range(batch.num_rows):
                row = batch.slice(n, 1).to_pylist()[0]
                rows = Rows.unpacked(row)
                mine = rows.take(np.flatnonzero(np.isin(rows.ids, np.frombuffer(row["wanted"], "<i8"))))
                search = Positives(mine, np.full(len(mine.ids), -LONG), most)
                search.meet(rows, row["cell"])
                yield pa.record_batch([
                    pa.array(mine.ids), pa.array(mine.labels), pa.array(list(mine.x.astype(np.int64)), pa.list_(pa.int64())),
                    pa.array(list(mine.angles), pa.list_(pa.float64())), pa.array(mine.norms),
                    pa.array(search.best.floors)], names=["vec_id", "label", "x", "angles", "norm", "floor"])

    return stage(blocks.where(F.octet_length("wanted") > 0).mapInArrow(
        own, "vec_id long, label long, x array<long>, angles array<double>, norm double, floor long"), "mining-anchors")


_A_BLOCK = ("a_block int, a_lo array<double>, a_hi array<double>, a_need double, a_cap double, a_ids binary, "
            "a_labels binary, a_kind string, a_x binary, a_angles binary, a_norms binary, a_floors binary, "
            "a_owner binary, a_positive binary, a_score binary")


def _anchor_blocks(anchors: DataFrame, most: int, high: int) -> tuple[DataFrame, int]:
    """Anchors (with ``found``, their positives, in the second search) in numbered
    blocks of about ``most``, of one direction or a few; and how many numbers."""
    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = lambda name: table.column(name).combine_chunks()
        rows = Rows(col("vec_id").to_numpy(), col("label").to_numpy(), matrix(col("x")),
                    matrix(col("angles"), np.float64), col("norm").to_numpy())
        floors = col("floor").to_numpy()
        found = col("found").to_pylist()
        triples = [(i, f["id"], f["score"]) for i, fs in enumerate(found)
                   for f in sorted(fs or [], key=lambda f: f["id"])]
        owner, positive, score = (np.array([t[k] for t in triples], np.int64) for k in range(3))
        cap = np.full(len(floors), np.inf)
        if triples:
            cap = np.full(len(floors), -np.inf)
            np.maximum.at(cap, owner, score.astype(np.float64) * high / 100)
        out = rows.packed(0, 0)
        safe = np.where(rows.norms > 0, rows.norms, 1)
        need = np.where(rows.norms > 0, floors / safe, np.where(floors > 0, np.inf, -np.inf))
        row = {"a_block": col("slot")[0].as_py(), "a_lo": out["lo"], "a_hi": out["hi"],
               "a_need": float(need.min()), "a_cap": float((cap / safe).max()),
               **{f"a_{k}": out[k] for k in ("ids", "labels", "kind", "x", "angles", "norms")},
               "a_floors": floors.astype("<i8").tobytes(), "a_owner": owner.astype("<i8").tobytes(),
               "a_positive": positive.astype("<i8").tobytes(), "a_score": score.astype("<i8").tobytes()}
        return pa.Table.from_pylist([row], schema)

    schema = pa.schema([("a_block", pa.int32()), ("a_lo", pa.list_(pa.float64())), ("a_hi", pa.list_(pa.float64())),
                        ("a_need", pa.float64()), ("a_cap", pa.float64()), ("a_ids", pa.binary()),
                        ("a_labels", pa.binary()), ("a_kind", pa.string()), ("a_x", pa.binary()),
                        ("a_angles", pa.binary()), ("a_norms", pa.binary()), ("a_floors", pa.binary()),
                        ("a_owner", pa.binary()), ("a_positive", pa.binary()), ("a_score", pa.binary())])
    cell = F.array_position(F.col("angles"), F.array_min("angles")).cast("int")
    placed = anchors.withColumn("cell", cell)
    counts = placed.groupBy("cell").count().orderBy("cell").collect()  # one row a direction
    first, parts, room, n = [], [], 0, 0
    for row in counts:  # small neighbouring cells share a block, large ones are split
        if row["count"] > room:
            need = -(-row["count"] // most)
            first.append((row["cell"], n))
            parts.append(need)
            n, room = n + need, need * most - row["count"] if need == 1 else 0
        else:
            first.append((row["cell"], n - 1))
            parts.append(1)
            room -= row["count"]
    start = F.create_map(*[F.lit(v) for pair in first for v in pair])[F.col("cell")]
    spread = F.create_map(*[F.lit(v) for (c, _), p in zip(first, parts) for v in (c, p)])[F.col("cell")]
    slot = (start + F.pmod(F.xxhash64("vec_id"), spread.cast("long"))).cast("int")
    return stage(placed.withColumn("slot", slot).groupBy("slot").applyInArrow(pack, _A_BLOCK), "mining-blocks"), n


def _pairs(blocks: DataFrame, anchor_blocks: DataFrame, n: int) -> DataFrame:
    """Pairs of blocks whose score windows can overlap."""
    every = blocks.withColumn("a_block", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    gap = F.array_max(F.zip_with(
        F.zip_with("lo", "a_hi", lambda a, b: a - b), F.zip_with("a_lo", "hi", lambda a, b: a - b),
        lambda a, b: F.greatest(a, b)))
    cos = F.when(F.col("a_need") <= 0, F.lit(-1.0)).when(F.col("norm_hi") == 0, F.lit(2.0)) \
        .otherwise(F.col("a_need") / (F.col("norm_hi") * (1 + 1e-9)))
    near = (F.when(cos <= 0, F.lit(True)).when(cos > 1 + 1e-9, F.lit(False))
            .otherwise(gap <= F.acos(F.least(cos, F.lit(1.0))) + 4 * SLACK))
    least = F.array_max(F.zip_with("hi", "a_hi", lambda a, b: F.cos(F.least(a + b + 4 * SLACK, F.lit(math.pi)))))
    least = least * F.when(least > 0, F.col("norm_lo")).otherwise(F.col("norm_hi"))
    below = least <= F.col("a_cap") + F.abs("a_cap") * 1e-9 + 1
    return every.join(small_side(anchor_blocks), "a_block").where(near & below).select(
        *SEARCHED, *[c for c in anchor_blocks.columns if c not in ("a_lo", "a_hi", "a_need", "a_cap")])


def _merged(lists: DataFrame, keys: list[str], by: str, ids: str, most: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(by), ids)
    return lists.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= most)


def participants(df: DataFrame, anchor: Column, id_col: str, vector: str, label: str) -> DataFrame:
    """The rows that take part, written: vec_id, label, x, wanted (is it an
    anchor); one for each id."""
    rows = df.where(F.col(id_col).isNotNull() & F.col(label).isNotNull() & whole(F.col(vector))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
        quantised(F.col(vector)).alias("x"), F.coalesce(anchor, F.lit(False)).alias("wanted"))
    rows = stage(of_common_length(rows, "x"), "mining-input")
    twice = stage(rows.groupBy("vec_id").count().where(F.col("count") > 1).select("vec_id"), "mining-twice")
    if twice.isEmpty():
        return rows
    ids = small_side(twice)
    one = (rows.join(ids, "vec_id", "left_semi").groupBy("vec_id")
           .agg(F.min(F.struct("label", "x", "wanted")).alias("r")).select("vec_id", "r.*"))
    return stage(rows.join(ids, "vec_id", "left_anti").unionByName(one), "mining-input")


def mine(df: DataFrame, anchor: Column, id_col: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    ``anchor`` is a condition on the rows of ``df``."""
    rows = participants(df, anchor, id_col, vector, label)
    empty = df.sparkSession.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    refs = references(rows)
    if not refs.size:  # no row, or zero vectors alone: any direction does
        first = rows.first()
        if first is None:
            return empty
        refs = np.eye(1, len(first["x"]))
    blocks = _row_blocks(rows, refs)
    anchors = _anchors(blocks, positives)
    if anchors.isEmpty():
        return empty
    no_list = F.lit(None).cast("array<struct<id:long,score:long>>")
    most = block_rows(refs.shape[1])
    anchor_blocks, n = _anchor_blocks(anchors.withColumn("found", no_list), most, high)

    def first_search(row):
        a = Rows.unpacked(row, "a_")
        return Positives(a, np.frombuffer(row["a_floors"], "<i8"), positives)

    near = _pairs(blocks, anchor_blocks, n).mapInArrow(
        _searched(first_search), "anchor_id long, positive_id long, positive_score long")
    near = _merged(near, ["anchor_id"], "positive_score", "positive_id", positives, "rank").where("positive_score >= 0")
    found = near.groupBy(F.col("anchor_id").alias("vec_id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("found"))
    second = stage(anchors.drop("floor").join(found, "vec_id").withColumn("floor", F.ceil(
        F.aggregate("found", F.lit(LONG), lambda acc, f: F.least(acc, f["score"])).cast("decimal(38,0)")
        * low / 100).cast("long")), "mining-windows")
    if second.isEmpty():
        return empty
    anchor_blocks, n = _anchor_blocks(second, most, high)

    def second_search(row):
        triple = tuple(np.frombuffer(row[f"a_{k}"], "<i8") for k in ("owner", "positive", "score"))
        return Negatives(Rows.unpacked(row, "a_"), triple, low, high, negatives)

    hard = _pairs(blocks, anchor_blocks, n).mapInArrow(
        _searched(second_search),
        "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    return _merged(hard, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, "rank").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

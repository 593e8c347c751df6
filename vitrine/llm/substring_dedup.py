"""Substring dedup: exact repeats of word windows by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words of one document. It repeats if its word
sequence also starts earlier (in a smaller ``doc_id``, or earlier in the same
document); every word that a repeating window covers is removed. Windows are
judged on the input, not on what is left.

Method:

1. A window's minimiser is the least hash of its runs of ``MINIMISER_WORDS``
   words, so equal windows have equal minimisers. Consecutive windows that share
   one travel as one packed string (a super-k-mer: their stretch of the text) in
   place of ``WINDOW`` words for each window.
2. The minimiser decides the bucket; buckets make passes and passes lanes. The
   strings that a run of texts of ``GROUP_BYTES`` has for one lane go as one
   compressed row. The number of lanes grows with the data, so that a lane has a
   share of ``LANE_BYTES`` and a pass one of ``PASS_BYTES``. A task holds one lane,
   compressed, and unpacks and sorts the windows of one pass at a time; of each run
   of equal windows all but the first start repeat.
3. Stretches of removed words go back to their documents by an equi-join.

Skew. Before anything is shuffled, the windows of each run of texts are sorted in
place: what repeats there is settled at once, so a passage of a third of all
documents leaves such a run once. The strings around a frequent passage still
differ, yet share its minimisers; buckets of more than ``HOT_STRINGS`` strings are
counted in a first reading of the texts and taken window by window: a ``groupBy`` on the window, which has no hot
key left, finds the first start.

A window's identity is 128 bits: two polynomials of two independent 64-bit word
hashes. Words are found and hashed as columns of bytes, without Python objects.

Defined cases: NULL and empty texts have no words; texts under ``WINDOW`` words
have no window and stay whole; a NULL ``doc_id`` is one id that sorts before all
others; rows that share a ``doc_id`` are one document's versions: of windows with
the same start neither is earlier, so repeated rows leave each other alone; long
runs of one word and very long texts are cut into strings of at most
``STRING_WINDOWS`` windows; words of more than ``CHUNK`` bytes are hashed on their
own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitrine.llm.common import small_side, stage
from vitrine.llm.shingles import mixed
from vitrine.session import parallelism

WINDOW = 20
MINIMISER_WORDS = 4
STRING_WINDOWS = 128
GROUP_BYTES = 4 << 20
LANE_BYTES, PASS_BYTES = 64 << 20, 4 << 20
PASS_BUCKETS = 16
HOT_STRINGS = 16384
MOST_TASKS = 50_000
CHUNK = 1 << 20

_U = np.uint64
_BASES = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
# The strings of one lane, ``sizes`` of them with ``bytes`` of text for each pass, or
# (``packed`` NULL) stretches whose removal is settled and which any lane may carry;
# ``owner`` counts within ``doc_ids``.
STRINGS = ("lane long, doc_ids array<long>, digests array<long>, sizes array<int>, bytes array<int>, packed binary, "
           "owner array<int>, start array<int>, words array<int>")
COUNTS = "lane long, counts array<int>"
STRETCHES = "doc_id long, digest long, start long, stop long"
WINDOWS = "doc_id long, digest long, start long, high long, low long"
_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_ARROW_STRINGS = pa.schema([
    ("lane", pa.int64()), ("doc_ids", _LONGS), ("digests", _LONGS), ("sizes", _INTS), ("bytes", _INTS), ("packed", pa.binary()),
    ("owner", _INTS), ("start", _INTS), ("words", _INTS)])
_ARROW_COUNTS = pa.schema([("lane", pa.int64()), ("counts", _INTS)])
# A string's numbers, column by column before the texts: the step of the owner from
# the string before, the first word, how many words, the bucket within the lane.
_FIELDS = (("owner", "<i4"), ("start", "<i4"), ("words", "u1"), ("bucket", "u1"))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _inverse(base: int) -> int:
    """Of an odd number, modulo 2^64."""
    return pow(base, -1, 1 << 64)


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def _powers() -> list[tuple[np.ndarray, np.ndarray]]:
    """Powers of both bases and of their inverses, once in each worker."""
    if not _tables:
        for base in _BASES:
            out = []
            for b in (int(base), _inverse(int(base))):
                steps = np.full(CHUNK + 1, b, _U)
                steps[0] = 1
                out.append(np.cumprod(steps))
            _tables.append(tuple(out))
    return _tables


def word_spans(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every word of a text, given as bytes."""
    edge = np.ones(len(text) + 2, bool)
    edge[1:-1] = _SPACE[text]
    turns = np.flatnonzero(edge[1:] != edge[:-1])
    return turns[::2], turns[1::2]


def word_codes(text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of every word, by running sums of bytes times
    powers, chunk by chunk."""
    codes = np.zeros(len(begin), _U), np.zeros(len(begin), _U)
    at = 0
    while at < len(begin):
        base = begin[at]
        stop = int(np.searchsorted(end, base + CHUNK, "right"))
        if stop == at:  # one word beyond a chunk
            word = text[base:end[at]].tobytes()
            for k in (0, 1):
                codes[k][at] = xxhash.xxh3_64_intdigest(word, seed=k + 1)
            at += 1
            continue
        part = text[base:end[stop - 1]].astype(_U) + _U(1)
        b, e = begin[at:stop] - base, end[at:stop] - base
        for k, (power, back) in enumerate(_powers()):
            sums = np.zeros(len(part) + 1, _U)
            np.cumsum(part * power[:len(part)], out=sums[1:])
            codes[k][at:stop] = (sums[e] - sums[b]) * back[b]
        at = stop
    length = (end - begin).astype(_U)
    return mixed(codes[0] + length), mixed(codes[1] ^ (length * _BASES[0]))


def rolled(words: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """The polynomial of every run of ``size`` words, by doubling."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, _U)
    out, done = np.zeros(n, _U), 0
    part, length = words, 1  # runs of ``length`` words
    while True:
        weight = _U(pow(int(base), length, 1 << 64))
        if size & length:
            out = out * weight + part[done:done + n]
            done += length
        if done == size:
            return out
        part = part[:-length] * weight + part[length:]
        length *= 2


def window_hashes(codes: tuple[np.ndarray, np.ndarray], size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for every run of ``size`` words."""
    return tuple(mixed(rolled(c, size, b)) for c, b in zip(codes, _BASES))


def minimisers(words: np.ndarray, size: int = WINDOW, run: int = MINIMISER_WORDS) -> np.ndarray:
    """The least hash of the ``run``-word runs of every window of ``size`` words."""
    width = size - run + 1
    if len(words) < size:
        return np.zeros(0, _U)
    least, have = mixed(rolled(words, run, _BASES[1])), 1
    while have < width:  # minima over doubled lengths, the last one overlapping
        step = min(have, width - have)
        least = np.minimum(least[:-step], least[step:])
        have += step
    return least


def repeated(high: np.ndarray, low: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which windows repeat one that starts earlier; rows come by (id, start)."""
    out = np.zeros(len(high), bool)
    values = np.sort(high)
    twice = values[1:][values[1:] == values[:-1]]
    if not len(twice):
        return out
    marked = np.zeros(1 << 22, bool)
    marked[twice >> _U(42)] = True
    some = np.flatnonzero(marked[high >> _U(42)])  # all that can repeat, and few others
    h, lo = high[some], low[some]
    order = np.lexsort((lo, h))  # stable: equal windows stay by (id, start)
    h, lo, at = h[order], lo[order], some[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (lo[1:] != lo[:-1])])
    first = at[np.flatnonzero(new)[np.cumsum(new) - 1]]
    out[at] = (ids[at] != ids[first]) | (starts[at] != starts[first])
    return out


def _runs(cut: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last position of each run; ``cut`` marks the first ones."""
    at = np.flatnonzero(cut)
    return at, np.concatenate([at[1:], [len(cut)]]) - 1


def _limited(cut: np.ndarray, most: int) -> np.ndarray:
    """More cuts, so that no run is longer than ``most``."""
    at, last = _runs(cut)
    inside = np.arange(len(cut)) - np.repeat(at, last - at + 1)
    return cut | (inside % most == 0)


def _ranked(ids: list) -> np.ndarray:
    """Ids as numbers in their order, NULL first."""
    known = sorted({i for i in ids if i is not None})
    rank = {None: -1} | {v: n for n, v in enumerate(known)}
    return np.fromiter((rank[i] for i in ids), np.int64, len(ids))


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For pieces of so many words: the piece of every window, its place in the
    piece, and its first word among all words."""
    counts = np.maximum(sizes - WINDOW + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), counts)
    inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    return owner, inside, (np.cumsum(sizes) - sizes)[owner] + inside


def _again(high, low, rank, start) -> np.ndarray:
    """``repeated`` for windows in any order."""
    if np.all((rank[1:] > rank[:-1]) | ((rank[1:] == rank[:-1]) & (start[1:] >= start[:-1]))):
        return repeated(high, low, rank, start)
    order = np.lexsort((start, rank))
    out = np.zeros(len(order), bool)
    out[order] = repeated(high[order], low[order], rank[order], start[order])
    return out


def _docs(rows: list, who: np.ndarray) -> tuple[dict, np.ndarray]:
    docs, owner = np.unique(who, return_inverse=True)
    return {"doc_ids": [rows[i][0] for i in docs], "digests": [rows[i][1] for i in docs]}, owner


def _pack(rows: list, lanes: int, passes: int, count: bool) -> Iterator[pa.RecordBatch]:
    """Strings by lane, and settled stretches, of one run of texts; or only how
    many strings each lane's buckets have."""
    rows = [r for r in rows if r[2]]
    rank = _ranked([r[0] for r in rows])
    order = np.argsort(rank, kind="stable")
    rows, rank = [rows[i] for i in order], rank[order]
    joined = b"\n".join(r[2] for r in rows)
    text = np.frombuffer(joined, np.uint8)
    begin, end = word_spans(text)
    ends = np.cumsum([len(r[2]) + 1 for r in rows]) if rows else np.zeros(0, np.int64)
    sizes = np.diff(np.searchsorted(begin, ends), prepend=0)
    owner, inside, at = _windows(sizes)
    if not len(owner):
        return
    codes = word_codes(text, begin, end)
    high, low = (h[at] for h in window_hashes(codes))
    settled = _again(high, low, rank[owner], inside)
    least = minimisers(codes[0])[at]
    del codes, high, low  # the largest arrays
    cut = np.ones(len(at), bool)
    cut[1:] = ((owner[1:] != owner[:-1]) | (settled[1:] != settled[:-1])
               | (~settled[1:] & (least[1:] != least[:-1])))
    first, last = _runs(_limited(cut, STRING_WINDOWS))
    who, start, words = owner[first], inside[first], last - first + WINDOW
    done = settled[first]
    buckets = passes * PASS_BUCKETS  # of a lane
    bucket = least[first].view(np.int64) % (lanes * buckets)
    lane, bucket = np.where(done, -1, bucket // buckets), bucket % buckets
    if count:
        numbers, which = np.unique(lane[~done], return_inverse=True)
        counts = np.zeros((len(numbers), buckets), np.int64)
        np.add.at(counts, (which, bucket[~done]), 1)
        yield pa.RecordBatch.from_pylist([{"lane": n, "counts": c} for n, c in zip(numbers, counts)], _ARROW_COUNTS)
        return
    by = np.lexsort((bucket % passes, lane))
    b, e = begin[at[first]][by].tolist(), end[at[last] + WINDOW - 1][by].tolist()
    zstd = zstandard.ZstdCompressor(3)
    bounds = np.append(np.flatnonzero(np.diff(lane[by], prepend=-2)), len(by)).tolist()
    out = []
    for i, j in zip(bounds, bounds[1:]):
        k, number = by[i:j], int(lane[by[i]])
        row, which = _docs(rows, who[k])
        if number < 0:
            row |= {"lane": int(start[k].sum()) % lanes, "owner": which, "start": start[k], "words": words[k]}
        else:
            values = (np.diff(which, prepend=0), start[k], words[k], bucket[k])
            packed = [v.astype(kind).tobytes() for v, (_, kind) in zip(values, _FIELDS)]
            sizes = np.bincount(bucket[k] % passes, minlength=passes)
            ends = (i + np.cumsum(sizes)).tolist()
            texts = [b" ".join([joined[x:y] for x, y in zip(b[f:t], e[f:t])]) for f, t in zip([i, *ends], ends)]
            row |= {"lane": number, "packed": zstd.compress(b"".join(packed + texts)),
                    "sizes": sizes, "bytes": [len(t) for t in texts]}
        out.append(row)
        if len(out) == 256:
            yield pa.RecordBatch.from_pylist(out, _ARROW_STRINGS)
            out = []
    yield pa.RecordBatch.from_pylist(out, _ARROW_STRINGS)


def _strings(lanes: int, passes: int, count: bool = False):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns):
                held.append(tuple(cell.as_py() for cell in row))
                size += len(held[-1][2])
                if size >= GROUP_BYTES:
                    yield from _pack(held, lanes, passes, count)
                    held, size = [], 0
        yield from _pack(held, lanes, passes, count)
    return run


class _Row:
    """A row of strings, compressed; ``part`` unpacks those of one pass."""

    def __init__(self, cell: dict):
        self.lane, self.doc_ids, self.digests = cell["lane"].as_py(), cell["doc_ids"].values, cell["digests"].values
        self.packed, self.settled = cell["packed"].as_py(), None
        self.hot = cell["hot"].values.to_numpy() if cell["hot"].is_valid else []
        if self.packed is None:
            self.settled = [cell[k].values.to_numpy().astype(np.int64) for k in ("owner", "start", "words")]
        else:
            self.sizes, self.bytes = (cell[k].values.to_numpy().astype(np.int64) for k in ("sizes", "bytes"))

    @staticmethod
    def of(batch: pa.RecordBatch) -> Iterator[_Row]:
        for n in range(batch.num_rows):
            yield _Row({name: batch.column(name)[n] for name in batch.schema.names})

    def part(self, number: int) -> dict:
        data = zstandard.ZstdDecompressor().decompress(self.packed)
        first, last = self.sizes[:number].sum(), self.sizes[:number + 1].sum()
        out, at, every = {}, 0, int(self.sizes.sum())
        for name, kind in _FIELDS:
            column = np.frombuffer(data, kind, every, at)
            at += column.nbytes
            column = np.cumsum(column, dtype=np.int64) if name == "owner" else column.astype(np.int64)
            out[name] = column[first:last]
        begin = at + int(self.bytes[:number].sum())
        return out | {"text": np.frombuffer(data, np.uint8, int(self.bytes[number]), begin)}


class _Lane:
    """The strings of one pass of some rows in memory, those of hot buckets or the
    others."""

    def __init__(self, rows: list[_Row], number: int, hot: bool):
        owners, starts, texts, sizes, ids, digests, docs = [], [], [], [], [], [], 0
        for row in rows:
            part = row.part(number)
            mine = np.isin(part["bucket"], row.hot) == hot
            owners.append(part["owner"] + docs)
            starts.append(part["start"])
            sizes.append(np.where(mine, part["words"], -part["words"]))  # negative: not of this way
            texts += [part["text"], np.array([32], np.uint8)]
            ids.append(row.doc_ids)
            digests.append(row.digests)
            docs += len(row.doc_ids)
        self.ids, self.digests = pa.concat_arrays(ids), pa.concat_arrays(digests)
        text = np.concatenate(texts)
        sizes, owner, start = (np.concatenate(v) for v in (sizes, owners, starts))
        wanted = sizes > 0
        begin, end = word_spans(text)
        mine = np.repeat(wanted, np.abs(sizes))
        begin, end, sizes = begin[mine], end[mine], sizes[wanted]
        piece, inside, at = _windows(sizes)
        self.high, self.low = (h[at] for h in window_hashes(word_codes(text, begin, end)))
        self.owner, self.start = owner[wanted][piece], start[wanted][piece] + inside
        self.piece = piece

    def key(self, at: np.ndarray) -> list[pa.Array]:
        who = pa.array(self.owner[at])
        return [self.ids.take(who), self.digests.take(who)]

    def repeats(self) -> pa.RecordBatch:
        again = _again(self.high, self.low, _ranked(self.ids.to_pylist())[self.owner], self.start)
        cut = np.ones(len(again), bool)
        cut[1:] = (self.piece[1:] != self.piece[:-1]) | (again[1:] != again[:-1])
        a, b = _runs(cut)
        a, b = a[again[a]], b[again[a]]
        return pa.record_batch([*self.key(a), pa.array(self.start[a]), pa.array(self.start[b] + WINDOW)],
                               names=["doc_id", "digest", "start", "stop"])

    def windows(self) -> pa.RecordBatch:
        every = np.arange(len(self.high))
        return pa.record_batch([*self.key(every), pa.array(self.start), pa.array(self.high.view(np.int64)),
                                pa.array(self.low.view(np.int64))],
                               names=["doc_id", "digest", "start", "high", "low"])


def _by_lane(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by lane; one lane is held at a time."""
    held: list[_Row] = []
    for batch in batches:
        for row in _Row.of(batch):
            if row.settled is not None:
                owner, start, words = row.settled
                yield pa.record_batch([row.doc_ids.take(pa.array(owner)), row.digests.take(pa.array(owner)),
                                       pa.array(start), pa.array(start + words)],
                                      names=["doc_id", "digest", "start", "stop"])
                continue
            if held and held[0].lane != row.lane:
                yield from _swept(held)
                held = []
            held.append(row)
    yield from _swept(held)


def _swept(rows: list[_Row]) -> Iterator[pa.RecordBatch]:
    """A lane, pass by pass."""
    for number in range(len(rows[0].sizes) if rows else 0):
        yield _Lane(rows, number, hot=False).repeats()


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hot buckets, one row for each window."""
    for batch in batches:
        for row in _Row.of(batch):
            for number in range(len(row.sizes)):
                yield _Lane([row], number, hot=True).windows()


def _keyed(docs: DataFrame) -> DataFrame:
    """Id, the digest that tells versions of an id apart, and text as bytes."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("digest"),
                       text.alias("text"))


def removed_stretches(docs: DataFrame) -> DataFrame:
    """Stretches ``[start, stop)`` of words that repeating windows cover, by
    document; stretches may touch or overlap."""
    keyed, spark = _keyed(docs), docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # at least a few lanes for each slot, if there are as many passes
    lanes = max(size // LANE_BYTES, min(size // PASS_BYTES, 8 * parallelism(spark))) + 1
    passes = min(size // lanes // PASS_BYTES + 1, LANE_BYTES // PASS_BYTES)
    counted = (keyed.mapInArrow(_strings(lanes, passes, count=True), COUNTS)
               .select("lane", F.posexplode("counts").alias("bucket", "n")).groupBy("lane", "bucket")
               .agg(F.sum("n").alias("n")).where(F.col("n") > HOT_STRINGS))
    hot = stage(counted.groupBy("lane").agg(F.collect_list("bucket").alias("hot")),
                "dedup-hot")  # at most a lane's buckets
    strings = keyed.mapInArrow(_strings(lanes, passes), STRINGS).join(small_side(hot), "lane", "left")
    plain = (strings.repartition(max(min(lanes, MOST_TASKS), parallelism(spark)), "lane")
             .sortWithinPartitions("lane").mapInArrow(_by_lane, STRETCHES))
    if hot.isEmpty():
        return plain
    windows = stage(strings.where(F.col("hot").isNotNull() & F.col("packed").isNotNull())
                    .mapInArrow(_unpacked, WINDOWS), "dedup-windows")
    firsts = windows.groupBy("high", "low").agg(F.min(F.struct("doc_id", "start")).alias("first"))
    again = (windows.join(firsts, ["high", "low"])
             .where(~(F.col("first.doc_id").eqNullSafe(F.col("doc_id"))
                      & (F.col("first.start") == F.col("start"))))
             .select("doc_id", "digest", "start", (F.col("start") + WINDOW).alias("stop")))
    return plain.unionByName(again)


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = [[], [], [], []]
        for i, text in enumerate(batch.column(1)):
            words = text.as_py().split()  # bytes split at 0x09-0x0D and space only
            gone = np.zeros(len(words) + 1, np.int64)
            stretches = batch.column(2)[i]
            if stretches.is_valid:
                begin, end = (stretches.values.field(k).to_numpy() for k in (0, 1))
                np.add.at(gone, begin, 1)
                np.add.at(gone, end, -1)
            stay = np.cumsum(gone)[:-1] == 0
            left = words if stay.all() else [w for w, s in zip(words, stay.tolist()) if s]
            for column, value in zip(out, (batch.column(0)[i].as_py(), len(words), len(words) - len(left),
                                           b" ".join(left).decode("utf-8"))):
                column.append(value)
        yield pa.record_batch([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                               pa.array(out[2], pa.int64()), pa.array(out[3], pa.string())],
                              names=["doc_id", "n_words", "n_removed", "kept"])


def dedup(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id, n_words, n_removed and ``kept``, the
    words that stay joined by one space."""
    gone = (removed_stretches(docs).groupBy("doc_id", "digest")
            .agg(F.collect_list(F.struct("start", "stop")).alias("gone"))
            .select(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "gone"))
    return (_keyed(docs).join(gone.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id"))
                              & (F.col("digest") == F.col("_digest")), "left")
            .select("doc_id", "text", "gone")
            .mapInArrow(_kept, "doc_id long, n_words long, n_removed long, kept string"))


def digest(kept: DataFrame) -> DataFrame:
    """``dedup``'s rows with the kept words as their SHA-256."""
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


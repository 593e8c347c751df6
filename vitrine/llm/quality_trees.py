"""Quality classifier: histogram gradient-boosted trees over document statistics.

``features`` turns every whole text into a fixed vector of statistics of
its characters, words and lines. ``fit`` grows trees of fixed depth on binned
features (one gradient histogram for each node and feature), on a bounded
sample: the ``SAMPLE_ROWS`` labelled documents with the smallest hash of their
id. The trees are flattened into arrays in heap order, so scoring a batch walks
all rows of all trees down one level at a time in numpy. The model's size is
fixed by its parameters; it travels to the tasks inside the function.

Labels, language, source and id never enter the vector.

Defined cases: NULL is the empty text, which has a vector like any other;
documents without label are scored, not learned from; repeated labels of one
id count by their mean; without labels of both kinds every score is the share
of ones (0.5 without labels); NULL ids and repeated rows are kept; an empty
table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SAMPLE_ROWS = 20_000
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 80, 4, 64, 0.15, 1.0, 10
ACCEPT = 0.7

FEATURES = ["bytes", "words", "lines", "mean_word", "long_words", "letters", "upper", "digits",
            "spaces", "symbols", "stops", "marks", "non_ascii", "distinct_words", "top_word",
            "repeated_windows", "distinct_lines", "mean_line", "unended_lines", "symbol_words",
            "short_words", "entropy"]

_CLASSES = {
    "letters": b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digits": b"0123456789", "spaces": b" \t\n\x0b\x0c\r",
    "symbols": b"#*$%&|<>", "stops": b".?!", "marks": b",;:'\"()-",
}
_MASK = np.zeros((len(_CLASSES) + 1, 256))
for _row, _chars in enumerate(_CLASSES.values()):
    _MASK[_row, list(_chars)] = 1
_MASK[-1, 128:] = 1


def vector(text: str | None) -> list[float]:
    """The statistics of one text, in the order of ``FEATURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = (_MASK @ counts) / n
    present = counts[counts > 0] / n
    w = raw.split()
    m = max(len(w), 1)
    sizes = np.fromiter(map(len, w), np.int64, len(w))
    tally = Counter(w)
    windows = max(len(w) - 2, 0)
    lines = [x.strip() for x in raw.split(b"\n")]
    lines = [x for x in lines if x]
    k = max(len(lines), 1)
    symbol_words = sum(c for x, c in tally.items() if x[-1] in b"#*$%&|<>!")
    return [
        math.log1p(len(raw)), math.log1p(len(w)), math.log1p(len(lines)),
        sizes.sum() / m, (sizes > 12).sum() / m, share[0], share[1], share[2], share[3], share[4],
        share[5], share[6], share[7], len(tally) / m, max(tally.values(), default=0) / m,
        1 - len(set(zip(w, w[1:], w[2:]))) / windows if windows else 0.0,
        len(set(lines)) / k, math.log1p(n / k),
        sum(x[-1] not in b".?!:;\"')" for x in lines) / k, symbol_words / m,
        (sizes <= 2).sum() / m, float(-(present * np.log2(present)).sum()),
    ]


@dataclass
class Trees:
    """Complete trees in heap order: inner nodes of all trees, then their leaves."""
    feature: np.ndarray    # (trees, 2^depth - 1) int
    threshold: np.ndarray  # (trees, 2^depth - 1)
    leaf: np.ndarray       # (trees, 2^depth)
    start: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        total = np.full(len(x), self.start)
        inner = self.feature.shape[1] if self.feature.size else 0
        depth = (inner + 1).bit_length() - 1
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf):
            at = np.zeros(len(x), np.int64)
            for _ in range(depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            total += leaf[at - inner]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS,
        rate: float = RATE) -> Trees:
    """Boost ``trees`` trees for the logistic loss; splits lie between bins."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    start = math.log(share / (1 - share))
    inner = 2 ** depth - 1
    none = np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1))
    if not len(y) or y.min() == y.max():
        return Trees(*none, start)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    n, d = x.shape
    flat = binned + bins * np.arange(d)
    total = np.full(n, start)
    out: list[list] = [[], [], []]
    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        grad, hess = y - p, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            for at in range(2 ** level - 1, 2 ** (level + 1) - 1):
                mine = np.flatnonzero(node == at)
                best = _best_split(flat[mine], grad[mine], hess[mine], d, bins, edges)
                if best is not None:
                    feature[at], cut = best
                    threshold[at] = edges[feature[at]][cut]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        g = np.bincount(node - inner, grad, inner + 1)
        h = np.bincount(node - inner, hess, inner + 1)
        leaf = rate * g / (h + L2)
        total += leaf[node - inner]
        for k, part in enumerate((feature, threshold, leaf)):
            out[k].append(part)
    return Trees(*map(np.stack, out), start)


def _best_split(flat, grad, hess, d, bins, edges):
    if len(flat) < 2 * MIN_ROWS:
        return None
    hist = lambda v: np.bincount(flat.ravel(), np.repeat(v, d), d * bins).reshape(d, bins).cumsum(1)
    g, h, c = hist(grad), hist(hess), hist(np.ones(len(grad)))
    gt, ht, ct = g[:, -1:], h[:, -1:], c[:, -1:]
    gain = g ** 2 / (h + L2) + (gt - g) ** 2 / (ht - h + L2) - gt ** 2 / (ht + L2)
    allowed = (c >= MIN_ROWS) & (ct - c >= MIN_ROWS)
    allowed &= np.arange(bins) < np.array([len(e) for e in edges])[:, None]
    gain = np.where(allowed, gain, 0)
    f, cut = np.unravel_index(gain.argmax(), gain.shape)
    return (f, cut) if gain[f, cut] > 1e-9 else None


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The bounded sample (text, y)."""
    sample = (labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()
                           & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.avg("quality").alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    return docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "y")


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())),
                           T.StructField("y", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([
                pa.array([[float(v) for v in vector(t.as_py())] for t in b.column(0)],
                         type=pa.list_(pa.float64())), b.column(1)], names=["x", "y"])

    found = training_rows(docs, labels, rows).mapInArrow(run, schema).collect()
    x = np.array([r.x for r in found]).reshape(-1, len(FEATURES))
    y = np.array([float(r.y >= 0.5) for r in found])
    order = np.lexsort((*x.T, y))  # the rows' arrival order must not matter
    return fit(x[order], y[order])


def score(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, score, predicted) of every row."""
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType),
                           T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([vector(t.as_py()) for t in b.column(1)])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(model.scores(x))],
                                                 names=[id_col, "score"])

    scored = docs.select(id_col, text_col).mapInArrow(run, schema)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "score",
                         (F.col("score") >= ACCEPT).cast("int").alias("predicted"))

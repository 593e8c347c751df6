"""Hierarchical multi-length packing.

Documents are cut into windows of the longest tier; the rest of each document
is routed to the shortest context tier that holds it. Tiers are packed from
the longest down: a window starts with one piece of its own tier, and the gap
is filled with the largest fitting pieces of the shorter tiers, then with a
part cut off another piece, whose remainder is routed again. A window is
therefore full unless its partition has run out of tokens; what is left at the
end goes into ever shorter full tiers, and only a tail shorter than the
shortest tier is padded (one window for each partition).

Every input partition packs its own documents as a stream, so there is no
shuffle, memory is bounded by the buffer and the longest document, and a lost
task repeats exactly. Windows of one tier form step groups of equal token
count, so every training step has one shape and the same number of tokens.

Defined cases: NULL or empty text is the end id alone; NULL ids and repeated
rows are kept and packed like any other row; an empty table gives no rows;
extra columns are not read.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.tokens import DOCUMENT_END, encoder

TIERS = (256, 512, 1024, 2048)
STEP_TOKENS = 16 * 2048
BUFFER_TOKENS = 1 << 20
OUTPUT_BYTES = 4 << 20

PIECE_FIELDS = [("start", T.LongType()), ("length", T.LongType()), ("ids", T.BinaryType()),
                ("doc_tokens", T.LongType()), ("sequence_id", T.LongType()),
                ("offset", T.LongType()), ("tier", T.IntegerType()),
                ("sequence_tokens", T.IntegerType()), ("step_group", T.LongType())]


class Packer:
    """Packs pieces ``(doc_id, start, ids, doc_tokens)`` of one partition."""

    def __init__(self, tiers, step_tokens: int, partition: int):
        self.tiers = sorted(tiers)
        self.longest = self.tiers[-1]
        self.step_tokens = step_tokens
        self.base = partition << 40
        self.sequences = 0
        self.steps = 0
        self.open_steps: dict[int, tuple[int, int]] = {}
        # Pieces not yet placed: for each tier a list sorted by (length, arrival).
        self.waiting: dict[int, list[tuple]] = {t: [] for t in self.tiers}
        self.arrivals = 0
        self.held = 0
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, doc_id, ids: bytes) -> None:
        total, width, at = len(ids) // 4, self.longest, 0
        while total - at >= width:
            self._emit(width, [(doc_id, at, ids[4 * at:4 * (at + width)], total)])
            at += width
        if at < total:
            self._route((doc_id, at, ids[4 * at:], total))

    def _route(self, piece: tuple) -> None:
        n = len(piece[2]) // 4
        tier = next(t for t in self.tiers if t >= n)
        self.arrivals += 1
        insort(self.waiting[tier], (n, self.arrivals, piece))
        self.held += n

    def _take(self, tier: int, at: int) -> tuple:
        n, _, piece = self.waiting[tier].pop(at)
        self.held -= n
        return piece

    def _largest_fitting(self, gap: int):
        for tier in reversed(self.tiers):
            found = bisect_right(self.waiting[tier], (gap, float("inf")))
            if found:
                return self._take(tier, found - 1)
        return None

    def _shortest_longer(self, gap: int):
        for tier in self.tiers:
            found = bisect_right(self.waiting[tier], (gap, float("inf")))
            if found < len(self.waiting[tier]):
                return self._take(tier, found)
        return None

    def _fill(self, width: int, first: tuple) -> None:
        pieces, gap = [first], width - len(first[2]) // 4
        while gap:
            piece = self._largest_fitting(gap)
            if piece is None:
                piece = self._shortest_longer(gap)
                if piece is None:
                    break
                doc_id, start, ids, total = piece
                self._route((doc_id, start + gap, ids[4 * gap:], total))
                piece = (doc_id, start, ids[:4 * gap], total)
            pieces.append(piece)
            gap -= len(piece[2]) // 4
        self._emit(width, pieces)

    def pack(self, last: bool) -> None:
        """Fill windows, longest tier first, while the waiting tokens suffice
        to fill one; at the end also the tail."""
        for width in reversed(self.tiers):
            own = self.waiting[width]
            while own and self.held >= width:
                self._fill(width, self._take(width, len(own) - 1))
        if not last:
            return
        for width in reversed(self.tiers):
            while self.held >= width:
                first = self._largest_fitting(width)
                if first is None:
                    first = self._cut(width)
                self._fill(width, first)
        if self.held:
            self._fill(self.tiers[0], self._largest_fitting(self.tiers[0]))

    def _cut(self, width: int) -> tuple:
        doc_id, start, ids, total = self._shortest_longer(width)
        self._route((doc_id, start + width, ids[4 * width:], total))
        return doc_id, start, ids[:4 * width], total

    def _emit(self, width: int, pieces: list[tuple]) -> None:
        used = sum(len(p[2]) for p in pieces) // 4
        step, filled = self.open_steps.get(width, (None, self.step_tokens))
        if filled + width > self.step_tokens:
            step, filled = self.base + self.steps, 0
            self.steps += 1
        self.open_steps[width] = (step, filled + width)
        sequence, offset = self.base + self.sequences, 0
        self.sequences += 1
        for doc_id, start, ids, total in pieces:
            n = len(ids) // 4
            self.rows.append((doc_id, start, n, ids, total, sequence, offset, width, used, step))
            self.bytes += len(ids)
            offset += n


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         tiers=TIERS, step_tokens: int = STEP_TOKENS) -> DataFrame:
    """One row per placed piece: the document's id, ``start`` and ``length`` of
    the piece in its ids, the ids (little-endian unsigned 32 bit), ``sequence_id``
    and ``offset`` there, the window's tier and used tokens, its step group."""
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([T.StructField(id_col, id_type)]
                          + [T.StructField(n, t) for n, t in PIECE_FIELDS])
    tiers = tuple(tiers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        encode = encoder(tokenizer_path).encode
        end = DOCUMENT_END.to_bytes(4, "little")
        packer = Packer(tiers, step_tokens, TaskContext.get().partitionId())
        arrow = to_arrow_schema(schema)

        def out():
            columns = list(zip(*packer.rows))
            packer.rows, packer.bytes = [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns, arrow)], schema=arrow)

        buffered = 0
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for i in range(batch.num_rows):
                encoded = encode(texts[i].as_py()) + end
                packer.add(ids[i].as_py(), encoded)
                buffered += len(encoded) // 4
                if buffered >= BUFFER_TOKENS:
                    packer.pack(last=False)
                    buffered = 0
                if packer.bytes >= OUTPUT_BYTES:
                    yield out()
        packer.pack(last=True)
        if packer.rows:
            yield out()

    return docs.select(F.col(id_col), F.col(text_col)).mapInArrow(run, schema)

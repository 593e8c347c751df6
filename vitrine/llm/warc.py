"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member for each record into WARC files below
a shared folder. Of records with equal payloads (of at least ``min_bytes``) the
one with the smallest id is a response, the others are revisit records that
name it and hold no payload.

``write_index`` sorts the captures by reversed-host URL key and id, writes them
in compressed blocks and keeps a sparse directory, one row for each block.
``lookup`` binary-searches the directory for the block, reads the block's byte
range and binary-searches its lines. ``read_records`` then reads the records'
byte ranges in file order and parses them.

Files are written and read through ``pyarrow.fs`` by the shared folder's URI,
never on a task's own disk. A task names its files by its attempt, so a
repeated task can't change files that others already point to. Only ids and
digests are shuffled to find equal payloads; the payloads move only where the
table of repeated digests is too large to broadcast.

Defined cases: NULL html is an empty payload, NULL urls are empty; NULL ids come
after all others (a group without any id is all responses); rows repeated with
the smallest id are all responses; an empty table gives no rows; extra columns
are not read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import small_side, stage
from vitrine.session import parallelism

FILE_BYTES = 64 << 20
BLOCK_LINES = 256
COALESCE_BYTES = 1 << 20
READ_BYTES = 32 << 20  # for each task that reads records
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURES = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType())])
DIRECTORY = T.StructType([
    T.StructField("first_key", T.StringType()), T.StructField("first_id", T.LongType()),
    T.StructField("last_key", T.StringType()), T.StructField("last_id", T.LongType()),
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()),
    T.StructField("length", T.LongType()), T.StructField("lines", T.LongType())])
RECORDS = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.LongType()),
    T.StructField("payload", T.BinaryType())])


def url_key(url: Column) -> Column:
    """Reversed host, then path and query: ``http://b.a.org/x?y#z`` -> ``org,a,b)/x?y``."""
    url = F.coalesce(url, F.lit(""))
    scheme = "^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//"
    host = F.lower(F.regexp_extract(url, scheme + "(?:[^/?#@]*@)?([^/?#:]*)", 1))
    path = F.regexp_extract(F.regexp_replace(url, scheme + "[^/?#]*", ""), "^([^#]*)", 1)
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), ","), F.lit(")"), path)


def _filesystem(uri: str):
    from pyarrow import fs
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def _record(kind: str, page_id, url: str, digest: bytes, size: int, payload: bytes, first) -> bytes:
    clean = "".join(c if c >= " " and c != "\x7f" else f"%{ord(c):02X}" for c in url)
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http + payload
    name = "" if page_id is None else str(page_id)
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}>",
             f"WARC-Date: {DATE}", f"WARC-Target-URI: {clean}",
             f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}"]
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _gzip(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _attempt() -> str:
    from pyspark import TaskContext
    return f"{TaskContext.get().partitionId():06d}-{TaskContext.get().taskAttemptId()}"


def _arrow(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, arrow)],
                                      schema=arrow)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", min_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the records; the captures (``CAPTURES``) say where each one lies."""
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    base = pages.select(F.col(id_col).cast("long").alias("id"), url_key(F.col(url_col)).alias("url_key"),
                        F.coalesce(F.col(url_col), F.lit("")).alias("url"), payload.alias("payload"))
    base = base.withColumn("digest", F.sha1("payload"))
    repeated = stage(base.where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "digests")
    base = base.join(small_side(repeated), "digest", "left").select(
        "id", "url_key", "url", "payload", "digest", "first")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        out, name, files, offset = None, "", 0, 0
        try:
            for batch in batches:
                rows = []
                for row in zip(*(batch.column(i) for i in range(6))):
                    page_id, key, url, body, digest, first = (v.as_py() for v in row)
                    revisit = first is not None and page_id != first
                    record = _gzip(_record("revisit" if revisit else "response", page_id, url,
                                           bytes.fromhex(digest), len(body),
                                           b"" if revisit else body, first))
                    if out is None or offset + len(record) > file_bytes:
                        if out is not None:
                            out.close()
                        name, offset = f"pages-{_attempt()}-{files:04d}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                        files += 1
                    out.write(record)
                    rows.append((key, page_id, name, offset, len(record)))
                    offset += len(record)
                yield _arrow(rows, CAPTURES)
        finally:
            if out is not None:
                out.close()

    _make_folder(folder)
    return stage(base.mapInArrow(run, CAPTURES), "captures")


def _make_folder(folder: str) -> None:
    fs, root = _filesystem(folder)
    fs.create_dir(root, recursive=True)


def _rank(key: str, page_id) -> tuple:
    """Order of a capture; NULL ids come first, as in Spark's ascending sort.
    Bytes compare as Spark compares strings."""
    return key.encode("utf-8", "surrogatepass"), page_id is not None, page_id or 0


def write_index(captures: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the sorted, compressed blocks, and the directory (``DIRECTORY``), one
    row for each block, as a table below the folder, in key order by its files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        held: list[tuple] = []
        name, offset, out = f"index-{_attempt()}.blocks", 0, None

        def block(rows):
            nonlocal offset, out
            data = zlib.compress("\n".join(json.dumps(r) for r in rows).encode())
            if out is None:
                out = fs.open_output_stream(f"{root}/{name}", compression=None)
            out.write(data)
            offset += len(data)
            return (rows[0][0], rows[0][1], rows[-1][0], rows[-1][1], name, offset - len(data),
                    len(data), len(rows))

        try:
            for batch in batches:
                held += zip(*(c.to_pylist() for c in batch.columns))
                full = len(held) // block_lines * block_lines
                yield _arrow([block(held[i:i + block_lines]) for i in range(0, full, block_lines)], DIRECTORY)
                held = held[full:]
            if held:
                yield _arrow([block(held)], DIRECTORY)
        finally:
            if out is not None:
                out.close()

    _make_folder(folder)
    ordered = captures.repartitionByRange("url_key", "id").sortWithinPartitions("url_key", "id")
    path = f"{folder}/directory"
    ordered.mapInArrow(run, DIRECTORY).write.parquet(path)
    return captures.sparkSession.read.schema(DIRECTORY).parquet(path)


class _Index:
    """A task's view: directory rows of a key range, and the block last read."""

    def __init__(self, folder: str):
        self.fs, self.root = _filesystem(folder)
        self.blocks: list[tuple] = []
        self.last: tuple = (None, [], [])

    def load(self, low: str, high: str) -> None:
        import pyarrow.dataset as ds
        data = ds.dataset(f"{self.root}/directory", format="parquet", filesystem=self.fs)
        rows = data.to_table(filter=(ds.field("last_key") >= low) & (ds.field("first_key") <= high))
        self.blocks = sorted(zip(*(c.to_pylist() for c in rows.columns)),
                             key=lambda r: _rank(r[0], r[1]))
        self.ends = [_rank(r[2], r[3]) for r in self.blocks]

    def _lines(self, block: tuple) -> tuple[list, list]:
        if self.last[0] != block[4:6]:
            with self.fs.open_input_file(f"{self.root}/{block[4]}") as f:
                data = zlib.decompress(f.read_at(block[6], block[5]))
            rows = [json.loads(x) for x in data.split(b"\n")]
            self.last = (block[4:6], rows, [_rank(r[0], r[1]) for r in rows])
        return self.last[1:]

    def find(self, low: tuple, high: tuple) -> Iterator[tuple]:
        """Captures whose rank lies between ``low`` and ``high``, both included."""
        at = bisect_left(self.ends, low)
        while at < len(self.blocks) and _rank(*self.blocks[at][:2]) <= high:
            rows, ranks = self._lines(self.blocks[at])
            yield from rows[bisect_left(ranks, low):bisect_right(ranks, high)]
            at += 1


def lookup(queries: DataFrame, folder: str) -> DataFrame:
    """Captures (``CAPTURES``) of the queries (url_key, id); an id of NULL in
    column ``id`` asks for the capture without id, a frame without that column
    for all captures of the key. Queries are sorted like the index, so a task
    reads neighbouring blocks."""
    exact = "id" in queries.columns
    keys = ["url_key", "id"] if exact else ["url_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _Index(folder)
        for batch in batches:
            if not batch.num_rows:
                continue
            wanted = list(zip(*(c.to_pylist() for c in batch.columns)))
            ordered = sorted(w[0].encode("utf-8", "surrogatepass") for w in wanted)
            index.load(ordered[0].decode("utf-8", "surrogatepass"), ordered[-1].decode("utf-8", "surrogatepass"))
            rows = []
            for w in wanted:
                low = _rank(*w) if exact else _rank(w[0], None)
                high = low if exact else (low[0], True, 1 << 63)
                rows += index.find(low, high)
            yield _arrow(rows, CAPTURES)

    # keys are small, but each costs a search: a stated count, which is not cut down by size
    tasks = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = queries.select(*keys).repartitionByRange(tasks, *keys).sortWithinPartitions(*keys)
    return ordered.mapInArrow(run, CAPTURES)


def parse_record(data: bytes) -> tuple:
    """A row of ``RECORDS`` from one gzip member; a response's payload must have
    its digest."""
    raw = zlib.decompress(data, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:] if ": " in x)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    kind = fields["WARC-Type"]
    if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda x: int(x[len("<urn:page:"):-1]) if x and x != "<urn:page:>" else None
    return (number(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI", ""), size, digest, kind,
            number(fields.get("WARC-Refers-To")), payload if kind == "response" else None)


def read_records(captures: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records (``RECORDS``) at the captures' byte ranges, read in file order;
    near ranges are read at once. Captures are small but stand for the bytes they
    point at, so those decide how many tasks share the reading."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(folder)
        for batch in batches:
            rows, spots = [], list(zip(*(c.to_pylist() for c in batch.columns)))
            at = 0
            while at < len(spots):
                name, start, length = spots[at]
                end, upto = start + length, at + 1
                while upto < len(spots) and spots[upto][0] == name and (
                        start <= spots[upto][1] <= end + 4096 and end - start < COALESCE_BYTES):
                    end = max(end, spots[upto][1] + spots[upto][2])
                    upto += 1
                with fs.open_input_file(f"{root}/{name}") as f:
                    data = f.read_at(end - start, start)
                for _, o, n in spots[at:upto]:
                    record = parse_record(data[o - start:o - start + n])
                    rows.append(record if payloads else (*record[:-1], None))
                at = upto
                if len(rows) >= 256:
                    yield _arrow(rows, RECORDS)
                    rows = []
            yield _arrow(rows, RECORDS)

    spots = stage(captures.select("file", "offset", "length"), "warc-captures")
    size = spots.agg(F.sum("length")).first()[0] or 0
    tasks = max(size // READ_BYTES + 1, parallelism(captures.sparkSession))
    ordered = spots.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(run, RECORDS)

"""Structured Streaming jobs.

* ``route_stream``: chat updates arrive as JSON files. Each micro-batch is
  routed, answered and replied to from the base version that is current when it
  starts; the version is recorded with its replies.
* ``refresh_stream``: each new base-file drop is a full replacement of the
  base: the newest complete drop is published as the version of its number,
  with its recomputed profile (last date, first date, rows).
* ``dedup_stream``: replay-safe dedup of any events.

Replays. Ids seen live in a keyed RocksDB state store (``dropDuplicates`` without
a watermark), so a batch looks up its own ids only, whatever came before, and a
late update is kept however far it is behind. The state grows by one id a row.

Commit log. A batch writes below ``batches/<stream>/<batch>``, where the stream
is the id in its checkpoint, and becomes visible by one marker file in
``_commits``, created when all its parts are written. Readers
(``read_committed``) see marked batches only: a batch that failed half-way and is
tried again is never read twice, and a new checkpoint is a new stream, which
cannot write over an old one. Its state starts from the ids that the folder has
committed so far: they come in its first batch.

Live base. ``LiveBase`` reads the published marker at each batch and rebuilds the
router, the reference date and the answer table only when it changed. A batch
pins its version before it reads the base, so that a second try answers from the
same one.

All use ``Trigger.AvailableNow`` in tests (process what is there, stop) and
can run continuously with a processing-time trigger. Streams started before this
need a new checkpoint and output folder.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.operators.answers import answer_questions, every_reply
from vitrine.operators.gold import analytic_from_raw, dim_category
from vitrine.operators.ranges import range_index
from vitrine.operators.routing import ROUTE_COLUMNS, Router
from vitrine.operators.taxonomy import lexicon, taxonomy_flat
from vitrine.sinks import writers as Wr
from vitrine.sources.dictionary import fixed_glossary
from vitrine.sources.updates import UPDATE_SCHEMA, parse_updates

STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


def _start(spark: SparkSession, writer, state_partitions: int | None):
    """Start a stream with the state store and the number of state partitions
    that it keeps for good (both are stored in the checkpoint). The query has its
    own copy of the session settings, so the session's are restored at once."""
    conf = dict(STATE_CONF)
    if state_partitions:
        conf["spark.sql.shuffle.partitions"] = str(state_partitions)
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        return writer.start()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


# --- commit log

COMMITS, BATCHES = "_commits", "batches"


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = Wr._folder(spark, path)
    return fs.exists(p)


def committed(spark: SparkSession, out_dir: str) -> list[tuple[str, int, bool]]:
    """(stream, batch, whether it has rows) of every committed batch."""
    fs, p = Wr._folder(spark, f"{out_dir}/{COMMITS}")
    names = [x.getPath().getName() for x in fs.listStatus(p)] if fs.exists(p) else []
    found = [re.fullmatch(r"(.+)-(\d{9})\.(rows|none)", n) for n in names]
    return sorted((m[1], int(m[2]), m[3] == "rows") for m in found if m)


def _batch_path(out_dir: str, stream: str, batch_id: int) -> str:
    return f"{out_dir}/{BATCHES}/{stream}/{batch_id:09d}"


def read_committed(spark: SparkSession, out_dir: str, part: str, schema: T.StructType | None = None) -> DataFrame:
    """One part ('rows', 'routed', 'replies') of all committed batches; an empty
    table of ``schema`` before the first one."""
    paths = [f"{_batch_path(out_dir, s, b)}/{part}" for s, b, rows in committed(spark, out_dir) if rows]
    if paths:
        return spark.read.parquet(*paths)
    if schema is None:
        raise FileNotFoundError(f"no committed rows under {out_dir}")
    return spark.createDataFrame([], schema)


def _once(spark: SparkSession, rows: DataFrame, key: str, out_dir: str, checkpoint: str,
          handle: Callable[[DataFrame, str], None] | None = None, available_now: bool = True,
          state_partitions: int | None = None):
    """Run a stream whose batches hold the rows of ``rows`` with a new ``key``,
    hand them to ``handle`` (rows, batch folder), and commit each batch."""
    known_path = f"{checkpoint}/known"
    key_schema = T.StructType([rows.schema[key]])
    if not _exists(spark, f"{checkpoint}/metadata"):  # a new stream, maybe over an old folder
        read_committed(spark, out_dir, "rows", key_schema).select(key).distinct() \
            .write.mode("overwrite").parquet(known_path)
    known = spark.readStream.schema(key_schema).parquet(known_path).withColumn("_known", F.lit(True))
    fresh = (rows.withColumn("_known", F.lit(False)).unionByName(known, allowMissingColumns=True)
             .dropDuplicates([key]))
    stream: list[str] = []

    def each(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if not stream:
            stream.append(json.loads(session.read.text(f"{checkpoint}/metadata").first()[0])["id"])
        folder = _batch_path(out_dir, stream[0], batch_id)
        new = batch.where(~F.col("_known")).drop("_known")
        if batch_id == 0:  # an old id and its replay may share this batch; later the state has them
            old = session.read.schema(key_schema).parquet(known_path).select(F.col(key).alias("_old"))
            new = new.join(old, F.col(key).eqNullSafe(F.col("_old")), "left_anti")
        marker = f"{out_dir}/{COMMITS}/{stream[0]}-{batch_id:09d}"
        if any(_exists(session, f"{marker}.{kind}") for kind in ("rows", "none")):
            new.write.format("noop").mode("overwrite").save()  # only the state is still to be saved
            return
        new.write.mode("overwrite").parquet(f"{folder}/rows")  # the one run of the stateful plan
        written = session.read.schema(new.schema).parquet(f"{folder}/rows")
        some = not written.isEmpty()
        if some and handle is not None:
            handle(written, folder)
        fs, p = Wr._folder(session, f"{marker}.{'rows' if some else 'none'}")
        fs.create(p, False).close()

    writer = fresh.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    q = _start(spark, writer, state_partitions)
    if available_now:
        _run(q)
    return q


# --- the message loop


@dataclass(frozen=True)
class Base:
    """What questions are answered from, as of one version. ``flat`` is the
    taxonomy that dictionary replies list (None: no such replies), ``index`` the
    range index of the table (None: built for each batch)."""
    version: int
    table: DataFrame
    ref: date
    total_rows: int
    router: Router
    flat: DataFrame | None = None
    index: DataFrame | None = None

    def __call__(self, version: int | None = None) -> Base:
        return self


def base_of(spark: SparkSession, table: DataFrame, version: int) -> Base:
    """Router, reference date, taxonomy and range index of an answer table."""
    row = table.agg(F.max("data").alias("last"), F.count(F.lit(1)).alias("n")).first()
    pairs = dim_category(table).checkpoint(eager=True)
    categories = pairs.groupBy("categoria").agg(F.min("sk_categoria").alias("pos"))
    router = Router(lexicon(spark, pairs), fixed_glossary(spark), categories, pairs, row["last"])
    return Base(version, table, row["last"], int(row["n"]), router, taxonomy_flat(table),
                range_index(table).checkpoint(eager=True))


class LiveBase:
    """The published base of a folder that ``refresh_stream`` writes to. A call
    gives the current version, or the one asked for; it is built once."""

    def __init__(self, spark: SparkSession, base_dir: str):
        self.spark, self.base_dir, self.built, self._held = spark, base_dir, 0, None

    def __call__(self, version: int | None = None) -> Base:
        version = version if version is not None else Wr.current_version(self.spark, self.base_dir)
        if version is None:
            raise FileNotFoundError(f"no version published under {self.base_dir}")
        if self._held is None or self._held.version != version:
            table = self.spark.read.parquet(Wr.version_path(self.base_dir, version))
            if self._held is not None:
                self._held.router.release()
            self._held = base_of(self.spark, table, version)
            self.built += 1
        return self._held


def route_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str,
                 base: Callable[[int | None], Base], available_now: bool = True,
                 max_files: int | None = None, state_partitions: int | None = None):
    """The message loop: each micro-batch of chat updates is routed, answered and
    replied to (one reply for each update), from ``base``: a ``Base`` for good, or
    a ``LiveBase``. Parts of a batch: rows, routed, replies."""
    reader = spark.readStream.schema(UPDATE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def reply(rows: DataFrame, folder: str) -> None:
        pinned = Wr.current_version(spark, folder)  # of an earlier try of this batch
        b = base(pinned)
        if pinned is None:
            Wr.publish(spark, folder, b.version)
        qs = rows.select(F.col("update_id").alias("q_id"), F.col("first_name").alias("user_name"), "text")
        b.router.route(qs).write.mode("overwrite").parquet(f"{folder}/routed")
        routed = rows.sparkSession.read.parquet(f"{folder}/routed")
        found = answer_questions(routed, b.table, b.ref, b.total_rows, b.index)
        every_reply(found, routed, b.flat, str(b.ref), b.total_rows) \
            .withColumns({"versao": F.lit(b.version), "data_ref": F.lit(b.ref)}) \
            .write.mode("overwrite").parquet(f"{folder}/replies")

    return _once(spark, parse_updates(reader.json(in_dir)), "update_id", out_dir, checkpoint, reply,
                 available_now, state_partitions)


def read_routed(spark: SparkSession, out_dir: str) -> DataFrame:
    return read_committed(spark, out_dir, "routed").select(*ROUTE_COLUMNS)


def publish_newest(spark: SparkSession, in_dir: str, base_dir: str, profile_dir: str, schema) -> int | None:
    """Publish the newest complete drop as a version and write its profile.

    A drop is a folder that matches ``in_dir`` and whose name ends in its
    number, which is also its version; it is complete when it holds the
    writer's ``_SUCCESS`` marker. Older drops are skipped: each is a full base."""
    fs, pattern = Wr._folder(spark, in_dir)
    found = []
    for status in fs.globStatus(pattern) or []:
        folder = status.getPath()
        number = re.search(r"(\d+)$", folder.getName())
        marker = spark._jvm.org.apache.hadoop.fs.Path(folder, "_SUCCESS")
        if number and fs.exists(marker):
            found.append((int(number[1]), folder.toString()))
    version, folder = max(found, default=(None, None))
    if version is None or version <= (Wr.current_version(spark, base_dir) or 0):
        return None
    path = Wr.version_path(base_dir, version)  # not published yet: a retry may write it again
    analytic_from_raw(spark.read.schema(schema).parquet(folder)).write.mode("overwrite").parquet(path)
    profile = spark.read.parquet(path).agg(
        F.max("data").alias("data_max"), F.min("data").alias("data_min"),
        F.count(F.lit(1)).alias("total_registros"))
    profile.write.mode("overwrite").parquet(f"{profile_dir}/versao={version}")
    Wr.publish(spark, base_dir, version)
    return version


def refresh_stream(spark: SparkSession, in_dir: str, base_dir: str, profile_dir: str,
                   checkpoint: str, schema) -> None:
    """Process the drops present now. New files only say that a drop has come;
    what is published is the newest complete drop as a whole, however the
    files are spread over micro-batches."""
    drops = spark.readStream.schema(schema).parquet(in_dir)

    def new_files(batch: DataFrame, batch_id: int) -> None:
        publish_newest(spark, in_dir, base_dir, profile_dir, schema)

    q = (drops.writeStream.foreachBatch(new_files).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    _run(q)
    publish_newest(spark, in_dir, base_dir, profile_dir, schema)  # a marker that came last


def dedup_stream(spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, schema,
                 key: str = "event_id", state_partitions: int | None = None) -> None:
    """New events only, once each; read them with ``read_committed(..., 'rows')``."""
    _once(spark, spark.readStream.schema(schema).parquet(in_dir), key, out_dir, checkpoint,
          state_partitions=state_partitions)

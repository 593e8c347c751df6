"""Session helpers: building a local session for tests/bench and locating the
shared checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import math
import os
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_RUN_ID = uuid.uuid4().hex[:12]


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "vitrine", extra_conf: dict | None = None) -> SparkSession:
    """Local session used by tests and the bench. On a cluster, use the
    session the platform gives you; nothing here is required."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("VITRINE_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` (or the SparkContext's checkpoint dir) from
    the session; only when neither is set (local tests) a fresh folder is
    created and registered. Never a machine-local folder on a cluster: there
    the cluster config names a shared location."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote sessions expose no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current is None and not conf_dir:
        master = spark.conf.get("spark.master", "")
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            # On a cluster each host would write to a disk of its own.
            raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all hosts share")
        conf_dir = tempfile.mkdtemp(prefix="vitrine-ckpt-")  # one host only
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    if current is None and sc is not None:
        sc.setCheckpointDir(conf_dir)
    return conf_dir or current


def session_key(spark: SparkSession) -> str:
    """Identifies the running application (for per-application caches)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def parallelism(spark: SparkSession) -> int:
    """Task slots of the application (falls back to the shuffle partitions)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Bounds of one task: compressed bytes of files that it reads and of shuffle data
# that it takes, and rows that a shuffle partition gets before neighbours are joined.
# A row of the base has some 18 bytes in its files and 450 in a sort: a task sorts
# some 100 MB, which fits where four tasks share an executor of 2 GB.
TASK_FILE_BYTES = 8 * 1024 * 1024
TASK_SHUFFLE_BYTES = 8 * 1024 * 1024
TASK_ROWS = 200_000

# Rows for each task slot that one pass of a layer moves: its shuffles hold some 130
# bytes a row until the pass ends, about 650 MB a slot. Each pass reads its input once
# more where that is not sorted by day: fewer rows cost time. Larger inputs take several
# passes, a range of days each; more machines take more rows a pass.
SLICE_ROWS = 5_000_000

_FILES, _ADVISORY = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PARTITIONS = "spark.sql.shuffle.partitions"
_CODEC, _PLAIN_CODEC, _SMALL_CODEC = "spark.sql.parquet.compression.codec", "snappy", "zstd"
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_ADAPTIVE = ("spark.sql.adaptive.enabled", "spark.sql.adaptive.coalescePartitions.enabled")
_UNITS = {"": 0, "k": 1, "m": 2, "g": 3, "t": 4, "p": 5}


def _bytes(text: str) -> int | None:
    """A size setting ('64MB', '128m', '1048576b') in bytes; None for other text."""
    m = re.fullmatch(r"\s*(\d+)\s*([kmgtp]?)i?b?\s*", text.lower())
    return int(m[1]) << 10 * _UNITS[m[2]] if m else None


def bound_tasks(spark: SparkSession, rows: int = 0) -> None:
    """Session settings under which what a task sorts or hashes does not grow with
    the input, so that it stays in memory: more tasks instead of larger ones.
    Settings that are tighter already stay; ``rows``: rows of the largest table.
    Parquet is written with zstd where the codec is Spark's default."""
    if spark.conf.get(_CODEC).lower() == _PLAIN_CODEC:
        spark.conf.set(_CODEC, _SMALL_CODEC)
    for key, bound in ((_FILES, TASK_FILE_BYTES), (_ADVISORY, TASK_SHUFFLE_BYTES)):
        size = _bytes(spark.conf.get(key))
        if size is not None and size > bound:
            spark.conf.set(key, str(bound))
    # the first number of partitions is a setting of its own only where neighbours are joined
    joined = all(spark.conf.get(key).lower() == "true" for key in _ADAPTIVE)
    most = int((spark.conf.get(_INITIAL, None) if joined else None) or spark.conf.get(_PARTITIONS))
    if math.ceil(rows / TASK_ROWS) > most:
        spark.conf.set(_INITIAL if joined else _PARTITIONS, str(math.ceil(rows / TASK_ROWS)))


def row_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks among which ``rows`` rows are dealt for a sort."""
    return max(parallelism(spark), math.ceil(rows / TASK_ROWS))


def slice_rows(spark: SparkSession) -> int:
    """Rows that one pass of a layer moves."""
    return parallelism(spark) * SLICE_ROWS


_HELD = threading.local()


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """For writes whose input is not used again: each statement inside drops its
    shuffle files when it ends, and what was ``held`` is deleted at the end."""
    old, outer = spark.conf.get(_FREE, None), getattr(_HELD, "paths", None)
    _HELD.paths = []
    spark.conf.set(_FREE, "true")
    try:
        yield
    finally:
        spark.conf.unset(_FREE) if old is None else spark.conf.set(_FREE, old)
        paths, _HELD.paths = _HELD.paths, outer
        for path in paths:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def held(df: DataFrame) -> DataFrame:
    """``df`` written once and read back. Inside ``freed``: Parquet that is deleted
    with the end of it; elsewhere a checkpoint, since nobody knows its last use."""
    paths = getattr(_HELD, "paths", None)
    if paths is None:
        return df.checkpoint(eager=True)
    paths.append(f"{work_root(df.sparkSession)}/held/{uuid.uuid4().hex}")
    df.write.option("compression", _SMALL_CODEC).parquet(paths[-1])
    return df.sparkSession.read.schema(df.schema).parquet(paths[-1])


def work_root(spark: SparkSession) -> str:
    """Folder (under the shared checkpoint dir) for tables this process writes."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/vitrine-{_RUN_ID}"

"""Materialized medallion layers for one input folder.

Each layer is written once (Parquet, under the shared checkpoint folder) and
read back, as the source writes each layer as a table. Writing cuts the
lineage, so a lost executor replays at most one layer, and every query reads
the layer it needs instead of re-running the ETL.

The answer table is written partitioned by the source's own period columns
(``ano``, ``mes``) and by the date's own month, after a range partition on
``data``: month-to-date and year-to-date filters prune directories by the
first two, single days by the third, and each write task produces a few
contiguous month files instead of one file per month per task.

Disk. A layer is written in passes over ranges of days (``operators/slices``); what a
pass shuffles or holds back is deleted when the pass is written.
"""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.constants import ANALYTIC_COLUMNS, ORIGIN_EXISTING_FILE
from vitrine.operators import bronze as bronze_ops
from vitrine.operators import gold, silver as silver_ops
from vitrine.operators.periods import DAY_PARTITION, day_partition
from vitrine.operators.slices import Slice, day_slices
from vitrine.session import bound_tasks, freed, row_tasks, session_key, slice_rows, work_root
from vitrine.sources.testdata import listing_day

_LOCK = threading.RLock()
_REGISTRY: dict[tuple[str, str], "Lakehouse"] = {}


@dataclass(frozen=True)
class Reference:
    """The three scalars the answer service keeps per load."""
    last_date: date | None
    first_date: date | None
    rows: int


def _slug(path: str) -> str:
    return re.sub(r"[^A-Za-z0-9]+", "_", path.strip("/"))[-80:] or "root"


class Lakehouse:
    """Layers for one input. ``sf_dir`` names the input (the folder of the
    driver's tables by default); ``landing_builder`` replaces the derived
    landing file with any DataFrame (a real landing file), and ``origin`` is
    its provenance tag."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None,
                 landing_builder=None, origin: str = ORIGIN_EXISTING_FILE):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.root = (root.rstrip("/") if root else f"{work_root(spark)}/{_slug(self.sf_dir)}")
        self._landing_builder = landing_builder or self._listing_day
        self.origin = origin
        self._paths: dict[str, str] = {}
        self._frames: dict[str, DataFrame] = {}
        self._refs: dict[str, Reference] = {}

        self._rows: int | None = None
        self._slices: list[Slice] | None = None
        self.bound()

    def bound(self) -> None:
        """Bound the tasks of the session, as it is set now, by the rows of the base."""
        bound_tasks(self.spark, self._rows or 0)

    def _listing_day(self, part: Slice | None = None) -> DataFrame:
        return listing_day(self.spark, self.sf_dir, part)

    def slices(self) -> list[Slice]:
        """Ranges of days that are written in one pass each."""
        with _LOCK:
            if self._slices is None:
                if self._landing_builder == self._listing_day:
                    self._rows = self.raw("lineitem").count()  # from the files' footers
                    self.bound()
                    rows, days = self._rows, self.raw("lineitem").select(
                        F.col("l_shipdate").cast("date").alias("data"))
                else:
                    days = self.landing().select("data")
                    rows = days.count()
                most = slice_rows(self.spark)
                self._slices = [Slice(None, None, rows)] if rows <= most else day_slices(days, most)
        return self._slices

    def tasks(self, part: Slice | None = None) -> int | None:
        """Tasks for a sort of the base, or of a slice of several, by its rows: sorted
        neighbours compress so well that shuffle bytes say little. None if the rows of
        the base are not known."""
        if part is not None and len(self._slices or []) > 1:
            return row_tasks(self.spark, part.rows)
        return row_tasks(self.spark, self._rows) if self._rows is not None else None

    # -- generic --------------------------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _materialize(self, name: str, build, partition_by: list[str] | None = None,
                     range_on: list[str] | None = None, slices: list[Slice] | None = None) -> DataFrame:
        """Write a layer once. With ``slices``, ``build`` gives the rows of each."""
        with _LOCK:
            if name not in self._paths:
                for i, part in enumerate(slices or [None]):
                    with freed(self.spark):
                        df = build(part) if slices else build()
                        if range_on:
                            # date first (files stay sorted by date for row-group pruning),
                            # then a row-level key so one hot day still splits across tasks
                            n = self.tasks(part)
                            df = df.repartitionByRange(*([n] if n else []),
                                                       *[F.col(c).asc_nulls_first() for c in range_on])
                        writer = df.write.mode("append" if i else "overwrite")
                        if partition_by:
                            writer = writer.partitionBy(*partition_by)
                        writer.parquet(self.path(name))
                self._paths[name] = self.path(name)
                # one reader per layer: its file index (and listing) is reused
                self._frames[name] = self.spark.read.parquet(self._paths[name])
        return self._frames[name]

    def raw(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    # -- layers ---------------------------------------------------------------
    def landing(self) -> DataFrame:
        from vitrine.constants import LANDING_COLUMNS
        own = self._landing_builder == self._listing_day
        if "landing" not in self._paths and own:
            df = self._materialize("landing", self._listing_day, slices=self.slices())
        else:
            df = self._materialize("landing", self._landing_builder)
        return df.select(*LANDING_COLUMNS, *[c for c in ("produto",) if c in df.columns])

    EXPORT_HEADER = "Fato_MaisVendidos[{col}]"

    def export_path(self) -> str:
        """The base exported once as ``;``-delimited text with ``Table[col]``
        headers, as the BI export writes it (shared by the export, ingest and
        header clean-up queries)."""
        from vitrine.sources.delimited import write_delimited
        with _LOCK:
            if "export_csv" not in self._paths:
                write_delimited(bronze_ops.select_contract(self.bronze()), self.path("export_csv"),
                                header_template=self.EXPORT_HEADER)
                self._paths["export_csv"] = self.path("export_csv")
        return self._paths["export_csv"]

    def landing_path(self) -> str:
        self.landing()
        return self._paths["landing"]

    def bronze(self) -> DataFrame:
        return self._materialize(
            "bronze", lambda: bronze_ops.bronze(self.landing(), self.origin))

    def silver(self) -> DataFrame:
        # written as the dedup exchange left it: no extra shuffle just for layout
        bronze, now = self.bronze(), F.lit(datetime.now(timezone.utc))
        return self._materialize(
            "silver", lambda part: silver_ops.silver(part.of(bronze), processing_time=False)
            .withColumn("_data_processamento", now), slices=self.slices())

    def dim_calendar(self) -> DataFrame:
        return self._materialize("dim_calendar", lambda: gold.dim_calendar(self.silver()))

    def dim_category(self) -> DataFrame:
        return self._materialize("dim_category", lambda: gold.dim_category(self.silver()))

    def dim_product(self) -> DataFrame:
        # rows of the columns of a product, and those of a task's latest days alone, take
        # half the room of the rows of a slice
        silver, passes = self.silver(), -(-len(self.slices()) // 2)
        return self._materialize("dim_product", lambda: gold.dim_product(silver, passes))

    def fact(self) -> DataFrame:
        """Sales fact, partitioned by ano_mes (month filters prune folders)."""
        from vitrine.constants import FACT_COLUMNS
        if "fact" not in self._paths:  # the layers below are written first, apart
            silver, cat, prod = self.silver(), self.dim_category(), self.dim_product()
            self._materialize("fact", lambda part: gold.fact_sales(part.of(silver), cat, prod),
                              partition_by=["ano_mes"], range_on=["data", "sk_produto"],
                              slices=self.slices())
        df = self._frames["fact"]
        return df.select(*FACT_COLUMNS)

    def analytic(self, raw: bool = False, with_partition: bool = False) -> DataFrame:
        """The 14-column answer table: over silver (default) or over the raw
        landing rows exactly as the chat service loads them (``raw=True``).
        ``with_partition`` adds the date-derived partition column, by which
        single days are pruned."""
        name = "analytic_raw" if raw else "analytic"
        rows = self.landing() if raw else self.silver()
        build = gold.analytic_from_raw if raw else gold.analytic_from_silver
        df = self._materialize(
            name, lambda part: build(part.of(rows)).withColumn(DAY_PARTITION, day_partition(F.col("data"))),
            partition_by=["ano", "mes", DAY_PARTITION], range_on=["data", "posicao_ranking"],
            slices=self.slices())
        columns = [F.col(c).cast("int").alias(c) if c in ("ano", "mes") else F.col(c)
                   for c in ANALYTIC_COLUMNS]
        if with_partition:
            columns.append(F.col(DAY_PARTITION).cast("string").alias(DAY_PARTITION))
        return df.select(*columns)

    # FIXED VALUES: names of the gold tables and of the answer table.
    VIEW_NAMES = {"ouro_dim_calendario": "dim_calendar", "ouro_dim_categoria": "dim_category",
                  "ouro_dim_produto": "dim_product", "ouro_fato_vendas": "fact",
                  "fato_ml": "analytic"}

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose the gold tables and the answer table to Spark SQL under their
        table names (BI-style star queries, ad-hoc SQL)."""
        names = []
        for view, layer in self.VIEW_NAMES.items():
            getattr(self, layer)().createOrReplaceTempView(prefix + view)
            names.append(prefix + view)
        return names

    # -- question answering -----------------------------------------------------
    def questions(self) -> DataFrame:
        from vitrine.operators import taxonomy
        return self._materialize("questions", lambda: taxonomy.questions(
            self.raw("conversations"), self.dim_category(), self.dim_calendar(), self.spark))

    def lexicon(self) -> DataFrame:
        from vitrine.operators import taxonomy
        return taxonomy.lexicon(self.spark, self.dim_category())

    def categories(self) -> DataFrame:
        """Data categories with their position (name order)."""
        return self.dim_category().groupBy("categoria").agg(F.min("sk_categoria").alias("pos"))

    def routed(self) -> DataFrame:
        from vitrine.operators.routing import route_questions
        from vitrine.sources.dictionary import fixed_glossary
        return self._materialize("routed", lambda: route_questions(
            self.questions(), self.lexicon(), fixed_glossary(self.spark), self.categories(),
            self.dim_category(), self.reference().last_date))

    def answers(self) -> DataFrame:
        from vitrine.operators.answers import answer_questions
        r = self.reference()
        return self._materialize("answers", lambda: answer_questions(
            self.routed(), self.analytic(), r.last_date, r.rows, self.range_index()))

    def range_index(self) -> DataFrame:
        """Sums of the answer table by dyadic intervals of days."""
        from vitrine.operators.ranges import range_index
        return self._materialize("range_index", lambda: range_index(self.analytic()))

    def listing_sketches(self) -> DataFrame:
        """Sketches of the listings of each category by dyadic intervals of days."""
        from vitrine.operators.distinct import sketch_index
        return self._materialize("listing_sketches",
                                 lambda: sketch_index(self.silver(), "id_anuncio"))

    def reference(self, raw: bool = False) -> Reference:
        """Last date, first date and row count of the answer table (one
        aggregate row; the only values brought to the driver)."""
        key = "raw" if raw else "silver"
        with _LOCK:
            if key not in self._refs:
                row = self.analytic(raw).agg(F.max("data").alias("mx"), F.min("data").alias("mn"),
                                             F.count(F.lit(1)).alias("n")).first()
                self._refs[key] = Reference(row["mx"], row["mn"], int(row["n"]))
        return self._refs[key]


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    key = (session_key(spark), sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _REGISTRY:
            _REGISTRY[key] = Lakehouse(spark, sf_dir)
        found = _REGISTRY[key]
    found.bound()  # the settings may have been changed since the layers were built
    return found

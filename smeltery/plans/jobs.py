"""Ingest, refresh and the two in sequence. Errors propagate, so a failed step stops the rest.

A step is done when its table's log says so. The pipeline can be called again under the same run ids
after any failure: it passes over steps that are done and replaces what others left behind.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace
from datetime import date, timedelta
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from smeltery.functions import named
from smeltery.operators import quality, reports
from smeltery.plans import sales
from smeltery.run import Run
from smeltery.sources import log, tables
from smeltery.sources.log import Part, Stats, Version
from smeltery.sources.tables import NoSuchTable, Table


@dataclass(frozen=True)
class BronzeLoad:
    """The stored table after a load; the looks at it cost nothing until asked for."""

    rows: DataFrame
    table: Table
    run: Run

    @property
    def latest(self) -> DataFrame:
        return latest_loads(self.rows.sparkSession, self.table)

    @property
    def monitor(self) -> DataFrame:
        return monitor_bronze(self.rows.sparkSession, self.table, self.run)

    @property
    def loaded_today(self) -> DataFrame:
        return loaded_on(self.rows.sparkSession, self.table, self.run.as_of)


@dataclass(frozen=True)
class SilverRefresh:
    """``rows`` is the published table, None while nothing was ever published.

    ``load`` is the ingest that came before, where the two ran as a pipeline.
    """

    ok: bool
    audit: DataFrame
    rows: DataFrame | None
    load: BronzeLoad | None = None

    @property
    def report(self) -> DataFrame:
        return sales.state_category_report(self._published())

    @property
    def monitor(self) -> DataFrame:
        return sales.silver_monitor(self._published())

    def _published(self) -> DataFrame:
        if self.rows is None:
            raise NoSuchTable("no refresh has passed its audit yet")
        return self.rows


def _day(spark: SparkSession, day: date) -> tuple[int, int]:
    """The first instant of a day and of the next, in microseconds, in the session time zone."""
    days = spark.createDataFrame(pa.table({"d": [day, day + timedelta(days=1)]}))
    start, end = (r[0] for r in days.select(F.unix_micros(F.col("d").cast("timestamp"))).collect())
    return start, end


def loaded_on(spark: SparkSession, bronze: Table, day: date) -> DataFrame:
    """The stored rows loaded on a day: only loads of that day are listed."""
    rows = tables.read_between(spark, bronze, sales.LOADED_AT, *_day(spark, day))
    return reports.loaded_on(rows, sales.LOADED_AT, day)


def latest_loads(spark: SparkSession, bronze: Table, k: int = 5) -> DataFrame:
    """The ``k`` rows loaded last: only loads that can hold one of them are listed."""
    return sales.latest_loads(tables.read_newest(spark, bronze, sales.LOADED_AT, k), k)


def monitor_bronze(spark: SparkSession, bronze: Table, run: Run) -> DataFrame:
    """Row count, rows loaded on the run's day and NULL counts, added up from the log.

    Every load's counts were logged with it. Data files are opened only for a load that began before
    the day or ended after it. A table with a load that was not counted is looked at file by file.
    """
    version, known = tables.statistics(spark, bronze)
    if not known or sales.LOADED_AT not in bronze.tracked:
        return monitor_files(spark, bronze, run)
    start, end = _day(spark, run.as_of)
    loaded, cut = 0, False
    for part in version.parts:
        span = part.stats.spans.get(sales.LOADED_AT)
        if sales.LOADED_AT not in part.stats.spans:
            cut = cut or part.stats.rows > 0
        elif span is not None and start <= span[0] and span[1] < end:
            loaded += part.stats.rows - part.stats.nulls_of(sales.LOADED_AT)
        elif span is not None and span[0] < end and span[1] >= start:
            cut = True
    if cut:
        loaded = loaded_on(spark, bronze, run.as_of).count()
    counts = {"total_rows": sum(p.stats.rows for p in version.parts), "loaded_rows": loaded}
    counts |= {c: sum(p.stats.nulls_of(c) for p in version.parts) for c in version.schema.names}
    return spark.createDataFrame(pa.table({c: pa.array([n], pa.int64()) for c, n in counts.items()}))


def monitor_files(spark: SparkSession, bronze: Table, run: Run) -> DataFrame:
    """The same from the stored files, without what the log says about them.

    Counts come from file footers and the day's rows from a pruned scan. Where footers cannot
    answer, everything comes from one scan.
    """
    versions = tables.footer_counts(spark, bronze)
    if versions is None:
        return sales.bronze_monitor(tables.read(spark, bronze), run)
    columns = [c for c in versions[-1].columns if c != tables.RUN_COLUMN]
    by = (*bronze.partition_by, tables.RUN_COLUMN)
    # Files older than a column hold no value of it, so all of their rows count as NULL there.
    profiles = [
        quality.null_profile(v, by, total="total_rows").select(
            "total_rows",
            reports.loaded_on(v, "bronze_load_timestamp", run.as_of)
            .agg(F.count(F.lit(1)))
            .scalar()
            .alias("loaded_rows"),
            *[(named(c) if c in v.columns else F.col("total_rows")).alias(c) for c in columns],
        )
        for v in versions
    ]
    counted = ["total_rows", "loaded_rows", *columns]
    return reduce(DataFrame.unionByName, profiles).agg(*[F.sum(named(c)).alias(c) for c in counted])


def ingest_bronze(
    spark: SparkSession,
    source: DataFrame,
    bronze: Table,
    run: Run,
    source_system: str = sales.SOURCE_SYSTEM,
    file_name: str = sales.FILE_NAME,
    rebalance: bool = True,
) -> BronzeLoad:
    """Stamp the delivered rows and append them as they are.

    ``rebalance=False`` spares the shuffle before the write, for deliveries whose tasks already meet
    few days.
    """
    stamped = sales.stamp_bronze(source, run, source_system, file_name)
    tables.append(spark, stamped, bronze, run.id, rebalance)
    return BronzeLoad(tables.read(spark, bronze), bronze, run)


def _rows_of(version: Version) -> int | None:
    """Rows of a version by its log, None if a part was not counted."""
    stats = log.merged(version.parts)
    return None if stats is None else stats.rows


def _audited(
    spark: SparkSession,
    rows: DataFrame,
    stats: Stats,
    bronze: DataFrame,
    rows_read: int | None,
    silver: Table,
    run: Run,
) -> tuple[DataFrame, int]:
    """The stored audit and the number of rows it scanned."""
    stored = Observation(f"stored-{uuid.uuid4()}")
    report = sales.staged_audit(rows, stats, bronze, rows_read, stored)
    return tables.keep_audit(report, silver, run.id), stored.get["rows"]


def refresh_silver(
    spark: SparkSession,
    bronze: DataFrame,
    silver: Table,
    run: Run,
    rebalance: bool = True,
    rows_read: int | None = None,
    source_seq: int | None = None,
) -> SilverRefresh:
    """Rebuild silver from all of bronze: stage, audit what was stored, publish if it passes.

    Bronze is scanned once; its rows are counted without reading a column unless ``rows_read`` says
    how many there are. Rows, NULLs, sum, maximum and bands are counted while silver is written; the
    audit scans the staged keys alone, for duplicates, and holds the rows it found against the
    count. If they differ, the staged rows are counted anew. ``rebalance=False`` spares the shuffle
    before the write where the input files are large enough that a task meets only one or two
    months. Either way the directory that is published is the one that was audited.
    ``source_seq`` is the last commit of the bronze table in these rows, for ``extend_silver``.
    """
    refined = sales.stamp_silver(sales.to_silver(bronze), run)
    measures = sales.audit_measures()
    stats = tables.stage(refined, silver, run.id, rebalance, measures)
    rows = tables.read_staged(spark, silver, run.id, refined.schema)
    audit, scanned = _audited(spark, rows, stats, bronze, rows_read, silver, run)
    if scanned != stats.rows:
        place = tables.location_of(run.id)
        stats = tables.recounted(spark, silver, place, refined.schema, measures)
        audit, _ = _audited(spark, rows, stats, bronze, rows_read, silver, run)
    ok = stats.rows > 0  # the gate of quality.passes
    if ok:
        tables.publish(spark, silver, run.id, refined.schema, stats, source_seq=source_seq)
    else:
        rows = tables.read(spark, silver) if tables.exists(spark, silver) else None
    if rows is not None:
        sales.register_view(rows)
    return SilverRefresh(ok, audit, rows)


def _refresh_from(
    spark: SparkSession, bronze: Table, silver: Table, run: Run, rebalance: bool
) -> SilverRefresh:
    version = tables.current(spark, bronze)
    if version is None:
        raise NoSuchTable(bronze.path)
    rows, count = tables.read(spark, bronze, version), _rows_of(version)
    return refresh_silver(spark, rows, silver, run, rebalance, count, version.seq)


def extend_silver(
    spark: SparkSession, bronze: Table, silver: Table, run: Run, rebalance: bool = True
) -> SilverRefresh:
    """Bring silver up to date by refining only the bronze loads it does not hold yet.

    The published version notes the last bronze commit in it, so the new loads are the entries after
    that one; what compaction did to bronze since does not matter. Their rows become one more part
    of silver. Rows are those of a full refresh but for the run columns, which name the run that
    added them. The audit covers the whole table: counts are added to those of the parts that are
    there, duplicates are counted over all keys. Where the difference is not just added loads, or
    parts were not counted, everything is refreshed. Without new loads nothing is published, and the
    last audit is returned.
    """
    source, held = tables.current(spark, bronze), tables.current(spark, silver)
    if source is None:
        raise NoSuchTable(bronze.path)
    new = None
    if held is not None and held.source_seq is not None and held.source_seq <= source.seq:
        new = tables.appended_since(spark, bronze, held.source_seq, source)
    if new is None or log.merged(held.parts) is None:
        return _refresh_from(spark, bronze, silver, run, rebalance)
    added, loads = new
    if not loads:
        return _as_published(spark, silver, held.parts[-1].location)
    refined = sales.stamp_silver(sales.to_silver(added), run)
    if refined.schema != held.schema:
        return _refresh_from(spark, bronze, silver, run, rebalance)
    measures, place = sales.audit_measures(), tables.location_of(run.id)
    stats = tables.stage(refined, silver, run.id, rebalance, measures)
    whole = tables.read(spark, silver, held).unionByName(
        tables.read_staged(spark, silver, run.id, refined.schema)
    )
    count = _rows_of(source)
    every = log.merged([*held.parts, Part(place, len(refined.schema), stats)])
    audit, scanned = _audited(spark, whole, every, tables.read(spark, bronze, source), count, silver, run)
    if scanned != every.rows:
        stats = tables.recounted(spark, silver, place, refined.schema, measures)
        every = log.merged([*held.parts, Part(place, len(refined.schema), stats)])
        audit, _ = _audited(spark, whole, every, tables.read(spark, bronze, source), count, silver, run)
    ok = every.rows > 0
    if ok:
        held = tables.publish(spark, silver, run.id, refined.schema, stats, True, source.seq)
    rows = tables.read(spark, silver, held)
    sales.register_view(rows)
    return SilverRefresh(ok, audit, rows)


def _as_published(spark: SparkSession, silver: Table, location: str) -> SilverRefresh:
    """The published table with the audit of the run that wrote a part of it."""
    rows = tables.read(spark, silver)
    sales.register_view(rows)
    return SilverRefresh(True, tables.read_audit(spark, silver, tables.run_of(location)), rows)


def run_pipeline(
    spark: SparkSession,
    source: DataFrame,
    bronze: Table,
    silver: Table,
    bronze_run: Run | None = None,
    silver_run: Run | None = None,
    rebalance: bool = True,
) -> SilverRefresh:
    """Ingest, then refresh; the refresh starts only if the ingest succeeded.

    Called again under the same run ids, it resumes: an ingest that was logged is not repeated, a
    refresh that was published is returned as it stands, and what a failed step wrote is replaced.
    ``rebalance`` holds for both writes.
    """
    bronze_run, silver_run = bronze_run or Run.start(spark), silver_run or Run.start(spark)
    if tables.logged(spark, bronze, bronze_run.id):
        load = BronzeLoad(tables.read(spark, bronze), bronze, bronze_run)
    else:
        load = ingest_bronze(spark, source, bronze, bronze_run, rebalance=rebalance)
    if tables.logged(spark, silver, silver_run.id):
        done = _as_published(spark, silver, tables.location_of(silver_run.id))
    else:
        done = _refresh_from(spark, bronze, silver, silver_run, rebalance)
    return replace(done, load=load)

"""Partitioned tables of plain files, with staged writes that become visible by publishing.

Layout under ``Table.path``::

    runs/__run=<run id>/  data files, partitioned; a directory is never rewritten in place
    log/                  one small entry per load or publish, see ``log``
    audits/<run id>/      the audit rows of that run

The log names the directories that make up the table, its schema, and what each directory holds:
rows, NULLs by column and the span of tracked times, counted while it was written. Rows are written
first and logged when they are whole, so a load that fails is never seen, neither its rows nor its
columns, and partition values are never re-typed by inference. One writer per table is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from smeltery.functions import named, null_count
from smeltery.session import (
    AUDIT_ADVISORY,
    COUNT_SETTINGS,
    LISTING_SETTINGS,
    OPEN_WRITERS,
    REBALANCE_PARTITIONS,
    WRITE_SETTINGS,
    at_least,
    audit_settings,
    settings,
)
from smeltery.sources import files, log
from smeltery.sources.log import Part, Stats, Version
from smeltery.sources.schemas import SchemaConflict, aligned, extended

# Parquet leaves out all statistics of a column chunk, its NULL count too, when its smallest and
# largest value are long. Shortened ones are still valid bounds.
WRITE_OPTIONS = {"parquet.statistics.truncate.length": "64"}
RUN_COLUMN = "__run"
MIB = 1 << 20

# Types that Parquet stores as one column with a NULL count of its own.
FLAT_TYPES = (
    BinaryType,
    BooleanType,
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)
OWN_LOG = ("delta", "hudi", "iceberg")


@dataclass(frozen=True)
class Table:
    """``tracked`` names timestamp columns whose span every load records, so that reads by time
    choose loads before any file is listed."""

    path: str
    partition_by: tuple[str, ...] = ()
    fmt: str = "parquet"
    tracked: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if self.fmt.lower() in OWN_LOG:
            raise ValueError(
                f"{self.fmt} keeps a log of its own; these tables are plain files, such as Parquet or ORC"
            )


class NoSuchTable(LookupError):
    """Nothing has been published under the table's path yet."""


class RunAlreadyLogged(ValueError):
    """Rows were loaded under this run id before."""


def location_of(run_id: str) -> str:
    return f"runs/{RUN_COLUMN}={run_id}"


def run_of(location: str) -> str:
    return location.partition(f"{RUN_COLUMN}=")[2]


def run_path(table: Table, run_id: str) -> str:
    return f"{table.path}/{location_of(run_id)}"


# --- the log


def current(spark: SparkSession, table: Table) -> Version | None:
    """The published version, None if there is none."""
    return log.current(spark, table.path)


def _version(spark: SparkSession, table: Table) -> Version:
    version = current(spark, table)
    if version is None:
        raise NoSuchTable(table.path)
    return version


def logged(spark: SparkSession, table: Table, run_id: str) -> bool:
    """Whether the run has committed to the table."""
    return log.logged(spark, table.path, run_id) is not None


def superseded(spark: SparkSession, table: Table) -> DataFrame:
    """Directories (``run_id``, ``location``) the table once had and no longer reads.

    Readers that opened an older version may still use them; an operator decides when to drop them.
    """
    now = _version(spark, table).locations
    history = log.entries(spark, table.path)
    once = history.select(F.explode("add.location").alias("location")).distinct()
    run = F.regexp_extract("location", f"{RUN_COLUMN}=(.*)$", 1).alias("run_id")
    return once.where(~F.col("location").isin(now)).select(run, "location")


# --- reading


def exists(spark: SparkSession, table: Table) -> bool:
    return current(spark, table) is not None


def _load(
    spark: SparkSession,
    table: Table,
    locations: Sequence[str],
    schema: StructType,
    and_run: tuple[str, ...] = (),
) -> DataFrame:
    # The run is a partition column to Spark, so directories of many runs are one scan. Partition
    # columns come back last, so put the columns in the stored order.
    # Naming it in the schema gives it a type, and lets it be asked for where no file tells it.
    wanted = StructType([*schema.fields, *[StructField(c, StringType()) for c in and_run]])
    scan = spark.read.format(table.fmt).schema(wanted).option("basePath", f"{table.path}/runs")
    rows = scan.load([f"{table.path}/{location}" for location in locations])
    return rows.select(*[named(c) for c in schema.names], *and_run)


def _of_parts(
    spark: SparkSession, table: Table, version: Version, wanted: Callable[[Part], bool]
) -> DataFrame:
    locations = [p.location for p in version.parts if wanted(p)]
    if not locations:
        return spark.createDataFrame([], version.schema)
    return _load(spark, table, locations, version.schema)


def read(spark: SparkSession, table: Table, version: Version | None = None) -> DataFrame:
    """The published rows, columns in their stored order, or those of a version read before."""
    version = version or _version(spark, table)
    return _load(spark, table, version.locations, version.schema)


def read_part(spark: SparkSession, table: Table, version: Version, part: Part) -> DataFrame:
    """The rows of one part of a version."""
    return _of_parts(spark, table, version, lambda p: p.location == part.location)


def read_between(spark: SparkSession, table: Table, column: str, start: int, end: int) -> DataFrame:
    """The rows of the loads that may hold an instant in [start, end), in microseconds.

    Loads are chosen from the log, before any file is listed; a load whose span is not known is
    read. The caller's filter decides about rows.
    """

    def meets(part: Part) -> bool:
        if part.stats is None or column not in part.stats.spans:
            return True
        span = part.stats.spans[column]
        return span is not None and span[0] < end and span[1] >= start

    return _of_parts(spark, table, _version(spark, table), meets)


def read_newest(spark: SparkSession, table: Table, column: str, k: int) -> DataFrame:
    """The rows of the loads that may hold one of the k newest instants, ties included.

    The newest loads that hold k instants between them are all at or after the earliest instant of
    theirs, so no load that ends before it is needed. With fewer than k instants in the table, or a
    load whose span is not known, all loads are read.
    """
    version = _version(spark, table)
    held = sorted(
        (
            (p.stats.spans[column][0], p.stats.rows - p.stats.nulls_of(column))
            for p in version.parts
            if p.stats and p.stats.spans.get(column)
        ),
        reverse=True,
    )
    unknown = any(p.stats is None or column not in p.stats.spans for p in version.parts)
    found, earliest = 0, None
    for first, instants in held:
        found += instants
        if found >= k:
            earliest = first
            break
    if unknown or earliest is None:
        return read(spark, table, version)

    def needed(part: Part) -> bool:
        span = part.stats.spans[column]
        return span is not None and span[1] >= earliest

    return _of_parts(spark, table, version, needed)


def appended_since(
    spark: SparkSession, table: Table, seq: int, version: Version
) -> tuple[DataFrame, int] | None:
    """The rows of the loads committed after ``seq`` up to ``version``, and their number.

    Compactions in between are passed over, as they hold the same rows. None if a load was replaced
    in between, or has been dropped since, so that the difference is not just added rows.
    """
    parts: list[Part] = []
    for number in range(seq + 1, version.seq + 1):
        made = log.entry(spark, table.path, number)
        if made is None or made["step"] not in ("append", "compact"):
            return None
        if made["step"] == "append":
            parts += [Part(p["location"], p["width"]) for p in made["add"]]
    if not all(files.exists(spark, f"{table.path}/{p.location}") for p in parts):
        return None
    if not parts:
        return spark.createDataFrame([], version.schema), 0
    return _load(spark, table, [p.location for p in parts], version.schema), len(parts)


def statistics(spark: SparkSession, table: Table) -> tuple[Version, bool]:
    """The published version, and whether all of its parts know what they hold."""
    version = _version(spark, table)
    return version, all(p.stats is not None for p in version.parts)


def read_staged(spark: SparkSession, table: Table, run_id: str, schema: StructType) -> DataFrame:
    """The rows of a run that need not be published."""
    return _load(spark, table, [location_of(run_id)], schema)


def _reader_session(spark: SparkSession) -> SparkSession:
    """A session with all of the caller's settings, and those that let footers answer counts."""
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        # What differs from a fresh session was set on the caller's, so it can be set here too.
        if session.conf.get(key, None) != value:
            session.conf.set(key, value)
    # The reader pushes a timestamp filter only for the form it would write itself.
    for key, value in WRITE_SETTINGS.items():
        session.conf.set(key, value)
    session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    v1 = session.conf.get("spark.sql.sources.useV1SourceList").split(",")
    session.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in v1 if s != "parquet"))
    return session


def footer_counts(spark: SparkSession, table: Table) -> list[DataFrame] | None:
    """The published rows, read so that plain counts come from the Parquet footers.

    One frame per schema version, with the columns its files have; columns were only ever added, so
    a version is a number of leading columns; the last column is the run, by which counts have to be
    grouped as by every partition column. Counting rows and NULLs of a whole table then opens
    every file but decodes no data. Returns None where footers cannot answer: other formats, and
    columns of types that are not known to be stored flat. The frames belong to a session of their
    own, which keeps the reader settings off the caller's session.
    """
    version = _version(spark, table)
    schema = version.schema
    if table.fmt != "parquet" or any(type(f.dataType) not in FLAT_TYPES for f in schema.fields):
        return None
    session = _reader_session(spark)
    versions: dict[int, list[str]] = {}
    for part in version.parts:
        versions.setdefault(part.width, []).append(part.location)
    return [
        _load(session, table, locations, StructType(schema.fields[:width]), (RUN_COLUMN,))
        for width, locations in sorted(versions.items())
    ]


# --- writing


def _counts(df: DataFrame, table: Table, measures: Mapping[str, Column]) -> dict[str, Column]:
    """What is counted while rows are written: all of it adds up over tasks.

    An empty text in a partition column reads back as NULL, so it counts as one.
    """
    stored = {
        f.name: F.nullif(named(f.name), F.lit(""))
        if f.name in table.partition_by and isinstance(f.dataType, StringType)
        else named(f.name)
        for f in df.schema.fields
    }
    out = {"rows": F.count(F.lit(1))}
    out |= {f"nulls_{i}": null_count(c) for i, c in enumerate(stored.values())}
    for i, c in enumerate(_tracked(df.schema, table)):
        instant = F.unix_micros(named(c))
        out |= {f"first_{i}": F.min(instant), f"last_{i}": F.max(instant)}
    return out | {f"measure_{i}": c for i, c in enumerate(measures.values())}


def _tracked(schema: StructType, table: Table) -> list[str]:
    kinds = {f.name: f.dataType for f in schema.fields}
    return [c for c in table.tracked if isinstance(kinds.get(c), TimestampType)]


def _stats(
    schema: StructType, table: Table, found: Mapping, measures: Mapping[str, Column]
) -> Stats:
    spans = {}
    for i, c in enumerate(_tracked(schema, table)):
        first, last = found[f"first_{i}"], found[f"last_{i}"]
        spans[c] = None if first is None else (first, last)
    return Stats(
        found["rows"],
        {c: found[f"nulls_{i}"] for i, c in enumerate(schema.names)},
        spans,
        {name: found[f"measure_{i}"] for i, name in enumerate(measures)},
    )


def _write(
    df: DataFrame,
    table: Table,
    location: str,
    mode: str,
    rebalance: bool,
    measures: Mapping[str, Column] | None = None,
) -> Stats:
    """Write the rows and return what was counted of them on the way, in the same pass.

    Counting stands behind the last shuffle, where Spark takes the counts of one attempt of every
    task; a task that ran twice is counted once.
    """
    spark, applied, measures = df.sparkSession, dict(WRITE_SETTINGS), measures or {}
    if rebalance and table.partition_by:
        # One file per partition value and output task instead of one per input task. The
        # adaptive planner splits a value that outgrows the advisory size over several tasks and
        # packs small ones together.
        first = at_least(spark, "spark.sql.shuffle.partitions", REBALANCE_PARTITIONS)
        df = df.hint("rebalance", first, *[named(c) for c in table.partition_by])
        writers = "spark.sql.maxConcurrentOutputFileWriters"
        applied[writers] = str(at_least(spark, writers, OPEN_WRITERS))
    counting = Observation(f"written-{uuid.uuid4()}")
    counted = [c.alias(name) for name, c in _counts(df, table, measures).items()]
    watched = df.observe(counting, *counted)
    writer = watched.write.format(table.fmt).options(**WRITE_OPTIONS).mode(mode)
    writer = writer.partitionBy(*table.partition_by)
    with settings(spark, applied):
        writer.save(f"{table.path}/{location}")
    return _stats(df.schema, table, counting.get, measures)


def stored_rows(spark: SparkSession, table: Table, location: str, schema: StructType) -> int:
    """Rows that a directory holds, by its files' footers; no column is read."""
    with settings(spark, COUNT_SETTINGS):
        return _load(spark, table, [location], schema).count()


def recounted(
    spark: SparkSession,
    table: Table,
    location: str,
    schema: StructType,
    measures: Mapping[str, Column] | None = None,
) -> Stats:
    """What a directory holds, from a scan of its files."""
    rows, measures = _load(spark, table, [location], schema), measures or {}
    counted = [c.alias(name) for name, c in _counts(rows, table, measures).items()]
    return _stats(schema, table, rows.agg(*counted).first().asDict(), measures)


def append(
    spark: SparkSession, df: DataFrame, table: Table, run_id: str, rebalance: bool = True
) -> Version:
    """Add rows as a whole. New columns extend the table; a changed type is refused before anything
    is written, as is a run id that was logged before.

    The rows go to a directory of their own, which the log names once it is complete. What a failed
    load left under the same run id was never seen and is replaced. What was counted of the rows is
    logged with them if the stored files have as many; otherwise the files are counted.
    """
    if logged(spark, table, run_id):
        raise RunAlreadyLogged(f"{table.path}: run {run_id} was logged before")
    version = current(spark, table)
    schema = extended(version.schema if version else StructType(), df.schema)
    location = location_of(run_id)
    stats = _write(aligned(df, schema), table, location, "overwrite", rebalance)
    if stats.rows != stored_rows(spark, table, location, schema):
        stats = recounted(spark, table, location, schema)
    part = Part(location, len(schema), stats)
    return log.commit(spark, table.path, version, run_id, "append", [part], [], schema)


def stage(
    df: DataFrame,
    table: Table,
    run_id: str,
    rebalance: bool = True,
    measures: Mapping[str, Column] | None = None,
) -> Stats:
    """Write a complete new version of the table, not yet visible to ``read``.

    Returns what was counted of the rows on the way, ``measures`` included: sums, counts, smallest
    and largest values. What a failed run staged under the same id is replaced; a run that was
    logged is never written over.
    """
    mode = "errorifexists" if logged(df.sparkSession, table, run_id) else "overwrite"
    return _write(df, table, location_of(run_id), mode, rebalance, measures)


def publish(
    spark: SparkSession,
    table: Table,
    run_id: str,
    schema: StructType,
    stats: Stats | None = None,
    added: bool = False,
    source_seq: int | None = None,
) -> Version:
    """Make a staged run the current version; its schema replaces the previous one.

    With ``added`` the run is added to the current version, whose schema must be the same.
    ``source_seq`` notes the last commit of the source whose rows the version holds.
    """
    version = current(spark, table)
    if added and (version is None or version.schema != schema):
        raise SchemaConflict(f"{table.path}: only rows of the same schema can be added")
    part = Part(location_of(run_id), len(schema), stats)
    return log.commit(
        spark, table.path, version, run_id, "publish", [part], [] if added else None, schema, source_seq
    )


def audit_path(table: Table, run_id: str) -> str:
    return f"{table.path}/audits/{run_id}"


def keep_audit(
    report: DataFrame, table: Table, run_id: str, advisory: int = AUDIT_ADVISORY
) -> DataFrame:
    """Store a run's audit rows once and return them as read back, whatever is asked of them.

    The audit's shuffle gets a partition for every ``advisory`` bytes the run staged. The audit of
    an earlier attempt of a run that was not logged is replaced.
    """
    spark, path = report.sparkSession, audit_path(table, run_id)
    staged = files.total_length(spark, run_path(table, run_id))
    mode = "errorifexists" if logged(spark, table, run_id) else "overwrite"
    with settings(spark, audit_settings(spark, staged, advisory)):
        report.write.mode(mode).parquet(path)
    return spark.read.schema(report.schema).parquet(path)


def read_audit(spark: SparkSession, table: Table, run_id: str) -> DataFrame:
    return spark.read.parquet(audit_path(table, run_id))


# --- file layout


def _files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    return files.select("path", "length")


def file_sizes(spark: SparkSession, table: Table) -> DataFrame:
    """(location, directory, length) of every current data file; file contents are not read.

    ``location`` is the run's directory, ``directory`` the partition within it.
    """
    paths = [f"{table.path}/{location}" for location in _version(spark, table).locations]
    pattern = f"(runs/{RUN_COLUMN}=[^/]*)/(?:(.*)/)?[^/]*$"
    return _files(spark, paths).select(
        F.regexp_extract("path", pattern, 1).alias("location"),
        F.regexp_extract("path", pattern, 2).alias("directory"),
        "length",
    )


def _summary(sizes: DataFrame, small: int) -> DataFrame:
    per_partition = sizes.groupBy("directory").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.count_if(F.col("length") < small).alias("small"),
    )
    return per_partition.agg(
        F.coalesce(F.sum("files"), F.lit(0)).alias("files"),
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.greatest(F.col("small") - 1, F.lit(0))), F.lit(0)).alias("surplus"),
    )


def file_summary(spark: SparkSession, table: Table, small: int = 16 * MIB) -> Row:
    """Files, bytes, and surplus: the small files beyond one remainder per partition."""
    with settings(spark, LISTING_SETTINGS):
        return _summary(file_sizes(spark, table), small).first()


def compact(
    spark: SparkSession,
    table: Table,
    run_id: str,
    max_surplus: float = 0.1,
    small: int = 16 * MIB,
) -> bool:
    """Merge the directories of small files into one and publish that; True if it was needed.

    A directory is left alone, file for file, while at most ``max_surplus`` of its bytes lie in
    files below ``small`` bytes. The others are merged if more than ``max_surplus`` of their files
    could be joined with a neighbour of the same partition. A step for the caller to schedule;
    nothing else in the library compacts.
    """
    version = _version(spark, table)
    schema = version.schema
    sizes = file_sizes(spark, table)
    in_small = F.sum(F.when(F.col("length") < small, F.col("length")).otherwise(0))
    with settings(spark, LISTING_SETTINGS):
        loose = (
            sizes.groupBy("location")
            .agg(in_small.alias("in_small"), F.sum("length").alias("bytes"))
            .where(F.col("in_small") > max_surplus * F.col("bytes"))
        )
        names = {row["location"] for row in loose.select("location").collect()}  # one per run
        summary = _summary(sizes.join(loose, "location", "left_semi"), small).first()
    if not names or summary["surplus"] <= max_surplus * summary["files"]:
        return False
    packed = [p for p in version.parts if p.location in names]
    stage(_load(spark, table, [p.location for p in packed], schema), table, run_id)
    # The same rows, so what the parts held is what the merged one holds.
    part = Part(location_of(run_id), len(schema), log.merged(packed))
    gone = [p.location for p in packed]
    log.commit(spark, table.path, version, run_id, "compact", [part], gone, schema)
    return True

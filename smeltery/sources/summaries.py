"""Summaries kept beside the parts of a table, so that reports read no row of it.

A part never changes once it is logged, so its summary is made once, under ``summaries/<name>/``,
and counts as there when the mark written after it is. Summaries add up: that of a compacted part is
made of those of the parts it replaced, without a scan.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from smeltery.sources import files, log, tables
from smeltery.sources.tables import NoSuchTable, Table


@dataclass(frozen=True)
class Summary:
    """``make`` turns rows into groups; ``merge`` turns groups of many parts into those of one."""

    name: str
    make: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]


def _folder(table: Table, summary: Summary) -> str:
    return f"{table.path}/summaries/{summary.name}"


def _paths(table: Table, summary: Summary, locations: list[str]) -> list[str]:
    return [f"{_folder(table, summary)}/{tables.run_of(location)}" for location in locations]


def _kept(spark: SparkSession, table: Table, summary: Summary) -> set[str]:
    marks = files.names(spark, f"{_folder(table, summary)}/done")
    return {tables.location_of(name) for name in marks}


def keep(spark: SparkSession, table: Table, summary: Summary) -> list[str]:
    """Make the summaries that parts of the table lack; returns the parts' run ids.

    Can be repeated after any failure: what a lost run wrote without its mark is replaced. Scans only
    parts without one, and of those not the ones that compaction made of parts that have one.
    """
    version = tables.current(spark, table)
    if version is None:
        raise NoSuchTable(table.path)
    kept, made = _kept(spark, table, summary), []
    for part in version.parts:
        if part.location in kept:
            continue
        run_id = tables.run_of(part.location)
        entry = log.logged(spark, table.path, run_id) or {}
        merged = entry.get("remove") if entry.get("step") == "compact" else None
        if merged and kept.issuperset(merged):
            groups = summary.merge(spark.read.parquet(*_paths(table, summary, merged)))
        else:
            groups = summary.make(tables.read_part(spark, table, version, part))
        groups.coalesce(1).write.mode("overwrite").parquet(f"{_folder(table, summary)}/{run_id}")
        files.write(spark, f"{_folder(table, summary)}/done/{run_id}", b"", replace=True)
        made.append(run_id)
    return made


def read(spark: SparkSession, table: Table, summary: Summary) -> DataFrame:
    """The table's groups, added up over its parts.

    Parts whose summary was not made are scanned, so the result is that of the whole table always.
    """
    version = tables.current(spark, table)
    if version is None:
        raise NoSuchTable(table.path)
    kept = _kept(spark, table, summary)
    there = [p.location for p in version.parts if p.location in kept]
    groups = [
        summary.make(tables.read_part(spark, table, version, p))
        for p in version.parts
        if p.location not in kept
    ]
    if there:
        groups.append(spark.read.parquet(*_paths(table, summary, there)))
    if not groups:
        return summary.make(tables.read(spark, table, version))
    whole = groups[0]
    for more in groups[1:]:
        whole = whole.unionByName(more)
    return summary.merge(whole)

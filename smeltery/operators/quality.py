"""Counting checks. Each is one aggregation over only the columns it needs."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from smeltery.functions import named, null_count, share
from smeltery.operators.refine import Rules, every
from smeltery.operators.rollup import roll_up
from smeltery.sources.log import Stats


def clean_counts(df: DataFrame, rules: Rules) -> DataFrame:
    """Rows before and after cleaning, from one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(every(rules)).alias("rows_kept")
    )


def critical_nulls(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """NULL count of each named field, as one wide row."""
    return df.agg(*[null_count(named(c)).alias(c) for c in fields])


def null_profile(
    df: DataFrame, partition_by: Sequence[str] = (), total: str | None = None
) -> DataFrame:
    """NULL count of every column as one wide row, with the row count first if ``total`` names it.

    Given the columns the table is partitioned by, the first step groups by them. Their own NULLs
    are then known from the group keys, and every aggregate left is a plain count, which Spark
    takes from the file footers when ``df`` comes from ``tables.footer_counts``.
    """
    rows = "__rows"
    stored = [c for c in df.columns if c not in partition_by]
    per_partition = df.groupBy(*[named(c) for c in partition_by]).agg(
        F.count(F.lit(1)).alias(rows), *[null_count(named(c)).alias(c) for c in stored]
    )
    nulls = {c: named(c) for c in stored} | {
        c: F.when(named(c).isNull(), named(rows)) for c in partition_by
    }
    wanted = ([F.sum(rows).alias(total)] if total else []) + [
        F.sum(nulls[c]).alias(c) for c in df.columns
    ]
    return per_partition.agg(*wanted).na.fill(0)


def duplicate_count(df: DataFrame, *keys: str, out: str = "duplicates") -> DataFrame:
    """Rows beyond the first of every key; NULL keys are one group.

    The shuffle carries one (key, count) pair per key and map task, so a key that holds a third
    of all rows costs no more than any other.
    """
    per_key = df.groupBy(*[named(k) for k in keys]).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias(out))


def value_stats(df: DataFrame, value: str) -> DataFrame:
    """Average and maximum of one column."""
    column = named(value)
    return df.agg(F.avg(column).alias("average"), F.max(column).alias("maximum"))


def quality_share(df: DataFrame, score: str, at_least: float = 90) -> DataFrame:
    """Percentage of rows whose score reaches ``at_least``; NULL over no rows."""
    return df.agg(share(named(score) >= at_least).alias("quality_pct"))


def quality_report(
    df: DataFrame, fields: Sequence[str], key: str, value: str, band: str
) -> DataFrame:
    """Every audit measure as rows of (metric, field, value).

    Two narrow scans. One groups by band and then rolls the few group rows up to the total, so
    the per-band counts and the whole-table measures share a scan. The other counts duplicate
    keys, the only measure that has to shuffle by a wide key.
    """
    rows, total, valued, highest = "__rows", "__total", "__valued", "__highest"
    nulls = {f: f"__nulls_{i}" for i, f in enumerate(fields)}
    per_band = df.groupBy(named(band).alias("band")).agg(
        F.count(F.lit(1)).alias(rows),
        *[null_count(named(f)).alias(out) for f, out in nulls.items()],
        F.sum(named(value)).alias(total),
        F.count(named(value)).alias(valued),
        F.max(named(value)).alias(highest),
    )
    rolled = roll_up(
        per_band,
        "band",
        rows,
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in nulls.values()],
        F.sum(total).alias(total),
        F.sum(valued).alias(valued),
        F.max(highest).alias(highest),
    )

    def line(metric: str, field: Column, amount: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            field.alias("field"),
            amount.cast("double").alias("value"),
        )

    whole_table = F.array(
        line("rows", F.lit("*"), F.col(rows)),
        *[line("nulls", F.lit(f), F.col(n)) for f, n in nulls.items()],
        line("average", F.lit(value), F.try_divide(F.col(total), F.col(valued))),
        line("maximum", F.lit(value), F.col(highest)),
    )
    one_band = F.array(line("band_rows", F.col("band"), F.col(rows)))
    lines = rolled.select(
        F.inline(F.when(F.col("is_total") == 1, whole_table).otherwise(one_band))
    )
    duplicates = duplicate_count(df, key).select(
        F.lit("duplicates").alias("metric"),
        F.lit(key).alias("field"),
        F.col("duplicates").cast("double").alias("value"),
    )
    return lines.unionByName(duplicates)


def with_rows_read(report: DataFrame, source: DataFrame) -> DataFrame:
    """The report with the rows that went into the refinement and those that were kept.

    The source is counted without reading any of its columns; what was kept is the report's own row
    count.
    """
    read = source.select(F.lit(1)).agg(F.count(F.lit(1)).cast("double").alias("value"))
    counts = read.select(F.lit("rows_read").alias("metric"), F.lit("*").alias("field"), "value")
    line = F.struct("metric", "field", "value")
    kept = F.struct(F.lit("rows_kept").alias("metric"), "field", "value")
    both = F.when(F.col("metric") == "rows", F.array(line, kept)).otherwise(F.array(line))
    return report.select(F.inline(both)).unionByName(counts)


def audit_measures(value: str, band: str, bands: Sequence[str]) -> dict[str, Column]:
    """What an audit needs beside rows and NULLs, counted while the rows are written."""
    column = named(value)
    return {
        "sum:total": F.sum(column).cast("double"),
        "sum:valued": F.count(column),
        "max:highest": F.max(column).cast("double"),
    } | {f"sum:band:{b}": F.count_if(named(band) == b) for b in bands}


def audit_of_counts(
    stats: Stats, fields: Sequence[str], value: str, band: str, bands: Sequence[str]
) -> list[tuple[str, str | None, float | None]] | None:
    """The (metric, field, value) rows that need no look at the stored rows.

    None if a measure is missing, or rows stand in a band that was not counted.
    """
    found = stats.measures
    if not found.keys() >= audit_measures(value, band, bands).keys():
        return None
    per_band: dict[str | None, int] = {b: found[f"sum:band:{b}"] or 0 for b in bands}
    per_band[None] = stats.nulls_of(band)
    if sum(per_band.values()) != stats.rows:
        return None
    average = found["sum:total"] / found["sum:valued"] if found["sum:valued"] else None
    return [
        ("rows", "*", stats.rows),
        *[("nulls", f, stats.nulls_of(f)) for f in fields],
        ("average", value, average),
        ("maximum", value, found["max:highest"]),
        *[("band_rows", b, n) for b, n in per_band.items() if n],
        ("rows_kept", "*", stats.rows),
    ]


def report_of(df: DataFrame, lines: Sequence[tuple[str, str | None, float | None]]) -> DataFrame:
    """Audit rows that are known already, as a report in the session of ``df``."""
    metric, names, amounts = zip(*lines, strict=True)
    kinds = {"metric": pa.string(), "field": pa.string(), "value": pa.float64()}
    columns = zip(kinds, (metric, names, amounts), strict=True)
    table = pa.table({c: pa.array(v, kinds[c]) for c, v in columns})
    return df.sparkSession.createDataFrame(table)


def duplicate_line(df: DataFrame, key: str, stored: Observation) -> DataFrame:
    """The duplicates of a key as a report row; ``stored`` gets the number of ``rows`` scanned."""
    per_key = df.groupBy(named(key)).agg(F.count(F.lit(1)).alias("copies"))
    both = per_key.agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicates"),
        F.coalesce(F.sum("copies"), F.lit(0)).alias("scanned"),
    )
    return both.observe(stored, F.max("scanned").alias("rows")).select(
        F.lit("duplicates").alias("metric"),
        F.lit(key).alias("field"),
        F.col("duplicates").cast("double").alias("value"),
    )


def rows_read_line(source: DataFrame, known: int | None) -> DataFrame:
    """The rows of the source as a report row, counted without reading a column if not known."""
    if known is not None:
        return report_of(source, [("rows_read", "*", known)])
    counted = source.select(F.lit(1)).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return counted.select(F.lit("rows_read").alias("metric"), F.lit("*").alias("field"), "value")


def passes(report: DataFrame) -> bool:
    """The publish gate: only an empty table fails. NULLs and duplicates are findings, no block."""
    counted = report.where(F.col("metric") == "rows").agg(F.max("value").alias("n")).first()
    return (counted["n"] or 0) > 0

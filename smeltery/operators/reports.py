"""Grouped reports, top-k and monitoring."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions import named, null_count, share
from smeltery.operators.rollup import roll_up


def row_distribution(df: DataFrame, by: str) -> DataFrame:
    """Row count of each value of ``by``."""
    return df.groupBy(named(by)).count()


def revenue_report(
    df: DataFrame, by: Sequence[str], value: str, count: str, total: str, average: str
) -> DataFrame:
    """Row count, sum and average per group, highest sum first, ties by group."""
    grouped = df.groupBy(*[named(c) for c in by]).agg(
        F.count(F.lit(1)).alias(count),
        F.sum(named(value)).alias(total),
        F.avg(named(value)).alias(average),
    )
    return grouped.orderBy(named(total).desc(), *[named(c).asc() for c in by])


def top_groups(df: DataFrame, by: str, value: str, out: str, k: int = 3) -> DataFrame:
    """The ``k`` groups with the highest sum, ties by group key, as a per-task top-k."""
    grouped = df.groupBy(named(by)).agg(F.sum(named(value)).alias(out))
    return grouped.orderBy(named(out).desc(), named(by).asc()).limit(k)


def latest_rows(df: DataFrame, loaded_at: str, ties: str | Sequence[str], k: int = 5) -> DataFrame:
    """The ``k`` rows loaded last; equal load times stand by the columns ``ties``.

    A first look at the timestamp column alone finds the k-th newest load time. It is a scalar
    subquery, so it becomes a pushed filter of the full-width scan, which then opens only the
    row groups that can hold one of the wanted rows. Rows without a load time sort last and stay
    eligible, as in a plain sort.
    """
    ts = named(loaded_at)
    newest = df.select(ts.alias("at")).orderBy(F.col("at").desc_nulls_last()).limit(k)
    kth_newest = newest.agg(F.min("at")).scalar()
    candidates = df.where(ts.isNull() | (ts >= kth_newest))
    by = [ties] if isinstance(ties, str) else ties
    return candidates.orderBy(ts.desc_nulls_last(), *[named(c).asc() for c in by]).limit(k)


def _on_day(df: DataFrame, loaded_at: str, day: date) -> Column:
    kind = df.schema[loaded_at].dataType
    start, end = F.lit(day).cast(kind), F.lit(day + timedelta(days=1)).cast(kind)
    return (named(loaded_at) >= start) & (named(loaded_at) < end)


def loaded_on(df: DataFrame, loaded_at: str, day: date) -> DataFrame:
    """Rows loaded on a day of the session time zone.

    A half-open range over the bare column, so that it reaches the scan and prunes row groups.
    """
    return df.where(_on_day(df, loaded_at, day))


def bronze_monitor(df: DataFrame, loaded_at: str, day: date) -> DataFrame:
    """Row count, rows loaded on ``day`` and the NULL count of every column, from one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(_on_day(df, loaded_at, day)).alias("loaded_rows"),
        *[null_count(named(c)).alias(c) for c in df.columns],
    )


def silver_metrics(df: DataFrame, value: str, score: str, at_least: float = 90) -> DataFrame:
    """Row count, revenue and quality share of the whole table, from one scan."""
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(named(value)).alias("revenue"),
        share(named(score) >= at_least).alias("quality_pct"),
    )


def silver_monitor(
    df: DataFrame, by: str, value: str, score: str, at_least: float = 90, k: int = 3
) -> DataFrame:
    """The whole-table metrics followed by the ``k`` groups with the highest revenue.

    One scan: the groups are aggregated first, their few rows are rolled up to the total, and a
    top-k keeps the total row and ``k`` groups.
    """
    per_group = df.groupBy(named(by).alias("group")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(named(score) >= at_least).alias("good"),
        F.sum(named(value)).alias("earned"),
    )
    rolled = roll_up(
        per_group,
        "group",
        "total_rows",
        F.sum("earned").alias("revenue"),
        F.try_divide(100.0 * F.sum("good"), F.sum("total_rows")).alias("quality_pct"),
    )
    ranked = rolled.orderBy(F.desc("is_total"), F.desc("revenue"), F.asc("group")).limit(k + 1)
    scope = F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.lit(by))
    return ranked.select(
        scope.alias("scope"), F.col("group").alias(by), "total_rows", "revenue", "quality_pct"
    )

"""Groups of a table and what adds up of each, and the reports that need no more than that."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions import named
from smeltery.operators.rollup import roll_up


def summarise(
    df: DataFrame, by: Sequence[str], value: str, score: str, at_least: float = 90
) -> DataFrame:
    """Per group: rows, rows of a good score, values that are there, their sum and the largest."""
    return df.groupBy(*[named(c) for c in by]).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(named(score) >= at_least).alias("good"),
        F.count(named(value)).alias("values"),
        F.sum(named(value)).alias("total"),
        F.max(named(value)).alias("largest"),
    )


def _added() -> list[Column]:
    sums = [F.sum(c).alias(c) for c in ("rows", "good", "values", "total")]
    return [*sums, F.max("largest").alias("largest")]


def added_up(summaries: DataFrame, by: Sequence[str]) -> DataFrame:
    """One summary of many: of several parts, or of coarser groups."""
    return summaries.groupBy(*[named(c) for c in by]).agg(*_added())


def revenue_report(
    summaries: DataFrame, by: Sequence[str], count: str, total: str, average: str
) -> DataFrame:
    """Row count, sum and average per group, highest sum first, ties by group."""
    groups = added_up(summaries, by).select(
        *[named(c) for c in by],
        F.col("rows").alias(count),
        F.col("total").alias(total),
        F.try_divide("total", "values").alias(average),
    )
    return groups.orderBy(named(total).desc(), *[named(c).asc() for c in by])


def top_groups(summaries: DataFrame, by: str, out: str, k: int = 3) -> DataFrame:
    """The ``k`` groups with the highest sum, ties by group key."""
    groups = added_up(summaries, [by]).select(named(by), F.col("total").alias(out))
    return groups.orderBy(named(out).desc(), named(by).asc()).limit(k)


def monitor(summaries: DataFrame, by: str, k: int = 3) -> DataFrame:
    """Row count, revenue and quality share of the whole table, then the ``k`` best groups."""
    groups = added_up(summaries, [by]).withColumnRenamed(by, "group")
    percent = F.try_divide(100.0 * F.sum("good"), F.sum("rows")).alias("quality_pct")
    rolled = roll_up(groups, "group", "rows", F.sum("total").alias("revenue"), percent)
    ranked = rolled.orderBy(F.desc("is_total"), F.desc("revenue"), F.asc("group")).limit(k + 1)
    scope = F.when(F.col("is_total") == 1, F.lit("total")).otherwise(F.lit(by))
    return ranked.select(
        scope.alias("scope"),
        F.col("group").alias(by),
        F.col("rows").alias("total_rows"),
        "revenue",
        "quality_pct",
    )

"""Row-wise refinement: no shuffle, one pass, everything inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.functions import ISO_DATE, banded, discounted, named, normalised_name, strict_date

Rules = Mapping[str, Column]


def stamp(df: DataFrame, **values: object) -> DataFrame:
    """Add (or replace) control columns that hold one literal each."""
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def every(rules: Rules) -> Column:
    """All rules ANDed; a rule that evaluates to NULL fails its row."""
    return reduce(and_, rules.values(), F.lit(True))


def clean(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that satisfy every named rule."""
    return df.where(every(rules))


def with_date_parts(
    df: DataFrame, text: str, date: str, year: str, month: str, pattern: str = ISO_DATE
) -> DataFrame:
    """Parse a text date and take its year and month; rows that do not parse keep NULLs."""
    parsed = df.withColumn(date, strict_date(named(text), pattern))
    return parsed.withColumns({year: F.year(named(date)), month: F.month(named(date))})


def with_discount(df: DataFrame, value: str, out: str, above: float, factor: float) -> DataFrame:
    return df.withColumn(out, discounted(named(value), above, factor))


def with_band(
    df: DataFrame, value: str, out: str, bands: Sequence[tuple[float, str]], top: str
) -> DataFrame:
    return df.withColumn(out, banded(named(value), bands, top))


def with_normalised_name(df: DataFrame, text: str, out: str) -> DataFrame:
    return df.withColumn(out, normalised_name(named(text)))

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column called exactly ``name``, also when the name holds dots or blanks."""
    return F.col("`" + name.replace("`", "``") + "`")


ISO_DATE = "yyyy-MM-dd"
# What the pattern accepts as text: four-digit years, and longer ones only with a sign.
ISO_DATE_TEXT = r"\A(\d{4}|-(?!0+-)\d{4,7}|\+\d{5,7})-\d{2}-\d{2}\z"


def strict_date(text: Column, pattern: str = ISO_DATE) -> Column:
    """Parse text to a date; anything that does not fit the pattern is NULL, in ANSI mode too.

    The usual pattern is checked as text and then parsed by the date cast, which is faster than
    the pattern parser and, unlike it, does not fail on far years.
    """
    if pattern != ISO_DATE:
        return F.try_to_date(text, pattern)
    return F.when(text.rlike(ISO_DATE_TEXT), text.try_cast("date"))


def discounted(value: Column, above: float, factor: float) -> Column:
    """``value * factor`` strictly above the threshold, else ``value`` unchanged."""
    return F.when(value > above, value * factor).otherwise(value)


def banded(value: Column, bands: Sequence[tuple[float, str]], top: str) -> Column:
    """The label of the first band whose inclusive upper bound holds ``value``, else ``top``.

    ``bands`` are (upper bound, label) in ascending order. NULL and NaN satisfy no bound and so
    get ``top``.
    """
    label = F.lit(top)
    for upper, name in reversed(bands):
        label = F.when(value <= upper, F.lit(name)).otherwise(label)
    return label


def normalised_name(text: Column) -> Column:
    """Outer blanks removed, first letter of every blank-separated word upper case."""
    return F.initcap(F.trim(text))


def null_count(column: Column) -> Column:
    """Number of NULLs in a group.

    Written as a difference of two plain counts, since Spark can answer both from Parquet footers.
    """
    return F.count(F.lit(1)) - F.count(column)


def share(condition: Column) -> Column:
    """Percentage of rows where ``condition`` is true; NULL over no rows."""
    return F.try_divide(100.0 * F.count_if(condition), F.count(F.lit(1)))

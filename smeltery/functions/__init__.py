"""Column expressions shared by the operators; all are built-in and stay in generated code."""

from smeltery.functions.columns import (
    ISO_DATE,
    banded,
    discounted,
    named,
    normalised_name,
    null_count,
    share,
    strict_date,
)

__all__ = [
    "ISO_DATE",
    "banded",
    "discounted",
    "named",
    "normalised_name",
    "null_count",
    "share",
    "strict_date",
]

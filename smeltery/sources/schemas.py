"""Additive schema evolution: new columns are appended, changed types are refused."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructField, StructType

from smeltery.functions import named


class SchemaConflict(ValueError):
    """A column arrives with another type than the table stores."""


def _by_name(schema: StructType) -> dict[str, StructField]:
    return {f.name.lower(): f for f in schema.fields}


def extended(known: StructType, incoming: StructType) -> StructType:
    """``known`` plus the columns only ``incoming`` has, all nullable.

    Names compare without case, as Spark resolves them. Every conflict is reported at once.
    """
    held = _by_name(known)
    conflicts = [
        f"{f.name}: table has {held[f.name.lower()].dataType.simpleString()}, "
        f"rows have {f.dataType.simpleString()}"
        for f in incoming.fields
        if f.name.lower() in held
        and not isinstance(f.dataType, NullType)
        and held[f.name.lower()].dataType.simpleString() != f.dataType.simpleString()
    ]
    if conflicts:
        raise SchemaConflict("; ".join(conflicts))
    added = [f for f in incoming.fields if f.name.lower() not in held]
    return StructType([StructField(f.name, f.dataType, True) for f in known.fields + added])


def aligned(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and spelling; missing ones are NULL."""
    present = _by_name(df.schema)
    return df.select(
        *[
            (
                named(present[f.name.lower()].name)
                if f.name.lower() in present
                else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )

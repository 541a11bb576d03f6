"""The identity of one run: its id, its timestamp and the day it counts as "today"."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Run:
    """Fixed once per run and stamped as literals.

    A stored row, its preview and its audit then always agree, and a task that is retried on
    another executor writes the same values again.
    """

    id: str
    ts: datetime
    as_of: date

    @classmethod
    def start(cls, spark: SparkSession) -> Run:
        """A fresh id, the current instant, and its date in the session time zone."""
        now = datetime.now(timezone.utc)
        today = spark.range(0, 1, 1, 1).select(F.lit(now).cast("date").alias("d")).first()["d"]
        return cls(str(uuid.uuid4()), now, today)

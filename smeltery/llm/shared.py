"""What several operators need: the shared folder, stored intermediates, words."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"

# Python works on so many rows of an Arrow batch at a time, which bounds its copies of long texts.
SLICE = 256

# A missing document id counts as an id below every other one.
NO_ID = -(1 << 63)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, label: str) -> str:
    """A new directory in the folder that all executors share (``spark.checkpoint.dir``).

    The folder is chosen here only where none is named and driver and executors are one process.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        base = tempfile.mkdtemp(prefix="smeltery-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/llm-{label}-{uuid.uuid4()}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written as Parquet in the shared folder and read back.

    A lost executor then costs a read, and expensive columns are computed once.
    """
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: str | Column = "text") -> Column:
    """UTF-8 bytes of a text; a missing text is an empty one."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def id_or_lowest(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column), F.lit(NO_ID)).cast("bigint")


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def decoded(value: bytes) -> str:
    return value.decode("utf-8", "replace")

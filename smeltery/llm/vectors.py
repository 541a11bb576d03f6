"""Integer vectors for the exact searches: packed rows, exact products, queries dealt over groups."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A vector of a larger squared length takes no part: a score of two would not fit a long for sure.
LARGEST = float(1 << 62)
# Sums of products are exact in double precision below this bound, whatever the order.
EXACT = float(1 << 53)


@dataclass(frozen=True)
class Shape:
    """How vectors are packed: ``dim`` numbers of ``width`` bytes, ordered as the vectors are.

    Numbers are written highest byte first and moved so that the smallest is zero; the order of the
    bytes is then that of the numbers, and equal bytes are equal vectors.
    """

    dim: int
    width: int

    @property
    def zero(self) -> np.uint64:
        return np.uint64(1 << (8 * self.width - 1))

    def raw(self, matrix: np.ndarray) -> bytes:
        moved = matrix.astype(np.int64).astype(np.uint64) + self.zero
        return moved.astype(f">u{self.width}").tobytes()

    def pack(self, matrix: np.ndarray) -> pa.Array:
        size = self.dim * self.width
        ends = np.arange(len(matrix) + 1, dtype=np.int32) * np.int32(size)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(self.raw(matrix))]
        return pa.Array.from_buffers(pa.binary(), len(matrix), buffers)

    def read(self, data: bytes) -> np.ndarray:
        numbers = np.frombuffer(data, f">u{self.width}").astype(np.uint64) - self.zero
        return numbers.astype(np.int64).reshape(-1, self.dim)

    def unpack(self, column: pa.Array | pa.ChunkedArray) -> np.ndarray:
        return self.read(b"".join(column.to_pylist()))


def products(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """All inner products of two blocks of integer vectors, exact, as 64-bit integers."""
    if not len(left) or not len(right):
        return np.zeros((len(left), len(right)), np.int64)
    a, b = left.astype(np.float64), right.astype(np.float64)
    most = np.sqrt((a * a).sum(axis=1).max() * (b * b).sum(axis=1).max())
    return (a @ b.T).astype(np.int64) if most < EXACT else left @ right.T


def squares(matrix: np.ndarray) -> np.ndarray:
    return (matrix.astype(np.float64) ** 2).sum(axis=1)


def integers(
    vectors: DataFrame, scale: int, vec_id: str, embedding: str, label: Column | None = None
) -> tuple[DataFrame, Shape | None]:
    """(vec_id, vec and, if asked for, label): every component x as floor(scale * x), packed.

    Left out are rows without id, vectors that are missing, empty or hold missing or non-finite
    components, those whose squared integer length is 2^62 or more, and those whose number of
    components is not the table's most frequent (the smaller, if tied). Of rows repeated under one
    id the smallest vector counts, then the smallest label. A missing label leaves a row out, where
    labels are asked for. Without usable rows the shape is None.
    """
    whole = lambda x: F.floor(x.cast("double") * scale)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    named = [] if label is None else [label.alias("label")]
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("given"), *named
    ).where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("given", finite), F.lit(False)))
    if label is not None:
        rows = rows.where("label IS NOT NULL")
    rows = rows.withColumn("vec", F.transform("given", whole)).drop("given")
    length = F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    rows = rows.where(length < LARGEST)
    sizes = rows.where(F.size("vec") > 0).groupBy(F.size("vec").alias("dim")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.greatest(F.array_max("vec"), -F.array_min("vec"))).alias("largest"),
    )
    most = sizes.orderBy(F.desc("n"), "dim").limit(1).first()
    if most is None:
        return rows.withColumn("vec", F.lit(b"")).limit(0), None
    width = next(w for w in (1, 2, 4, 8) if most["largest"] < 1 << (8 * w - 1))
    shape = Shape(most["dim"], width)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("vec").flatten().to_numpy(zero_copy_only=False)
            at = batch.schema.get_field_index("vec")
            yield batch.set_column(at, "vec", shape.pack(flat.reshape(-1, shape.dim)))

    kind = "" if label is None else f"label {rows.schema['label'].dataType.simpleString()}, "
    packed = rows.where(F.size("vec") == shape.dim).mapInArrow(
        pack, f"vec_id BIGINT, {kind}vec BINARY"
    )
    if label is None:
        return packed.groupBy("vec_id").agg(F.min("vec").alias("vec")), shape
    first = F.min(F.struct("vec", "label")).alias("first")
    return packed.groupBy("vec_id").agg(first).select("vec_id", "first.label", "first.vec"), shape


def ranked(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], k: int) -> DataFrame:
    """The first k rows of each group; Spark cuts each task's rows to k before it shuffles."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", at).where(F.col("rank") <= k)


Work = Callable[[pa.Table, pa.Table], Iterator[pa.RecordBatch] | pa.Table]


def met(
    asking: DataFrame, held: DataFrame, by: str, deal: str, most: int, work: Work, schema: str
) -> DataFrame:
    """``work(asking rows, held rows)`` for every value of ``by`` that both sides have.

    The asking rows of a value are dealt by a hash of ``deal`` over groups of about ``most``, each
    with all held rows of that value. So no group grows with the rows that ask; what is held of one
    value must be bounded by the caller.
    """
    counts = asking.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / most).cast("int").alias("groups"))
    group = F.pmod(F.xxhash64(deal), F.col("groups")).cast("int").alias("group")
    left = asking.join(counts, by).select(*asking.columns, group)
    copies = F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group")
    right = held.join(counts, by).select(*held.columns, copies)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        return work(a, b)

    return (
        left.groupBy(by, "group").cogroup(right.groupBy(by, "group")).applyInArrow(run, schema)
    )

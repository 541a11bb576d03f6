"""Hard negatives from blocks in the order of a Hilbert curve, chosen by their zone maps.

Candidates are sorted by label and, within a label, by the place of their vector on a Hilbert curve
through all dimensions, and cut into blocks. A block is one Parquet row: its zone map (smallest and
largest number of every dimension, smallest and largest label) in columns of its own, and its rows
packed in others, so that zone maps are read without the rows. Further levels of zone maps cover
runs of neighbouring blocks, as the order makes them alike.

Interval arithmetic over a zone map bounds the scores of an anchor with everything in the block from
both sides. An anchor's windows of scores, one for every score of its positives, say which blocks it
has to read: those that may hold another label, and a score in the window that is not below the
window's last place found so far. Places are first taken from the anchor's most promising block, so
that the second round reads only the blocks whose bounds reach them. Positives are found in the same
way among the blocks of the anchor's label.

Anchors visit zone maps and blocks in groups of bounded size. Scores are exact integers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import stored
from smeltery.llm.vectors import Shape, integers, met, products, ranked, squares

# Rows of a block, blocks written by one task, anchors that meet a block in one group.
BLOCK = 1024
BLOCKS = 16
ASKING = 4096
# Bits of a place on the curve, over all dimensions, and most in one of them.
CURVE_BITS = 256
MOST_BITS = 8
# A node of the zone maps above the tasks covers 2^UP of the level below it.
UP = 6

ZONE = "low BINARY, high BINARY, label_low BIGINT, label_high BIGINT"


def hilbert(cells: np.ndarray, bits: int) -> list[bytes]:
    """Places on the Hilbert curve of points given by ``bits`` bits in every dimension, as bytes.

    The bytes sort as the places do. All points go through the rotations of a level of the curve
    together: a level is one bit of every dimension, from the highest.
    """
    points, dims = cells.astype(np.uint32).T.copy(), cells.shape[1]
    for level in range(bits - 1, 0, -1):
        bit = np.uint32(1 << level)
        lower = np.uint32((1 << level) - 1)
        for d in range(dims):
            upper = (points[d] & bit) > 0
            swapped = np.where(upper, np.uint32(0), (points[0] ^ points[d]) & lower)
            points[0] ^= np.where(upper, lower, swapped)
            points[d] ^= swapped
    for d in range(1, dims):
        points[d] ^= points[d - 1]
    flip = np.zeros(points.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(points[-1] & np.uint32(1 << level), np.uint32((1 << level) - 1), np.uint32(0))
    points ^= flip
    levels = [(points >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(levels).T.astype(np.uint8), axis=1)
    return [row.tobytes() for row in packed]


def ranges(rows: DataFrame, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """The smallest and largest number of every dimension; tasks send the driver one pair each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for batch in batches:
            if batch.num_rows:
                matrix = shape.unpack(batch.column(0))
                if low is not None:
                    matrix = np.vstack([matrix, low, high])
                low, high = matrix.min(axis=0), matrix.max(axis=0)
        if low is not None:
            columns = [pa.array(np.arange(shape.dim)), pa.array(low), pa.array(high)]
            yield pa.record_batch(columns, names=["d", "low", "high"])

    each = rows.select("vec").mapInArrow(run, "d BIGINT, low BIGINT, high BIGINT")
    found = each.groupBy("d").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("d").toArrow()
    return found["low"].to_numpy(), found["high"].to_numpy()


def with_place(rows: DataFrame, shape: Shape) -> DataFrame:
    """The rows with ``place``, where the vector stands on the curve."""
    low, high = ranges(rows, shape)
    bits = int(max(1, min(MOST_BITS, CURVE_BITS // shape.dim)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = shape.unpack(batch.column("vec")).astype(np.float64)
            spread = np.maximum(high.astype(np.float64) - low, 1)
            cells = np.floor((matrix - low) / spread * (1 << bits)).clip(0, (1 << bits) - 1)
            place = pa.array(hilbert(cells.astype(np.uint32), bits), pa.binary())
            yield pa.record_batch([*batch.columns, place], [*batch.schema.names, "place"])

    return rows.mapInArrow(run, "vec_id BIGINT, label BIGINT, vec BINARY, place BINARY")


def blocks(rows: DataFrame, shape: Shape, tasks: int) -> DataFrame:
    """(part, block, zone map, rows): the candidates in blocks, in the order of label and curve.

    A row with very many neighbours of one label and place stands in a block like any other, as ids
    continue the order.
    """
    order = ["label", "place", "vec_id"]
    laid = with_place(rows, shape).repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= BLOCK:
                table = pa.Table.from_batches(held)
                yield row_of(part, number, table.slice(0, BLOCK))
                held, number = table.slice(BLOCK).to_batches(), number + 1
        table = pa.Table.from_batches(held) if held else None
        if table is not None and table.num_rows:
            yield row_of(part, number, table)

    def row_of(part: int, number: int, table: pa.Table) -> pa.RecordBatch:
        matrix = shape.unpack(table["vec"])
        labels = table["label"].to_numpy()
        columns = {
            "part": pa.array([part], pa.int64()),
            "block": pa.array([part << 32 | number], pa.int64()),
            "low": shape.pack(matrix.min(axis=0)[None]),
            "high": shape.pack(matrix.max(axis=0)[None]),
            "label_low": pa.array([labels.min()], pa.int64()),
            "label_high": pa.array([labels.max()], pa.int64()),
            "ids": pa.array([table["vec_id"].to_numpy()], pa.list_(pa.int64())),
            "labels": pa.array([labels], pa.list_(pa.int64())),
            "vecs": pa.array([shape.raw(matrix)], pa.binary()),
        }
        return pa.RecordBatch.from_pydict(columns)

    return laid.select("vec_id", "label", "vec").mapInArrow(
        run,
        f"part BIGINT, block BIGINT, {ZONE}, ids ARRAY<BIGINT>, labels ARRAY<BIGINT>, vecs BINARY",
    )


def zone_levels(laid: DataFrame, shape: Shape, tasks: int) -> list[DataFrame]:
    """(over, node, zone map) of every level, from the top, whose ``over`` is 0, to the blocks."""
    spans = ["low", "high", "label_low", "label_high"]

    def cover(table: pa.Table) -> pa.Table:
        low, high = shape.unpack(table["low"]).min(axis=0), shape.unpack(table["high"]).max(axis=0)
        return pa.table(
            {
                "node": table["over"].slice(0, 1),
                "low": shape.pack(low[None]),
                "high": shape.pack(high[None]),
                "label_low": pa.array([table["label_low"].to_numpy().min()]),
                "label_high": pa.array([table["label_high"].to_numpy().max()]),
            }
        )

    at = stored(laid.select(F.col("part").alias("over"), F.col("block").alias("node"), *spans), "zones")
    levels, nodes = [at], tasks
    while True:
        above = at.groupBy("over").applyInArrow(cover, f"node BIGINT, {ZONE}")
        over = F.lit(0).cast("bigint") if nodes <= 1 << UP else F.shiftright("node", UP)
        at = stored(above.select(over.alias("over"), "node", *spans), "zones")
        levels.insert(0, at)
        if nodes <= 1 << UP:
            return levels
        nodes = -(-nodes // (1 << UP))


def bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest scores of every query with anything between ``low`` and ``high``.

    Interval arithmetic: a positive number of the query meets the high end for the largest score, a
    negative one the low end. Rounding moves both a little outwards.
    """
    plus, minus = np.maximum(queries, 0).astype(np.float64), np.minimum(queries, 0).astype(np.float64)
    low, high = low.astype(np.float64), high.astype(np.float64)
    least, most = plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T
    reach = np.sqrt(squares(queries)[:, None] * np.maximum(low**2, high**2).sum(axis=1))
    slack = 1e-9 * reach + 1e-6
    return least - slack, most + slack


# --- searching

ASK = "aid BIGINT, label BIGINT, vec BINARY, least ARRAY<BIGINT>, most ARRAY<BIGINT>"
LEAST, MOST = -(1 << 62), 1 << 62
WINDOWS = pa.list_(pa.field("element", pa.int64()))


def _windows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of the anchor, least, most) of all windows."""
    least, most = table["least"].to_pylist(), table["most"].to_pylist()
    row = np.repeat(np.arange(len(least)), [len(x) for x in least])
    flat = lambda lists: np.array([x for some in lists for x in some], np.int64)
    return row, flat(least), flat(most)


def chosen(ask: DataFrame, levels: list[DataFrame], shape: Shape, same: bool, best: bool) -> DataFrame:
    """The anchors with the blocks (``node``) their windows must read, or their ``best`` one alone.

    A window [least, most] needs a block that may hold a score in it and a row of the anchor's label
    (``same``) or of another one. Anchors start at ``node`` 0, stored like it, so that every join is
    on a column.
    """

    def choose(asking: pa.Table, zones: pa.Table) -> pa.Table:
        zones = zones.sort_by("node")
        queries = shape.unpack(asking["vec"])
        lowest, highest = bounds(queries, shape.unpack(zones["low"]), shape.unpack(zones["high"]))
        first, last = zones["label_low"].to_numpy(), zones["label_high"].to_numpy()
        label = asking["label"].to_numpy()[:, None]
        fits = (first <= label) & (label <= last) if same else (first != label) | (last != label)
        row, least, most = _windows(asking)
        meets = (highest[row] >= least[:, None]) & (lowest[row] <= most[:, None]) & fits[row]
        need = np.zeros_like(fits)
        np.logical_or.at(need, row, meets)
        if best:
            promise = np.where(need, highest, -np.inf)
            only = np.arange(promise.shape[1]) == promise.argmax(axis=1)[:, None]
            need &= only
        at, zone = np.nonzero(need)
        taken = asking.select(["aid", "label", "vec", "least", "most"]).take(pa.array(at))
        return pa.table(
            {
                **{c: taken[c] for c in ("aid", "label", "vec")},
                **{c: taken[c].cast(WINDOWS) for c in ("least", "most")},
                "node": zones["node"].take(pa.array(zone)),
            }
        )

    at = stored(ask.withColumn("node", F.lit(0).cast("bigint")), "zones-ask")
    for level in levels:
        visits = at.withColumnRenamed("node", "over")
        at = stored(met(visits, level, "over", "aid", ASKING, choose, ASK + ", node BIGINT"), "zones-chosen")
    return at


def read(visits: DataFrame, laid: DataFrame, shape: Shape, same: bool, k: int) -> DataFrame:
    """(aid, most, vec_id, score): the first k rows of a block in each window of its visitors."""

    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        ids = held["ids"].combine_chunks().flatten().to_numpy()
        labels = held["labels"].combine_chunks().flatten().to_numpy()
        matrix = shape.unpack(held["vecs"])
        queries, label = shape.unpack(asking["vec"]), asking["label"].to_numpy()
        score = products(queries, matrix)
        row, least, most = _windows(asking)
        out: list[tuple[np.ndarray, ...]] = []
        windows = np.searchsorted(row, np.arange(len(queries) + 1))
        for q in range(len(queries)):
            fits = np.flatnonzero((labels == label[q]) == same)
            fits = fits[score[q, fits] >= least[windows[q] : windows[q + 1]].min()]
            order = fits[np.lexsort((ids[fits], -score[q, fits]))]
            sorted_scores = -score[q, order]
            for w in range(windows[q], windows[q + 1]):
                a = np.searchsorted(sorted_scores, -most[w], "left")
                b = np.searchsorted(sorted_scores, -least[w], "right")
                rows = order[a : min(b, a + k)]
                same_size = np.ones(len(rows), np.int64)
                out.append((q * same_size, most[w] * same_size, ids[rows], score[q, rows]))
        q, top, found, value = (np.concatenate(c) for c in zip(*out, strict=True))
        aid = asking["aid"].to_numpy()
        return pa.table({"aid": aid[q], "most": top, "vec_id": found, "score": value})

    packed = laid.select(F.col("block").alias("node"), "ids", "labels", "vecs")
    return met(visits, packed, "node", "aid", ASKING, run, "aid BIGINT, most BIGINT, vec_id BIGINT, score BIGINT")


def in_windows(
    ask: DataFrame, levels: list[DataFrame], laid: DataFrame, shape: Shape, same: bool, k: int
) -> DataFrame:
    """(aid, most, vec_id, score): the first k rows of every window of ``ask``, in two rounds."""
    first = chosen(ask, levels, shape, same, True)
    found = stored(read(first, laid, shape, same, k), "zones-found")
    # A window that is full needs nothing below its last place.
    place = found.groupBy("aid", "most").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    place = place.where(F.col("n") >= k).groupBy("aid").agg(
        F.map_from_entries(F.collect_list(F.struct("most", "last"))).alias("last")
    )
    raised = F.transform(
        F.arrays_zip("least", "most"),
        lambda w: F.greatest(w["least"], F.coalesce(F.try_element_at("last", w["most"]), w["least"])),
    )
    more = ask.join(place, "aid", "left").select("aid", "label", "vec", raised.alias("least"), "most")
    visits = chosen(more, levels, shape, same, False)
    visits = visits.join(first.select("aid", "node"), ["aid", "node"], "left_anti")
    found = found.unionByName(read(stored(visits, "zones-visits"), laid, shape, same, k))
    return ranked(found, ["aid", "most"], [F.desc("score"), "vec_id"], k).drop("rank")


def mine(
    vectors: DataFrame,
    positives: int = 5,
    negatives: int = 10,
    anchor_every: int = 100,
    scale: int = 256,
    least: int = 30,
    most: int = 90,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: Column | str = "label",
) -> DataFrame:
    """Hard negatives of every anchor and positive, highest integer inner product first.

    Anchors are the rows whose id is divisible by ``anchor_every``; an anchor's positives its first
    other rows of the same label; the negatives of a positive the first rows of other labels whose
    score is between ``least`` and ``most`` percent of the positive's. Ties go to the smaller id.
    Columns ``anchor_id``, ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``; a window without rows gives none, as does an empty table. ``label`` is an
    integer column. See ``vectors.integers`` for rows that take no part and for repeated ids; zero
    vectors take part. Other columns are not read.
    """
    given = (F.col(label) if isinstance(label, str) else label).cast("bigint")
    clean, shape = integers(vectors, scale, vec_id, embedding, given)
    if shape is None:
        empty = (
            "anchor_id BIGINT, positive_id BIGINT, rank INT, negative_id BIGINT, "
            "positive_score BIGINT, negative_score BIGINT"
        )
        return vectors.sparkSession.createDataFrame([], empty)
    clean = stored(clean, "zones-vectors")
    # Equal rows of a label score alike, so only those of the smallest ids can be among the first.
    useful = max(positives + 1, negatives)
    kept = stored(
        ranked(clean, ["label", "vec"], ["vec_id"], useful).select("vec_id", "label", "vec"), "zones-rows"
    )
    tasks = max(1, -(-kept.count() // (BLOCK * BLOCKS)))
    laid = stored(blocks(kept, shape, tasks), "zones-blocks")
    levels = zone_levels(laid, shape, tasks)
    # Anchors with equal rows ask once.
    anchors = clean.where(F.pmod("vec_id", F.lit(anchor_every)) == 0)
    askers = anchors.groupBy("label", "vec").agg(F.min("vec_id").alias("aid"))
    askers = stored(askers, "zones-askers")
    bounds_of = lambda low, high: [F.array(F.lit(low).cast("bigint")).alias("least"), F.array(F.lit(high).cast("bigint")).alias("most")]
    ask = askers.select("aid", "label", "vec", *bounds_of(LEAST, MOST))
    alike = in_windows(ask, levels, laid, shape, True, positives + 1)
    pairs = anchors.join(askers, ["label", "vec"]).select(F.col("vec_id").alias("anchor_id"), "aid")
    pairs = pairs.join(alike, "aid").where(F.col("vec_id") != F.col("anchor_id"))
    pairs = ranked(pairs, ["anchor_id"], [F.desc("score"), "vec_id"], positives).select(
        "aid", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
    )
    pairs = stored(pairs, "zones-pairs")
    # least * p <= 100 * n <= most * p, in whole numbers; empty for a negative p.
    lowest = F.ceil(F.col("positive_score").cast("decimal(38,0)") * least / 100).cast("bigint")
    top = F.floor(F.col("positive_score").cast("decimal(38,0)") * most / 100).cast("bigint")
    windows = pairs.select("aid", "positive_score", lowest.alias("low"), top.alias("top")).where("low <= top")
    # Positives of neighbouring scores may end at the same number; the first of them is the wider.
    per_top = windows.groupBy("aid", "top").agg(F.min("low").alias("low"))
    wanted = per_top.groupBy("aid").agg(F.collect_list(F.struct("low", "top")).alias("w"))
    ask = askers.join(wanted, "aid").select("aid", "label", "vec", F.col("w.low").alias("least"), F.col("w.top").alias("most"))
    hard = in_windows(stored(ask, "zones-windows"), levels, laid, shape, False, negatives)
    ends = pairs.withColumns({"low": lowest, "top": top})
    found = ends.join(hard.withColumnRenamed("most", "top"), ["aid", "top"]).where(F.col("score") >= F.col("low"))
    return ranked(found, ["anchor_id", "positive_id"], [F.desc("score"), "vec_id"], negatives).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        F.col("vec_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )

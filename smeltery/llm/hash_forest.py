"""Nearest neighbours by a forest of hash-prefix trees.

Each tree gives a vector a long bit string. The first bits walk down a binary tree of hyperplanes,
each through the median of a bounded sample, so that prefixes of one length hold equally many rows;
further bits are random hyperplanes. Sorted by that string, the rows of a prefix stand together. A
query starts at its longest prefix and goes up, in all trees at once, until the rows under its
prefixes number enough; then it is compared exactly with all of them.

How many rows are enough is measured, not guessed: a bounded set of probe queries is answered by
brute force over all rows, and the number is the smallest that finds the wanted share of their
true neighbours, whatever the vectors look like. The probes go as deep as the search does, also
where it goes on below the counted prefixes in each tree by itself.

The sorted arrays are cut into segments of bounded size, by prefix and, where more rows share a
prefix than a segment holds, by a hash of the row. A query visits the segments under its prefix;
a segment that very many queries visit is repeated, each time for a bounded part of them.
Equal vectors are one row of the index; their ids are told apart at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.shared import stored

# Bits of a hash string; the first ones are fitted, and counted per prefix by the driver.
BITS = 48
COUNTED = 14
EPSILON = float(np.finfo(np.float64).eps)
# Rows the hyperplanes are fitted on, fewest of them at a fitted node, and probe queries.
SAMPLE = 16_384
LEAST = 64
PROBES = 128
# Rows of a segment, and queries it is compared with in one group.
SEGMENT = 16_384
ASKING = 16_384
# Rows of the Arrow batches that tasks hand on.
ROWS = 8192


@dataclass(frozen=True)
class Forest:
    """Hyperplanes by tree: ``nodes[t, i]`` for node i of the fitted levels, then ``flat[t]``."""

    nodes: np.ndarray  # trees x 2^levels x dim
    cuts: np.ndarray  # trees x 2^levels
    flat: np.ndarray  # trees x (BITS - levels) x dim
    levels: int

    @property
    def trees(self) -> int:
        return len(self.nodes)

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        """(rows, trees) hash strings, first bit highest of the BITS bits."""
        out = np.zeros((len(vectors), self.trees), np.int64)
        for t in range(self.trees):
            node = np.ones(len(vectors), np.int64)
            for _ in range(self.levels):
                side = np.einsum("ij,ij->i", vectors, self.nodes[t][node]) > self.cuts[t][node]
                node = 2 * node + side
            rest = vectors @ self.flat[t].T > 0
            code = node - (1 << self.levels)
            for i in range(rest.shape[1]):
                code = 2 * code + rest[:, i]
            out[:, t] = code
        return out


def fit(sample: np.ndarray, trees: int, seed: int) -> Forest:
    """Random directions, cut at the sample's median; as many levels as the sample supports."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    levels = int(max(0, min(COUNTED, np.floor(np.log2(max(1, len(sample) / LEAST))))))
    nodes = rng.standard_normal((trees, 1 << levels, dim))
    cuts = np.zeros((trees, 1 << levels))
    for t in range(trees):
        node = np.ones(len(sample), np.int64)
        for _ in range(levels):
            along = np.einsum("ij,ij->i", sample, nodes[t][node])
            order = np.lexsort((along, node))
            starts = np.flatnonzero(np.r_[True, np.diff(node[order]) != 0])
            for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
                cuts[t][node[order[a]]] = np.median(along[order[a:b]])
            node = 2 * node + (along > cuts[t][node])
    return Forest(nodes, cuts, rng.standard_normal((trees, BITS - levels, dim)), levels)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.float64, copy=False).reshape(-1, dim)


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, vec) of the vectors that take part, one per id.

    Left out are vectors that are missing, zero, or hold missing or non-finite components, rows
    without id, and vectors whose length is not the table's most frequent (the smaller, if tied).
    Of rows repeated under one id the smallest vector counts.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("vec_id"),
        F.col(embedding).cast("array<double>").alias("vec"),
    ).where(
        F.col("vec_id").isNotNull()
        & F.coalesce(F.forall("vec", finite) & F.exists("vec", lambda x: x != 0), F.lit(False))
    )
    sizes = rows.groupBy(F.size("vec").alias("dim")).agg(F.count(F.lit(1)).alias("n"))
    best = sizes.orderBy(F.desc("n"), "dim").limit(1)
    first = best.first()
    dim = first["dim"] if first else 0
    rows = rows.where(F.size("vec") == dim)
    return rows.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def _top(by: list[str], order: list[Column], k: int) -> Column:
    return F.row_number().over(Window.partitionBy(*by).orderBy(*order)) <= k


def _ranked(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark cuts each task's rows to k before it shuffles."""
    at = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("rank", at).where(F.col("rank") <= k)


def _sampled(df: DataFrame, rows: int, total: int, salt: int) -> DataFrame:
    """About ``rows`` rows, the same ones however the table is partitioned; all if it has fewer."""
    share = min(1.0, rows / max(1, total))
    return df.where(F.pmod(F.xxhash64(F.lit(salt), "cid"), F.lit(1 << 30)) < int(share * (1 << 30)))


def search(
    vectors: DataFrame,
    k: int = 20,
    query_every: int = 20,
    trees: int = 8,
    recall: float = 0.95,
    seed: int = 11,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k candidates of largest inner product for every query, nearest first.

    Queries are the rows whose id is divisible by ``query_every``, candidates all rows but the
    query's own. Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the
    smaller id. See ``usable`` for the vectors that take no part. ``recall`` is what the probe
    queries must reach; a table that is empty or has one usable vector gives no rows.
    """
    clean = stored(usable(vectors, vec_id, embedding), "vectors")
    spark = vectors.sparkSession
    # Of equal vectors a query needs the k + 1 smallest ids at most, its own among them.
    members = _ranked(clean, ["vec"], [F.col("vec_id")], k + 1)
    ids = F.array_sort(F.collect_list("vec_id")).alias("ids")
    grouped = members.groupBy("vec").agg(ids)
    asked = clean.where(F.pmod("vec_id", F.lit(query_every)) == 0)
    asking = asked.select("vec").distinct().withColumn("is_query", F.lit(True))
    classes = grouped.join(asking, "vec", "left").select(
        F.col("ids")[0].alias("cid"), "vec", "ids", F.coalesce("is_query", F.lit(False)).alias("is_query")
    )
    classes = stored(classes, "vector-classes")
    total = classes.count()
    empty = "query_id BIGINT, rank INT, vec_id BIGINT, score DOUBLE"
    if total == 0:
        return spark.createDataFrame([], empty)
    sample = _sampled(classes.select("cid", "vec"), SAMPLE, total, seed).orderBy("cid").toArrow()
    dim = len(classes.select("vec").first()["vec"])
    forest = fit(_matrix(sample["vec"].combine_chunks(), dim), trees, seed)
    coded = stored(with_codes(classes, forest, dim), "codes")
    counts = prefix_counts(coded, trees)
    enough = rows_needed(coded, counts, forest, dim, k, recall, total, seed)
    found = candidates(coded, counts, trees, dim, k, enough, total)
    return expanded(found, coded, clean, asked, k)


def with_codes(classes: DataFrame, forest: Forest, dim: int) -> DataFrame:
    shipped = classes.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = shipped.value.codes(_matrix(batch.column(1), dim))
            ends = pa.array(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1])
            column = pa.ListArray.from_arrays(ends, pa.array(codes.ravel()))
            yield pa.record_batch([*batch.columns, column], [*batch.schema.names, "codes"])

    return classes.mapInArrow(
        run, "cid BIGINT, vec ARRAY<DOUBLE>, ids ARRAY<BIGINT>, is_query BOOLEAN, codes ARRAY<BIGINT>"
    )


def prefix_counts(coded: DataFrame, trees: int) -> list[np.ndarray]:
    """Rows under each prefix of each length up to COUNTED: [length][tree, prefix].

    The driver gets at most trees x 2^COUNTED numbers, however many rows there are.
    """
    each = coded.select(F.posexplode("codes").alias("tree", "code"))
    prefix = F.shiftright("code", BITS - COUNTED).alias("prefix")
    rows = each.groupBy("tree", prefix).agg(F.count(F.lit(1)).alias("n")).toArrow()
    counts = np.zeros((trees, 1 << COUNTED), np.int64)
    counts[rows["tree"].to_numpy(), rows["prefix"].to_numpy()] = rows["n"].to_numpy()
    levels = [counts]
    for _ in range(COUNTED):
        levels.insert(0, levels[0].reshape(trees, -1, 2).sum(axis=2))
    return levels


def under(counts: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
    """(queries, lengths) rows under the query's prefix, over all trees."""
    trees = np.arange(codes.shape[1])
    return np.stack(
        [c[trees, codes >> (BITS - x)].sum(axis=1) for x, c in enumerate(counts)], axis=1
    )


def ascended(counts: list[np.ndarray], codes: np.ndarray, enough: int) -> np.ndarray:
    """The longest prefix length, the same in all trees, that holds enough rows; 0 if none does."""
    reached = under(counts, codes) >= enough
    lengths = np.arange(len(counts))
    return np.where(reached, lengths, 0).max(axis=1)


def deeper_counts(coded: DataFrame, codes: np.ndarray) -> np.ndarray:
    """[probe, tree, i] rows that share COUNTED + i bits or more with the probe.

    A row is compared with the probes in the trees where it has the counted prefix of one of them.
    The driver gets at most probes x trees x BITS numbers, however many rows there are.
    """
    trees, depths = codes.shape[1], BITS - COUNTED + 1
    near = np.zeros((trees, 1 << COUNTED), bool)
    near[np.arange(trees), codes >> (BITS - COUNTED)] = True
    shipped = coded.sparkSession.sparkContext.broadcast((codes, near))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, near = shipped.value
        found = np.zeros((len(codes) * trees, depths), np.int64)
        for batch in batches:
            flat = batch.column(0).flatten().to_numpy().reshape(-1, trees)
            for t in range(trees):
                rows = flat[near[t][flat[:, t] >> (BITS - COUNTED)], t]
                for a in range(0, len(rows), ROWS):
                    differ = np.bitwise_xor(codes[:, t, None], rows[None, a : a + ROWS])
                    shared = BITS - np.frexp(differ.astype(np.float64))[1] - COUNTED
                    probe, row = np.nonzero(shared >= 0)
                    np.add.at(found, (probe * trees + t, shared[probe, row]), 1)
        place, depth = np.nonzero(found)
        columns = [pa.array(place), pa.array(depth), pa.array(found[place, depth])]
        yield pa.record_batch(columns, names=["place", "depth", "n"])

    each = coded.select("codes").mapInArrow(run, "place BIGINT, depth BIGINT, n BIGINT")
    rows = each.groupBy("place", "depth").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(codes) * trees, depths), np.int64)
    counts[rows["place"].to_numpy(), rows["depth"].to_numpy()] = rows["n"].to_numpy()
    return counts[:, ::-1].cumsum(axis=1)[:, ::-1].reshape(len(codes), trees, depths)


def reached(held: np.ndarray, deeper: np.ndarray, enough: int, k: int) -> np.ndarray:
    """[probe, tree] the prefix length the search compares, by ``under`` and ``deeper_counts``.

    Where a prefix is dealt over chunks the search stops no deeper than here, as a chunk holds fewer.
    """
    length = np.where(held >= enough, np.arange(held.shape[1]), 0).max(axis=1)
    further = np.where(deeper >= max(enough, k + 1), np.arange(deeper.shape[2]), 0).max(axis=2)
    return length[:, None] + np.where(length[:, None] >= COUNTED, further, 0)


def rows_needed(
    coded: DataFrame,
    counts: list[np.ndarray],
    forest: Forest,
    dim: int,
    k: int,
    recall: float,
    total: int,
    seed: int,
) -> int:
    """The fewest rows under a query's prefixes that find ``recall`` of the probes' neighbours."""
    asking = coded.where("is_query")
    n = asking.count()
    probes = _sampled(asking.select("cid", "vec", "codes"), PROBES, n, seed + 1).orderBy("cid").toArrow()
    if probes.num_rows == 0:
        return total * forest.trees
    ids = probes["cid"].to_numpy()
    queries = _matrix(probes["vec"].combine_chunks(), dim)
    codes = np.stack(probes["codes"].to_pylist())
    shipped = coded.sparkSession.sparkContext.broadcast((ids, queries, codes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, codes = shipped.value
        for batch in batches:
            cids = batch.column(0).to_numpy()
            scores = queries @ _matrix(batch.column(1), dim).T
            scores[ids[:, None] == cids[None, :]] = -np.inf
            best = np.argpartition(-scores, min(k, len(cids)) - 1, axis=1)[:, :k]
            flat = batch.column(2).flatten().to_numpy().reshape(len(cids), -1)
            # The longest prefix that probe and row share in each tree.
            differ = np.bitwise_xor(codes[:, None, :], flat[best])
            shared = BITS - np.frexp(differ.astype(np.float64))[1]
            ends = np.arange(best.size + 1, dtype=np.int32) * shared.shape[2]
            rows = np.repeat(np.arange(len(ids)), best.shape[1])
            value = np.take_along_axis(scores, best, axis=1)
            yield pa.record_batch(
                [
                    pa.array(rows, pa.int64()),
                    pa.array(value.ravel(), pa.float64()),
                    pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(shared.ravel().astype(np.int64))
                    ),
                ],
                names=["probe", "score", "shared"],
            )

    compared = coded.select("cid", "vec", "codes").mapInArrow(
        run, "probe BIGINT, score DOUBLE, shared ARRAY<BIGINT>"
    )
    best = [F.desc("score"), F.array_max("shared").desc()]
    true = _ranked(compared, ["probe"], best, k).where(F.col("score") > float("-inf")).toArrow()
    probe = true["probe"].to_numpy()
    shared = true["shared"].combine_chunks().flatten().to_numpy().reshape(-1, forest.trees)
    held, deeper = under(counts, codes), deeper_counts(coded, codes)
    for enough in sorted({int(x) for x in np.geomspace(min(total, 256), total * forest.trees, 60)}):
        lengths = reached(held, deeper, enough, k)
        if len(probe) == 0 or np.mean((shared >= lengths[probe]).any(axis=1)) >= recall:
            return enough
    return total * forest.trees


def visited(
    counts: list[np.ndarray], codes: np.ndarray, enough: int, cut: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix length of each query, and by tree its first segment and the one after its last."""
    lengths = ascended(counts, codes, enough)
    up = np.maximum(0, cut - lengths)[:, None]
    first = codes >> (BITS - cut) >> up << up
    return lengths, first, first + (1 << up)


def visitors(
    coded: DataFrame, counts: list[np.ndarray], trees: int, enough: int, cut: int
) -> np.ndarray:
    """[tree, segment] queries that visit the segment.

    Tasks add up where visits begin and end, so the driver gets at most 2 x trees x 2^COUNTED
    numbers, however many queries there are.
    """
    shipped = coded.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        change = np.zeros((trees, (1 << cut) + 1), np.int64)
        for batch in batches:
            codes = batch.column(0).flatten().to_numpy().reshape(-1, trees)
            _, first, after = visited(shipped.value, codes, enough, cut)
            for t in range(trees):
                np.add.at(change[t], first[:, t], 1)
                np.add.at(change[t], after[:, t], -1)
        tree, segment = np.nonzero(change)
        columns = [pa.array(tree), pa.array(segment), pa.array(change[tree, segment])]
        yield pa.record_batch(columns, names=["tree", "segment", "n"])

    asking = coded.where("is_query").select("codes")
    changes = asking.mapInArrow(run, "tree BIGINT, segment BIGINT, n BIGINT")
    rows = changes.groupBy("tree", "segment").agg(F.sum("n").alias("n")).toArrow()
    change = np.zeros((trees, (1 << cut) + 1), np.int64)
    change[rows["tree"].to_numpy(), rows["segment"].to_numpy()] = rows["n"].to_numpy()
    return change.cumsum(axis=1)[:, :-1]


def candidates(
    coded: DataFrame,
    counts: list[np.ndarray],
    trees: int,
    dim: int,
    k: int,
    enough: int,
    total: int,
) -> DataFrame:
    """(qid, cid, score): the best k + 1 rows that each query meets in each segment it visits.

    A group holds about SEGMENT rows and ASKING queries. A prefix with more rows is dealt over
    chunks, each met by all of its queries; one with more queries over parts, each with all rows.
    """
    cut = int(min(COUNTED, max(0, np.ceil(np.log2(max(1, total / SEGMENT))))))
    chunks = np.maximum(1, -(-counts[cut] // SEGMENT))
    parts = np.maximum(1, -(-visitors(coded, counts, trees, enough, cut) // ASKING))
    shipped = coded.sparkSession.sparkContext.broadcast((counts, chunks, parts))

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, chunks, parts = shipped.value
        for batch in batches:
            cids = batch.column(0).to_numpy()
            codes = batch.column(3).flatten().to_numpy().reshape(-1, trees)
            mixed = np.abs(cids * 2_654_435_761 % 1_000_003)

            def placed(tree: int, at: np.ndarray, *where: np.ndarray) -> Iterator[pa.RecordBatch]:
                # Vectors are repeated once per tree and visit, so not too many rows at a time.
                for a in range(0, len(at), ROWS):
                    rows = at[a : a + ROWS]
                    segment, chunk, part, length = (w[a : a + ROWS] for w in where)
                    columns = {
                        "tree": pa.array(np.full(len(rows), tree), pa.int32()),
                        "segment": pa.array(segment, pa.int64()),
                        "chunk": pa.array(chunk, pa.int64()),
                        "part": pa.array(part, pa.int64()),
                        "cid": pa.array(cids[rows]),
                        "vec": batch.column(1).take(pa.array(rows)),
                        "code": pa.array(codes[rows, tree]),
                        "length": pa.array(length, pa.int64()),
                    }
                    yield pa.RecordBatch.from_pydict(columns)

            asking = np.flatnonzero(batch.column(2).to_numpy(zero_copy_only=False))
            lengths, first, after = visited(counts, codes[asking], enough, cut)
            for t in range(trees):
                place = codes[:, t] >> (BITS - cut)
                for p in range(parts[t][place].max(initial=0)):
                    at = np.flatnonzero(parts[t][place] > p)
                    own, same = mixed[at] % chunks[t][place[at]], np.ones(len(at), np.int64)
                    yield from placed(t, at, place[at], own, p * same, -same)
                found: list[tuple[np.ndarray, ...]] = []
                held = 0
                for i, row in enumerate(asking):
                    s = np.arange(first[i, t], after[i, t])
                    s = s[counts[cut][t, s] > 0]
                    n = chunks[t][s]
                    segment = np.repeat(s, n)
                    chunk = np.arange(len(segment)) - np.repeat(np.cumsum(n) - n, n)
                    part = mixed[row] % parts[t][segment]
                    same = np.ones(len(segment), np.int64)
                    found.append((row * same, segment, chunk, part, lengths[i] * same))
                    held += len(segment)
                    if held >= ROWS or i == len(asking) - 1:
                        yield from placed(t, *map(np.concatenate, zip(*found, strict=True)))
                        found, held = [], 0

    rows = coded.select("cid", "vec", "is_query", "codes").mapInArrow(
        visits,
        "tree INT, segment BIGINT, chunk BIGINT, part BIGINT, cid BIGINT, vec ARRAY<DOUBLE>, "
        "code BIGINT, length BIGINT",
    )

    def compare(table: pa.Table) -> pa.Table:
        length, code, cid = (table[c].to_numpy() for c in ("length", "code", "cid"))
        vecs = _matrix(table["vec"].combine_chunks(), dim)
        index = np.flatnonzero(length < 0)
        index = index[np.lexsort((cid[index], code[index]))]
        sorted_codes, matrix, owners = code[index], vecs[index], cid[index]
        longest = np.sqrt(np.einsum("ij,ij->i", matrix, matrix).max(initial=0.0))
        qids, cids, scores = [], [], []
        for q in np.flatnonzero(length >= 0):
            x = int(length[q])
            low, high = _span(sorted_codes, int(code[q]), x)
            # Beyond the counted lengths the prefix grows while it still holds enough.
            while x >= COUNTED and x < BITS:
                a, b = _span(sorted_codes, int(code[q]), x + 1)
                if b - a < max(enough, k + 1):
                    break
                low, high, x = a, b, x + 1
            if high == low:
                continue
            # The last bits of a block's products depend on where a row stands in it; those that may
            # be nearest are computed row by row, alike in every block.
            rough = matrix[low:high] @ vecs[q]
            near = np.arange(len(rough))
            if len(rough) > k + 1:
                slack = 4 * dim * EPSILON * longest * np.sqrt(vecs[q] @ vecs[q])
                near = np.flatnonzero(rough >= np.partition(rough, -(k + 1))[-(k + 1)] - slack)
            score = row_products(matrix[low + near], vecs[q])
            first = np.lexsort((owners[low + near], -score))[: k + 1]
            qids.append(np.full(len(first), cid[q]))
            cids.append(owners[low + near[first]])
            scores.append(score[first])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.array([], kind)
        return pa.table(
            {
                "qid": pa.array(join(qids, np.int64), pa.int64()),
                "cid": pa.array(join(cids, np.int64), pa.int64()),
                "score": pa.array(join(scores, np.float64), pa.float64()),
            }
        )

    near = rows.groupBy("tree", "segment", "chunk", "part").applyInArrow(
        compare, "qid BIGINT, cid BIGINT, score DOUBLE"
    )
    return near.groupBy("qid", "cid").agg(F.max("score").alias("score"))


def row_products(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    """Inner products whose bits depend on the two vectors alone, not on the rows beside them."""
    return np.ascontiguousarray(matrix * vector).sum(axis=1)


def _span(codes: np.ndarray, code: int, length: int) -> tuple[int, int]:
    """Where the rows that share the first ``length`` bits stand in the sorted array."""
    free = BITS - length
    first = (code >> free) << free
    return (
        int(np.searchsorted(codes, first, "left")),
        int(np.searchsorted(codes, first + (1 << free), "left")),
    )


def expanded(
    found: DataFrame, coded: DataFrame, clean: DataFrame, asked: DataFrame, k: int
) -> DataFrame:
    """The result by id: every query of a class with the members of the classes it found.

    A class gives a query at least one candidate, unless it is the query alone; so the first k + 1
    classes, ties by their smallest id, hold all that can be among its first k.
    """
    near = _ranked(found, ["qid"], [F.desc("score"), F.col("cid")], k + 1).drop("rank")
    named = near.join(coded.select("cid", "ids"), "cid")
    best = named.groupBy("qid").agg(F.collect_list(F.struct("score", "ids")).alias("near"))
    best = best.join(coded.where("is_query").select(F.col("cid").alias("qid"), "vec"), "qid")
    rows = asked.withColumnRenamed("vec_id", "query_id").join(best.drop("qid"), "vec")

    def members(c: Column) -> Column:
        return F.transform(c["ids"], lambda i: F.struct((-c["score"]).alias("far"), i.alias("id")))

    others = F.filter(
        F.flatten(F.transform("near", members)), lambda m: m["id"] != F.col("query_id")
    )
    first = F.slice(F.array_sort(others), 1, k)
    ranked = rows.select("query_id", F.posexplode(first).alias("at", "m"))
    return ranked.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("m.id").alias("vec_id"),
        (-F.col("m.far")).alias("score"),
    )

"""Exact top-k by inner product with an M-tree, searched best first.

The vectors are floored to integers, so scores are exact, and the metric is the Euclidean distance.
A node has a routing vector, a covering radius, its distance to the routing vector of its parent,
and the largest squared length below it. From a lower bound d of the distance to anything below a
node follows an upper bound of the scores there, (|q|^2 + largest - d^2) / 2, and the triangle
inequality gives such a d from the parent's distance alone, before a child is compared at all.

The upper levels split cells of too many vectors by routing vectors drawn from each cell, level by
level, until every cell is a chunk of bounded size; a chunk is loaded as a tree of pages and stored,
one row a page. Searching has two rounds: a query goes down to its most promising chunk first, and
the last score it finds there decides which cells it has to visit in the second round. Queries
visit cells and chunks in groups of bounded size, so neither the tree nor the queries pass through
one task or the driver. Within a chunk every query takes its most promising open pages first, a few
at a time, until no open page can hold a better score.

Equal vectors are one entry of the tree; their ids are told apart at the end.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import stored
from smeltery.llm.vectors import Shape, integers, met, products, ranked, squares

# Vectors of a chunk, queries that meet it in one group, routing vectors of a split cell.
CHUNK = 8192
ASKING = 4096
CELLS = 64
# Entries of a page and of an inner node within a chunk; most pages a query takes at a time.
PAGE = 64
FAN = 16
AT_ONCE = 16
ROOT = "0"


@dataclass
class Pages:
    """The tree of one chunk. Node i covers ``rows[first[i]:last[i]]`` if it is a page."""

    centre: np.ndarray  # nodes x dim
    radius: np.ndarray
    apart: np.ndarray  # distance to the parent's routing vector
    largest: np.ndarray  # largest squared length below
    parent: np.ndarray  # -1 for the nodes of the top
    first: np.ndarray  # -1 for inner nodes
    last: np.ndarray
    rows: np.ndarray  # vectors of all pages, page by page
    ids: np.ndarray
    gap: np.ndarray  # distance of each vector to its page's routing vector
    below: dict[int, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.below = {
            int(p): np.flatnonzero(self.parent == p) for p in np.unique(self.parent)
        }


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    apart = squares(a)[:, None] + squares(b)[None, :] - 2.0 * products(a, b)
    return np.sqrt(np.maximum(apart, 0))


def nearest(matrix: np.ndarray, routes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest routing vector of every row, the first of equals, and how far it is."""
    apart = distances(matrix, routes)
    own = apart.argmin(axis=1)
    return own, np.take_along_axis(apart, own[:, None], axis=1)[:, 0]


def load(matrix: np.ndarray, ids: np.ndarray, seed: int) -> Pages:
    """Bulk loading: routing vectors are drawn from a node's vectors, which go to the nearest."""
    rng = np.random.default_rng(seed)
    square = squares(matrix)
    nodes: list[tuple] = []
    order: list[np.ndarray] = []
    gaps: list[np.ndarray] = []
    held = 0
    todo: list[tuple[np.ndarray, int, int]] = [(np.arange(len(matrix)), -1, -1)]
    while todo:
        rows, parent, route = todo.pop()
        fan = int(min(FAN, max(2, -(-2 * len(rows) // PAGE)))) if len(rows) > PAGE else 1
        routes = np.sort(rng.choice(rows, fan, replace=False))
        own, apart = nearest(matrix[rows], matrix[routes])
        to_parent = distances(matrix[routes], matrix[[route]])[:, 0] if route >= 0 else np.zeros(fan)
        for i, centre in enumerate(routes):
            mine = rows[own == i]
            page = len(mine) <= PAGE
            start, end = (held, held + len(mine)) if page else (-1, -1)
            far = apart[own == i]
            nodes.append((centre, far.max(), to_parent[i], square[mine].max(), parent, start, end))
            if page:
                order.append(mine)
                gaps.append(far)
                held = end
            else:
                todo.append((mine, len(nodes) - 1, int(centre)))
    columns = [np.array(c) for c in zip(*nodes, strict=True)]
    at = np.concatenate(order)
    return Pages(matrix[columns[0]], *columns[1:], matrix[at], ids[at], np.concatenate(gaps))


def highest(square: np.ndarray, largest: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Upper bound of the scores of vectors at least ``apart`` away, a little above for rounding."""
    near = (square + largest - np.maximum(apart, 0) ** 2) / 2
    bound = np.minimum(near, np.sqrt(square * largest))
    return bound + 1e-9 * (square + largest) + 1e-6


def best_first(
    pages: Pages, queries: np.ndarray, floor: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query row, id, score) of each query's k best, ties to smaller ids, and products computed.

    ``floor`` is a score below which a query needs nothing; it rises as the k best are found.
    """
    n, floor = len(queries), floor.astype(np.float64).copy()
    square = squares(queries)[:, None]
    open_ = np.full((n, len(pages.radius)), -np.inf)
    far = np.zeros_like(open_)
    best_row, best_id, best_score = (np.zeros(0, np.int64) for _ in range(3))
    computed = 0

    def reach(rows: np.ndarray, nodes: np.ndarray, need: np.ndarray) -> int:
        """Compare the queries with routing vectors, and open the nodes that may hold something."""
        rows, need = rows[need.any(axis=1)], need[need.any(axis=1)]
        nodes, need = nodes[need.any(axis=0)], need[:, need.any(axis=0)]
        if not need.size:
            return 0
        apart = distances(queries[rows], pages.centre[nodes])
        bound = highest(square[rows], pages.largest[nodes], apart - pages.radius[nodes])
        far[np.ix_(rows, nodes)] = apart
        open_[np.ix_(rows, nodes)] = np.where(need, bound, -np.inf)
        return need.size

    top = pages.below[-1]
    computed += reach(np.arange(n), top, np.ones((n, len(top)), bool))
    take = 2
    while True:
        at = np.argpartition(-open_, min(take, open_.shape[1]) - 1, axis=1)[:, :take]
        value = np.take_along_axis(open_, at, axis=1)
        row, slot = np.nonzero((value >= floor[:, None]) & (value > -np.inf))
        if not len(row):
            break
        node = at[row, slot]
        open_[row, node] = -np.inf
        by_node = np.lexsort((row, node))
        row, node = row[by_node], node[by_node]
        found = [(best_row, best_id, best_score)]
        for group in np.split(np.arange(len(node)), np.flatnonzero(np.diff(node)) + 1):
            p, rows = int(node[group[0]]), row[group]
            near = far[rows, p][:, None]
            if pages.first[p] < 0:
                nodes = pages.below[p]
                apart = np.abs(near - pages.apart[nodes]) - pages.radius[nodes]
                need = highest(square[rows], pages.largest[nodes], apart) >= floor[rows][:, None]
                computed += reach(rows, nodes, need)
                continue
            held = np.arange(pages.first[p], pages.last[p])
            sizes = squares(pages.rows[held])
            apart = np.abs(near - pages.gap[held])
            need = highest(square[rows], sizes, apart) >= floor[rows][:, None]
            held, need = held[need.any(axis=0)], need[:, need.any(axis=0)]
            rows, need = rows[need.any(axis=1)], need[need.any(axis=1)]
            if not need.size:
                continue
            computed += need.size
            score = products(queries[rows], pages.rows[held])
            enough = floor[rows][:, None]
            if len(held) > k:
                enough = np.maximum(enough, np.partition(score, len(held) - k, axis=1)[:, [len(held) - k]])
            r, h = np.nonzero(score >= enough)
            found.append((rows[r], pages.ids[held[h]], score[r, h]))
        best_row, best_id, best_score = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((best_id, -best_score, best_row))
        begins = np.searchsorted(best_row[order], np.arange(n))
        rank = np.arange(len(order)) - begins[best_row[order]]
        order = order[rank < k]
        best_row, best_id, best_score = best_row[order], best_id[order], best_score[order]
        last = rank[rank < k] == k - 1
        floor[best_row[last]] = np.maximum(floor[best_row[last]], best_score[last])
        take = min(2 * take, AT_ONCE)
    return best_row, best_id, best_score, computed


# --- in Spark


def search(
    vectors: DataFrame,
    k: int = 20,
    query_every: int = 20,
    scale: int = 64,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """The k candidates of largest integer inner product for every query, largest first.

    Queries are the rows whose id is divisible by ``query_every``, candidates all rows but the
    query's own; every component x counts as floor(scale * x). Columns ``query_id``, ``rank`` (from
    1), ``vec_id``, ``score``; ties go to the smaller id. A query with fewer candidates gets all of
    them. See ``vectors.integers`` for the rows that take no part and for repeated ids; zero vectors
    take part. Other columns are not read. An empty table gives no rows.
    """
    clean, shape = integers(vectors, scale, vec_id, embedding)
    empty = "query_id BIGINT, rank INT, vec_id BIGINT, score BIGINT"
    if shape is None:
        return vectors.sparkSession.createDataFrame([], empty)
    clean = stored(clean, "metric-vectors")
    asked = clean.where(F.pmod("vec_id", F.lit(query_every)) == 0)
    # Of equal vectors a query needs the k + 1 smallest ids at most, its own among them.
    members = ranked(clean, ["vec"], ["vec_id"], k + 1)
    grouped = members.groupBy("vec").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    root = F.lit(ROOT).alias("cell")
    classes = grouped.select(F.col("ids")[0].alias("cid"), "vec", "ids", root)
    classes = stored(classes, "metric-classes")
    levels, chunks = cells(classes.select("cid", "vec", "cell"), shape)
    pages = stored(paged(chunks, shape), "metric-pages")
    queries = stored(
        asked.groupBy("vec").agg(F.min("vec_id").alias("qid")).select("qid", "vec"), "metric-queries"
    )
    ask = stored(queries.select("*", F.lit(float("-inf")).alias("floor"), root), "metric-ask")
    first = stored(descend(ask, levels, shape, True), "metric-first")
    found = stored(searched(first, pages, shape, k + 1), "metric-found")
    # A query that has k + 1 scores needs none below the last of them.
    last = found.groupBy("qid").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("last"))
    reached = F.when(F.col("n") > k, F.col("last").cast("double")).otherwise(float("-inf"))
    floor = F.coalesce(reached, F.lit(float("-inf"))).alias("floor")
    ask = stored(queries.join(last, "qid", "left").select("qid", "vec", floor, root), "metric-ask")
    visits = descend(ask, levels, shape, False)
    visits = visits.join(first.select("qid", "cell"), ["qid", "cell"], "left_anti")
    found = found.unionByName(searched(stored(visits, "metric-visits"), pages, shape, k + 1))
    return expanded(found, classes, queries, asked, k)


def cells(rows: DataFrame, shape: Shape) -> tuple[list[DataFrame], DataFrame]:
    """The upper levels, and (cid, vec, cell) of all vectors in cells of at most CHUNK.

    The rows come as (cid, vec, cell), all in the cell ROOT.

    A level is (parent, cell, centre, radius, largest, split); ``split`` cells have a level
    below them. Routing vectors are the first of a hash of the id, so a hot region gets its share.
    """
    levels: list[DataFrame] = []
    done: DataFrame | None = None
    while True:
        sizes = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
        large = sizes.where(F.col("n") > CHUNK)
        if large.isEmpty():
            break
        drawn = ranked(rows.join(large, "cell"), ["cell"], [F.xxhash64(F.lit(7), "cid"), "cid"], CELLS)
        some = F.greatest(F.lit(4), F.ceil(2 * F.col("n") / CHUNK))
        routes = drawn.where(F.col("rank") <= some).select(
            "cell", F.col("rank").alias("route"), F.col("vec").alias("centre")
        )
        routes = stored(routes, "metric-routes")
        placed = stored(
            met(rows.join(large.select("cell"), "cell", "left_semi"), routes, "cell", "cid", CHUNK,
                _placing(shape), "parent STRING, cell STRING, cid BIGINT, vec BINARY, apart DOUBLE, square DOUBLE"),
            "metric-cells",
        )
        small = rows.join(large.select("cell"), "cell", "left_anti")
        done = small if done is None else done.unionByName(small)
        rows = placed.select("cid", "vec", "cell")
        covered = placed.groupBy("parent", "cell").agg(
            F.max("apart").alias("radius"),
            F.max("square").alias("largest"),
            (F.count(F.lit(1)) > CHUNK).alias("split"),
        )
        name = F.concat_ws("/", "cell", "route")
        levels.append(
            stored(
                covered.join(routes.select(name.alias("cell"), "centre"), "cell").select(
                    "parent", "cell", "centre", "radius", "largest", "split"
                ),
                "metric-level",
            )
        )
    return levels, rows if done is None else done.unionByName(rows)


def _placing(shape: Shape):
    def place(rows: pa.Table, routes: pa.Table) -> pa.Table:
        matrix = shape.unpack(rows["vec"])
        routes = routes.sort_by("route")
        own, apart = nearest(matrix, shape.unpack(routes["centre"]))
        number = routes["route"].to_numpy()
        parent = rows["cell"][0].as_py()
        return pa.table(
            {
                "parent": rows["cell"],
                "cell": pa.array([f"{parent}/{number[i]}" for i in own], pa.string()),
                "cid": rows["cid"],
                "vec": rows["vec"],
                "apart": pa.array(apart, pa.float64()),
                "square": pa.array(squares(matrix), pa.float64()),
            }
        )

    return place


def paged(chunks: DataFrame, shape: Shape) -> DataFrame:
    """The tree of every chunk, a row a node; pages hold their vectors, ids and distances."""

    def build(table: pa.Table) -> pa.Table:
        table = table.sort_by("cid")
        tree = load(shape.unpack(table["vec"]), table["cid"].to_numpy(), seed=len(table))
        pages = [slice(max(a, 0), max(b, 0)) for a, b in zip(tree.first, tree.last, strict=True)]
        return pa.table(
            {
                "cell": pa.array([table["cell"][0].as_py()] * len(pages), pa.string()),
                "node": pa.array(np.arange(len(pages)), pa.int32()),
                "parent": pa.array(tree.parent, pa.int32()),
                "centre": shape.pack(tree.centre),
                "radius": pa.array(tree.radius, pa.float64()),
                "apart": pa.array(tree.apart, pa.float64()),
                "largest": pa.array(tree.largest, pa.float64()),
                "cids": pa.array([tree.ids[s] for s in pages], pa.list_(pa.int64())),
                "gaps": pa.array([tree.gap[s] for s in pages], pa.list_(pa.float64())),
                "vecs": pa.array([shape.raw(tree.rows[s]) for s in pages], pa.binary()),
            }
        )

    return chunks.select("cell", "cid", "vec").groupBy("cell").applyInArrow(
        build,
        "cell STRING, node INT, parent INT, centre BINARY, radius DOUBLE, apart DOUBLE, "
        "largest DOUBLE, cids ARRAY<BIGINT>, gaps ARRAY<DOUBLE>, vecs BINARY",
    )


def read_pages(table: pa.Table, shape: Shape) -> Pages:
    table = table.sort_by("node").combine_chunks()
    sizes = np.array([len(x) for x in table["cids"].to_pylist()])
    ends = np.cumsum(sizes)
    page = sizes > 0
    flat = lambda name: table[name].combine_chunks().flatten().to_numpy()
    return Pages(
        shape.unpack(table["centre"]),
        *(table[c].to_numpy() for c in ("radius", "apart", "largest", "parent")),
        np.where(page, ends - sizes, -1),
        np.where(page, ends, -1),
        shape.unpack(table["vecs"]),
        flat("cids"),
        flat("gaps"),
    )


VISIT = "qid BIGINT, vec BINARY, floor DOUBLE, cell STRING"


def descend(ask: DataFrame, levels: list[DataFrame], shape: Shape, best: bool) -> DataFrame:
    """(qid, vec, floor, cell) of the chunks each query has to visit, or of its ``best`` one alone.

    The queries come with the cell ROOT, stored like it, so that every join is on a column.
    """

    def choose(visits: pa.Table, cells: pa.Table) -> pa.Table:
        cells = cells.sort_by("cell")
        queries, floor = shape.unpack(visits["vec"]), visits["floor"].to_numpy()
        apart = distances(queries, shape.unpack(cells["centre"]))
        radius, largest = cells["radius"].to_numpy(), cells["largest"].to_numpy()
        bound = highest(squares(queries)[:, None], largest, apart - radius)
        if best:
            # Of cells that overlap, the one whose routing vector is nearest promises most.
            row, at = np.arange(len(queries)), apart.argmin(axis=1)
        else:
            row, at = np.nonzero(bound >= floor[:, None])
        taken = visits.take(pa.array(row))
        names = cells["cell"].take(pa.array(at))
        split = cells["split"].take(pa.array(at))
        return pa.table(
            [taken["qid"], taken["vec"], taken["floor"], names, split],
            ["qid", "vec", "floor", "cell", "split"],
        )

    at = ask
    reached: DataFrame | None = None
    for level in levels:
        below = level.select(F.col("parent").alias("over"), "cell", "centre", "radius", "largest", "split")
        visits = at.withColumnRenamed("cell", "over")
        seen = met(visits, below, "over", "qid", ASKING, choose, VISIT + ", split BOOLEAN")
        seen = stored(seen, "metric-descent")
        leaves = seen.where(~F.col("split")).drop("split")
        reached = leaves if reached is None else reached.unionByName(leaves)
        at = seen.where("split").drop("split")
    return at if reached is None else reached


def searched(visits: DataFrame, pages: DataFrame, shape: Shape, k: int) -> DataFrame:
    """(qid, cid, score): the best k of every chunk for each query that visits it."""

    def run(asking: pa.Table, held: pa.Table) -> pa.Table:
        floor = asking["floor"].to_numpy()
        row, cid, score, _ = best_first(read_pages(held, shape), shape.unpack(asking["vec"]), floor, k)
        return pa.table({"qid": asking["qid"].to_numpy()[row], "cid": cid, "score": score})

    return met(visits, pages, "cell", "qid", ASKING, run, "qid BIGINT, cid BIGINT, score BIGINT")


def expanded(
    found: DataFrame, classes: DataFrame, queries: DataFrame, asked: DataFrame, k: int
) -> DataFrame:
    """The result by id: every query with the members of the classes that its vector found.

    A class gives a query at least one candidate, unless it is the query alone; so the first k + 1
    classes, ties by their smallest id, hold all that can be among its first k.
    """
    near = ranked(found, ["qid"], [F.desc("score"), "cid"], k + 1).drop("rank")
    members = near.join(classes.select("cid", "ids"), "cid").select("qid", "score", F.explode("ids").alias("id"))
    # The query's own id may be among them, so one more than k.
    first = ranked(members, ["qid"], [F.desc("score"), "id"], k + 1)
    lists = first.groupBy("qid").agg(
        F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("far"), "id"))).alias("near")
    )
    rows = asked.withColumnRenamed("vec_id", "query_id").join(lists.join(queries, "qid"), "vec")
    others = F.filter("near", lambda m: m["id"] != F.col("query_id"))
    each = rows.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("at", "m"))
    return each.select(
        "query_id",
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("m.id").alias("vec_id"),
        (-F.col("m.far")).alias("score"),
    )

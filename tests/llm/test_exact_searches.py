"""The exact searches over integer vectors against brute force and SQL."""

from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltery.llm import metric_tree, queries, vectors, zone_maps
from smeltery.llm.vectors import Shape

SF = "/root/testdata/sf0.01"
ROWS = "vec_id long, embedding array<double>"


def clustered(n, dim, groups, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim)) * 2
    return centres[rng.integers(0, groups, n)] + spread * rng.standard_normal((n, dim))


def table_of(spark, matrix):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(matrix)], ROWS)


def brute(ids, matrix, every=20, k=20):
    out = []
    for q in np.flatnonzero(ids % every == 0):
        score = matrix @ matrix[q]
        order = [j for j in np.lexsort((ids, -score)) if ids[j] != ids[q]][:k]
        out += [(int(ids[q]), r + 1, int(ids[j]), int(score[j])) for r, j in enumerate(order)]
    return sorted(out)


def rows_of(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("name", ["op11_exact_topk", "op13_hard_negatives"])
@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_sql_gives_the_same(spark, name, sf):
    duck, folder = duckdb.connect(), f"/root/testdata/{sf}"
    duck.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    ours, theirs = queries.queries()[name](spark, folder), duck.sql(queries.oracle_sql()[name]).to_arrow_table()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.column_names)
    got = Counter(tuple(r[c] for c in columns) for r in ours.collect())
    assert got == Counter(tuple(r[c] for c in columns) for r in theirs.to_pylist())


@pytest.mark.parametrize(("width", "numbers"), [(1, [-128, -1, 0, 127]), (2, [-32768, 300]), (8, [-(2**62), 2**62, -1])])
def test_packed_vectors_keep_their_order(width, numbers):
    shape = Shape(2, width)
    matrix = np.array([[a, b] for a in numbers for b in numbers], np.int64)
    packed = shape.pack(matrix)
    assert (shape.unpack(packed) == matrix).all()
    assert sorted(packed.to_pylist()) == [shape.raw(np.array([r])) for r in sorted(map(list, matrix.tolist()))]


def test_products_are_exact_beyond_double_precision():
    a = np.array([[2**30, 3], [2**30 + 1, -1]])
    b = np.array([[2**30 - 1, 1], [-(2**31), 7]])
    assert vectors.products(a, b).tolist() == [[int(x) * int(u) + int(y) * int(v) for u, v in b] for x, y in a]


# --- metric tree


@pytest.mark.parametrize("kind", ["clustered", "lengths", "ties", "large"])
def test_tree_search_is_exact_and_avoids_products(kind):
    rng = np.random.default_rng(4)
    matrix = {
        "clustered": lambda: np.floor(64 * clustered(4_000, 16, 40, 2)),
        "lengths": lambda: np.floor(rng.standard_normal((3_000, 8)) * rng.integers(1, 400, (3_000, 1))),
        "ties": lambda: rng.integers(-2, 3, (2_000, 4)),
        "large": lambda: np.floor(2.0**27 * clustered(900, 4, 9, 3)),
    }[kind]().astype(np.int64)
    matrix = np.unique(matrix, axis=0)
    matrix = matrix[rng.permutation(len(matrix))]
    ids = np.arange(len(matrix)) * 3
    asked = matrix[::20]
    pages = metric_tree.load(matrix, ids, 1)
    row, found, score, computed = metric_tree.best_first(pages, asked, np.full(len(asked), -np.inf), 21)
    exact = vectors.products(asked, matrix)
    for q in range(len(asked)):
        order = np.lexsort((ids, -exact[q]))[:21]
        assert found[row == q].tolist() == ids[order].tolist()
        assert score[row == q].tolist() == exact[q][order].tolist()
    # A floor that is given leaves out what lies below it, and nothing else.
    floor = exact.max(axis=1).astype(float) - 5
    some = metric_tree.best_first(pages, asked, floor, 21)
    want = sum(min(21, int((exact[q] >= floor[q]).sum())) for q in range(len(asked)))
    assert len(some[0]) == want and some[3] <= computed
    if kind == "clustered":
        assert computed < 0.2 * exact.size


def test_stored_bounds_hold_for_every_page():
    matrix = np.floor(64 * clustered(2_000, 8, 12, 6)).astype(np.int64)
    tree = metric_tree.load(matrix, np.arange(len(matrix)), 3)
    below = {i: set(range(a, b)) for i, (a, b) in enumerate(zip(tree.first, tree.last, strict=True)) if a >= 0}
    for i in reversed(range(len(tree.parent))):
        if tree.parent[i] >= 0:
            below.setdefault(int(tree.parent[i]), set()).update(below[i])
    assert sorted(x for i in tree.below[-1] for x in below[i]) == list(range(len(matrix)))
    for i, rows in below.items():
        held = tree.rows[sorted(rows)]
        assert np.allclose(metric_tree.distances(held, tree.centre[[i]]).max(), tree.radius[i])
        assert vectors.squares(held).max() == tree.largest[i]
        if tree.first[i] >= 0:
            assert len(rows) <= metric_tree.PAGE
            assert np.allclose(tree.gap[sorted(rows)], metric_tree.distances(held, tree.centre[[i]])[:, 0])


@pytest.mark.parametrize(("chunk", "asking"), [(8192, 4096), (300, 25), (40, 4096)])
def test_search_over_many_cells(spark, monkeypatch, chunk, asking):
    monkeypatch.setattr(metric_tree, "CHUNK", chunk)
    monkeypatch.setattr(metric_tree, "ASKING", asking)
    matrix = clustered(3_000, 8, 30, 1)
    got = rows_of(metric_tree.search(table_of(spark, matrix)))
    assert got == brute(np.arange(3_000), np.floor(64 * matrix).astype(np.int64))


def test_second_round_leaves_out_most_cells(spark, monkeypatch):
    monkeypatch.setattr(metric_tree, "CHUNK", 100)
    matrix = clustered(4_000, 6, 60, 9, spread=0.05)
    clean, shape = vectors.integers(table_of(spark, matrix), 64, "vec_id", "embedding")
    root = F.lit(metric_tree.ROOT).alias("cell")
    levels, chunks = metric_tree.cells(clean.select(F.col("vec_id").alias("cid"), "vec", root), shape)
    assert chunks.count() == 4_000 and chunks.groupBy("cell").count().where("count > 100").isEmpty()
    pages = metric_tree.paged(chunks, shape)
    ask = clean.where("vec_id % 20 = 0").select(F.col("vec_id").alias("qid"), "vec", F.lit(float("-inf")).alias("floor"), root)
    first = metric_tree.descend(ask, levels, shape, True)
    assert first.count() == 200 == first.select("qid").distinct().count()
    found = metric_tree.searched(first, pages, shape, 21)
    last = found.groupBy("qid").agg(F.min("score").cast("double").alias("floor"))
    again = metric_tree.descend(ask.drop("floor").join(last, "qid"), levels, shape, False)
    assert again.count() < 0.5 * 200 * chunks.select("cell").distinct().count()


ODD = [
    *[(i, [1.0, 0.5]) for i in range(60)],
    (60, [0.0, 1.0]),
    (61, None),
    (62, [0.0, 0.0]),
    (63, [1.0, None]),
    (64, [float("nan"), 1.0]),
    (80, [float("-inf"), 1.0]),
    (None, [9.0, 9.0]),
    (100, [1.0]),
    (65, [2.0, 0.0]),
    (65, [2.0, 0.0]),
    (66, [1e300, 1.0]),
    (67, []),
]


def test_search_of_odd_vectors(spark):
    table = spark.createDataFrame(ODD, ROWS).withColumns({"cid": F.lit(1), "vec": F.lit("x"), "cell": F.lit(2)})
    got = rows_of(metric_tree.search(table))
    ids = np.array([*range(60), 60, 62, 65])
    matrix = np.array([*[[64, 32]] * 60, [0, 64], [0, 0], [128, 0]])
    assert got == brute(ids, matrix)
    assert rows_of(metric_tree.search(table.limit(0))) == []
    assert rows_of(metric_tree.search(table.where("vec_id = 40"))) == []
    assert rows_of(metric_tree.search(table.where("vec_id in (40, 41)"))) == [(40, 1, 41, 64 * 64 + 32 * 32)]


# --- zone maps


def brute_mine(rows, every=100, positives=5, negatives=10):
    """Rows are (vec_id, label, integer vector)."""
    out = []
    for a, la, va in rows:
        if a % every:
            continue
        scored = sorted((-int(va @ v), i, label) for i, label, v in rows if i != a)
        for s, p, label in [x for x in scored if x[2] == la][:positives]:
            hard = [x for x in scored if x[2] != la and 30 * -s <= 100 * -x[0] <= 90 * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i, _) in enumerate(hard[:negatives])]
    return sorted(out)


@pytest.mark.parametrize(("dims", "bits"), [(2, 4), (3, 3), (5, 2), (4, 1)])
def test_neighbours_on_the_curve_are_neighbours_in_space(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims), axis=-1).reshape(-1, dims)
    places = zone_maps.hilbert(cells, bits)
    assert len(set(places)) == len(cells) and len({len(p) for p in places}) == 1
    walk = cells[sorted(range(len(cells)), key=places.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_intervals_hold_the_scores_and_leave_out_blocks():
    matrix = np.floor(256 * clustered(3_000, 6, 40, 8, spread=0.05)).astype(np.int64)
    spread = matrix.max(axis=0) - matrix.min(axis=0)
    places = zone_maps.hilbert(((matrix - matrix.min(axis=0)) * 255 // spread).astype(np.uint32), 8)
    laid = matrix[sorted(range(len(matrix)), key=places.__getitem__)].reshape(30, 100, 6)
    asked = matrix[::50]
    least, most = zone_maps.bounds(asked, laid.min(axis=1), laid.max(axis=1))
    score = np.stack([asked @ b.T for b in laid], axis=1)
    assert (least <= score.min(axis=2)).all() and (score.max(axis=2) <= most).all()
    tenth = np.sort(score.reshape(len(asked), -1), axis=1)[:, -10]
    assert (most >= tenth[:, None]).mean() < 0.4


@pytest.mark.parametrize(("block", "wide", "asking", "labels"), [(1024, 16, 4096, 3), (20, 2, 7, 3), (7, 1, 4096, 4_000)])
def test_mining_over_many_blocks(spark, monkeypatch, block, wide, asking, labels):
    monkeypatch.setattr(zone_maps, "BLOCK", block)
    monkeypatch.setattr(zone_maps, "BLOCKS", wide)
    monkeypatch.setattr(zone_maps, "ASKING", asking)
    rng = np.random.default_rng(block)
    matrix, label = clustered(1_500, 5, 12, 4, spread=0.5), rng.integers(0, labels, 1_500)
    label[::150] = label[7]
    rows = [(i, int(b), v.tolist()) for i, (b, v) in enumerate(zip(label, matrix, strict=True))]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    ours = rows_of(zone_maps.mine(table))
    whole = np.floor(256 * matrix).astype(np.int64)
    assert ours == brute_mine([(i, int(b), v) for (i, b, _), v in zip(rows, whole, strict=True)])
    assert len(ours) > 50


def test_mining_reads_few_blocks_where_vectors_cluster(spark, monkeypatch):
    monkeypatch.setattr(zone_maps, "BLOCK", 50)
    matrix = clustered(4_000, 4, 80, 5, spread=0.02)
    rows = [(i, i % 3, v.tolist()) for i, v in enumerate(matrix)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    clean, shape = vectors.integers(table, 256, "vec_id", "embedding", F.col("label").cast("bigint"))
    laid = zone_maps.blocks(clean, shape, 4)
    assert laid.select(F.sum(F.size("ids"))).first()[0] == 4_000 and laid.count() >= 80
    levels = zone_maps.zone_levels(laid, shape, 4)
    whole = np.floor(256 * matrix).astype(np.int64)
    best = {i: np.sort(whole[i % 3 :: 3] @ whole[i])[-6:].min() for i in range(0, 4_000, 100)}
    ask = clean.where("vec_id % 100 = 0").withColumnRenamed("vec_id", "aid")
    floors = spark.createDataFrame([(i, [int(v)], [1 << 62]) for i, v in best.items()], "aid long, least array<long>, most array<long>")
    visits = zone_maps.chosen(ask.join(floors, "aid"), levels, shape, True, False)
    assert 40 <= visits.count() < 0.4 * 40 * laid.count() / 3


def test_mining_of_odd_rows(spark):
    rows = [(i, i % 2, [1.0, 0.5]) for i in range(130)]
    rows += [(200 + i, 0, [0.9 - i / 100, 0.1]) for i in range(40)] + [(300, 0, [-1.0, 0.0]), (301, 0, [0.0, 0.0])]
    odd = [(400, None, [1.0, 1.0]), (401, 1, None), (500, 1, [1.0, None]), (501, 1, [float("nan"), 0.0]),
           (None, 1, [1.0, 1.0]), (600, 1, [1.0]), (700, 1, []), (301, 0, [0.0, 0.0]), (800, 1, [1e300, 0.0])]
    columns = "vec_id long, label int, embedding array<double>"
    table = spark.createDataFrame(rows + odd, columns).withColumns({"vec": F.lit(1), "node": F.lit("x"), "most": F.lit(2)})
    whole = [(i, b, np.floor(256 * np.array(v)).astype(np.int64)) for i, b, v in rows]
    assert rows_of(zone_maps.mine(table)) == brute_mine(whole)
    assert rows_of(zone_maps.mine(table.limit(0))) == []
    assert rows_of(zone_maps.mine(table.where("vec_id = 100"))) == []

"""Co-training: limits that cannot overlap, uncapped exchange, and what the exchange is worth."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltery.llm import cotraining

SF = "/root/testdata/sf0.01"


def test_limits_lie_on_their_own_side_and_are_judged_at_the_limit():
    rng = np.random.default_rng(1)
    z = np.sort(rng.normal(0, 3, 2_000))
    y = (rng.random(2_000) < 1 / (1 + np.exp(-2 * z))).astype(float)
    low, high = cotraining.sure_limits(z, y, 0.98, 20)
    assert low < 0 <= high
    assert y[z >= high].mean() > 0.98 and y[z <= low].mean() < 0.02
    band = np.flatnonzero(z >= high)[:20]
    assert y[band].mean() >= 0.98
    # Perfect order, classes far apart: from the end alone both would reach across the middle.
    z, y = np.r_[np.linspace(-9, -5, 100), np.linspace(5, 9, 900)], np.r_[np.zeros(100), np.ones(900)]
    low, high = cotraining.sure_limits(z, y, 0.9, 20)
    assert (low, high) == (-5, 5) and not ((z <= low) & (z >= high)).any()
    low, high = cotraining.sure_limits(z, y, 0.9, 20, share=0.25)
    assert ((z <= low).sum(), (z >= high).sum()) == (25, 225)
    # So common a class needs a longer band than twenty rows.
    assert cotraining.sure_limits(z[:200], y[:200], 0.9, 20)[1] == 5
    assert cotraining.sure_limits(z[90:200], y[90:200], 0.9, 20) == (-math.inf, math.inf)


def test_a_view_without_information_is_never_sure():
    rng = np.random.default_rng(2)
    y = (rng.random(900) < 0.86).astype(float)
    low, high = cotraining.sure_limits(1.8 + 0.1 * rng.normal(size=900), y, 0.98, 20)
    assert (low, high) == (-math.inf, math.inf)
    assert cotraining.sure_limits(np.ones(5), np.ones(5), 0.98, 20) == (-math.inf, math.inf)


A, B = ([f"{x}{i}" for i in range(30)] for x in "ab")


def made(n, seed):
    """Texts with a weak leaning of their words, sources with a strong one, independent of each other."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(draw.random() < 0.5)
        words = [draw.choice(A if draw.random() < (0.62 if y else 0.38) else B) for _ in range(draw.randrange(30, 120))]
        kind = y if draw.random() < 0.93 else 1 - y
        rows.append((i, " ".join(words), "en", f"s{2 * draw.randrange(20) + kind}", 100, y))
    return rows


@pytest.fixture(scope="module")
def views(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, y int"
    table = spark.createDataFrame(made(6_000, 7), columns)
    labels = table.where("doc_id < 260").select("doc_id", F.col("y").alias("quality"))
    return table, cotraining.with_labels(cotraining.document_features(table), labels)


def right(model, table, features):
    got = cotraining.classify(features, model).join(table.where("doc_id >= 260").select("doc_id", "y"), "doc_id")
    share = lambda c: F.avg(((F.col(c) >= 0.5).cast("int") == F.col("y")).cast("double"))
    return got.agg(share("text_quality"), share("meta_quality"), share("quality")).first()


def test_the_exchange_lifts_both_views(views):
    table, features = views
    options = {"precision": 0.9, "least": 10}
    before = right(cotraining.train(features, shares=(), **options), table, features)
    model = cotraining.train(features, **options)
    after = right(model, table, features)
    assert before[0] < 0.9 and before[1] < 0.9
    assert after[0] > before[0] + 0.01 and after[1] > before[1] + 0.01 and after[2] > before[2]
    # Both views give, and a round gives no more than its share of a class.
    assert all(sum(turn[v]) > 0 for turn in model.exchanged[1:] for v in cotraining.VIEWS)


def test_the_exchange_grows_with_the_rows(views):
    _, features = views
    options = {"precision": 0.9, "least": 10, "shares": (0.5,), "steps": 1}
    once = cotraining.train(features, **options).exchanged[0]
    copies = features.where("y IS NULL").withColumn("doc_id", F.col("doc_id") + 1_000_000)
    twice = cotraining.train(features.unionByName(copies), **options).exchanged[0]
    assert twice == {v: tuple(2 * n for n in once[v]) for v in cotraining.VIEWS}


def test_sums_from_tasks_are_those_of_one_place(views):
    table, features = views
    base = cotraining.train(features, shares=())
    models = {"xt": base.text, "xm": base.meta}
    limits = {"xt": (-0.5, 0.7), "xm": (-0.2, 0.1)}
    got = cotraining._exchanged(features.repartition(5), models, limits, models)
    rows = features.orderBy("doc_id").toArrow()
    x = {v: cotraining._view(rows[v], v).astype(float) for v in cotraining.VIEWS}
    z = {v: models[v].logit(x[v]) for v in cotraining.VIEWS}
    said = {v: np.where(z[v] <= limits[v][0], 0, np.where(z[v] >= limits[v][1], 1, -1)) for v in z}
    clash = (said["xt"] >= 0) & (said["xm"] >= 0) & (said["xt"] != said["xm"])
    for v, w in cotraining.OTHER.items():
        for c in (0, 1):
            own = (said[w] == c) & ~clash
            slope, curve = cotraining._loss_sums(cotraining._design(models[v], x[v][own]), c, models[v].weights)
            n, s, h = got[v, c]
            assert n == own.sum() > 0 and np.allclose(s, slope) and np.allclose(h, curve)


def test_runs_agree_however_rows_are_dealt(views):
    table, features = views
    one, two = (cotraining.train(features.repartition(n, "doc_id"), precision=0.9, least=10) for n in (1, 6))
    assert one.exchanged == two.exchanged
    assert np.allclose(one.text.weights, two.text.weights) and np.allclose(one.meta.weights, two.meta.weights)


def test_metadata_is_spread_out_in_place():
    rows = [cotraining.meta_features(*m) for m in [("en", "a", 100), (None, "a", None), ("en", None, -3)]]
    x = cotraining.meta_matrix(np.array(rows, np.float32))
    assert x.shape == (3, cotraining.META_FEATURES)
    assert x[:, : sum(cotraining._SIZES)].sum(axis=1).tolist() == [4, 1, 2]
    assert x[:, -2:].tolist() == [[0, 0], [1, 1], [1, 0]]


def test_figures_on_the_given_labels(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    half = F.pmod(F.xxhash64("doc_id"), F.lit(2))
    features = cotraining.with_labels(cotraining.document_features(documents), labels.where(half == 0))
    model = cotraining.train(features)
    assert all(turn["xt"][1] < 0.9 * documents.count() for turn in model.exchanged)
    held = labels.where(half == 1).select("doc_id", F.col("quality").alias("y"))
    got = cotraining.classify(features, model).join(held, "doc_id").collect()
    assert sum(r["kept"] == (r["y"] == 1) for r in got) >= 0.97 * len(got)

"""Quality classification by co-training of two views.

One classifier sees only a document's text (shares of characters, how words and lines vary, hashed
words and word pairs), the other only its metadata (language, source, length as stated, and the
first two together). Both start from the labelled documents. In every round each scores all
unlabelled documents, and those it is sure of become training rows of the other. It is sure beyond a
limit on the class's own side of an even verdict, where every band of rows of the calibration set is
right often enough, and in the first rounds only of the surest part of the class; so the two limits
cannot overlap. In the end both are calibrated to probabilities on labelled documents that neither
was trained on, and the two probabilities are combined as independent evidence.

The first fit is on a bounded sample of labelled rows. The exchanged rows have no bound: tasks add up
the slope and curvature of the loss over all of them, and the driver gets one matrix per view and
class, whatever their number. Each class's exchanged rows weigh as much as its labelled ones at
most. Features are computed once per document, every round scores every document, and the verdict is
given to each.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace
from operator import eq
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import slices, stored, text_bytes

LANG_BINS, SOURCE_BINS = 16, 64
# Byte values whose shares describe a text: ASCII ones in groups, all others together.
_GROUPS = (
    b"abcdefghijklmnopqrstuvwxyz",
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    b"0123456789",
    b" ",
    b"\n",
    b".,;:?'\"()-",
    b"!",
    b"|",
    b"#*$%&",
    b"<>{}[]\\/=_+~^@`",
)
_group = np.full(256, len(_GROUPS))
for _i, _members in enumerate(_GROUPS):
    _group[list(_members)] = _i
WORD_BINS = 64
TEXT_FEATURES = len(_GROUPS) + 1 + 9 + 2 * WORD_BINS
# Metadata is stored as four places of a one and four numbers, and spread out where it is used.
PAIR_BINS, LENGTH_BINS = 64, 80
HASHED_RIDGE = 30.0
# A band of one class is taken as no accident below this probability.
CHANCE = 1e-5
_SIZES = (LANG_BINS, SOURCE_BINS, PAIR_BINS, LENGTH_BINS)
META_STORED = len(_SIZES) + 4
META_FEATURES = sum(_SIZES) + 4


def text_features(text: bytes) -> list[float]:
    """Shares of character groups, how words and lines vary, and shares of hashed words and pairs,
    over the whole text."""
    n = len(text)
    bins = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    groups = np.sqrt(np.bincount(_group, weights=bins, minlength=len(_GROUPS) + 1) / max(1, n))
    words = text.split()
    count = max(1, len(words))
    lines = text.split(b"\n")
    in_a_row = sum(map(eq, words, words[1:]))
    pairs = len(set(zip(words, words[1:], strict=False))) / max(1, len(words) - 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    hashes = list(map(crc32, words))
    hashed = np.fromiter(hashes, np.int64, len(words)) % WORD_BINS
    following = np.fromiter(map(crc32, words[1:], hashes), np.int64, max(0, len(words) - 1)) % WORD_BINS
    bags = np.concatenate([np.bincount(h, minlength=WORD_BINS) for h in (hashed, following)])
    return [
        *groups,
        len(set(words)) / count,
        in_a_row / count,
        pairs,
        len(set(lines)) / len(lines),
        math.log1p(len(words)) / 10,
        math.log1p(count / len(lines)) / 5,
        float(lengths.mean()) / 10 if len(words) else 0.0,
        float(lengths.std()) / 10 if len(words) else 0.0,
        sum(w[-1] in b"!#*$%&|" for w in words) / count,
        *np.sqrt(bags / count),
    ]


def _bin(value: str, bins: int) -> int:
    return int.from_bytes(hashlib.blake2b(value.encode(), digest_size=4).digest(), "big") % bins


def meta_features(lang: str | None, source: str | None, n_chars: int | None) -> list[float]:
    """Where the ones stand (-1: nowhere) for language, source, both, and quarter octaves of the
    length as stated, then the length, its square, and what is missing."""
    size = max(0, n_chars) if n_chars is not None else 0
    length = math.log1p(size) / 10
    return [
        float(_bin(lang, LANG_BINS)) if lang is not None else -1.0,
        float(_bin(source, SOURCE_BINS)) if source is not None else -1.0,
        float(_bin(f"{lang}\n{source}", PAIR_BINS)) if None not in (lang, source) else -1.0,
        float(min(LENGTH_BINS - 1, int(4 * math.log2(1 + size)))) if n_chars is not None else -1.0,
        length,
        length**2,
        float(lang is None or source is None),
        float(n_chars is None),
    ]


def meta_matrix(stored_rows: np.ndarray) -> np.ndarray:
    """The stored metadata of many rows with its ones in their places."""
    out = np.zeros((len(stored_rows), META_FEATURES), np.float32)
    start = 0
    for i, size in enumerate(_SIZES):
        at = stored_rows[:, i].astype(np.int64)
        known = np.flatnonzero(at >= 0)
        out[known, start + at[known]] = 1.0
        start += size
    out[:, start:] = stored_rows[:, len(_SIZES) :]
    return out


@dataclass(frozen=True)
class Linear:
    """A logistic model on standardised features, and the calibration of its score."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def score(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights[1:] + self.weights[0]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.slope * self.score(x) + self.shift, -30, 30)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _newton(x: np.ndarray, y: np.ndarray, ridge: np.ndarray, steps: int = 25) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = _sigmoid(x @ w)
        slope = x.T @ (p - y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-9)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def ridge_of(view: str) -> np.ndarray:
    """How strongly each weight is held back; hashed words more, as there are many and each says little."""
    if view == "xm":
        return np.ones(META_FEATURES)
    return np.r_[np.ones(TEXT_FEATURES - 2 * WORD_BINS), np.full(2 * WORD_BINS, HASHED_RIDGE)]


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: np.ndarray) -> Linear:
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    design = np.column_stack([np.ones(len(x)), (x - mean) / scale])
    return Linear(mean, scale, _newton(design, y, np.r_[0.0, ridge]))


def calibrated(model: Linear, x: np.ndarray, y: np.ndarray) -> Linear:
    """Platt scaling: a logistic fit of the score, with targets a little inside 0 and 1."""
    n1 = y.sum()
    n0 = len(y) - n1
    soft = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    score = model.score(x)
    slope, shift = _newton(np.column_stack([score, np.ones(len(x))]), soft, np.array([1e-3, 0.0]))[:2]
    return Linear(model.mean, model.scale, model.weights, float(slope), float(shift))


def sure_limits(
    logit: np.ndarray, y: np.ndarray, precision: float, least: int, share: float = 1.0
) -> tuple[float, float]:
    """Logits at and below which a row is surely bad, at and above which it is surely good; infinite
    where the calibration set confirms none.

    The lower limit is below zero and the upper one at zero or above, so no row meets both. From a
    limit outwards, every band of neighbouring rows of the calibration set holds the wanted share
    of the class, the one at the limit too; and no more than ``share`` of the class's own rows lie
    beyond it. A band has ``least`` rows, and more for a class so common that a view without
    information would show so many in a row by chance.
    """

    def upper(z: np.ndarray, t: np.ndarray) -> float:
        order = np.argsort(z, kind="stable")
        z, t = z[order], t[order]
        own = np.sort(z[t > 0])
        common = min(t.mean(), 0.999)
        band = max(least, math.ceil(math.log(CHANCE) / math.log(max(common, 1e-9))))
        if len(own) < band:
            return math.inf
        right = np.convolve(t, np.ones(band), "valid") / band  # rows i .. i + band - 1
        wrong = np.flatnonzero((right < precision) | (z[: len(right)] < 0))
        first = wrong.max() + 1 if len(wrong) else 0
        if first >= len(right):
            return math.inf
        surest = own[max(0, len(own) - max(band, int(share * len(own))))]
        return float(max(z[first], surest))

    low, high = -upper(-logit, 1 - y), upper(logit, y)
    return (low if low < 0 else -math.inf), high


@dataclass(frozen=True)
class QualityModel:
    text: Linear | None
    meta: Linear | None
    prior: float  # logit of the share of good documents
    # Rows each view has given the other in each round: {"xt": (bad, good), "xm": (bad, good)}.
    exchanged: tuple[dict[str, tuple[int, int]], ...] = ()

    def logits(self, xt: np.ndarray, xm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the text, of the metadata, and combined: both views' evidence over the prior."""
        if self.text is None or self.meta is None:
            flat = np.full(len(xt), self.prior)
            return flat, flat, flat
        a, b = self.text.logit(xt), self.meta.logit(xm)
        return a, b, np.clip(a + b - self.prior, -30, 30)


def _features(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Of the columns text, lang, source, n_chars."""
    text, lang, source, size = (c.to_pylist() for c in part.columns)
    xt = [text_features(t) for t in text]
    xm = [meta_features(*m) for m in zip(lang, source, size, strict=True)]
    return (
        np.array(xt, np.float32).reshape(-1, TEXT_FEATURES),
        meta_matrix(np.array(xm, np.float32).reshape(-1, META_STORED)),
    )


def _packed(rows: list[list[float]]) -> pa.Array:
    """Features as half-precision numbers, a few hundred bytes a row."""
    return pa.array([np.clip(r, -6e4, 6e4).astype("<f2").tobytes() for r in rows], pa.binary())


def _view(column: pa.Array | pa.ChunkedArray, view: str) -> np.ndarray:
    """The features of a view, from the stored column of that name."""
    flat = np.frombuffer(b"".join(column.to_pylist()), "<f2").astype(np.float32)
    if view == "xt":
        return flat.reshape(-1, TEXT_FEATURES)
    return meta_matrix(flat.reshape(-1, META_STORED))


def _given(documents: DataFrame, text: str, lang: str, source: str, n_chars: str) -> list[Column]:
    return [
        text_bytes(F.col(f"`{text}`")).alias("text"),
        F.col(f"`{lang}`").cast("string").alias("lang"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{n_chars}`").cast("bigint").alias("n_chars"),
    ]


def document_features(
    documents: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    n_chars: str = "n_chars",
) -> DataFrame:
    """(doc_id, xt, xm): the features of both views, once per row, without the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            texts, *meta = (part.column(c).to_pylist() for c in ("text", "lang", "source", "n_chars"))
            xt = _packed([text_features(t) for t in texts])
            xm = _packed([meta_features(*m) for m in zip(*meta, strict=True)])
            columns = [part.column(0), xt, xm]
            yield pa.record_batch(columns, ["doc_id", "xt", "xm"])

    rows = documents.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        *_given(documents, text, lang, source, n_chars),
    )
    return rows.mapInArrow(run, "doc_id BIGINT, xt BINARY, xm BINARY")


def with_labels(
    features: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """The features, stored once, with the label ``y`` (0, 1 or NULL) of the row's document.

    A label counts once per document (the largest, if they differ); missing labels and ids count as
    none. The features are shuffled once, at any size.
    """
    given = labels.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"),
        (F.col(f"`{label}`") > 0).cast("int").alias("y"),
    )
    given = given.where("doc_id IS NOT NULL AND y IS NOT NULL").groupBy("doc_id").agg(
        F.max("y").alias("y")
    )
    return stored(features.join(given.hint("merge"), "doc_id", "left"), "features")


def _draw(salt: int, columns: list[str]) -> Column:
    """A number below 2^30 by a hash of the row, so that rows of one id are drawn each by itself."""
    return F.pmod(F.xxhash64(F.lit(salt), *columns), F.lit(1 << 30))


def _some(rows: DataFrame, limit: int, total: int, salt: int) -> pa.Table:
    """About ``limit`` rows to the driver, chosen by a hash of the row; all if there are fewer.

    Equal rows count once, so twice the limit is never reached and the draw is the same in every run.
    """
    share = min(1.0, limit / max(1, total))
    drawn = rows.withColumn("draw", _draw(salt, rows.columns))
    drawn = drawn.where(F.col("draw") < int(share * (1 << 30))).distinct()
    return drawn.limit(2 * limit).toArrow().sort_by([("doc_id", "ascending"), ("draw", "ascending")])


VIEWS = ("xt", "xm")
OTHER = {"xt": "xm", "xm": "xt"}


def train(
    features: DataFrame,
    shares: tuple[float, ...] = (0.25, 0.5, 0.75),
    labelled: int = 20_000,
    precision: float = 0.98,
    least: int = 20,
    held_out: float = 0.3,
    steps: int = 2,
    seed: int = 5,
) -> QualityModel:
    """Co-train both views on the rows of ``with_labels``, a round for every number in ``shares``.

    About ``labelled`` labelled rows are used, ``held_out`` of them for calibration only. A round
    exchanges all rows beyond the limits (see ``sure_limits``), of a class that share at most by the
    calibration set, and fits each view to them and to the labelled rows by ``steps`` Newton steps; a
    row on whose class the views contradict each other is left out. Without rows of both classes in
    both parts there is no classifier, and every document gets the prior.
    """
    known, unlabelled = features.where("y IS NOT NULL"), features.where("y IS NULL")
    table = _some(known, labelled, known.count(), seed)
    y = table["y"].to_numpy().astype(np.float64)
    prior = float(np.clip((y.sum() + 1) / (len(y) + 2), 1e-6, 1 - 1e-6))
    prior = math.log(prior / (1 - prior))
    ids = table["doc_id"].to_pylist()
    order = np.argsort(ids, kind="stable")
    part = np.array([_bin(f"{seed} {i}", 1000) for i in ids]) < 1000 * held_out
    fit, check = order[~part[order]], order[part[order]]
    if any(len(set(y[p])) < 2 for p in (fit, check)):
        return QualityModel(None, None, prior)
    x = {v: _view(table[v], v).astype(np.float64) for v in VIEWS}
    models = {v: calibrated(fit_linear(x[v][fit], y[fit], ridge_of(v)), x[v][check], y[check]) for v in VIEWS}
    history = []
    for share in shares:
        limits = {
            v: sure_limits(models[v].logit(x[v][check]), y[check], precision, least, share)
            for v in VIEWS
        }
        if all(math.isinf(low) and math.isinf(high) for low, high in limits.values()):
            break
        learning = models
        for _ in range(steps):
            sums = _exchanged(unlabelled, models, limits, learning)
            learning = {
                v: _stepped(
                    learning[v], x[v][fit], y[fit], [sums[v, c] for c in (0, 1)], ridge_of(v)
                )
                for v in VIEWS
            }
        history.append({v: tuple(int(sums[OTHER[v], c][0]) for c in (0, 1)) for v in VIEWS})
        models = {v: calibrated(learning[v], x[v][check], y[check]) for v in VIEWS}
    return QualityModel(models["xt"], models["xm"], prior, tuple(history))


def _design(model: Linear, x: np.ndarray) -> np.ndarray:
    return np.column_stack([np.ones(len(x)), (x - model.mean) / model.scale])


def _loss_sums(design: np.ndarray, y: np.ndarray | float, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the logistic loss."""
    p = _sigmoid(design @ w)
    return design.T @ (p - y), (design * (p * (1 - p))[:, None]).T @ design


def _stepped(
    model: Linear,
    x: np.ndarray,
    y: np.ndarray,
    sums: list[tuple[float, np.ndarray, np.ndarray]],
    ridge: np.ndarray,
) -> Linear:
    """One Newton step on the labelled rows and the exchanged ones, given as sums by class."""
    w = model.weights
    slope, curve = _loss_sums(_design(model, x), y, w)
    for c, (n, more_slope, more_curve) in enumerate(sums):
        weight = min(1.0, float((y == c).sum()) / n) if n else 0.0
        slope, curve = slope + weight * more_slope, curve + weight * more_curve
    held = np.r_[0.0, ridge]
    step = np.linalg.solve(curve + np.diag(held + 1e-9), slope + held * w)
    # A long step overshoots where the curvature is small.
    return replace(model, weights=w - step / max(1.0, np.abs(step).max() / 2))


def _exchanged(
    unlabelled: DataFrame,
    models: dict[str, Linear],
    limits: dict[str, tuple[float, float]],
    learning: dict[str, Linear],
) -> dict[tuple[str, int], tuple[float, np.ndarray, np.ndarray]]:
    """By learning view and class: rows that the other view is sure of, and their loss at its weights.

    Every task adds up its rows; the partial sums are added row of the matrix by row, so that no
    group holds more than a row of each task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            x = {v: _view(batch.column(v), v).astype(np.float64) for v in VIEWS}
            said = {}
            for v in VIEWS:
                z, (low, high) = models[v].logit(x[v]), limits[v]
                said[v] = np.where(z <= low, 0, np.where(z >= high, 1, -1))
            agreed = (said["xt"] < 0) | (said["xm"] < 0) | (said["xt"] == said["xm"])
            for v in VIEWS:
                for c in (0, 1):
                    rows = np.flatnonzero((said[OTHER[v]] == c) & agreed)
                    if not len(rows):
                        continue
                    slope, curve = _loss_sums(
                        _design(learning[v], x[v][rows]), float(c), learning[v].weights
                    )
                    whole = np.vstack([slope, curve, np.full(len(slope), float(len(rows)))])
                    sums[v, c] = sums[v, c] + whole if (v, c) in sums else whole
        for (v, c), whole in sums.items():
            n = len(whole)
            ends = pa.array(np.arange(n + 1, dtype=np.int32) * whole.shape[1])
            columns = [
                pa.array([v] * n),
                pa.array(np.full(n, c), pa.int32()),
                pa.array(np.arange(n), pa.int32()),
                pa.ListArray.from_arrays(ends, pa.array(whole.ravel())),
            ]
            yield pa.record_batch(columns, names=["view", "said", "line", "sums"])

    def add(table: pa.Table) -> pa.Table:
        rows = np.stack([np.array(r) for r in table["sums"].to_pylist()])
        # In one order, whichever task came first.
        total = np.sort(rows, axis=0).sum(axis=0)
        kept = table.select(["view", "said", "line"]).slice(0, 1)
        return kept.append_column("sums", pa.array([total.tolist()], pa.list_(pa.float64())))

    schema = "view STRING, said INT, line INT, sums ARRAY<DOUBLE>"
    partial = unlabelled.select("xt", "xm").mapInArrow(run, schema)
    found = partial.groupBy("view", "said", "line").applyInArrow(add, schema).toArrow()
    out = {}
    for v in VIEWS:
        d = len(learning[v].weights)
        for c in (0, 1):
            whole = np.zeros((d + 2, d))
            for row in found.to_pylist():
                if row["view"] == v and row["said"] == c:
                    whole[row["line"]] = row["sums"]
            out[v, c] = (whole[-1, 0], whole[0], whole[1:-1])
    return out


def classify(features: DataFrame, model: QualityModel, threshold: float = 0.5) -> DataFrame:
    """``doc_id``, ``text_quality``, ``meta_quality``, ``quality`` (probabilities) and ``kept``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, both = model.logits(*[_view(batch.column(v), v) for v in VIEWS])
            quality = _sigmoid(both)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(_sigmoid(a), pa.float64()),
                    pa.array(_sigmoid(b), pa.float64()),
                    pa.array(quality, pa.float64()),
                    pa.array(quality >= threshold, pa.bool_()),
                ],
                names=["doc_id", "text_quality", "meta_quality", "quality", "kept"],
            )

    return features.select("doc_id", *VIEWS).mapInArrow(
        run, "doc_id BIGINT, text_quality DOUBLE, meta_quality DOUBLE, quality DOUBLE, kept BOOLEAN"
    )


def quality(documents: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The verdict on every document, by a model trained on the labelled ones among them.

    Missing texts are empty ones; missing metadata is a feature of its own. Repeated rows are judged
    each. See ``train`` and ``classify``.
    """
    features = with_labels(document_features(documents), labels)
    return classify(features, train(features, **options))


def keep_good(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The documents, all columns, without those the classifier rejects.

    The verdict is given next to the row itself, so rows that share an id are judged each by its own
    text, and no text is shuffled.
    """
    model = train(with_labels(document_features(documents), labels), **options)

    @F.arrow_udf("boolean")
    def good(text: pa.Array, lang: pa.Array, source: pa.Array, n_chars: pa.Array) -> pa.Array:
        batch = pa.record_batch([text, lang, source, n_chars], ["text", "lang", "source", "n_chars"])
        verdicts = []
        for part in slices([batch]):
            verdicts.append(_sigmoid(model.logits(*_features(part))[2]) >= threshold)
        return pa.array(np.concatenate(verdicts) if verdicts else [], pa.bool_())

    return documents.where(good(*_given(documents, "text", "lang", "source", "n_chars")))

"""Periodic runs of words, found by recursive frequency splitting and a scan of the lags.

A run is a stretch of consecutive words with smallest period q, words q apart being identical, that
no neighbouring word extends and that is long enough: ``least`` words and ``periods`` whole periods.
Every word of a run occurs at least ``periods`` times in it, so a word that is rarer within its
segment belongs to no run of that segment and splits it; the pieces are split in turn, as words are
rarer in them, until nothing changes. In ordinary prose nearly nothing is left by then.

The segments that are left are scanned lag by lag. A run of period q gives a stretch of matches at
lag q so long that a block of a fixed length, at one of its multiples, lies within it. The blocks of
all lags are compared by prefix hashes at once, m log m comparisons for m words; only lags at which
a block agrees that no run of a smaller period explains are compared word by word. A hash that
agrees by chance costs such a comparison, never a result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import WORD, decoded, slices, text_bytes

# Fewest words of a run, and fewest whole periods.
LEAST = 24
PERIODS = 3
# Prefix hashes are sums modulo this prime (2^31 - 1); products of two residues fit 64 bits.
PRIME = np.uint64((1 << 31) - 1)
BASE = 1_000_003
# Blocks compared at a time, which bounds the memory of very long segments.
AT_ONCE = 1 << 20

RUNS = "ARRAY<STRUCT<start: BIGINT, length: BIGINT, period: BIGINT>>"


def numbered(words: list[str]) -> np.ndarray:
    """A number for each word, the same for identical words."""
    index: dict[str, int] = {}
    return np.fromiter(
        (index.setdefault(w, len(index)) for w in words), np.int64, count=len(words)
    )


def segments(codes: np.ndarray, least: int, periods: int) -> list[tuple[int, int]]:
    """The stretches (start, end) left when words too rare within their segment have split it.

    All segments of a depth are split at once; those that no word splits are set aside.
    """
    done: list[tuple[int, int]] = []
    if len(codes) < least:
        return done
    kinds = int(codes.max()) + 1
    place = np.arange(len(codes))
    part = np.zeros(len(codes), np.int64)
    first = True
    while len(place):
        if first:
            often = np.bincount(codes, minlength=kinds)[codes] >= periods
            first = False
        else:
            _, kind, count = np.unique(part * kinds + codes[place], return_inverse=True, return_counts=True)
            often = count[kind] >= periods
        split = np.bincount(part[~often], minlength=int(part[-1]) + 1) > 0
        whole = ~split[part]
        done += _stretches(place[whole], least)
        place = place[often & ~whole]
        part = np.cumsum(np.r_[0, np.diff(place) != 1]) if len(place) else place
        if len(place):
            long = np.bincount(part)[part] >= least
            place = place[long]
            part = np.cumsum(np.r_[False, np.diff(part[long]) != 0]) if len(place) else place
    return sorted(done)


def _stretches(place: np.ndarray, least: int) -> list[tuple[int, int]]:
    if not len(place):
        return []
    cuts = np.flatnonzero(np.diff(place) != 1) + 1
    starts, ends = place[np.r_[0, cuts]], place[np.r_[cuts - 1, len(place) - 1]] + 1
    return [(int(a), int(b)) for a, b in zip(starts, ends, strict=True) if b - a >= least]


def _powers(n: int) -> np.ndarray:
    """BASE^0 .. BASE^(n-1) modulo PRIME, by doubling."""
    out = np.ones(max(1, n), np.uint64)
    have, step = 1, np.uint64(BASE)
    while have < n:
        more = min(have, n - have)
        out[have : have + more] = out[:more] * step % PRIME
        have, step = have + more, step * step % PRIME
    return out


def _agreeing(codes: np.ndarray, least: int, periods: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(lag, block length, starts of agreeing blocks) for every lag with one, lags ascending."""
    m = len(codes)
    powers = _powers(m + 1)
    terms = (codes.astype(np.uint64) + np.uint64(1)) * powers[:m] % PRIME
    prefix = np.r_[np.uint64(0), np.cumsum(terms)] % PRIME
    lags = np.arange(1, m // periods + 1)
    # Fewest matches in a row at the lag, the block that fits within them at one of its multiples.
    matches = np.maximum(least, periods * lags) - lags
    block = (matches + 1) // 2
    # The last block at a lag ends with the last word that has one a lag further on.
    blocks = np.maximum(0, (m - lags) // block)
    ends = np.cumsum(blocks)
    a = 0
    while a < len(lags):
        before = ends[a - 1] if a else 0
        b = max(a + 1, int(np.searchsorted(ends, before + AT_ONCE, "right")))
        n = blocks[a:b]
        lag, size = np.repeat(lags[a:b], n), np.repeat(block[a:b], n)
        start = (np.arange(len(lag)) - np.repeat(np.cumsum(n) - n, n)) * size
        here = (prefix[start + size] + PRIME - prefix[start]) % PRIME * powers[lag] % PRIME
        there = (prefix[start + lag + size] + PRIME - prefix[start + lag]) % PRIME
        same = np.flatnonzero(here == there)
        for group in np.split(same, np.flatnonzero(np.diff(lag[same])) + 1):
            if len(group):
                yield int(lag[group[0]]), int(size[group[0]]), start[group]
        a = b


def _matching(codes: np.ndarray, lag: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal stretches whose words recur ``lag`` words on."""
    same = np.r_[False, codes[lag:] == codes[:-lag], False]
    edges = np.flatnonzero(same[1:] != same[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return starts[long], ends[long]


def scan(codes: np.ndarray, least: int, periods: int) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of one segment."""
    found: list[tuple[int, int, int]] = []
    starts = reach = np.array([], np.int64)
    for lag, block, at in _agreeing(codes, least, periods):
        if len(starts):
            # Blocks are no shorter than the lag, so one that lies with its copy within a run of a
            # smaller period stands for a multiple of that period.
            known = np.searchsorted(starts, at, "right") - 1
            inside = (known >= 0) & (reach[np.maximum(known, 0)] >= at + block + lag)
            if inside.all():
                continue
        new = False
        held = {(s, n) for s, n, _ in found}
        for a, b in zip(*_matching(codes, lag, max(least, periods * lag) - lag), strict=True):
            run = (int(a), int(b - a) + lag)
            if run not in held:
                found.append((*run, lag))
                new = True
        if new:
            spans = np.array(sorted((s, s + n) for s, n, _ in found))
            starts, reach = spans[:, 0], np.maximum.accumulate(spans[:, 1])
    return found


def runs(codes: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """(runs, 3): start, length and period of all runs, by start, then period."""
    found = [
        (a + start, length, period)
        for a, b in segments(codes, least, periods)
        for start, length, period in scan(codes[a:b], least, periods)
    ]
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)


def kept(n: int, found: np.ndarray) -> np.ndarray:
    """Which of n words stay: those that no run holds behind its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return np.cumsum(change[:-1]) == 0


def find_runs(
    documents: DataFrame,
    least: int = LEAST,
    periods: int = PERIODS,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """The runs of every text, and the text with each run collapsed to its first period.

    Columns ``doc_id``, ``n_words``, ``runs`` (an array of start, length, period, by start, then
    period), ``collapsed_sha256`` and, if kept, ``collapsed``: the kept words joined by one space.
    One scan without a shuffle; a task holds one text at a time. A missing, empty or blank text has
    no words, no runs and an empty collapsed text. Repeated rows are scanned each; a missing id
    stays missing. Other columns are not read. ``periods`` is three or more.
    """
    if periods < 3:
        raise ValueError("a run has three periods at least; with fewer, runs of different periods overlap")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(WORD)
        for part in slices(batches):
            counts, found, sums, texts = [], [], [], []
            for value in part.column(1).to_pylist():
                words = pattern.findall(decoded(value))
                all_runs = runs(numbered(words), least, periods)
                if len(all_runs):
                    stay = kept(len(words), all_runs)
                    words = [w for w, here in zip(words, stay, strict=True) if here]
                    counts.append(len(stay))
                else:
                    counts.append(len(words))
                left = " ".join(words)
                found.append(all_runs)
                sums.append(hashlib.sha256(left.encode()).hexdigest())
                if keep_text:
                    texts.append(left)
            flat = np.concatenate(found)
            ends = np.cumsum([0, *map(len, found)])
            fields = ["start", "length", "period"]
            each = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields)
            columns = {
                "doc_id": part.column(0),
                "n_words": pa.array(counts, pa.int64()),
                "runs": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), each),
                "collapsed_sha256": pa.array(sums, pa.string()),
            }
            if keep_text:
                columns["collapsed"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    schema = f"doc_id BIGINT, n_words BIGINT, runs {RUNS}, collapsed_sha256 STRING"
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_bytes(text))
    return rows.mapInArrow(run, schema + ", collapsed STRING" * keep_text)

"""Periodic runs against a scan of every lag, word by word."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from smeltery.llm import periodic, queries
from smeltery.llm.shared import WORD

SF = "/root/testdata/sf0.001"


def brute(words, least=24, periods=3):
    found = {}
    for lag in range(1, len(words) // periods + 1):
        i = 0
        while i + lag < len(words):
            j = i
            while j + lag < len(words) and words[j] == words[j + lag]:
                j += 1
            length = j - i + lag
            if j > i and length >= max(least, periods * lag):
                found.setdefault((i, length), lag)
            i = max(j, i + 1)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def answer(doc_id, text):
    """A row of op12 from every lag."""
    words = re.findall(WORD, text or "")
    n = len(words)
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and n:
        g = h // 10
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute(words)
    gone = {i for a, m, q in runs for i in range(a + q, a + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    left = " ".join(w for i, w in enumerate(words) if i not in gone)
    listed = "".join(f"{a},{m},{q}\n" for a, m, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, left)]
    return (doc_id, len(runs), *best, milli, *digests)


@pytest.mark.parametrize(("least", "periods"), [(24, 3), (6, 3), (3, 3), (24, 4)])
def test_runs_are_those_of_every_lag(least, periods):
    draw = random.Random(least + periods)
    for _ in range(400):
        n, kinds = draw.randrange(260), draw.choice([1, 2, 3, 5, 40])
        words = [draw.randrange(kinds) for _ in range(n)]
        for _ in range(draw.randrange(4) if n > 30 else 0):
            a, p = draw.randrange(n), draw.randrange(1, 40)
            for i in range(a, a + draw.randrange(n - a + 1)):
                words[i] = words[a + (i - a) % p]
        got = periodic.runs(periodic.numbered(list(map(str, words))), least, periods)
        assert list(map(tuple, got.tolist())) == brute(words, least, periods)


def test_rare_words_split_until_nothing_changes():
    run = [1, 2, 3] * 9
    words = run + [9] + [4, 5] * 3 + [9] + run + [8, 9, 8] + [6] * 24
    left = periodic.segments(np.array(words), 24, 3)
    # 8 splits first; then 9, no longer found three times in its piece, splits that too.
    assert left == [(0, 27), (35, 62), (65, 89)]


def test_chance_agreement_of_hashes_adds_no_run(monkeypatch):
    monkeypatch.setattr(periodic, "PRIME", np.uint64(7))
    monkeypatch.setattr(periodic, "AT_ONCE", 50)
    words = [random.Random(5).randrange(4) for _ in range(600)] + [0, 1, 2, 3, 2, 1, 0] * 30
    assert list(map(tuple, periodic.runs(np.array(words)).tolist())) == brute(words)


def test_long_texts_are_scanned_whole():
    one = periodic.runs(periodic.numbered(["a"] * 200_000))
    assert one.tolist() == [[0, 200_000, 1]]
    some = [str(x) for x in np.random.default_rng(1).integers(0, 900, 50_000)]
    assert periodic.runs(periodic.numbered(some * 3 + ["z"])).tolist() == [[0, 150_000, 50_000]]


ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "x " * 23),
    (5, "x y " * 24),
    (6, "a b c\n" * 9 + "c b a " * 9),
    (7, "漢字 \U0001f642 " * 500),
    (7, "漢字 \U0001f642 " * 500),
    (None, "p q " * 30 + "r " * 40),
    (50, "planted " + " ".join(map(str, range(300)))),
    *[(i, " ".join(str(j * j % 97) for j in range(i % 400))) for i in range(100, 260)],
]


def test_the_query_equals_every_lag_on_odd_rows(spark, folder):
    documents = spark.createDataFrame(ODD, "doc_id long, text string")
    documents.withColumns({"words": F.lit(1), "runs": F.lit("x"), "n": F.lit(2), "a": F.lit(0)}).write.parquet(
        f"{folder}/documents.parquet"
    )
    got = [tuple(r) for r in queries.op12_periodic_runs(spark, folder).collect()]
    want = [answer(*row) for row in ODD]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert any(zlib.crc32(str(i).encode()) % 10 == 0 and w[1] for (i, _), w in zip(ODD, want, strict=True) if i)


def test_the_query_equals_every_lag_on_the_table(spark):
    documents = spark.read.parquet(f"{SF}/documents.parquet").where(F.length("text") < 6_000)
    want = [answer(r["doc_id"], r["text"]) for r in documents.collect()]
    got = {r["doc_id"]: tuple(r) for r in queries.op12_periodic_runs(spark, SF).collect()}
    assert len(want) > 150 and all(got[w[0]] == w for w in want)


def test_collapsed_texts_and_empty_tables(spark):
    rows = spark.createDataFrame([(1, "see " + "one two three " * 9 + "end")], "doc_id long, text string")
    got = periodic.find_runs(rows).first()
    assert got["collapsed"] == "see one two three end"
    assert [tuple(r) for r in got["runs"]] == [(1, 27, 3)] and got["n_words"] == 29
    assert periodic.find_runs(rows.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periodic.find_runs(rows, periods=2)

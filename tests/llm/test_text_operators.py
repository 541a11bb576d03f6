"""Tokens, encoding, SimHash, line dedup and page text against the libraries or brute force."""

import hashlib
import random
import re
import string
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as driver
from smeltery.llm import bpe, line_blocks, line_dedup, simhash, token_counts

SF = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t \r\n"),
    (4, "plain words, don't we'll 123 ... <|endoftext|> x<|endoftext|>"),
    (5, "naïve ÄÖ ß 漢字 🙂🙂 ֈ ⅷ  x \x1c\x85 é" * 3),
    (6, "a" * 70_000 + " " * 9_000 + "b \n\n c" + "\n" * 5_000),
    (7, "word " * 40_000),
    (7, "word " * 40_000),
    (None, "no id"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string").withColumn("n_tokens", F.lit("x"))


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def _pairs(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_token_counts_are_the_librarys(request, table):
    df = request.getfixturevalue(table)
    library = Tokenizer.from_file(VOCABULARY)
    got = token_counts.token_counts(df, VOCABULARY, max_tokens=9).collect()
    want = [(i, len(library.encode(t, add_special_tokens=False).ids), t) for i, t in _pairs(df)]
    assert sorted(map(repr, got)) == sorted(
        f"Row(doc_id={i}, n_bytes={len(t.encode())}, n_tokens={n}, over_limit={n > 9})"
        for i, n, t in want
    )


def test_every_single_token_is_proven():
    library = Tokenizer.from_file(VOCABULARY)
    singles = token_counts.single_tokens(library)
    assert len(singles) > 40_000 and {" the", "the", "\n"} <= set(singles)
    assert all(len(library.encode(s).ids) == 1 for s in singles[::97])


def test_characters_are_looked_up_in_the_unproven_class_once():
    library = Tokenizer.from_file(VOCABULARY)
    proven = token_counts.proven(VOCABULARY, public_tokenizers.PATTERN)
    counter = token_counts.Counter(*proven, public_tokenizers.PATTERN)
    look, seen = counter.odd, Counter()
    counter.odd = lambda characters: seen.update(characters) or look(characters)
    # U+0378 is assigned to no character; what stands beside it is proven all the same.
    texts = ["naïve 漢字 🙂 " * 500, "x \u0378x漢é", "\u0378\u0378", "é 漢字x 🙂", "naïve x\u0378 🙂字"]
    for text in texts * 3:
        assert counter(text) == len(library.encode(text, add_special_tokens=False).ids)
    assert seen.pop("\u0378") == 9
    assert set(seen) == set("".join(texts)) - {"\u0378"} and set(seen.values()) == {1}


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_encoding_is_the_librarys_and_decodes_to_the_text(request, table):
    df = request.getfixturevalue(table)
    ranks = bpe.read_ranks(RANKS)
    library = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    encoded = bpe.encode(df, ranks)
    got = sorted((repr(r["doc_id"]), r["n_tokens"], r["ids_sha256"], r["decoded_sha256"], r["ids"]) for r in encoded.collect())
    want = []
    for i, text in _pairs(df):
        ids = library.encode_ordinary(text)
        sums = [hashlib.sha256(b).hexdigest() for b in (",".join(map(str, ids)).encode(), text.encode())]
        want.append((repr(i), len(ids), *sums, ids))
    assert got == sorted(want)
    back = {r["doc_id"]: bytes(r["bytes"]) for r in bpe.decode(encoded, ranks).collect()}
    assert back == {i: t.encode() for i, t in _pairs(df)}


def test_a_long_run_of_white_space_is_encoded():
    codec = bpe.Codec(bpe.read_ranks(RANKS))
    text = "x" + " " * 1_000_000 + "y"
    assert codec.decode(codec.encode(text)) == text.encode()
    short = "x" + " " * 5_000 + "y  z"
    assert codec.encode(short) == codec.encoding.encode_ordinary(short)


def _lower(text):
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", _lower(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def _components(points, linked):
    low = list(range(len(points)))
    for _ in points:
        new = [min(low[j] for j in range(len(points)) if linked(points[i], points[j])) for i in range(len(points))]
        if new == low:
            break
        low = new
    return low


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_simhash_components_are_those_of_all_pairs(request, table):
    df = request.getfixturevalue(table)
    rows = _pairs(df)
    prints = [_fingerprint(t) for _, t in rows]
    group = _components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    ids = defaultdict(list)
    for (i, _), g in zip(rows, group, strict=True):
        ids[g] += [i] if i is not None else []
    want = sorted(
        repr((i, f"{p:016x}", min(ids[g], default=None)))
        for (i, _), p, g in zip(rows, prints, group, strict=True)
    )
    got = simhash.near_duplicates(df).collect()
    assert sorted(repr(tuple(r)) for r in got) == want
    kept = [r["doc_id"] for r in simhash.keep_one(df).collect()]
    assert sorted(map(repr, kept)) == sorted({repr(min(ids[g], default=None)) for g in group})
    assert simhash.keep_one(df).columns == df.columns


def _signed(points):
    return sorted({p - (1 << 64) if p >> 63 else p for p in points})


def _linked_groups(links):
    """Of links collected: each node's smallest reachable node."""
    low = {n: n for link in links for n in link}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            least = min(low[a], low[b])
            changed |= low[a] != least or low[b] != least
            low[a] = low[b] = least
    return low


@pytest.mark.parametrize("max_bits", [0, 1, 2, 3])
@pytest.mark.parametrize(("segments", "most"), [(2, 16), (2, 1), (3, 2)])
def test_links_connect_all_near_fingerprints(spark, max_bits, segments, most):
    base = 0x0123_4567_89AB_CDEF
    points = [base ^ (1 << i) ^ (1 << j) ^ (k << 40) for i in (0, 5, 31, 32, 63) for j in (0, 9, 33) for k in (0, 7)]
    signed = _signed(points)
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [tuple(r) for r in simhash.near_links(table, max_bits, segments=segments, most=most).collect()]
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= max_bits
    assert all(near(a, b) for a, b in links)
    low = _linked_groups(links)
    want = _components(signed, near)
    assert [signed.index(low.get(p, p)) for p in signed] == want


def test_roots_are_those_of_the_links(spark):
    signed = _signed([0, 3, 15, 255 << 56, 1 << 63, 7 << 30])
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    got = {r["fp"]: r["root"] for r in simhash.fingerprint_roots(table, 2).collect()}
    near = lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2
    assert [signed.index(got[p]) for p in signed] == _components(signed, near)


def test_segments_and_balls():
    for n in (2, 3, 5, 64):
        parts = simhash.segments_of(n)
        assert [b for s in parts for b in s.bits] == list(range(64))
        assert all(sorted([*s.bits, *s.rest]) == list(range(64)) for s in parts)
    with pytest.raises(ValueError):
        simhash.segments_of(1)
    for radius, size in ((0, 1), (1, 65), (2, 65 + 64 * 63 // 2)):
        masks = set(simhash.ball(radius))
        assert len(masks) == size and max(m.bit_count() for m in masks) == radius


@pytest.mark.parametrize("first", [0, 32])
def test_ten_thousand_fingerprints_that_share_a_segment(spark, first):
    """The entry holds them all; candidates stay few, those too far apart are turned down."""
    draw = random.Random(first)
    shared, other = 0xDEAD_BEEF << first, 32 - first
    rest = {draw.getrandbits(32) for _ in range(9_900)}
    rest |= {r ^ (1 << draw.randrange(32)) ^ (1 << draw.randrange(32)) for r in list(rest)[:300]}
    points = [shared | r << other for r in rest] + [shared ^ (1 << first) | r << other for r in list(rest)[:50]]
    signed = _signed(points)
    table = spark.createDataFrame([(p,) for p in signed], "fp long").repartition(8)
    links = [tuple(r) for r in simhash.near_links(table, 2).collect()]
    # Brute force by the balls of one bit: two that lie within two bits share a variant.
    meet = defaultdict(list)
    for p in signed:
        for mask in simhash.ball(1):
            meet[(p & (1 << 64) - 1) ^ mask].append(p)
    pairs = {(a, b) for group in meet.values() for a in group for b in group if a > b}
    assert {(max(x), min(x)) for x in links} <= pairs
    assert _linked_groups(links) == _linked_groups(list(pairs)) and len(pairs) > 100


def test_verification_turns_candidates_down(spark):
    """Few fingerprints share a segment and nothing else: fetched, but not linked."""
    signed = _signed([7 << 32 | 0b1111 << 4 * i for i in range(8)])
    table = spark.createDataFrame([(p,) for p in signed], "fp long")
    parts = simhash.segments_of(2)
    met = simhash.segment_probes(table, parts, 1).join(simhash.segment_table(table, parts).withColumnRenamed("fp", "other"), "key")
    assert met.where("fp <> other").count() == 8 * 7
    assert simhash.near_links(table, 2).count() == 0


def test_simhash_columns_that_clash(spark):
    rows = [(1, "a b c d", 1), (2, "a b c d", 2), (3, "something else", 3)]
    names = ["fp", "key", "root", "low", "id", "members", "near", "point", "row"]
    df = spark.createDataFrame(rows, "doc_id long, text string, x int")
    df = df.select("doc_id", "text", *[F.col("x").alias(n) for n in names])
    assert {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(df).collect()} == {1: 1, 2: 1, 3: 3}
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns and {r["doc_id"] for r in kept.collect()} == {1, 3}


def _without_shared(rows, least=3):
    key = lambda line: _lower(line.strip(" \t\n\x0b\x0c\r"))
    held = defaultdict(set)
    for i, text in rows:
        for line in text.split("\n"):
            held[key(line)].add(-1 if i is None else i)
    out = []
    for i, text in rows:
        lines = text.split("\n")
        own = -1 if i is None else i
        stay = [
            x for x in lines if len(key(x)) < 20 or len(held[key(x)]) < least or max(held[key(x)]) == own
        ]
        out.append((repr(i), len(lines), len(lines) - len(stay), "\n".join(stay)))
    return sorted(out)


def test_line_dedup_is_that_of_brute_force(spark, documents, odd):
    shared = "  A Line that MANY documents share é\x0b"
    more = [(100 + i, f"own {i}\n{shared}\n{shared.upper() if i % 2 else shared}\r\nshort") for i in range(5)]
    more += [(101, "own again"), (None, shared), (3, None), (200, "only here, but twice in all!\n" * 3)]
    mixed = documents.select("doc_id", "text").unionByName(odd.select("doc_id", "text")).unionByName(
        spark.createDataFrame(more, "doc_id long, text string")
    )
    rows = [(r["doc_id"], r["text"] or "") for r in mixed.collect()]
    for batches, fanout in ((4, 2), (5, 3), (1, 2)):
        got = line_dedup.dedup_lines(mixed, batches=batches, fanout=fanout).collect()
        assert sorted((repr(r["row"]["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in got) == _without_shared(rows)
        assert all(r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest() for r in got)
    clash = mixed.withColumns({"row": F.lit(1), "drop": F.lit(2), "doc": F.lit(3), "hi": F.lit(4)})
    assert line_dedup.without_shared_lines(clash).columns == clash.columns


LINE = "a line that is long enough to count"


def _runs(spark, batches, enough=3, fanout=2):
    runs = line_dedup.LineRuns(fanout, enough)
    for rows in batches:
        runs.add(spark.createDataFrame(rows, "doc long, hi long, lo long"))
    return runs


def test_known_hashes_enter_no_run_with_a_holder(spark):
    """Batches by descending id: the first names the holder, later ones count, then nothing."""
    batches = [[(9, 1, 1), (8, 2, 2)], [(7, 1, 1), (6, 2, 2), (6, 1, 1)], [(5, 1, 1), (4, 3, 3)], [(3, 2, 2)]]
    runs = _runs(spark, batches, fanout=9)
    stored = [sorted(map(tuple, run.collect()), key=repr) for run in runs.levels[0]]
    assert stored == [
        [(1, 1, 1, 9), (2, 2, 1, 8)],
        [(1, 1, 2, None), (2, 2, 1, None)],
        [(3, 3, 1, 4)],  # the line of 9, 7 and 6 has enough documents: 5 adds nothing
        [(2, 2, 1, None)],
    ]
    want = [(1, 1, 9), (2, 2, 8)]
    for fanout in (2, 3, 9):
        assert sorted(map(tuple, _runs(spark, batches, fanout=fanout).shared().collect())) == want


def test_without_the_join_holders_are_not_found(spark, monkeypatch):
    batches = [[(9, 1, 1)], [(7, 1, 1)], [(6, 1, 1)]]
    monkeypatch.setattr(line_dedup.LineRuns, "rows", lambda self: None)
    runs = _runs(spark, batches, fanout=9)
    held = [r["holder"] for run in runs.levels[0] for r in run.collect()]
    assert held == [9, 7, 6]  # three holders in place of one


@pytest.mark.parametrize("ids", ["none", "one", "same text"])
def test_ten_thousand_rows_of_one_document(spark, ids):
    """Rows without id, or of one, are one document, but each is rebuilt by its own lines."""
    of = F.lit(None).cast("long") if ids == "none" else F.lit(7).cast("long")
    own = F.lit("0") if ids == "same text" else F.col("id").cast("string")
    many = spark.range(10_000).select(of.alias("doc_id"), F.concat(F.lit(LINE + "\nmy own line, of number "), own).alias("text"))
    more = spark.createDataFrame([(i, f"{LINE}\nx") for i in (20, 21, 22)], "doc_id long, text string")
    rows = [tuple(r) for r in many.unionByName(more).collect()]
    got = line_dedup.dedup_lines(many.unionByName(more)).collect()
    assert sorted((repr(r["row"]["doc_id"]), r["n_lines"], r["n_dropped"], r["text"]) for r in got) == _without_shared(rows)


def test_batches_hold_whole_documents_by_descending_id(spark):
    ids = [*range(100)] * 2 + [50] * 300 + [-(1 << 63)] * 20 + [(1 << 60) + i for i in range(9)]
    df = spark.createDataFrame([(i,) for i in ids], "doc long")
    for n in (1, 4, 7):
        numbered = df.withColumn("batch", line_dedup.descending_batches(df, n)).distinct().collect()
        order = sorted((-r["doc"], r["batch"]) for r in numbered)
        assert [b for _, b in order] == sorted(b for _, b in order) and order[-1][1] < n
        assert len(numbered) == len(set(ids))
    empty = spark.createDataFrame([], "doc long")
    assert empty.withColumn("batch", line_dedup.descending_batches(empty, 4)).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{{}}</style></head><body class="has-sidebar">
<header><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav><div class="ad">Buy now, it is cheap.</div>
{open}<h1>A  title &amp; more</h1><p>First&nbsp;line<br>goes on.<p>Short.</p><form>Name <input></form>
<!-- <p>no</p> --><script>var a = "</p>";</script><ul><li>item <b>one</b></li><li>item two</ul>{close}
<section id="comments"><p>Great post, thanks a lot for writing it!</p></section><aside>See also</aside>
<div class="cookie-notice">We use cookies</div><footer>&copy; us</footer></body></html>"""
TEXT = "A title & more\nFirst line goes on.\nShort.\nitem one\nitem two"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE.format(open="<article>", close="</article>"), TEXT),
        (PAGE.format(open="<main>", close="</main>"), TEXT),
        (PAGE.format(open="<div class=content>", close="</div>"), TEXT),
        (PAGE.format(open="<article><header>", close="</header></article>"), TEXT),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
        ("no markup &lt;at all&gt;", "no markup <at all>"),
        ("<nav>open<article><p>text</article>", "text"),
        ("<form><article><p>text</p></article></form>", "text"),
        ("<p>cut off <b>her", "cut off her"),
        ("<p title='a>b'>x</p><script>never closed", "x"),
    ],
)
def test_main_text(page, text):
    assert line_blocks.main_text(page) == text


def test_text_between_surge_and_dive_is_kept_and_what_stands_apart_is_not():
    menu = "".join(f"<div><a href=x>Link {i}</a></div>" for i in range(5))
    body = "<p>" + "long enough " * 20 + "</p><p>Tiny.</p><p>" + "and more of it " * 20 + "</p>"
    got = line_blocks.main_text(f"<body><div>Hello</div>{menu}{body}{menu}<div>Bye</div></body>")
    assert got.split("\n")[1] == "Tiny." and "Link" not in got and "Hello" not in got


def test_a_marked_teaser_is_not_the_story():
    story = "".join(f"<p>Paragraph {i} " + "tells more of it " * 9 + "</p>" for i in range(4))
    card = "<article class=card><p>Read this other piece as well.</p></article>"
    for page in (f"<div>{story}</div>{card}", f"{card}<div>{story}</div>", f"<div>{story}{card}{story}</div>"):
        got = line_blocks.main_text(f"<body>{page}</body>")
        assert got.count("Paragraph") == page.count("Paragraph")
    notice = "<p>Our office is open on weekdays.</p>"
    marked = line_blocks.main_text(f"{notice}<article>{story}</article>{notice}")
    assert "office" not in marked and marked.count("Paragraph") == 4


@pytest.mark.parametrize(
    "mark", ["layout has-sidebar", "no-sidebar", "ad-free", "content-widget", "page-header-fixed", "widget"]
)
def test_a_hint_does_not_hide_the_story(mark):
    story = "<h2>A title</h2>" + "<p>It tells more of it. </p>" * 9
    sidebar = "<div class=sidebar><p>About us.</p></div>"
    for inner in (story, f"<main>{story}</main>", f"<article>{story}</article>"):
        got = line_blocks.main_text(f"<body><div class='{mark}'>{inner}{sidebar}</div><p>Imprint</p></body>")
        assert got.startswith("A title") and got.count("more") == 9 and "About" not in got


def test_readers_comments_stay_out_however_long():
    story = "<p>" + "The story goes on. " * 9 + "</p>"
    comments = "<section id=comments>" + "<article><p>Reader comment, a long one. </p></article>" * 40 + "</section>"
    for page in (f"<article>{story}</article>{comments}", f"<div>{story}</div>{comments}"):
        got = line_blocks.main_text(page)
        assert "story" in got and "Reader" not in got
    assert line_blocks.main_text(f"<body>{comments}</body>").count("Reader") == 40


def test_an_article_in_a_closed_aside_is_no_article():
    story = "<p>" + "The story goes on. " * 9 + "</p>"
    teaser = "<aside><article><p>" + "Teaser of another. " * 5 + "</p></article></aside>"
    for page in (f"{teaser}<div>{story}</div>", f"<article>{story}</article>{teaser}"):
        got = line_blocks.main_text(f"<body>{page}</body>")
        assert "story" in got and "Teaser" not in got
    unclosed = f"<body><div class=wrap><div class=ad>Buy<article>{story}</article></div></body>"
    assert "story" in line_blocks.main_text(unclosed) and "Buy" not in line_blocks.main_text(unclosed)


def test_the_window_sums_decide_in_a_marked_article_too():
    apart = "<p>Apart</p><form>f</form><p>Near</p><form>f</form>"
    got = line_blocks.main_text(f"<article>{apart}<p>{'long enough ' * 20}</p><p>End.</p></article>")
    assert [line[:4] for line in got.split("\n")] == ["Near", "long", "End."]


def _surges_by_definition(lengths, window, level):
    """Stretches by their definition: line by line, each with the sums of all windows it begins."""
    n = len(lengths)
    sums = [sum(lengths[i : min(n, i + window)]) for i in range(n)]
    found, last = [], 0
    for i in range(n):
        if i < last or sums[i] < level:
            continue
        last = next((j for j in range(i, n) if sums[j] == 0), n)
        first = next(j for j in range(i, n) if lengths[j])
        first = next((j + 1 for j in range(first - 1, -1, -1) if not lengths[j]), 0)
        found.append((first, last))
    return found


@settings(deadline=None, max_examples=300)
@given(
    st.lists(st.sampled_from([0, 0, 0, 1, 5, 30, 90, 400]), max_size=40),
    st.integers(1, 5),
    st.sampled_from([1, 10, 80]),
)
def test_surges_and_threshold_by_definition(lengths, window, surge):
    level = line_blocks.threshold(lengths, surge)
    total = sum(lengths)
    middle = [x for x in sorted(set(lengths)) if 2 * sum(y for y in lengths if y >= x) >= total]
    assert level == (max(1, min(surge, middle[-1] // 2)) if middle else 1)
    assert line_blocks.surges(lengths, window, level) == _surges_by_definition(lengths, window, level)


@pytest.mark.parametrize("tag", ["div", "section", "p", "span", "td"])
def test_clutter_that_no_list_names(tag):
    """Neither tags nor names tell: the lengths and the part of the page do."""
    story = "<h1>On rivers</h1><p>In brief.</p>" + "<p>" + "The river runs on and on. " * 8 + "</p>" + "<p>It ends.</p>"
    before, after = f"<div class=x1><{tag}>Half price today</{tag}></div>", f"<div class=x2><{tag}>Made by us</{tag}></div>"
    for page in (f"{before}<div class=x3>{story}</div>{after}", f"{before}{story}{after}"):
        got = line_blocks.main_text(f"<body>{page}</body>").split("\n")
        assert [line[:8] for line in got] == ["On river", "In brief", "The rive", "It ends."]


def test_the_pages_title_starts_the_text():
    page = "<title>Ice  &amp; snow</title><div class=x>Half price today</div><div><h1>Ice &amp; snow</h1><p>Cold.</p></div>"
    assert line_blocks.main_text(page) == "Ice & snow\nCold."


def test_links_alone_dive_within_an_article():
    links = [f"<p><a href=x>Read this as well {i}</a></p>" for i in range(3)]
    story = "<p>" + "The story goes on. " * 9 + "</p>"
    some, many = "".join(links[:2]), "".join(links)
    got = line_blocks.main_text(f"<article>{story}{some}{story}{some}</article>")
    assert got.count("Read this") == 4
    got = line_blocks.main_text(f"<article>{story}{story}{many}<p>Fin</p></article>")
    assert "Read this" not in got and "Fin" not in got and got.count("goes on") == 18
    assert line_blocks.main_text(f"<article>{some}</article>").count("Read this") == 2


def test_most_clutter_goes_without_lists_and_marks_and_no_line_of_an_article(monkeypatch):
    pages = [r["html"] or "" for r in pq.read_table("/root/testdata/sf0.01/pages.parquet").to_pylist()]
    article = [[x.text for x in line_blocks.page_lines(p) if x.in_article and not x.dropped] for p in pages]
    monkeypatch.setattr(line_blocks, "DROPPED", frozenset(["head", "script", "style", "title"]))
    for name in ("ROLES", "HINTS", "FOREIGN"):
        monkeypatch.setattr(line_blocks, name, frozenset())
    lost = foreign = kept = 0
    for page, want in zip(pages, map(Counter, article), strict=True):
        lines = line_blocks.page_lines(page)
        for line in lines:
            line.in_article = False
        got = Counter(line_blocks.kept_lines(lines))
        lost += (want - got).total()
        foreign += (got - want).total()
        kept += got.total()
    assert lost == 0 and foreign < 0.125 * kept


def test_pages_of_any_kind_give_a_row(spark):
    rows = [(1, "u", None), (None, None, "<p>x"), (2, "u", "<p>y"), (2, "u", "<p>y"), (3, "u", "<p>z " * 50_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1))
    got = line_blocks.extract(pages).collect()
    assert sorted((repr(r["page_id"]), r["n_chars"]) for r in got) == [
        ("1", 0), ("2", 1), ("2", 1), ("3", 99_999), ("None", 1)
    ]


@pytest.mark.parametrize("name", [k for k in driver.queries() if k.startswith("op") or k == "pipeline"])
def test_empty_tables(spark, folder, name):
    for table in ("documents", "pages", "embeddings", "labels"):
        spark.read.parquet(f"{SF}/{table}.parquet").limit(0).write.parquet(f"{folder}/{table}.parquet")
    assert driver.queries()[name](spark, folder).count() == 0

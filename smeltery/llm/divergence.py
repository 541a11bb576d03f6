"""Quality rules by distribution divergence, in DataFrame functions only.

Two histograms of a document are compared with those of its language: the shares of character
classes, and the shares of the language's common words beside all others. A language's common words
are the ``COMMON`` words found in most of its documents, counted over all of them, and at least in
half. Its reference is the median share of each bin over all its documents that pass the base rules
and are long enough, so every document counts alike and a minority of odd ones doesn't move it. The
measure is the Jensen-Shannon distance (square root of the divergence, logarithms to base 2): 0 for
equal histograms, 1 for disjoint ones. Documents too short for a histogram are not judged by it.
Languages are taken as stated, and have a reference from ``LEAST`` documents on.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.shared import SPACE, WORD, stored

# Character classes as patterns of one character; what is in none counts as "other".
CLASSES = {
    "lower or digit": r"[\p{Ll}\p{Nd}]",
    "upper": r"\p{Lu}",
    "space": SPACE,
    "stop": r"[.,;:?'\"()\-]",
    "bang": r"[!]",
    "symbol": r"[#*$%&|<>@_=+~^/\\\[\]{}]",
}
# Most words that are a language's common words.
COMMON = 16
STEPS = 10_000
# Fewest documents that make a reference for a language.
LEAST = 20
# Documents without language are dealt over so many keys to meet the references.
SALTS = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once per row, also where the body uses it per element."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({WORD})"))


def repeated_words(ws: Column, size: int = 3) -> Column:
    """How many words lie in a window of ``size`` words that the list holds twice or more.

    Windows are compared by the 64-bit hash of their words. Sorted by hash, equal windows are
    neighbours; the starts of those, in order again, each cover up to ``size`` words.
    """
    none = F.lit(0).cast("bigint")
    last = F.size(ws) - F.lit(size)

    def at(i: Column, step: int) -> Column:
        return F.get(ws, i + F.lit(step))

    def hashes(n: Column) -> Column:
        window = lambda i: F.xxhash64(*[at(i, step) for step in range(size)])
        return F.transform(F.sequence(F.lit(0), n), window)

    def starts(hs: Column) -> Column:
        pairs = F.sort_array(F.transform(hs, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(ps: Column) -> Column:
            def equal(p: Column, j: Column) -> Column:
                before = F.get(ps, j - F.lit(1))["h"]
                after = F.get(ps, j + F.lit(1))["h"]
                return F.coalesce(p["h"] == before, F.lit(False)) | F.coalesce(
                    p["h"] == after, F.lit(False)
                )

            return F.sort_array(F.transform(F.filter(ps, equal), lambda p: p["i"]))

        return _let(pairs, twins)

    def covered(found: Column) -> Column:
        def width(i: Column, j: Column) -> Column:
            following = F.get(found, j + F.lit(1))
            return F.least(F.lit(size), F.coalesce(following - i, F.lit(size)))

        widths = F.transform(found, width)
        return F.aggregate(widths, none, lambda total, w: total + w)

    def count(hs: Column) -> Column:
        # Most texts repeat no window and need no positions.
        unique = F.size(F.array_distinct(hs)) == F.size(hs)
        return F.when(unique, none).otherwise(_let(starts(hs), covered))

    return F.when(last < 1, none).otherwise(_let(hashes(last), count))


def _shares(counts: list[Column], total: Column) -> list[Column]:
    return [F.when(total > 0, c / total).otherwise(F.lit(0.0)) for c in counts]


def distance(p: list[Column], q: list[Column]) -> Column:
    """Jensen-Shannon distance of two lists of shares."""

    def part(a: Column, b: Column) -> Column:
        # a log(a / m) with m the mean of both; nothing where a is nothing.
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(F.lit(0.0))

    total = reduce(Column.__add__, [part(a, b) + part(b, a) for a, b in zip(p, q, strict=True)])
    return F.sqrt(F.greatest(total / 2, F.lit(0.0)))


def common_words(rows: DataFrame) -> DataFrame:
    """``lang`` and its ``common`` words, lower-cased, those found in most documents first.

    Per language the word counts of the tasks are ranked where they are added up, so no task meets
    more than a few words of a language.
    """
    found = F.array_distinct(words(F.lower("text")))
    # No word is empty: the empty one counts the language's documents, and ranks first.
    counted = (
        rows.where("lang IS NOT NULL")
        .select("lang", F.explode(F.concat(F.array(F.lit("")), found)).alias("word"))
        .groupBy("lang", "word")
        .agg(F.count(F.lit(1)).alias("documents"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("documents"), "word")
    ranked = counted.withColumn("rank", F.row_number().over(order)).where(
        F.col("rank") <= COMMON + 1
    )
    listed = ranked.groupBy("lang").agg(
        F.max("documents").alias("documents"),
        F.sort_array(F.collect_list(F.struct("rank", "word", "documents"))).alias("ranked"),
    )
    often = F.filter(
        "ranked", lambda w: (w["word"] != "") & (2 * w["documents"] >= F.col("documents"))
    )
    return listed.where(F.col("documents") >= LEAST).select(
        "lang", F.transform(often, lambda w: w["word"]).alias("common")
    )


def text_measures(documents: DataFrame, doc_id: str, text: str, lang: str) -> DataFrame:
    """Counts of every document: those of the base rules, of character classes, of common words."""
    stated = F.col(lang).cast("string")
    rows = documents.select(
        F.col(doc_id).cast("bigint").alias("doc_id"),
        F.when(F.trim(stated) != "", stated).alias("lang"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # One row per language; Spark sees from the stored size whether to broadcast it.
    rows = rows.join(stored(common_words(rows), "common"), "lang", "left")
    lines = F.filter(F.split("text", "\n", -1), lambda line: line.rlike(WORD))

    # Blanks around every word, two between, so that neighbours are both found.
    spread = F.regexp_replace(F.lower("text"), f"{SPACE}+", "  ")
    padded = F.concat(F.lit(" "), spread, F.lit(" "))

    def common(i: int) -> Column:
        of = F.concat(F.lit(" "), F.get("common", F.lit(i)), F.lit(" "))
        gone = F.octet_length("padded") - F.octet_length(F.replace(F.col("padded"), of))
        return F.coalesce((gone / F.octet_length(of)).cast("bigint"), F.lit(0))

    def without(column: str, pattern: str) -> Column:
        return F.regexp_replace(column, f"{pattern}+", "")

    # No character is in two classes, so the few of the other classes are counted in what is left
    # of a text without its letters and white space, whose runs are taken out at once.
    classes = list(CLASSES.values())
    spaces = F.length("left_0") - F.length("left_1")
    counts = [F.regexp_count("left_1", F.lit(pattern)) for pattern in classes]
    counts[0] = F.length("text") - F.length("left_0")
    counts[classes.index(SPACE)] = spaces

    return (
        rows.withColumn("ws", words(F.col("text")))
        .withColumn("padded", padded)
        .withColumn("left_0", without("text", classes[0]))
        .withColumn("left_1", without("left_0", SPACE))
        .select(
            "doc_id",
            "lang",
            F.size("ws").cast("bigint").alias("n_words"),
            F.length("text").cast("bigint").alias("n_chars"),
            (F.length("text") - spaces).cast("bigint").alias("word_chars"),
            F.regexp_count("left_1", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
            _let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
            .cast("bigint")
            .alias("n_dup_lines"),
            _let(F.col("ws"), lambda ws: repeated_words(ws)).alias("n_repeat_words"),
            *[n.alias(f"class_{i}") for i, n in enumerate(counts)],
            (F.size("common") > 0).alias("listed"),
            *[common(i).alias(f"common_{i}") for i in range(COMMON)],
        )
    )


def judge(
    documents: DataFrame,
    max_class_distance: float = 0.15,
    max_word_distance: float = 0.28,
    min_chars: int = 200,
    min_words: int = 100,
    base_words: int = 50,
    base_repeats: int = 50,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """Counts, distances and verdict of every document.

    Columns ``doc_id``, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``class_distance``, ``word_distance``, ``kept``.
    ``base_failed``: fewer than ``base_words`` words, or more than ``base_repeats`` percent of them
    in repeated windows. Otherwise a document is kept unless one of its distances exceeds its limit.
    A distance is missing, and fails nobody, where the text is too short for it (``min_chars``,
    ``min_words``), where its language has no reference (``LEAST`` documents), and for words where
    none is common to half of a language's documents. A missing text is an empty one and fails the
    base rules; a document without language is compared with the nearest of all references, among
    them that of such documents, by characters alone. Repeated rows are judged each. Texts are read
    twice, for the common words and for the counts; what follows works on the counts.
    """
    measures = stored(text_measures(documents, doc_id, text, lang), "measures")
    classes = [F.col(f"class_{i}") for i in range(len(CLASSES))]
    other = F.greatest(F.col("n_chars") - reduce(Column.__add__, classes), F.lit(0))
    commons = [F.col(c) for c in measures.columns if c.startswith("common_")]
    rest = F.greatest(F.col("n_words") - reduce(Column.__add__, commons), F.lit(0))
    class_shares = _shares([*classes, other], F.col("n_chars"))
    word_shares = _shares([*commons, rest], F.col("n_words"))
    shared = {f"c{i}": c for i, c in enumerate(class_shares)}
    shared |= {f"w{i}": c for i, c in enumerate(word_shares)}
    failed = (F.col("n_words") < base_words) | (
        100 * F.col("n_repeat_words") > base_repeats * F.col("n_words")
    )
    rows = measures.withColumns(shared | {"base_failed": failed})
    long = (F.col("n_chars") >= min_chars) & (F.col("n_words") >= min_words)
    # Shares are counted in steps, which bounds the state of an exact median.
    middle = {c: F.percentile(F.round(F.col(c) * STEPS), 0.5).alias(f"ref_{c}") for c in shared}
    references = rows.where(~failed & long).groupBy("lang").agg(
        F.count(F.lit(1)).alias("documents"), *middle.values()
    )
    references = references.where(F.col("documents") >= LEAST)
    for prefix in "cw":
        names = [f"ref_{c}" for c in shared if c[0] == prefix]
        total = reduce(Column.__add__, [F.col(c) for c in names])
        references = references.withColumns({c: F.col(c) / total for c in names})
    # One row per language; Spark sees from the stored size whether to broadcast it.
    references = stored(references.drop("documents"), "references")

    def apart(prefix: str, n: int, of: Callable[[str], Column]) -> Column:
        p = [F.col(f"{prefix}{i}") for i in range(n)]
        q = [of(f"ref_{prefix}{i}") for i in range(n)]
        return F.when(q[0].isNotNull(), distance(p, q))

    n_classes = len(class_shares)
    listed = (F.col("n_words") >= min_words) & F.col("listed")
    by_class = apart("c", n_classes, F.col)
    by_word = F.when(listed, apart("w", len(word_shares), F.col))
    stated = rows.where("lang IS NOT NULL").join(references, "lang", "left")
    stated = stated.withColumns({"class_distance": by_class, "word_distance": by_word})
    each = F.struct(*[F.col(f"ref_c{i}") for i in range(n_classes)])
    nearest = F.array_min(F.transform("references", lambda r: apart("c", n_classes, r.getField)))
    # All references as one list, joined by its size like any table: every key has a copy.
    row = F.xxhash64("doc_id", "n_chars", "n_words", "word_chars")
    every = references.agg(F.collect_list(each).alias("references")).select(
        "references", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")
    )
    unknown = rows.where("lang IS NULL").withColumn("salt", F.pmod(row, F.lit(SALTS)).cast("int"))
    unknown = unknown.join(every, "salt")
    unknown = unknown.withColumns(
        {"class_distance": nearest, "word_distance": F.lit(None).cast("double")}
    )
    both = stated.select(*rows.columns, "class_distance", "word_distance").unionByName(
        unknown.select(*rows.columns, "class_distance", "word_distance")
    )
    judged = F.when(F.col("n_chars") >= min_chars, F.col("class_distance"))
    near = (F.coalesce("class_distance", F.lit(0.0)) <= max_class_distance) & (
        F.coalesce("word_distance", F.lit(0.0)) <= max_word_distance
    )
    return (
        both.withColumn("class_distance", judged)
        .withColumn("kept", ~F.col("base_failed") & near)
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            "base_failed",
            "class_distance",
            "word_distance",
            "kept",
        )
    )

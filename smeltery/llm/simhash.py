"""SimHash near-duplicates by multi-index hashing.

A fingerprint of 64 bits is cut into segments. Of two fingerprints within the allowed distance, one
segment differs by no more than that distance divided by the number of segments (pigeonholes). So
there is a table per segment, from the segment's value to the fingerprints holding it; each
fingerprint enumerates the small Hamming ball around every segment, fetches what the tables hold
under each variant, and the complete distance is verified.

A group of near copies shares segments, so its table entries are large. An entry of more than
``most`` fingerprints is not fetched but cut by a second key, the rest of the fingerprint: there the
bits still allowed are shared between both sides, the entry being listed under the ball around its
rest and probed with the ball of what remains. Such a bucket holds only fingerprints near one point,
and links its members to its smallest, so no group makes a quadratic number of pairs. Links are
joined to components.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.components import components
from smeltery.llm.shared import id_or_lowest, stored, text_bytes

BITS = 64
# Bits of so many hashes are summed at a time.
CHUNK = 1 << 15
# A key is a segment's number above so many bits, which hold the segment's value.
KEY_BITS = 32
# Table entries of more fingerprints than this are cut by the rest of the fingerprint as well.
MOST = 16
# Fingerprints whose probes one task makes.
PROBING = 1 << 16


def fingerprint(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """Majority of the bits of the shingles' XXH64 hashes, as an unsigned number.

    Words are cut at ASCII white space after A-Z were lower-cased, shingles are joined by a blank
    and count as often as they occur. Fewer words than a shingle has are one shingle; none give 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(line, seed)
    after = list(accumulate(len(w) + 1 for w in words))
    starts, ends = [0, *after], after[shingle - 1 :]
    n, ones = len(ends), np.zeros(BITS, np.int64)
    for at in range(0, n, CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=False)
        hashes = np.fromiter(
            (digest(line[a : b - 1], seed) for a, b in spans), ">u8", min(CHUNK, n - at)
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def with_fingerprint(
    documents: DataFrame, text: str = "text", shingle: int = 3, seed: int = 42, name: str = "fp"
) -> DataFrame:
    """The rows with their fingerprint as a signed 64-bit number; a missing text gives 0."""

    @F.arrow_udf("bigint")
    def fingerprints(texts: pa.Array) -> pa.Array:
        found = np.array([fingerprint(t.as_py(), shingle, seed) for t in texts], np.uint64)
        return pa.array(found.view(np.int64))

    return documents.withColumn(name, fingerprints(text_bytes(text)))


def hexadecimal(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def ball(radius: int, bits: Iterable[int] = range(BITS)) -> list[int]:
    """Masks that turn a number into each variant of the ball around it, in the given bits."""
    flips = (c for r in range(radius + 1) for c in combinations(list(bits), r))
    return [sum(1 << b for b in c) for c in flips]


def _masks(radius: int, bits: Iterable[int]) -> Column:
    """The ball's masks as one constant array of signed numbers."""
    signed = [m - (1 << BITS) if m >> (BITS - 1) else m for m in ball(radius, bits)]
    return F.array(*[F.lit(m).cast("bigint") for m in signed])


@dataclass(frozen=True)
class Segment:
    """Some neighbouring bits of a fingerprint; its keys carry its number above the value."""

    number: int
    first: int
    width: int

    @property
    def bits(self) -> range:
        return range(self.first, self.first + self.width)

    @property
    def rest(self) -> list[int]:
        return [b for b in range(BITS) if b not in self.bits]

    def key(self, fp: Column) -> Column:
        value = F.shiftrightunsigned(fp, self.first).bitwiseAND(F.lit((1 << self.width) - 1))
        return value + F.lit(self.number << KEY_BITS)

    def moved(self, fp: Column, key: Column) -> Column:
        """The fingerprint with the key's value in this segment."""
        return fp.bitwiseXOR(F.shiftleft(self.key(fp).bitwiseXOR(key), self.first))


def segments_of(n: int) -> list[Segment]:
    """``n`` segments, two at least, of equal width as far as that goes."""
    if n < 2:
        raise ValueError("a fingerprint has two segments or more")
    cuts = [BITS * i // n for i in range(n + 1)]
    return [Segment(i, a, b - a) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]


def segment_table(fingerprints: DataFrame, segments: list[Segment]) -> DataFrame:
    """``key``, ``fp``: every fingerprint under the value of each of its segments."""
    keys = F.array(*[s.key(F.col("fp")) for s in segments])
    return fingerprints.select(F.explode(keys).alias("key"), "fp")


def segment_probes(fingerprints: DataFrame, segments: list[Segment], radius: int) -> DataFrame:
    """``key``, ``fp``: every fingerprint under the ball around each of its segments.

    Of two values of a segment the larger one asks for the smaller, so variants above it are left out.
    """

    def variants(segment: Segment) -> Column:
        key = segment.key(F.col("fp"))
        keys = F.transform(_masks(radius, range(segment.width)), lambda m: key.bitwiseXOR(m))
        return F.filter(keys, lambda k: k <= key)

    keys = F.concat(*[variants(s) for s in segments])
    return fingerprints.select(F.explode(keys).alias("key"), "fp")


def crowded_links(probes: DataFrame, segments: list[Segment], max_bits: int, radius: int) -> DataFrame:
    """Links within table entries that are too large to be fetched; ``probes`` of such keys alone."""
    held, fp, toward = max_bits // 2, F.col("fp"), F.col("toward")
    number = F.shiftright("key", KEY_BITS)
    moved = F.coalesce(*[F.when(number == s.number, s.moved(fp, F.col("key"))) for s in segments])
    used = F.bit_count(fp.bitwiseXOR(toward))
    around = []
    for segment in segments:
        for n in range(radius + 1):
            # The entry's own fingerprints are listed and probe; those beside it only probe.
            reach = max_bits - n - held if n else max_bits - held
            around.append(
                F.when((number == segment.number) & (used == n), _masks(reach, segment.rest))
            )
    rows = (
        probes.select("key", "fp", moved.alias("toward"))
        .select("key", "fp", "toward", F.explode(F.coalesce(*around)).alias("mask"))
        .select(
            "key",
            "fp",
            toward.bitwiseXOR(F.col("mask")).alias("point"),
            ((used == 0) & (F.bit_count("mask") <= held)).alias("listed"),
        )
    )
    lowest = F.min(F.when(F.col("listed"), fp)).over(Window.partitionBy("key", "point"))
    return rows.select(fp.alias("a"), lowest.alias("b"))


def near_links(
    fingerprints: DataFrame, max_bits: int = 2, fp: str = "fp", segments: int = 2, most: int = MOST
) -> DataFrame:
    """Links ``a``, ``b`` that connect all distinct fingerprints at ``max_bits`` or fewer bits.

    Not every pair is listed, but every pair is connected. With two segments and two bits a
    fingerprint is two table rows and some 34 probes, one shuffle of each; a probe compares with
    ``most`` fingerprints at most, or goes on with 33 further keys where an entry holds more.
    """
    parts, radius = segments_of(segments), max_bits // segments
    of = stored(fingerprints.select(F.col(fp).alias("fp")).distinct(), "fingerprints")
    # Probes are many times their fingerprints, which are therefore dealt by their number.
    spread = of.repartition(1 + of.count() // PROBING)
    table = segment_table(of, parts)
    sizes = table.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    crowded = stored(sizes.where(F.col("n") > most).select("key"), "crowded")
    few = table.join(crowded, "key", "left_anti").groupBy("key").agg(
        F.collect_list("fp").alias("members")
    )
    none = F.lit(None).cast("array<bigint>").alias("members")
    entries = few.unionByName(crowded.select("key", none))
    fp, apart = F.col("fp"), lambda x, y: F.bit_count(x.bitwiseXOR(y))
    near = F.filter("members", lambda m: (m != fp) & (apart(m, fp) <= max_bits)).alias("near")
    fetched = segment_probes(spread, parts, radius).join(entries, "key").select("key", "fp", near)
    # Few are left: those with a verified neighbour, and those that met a crowded entry.
    hits = stored(fetched.where("near IS NULL OR size(near) > 0"), "hits")
    beside = hits.select(fp.alias("a"), F.explode("near").alias("b"))
    within = crowded_links(hits.where("near IS NULL"), parts, max_bits, radius)
    linked = beside.unionByName(within).where(F.col("a") != F.col("b"))
    return linked.where(apart(F.col("a"), F.col("b")) <= max_bits).distinct()


def fingerprint_roots(fingerprinted: DataFrame, max_bits: int) -> DataFrame:
    """For each distinct ``fp``: ``root``, a fingerprint that stands for its component."""
    distinct = fingerprinted.select("fp").distinct()
    reached = components(near_links(distinct, max_bits))
    joined = distinct.join(reached, F.col("fp") == F.col("node"), "left")
    return joined.select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(
    documents: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    Exact copies are one fingerprint, grouped before anything is compared. ``component_id`` is the
    smallest id that links reach; rows without id get one too, but count for nobody's unless all
    of their component lack it. Missing and wordless texts share fingerprint zero and are linked
    like any other. Repeated rows come back each.
    """
    given = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    marked = stored(with_fingerprint(given, "text", shingle, seed).select("doc_id", "fp"), "simhash")
    classes = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = fingerprint_roots(classes, max_bits).join(classes, "fp")
    lowest = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    named = stored(roots.join(lowest, "root").select("fp", "component_id"), "classes")
    return marked.join(named, "fp").select(
        "doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id"
    )


def keep_one(
    documents: DataFrame,
    shingle: int = 3,
    max_bits: int = 2,
    seed: int = 42,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One document of each component, that with the smallest id, with all its columns.

    Rows without id go before any that have one. Of rows repeated under one id and fingerprint
    one stays.
    """
    columns = documents.columns
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"))
    held = held.withColumns(
        {"id": F.col(f"row.`{doc_id}`").cast("bigint"), "text": F.col(f"row.`{text}`")}
    )
    marked = stored(with_fingerprint(held, "text", shingle, seed).drop("text"), "simhash")
    classes = marked.groupBy("fp").agg(F.min("id").alias("low"))
    roots = fingerprint_roots(classes, max_bits).join(classes, "fp")
    # Smallest id first, rows without id last.
    first = F.min(F.struct(F.col("low").isNull().alias("none"), "low", "fp")).alias("first")
    keepers = roots.groupBy("root").agg(first).select(
        F.col("first.fp").alias("fp"), id_or_lowest("first.low").alias("key")
    )
    kept = marked.withColumn("key", id_or_lowest("id")).join(keepers, ["fp", "key"])
    return kept.dropDuplicates(["fp", "key"]).select("row.*")

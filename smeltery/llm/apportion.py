"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Sizes are words. Every source gets a share of all words by its weight, up to a multiple of what it
has; what that leaves over goes to the others by weight. The mix is then dealt in blocks of equally
many words. Seats for blocks go to the sources by the highest quotients (target over 1, 3, 5, ...),
and a source's seats to its shards in the same way, so that every quota is an integer. A shard is a
bounded part of a source: its documents stand in a seeded order and are cut into blocks, and a
seeded permutation says which blocks are taken once more than the others.

Nothing wider than (row key, size) is shuffled, and no window spans more than one shard's documents
or one row per shard or source. The rows of all sources, and about three per source where seats are
dealt, are in one task, which bounds the number of sources, not of documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smeltery.llm.shared import SPACE, WORD, stored

# Words of a block and of a shard; a source has no more than MAX_SHARDS of the latter.
BLOCK = 64
SHARD = 1 << 18
MAX_SHARDS = 1 << 16
# Every source with a target gets at least about so many blocks, however small it is.
SEATS = 64
# A prime above any number of blocks in a shard, so that multiplying by it permutes them.
STRIDE = 2_147_483_647


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...], max_copies: int
) -> DataFrame:
    """One row per source: ``source``, ``source_size``, ``target``, given ``source``, ``size`` rows.

    Sources stand by code point, the missing one last, and take the weights in turn. With the limit
    reached first by the source with the smallest limit per weight, the sources that reach it are
    the first in that order, and the level of the others follows from running sums.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    given = F.array(*[F.lit(float(w)) for w in weights])
    at = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    ranked = per_source.withColumn("weight", F.get(given, at)).withColumn(
        "most", (max_copies * F.col("source_size")).cast("double")
    )
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    spent = F.coalesce(F.sum("most").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(before), F.lit(0.0)
    )
    level = (total - spent) / open_weight
    # The first source below its limit fixes the level of all that follow.
    free = F.when(F.col("most") > level * F.col("weight"), level)
    leveled = ranked.withColumn("free", free)
    fixed = F.first("free", ignorenulls=True).over(
        fill.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    target = F.coalesce(fixed * F.col("weight"), F.col("most"))
    return leveled.withColumn("target", target).select("source", "source_size", "target")


def sainte_lague(
    votes: DataFrame, key: list[str], vote: str, seats: Column, within: list[str]
) -> DataFrame:
    """Integer ``quota`` of each row from ``seats`` dealt by the highest quotients.

    ``seats`` is the same for all rows of a group ``within``. With n seats, S rows and a share p,
    a row's quota lies between p (n - S/2) - 1/2 and p (n + S/2) + 1/2. What it has for certain is
    given at once, and only the seats between the two bounds, about two per row, compete.
    """
    group = Window.partitionBy(*within)
    rows = votes.withColumns(
        {
            "_seats": seats.cast("double"),
            "_rows": F.count(F.lit(1)).over(group),
            "_share": F.coalesce(F.try_divide(F.col(vote), F.sum(vote).over(group)), F.lit(0.0)),
        }
    )
    low = F.ceil(F.col("_share") * (F.col("_seats") - F.col("_rows") / 2) - F.lit(1.0))
    high = F.floor(F.col("_share") * (F.col("_seats") + F.col("_rows") / 2) + F.lit(1.0))
    bounded = rows.withColumns(
        {
            "_low": F.greatest(F.lit(0), low).cast("bigint"),
            "_high": F.greatest(F.lit(0), high).cast("bigint"),
        }
    )
    bounded = bounded.withColumn("_given", F.sum("_low").over(group))
    tries = F.when(
        (F.col("_high") > F.col("_low")) & (F.col(vote) > 0), F.sequence(F.col("_low") + 1, "_high")
    )
    tried = bounded.withColumn("_seat", F.explode_outer(tries))
    quotient = F.when(F.col("_seat").isNotNull(), F.col(vote) / (2 * F.col("_seat") - 1))
    best = Window.partitionBy(*within).orderBy(
        quotient.desc_nulls_last(), *[F.col(k).asc_nulls_last() for k in key], "_seat"
    )
    won = tried.withColumn("_rank", F.row_number().over(best)).withColumn(
        "_won", F.col("_seat").isNotNull() & (F.col("_rank") <= F.col("_seats") - F.col("_given"))
    )
    return won.groupBy(*votes.columns).agg(
        (F.first("_low") + F.count_if("_won")).alias("quota")
    )


def block_copies(
    sized: DataFrame,
    weights: tuple[float, ...],
    max_copies: int,
    seed: int,
) -> DataFrame:
    """The mix: given ``uid``, ``key``, ``source``, ``size``, adds ``target`` and block columns.

    ``start`` is the document's first word in its shard, ``block`` the words of a block, ``passes``
    how often the whole shard is taken, ``extra`` how many of its ``blocks`` once more.
    """
    targets = source_targets(sized.select("source", "size"), weights, max_copies)
    smallest = F.min(F.when(F.col("target") > 0, F.col("target"))).over(Window.partitionBy())
    block = F.greatest(F.lit(1), F.least(F.lit(BLOCK), F.floor(smallest / SEATS))).cast("bigint")
    count = F.least(F.lit(MAX_SHARDS), F.ceil(F.col("source_size") / SHARD))
    targets = targets.withColumns(
        {
            "block": F.coalesce(block, F.lit(1)),
            "shards": F.greatest(F.lit(1), count).cast("bigint"),
            "sid": F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())),
        }
    )
    blocks = F.round(F.sum("target").over(Window.partitionBy()) / F.col("block"))
    targets = stored(sainte_lague(targets, ["sid"], "target", blocks, []), "sources")
    placed = sized.join(
        F.broadcast(targets) if _few(targets) else targets, sized["source"].eqNullSafe(targets["source"])
    ).select(sized["*"], "sid", "source_size", "target", "block", "shards", "quota")
    # By id and text, so that rows without id, or of one id, are spread over the shards as well.
    placed = placed.withColumn("order", F.xxhash64(F.lit(seed), "key", "uid")).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(seed + 1), "key", "uid"), F.col("shards"))
    )
    shard_sizes = placed.groupBy("sid", "shard", "block", "quota").agg(
        F.sum("size").cast("bigint").alias("words")
    )
    source_quota = F.col("seats")
    dealt = sainte_lague(
        shard_sizes.withColumnRenamed("quota", "seats"), ["shard"], "words", source_quota, ["sid"]
    )
    # Whole passes first; the rest of the quota is that many blocks more, none beyond the limit.
    passes = F.when(
        F.col("words") > 0,
        F.least(F.lit(max_copies), F.floor(F.col("quota") * F.col("block") / F.col("words"))),
    ).otherwise(0)
    dealt = dealt.withColumns(
        {
            "passes": passes.cast("bigint"),
            "blocks": F.ceil(F.col("words") / F.col("block")).cast("bigint"),
        }
    )
    rest = F.round((F.col("quota") * F.col("block") - F.col("passes") * F.col("words")) / F.col("block"))
    extra = F.when(F.col("passes") < max_copies, F.least(F.col("blocks"), rest)).otherwise(0)
    dealt = stored(
        dealt.withColumn("extra", F.greatest(F.lit(0), extra).cast("bigint")).select(
            "sid", "shard", "passes", "blocks", "extra"
        ),
        "shards",
    )
    stream = Window.partitionBy("sid", "shard").orderBy("order", "key", "size", "uid")
    before = stream.rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    return run.join(dealt, ["sid", "shard"])


def _few(targets: DataFrame, rows: int = 100_000) -> bool:
    """Whether the one row per source is small enough to send everywhere."""
    return targets.count() <= rows


def is_extra(block: Column, seed: int) -> Column:
    """Whether a block is one of those taken once more, by its place in the seeded permutation."""
    shift = F.pmod(F.xxhash64(F.lit(seed + 2), "sid", "shard"), F.col("blocks"))
    place = F.pmod(block * F.lit(STRIDE) + shift, F.col("blocks"))
    return place < F.col("extra")


def covering(start: Column, size: Column, block: Column) -> Column:
    """The numbers of the blocks that hold the document's words."""
    first = F.floor(start / block).cast("bigint")
    last = F.floor((start + size - 1) / block).cast("bigint")
    return F.sequence(first, last)


def taken_words(seed: int) -> Column:
    end = F.col("start") + F.col("size")

    def overlap(b: Column) -> Column:
        inside = F.least(end, (b + 1) * F.col("block")) - F.greatest(F.col("start"), b * F.col("block"))
        return F.when(is_extra(b, seed), inside).otherwise(F.lit(0))

    parts = F.transform(covering(F.col("start"), F.col("size"), F.col("block")), overlap)
    more = F.aggregate(parts, F.lit(0).cast("bigint"), lambda total, n: total + n.cast("bigint"))
    nothing_more = (F.col("size") == 0) | (F.col("extra") == 0)
    all_more = F.col("extra") == F.col("blocks")
    once_more = F.when(nothing_more, F.lit(0)).when(all_more, F.col("size")).otherwise(more)
    return (F.col("passes") * F.col("size") + once_more).cast("bigint")


def _sized(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """(uid, key, source, size): what the mix is worked out on, without the texts."""
    return documents.select(
        F.xxhash64(F.col(text)).alias("uid"),
        F.col(doc_id).cast("bigint").alias("key"),
        F.col(source).cast("string").alias("source"),
        word_count(F.col(text)).alias("size"),
    )


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    max_copies: int = 3,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """What the mix takes of every document.

    Columns ``doc_id``, ``size``, ``source_size``, ``target`` (both of its source) and ``taken``, in
    words, repeats counted; ``taken`` is at most ``max_copies`` times ``size``. A missing text has
    size 0 and is never taken; a missing source is one source, the last. Of repeated rows each is
    taken by its own place. The same table and seed give the same mix, however it is partitioned.
    """
    sized = stored(_sized(documents, doc_id, text, source), "sizes")
    placed = block_copies(sized, weights, max_copies, seed)
    return placed.select(
        F.col("key").alias("doc_id"),
        "size",
        F.col("source_size").cast("bigint").alias("source_size"),
        F.col("target").cast("double").alias("target"),
        taken_words(seed).alias("taken"),
    )


def mixed_documents(
    documents: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    max_copies: int = 3,
    seed: int = 7,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The mix itself: all columns of the documents, their text cut to the blocks taken.

    A document comes once for every pass and once more with its extra blocks, if it has any; white
    space after a word goes with the word. Documents the mix takes nothing of are left out. Rows
    alike in id, text and source are numbered by their other columns, so the mixed rows, too, are the
    same however the table is partitioned.
    """
    columns = documents.columns
    sized = stored(_sized(documents, doc_id, text, source), "sizes")
    twin = Window.partitionBy("key", "uid", "source").orderBy("start")
    same = ["key", "uid", "source"]
    placed = block_copies(sized, weights, max_copies, seed)
    numbered = placed.withColumn("twin", F.row_number().over(twin)).where(
        (F.col("size") > 0) & ((F.col("passes") > 0) | (F.col("extra") > 0))
    )
    rows = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"),
        F.xxhash64(F.col(text)).alias("uid"),
        F.col(doc_id).cast("bigint").alias("key"),
        F.col(source).cast("string").alias("source"),
    )
    others = [F.col(f"row.`{c}`") for c in columns if c not in (doc_id, text, source)]
    by_others = F.to_json(F.struct(*others)) if others else F.lit(1)
    rows = rows.withColumn("twin", F.row_number().over(Window.partitionBy(*same).orderBy(by_others)))
    left, right = rows.alias("l"), numbered.alias("r")
    matched = F.col("l.twin") == F.col("r.twin")
    for c in same:
        matched = matched & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    both = left.join(right, matched).select(
        "row", "r.sid", "r.shard", "r.size", "r.start", "r.block", "r.passes", "r.blocks", "r.extra"
    )
    pieces = F.regexp_extract_all(
        F.col(f"row.`{text}`"), F.lit(f"({SPACE}*{WORD}{SPACE}*)"), F.lit(1)
    )

    def chosen(ps: Column) -> Column:
        def stays(_: Column, i: Column) -> Column:
            return is_extra(F.floor((F.col("start") + i) / F.col("block")).cast("bigint"), seed)

        return F.array_join(F.filter(ps, stays), "")

    whole = F.col(f"row.`{text}`")
    part = (
        F.when(F.col("extra") == 0, F.lit(""))
        .when(F.col("extra") == F.col("blocks"), whole)
        .otherwise(chosen(pieces))
    )
    both = both.withColumn("part", part)
    copies = F.concat(
        F.array_repeat(whole, F.col("passes").cast("int")),
        F.when(F.length("part") > 0, F.array("part")).otherwise(F.array().cast("array<string>")),
    )
    out = both.select("row", F.explode(copies).alias("mixed"))
    return out.select(
        *[F.col("mixed").alias(c) if c == text else F.col(f"row.`{c}`") for c in columns]
    )

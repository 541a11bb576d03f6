"""Removing lines that many documents share, with levelled sorted runs of line hashes.

Documents come in batches by descending id. Line hashes are kept in runs, each sorted by hash. A new
batch groups its own hashes and merge-joins them with the runs. Hashes that no run holds (the
anti-join) enter with their holder, the largest id of the batch that has the line, which is the
largest of all since later ids are smaller. Of known hashes only the number of documents is added,
and nothing at all once they have enough documents to be removed. Both go into a run of the lowest
level; a level of ``fanout`` runs is merged into one run of the next, so a hash is rewritten about
log(batches) times and a batch meets few runs. The runs then name the lines to remove: those with
enough documents, everywhere but in their holder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from smeltery.llm.shared import decoded, id_or_lowest, scratch, slices, stored, text_bytes

BLANK = b" \t\n\x0b\x0c\r"
KEY = ["hi", "lo"]
RUN = ["hi", "lo", "n_docs", "holder"]
# A row's place: its document, and a hash of its text, as rows may share an id or have none.
PLACE = ["doc", "part"]


def line_key(line: bytes, min_chars: int) -> tuple[int, int] | None:
    """128-bit hash of a line's normal form in two signed halves, None if that is too short."""
    key = line.strip(BLANK).lower()
    if len(key) < min_chars or len(key.decode("utf-8", "replace")) < min_chars:
        return None
    digest = xxhash.xxh3_128_digest(key)
    return (
        int.from_bytes(digest[:8], "big", signed=True),
        int.from_bytes(digest[8:], "big", signed=True),
    )


def line_hashes(documents: DataFrame, min_chars: int) -> DataFrame:
    """Distinct long lines of every row: ``doc``, ``part``, ``hi``, ``lo``.

    Expects ``doc``, ``part`` and ``text``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in slices(batches):
            docs, parts, his, los = [], [], [], []
            for doc, part, text in zip(*(c.to_pylist() for c in rows.columns), strict=True):
                for key in {line_key(line, min_chars) for line in text.split(b"\n")} - {None}:
                    docs.append(doc)
                    parts.append(part)
                    his.append(key[0])
                    los.append(key[1])
            columns = [pa.array(x, pa.int64()) for x in (docs, parts, his, los)]
            yield pa.record_batch(columns, names=[*PLACE, *KEY])

    rows = documents.select(*PLACE, text_bytes("text"))
    return rows.mapInArrow(run, "doc BIGINT, part BIGINT, hi BIGINT, lo BIGINT")


class LineRuns:
    """The runs, as Parquet in the shared folder; only their names are held here.

    Batches must come by descending id, and no id may be in two of them. A hash has its holder in
    one row of all runs; its other rows add documents and have none.
    """

    def __init__(self, fanout: int = 2, enough: int = 3):
        self.fanout = fanout
        self.enough = enough
        self.levels: list[list[DataFrame]] = []

    def rows(self) -> DataFrame | None:
        runs = [run for level in self.levels for run in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def add(self, hashes: DataFrame) -> None:
        """Take in the ``doc``, ``hi``, ``lo`` rows of the next batch."""
        once = hashes.select("doc", *KEY).distinct()
        own = once.groupBy(*KEY).agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc").alias("holder")
        )
        held = self.rows()
        if held is not None:
            known = held.groupBy(*KEY).agg(F.sum("n_docs").alias("before"))
            met = own.join(known.hint("merge"), KEY, "left")
            new = F.col("before").isNull()
            own = met.where(new | (F.col("before") < self.enough)).withColumn(
                "holder", F.when(new, F.col("holder"))
            )
        self._place(own, 0)

    def _place(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(
            stored(run.select(*RUN).sortWithinPartitions(*KEY), f"run{level}")
        )
        if len(self.levels[level]) == self.fanout:
            merged = self.merged(self.levels[level])
            self.levels[level] = []
            self._place(merged, level + 1)

    @staticmethod
    def merged(runs: list[DataFrame]) -> DataFrame:
        rows = reduce(DataFrame.unionByName, runs)
        # At most one row of a hash has a holder.
        return rows.groupBy(*KEY).agg(
            F.sum("n_docs").alias("n_docs"), F.any_value("holder", True).alias("holder")
        )

    def shared(self) -> DataFrame:
        """The hashes with enough documents, and the largest id holding each."""
        totals = self.merged([run for level in self.levels for run in level])
        return totals.where(F.col("n_docs") >= self.enough).select(*KEY, "holder")


def descending_batches(documents: DataFrame, batches: int) -> Column:
    """The number of a row's batch by ``doc``, 0 for the largest ids; a document is in one batch.

    Limits are approximate quantiles of the ids, so batches are about equal unless an id is frequent.
    """
    shares = [i / batches for i in range(1, batches)]
    limits = sorted(set(documents.approxQuantile("doc", shares, 0.01))) if shares else []
    # Quantiles come as doubles; any limits do, as long as they cut between ids.
    above = [F.when(F.col("doc") <= F.lit(int(limit)), 1).otherwise(0) for limit in limits]
    return reduce(Column.__add__, above, F.lit(0))


def repeated_lines(
    hashes: Callable[[int], DataFrame], min_docs: int, batches: int, fanout: int
) -> DataFrame:
    """The hashes of lines to remove, with the document that keeps them: ``hi``, ``lo``, ``holder``.

    ``hashes`` gives the rows of a batch by its number.
    """
    runs = LineRuns(fanout, min_docs)
    for i in range(batches):
        runs.add(hashes(i))
    # Stored, so that joins with it have a shuffle of their own, which Spark splits where a line is frequent.
    return stored(runs.shared(), "shared")


def dedup_lines(
    documents: DataFrame,
    min_chars: int = 20,
    min_docs: int = 3,
    batches: int = 4,
    fanout: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """The rows with shared lines removed from their text, and what that took away.

    Columns: ``row`` (a struct of all other columns), ``n_lines``, ``n_dropped``, ``kept_sha256``,
    and ``text`` (the lines that stay, joined by line breaks) unless only digests are asked for. A
    line's key is the line without ASCII white space at its ends, A-Z lower-cased. Keys of
    ``min_chars`` code points or more found in ``min_docs`` documents or more lose their lines except
    in the document with the largest id. A missing text counts as an empty one, which is one empty
    line, and comes back empty. Rows that share an id are one document; rows without id together
    are one, with an id below all others.
    """
    others = [F.col(f"`{c}`") for c in documents.columns if c != text]
    given = documents.select(
        F.struct(*others).alias("row"),
        id_or_lowest(f"`{doc_id}`").alias("doc"),
        F.xxhash64(F.col(f"`{text}`")).alias("part"),
        F.col(f"`{text}`").alias("text"),
    )
    spark, path = documents.sparkSession, scratch(documents.sparkSession, "lines")
    batch = descending_batches(given.select("doc"), batches)
    found = line_hashes(given, min_chars).withColumn("batch", batch)
    found.write.partitionBy("batch").parquet(path)
    hashes = spark.read.schema(found.schema).parquet(path)
    shared = repeated_lines(lambda i: hashes.where(F.col("batch") == i), min_docs, batches, fanout)
    lost = hashes.join(shared.hint("merge"), KEY).where(F.col("doc") != F.col("holder"))
    # At most the lines of one text.
    drops = lost.groupBy(*PLACE).agg(F.collect_set(F.struct(*KEY)).alias("drop"))
    rows = given.join(drops, PLACE, "left").select("row", text_bytes("text").alias("text"), "drop")

    def rebuild(text: bytes, drop: list[dict] | None) -> tuple[bytes, int, int]:
        lines = text.split(b"\n")
        if not drop:
            return text, len(lines), 0
        gone = {(d["hi"], d["lo"]) for d in drop}
        stay = [line for line in lines if line_key(line, min_chars) not in gone]
        return b"\n".join(stay), len(lines), len(lines) - len(stay)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            pairs = zip(part.column("text").to_pylist(), part.column("drop").to_pylist(), strict=True)
            made = [rebuild(*pair) for pair in pairs]
            out = {
                "row": part.column("row"),
                "n_lines": pa.array([m[1] for m in made], pa.int64()),
                "n_dropped": pa.array([m[2] for m in made], pa.int64()),
                "kept_sha256": pa.array([hashlib.sha256(m[0]).hexdigest() for m in made], pa.string()),
            }
            if keep_text:
                out["text"] = pa.array([decoded(m[0]) for m in made], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    schema = StructType([given.schema["row"]])
    schema = schema.add("n_lines", "long").add("n_dropped", "long").add("kept_sha256", "string")
    return rows.mapInArrow(run, schema.add("text", "string") if keep_text else schema)


def without_shared_lines(documents: DataFrame, text: str = "text", **options) -> DataFrame:
    """The documents, all columns in their order, with their text replaced by what stays."""
    done = dedup_lines(documents, text=text, **options)
    return done.select(
        *[F.col("text").alias(c) if c == text else F.col(f"row.`{c}`") for c in documents.columns]
    )

"""Byte-level BPE encoding and decoding by a rank file, with the tiktoken library.

Long texts are cut before encoding, only where the pattern always ends a match: between a character
that is not white space and a blank or line break. No match of the pattern holds white space after
anything else, and its one look-ahead looks a single character past white space, so the cuts change
no match. The parts are encoded one after the other, which keeps the library's buffers small.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smeltery.llm.shared import decoded, slices, text_bytes

# Texts longer than this are cut into parts of about this many characters.
PART = 1 << 16
# Longer runs of white space are encoded without the pattern, whose engine's stack they exhaust.
LONG_SPACE = 1 << 12
# The characters with Unicode's White_Space property, which the pattern's \s matches.
WHITE = "\\t-\\r\\x20\\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
# Python's \s holds every one of those characters, and a few more.
_cut_at = re.compile(r"(?<=\S)(?=[ \n])")
_long_space = re.compile(f"[{WHITE}]{{{LONG_SPACE},}}")


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one token per line, in base 64, and its rank."""
    lines = (line.split() for line in Path(path).read_bytes().splitlines() if line)
    return {base64.b64decode(token): int(rank) for token, rank in lines}


def safe_parts(text: str, size: int = PART) -> Iterator[str]:
    """The text in parts of at least ``size`` characters, cut where no match is cut.

    A text that offers no such place stays whole, however long it is.
    """
    start = 0
    while len(text) - start > size:
        found = _cut_at.search(text, start + size)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


class Codec:
    """Encodes and decodes as the library does, also where its pattern engine gives up."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = public_tokenizers.PATTERN):
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )

    def encode(self, text: str) -> list[int]:
        if len(text) <= LONG_SPACE:
            return self.encoding.encode_ordinary(text)
        ids: list[int] = []
        at = 0
        for run in _long_space.finditer(text):
            # The last white-space character may belong to the next match; at the end it does not.
            end = run.end() if run.end() == len(text) else run.end() - 1
            self._extend(ids, text[at : run.start()])
            ids += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        self._extend(ids, text[at:])
        return ids

    def _extend(self, ids: list[int], text: str) -> None:
        for part in safe_parts(text):
            ids += self.encoding.encode_ordinary(part)

    def decode(self, ids: list[int]) -> bytes:
        """The raw bytes; they need not be valid UTF-8 if the ids were cut."""
        return self.encoding.decode_bytes(ids)


def encode(
    documents: DataFrame,
    ranks: dict[bytes, int],
    pattern: str = public_tokenizers.PATTERN,
    doc_id: str = "doc_id",
    text: str = "text",
    keep_ids: bool = True,
) -> DataFrame:
    """Ids of every text, and digests of the ids and of the bytes decoded from them.

    Columns ``doc_id``, ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and ``ids`` if kept. One
    scan without a shuffle; the ranks are broadcast and bounded by the vocabulary. A missing text
    counts as an empty one: no ids. Repeated rows are encoded each; a missing id stays missing.
    """
    shipped = documents.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shipped.value, pattern)
        decimal = [str(i) for i in range(max(shipped.value.values(), default=-1) + 1)]
        for part in slices(batches):
            counts, id_sums, byte_sums, kept = [], [], [], []
            for value in part.column(1).to_pylist():
                ids = codec.encode(decoded(value))
                written = ",".join(map(decimal.__getitem__, ids))
                counts.append(len(ids))
                id_sums.append(hashlib.sha256(written.encode()).hexdigest())
                byte_sums.append(hashlib.sha256(codec.decode(ids)).hexdigest())
                if keep_ids:
                    kept.append(pa.array(ids, pa.int32()))
            columns = {
                "doc_id": part.column(0),
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(id_sums, pa.string()),
                "decoded_sha256": pa.array(byte_sums, pa.string()),
            }
            if keep_ids:
                ends = pa.array([0, *_running(counts)], pa.int32())
                flat = pa.concat_arrays(kept) if kept else pa.array([], pa.int32())
                columns["ids"] = pa.ListArray.from_arrays(ends, flat)
            yield pa.RecordBatch.from_pydict(columns)

    schema = "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING"
    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_bytes(text))
    return rows.mapInArrow(run, schema + ", ids ARRAY<INT>" * keep_ids)


def _running(counts: list[int]) -> Iterator[int]:
    total = 0
    for n in counts:
        total += n
        yield total


def decode(
    encoded: DataFrame,
    ranks: dict[bytes, int],
    pattern: str = public_tokenizers.PATTERN,
    doc_id: str = "doc_id",
    ids: str = "ids",
) -> DataFrame:
    """The raw bytes of every row's ids: columns ``doc_id`` and ``bytes``; no ids, no bytes."""
    shipped = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(shipped.value, pattern)
        for part in slices(batches):
            raw = [codec.decode(row or []) for row in part.column(1).to_pylist()]
            yield pa.record_batch([part.column(0), pa.array(raw, pa.binary())], ["doc_id", "bytes"])

    rows = encoded.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(ids))
    return rows.mapInArrow(run, "doc_id BIGINT, bytes BINARY")

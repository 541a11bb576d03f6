"""Token counts through the whole-token shortcut.

A byte-level BPE tokenizer first cuts a text into pre-tokens and then merges within each. Before the
job, every string of the vocabulary is encoded alone: those that give exactly one token are proven
to cost one wherever they stand as a pre-token. The job cuts texts with the tokenizer's pattern,
counts proven pre-tokens by a dictionary look-up, and asks the tokenizer only for the rest.

The pattern is run by another regular-expression library than the tokenizer's own. The two know
different Unicode versions, so their cuts are compared beforehand, character by character; a text
with a character on which they were not proven to agree is encoded whole by the tokenizer.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from smeltery.llm.shared import decoded, slices, text_bytes

# Merged pre-tokens remembered per Python worker, and the longest that is worth remembering.
REMEMBERED = 1 << 18
LONGEST = 64


def byte_letters() -> dict[str, int]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def single_tokens(tokenizer: Tokenizer) -> list[str]:
    """The vocabulary strings that the tokenizer encodes, alone, as one token."""
    letters, texts = byte_letters(), []
    for written in tokenizer.get_vocab(with_added_tokens=False):
        try:
            texts.append(bytes(letters[c] for c in written).decode())
        except (KeyError, UnicodeDecodeError):  # part of a character; never a whole pre-token
            continue
    found = tokenizer.encode_batch_fast(texts, add_special_tokens=False)
    return [t for t, e in zip(texts, found, strict=True) if len(e.ids) == 1]


def unproven_characters(tokenizer: Tokenizer, pattern: str) -> str:
    """A character class of all characters on which the two libraries may cut differently."""
    known = [
        c
        for c in map(chr, range(0x110000))
        if unicodedata.category(c) not in ("Cn", "Co", "Cs")
    ]
    probes = [f"a{c}1{c}!{c} {c}" for c in known]
    ours, agreed = regex.compile(pattern), set()
    for start in range(0, len(probes), 4096):
        part = probes[start : start + 4096]
        whole = "\n".join(part)
        cuts = {end for _, (_, end) in tokenizer.pre_tokenizer.pre_tokenize_str(whole)}
        mine = {m.end() for m in ours.finditer(whole)}
        at = 0
        for c, probe in zip(known[start : start + 4096], part, strict=True):
            inside = range(at, at + len(probe))
            if all((i in cuts) == (i in mine) for i in inside):
                agreed.add(ord(c))
            at += len(probe) + 1
    ranges, start = [], None
    for code in range(0x110001):
        odd = code < 0x110000 and code not in agreed
        if odd and start is None:
            start = code
        elif not odd and start is not None:
            ranges.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return f"[{''.join(ranges)}]" if ranges else r"(?!)"


@functools.lru_cache(maxsize=2)
def proven(path: str, pattern: str) -> tuple[str, tuple[str, ...], str]:
    """The tokenizer file with what was proven about it; done once per driver."""
    content = Path(path).read_text()
    tokenizer = Tokenizer.from_str(content)
    return content, tuple(single_tokens(tokenizer)), unproven_characters(tokenizer, pattern)


class Costs(dict):
    """Tokens by pre-token: the proven ones, and those merged lately."""

    def __init__(self, tokenizer: Tokenizer, singles: tuple[str, ...]):
        super().__init__(dict.fromkeys(singles, 1))
        # A pre-token needs only the tokenizer's merges, which take it letter by byte.
        self.merge, self.room = tokenizer.model.tokenize, len(self) + REMEMBERED
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.singles = singles

    def __missing__(self, piece: str) -> int:
        cost = len(self.merge(piece.encode().decode("latin-1").translate(self.letters)))
        if len(piece) <= LONGEST:
            if len(self) >= self.room:
                self.clear()
                self.update(dict.fromkeys(self.singles, 1))
            self[piece] = cost
        return cost


class Counter:
    """Counts tokens as ``tokenizer.encode(text, add_special_tokens=False)`` would."""

    def __init__(self, content: str, singles: tuple[str, ...], unproven: str, pattern: str):
        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.cost = Costs(self.tokenizer, singles).__getitem__
        self.cut = regex.compile(pattern).findall
        # The class is slow to search; it sees every character once, not every text.
        self.odd, self.met = re.compile(unproven).findall, set()
        added = self.tokenizer.get_added_tokens_decoder().values()
        # Strings of added tokens cut the text and count one each; other rules need the tokenizer.
        self.plain = [t.content for t in added if not (t.lstrip or t.rstrip or t.single_word)]
        self.special = [t.content for t in added if t.content not in self.plain]
        self.split = re.compile("|".join(map(re.escape, self.plain)) or r"(?!)").split

    def unproven(self, text: str) -> bool:
        """Whether the text has a character on which the two libraries may cut differently."""
        fresh = set(text) - self.met
        if not fresh:
            return False
        odd = self.odd("".join(fresh))
        self.met |= fresh.difference(odd)
        return bool(odd)

    def __call__(self, text: str) -> int:
        if any(s in text for s in self.special) or not text.isascii() and self.unproven(text):
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        parts = self.split(text)
        return len(parts) - 1 + sum(sum(map(self.cost, self.cut(part))) for part in parts)


def token_counts(
    documents: DataFrame,
    path: str,
    pattern: str = public_tokenizers.PATTERN,
    max_tokens: int = 1024,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Tokens of every text, as the tokenizer of a byte-level BPE file gives them.

    Columns ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``. One scan without a shuffle; a
    worker holds one slice of texts and a bounded table of merged pre-tokens. A missing text counts
    as an empty one: no bytes, no tokens. Repeated rows are counted each; a missing id stays
    missing. Special strings in a text are the special token, the library's default.
    """
    content, singles, unproven = proven(path, pattern)
    shipped = documents.sparkSession.sparkContext.broadcast((content, singles, unproven))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(*shipped.value, pattern)
        for part in slices(batches):
            texts = part.column(1).to_pylist()
            tokens = [counter(decoded(t)) for t in texts]
            yield pa.record_batch(
                [
                    part.column(0),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > max_tokens for n in tokens], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = documents.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_bytes(text))
    return rows.mapInArrow(
        count, "doc_id BIGINT, n_bytes BIGINT, n_tokens BIGINT, over_limit BOOLEAN"
    )

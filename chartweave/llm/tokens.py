"""Encoding of a corpus with a public byte-level BPE tokenizer, and back.

Method: the tokenizers library over Arrow batches.  Its word splitter never lets a token cross from a non-blank
to a blank, so a text falls into pieces that start at blanks with no white space on either side, and the ids of a text
are those of its pieces in a row; the pieces of a batch that a worker hasn't met yet are encoded in one call.  The byte table maps
the printable characters of the vocabulary to bytes: with it ids give byte lengths, those give character offsets,
and decoding joins characters that are split over tokens.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: At most so many pieces are remembered by a worker (about 200 bytes each).
MEMORY = 400_000
_GAP = re.compile(r"(?<=\S) (?=\S)")
#: A blank beside white space of any kind: a vocabulary may have a token for such a run, so it isn't cut.
_RUN = re.compile(r"\s(?:(?<= )\s|(?<! ) )")


def default_path() -> str:
    """byte_bpe_50k.json in ``CHARTWEAVE_TOKENIZERS`` or else in /opt/tokenizers."""
    return os.path.join(os.environ.get("CHARTWEAVE_TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.json")


@functools.lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@functools.lru_cache(maxsize=1)
def byte_table() -> dict[str, int]:
    """Printable stand-in character -> byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in own}
    for k, b in enumerate(b for b in range(256) if b not in set(own)):
        table[chr(256 + k)] = b
    return table


@functools.lru_cache(maxsize=4)
def token_bytes(path: str) -> dict[int, bytes]:
    table = byte_table()
    return {i: bytes(table[c] for c in w) if all(c in table for c in w) else w.encode() for w, i in tokenizer(path).get_vocab().items()}


def decode(ids: list[int], path: str) -> str:
    """The text of a list of ids; a character split over tokens is whole again once all its bytes are there."""
    known = token_bytes(path)
    return b"".join(known[i] for i in ids).decode("utf-8", "replace")


def offsets(text: str, ids: list[int], path: str) -> list[tuple[int, int]]:
    """Character span of each id, end excluded; a token that holds only part of a character spans that character."""
    known = token_bytes(path)
    ends = np.cumsum([len(known[i]) for i in ids])
    raw = np.frombuffer(text.encode(), np.uint8)
    char_of = np.cumsum((raw & 0xC0) != 0x80) - 1
    return [(int(char_of[e - len(known[i])]), int(char_of[e - 1]) + 1) for i, e in zip(ids, ends)]


class Encoder:
    """Ids of texts by pieces; ``seen`` maps a piece without its leading blank to its ids with it."""

    def __init__(self, path: str):
        self.t, self.seen = tokenizer(path), {}

    def words(self, text: str) -> list[str]:
        return text.split(" ") if text[-1] != " " and "  " not in text and not _RUN.search(text) else _GAP.split(text)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and where each text's ids end; null and empty texts have none."""
        if len(self.seen) > MEMORY:
            self.seen.clear()
        seen = self.seen
        split = [self.words(t) if t else [] for t in texts]
        heads = [w[0] for w in split if w]
        new = list(set(chain.from_iterable(w[1:] for w in split)).difference(seen))
        if new:
            for w, e in zip(new, self.t.encode_batch_fast([" " + w for w in new], add_special_tokens=False)):
                seen[w] = e.ids
        first = iter(self.t.encode_batch_fast(heads, add_special_tokens=False)) if heads else iter(())
        out, ends, n = [], [], 0
        for w in split:
            if w:
                ids = next(first).ids
                ids.extend(chain.from_iterable(map(seen.__getitem__, w[1:])))
                n += len(ids)
                out.append(np.array(ids, np.int32))
            ends.append(n)
        return (np.concatenate(out) if out else np.zeros(0, np.int32)), np.array(ends, np.int64)


def encode_corpus(df: DataFrame, key: str, text: str, path: str | None = None) -> DataFrame:
    """``(key, ids array<int>)`` of every row, without special tokens; strings of special tokens in a text are
    ordinary text.  Null and empty texts give an empty list, repeated keys stay repeated rows, no row is lost."""
    path = path or default_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = Encoder(path)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                flat, ends = enc.encode(part.column(1).to_pylist())
                at = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(at, pa.array(flat, pa.int32()))], names=[key, "ids"])

    return df.select(key, text).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, ids array<int>")

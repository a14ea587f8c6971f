"""Encoding of whole texts with a public byte-level BPE vocabulary.

Exact BPE by dynamic programming: of every prefix of a pretoken only the last token of its encoding is
kept. It is the one vocabulary entry ending there (found by an Aho-Corasick automaton over the
vocabulary, whose suffix links list all entries that end at a position) that is compatible with the last
token of the prefix before it: two tokens are compatible when byte pair merging of their joined bytes
gives just these two. Following the stored tokens back from the end gives the ids, without simulating the
merges of the whole pretoken.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

#: Where the public vocabulary files lie, and the pattern that cuts a text into pretokens (fixed value of the vocabulary).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CACHE_ENTRIES = 400_000  # pretokens remembered by one worker; when full it starts anew


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, from a file of base64 tokens and ranks."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


class PrefixEncoder(dict):
    """Maps a pretoken (str) to the little-endian int32 bytes of its ids; computes what it doesn't hold yet."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.ends = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for token, i in ranks.items():
            self.ends.add_word(token.decode("latin-1"), i)
        self.ends.make_automaton()
        self.compatible = lru_cache(maxsize=1 << 20)(self._compatible)

    def _merge(self, data: bytes) -> list[int]:
        """Plain byte pair merging; only ever applied to the bytes of two tokens."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            rank, i = min((self.ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
            if rank == 1 << 60:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _compatible(self, left: int, right: int) -> bool:
        return self._merge(self.tokens[left] + self.tokens[right]) == [left, right]

    def encode(self, data: bytes) -> list[int]:
        """Ids of one pretoken."""
        if (whole := self.ranks.get(data)) is not None:
            return [whole]
        last: list[int] = [-1] * len(data)
        for end, token in self.ends.iter(data.decode("latin-1")):
            if last[end] >= 0:
                continue
            before = end - len(self.tokens[token])
            if before < 0 or (last[before] >= 0 and self.compatible(last[before], token)):
                last[end] = token
        out: list[int] = []
        at = len(data) - 1
        while at >= 0:
            out.append(last[at])
            at -= len(self.tokens[last[at]])
        return out[::-1]

    def __missing__(self, pretoken: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        ids = np.array(self.encode(pretoken.encode("utf-8")), "<i4").tobytes()
        if len(pretoken) <= 64:
            self[pretoken] = ids
        return ids


@lru_cache(maxsize=2)
def _worker_encoder(key: int, box) -> tuple:  # noqa: ANN001
    return PrefixEncoder(box.value), regex.compile(PATTERN)


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, ids) of every row: the ids of its whole text, without special tokens, as array<int>.

    Null, empty texts: an empty list; blank texts are encoded as they stand. Strings that look like
    special tokens are ordinary text. Repeated rows give repeated rows, an empty table none; other
    columns are ignored. One pass without a shuffle. The vocabulary is read once by the driver and
    broadcast (under a megabyte, the same for any corpus).
    """
    box = docs.sparkSession.sparkContext.broadcast(read_ranks(vocabulary))
    key = id(box)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, pattern = _worker_encoder(key, box)
        get, cut = encoder.__getitem__, pattern.findall
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                coded = [b"".join(map(get, cut(t))) if t else b"" for t in part.column(1).to_pylist()]
                offsets = np.zeros(len(coded) + 1, np.int32)
                np.cumsum([len(c) >> 2 for c in coded], out=offsets[1:])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(coded), "<i4")))
                yield pa.RecordBatch.from_arrays([part.column(0), ids], [id_col, "ids"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")

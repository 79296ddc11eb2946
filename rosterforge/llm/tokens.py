"""Problem 8: token ids of a public byte-level BPE vocabulary.

Texts are cut into pre-tokens by the vocabulary's pattern; each pre-token's
bytes are merged by a hierarchical-bitmap rank queue. Every merge rank has a
bucket of positions in a linked list of parts; a bitmap of non-empty buckets
with a summary bitmap over its words gives the lowest rank by two find-first-set
steps. A bucket is emptied from left to right; entries whose pair has changed
since are stale and skipped. Each merge costs constant time whatever the
length, so very long pre-tokens are no special case. Pre-tokens met before are
looked up.

The vocabulary (one file, a parameter) is read on the driver and shipped once
to every worker; its size is that of the file. Rows are encoded where they
are, without a shuffle.

Defined results: NULL and empty texts give an empty list; strings of special
tokens in a text are ordinary text; ids are without special tokens.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import pandas as pd
import regex
from pyspark.sql import DataFrame

#: Folder of the public vocabulary files.
TOKENIZER_DIR = os.environ.get("ROSTERFORGE_TOKENIZERS", "/opt/tokenizers")
#: Pre-tokens a worker remembers before it starts afresh, and the most bytes of one that is remembered.
REMEMBERED, REMEMBERED_BYTES = 150_000, 400

# Fixed value: the pre-token pattern published with the 50k byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_WORD = 64


def read_ranks(name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR) -> dict[bytes, int]:
    """Token bytes -> id, from a vocabulary file of ranks."""
    with open(os.path.join(folder, f"{name}.tiktoken"), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class RankQueue:
    """Positions filed by merge rank; lowest rank first, found by bitmap and summary bitmap."""

    __slots__ = ("buckets", "words", "summary")

    def __init__(self) -> None:
        self.buckets: dict[int, list[int]] = {}
        self.words: dict[int, int] = {}
        self.summary = 0

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [position]
            word, bit = divmod(rank, _WORD)
            self.words[word] = self.words.get(word, 0) | 1 << bit
            self.summary |= 1 << word
        else:
            bucket.append(position)

    def pop(self) -> tuple[int, list[int]] | None:
        """The lowest rank and its positions from left to right."""
        if not self.summary:
            return None
        word = (self.summary & -self.summary).bit_length() - 1
        bits = self.words[word]
        low = bits & -bits
        bits ^= low
        self.words[word] = bits
        if not bits:
            self.summary ^= 1 << word
        rank = word * _WORD + low.bit_length() - 1
        positions = self.buckets.pop(rank)
        positions.sort()
        return rank, positions


class Encoder:
    """Byte-level BPE over a table of token bytes and ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN) -> None:
        self.ranks = ranks
        self.tokens = {i: t for t, i in ranks.items()}
        self.byte_ids = [ranks[bytes([b])] for b in range(256)]
        self.find = regex.compile(pattern).findall
        self.pairs: dict[tuple[int, int], int] = {}
        self.known: dict[str, tuple[int, ...]] = {}

    def rank_of(self, left: int, right: int) -> int:
        """Id of the merged pair, or -1."""
        found = self.pairs.get((left, right))
        if found is None:
            found = self.ranks.get(self.tokens[left] + self.tokens[right], -1)
            if len(self.pairs) > 500_000:
                self.pairs.clear()
            self.pairs[left, right] = found
        return found

    def merge(self, data: bytes) -> list[int]:
        """Ids of one pre-token's bytes."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        ids: list[int] = [self.byte_ids[b] for b in data]
        n = len(ids)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        queue, rank_of = RankQueue(), self.rank_of
        for i in range(n - 1):
            rank = rank_of(ids[i], ids[i + 1])
            if rank >= 0:
                queue.push(rank, i)
        while (lowest := queue.pop()) is not None:
            rank, positions = lowest
            for k, i in enumerate(positions):
                if ids[i] < 0 or (j := after[i]) >= n or rank_of(ids[i], ids[j]) != rank:
                    continue  # stale
                ids[i], ids[j] = rank, -1
                right = after[i] = after[j]
                least = rank
                if right < n:
                    before[right] = i
                    r = rank_of(rank, ids[right])
                    if r >= 0:
                        queue.push(r, i)
                        least = min(least, r)
                left = before[i]
                if left >= 0:
                    r = rank_of(ids[left], rank)
                    if r >= 0:
                        queue.push(r, left)
                        least = min(least, r)
                if least < rank:  # a lower rank arose: the rest of this bucket waits
                    for later in positions[k + 1 :]:
                        queue.push(rank, later)
                    break
        return [t for t in ids if t >= 0]

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; [] for None and ''."""
        if not text:
            return []
        out: list[int] = []
        known = self.known
        for piece in self.find(text):
            ids = known.get(piece)
            if ids is None:
                data = piece.encode("utf-8", "surrogatepass")
                ids = tuple(self.merge(data))
                if len(data) <= REMEMBERED_BYTES:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out += ids
        return out


def _shipped(df: DataFrame, name: str, folder: str):  # noqa: ANN202 - a Spark broadcast
    return df.sparkSession.sparkContext.broadcast(read_ranks(name, folder))


def encode_column(
    df: DataFrame, id_col: str, text_col: str, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR
) -> DataFrame:
    """``id, ids`` of every row."""
    ranks = _shipped(df, name, folder)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for batch in batches:
            yield pd.DataFrame({"id": batch[id_col], "ids": [encoder.encode(t) for t in batch[text_col]]})

    return df.select(id_col, text_col).mapInPandas(encode, f"id {dict(df.dtypes)[id_col]}, ids array<int>")


def count_column(
    df: DataFrame, id_col: str, text_col: str, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR
) -> DataFrame:
    """``id, n_tokens`` of every row."""
    ranks = _shipped(df, name, folder)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(ranks.value)
        for batch in batches:
            yield pd.DataFrame({"id": batch[id_col], "n_tokens": [len(encoder.encode(t)) for t in batch[text_col]]})

    return df.select(id_col, text_col).mapInPandas(count, f"id {dict(df.dtypes)[id_col]}, n_tokens long")


def byte_lengths(
    encoded: DataFrame, name: str = "byte_bpe_50k", folder: str = TOKENIZER_DIR
) -> DataFrame:
    """``id, n_bytes`` of what the ids of every row stand for; a check that no byte was lost."""
    ranks = _shipped(encoded, name, folder)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size = {i: len(t) for t, i in ranks.value.items()}
        for batch in batches:
            yield pd.DataFrame({"id": batch["id"], "n_bytes": [sum(size[i] for i in ids) for ids in batch["ids"]]})

    return encoded.select("id", "ids").mapInPandas(measure, f"id {dict(encoded.dtypes)['id']}, n_bytes long")

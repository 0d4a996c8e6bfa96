"""Byte-level BPE with a hierarchical-bitmap rank queue.

Pairs wait in one bucket per merge rank; a two-level bitmap over the ranks finds the lowest
non-empty bucket by find-first-set. Buckets hold positions of a linked list of symbols,
leftmost first; a position whose pair has changed since is stale and skipped. A merge costs
the same wherever it lies, so a pre-token of a million bytes takes time in proportion to its
length (and the logarithm of a bucket).

Spark spreads the documents; each Python worker keeps one encoder with bounded caches.

Defined results: a null or empty text has no ids and decodes to no bytes; a null id list
decodes to no bytes. Rows are independent, so null or repeated doc_ids and any further
columns pass through unchanged (an input column named like the output is replaced).
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BITS = 10
WORD_MASK = (1 << WORD_BITS) - 1
WORD_BITS_LENGTH = 1 << WORD_BITS  # positions that fit one bitmap word
CACHED_PIECES = 800_000
CACHED_PARTS = 400_000
LONGEST_CACHED = 32


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: always merge the leftmost pair of the lowest rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    end = list(range(1, len(piece) + 1))  # a symbol's end is its right neighbour's start
    (_merge_long if len(piece) > WORD_BITS_LENGTH else _merge_short)(piece, ranks.get, end)
    ids = []
    at = 0
    while at < len(piece):
        ids.append(ranks[piece[at:end[at]]])
        at = end[at]
    return ids


def _merge_short(piece: bytes, rank_of, end: list[int]) -> None:
    """Buckets are bit masks of positions, so leftmost is find-first-set as well."""
    size = len(piece)
    before = list(range(-1, size - 1))
    pair = [-1] * size  # rank of the pair that starts here, -1 for none
    buckets: dict[int, int] = {}
    words: dict[int, int] = {}
    summary = 0
    for at in range(size - 1):
        rank = rank_of(piece[at:at + 2])
        if rank is not None:
            pair[at] = rank
            if rank in buckets:
                buckets[rank] |= 1 << at
            else:
                buckets[rank] = 1 << at
                word = rank >> WORD_BITS
                words[word] = words.get(word, 0) | 1 << (rank & WORD_MASK)
                summary |= 1 << word
    while summary:
        word = (summary & -summary).bit_length() - 1
        bits = words[word]
        lowest = bits & -bits
        rank = (word << WORD_BITS) + lowest.bit_length() - 1
        bucket = buckets[rank]
        first = bucket & -bucket
        if bucket == first:
            del buckets[rank]
            if bits == lowest:
                del words[word]
                summary &= summary - 1
            else:
                words[word] = bits ^ lowest
        else:
            buckets[rank] = bucket ^ first
        at = first.bit_length() - 1
        if pair[at] != rank:
            continue
        right = end[at]
        stop = end[at] = end[right]
        pair[right] = pair[at] = -1
        if stop < size:
            before[stop] = at
            new = rank_of(piece[at:end[stop]])
            if new is not None:
                pair[at] = new
                if new in buckets:
                    buckets[new] |= 1 << at
                else:
                    buckets[new] = 1 << at
                    word = new >> WORD_BITS
                    words[word] = words.get(word, 0) | 1 << (new & WORD_MASK)
                    summary |= 1 << word
        left = before[at]
        if left >= 0:
            new = rank_of(piece[left:stop])
            if new is None:
                pair[left] = -1
            else:
                pair[left] = new
                if new in buckets:
                    buckets[new] |= 1 << left
                else:
                    buckets[new] = 1 << left
                    word = new >> WORD_BITS
                    words[word] = words.get(word, 0) | 1 << (new & WORD_MASK)
                    summary |= 1 << word


def _merge_long(piece: bytes, rank_of, end: list[int]) -> None:
    """Buckets are heaps of positions: masks of a long piece would be long numbers."""
    size = len(piece)
    before = list(range(-1, size - 1))
    pair = [-1] * size
    buckets: dict[int, list[int]] = {}
    words: dict[int, int] = {}
    summary = 0

    def push(at: int, rank: int | None) -> None:
        nonlocal summary
        if rank is None:
            pair[at] = -1
            return
        pair[at] = rank
        if rank in buckets:
            heappush(buckets[rank], at)
        else:
            buckets[rank] = [at]
            word = rank >> WORD_BITS
            words[word] = words.get(word, 0) | 1 << (rank & WORD_MASK)
            summary |= 1 << word

    for at in range(size - 1):
        push(at, rank_of(piece[at:at + 2]))
    while summary:
        word = (summary & -summary).bit_length() - 1
        bits = words[word]
        lowest = bits & -bits
        rank = (word << WORD_BITS) + lowest.bit_length() - 1
        at = heappop(buckets[rank])
        if not buckets[rank]:
            del buckets[rank]
            words[word] = bits ^ lowest
            if bits == lowest:
                summary &= summary - 1
        if pair[at] != rank:
            continue
        right = end[at]
        stop = end[at] = end[right]
        pair[right] = -1
        if stop < size:
            before[stop] = at
            push(at, rank_of(piece[at:end[stop]]))
        else:
            pair[at] = -1
        left = before[at]
        if left >= 0:
            push(left, rank_of(piece[left:stop]))


class _Cache(dict):
    """Computes missing short pieces; emptied when full, so memory stays bounded."""

    def __init__(self, compute, most: int):
        super().__init__()
        self.compute = compute
        self.most = most

    def __missing__(self, piece: str) -> bytes:
        value = self.compute(piece)
        if len(piece) <= LONGEST_CACHED:
            if len(self) >= self.most:
                self.clear()
            self[piece] = value
        return value


class _Blank(Exception):
    """A part of the text starts with white space, so it depends on what stands before."""


class Encoder:
    """Text to packed ids and back. Packed ids are little-endian unsigned 32-bit integers."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        lines = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.split = regex.compile(pattern).findall
        self.blank = regex.compile(r"\s").match
        self.pieces = _Cache(self._piece, CACHED_PIECES)
        self.parts = _Cache(self._part, CACHED_PARTS)

    def _piece(self, piece: str) -> bytes:
        ids = merge_bytes(piece.encode(), self.ranks)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _matches(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def _part(self, part: str) -> bytes:
        if not part or self.blank(part):
            raise _Blank
        return self._matches(" " + part)

    def encode(self, text: str) -> bytes:
        """Packed ids.

        A single space before anything but white space always begins a match, so parts between
        such spaces are looked up whole; a text with other spacing is matched as one.
        """
        head, *rest = text.split(" ")
        try:
            return self._matches(head) + b"".join([self.parts[part] for part in rest])
        except _Blank:
            return self._matches(text)

    def decode(self, packed: bytes) -> bytes:
        ids = np.frombuffer(packed, dtype="<u4").tolist()
        return b"".join(map(self.tokens.__getitem__, ids))


_ENCODERS: dict[tuple[str, str], Encoder] = {}


class Tokenizer:
    """A rank file and its split pattern, sent to the workers once."""

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        with open(rank_path, "rb") as source:
            content = source.read()
        self.key = (hashlib.sha256(content).hexdigest(), pattern)
        self.content = spark.sparkContext.broadcast(content)

    def encoder(self) -> Encoder:
        made = _ENCODERS.get(self.key)
        if made is None:
            made = _ENCODERS[self.key] = Encoder(self.content.value, self.key[1])
        return made


def public_tokenizer(
    spark: SparkSession, name: str = "byte_bpe_multi_50k.tiktoken"
) -> Tokenizer:
    """A rank file of the installed public tokenizers with their split pattern."""
    import public_tokenizers

    return Tokenizer(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


def encoded(docs: DataFrame, tokenizer: Tokenizer, output: str = "token_ids") -> DataFrame:
    """Adds the ids of each text as an array."""

    @F.pandas_udf("array<bigint>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer.encoder().encode
        for batch in texts:
            yield pd.Series([
                np.frombuffer(encode(text or ""), dtype="<u4").astype(np.int64) for text in batch
            ], dtype=object)

    return docs.withColumn(output, ids(F.col("text")))


def decoded(docs: DataFrame, tokenizer: Tokenizer, column: str = "token_ids",
            output: str = "decoded") -> DataFrame:
    """Adds the bytes that the ids stand for."""

    @F.pandas_udf("binary")
    def content(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        decode = tokenizer.encoder().decode
        for batch in lists:
            yield pd.Series([
                decode(np.asarray([] if ids is None else ids, dtype="<u4").tobytes())
                for ids in batch
            ], dtype=object)

    return docs.withColumn(output, content(F.col(column)))


def round_trip(docs: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """Adds n_tokens, ids_sha256 and decoded_sha256: encoded, then decoded from the ids.

    Both ways run in one call, so the ids do not travel between the JVM and Python.
    """

    @F.pandas_udf("n_tokens bigint, ids_sha256 string, decoded_sha256 string")
    def digests(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encoder = tokenizer.encoder()
        for batch in texts:
            rows = []
            for text in batch:
                packed = encoder.encode(text or "")
                rows.append((
                    len(packed) // 4, hashlib.sha256(packed).hexdigest(),
                    hashlib.sha256(encoder.decode(packed)).hexdigest(),
                ))
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])

    added = ("n_tokens", "ids_sha256", "decoded_sha256")
    names = [f"`{c}`" for c in docs.columns if c not in (*added, "text")]
    return docs.select(*names, digests(F.col("text")).alias("_ft_made")).select(
        *names, *[F.col(f"_ft_made.{name}").alias(name) for name in added]
    )

"""Hashes of words and of runs of consecutive words, for whole batches of texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from xxhash import xxh3_64_intdigest

CHUNK_BYTES = 2_000_000

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_C = np.uint64(0xD6E8FEB86659FD93)


def text_chunks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a batch with their texts (null: empty), a few megabytes at a time."""
    texts = batch.column(column)
    start, size, held = 0, 0, []
    for at in range(batch.num_rows):
        value = texts[at].as_py()
        raw = b"" if value is None else value if isinstance(value, bytes) else value.encode()
        held.append(raw)
        size += len(raw)
        if size >= CHUNK_BYTES:
            yield batch.slice(start, len(held)), held
            start, size, held = at + 1, 0, []
    if held:
        yield batch.slice(start, len(held)), held


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Order-aware hash of pairs."""
    x = a * _A + (b ^ (b >> np.uint64(31))) * _B
    x ^= x >> np.uint64(29)
    x *= _C
    x ^= x >> np.uint64(32)
    return x


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """Hash of every run of ``length`` consecutive items, by doubling."""
    if len(hashes) < length:
        return np.zeros(0, dtype=np.uint64)
    span, runs = 1, hashes
    while span * 2 <= length:
        runs = mixed(runs[:-span], runs[span:])
        span *= 2
    if span < length:
        runs = mixed(runs[:len(hashes) - length + 1], runs[length - span:])
    return runs

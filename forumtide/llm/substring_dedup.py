"""Substring deduplication by relative Lempel-Ziv parsing against indexed reference blocks.

Any window of 50 words is represented by its anchor, the least hashed 12-word run inside it,
so equal windows have equal anchors. Only anchors found in two documents are followed. The
reference block of an anchor holds the windows around it in the smallest such doc_id, indexed
by window. Every other document's windows around the anchor are factored greedily against the
block: a factor is the longest run of windows that follows the block from a found place, so a
factor of n windows is n + 49 equal words and becomes a duplicate span. At every factor
boundary the next window is looked up again, so windows across boundaries are not lost. A
window that is in no factor goes to a count by window over all documents, which finds those
shared by documents other than the block's.

Windows are compared by two independent 64-bit hashes (anchor and window). No step collects
an anchor's documents: blocks belong to one document, and counts combine before the shuffle.

Defined results: a null or empty text has no words. Rows with a null doc_id keep everything
and are no reference. Rows sharing a doc_id do not remove from each other; however often a
row repeats, its anchors and spans are gathered once. Texts under 50
words lose nothing. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.llm.grams import run_hashes, text_chunks, word_hashes
from forumtide.session import materialize

WINDOW = 50
RUN = 12
RUNS = WINDOW - RUN + 1  # runs in a window

_SCANNED = "doc_id bigint, text_hash bigint, n_words bigint, kept_sha256 string, anchors array<bigint>"
_SEGMENT = "anchor bigint, doc_id bigint, text_hash bigint, at int, windows binary, leads boolean"
_FACTOR = "doc_id bigint, text_hash bigint, at int, length int, anchor bigint, window bigint"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"


def _anchor_places(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Window starts, the place of each window's anchor, and all run hashes.

    ``ends`` is, per word, where its text ends; windows do not cross it.
    """
    runs = run_hashes(hashes, RUN)
    if len(runs) < RUNS:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, runs
    least = np.lib.stride_tricks.sliding_window_view(runs, RUNS).argmin(axis=1)
    starts = np.flatnonzero(np.arange(len(least)) + WINDOW <= ends[:len(least)])
    return starts, starts + least[starts], runs


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text: number and digest of its words, and its anchors."""
    for batch in batches:
        for part, texts in text_chunks(batch, "text"):
            lists = [text.split() for text in texts]
            counts = np.array([len(words) for words in lists], dtype=np.int64)
            ends = np.cumsum(counts)
            hashes = word_hashes([word for words in lists for word in words])
            starts, places, runs = _anchor_places(hashes, np.repeat(ends, counts))
            # Places grow along a text, so equal ones are neighbours.
            new = np.r_[True, places[1:] != places[:-1]] if len(places) else np.zeros(0, bool)
            owner = np.searchsorted(ends, starts[new], side="right")
            offsets = np.searchsorted(owner, np.arange(len(texts) + 1))
            anchors = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()), pa.array(_signed(runs[places[new]]), pa.int64())
            )
            digests = [hashlib.sha256(b" ".join(words)).hexdigest() for words in lists]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("text_hash"), pa.array(counts),
                 pa.array(digests, pa.string()), anchors],
                names=["doc_id", "text_hash", "n_words", "kept_sha256", "anchors"],
            )


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per followed anchor of a text: the hashes of the windows it stands for."""
    for batch in batches:
        for part, texts in text_chunks(batch, "text"):
            out: list[tuple] = []
            for row, text in enumerate(texts):
                doc, text_hash = part.column("doc_id")[row].as_py(), part.column("text_hash")[row].as_py()
                shared = np.array(part.column("anchors")[row].as_py(), dtype=np.int64)
                firsts = np.array(part.column("firsts")[row].as_py(), dtype=np.int64)
                order = np.argsort(shared)
                shared, firsts = shared[order], firsts[order]
                hashes = word_hashes(text.split())
                _, places, runs = _anchor_places(hashes, np.full(len(hashes), len(hashes)))
                windows = run_hashes(hashes, WINDOW)
                begins = np.flatnonzero(np.r_[True, places[1:] != places[:-1]])
                stops = np.r_[begins[1:], len(places)]
                anchors = _signed(runs[places[begins]])
                found = np.minimum(np.searchsorted(shared, anchors), len(shared) - 1)
                for k in np.flatnonzero(shared[found] == anchors):
                    a, b = begins[k], stops[k]
                    out.append((
                        int(anchors[k]), doc, text_hash, int(a), windows[a:b].tobytes(),
                        bool(firsts[found[k]] == doc),
                    ))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.bool_())
                names = ("anchor", "doc_id", "text_hash", "at", "windows", "leads")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=list(names)
                )


def factors(windows: list[int], blocks: list[list[int]]) -> Iterator[tuple[int, int]]:
    """Greedy parse: (place, length) of each factor; windows outside are in no block.

    From each place the longest run of windows along any found place of the blocks is taken.
    """
    index: dict[int, list[tuple[int, int]]] = {}
    for b, block in enumerate(blocks):
        for i, window in enumerate(block):
            index.setdefault(window, []).append((b, i))
    at = 0
    while at < len(windows):
        longest = 0
        for b, i in index.get(windows[at], ()):
            block, n = blocks[b], 0
            while at + n < len(windows) and i + n < len(block) and block[i + n] == windows[at + n]:
                n += 1
            longest = max(longest, n)
        if longest:
            yield at, longest
        at += max(longest, 1)


def _factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans found in the reference block; what is left over, window by window."""
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(name).to_pylist() for name in
                   ("anchor", "doc_id", "text_hash", "at", "windows", "blocks")]
        for anchor, doc, text_hash, at, raw, blocks in zip(*columns):
            if raw in blocks:
                out.append((doc, text_hash, at, len(raw) // 8, None, None))
                continue
            windows = np.frombuffer(raw, dtype=np.int64).tolist()
            held = [np.frombuffer(block, dtype=np.int64).tolist() for block in blocks]
            free = np.ones(len(windows), dtype=bool)
            for start, length in factors(windows, held):
                free[start:start + length] = False
                out.append((doc, text_hash, at + start, length, None, None))
            for start in np.flatnonzero(free).tolist():
                out.append((doc, text_hash, at + start, 0, anchor, windows[start]))
        if out:
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
            names = ("doc_id", "text_hash", "at", "length", "anchor", "window")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=list(names)
            )


def kept_words(words: list[bytes], spans: list[tuple[int, int]]) -> list[bytes]:
    """Words outside all spans; a span of n windows from a place covers n + 49 words."""
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for at, length in spans:
        change[at] += 1
        change[at + length - 1 + WINDOW] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in text_chunks(batch, "text"):
            counts, gone, digests = [], [], []
            for row, text in enumerate(texts):
                words = text.split()
                starts = part.column("starts")[row].as_py()
                lengths = part.column("lengths")[row].as_py()
                kept = kept_words(words, list(zip(starts, lengths)))
                counts.append(len(words))
                gone.append(len(words) - len(kept))
                digests.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(gone, pa.int64()),
                 pa.array(digests, pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept_sha256"],
            )


def duplicate_spans(texts: DataFrame, scanned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans (doc_id, text_hash, at, length in windows), and the followed texts. Runs jobs."""
    anchors = scanned.where(F.col("doc_id").isNotNull()).select(
        "doc_id", "text_hash", F.explode("anchors").alias("anchor")
    )
    shared = materialize(
        anchors.groupBy("anchor").agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
        ).where(F.col("first") < F.col("last")).select("anchor", "first"),
        "shared-anchors",
    )
    followed = anchors.join(shared, "anchor").groupBy("doc_id", "text_hash").agg(
        # Sets, here and for the removals: rows that repeat add nothing to what one row says.
        F.collect_set(F.struct("anchor", "first")).alias("pairs")
    )
    named = followed.select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"),
        F.col("pairs.anchor").alias("anchors"), F.col("pairs.first").alias("firsts"),
    )
    # The only time that all texts move; the rest works on followed texts.
    traced = materialize(
        texts.join(named, (F.col("doc_id") == F.col("_d")) & (F.col("text_hash") == F.col("_h")))
        .drop("_d", "_h"),
        "followed-texts",
    )
    segments = materialize(
        traced.mapInArrow(_segments, _SEGMENT), "segments"
    )
    blocks = materialize(
        segments.where("leads").groupBy("anchor").agg(F.collect_set("windows").alias("blocks")),
        "reference-blocks",
    )
    parsed = materialize(
        segments.where("not leads").drop("leads").join(blocks, "anchor")
        .mapInArrow(_factor, _FACTOR),
        "factors",
    )
    left_over = parsed.where("length = 0")
    repeated = materialize(
        left_over.groupBy("anchor", "window").agg(
            F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
        ).where(F.col("first") < F.col("last")).select("anchor", "window", "first"),
        "left-over-windows",
    )
    late = left_over.join(repeated, ["anchor", "window"]).where(F.col("doc_id") > F.col("first"))
    spans = parsed.where("length > 0").select("doc_id", "text_hash", "at", "length").unionByName(
        late.select("doc_id", "text_hash", "at", F.lit(1).alias("length"))
    )
    return spans, traced


def deduplicated(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words of every document."""
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    scanned = materialize(texts.mapInArrow(_scan, _SCANNED), "scanned")
    spans, traced = duplicate_spans(texts, scanned)
    removals = materialize(
        spans.groupBy("doc_id", "text_hash").agg(
            F.collect_set(F.struct("at", "length")).alias("spans")
        ), "removals",
    )
    keys = ["doc_id", "text_hash"]
    rewritten = traced.select("doc_id", "text_hash", "text").join(
        removals.select(*keys, F.col("spans.at").alias("starts"), F.col("spans.length").alias("lengths")),
        keys,
    ).mapInArrow(_rewrite, _RESULT)
    whole = scanned.join(removals, keys, "left_anti").select(
        "doc_id", "n_words", F.lit(0).cast("bigint").alias("n_removed"), "kept_sha256"
    )
    return whole.unionByName(rewritten)

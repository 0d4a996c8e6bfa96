"""Phrase collocations, counted on word-level FM-indexes.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends and into words at
blanks and tabs. Each task turns its documents into shards of one language and about
``SHARD_WORDS`` words: a piece lies whole in one shard, so phrases are never cut. A shard is
stored as the Burrows-Wheeler transform of its word ids, with its words and their intervals.

From the transform alone an index extends phrases on both sides: to the right by narrowing an
interval to the rows that agree in one more word, to the left by stepping to the row whose tail
a row is. ``longer`` does both for all phrases of a shard at once: it extends every frequent
phrase to the right and keeps what is also a left extension of a frequent phrase, for a phrase
is never more frequent than its parts. So every level takes one pass over the shards: their
counts are summed, and each shard gets back which of its phrases are frequent.

Sums are dealt out by a hash of the phrase into as many buckets as the corpus needs, packed as
arrays; a bucket holds at most one entry per shard and phrase. Scores are exact decimals.

Defined results: a null text has no words, a null language is ``und``. Occurrences that overlap
all count. Repeated rows count as often as they occur. Ties are ordered by phrase. An empty
table, or one without a frequent phrase, gives no rows. Only ``text`` and ``lang`` are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.llm.common import whole_text
from forumtide.session import materialize

MAX_WORDS = 3
LEAST = 10
TOP = 2000
COVERED_PERCENT = 50
NO_LANG = "und"
SHARD_WORDS = 1_000_000
HELD_WORDS = 2_000_000
BUCKET_WORDS = 500_000
RANK_PARTS = 16
CHUNK = 1 << 21

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_ENDS = b".,;:!?\x0b\x0c\r"
_FOLD = bytes.maketrans(
    _UPPER + _ENDS + b"\t", _UPPER.lower() + b"\n" * len(_ENDS) + b" "
)
END = 0  # the id of the end of a piece

_INDEX_DDL = (
    "shard long, lang string, n_words long, words array<string>, starts array<int>, "
    "counts array<int>, bwt binary"
)
_FOUND_DDL = (
    "bucket long, shard long, heads binary, tails binary, starts binary, counts binary"
)
_SUMS_DDL = (
    "shard long, items array<struct<start: int, size: int, id: long>>, "
    "totals array<struct<id: long, head: long, tail: long, total: long>>"
)


# ---- one shard ----

def chunks_of_tokens(text: bytes) -> Iterator[list[bytes]]:
    """Lower-case words and piece ends (a line feed), a few megabytes of text at a time."""
    text = text.translate(_FOLD)
    start = 0
    while start < len(text):
        cut = text.rfind(b"\n", start, start + CHUNK) + 1
        if not cut:
            # One piece longer than a chunk, or the last one.
            cut = (text.find(b"\n", start + CHUNK) + 1) or len(text)
        part = text[start:cut].replace(b"\n", b" \n ")
        yield [token for token in part.split(b" ") if token]
        start = cut


def suffix_order(ids: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, each suffix read up to the end of its piece.

    Ranks by one word are doubled to two, four, ... words; only places that still tie are sorted
    again. Ends are distinct, in order of place, so no comparison leaves a piece.
    """
    n = len(ids)
    counts = np.bincount(ids)
    first = np.concatenate(([0], np.cumsum(counts)[:-1]))
    rank = first[ids]
    ends = np.flatnonzero(ids == END)
    rank[ends] = np.arange(len(ends))
    open_ = np.flatnonzero((counts[ids] > 1) & (ids != END))
    step = 1
    while open_.size:
        key = rank[open_] * n + rank[open_ + step]
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        group = key // n
        place = np.arange(len(key))
        new_group = np.concatenate(([True], group[1:] != group[:-1]))
        new_key = np.concatenate(([True], key[1:] != key[:-1]))
        group_start = np.maximum.accumulate(np.where(new_group, place, 0))
        key_start = np.maximum.accumulate(np.where(new_key, place, 0))
        rank[open_] = group + (key_start - group_start)
        alone = new_key & np.concatenate((new_key[1:], [True]))
        open_ = open_[~alone]
        step *= 2
    order = np.empty(n, dtype=np.int64)
    order[rank] = np.arange(n)
    return order


def transform(ids: np.ndarray) -> np.ndarray:
    """The word before each suffix, suffixes in order. ``ids`` ends with an end of a piece."""
    return ids[suffix_order(ids) - 1]


class PhraseIndex:
    """An FM-index: rows are suffixes in order, and phrases are intervals of rows.

    The transform keeps, for each word, its occurrences in row order. Row r of the suffixes that
    begin with a word is therefore the r-th place where the transform has it, which leads from a
    suffix to its tail (``tail``), and back to what stands before it. Rows that begin with an
    end have no use of it.
    """

    def __init__(self, bwt: np.ndarray) -> None:
        counts = np.bincount(bwt)
        self.bwt = bwt
        self.first = np.repeat(np.arange(len(counts)), counts)  # the word a row begins with
        self.tail = np.argsort(bwt, kind="stable")
        self.starts = np.concatenate(([0], np.cumsum(counts)))

    def interval(self, word: int) -> tuple[int, int]:
        return int(self.starts[word]), int(self.starts[word + 1] - self.starts[word])

    def extend_left(self, start: int, size: int, word: int) -> tuple[int, int]:
        """Interval of ``word`` followed by the phrase of this interval."""
        held = self.tail[self.starts[word]:self.starts[word + 1]]
        low, high = np.searchsorted(held, [start, start + size])
        return int(self.starts[word] + low), int(high - low)

    def extend_right(self, start: int, size: int, length: int, word: int) -> tuple[int, int]:
        """Interval of the phrase of this interval (of ``length`` words) followed by ``word``."""
        after = self._word_after(np.arange(start, start + size), length)
        hits = np.flatnonzero(after == word)
        return (start + int(hits[0]), len(hits)) if len(hits) else (start, 0)

    def _word_after(self, rows: np.ndarray, length: int) -> np.ndarray:
        for _ in range(length):
            rows = self.tail[rows]
        return self.first[rows]

    def owners(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """For each row the phrase whose interval holds it, or -1."""
        owner = np.full(len(self.bwt), -1, dtype=np.int64)
        offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        owner[np.repeat(starts, sizes) + offset] = np.repeat(np.arange(len(starts)), sizes)
        return owner

    def longer(
        self, starts: np.ndarray, sizes: np.ndarray, length: int
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All phrases one word longer whose first and last ``length`` words are both given.

        Returns start and size of their intervals, and which given phrase is head and tail.
        """
        owner = self.owners(starts, sizes)
        rows = np.flatnonzero(owner >= 0)
        # The rows of a phrase extended to the left by their first word are those whose tails
        # it owns; such a row belongs to an extension to the right if it is owned itself.
        tails = owner[self.tail[rows]]
        rows, tails = rows[tails >= 0], tails[tails >= 0]
        heads = owner[rows]
        new = np.ones(len(rows), dtype=bool)
        new[1:] = (heads[1:] != heads[:-1]) | (tails[1:] != tails[:-1])
        at = np.flatnonzero(new)
        return rows[at], np.diff(np.append(at, len(rows))), heads[at], tails[at]


# ---- packing ----

def pack(values: np.ndarray, kind: str) -> bytes:
    """Bytes of equal weight side by side: the high ones are alike and compress to little."""
    wide = np.ascontiguousarray(values, dtype=kind)
    return wide.view(np.uint8).reshape(-1, wide.itemsize).T.tobytes()


def unpack(raw: bytes, kind: str) -> np.ndarray:
    item = np.dtype(kind).itemsize
    planes = np.frombuffer(raw, dtype=np.uint8).reshape(item, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


# ---- the corpus ----

class _Shard:
    def __init__(self) -> None:
        self.ids: list[np.ndarray] = []
        self.n = 0
        self.words: dict[bytes, int] = defaultdict()
        self.words.default_factory = self.words.__len__
        self.words[b"\n"] = END

    def add(self, tokens: list[bytes]) -> None:
        ids = np.fromiter(map(self.words.__getitem__, tokens), np.int32, len(tokens))
        self.ids.append(ids)
        self.n += len(ids)

    def row(self, shard: int, lang: str) -> tuple | None:
        ids = np.concatenate([*self.ids, np.zeros(1, np.int32)])
        kept = ids != END
        kept[1:] |= ids[:-1] != END  # one end between pieces is enough
        ids = ids[kept]
        if not len(ids):
            return None
        counts = np.bincount(ids, minlength=len(self.words))
        starts = np.cumsum(counts) - counts
        names = list(self.words)
        return (
            shard, lang, int(len(ids) - counts[END]), [name.decode() for name in names[1:]],
            starts[1:], counts[1:], pack(transform(ids), "<i4"),
        )


def _index(
    batches: Iterator[pa.RecordBatch], shard_words: int, held_words: int
) -> Iterator[pa.RecordBatch]:
    types = [
        pa.int64(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32()),
        pa.list_(pa.int32()), pa.binary(),
    ]
    names = [column.split()[0] for column in _INDEX_DDL.split(", ")]
    task, made, held = TaskContext.get().partitionId(), 0, 0
    shards: dict[str, _Shard] = {}

    def flushed(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal made, held
        shard = shards.pop(lang)
        held -= shard.n
        made += 1
        row = shard.row((task << 32) + made, lang)
        if row is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(row, types)], names=names
            )

    for batch in batches:
        for lang, text in zip(*batch.columns):
            lang = lang.as_py()
            for tokens in chunks_of_tokens(text.as_py()):
                if lang not in shards:
                    shards[lang] = _Shard()
                shard = shards[lang]
                shard.add(tokens)
                held += len(tokens)
                if shard.n >= shard_words:
                    yield from flushed(lang)
                elif held >= held_words:
                    yield from flushed(max(shards, key=lambda name: shards[name].n))
            if lang in shards:
                shards[lang].add([b"\n"])
                held += 1
    for lang in sorted(shards):
        yield from flushed(lang)


def indexed(
    docs: DataFrame, shard_words: int = SHARD_WORDS, held_words: int = HELD_WORDS
) -> DataFrame:
    """The stored shards of a corpus. This runs a job."""
    rows = docs.select(
        F.coalesce(F.col("lang"), F.lit(NO_LANG)).alias("lang"),
        whole_text().cast("binary").alias("text"),
    )
    made = partial(_index, shard_words=shard_words, held_words=held_words)
    return materialize(rows.mapInArrow(made, _INDEX_DDL), "phrase-shards")


def frequent_words(index: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """Words of at least ``least`` occurrences in their language, and where shards have them."""
    entries = index.select(
        "shard", "lang", F.inline(F.arrays_zip("words", "starts", "counts"))
    ).toDF("shard", "lang", "word", "start", "size")
    totals = entries.groupBy("lang", "word").agg(F.sum("size").alias("total"))
    words = materialize(
        totals.where(F.col("total") >= least).withColumn("id", F.monotonically_increasing_id()),
        "phrase-words",
    )
    items = entries.join(words.drop("total"), ["lang", "word"]).groupBy("shard").agg(
        F.collect_list(F.struct("start", "size", "id")).alias("items")
    )
    return words, materialize(items, "phrase-items")


def _numbers(items: pa.Array, field: str) -> np.ndarray:
    return items.field(field).to_numpy(zero_copy_only=False).astype(np.int64)


def _extend(
    batches: Iterator[pa.RecordBatch], length: int, buckets: int
) -> Iterator[pa.RecordBatch]:
    names = [column.split()[0] for column in _FOUND_DDL.split(", ")]
    for batch in batches:
        for shard, bwt, items in zip(*batch.columns):
            index = PhraseIndex(unpack(bwt.as_py(), "<i4"))
            starts, sizes, ids = (_numbers(items.values, f) for f in ("start", "size", "id"))
            starts, sizes, heads, tails = index.longer(starts, sizes, length)
            heads, tails = ids[heads], ids[tails]
            mixed = heads.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29)) ^ tails.astype(np.uint64)) * np.uint64(
                0xC2B2AE3D27D4EB4F
            )
            bucket = ((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.diff(bucket[order])) + 1
            rows = [
                (int(bucket[part[0]]), shard.as_py(), pack(heads[part], "<i8"),
                 pack(tails[part], "<i8"), pack(starts[part], "<i4"), pack(sizes[part], "<i4"))
                for part in np.split(order, cuts) if len(part)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column) for column in zip(*rows)], names=names
                )


def _sum(table: pa.Table, least: int, buckets: int, last: bool) -> pa.Table:
    """Sums of one bucket over its shards: the frequent phrases, and each shard's share."""
    parts = {
        name: [unpack(raw, kind) for raw in table[name].to_pylist()]
        for name, kind in (("heads", "<i8"), ("tails", "<i8"), ("starts", "<i4"), ("counts", "<i4"))
    }
    heads, tails, counts = (np.concatenate(parts[n]) for n in ("heads", "tails", "counts"))
    order = np.lexsort((tails, heads))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (np.diff(heads[order]) != 0) | (np.diff(tails[order]) != 0)
    at = np.flatnonzero(new)
    sums = np.add.reduceat(counts[order].astype(np.int64), at)
    good = sums >= least
    bucket = table["bucket"][0].as_py()
    known = np.full(len(at), -1, dtype=np.int64)
    known[good] = np.arange(good.sum()) * buckets + bucket
    ids = np.empty(len(order), dtype=np.int64)
    ids[order] = known[np.cumsum(new) - 1]
    lone = order[at[good]]
    # The first row has the sums; then one row for each shard that holds a frequent phrase.
    here = np.zeros(0, dtype=np.int64) if last else np.flatnonzero(ids >= 0)
    edges = np.searchsorted(here, np.cumsum([0, *map(len, parts["heads"])]))
    holds = np.flatnonzero(np.diff(edges))
    shards = table["shard"].to_numpy()[holds]
    items = _lists(
        [0, *edges[holds], len(here)], start=np.concatenate(parts["starts"])[here],
        size=counts[here], id=ids[here],
    )
    totals = _lists(
        [0, *[len(lone)] * (len(holds) + 1)], id=known[good], head=heads[lone],
        tail=tails[lone], total=sums[good],
    )
    return pa.table({
        "shard": pa.array([None, *shards.tolist()], pa.int64()), "items": items, "totals": totals
    })


def _lists(edges: list[int], **fields: np.ndarray) -> pa.ListArray:
    values = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], names=list(fields))
    return pa.ListArray.from_arrays(pa.array(edges, pa.int32()), values)


def longer_phrases(
    index: DataFrame, items: DataFrame, length: int, least: int, buckets: int, last: bool
) -> tuple[DataFrame, DataFrame]:
    """Frequent phrases of ``length`` + 1 words, and where shards have them. This runs a job."""
    found = index.select("shard", "bwt").join(items, "shard").mapInArrow(
        partial(_extend, length=length, buckets=buckets), _FOUND_DDL
    )
    summed = materialize(
        found.groupBy("bucket").applyInArrow(
            lambda bucket: _sum(bucket, least, buckets, last), _SUMS_DDL
        ),
        "phrase-sums",
    )
    totals = summed.where("shard IS NULL").select(F.inline("totals"))
    shares = summed.where("shard IS NOT NULL").groupBy("shard").agg(
        F.flatten(F.collect_list("items")).alias("items")
    )
    return totals, shares


def _exact_score(total: Column, left: Column, right: Column) -> Column:
    wide = "decimal(38,0)"
    square = F.lit(1_000_000).cast(wide) * total.cast(wide) * total.cast(wide)
    return F.call_function("div", square, left.cast(wide) * right.cast(wide))


def _lowest_cut(length: int) -> Column:
    """The cut of the lowest score, then of the fewest first words: (score, k, l, r)."""
    cuts = [
        F.struct(
            _exact_score(F.col("total"), F.col("heads")[k - 1], F.col("tails")[length - k - 1])
            .alias("score"),
            F.lit(k).alias("k"), F.col("heads")[k - 1].alias("l"),
            F.col("tails")[length - k - 1].alias("r"),
        )
        for k in range(1, length)
    ]
    return F.least(*cuts) if len(cuts) > 1 else cuts[0]


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, least: int = LEAST, top: int = TOP,
    shard_words: int = SHARD_WORDS, bucket_words: int = BUCKET_WORDS,
) -> DataFrame:
    """The best phrases of 2 to ``max_words`` words of each language. This runs jobs.

    A candidate occurs ``least`` times. Of the ways to cut it in two, the lowest score counts:
    a million times the square of its count over the counts of the parts, rounded down.
    Candidates inside a longer one that has half their count are dropped.
    """
    if max_words < 2:
        raise ValueError("phrases have two words at least")
    index = indexed(docs, shard_words, 2 * shard_words)
    n_words = materialize(
        index.groupBy("lang").agg(F.sum("n_words").alias("n")), "phrase-languages"
    )
    total = index.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, -(-total // bucket_words))
    words, items = frequent_words(index, least)
    # heads and tails: counts of the phrase's beginnings and ends, shortest first.
    none = F.array().cast("array<bigint>")
    level = words.select(
        "id", "lang", F.array("word").alias("words"), "total", none.alias("heads"),
        none.alias("tails"),
    )
    ranked = []
    for length in range(1, max_words):
        totals, items = longer_phrases(
            index, items, length, least, buckets, last=length + 1 == max_words
        )
        head = level.select(
            F.col("id").alias("head"), "lang", F.col("words").alias("_ft_words"),
            F.array_append("heads", F.col("total")).alias("heads"),
        )
        tail = level.select(
            F.col("id").alias("tail"), F.element_at("words", -1).alias("_ft_last"),
            F.array_append("tails", F.col("total")).alias("tails"),
        )
        if length > 1:
            # A phrase of this level lies inside one a word longer: those of half its count.
            inside = totals.select(F.col("head").alias("id"), "total").unionByName(
                totals.select(F.col("tail").alias("id"), "total")
            ).groupBy("id").agg(F.max("total").alias("_ft_longer"))
            ranked.append(_scored(level.join(inside, "id", "left"), length))
        level = materialize(
            totals.join(head, "head").join(tail, "tail").select(
                "id", "lang", F.array_append("_ft_words", F.col("_ft_last")).alias("words"),
                "total", "heads", "tails",
            ),
            "phrases",
        )
    ranked.append(_scored(level.withColumn("_ft_longer", F.lit(None).cast("long")), max_words))
    candidates = ranked[0]
    for more in ranked[1:]:
        candidates = candidates.unionByName(more)
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # The best of each part first: one task then sees ``top`` rows of every part of a language,
    # however many tasks found candidates.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    best_of_part = Window.partitionBy("lang", "_ft_part").orderBy(*order)
    best = Window.partitionBy("lang").orderBy(*order)
    return (
        candidates.withColumn("_ft_part", part)
        .withColumn("_ft_place", F.row_number().over(best_of_part))
        .where(F.col("_ft_place") <= top)
        .withColumn("rank", F.row_number().over(best).cast("long"))
        .where(F.col("rank") <= top)
        .join(n_words, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def _scored(level: DataFrame, length: int) -> DataFrame:
    kept = level.where(
        F.coalesce(100 * F.col("_ft_longer") < COVERED_PERCENT * F.col("total"), F.lit(True))
    )
    return kept.withColumn("_ft_cut", _lowest_cut(length)).select(
        "lang", F.array_join("words", " ").alias("phrase"), F.col("total").alias("a"),
        "_ft_cut.l", "_ft_cut.r", "_ft_cut.score",
    )

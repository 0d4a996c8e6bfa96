"""Reversible line deduplication: exact reference counts and sharded cuckoo filters.

A line's key is the line stripped of blanks and lower-cased (A-Z). The store keeps which
document holds which key (``refs``), documents per key with the largest doc_id (``counts``),
and per shard a cuckoo filter of the shared keys, those found in ``min_docs`` documents or
more. Inserting or deleting documents changes the references, and keys that cross the
threshold enter or leave their filter, so a deletion undoes an insertion. Lines of a batch
are looked up in the filters first; only keys that a filter may hold meet the exact counts.

Every change writes a new generation of the store and leaves the old one readable, so a
failed change has no effect. Keys are 128-bit digests.

Defined results: a null or empty text is one empty line. Rows sharing a doc_id are one
document for the counts and each is rewritten by its own text. Rows with a null doc_id are
no document: their lines neither count nor go. Keys shorter than ``min_chars`` are never
touched. Empty tables give an empty store and no rows. Only doc_id and text are read;
``rewrite`` passes the other input columns through unchanged and replaces text.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.llm.common import BLANKS, bucket_bits, let, whole_text
from forumtide.session import materialize, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SHARD_KEYS = 4096
SLOTS = 4
MAX_KICKS = 200


def text_lines(text: Column) -> Column:
    return F.split(text, "\n")


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, UPPER.lower())


def keyed_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text hash, line number and key digest of every line long enough to count."""
    key = line_key(F.col("_ft_line"))
    return (
        docs.where(F.col("doc_id").isNotNull())
        .select("doc_id", whole_text().alias("_ft_text"))
        .select(
            "doc_id", F.xxhash64("_ft_text").alias("_ft_hash"),
            F.posexplode(text_lines(F.col("_ft_text"))).alias("_ft_pos", "_ft_line"),
        )
        .select("doc_id", "_ft_hash", "_ft_pos", key.alias("_ft_key"))
        .where(F.char_length("_ft_key") >= min_chars)
        .withColumn("_ft_key", F.unhex(F.md5(F.col("_ft_key").cast("binary"))))
        .withColumnRenamed("_ft_key", "key")
    )


class CuckooFilter:
    """Set of 16-bit fingerprints, two candidate buckets of four slots for each key.

    ``add`` returns False when no place was found; the owner then rebuilds a larger filter
    from the exact keys. ``discard`` must only be called for keys that were added.
    """

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * 0.84 < keys:
            buckets *= 2
        return cls(np.zeros((buckets, SLOTS), dtype=np.uint16))

    @classmethod
    def build(cls, keys: list[bytes]) -> CuckooFilter:
        size = max(len(keys), 1)
        while True:
            made = cls.sized(size)
            if all(made.add(key) for key in keys):
                return made
            size *= 2

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, dtype="<u2").reshape(-1, SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.astype("<u2").tobytes()

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (((mark * 0x9E3779B1) >> 7) & self.mask)

    def _places(self, key: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(key[8:10], "little") or 1
        bucket = int.from_bytes(key[:8], "little") & self.mask
        return mark, bucket, self._other(bucket, mark)

    def __contains__(self, key: bytes) -> bool:
        mark, one, two = self._places(key)
        return bool((self.table[one] == mark).any() or (self.table[two] == mark).any())

    def add(self, key: bytes) -> bool:
        mark, one, two = self._places(key)
        for bucket in (one, two):
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        bucket = two
        for kick in range(MAX_KICKS):
            slot = kick % SLOTS
            mark, self.table[bucket, slot] = int(self.table[bucket, slot]), mark
            bucket = self._other(bucket, mark)
            free = np.flatnonzero(self.table[bucket] == 0)
            if len(free):
                self.table[bucket, free[0]] = mark
                return True
        return False

    def discard(self, key: bytes) -> None:
        mark, one, two = self._places(key)
        for bucket in (one, two):
            found = np.flatnonzero(self.table[bucket] == mark)
            if len(found):
                self.table[bucket, found[0]] = 0
                return

    def may_hold(self, keys: list[bytes]) -> np.ndarray:
        """Membership of many keys at once."""
        raw = np.frombuffer(b"".join(key[:10] for key in keys), dtype=np.uint8).reshape(-1, 10)
        mark = raw[:, 8:].copy().view("<u2")[:, 0].astype(np.int64)
        mark[mark == 0] = 1
        one = (raw[:, :8].copy().view("<u8")[:, 0] & np.uint64(self.mask)).astype(np.int64)
        two = one ^ (((mark * 0x9E3779B1) >> 7) & self.mask)
        want = mark[:, None]
        return ((self.table[one] == want) | (self.table[two] == want)).any(axis=1)


def _changed_filter(keys: tuple, change: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    """One shard: apply entering and leaving keys to the stored filter, or build it anew."""
    entering = change.loc[change["enters"], "key"].tolist()
    leaving = change.loc[~change["enters"], "key"].tolist()
    if len(stored):
        made = CuckooFilter.load(stored["filter"].iloc[0])
        for key in leaving:
            made.discard(key)
        if not all(made.add(key) for key in entering):
            return pd.DataFrame({"shard": [keys[0]], "filter": [None]})
    else:
        made = CuckooFilter.build(entering)
    return pd.DataFrame({"shard": [keys[0]], "filter": [made.dump()]})


def _probe(keys: tuple, asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
    if not len(stored) or not len(asked):
        return asked.iloc[:0][["key"]]
    held = CuckooFilter.load(stored["filter"].iloc[0]).may_hold(asked["key"].tolist())
    return asked.loc[held, ["key"]]


@dataclass(frozen=True)
class LineStore:
    """One generation of the store; without a folder nothing was inserted yet."""

    root: str
    min_docs: int = 3
    min_chars: int = 20
    folder: str | None = None
    shards: int = 1

    @classmethod
    def create(cls, spark: SparkSession, **options: int) -> LineStore:
        return cls(scratch_path(spark, "lines"), **options)

    def _path(self, part: str) -> str:
        return f"{self.root}/{self.folder}/{part}"

    def _read(self, spark: SparkSession, part: str, schema: str) -> DataFrame:
        if self.folder is None:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self._path(part))

    def refs(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "refs", "key binary, doc_id bigint")

    def counts(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "counts", "key binary, n_docs bigint, last_doc bigint")

    def filters(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, "filters", "shard int, filter binary")

    def insert(self, docs: DataFrame) -> LineStore:
        """Add the documents' lines; documents already referenced change nothing twice."""
        return self.insert_lines(keyed_lines(docs, self.min_chars))

    def insert_lines(self, lines: DataFrame) -> LineStore:
        spark = lines.sparkSession
        batch = lines.select("key", "doc_id").distinct()
        if self.folder is None:
            return self._advance(spark, batch)
        fresh = batch.join(self.refs(spark), ["key", "doc_id"], "left_anti")
        return self._advance(spark, self.refs(spark).unionByName(fresh))

    def delete(self, doc_ids: DataFrame) -> LineStore:
        """Forget documents by doc_id, as if they had never been inserted."""
        spark = doc_ids.sparkSession
        gone = doc_ids.select("doc_id").distinct()
        return self._advance(spark, self.refs(spark).join(gone, "doc_id", "left_anti"))

    def _shard(self, shards: int) -> Column:
        return F.pmod(F.xxhash64("key"), F.lit(shards)).cast("int").alias("shard")

    def _advance(self, spark: SparkSession, refs: DataFrame) -> LineStore:
        after = replace(self, folder=uuid.uuid4().hex)
        refs.select("key", "doc_id").write.parquet(after._path("refs"))
        after.refs(spark).groupBy("key").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("doc_id").alias("last_doc")
        ).write.parquet(after._path("counts"))
        shards = 1 << bucket_bits(after.counts(spark).count(), SHARD_KEYS, 30)
        after = replace(after, shards=shards)
        after._filters_from(spark, self).write.parquet(after._path("filters"))
        return after

    def _shared(self, spark: SparkSession) -> DataFrame:
        return self.counts(spark).where(F.col("n_docs") >= self.min_docs)

    def _filters_from(self, spark: SparkSession, before: LineStore) -> DataFrame:
        """Filters of this generation: changed where the sharding is unchanged, else built."""
        now = self._shared(spark).select("key")
        if before.folder is None or before.shards != self.shards:
            change, stored = now.withColumn("enters", F.lit(True)), spark.createDataFrame(
                [], "shard int, filter binary"
            )
            return self._grouped(change, stored, _changed_filter, "shard int, filter binary")
        was = before._shared(spark).select("key")
        change = now.join(was, "key", "left_anti").withColumn("enters", F.lit(True)).unionByName(
            was.join(now, "key", "left_anti").withColumn("enters", F.lit(False))
        )
        stored = before.filters(spark)
        touched = self._grouped(change, stored, _changed_filter, "shard int, filter binary")
        path = scratch_path(spark, "filters")
        touched.write.parquet(path)
        touched = spark.read.schema("shard int, filter binary").parquet(path)
        # A shard that ran full is built anew, larger, from its exact keys.
        full = touched.where(F.col("filter").isNull()).select("shard")
        again = now.withColumn("enters", F.lit(True)).withColumn("shard", self._shard(self.shards))
        rebuilt = self._grouped(
            again.join(full, "shard", "left_semi").drop("shard"), stored.limit(0),
            _changed_filter, "shard int, filter binary",
        )
        return touched.where(F.col("filter").isNotNull()).unionByName(rebuilt).unionByName(
            stored.join(touched.select("shard"), "shard", "left_anti")
        )

    def _grouped(self, keys: DataFrame, stored: DataFrame, call, schema: str) -> DataFrame:
        """Shards are even and bounded: keys are distinct and their number sets the shards."""
        return (
            keys.withColumn("shard", self._shard(self.shards)).groupBy("shard")
            .cogroup(stored.groupBy("shard")).applyInPandas(call, schema)
        )

    def shared_keys(self, keys: DataFrame) -> DataFrame:
        """Distinct keys asked for that are shared, with their last_doc."""
        spark = keys.sparkSession
        asked = keys.select("key").distinct()
        candidates = self._grouped(asked, self.filters(spark), _probe, "key binary")
        return self._shared(spark).join(candidates, "key", "left_semi").select("key", "last_doc")

    def dropped_lines(self, lines: DataFrame) -> DataFrame:
        """doc_id, text hash and the sorted numbers of the keyed lines that go."""
        spark = lines.sparkSession
        path = scratch_path(spark, "shared")
        self.shared_keys(lines).write.parquet(path)
        shared = spark.read.schema("key binary, last_doc bigint").parquet(path)
        return (
            lines.join(shared, "key").where(F.col("doc_id") != F.col("last_doc"))
            .groupBy("doc_id", "_ft_hash")
            .agg(F.array_sort(F.collect_set("_ft_pos")).alias("_ft_drops"))
        )

    def rewrite(self, docs: DataFrame, lines: DataFrame | None = None) -> DataFrame:
        """The documents with shared lines left only in the largest doc_id that holds them.

        Adds n_lines (before) and n_dropped; columns of these names in the input are replaced.
        ``lines`` are the documents' keyed lines, where the caller has stored them.
        """
        if lines is None:
            lines = materialize(keyed_lines(docs, self.min_chars), "keyed-lines")
        marked = docs.drop("n_lines", "n_dropped").withColumn(
            "_ft_hash", F.xxhash64(whole_text())
        )
        # A doc_id with its text hash names a row's lines: equal rows lose the same lines.
        joined = marked.join(self.dropped_lines(lines), ["doc_id", "_ft_hash"], "left")
        gone = F.coalesce(F.col("_ft_drops"), F.array().cast("array<int>"))
        text = text_lines(whole_text())

        def kept(every: Column) -> Column:
            left = F.array_except(F.sequence(F.lit(0), F.size(every) - 1), gone)
            return F.array_join(F.transform(left, lambda i: F.get(every, i)), "\n")

        out = joined.select(
            *[F.col(f"`{c}`") for c in docs.columns if c not in ("text", "n_lines", "n_dropped")],
            F.when(F.size(gone) == 0, whole_text()).otherwise(let(text, kept)).alias("text"),
            F.size(text).cast("bigint").alias("n_lines"),
            F.size(gone).cast("bigint").alias("n_dropped"),
        )
        order = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
        return out.select(*[f"`{c}`" for c in order], "n_lines", "n_dropped")


def deduplicated_lines(docs: DataFrame, min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """One-batch use: insert all documents into a new store, then rewrite them by it."""
    store = LineStore.create(docs.sparkSession, min_docs=min_docs, min_chars=min_chars)
    lines = materialize(keyed_lines(docs, min_chars), "keyed-lines")
    return store.insert_lines(lines).rewrite(docs, lines)

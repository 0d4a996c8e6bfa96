"""Slot-aligned ingestion on Structured Streaming.

Batches are reduced on their own and merged on read, so no state grows and no row is too
late. Every sink step is replay-safe: a restarted query or a re-delivered batch leaves the
same tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from forumtide.functions.time import slot_window
from forumtide.operators.merge import (
    COUNTERS,
    POST_KEY,
    merge_snapshots,
    merge_snapshots_strict,
    upsert_posts,
)
from forumtide.operators.screening import THRESHOLD, scan
from forumtide.registry import PROMPT_RULES, ScanRule
from forumtide.schemas import POST, SNAPSHOT
from forumtide.session import discard, materialize

POST_COLUMNS = [part.split()[0] for part in POST.split(", ")]
SNAPSHOT_COLUMNS = [part.split()[0] for part in SNAPSHOT.split(", ")]


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 64) -> DataFrame:
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def slot_snapshots(
    rows: DataFrame, time_column: str, keys: Sequence[str] = POST_KEY,
    interval_hours: int = 6, minute: int = 20,
) -> DataFrame:
    """Tumbling slots with the greatest value of each counter per key."""
    window = slot_window(F.col(time_column), interval_hours, minute)
    return (
        rows.groupBy(window.alias("_w"), *keys)
        .agg(
            F.max("views").alias("views"), F.max("recommendations").alias("recommendations"),
            F.max("comments").alias("comments"),
        )
        .select(F.col("_w.start").alias("slot"), *keys, "views", "recommendations", "comments")
    )


def screened(
    rows: DataFrame, column: str, rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """Rows with their scan and ``quarantined``; nothing unscanned goes further."""
    return scan(rows, column, rules).withColumn(
        "quarantined", F.col("risk_score") >= threshold
    )


class MergeTable:
    """A parquet table kept as one merged base plus small batch folders.

    Every merge here takes a maximum, so rows may be merged in any grouping: a batch only
    writes its own folder, readers merge base and batches, and :meth:`compact` folds the
    batches into a new base from time to time. A batch delivered twice overwrites its own
    folder, and no plan overwrites files it reads.
    """

    def __init__(
        self, spark: SparkSession, root: str, schema: str,
        merge: Callable[[DataFrame], DataFrame], partition: str | None = None,
        compact_every: int = 16,
    ) -> None:
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.merge, self.partition, self.compact_every = merge, partition, compact_every

    def _complete(self, kind: str) -> list[int]:
        """Numbers of the finished folders of one kind; only names are read back."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/n=*/_SUCCESS")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = fs.globStatus(path) or []
        return sorted(int(s.getPath().getParent().getName()[2:]) for s in found)

    def _write(self, rows: DataFrame, kind: str, number: int) -> None:
        # Rebalancing gives each partition value few files and splits a large one.
        if self.partition:
            writer = rows.hint("rebalance", self.partition).write.partitionBy(self.partition)
        else:
            writer = rows.hint("rebalance").write
        writer = writer.mode("overwrite")
        writer.parquet(f"{self.root}/{kind}/n={number}")

    def append(self, rows: DataFrame, number: int) -> None:
        """Store a batch; every ``compact_every`` batches the earlier ones are folded."""
        self._write(rows, "batch", number)
        bases = self._complete("base")
        floor = bases[-1] if bases else -1
        if sum(n > floor for n in self._complete("batch")) > self.compact_every:
            self.compact(number)

    def _folders(self, before: int | None) -> list[str]:
        def kept(kind: str) -> list[int]:
            return [n for n in self._complete(kind) if before is None or n < before]

        bases = kept("base")
        floor = bases[-1] if bases else -1
        folders = [f"{self.root}/base/n={floor}"] if bases else []
        return folders + [f"{self.root}/batch/n={n}" for n in kept("batch") if n > floor]

    def holds(self, before: int | None = None) -> bool:
        """Whether anything is stored, ahead of the batch ``before`` if one is given."""
        return bool(self._folders(before))

    def rows(self, before: int | None = None) -> DataFrame:
        """Stored rows not yet merged with each other: one scan over all folders."""
        folders = self._folders(before)
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        # The base and the batches are one scan each, however many batches there are.
        columns = T.StructType.fromDDL(self.schema).fieldNames()
        scans = [
            self.spark.read.schema(self.schema).option("basePath", f"{self.root}/{kind}")
            .parquet(*found).select(*columns)
            for kind in ("base", "batch")
            if (found := [f for f in folders if f.startswith(f"{self.root}/{kind}/")])
        ]
        return reduce(DataFrame.unionByName, scans)

    def read(self, before: int | None = None) -> DataFrame:
        return self.merge(self.rows(before))

    def compact(self, before: int | None = None) -> None:
        """Fold the finished batches (those ahead of ``before``) into one base.

        Folders that the previous base had already folded go; those of this fold stay until
        the next one, so that a reader that began earlier still finds its files.
        """
        bases = self._complete("base")
        batches = [n for n in self._complete("batch") if before is None or n < before]
        if not batches or (bases and bases[-1] >= batches[-1]):
            return
        self._write(self.read(batches[-1] + 1), "base", batches[-1])
        if bases:
            self._drop("batch", [n for n in batches if n <= bases[-1]])
            self._drop("base", bases[:-1])

    def _drop(self, kind: str, numbers: list[int]) -> None:
        for number in numbers:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}/n={number}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


SNAPSHOT_TABLE = SNAPSHOT + ", slot_month DATE"


def post_table(spark: SparkSession, root: str) -> MergeTable:
    return MergeTable(spark, root, POST, upsert_posts)


def snapshot_table(spark: SparkSession, root: str) -> MergeTable:
    """Snapshots partitioned by the month of their slot."""

    def merged(rows: DataFrame) -> DataFrame:
        return merge_snapshots_strict(rows.drop("slot_month")).withColumn(
            "slot_month", F.trunc("slot", "month")
        )

    return MergeTable(spark, root, SNAPSHOT_TABLE, merged, "slot_month")


def refuse_other_configuration(snapshots: MergeTable, fresh: DataFrame, number: int) -> None:
    """Fail if a slot of the batch is stored under another configuration.

    ``fresh`` agrees with itself. Only the stored months that the batch has slots of are read,
    and only earlier batches; they agree with each other, so that a slot with two configurations
    is one of the batch.
    """
    if not snapshots.holds(number):
        return
    # The months of a batch are a short list, at most twelve a year of history.
    months = [row[0] for row in fresh.select("slot_month").distinct().collect()]
    stored = snapshots.rows(number).where(F.col("slot_month").isin(months))
    if merge_snapshots(fresh.unionByName(stored).drop("slot_month"))[1].take(1):
        raise ValueError("snapshot slot belongs to another configuration")


def upsert_stream(
    observations: DataFrame, posts: MergeTable, snapshots: MergeTable, checkpoint: str
) -> StreamingQuery:
    """Merge each micro-batch of observations into the post and snapshot tables.

    A batch is first collapsed on its keys, once for all steps that follow. Only the snapshot
    partitions of the slots it holds are read, to refuse a slot pinned to another configuration
    before anything of the batch is stored.
    """

    def apply(batch: DataFrame, number: int) -> None:
        batch.persist()
        try:
            fresh = materialize(
                merge_snapshots_strict(batch.select(*SNAPSHOT_COLUMNS)).withColumn(
                    "slot_month", F.trunc("slot", "month")
                ),
                "upsert-collapsed",
            )
            refuse_other_configuration(snapshots, fresh, number)
            seen = batch.withColumn("last_seen_at", F.col("observed_at"))
            posts.append(posts.merge(seen.select(*POST_COLUMNS)), number)
            snapshots.append(fresh, number)
            discard(fresh)
        finally:
            batch.unpersist()

    return drive(observations, apply, checkpoint)


def run_to_folder(
    rows: DataFrame, path: str, checkpoint: str,
    each: Callable[[DataFrame], DataFrame] | None = None, partition: str | None = None,
) -> None:
    """Drive a stream over everything available, one folder per micro-batch.

    ``each`` reduces a micro-batch before it is stored, without state between batches: a row
    may come as late as it likes, and results that span batches are merged on read. A batch
    delivered twice overwrites its own folder.
    """

    def save(batch: DataFrame, number: int) -> None:
        writer = (batch if each is None else each(batch)).write.mode("overwrite")
        if partition is not None:
            writer = writer.partitionBy(partition)
        writer.parquet(f"{path}/n={number}")

    drive(rows, save, checkpoint).awaitTermination()


def drive(rows: DataFrame, call, checkpoint: str) -> StreamingQuery:
    return (
        rows.writeStream.foreachBatch(call)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def store_once(
    rows: DataFrame, path: str, identity: Sequence[str], time_column: str, checkpoint: str
) -> None:
    """Store every observation once, however often and however late it arrives again.

    Batches are stored by day; a batch is compared only with the stored days it has rows of,
    and only with earlier batches, so a batch delivered twice gives the same folder. The
    identity must fix the observation's time.
    """
    spark = rows.sparkSession
    day = F.to_date(time_column)

    def save(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates(list(identity)).withColumn("_day", day)
        if number:
            days = [r[0] for r in batch.select(day).distinct().collect()]
            schema = T.StructType([*fresh.schema.fields, T.StructField("n", T.IntegerType())])
            stored = spark.read.schema(schema).parquet(path).where(
                (F.col("n") < number) & F.col("_day").isin(days)
            )
            fresh = fresh.join(stored.select(*identity), list(identity), "left_anti")
        fresh.write.mode("overwrite").partitionBy("_day").parquet(f"{path}/n={number}")

    drive(rows, save, checkpoint).awaitTermination()


def read_slots(spark: SparkSession, path: str, keys: Sequence[str] = POST_KEY) -> DataFrame:
    """Slot snapshots stored batch by batch, greatest value of each counter."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col("slot").cast("timestamp_ntz").alias("slot"), *keys)
        .agg(*[F.max(name).alias(name) for name in COUNTERS])
    )


def on_new_release(
    spark: SparkSession, root: str, checkpoint: str, handle, ledger: str,
    pattern: str = "SHA256SUMS.txt",
) -> StreamingQuery:
    """Call ``handle(release folder)`` once for every newly completed release.

    The checksum list is written last, so its appearance is the signal. Handled releases are
    noted in ``ledger``; a batch delivered again skips them. A job lost between handling and
    noting handles the release again, so ``handle`` should overwrite its own output. Release
    names are few and short; they are the only thing read back.
    """

    def announce(batch: DataFrame, number: int) -> None:
        folder = F.regexp_extract("path", r"^(.*)/[^/]+\z", 1)
        found = batch.select(folder.alias("release")).distinct()
        path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            done = spark.read.schema("release STRING").parquet(ledger)
            found = found.join(done, "release", "left_anti")
        for row in found.orderBy("release").collect():
            handle(row["release"])
            noted = spark.createDataFrame([row], "release STRING").coalesce(1)
            noted.write.mode("append").parquet(ledger)

    lists = (
        spark.readStream.format("binaryFile")
        .schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )
    return drive(lists, announce, checkpoint)

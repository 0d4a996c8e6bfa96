"""Validated and screened ingestion: one stream, four tables and an audit of every batch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from forumtide.functions.values import Site
from forumtide.operators.merge import COUNTERS, POST_KEY, batch_summary
from forumtide.operators.screening import QUARANTINE_KEY, THRESHOLD, quarantine_rows
from forumtide.operators.validate import failed_rules, split_valid
from forumtide.registry import PROMPT_RULES, ScanRule
from forumtide.schemas import QUARANTINE
from forumtide.session import materialize
from forumtide.streaming.slots import (
    MergeTable,
    drive,
    post_table,
    refuse_other_configuration,
    snapshot_table,
)

_POST_RANK = (
    "published_at", "title", "analysis_unit", "category", "source_url", "is_notice", "is_ad",
)
REJECTED = (
    "board_id INT, post_id BIGINT, title STRING, source_url STRING, observed_at TIMESTAMP_NTZ, "
    "failed ARRAY<STRING>"
)
SUMMARY = (
    "board_id INT, inserted BIGINT, updated BIGINT, quarantined BIGINT, rejected BIGINT"
)


def columns_of(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).fieldNames()


def quarantine_table(spark: SparkSession, root: str) -> MergeTable:
    """Quarantine rows of a stream; the earliest sighting of a text stands."""
    names = [c for c in columns_of(QUARANTINE) if c not in QUARANTINE_KEY]

    def merged(rows: DataFrame) -> DataFrame:
        # Findings follow from the text, so any row of the key has them.
        first = F.min("quarantined_at").alias("quarantined_at")
        others = [F.any_value(c).alias(c) for c in names if c != "quarantined_at"]
        return rows.groupBy(*QUARANTINE_KEY).agg(first, *others).select(*rows.columns)

    return MergeTable(spark, root, QUARANTINE, merged)


@dataclass(frozen=True)
class Ingested:
    """What a stream of observations leaves behind.

    ``posts``, ``snapshots`` and ``quarantine`` are merged on read. ``rejected`` and
    ``summary`` have one folder per batch, each written whole by its batch.
    """

    spark: SparkSession
    root: str
    posts: MergeTable
    snapshots: MergeTable
    quarantine: MergeTable

    @classmethod
    def at(cls, spark: SparkSession, root: str) -> Ingested:
        root = root.rstrip("/")
        return cls(
            spark, root, post_table(spark, f"{root}/posts"),
            snapshot_table(spark, f"{root}/snapshots"),
            quarantine_table(spark, f"{root}/quarantine"),
        )

    def rejected(self) -> DataFrame:
        """Observations that broke a rule, with the ids of all rules they broke."""
        return self._batches("rejected", REJECTED)

    def summary(self) -> DataFrame:
        """Per batch ``n`` and board: posts inserted and updated, titles and rows refused."""
        return self._batches("summary", SUMMARY + ", n INT")

    def _batches(self, kind: str, schema: str) -> DataFrame:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{kind}")
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], schema)
        stored = self.spark.read.schema(schema).parquet(f"{self.root}/{kind}")
        return stored.select(*columns_of(schema))


def ingest_stream(
    observations: DataFrame,
    unit_map: DataFrame,
    site: Site,
    tables: Ingested,
    checkpoint: str,
    rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
) -> StreamingQuery:
    """Validate, screen and merge each micro-batch of observations.

    Observations carry ``slot``, ``observed_at`` and ``config_version``. A row that breaks a rule
    goes to ``rejected``; every title of a valid row is screened, and a flagged one is
    quarantined beside its post. Valid rows are collapsed once per post and slot; posts and
    snapshots both come from that frame. A slot pinned to another configuration refuses the
    batch before anything of it is stored.

    Every table is written under the number of the batch, and what a batch is compared with are
    earlier batches only: a batch that is delivered again, at once or after a restart, leaves
    the tables as they are.
    """

    def apply(batch: DataFrame, number: int) -> None:
        checked = materialize(failed_rules(batch, unit_map, site), "ingest-checked")
        valid, refused = split_valid(checked)
        newest = F.max(F.struct("observed_at", *_POST_RANK)).alias("_post")
        version = [
            F.min("config_version").alias("config_version"),
            F.max("config_version").alias("other_version"),
        ]
        collapsed = materialize(
            valid.groupBy(*POST_KEY, "slot").agg(
                newest, *[F.max(c).cast("bigint").alias(c) for c in COUNTERS], *version
            ).withColumn("slot_month", F.trunc("slot", "month")),
            "ingest-collapsed",
        )
        seen = collapsed.select(
            *POST_KEY, *[f"_post.{c}" for c in _POST_RANK],
            F.col("_post.observed_at").alias("last_seen_at"),
        )
        fresh = collapsed.select(
            *POST_KEY, "slot", F.col("_post.observed_at").alias("observed_at"), *COUNTERS,
            "config_version", "slot_month",
        )
        if collapsed.where("NOT config_version <=> other_version").take(1):
            raise ValueError("snapshot slot belongs to another configuration")
        refuse_other_configuration(tables.snapshots, fresh, number)
        titles = valid.groupBy(
            F.concat(F.lit("post:"), F.concat_ws(":", *POST_KEY)).alias("source_ref"),
            F.col("title").alias("text"),
        ).agg(F.min("observed_at").alias("seen_at"))
        earlier = tables.quarantine.rows(number)
        flagged = materialize(
            quarantine_rows(titles, "title", F.col("seen_at"), rules, threshold), "ingest-flagged"
        )
        new = flagged.join(earlier.select(*QUARANTINE_KEY), list(QUARANTINE_KEY), "left_anti")
        counted = batch_summary(
            checked, tables.posts.rows(number),
            new.select(F.split("source_ref", ":")[1].cast("int").alias("board_id")),
        )
        _store(counted, f"{tables.root}/summary", number)
        _store(refused.select(*columns_of(REJECTED)), f"{tables.root}/rejected", number)
        tables.quarantine.append(flagged, number)
        tables.posts.append(tables.posts.merge(seen), number)
        tables.snapshots.append(fresh, number)

    return drive(observations, apply, checkpoint)


def _store(rows: DataFrame, path: str, number: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/n={number}")

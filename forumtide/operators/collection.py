"""Whole steps of a collection cycle, composed of the single operators."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.functions.values import Site
from forumtide.operators.merge import (
    POST_KEY,
    batch_summary,
    collapse_observations,
    detail_tasks,
    merge_snapshots_strict,
    upsert_posts,
)
from forumtide.operators.ranking import write_ranking
from forumtide.operators.screening import THRESHOLD, quarantine_rows
from forumtide.operators.validate import failed_rules, split_valid
from forumtide.params import RankingSpec, utc
from forumtide.registry import PROMPT_RULES, ScanRule
from forumtide.schemas import POST, RANKING, SNAPSHOT
from forumtide.session import materialize


@dataclass(frozen=True)
class Collected:
    """Tables after a batch, its new quarantine rows, and one summary row per board."""

    posts: DataFrame
    snapshots: DataFrame
    quarantined: DataFrame
    summary: DataFrame


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def collect_batch(
    observations: DataFrame,
    unit_map: DataFrame,
    site: Site,
    posts: DataFrame,
    snapshots: DataFrame,
    quarantine: DataFrame,
    fetched_at: datetime,
    rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
) -> Collected:
    """Validate, collapse, screen titles, and merge one batch of observations.

    ``observations`` carry their ``slot`` and ``config_version``; a batch may span slots. The
    post of a key is the collapsed one; every valid sighting's title is screened. The checked
    rows feed four results and are stored once; this runs a job.
    """
    at = F.lit(utc("fetched_at", fetched_at)).cast("timestamp_ntz")
    checked = materialize(failed_rules(observations, unit_map, site), "checked")
    valid = split_valid(checked)[0]
    seen = collapse_observations(valid).withColumn("last_seen_at", at)
    # Merging snapshots takes the greatest counters, which collapses a slot's sightings too.
    shots = valid.withColumn("observed_at", at)
    titles = valid.select(
        F.concat(F.lit("post:"), F.concat_ws(":", *POST_KEY)).alias("source_ref"),
        F.col("title").alias("text"),
    ).distinct()
    flagged = materialize(
        quarantine_rows(titles, "title", fetched_at, rules, threshold, quarantine), "flagged"
    )
    boards = flagged.select(F.split("source_ref", ":")[1].cast("int").alias("board_id"))
    return Collected(
        upsert_posts(posts, seen.select(*_columns(POST))),
        merge_snapshots_strict(snapshots, shots.select(*_columns(SNAPSHOT))),
        flagged,
        batch_summary(checked, posts, boards),
    )


def refreshed_slot(
    ranking: DataFrame, root: str, spec: RankingSpec, tasks: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Replace one slot of the ranking table; ``(its stored rows, follow-up tasks new to it)``.

    The tasks come from the stored rows, so ranking runs once.
    """
    path = write_ranking(ranking, root, spec)
    stored = ranking.sparkSession.read.schema(RANKING).parquet(path)
    end = F.lit(spec.bounds[1]).cast("timestamp_ntz")
    return stored, detail_tasks(stored, tasks, end)


def next_backfill_state(
    states: DataFrame, spent: DataFrame, status: DataFrame, updated_at: datetime
) -> DataFrame:
    """Backfill state of every source after a budget was spent.

    ``states`` has ``source_key, next_page, complete, checkpoint_post_id``; ``spent`` are the
    pages that were read and stored, ``status`` what was found on them. A source whose pages
    were read goes on after its last one; it is complete once its cut was seen. A source
    that got no page keeps its state.
    """
    read = spent.groupBy("source_key").agg(F.max("page").alias("_page"))
    found = status.select(
        "source_key", F.col("complete").alias("_complete"),
        F.col("checkpoint_post_id").alias("_checkpoint"),
    )
    moved = F.col("_page").isNotNull()
    at = F.lit(utc("updated_at", updated_at)).cast("timestamp_ntz")
    return (
        states.join(read, "source_key", "full").join(found, "source_key", "left")
        .select(
            "source_key",
            F.when(moved, F.col("_page") + 1).otherwise(F.col("next_page")).alias("next_page"),
            F.coalesce(F.when(moved, F.col("_complete")), "complete", F.lit(False))
            .alias("complete"),
            F.coalesce(F.when(moved, F.col("_checkpoint")), "checkpoint_post_id")
            .alias("checkpoint_post_id"),
            F.when(moved, at).alias("updated_at"),
        )
    )

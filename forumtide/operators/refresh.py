"""The labelled artifact carried from run to run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from forumtide.operators.merge import POST_KEY
from forumtide.operators.screening import THRESHOLD
from forumtide.operators.semantic import label_threads, relabel, split_reuse
from forumtide.registry import PROMPT_RULES, Lexicon, ScanRule, SelectionPolicy
from forumtide.session import materialize
from forumtide.sources.artifact import (
    COMMENT_KEY,
    is_current,
    read_artifact,
    read_manifests,
    read_texts,
    write_artifact,
)

COUNTERS = (
    "selected_posts BIGINT, fetched_posts BIGINT, analyzed_posts BIGINT, "
    "analyzed_comments BIGINT, quarantined_items BIGINT, failed_posts BIGINT, "
    "complete BOOLEAN, current BOOLEAN"
)


@dataclass(frozen=True)
class Refresh:
    """Posts and comments as stored, and one row of counters.

    ``current`` says that the artifact in force was kept and nothing was labelled.
    """

    posts: DataFrame
    comments: DataFrame
    counters: DataFrame


def split_with_texts(
    candidates: DataFrame, posts: DataFrame, comments: DataFrame,
    body_texts: DataFrame, comment_texts: DataFrame,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """:func:`split_reuse` that reuses a thread only if all its whole texts are stored."""
    lost = comments.join(comment_texts, list(COMMENT_KEY), "left_anti").select(*POST_KEY)
    whole = posts.join(body_texts, list(POST_KEY), "left_semi").join(
        lost, list(POST_KEY), "left_anti"
    )
    return split_reuse(candidates, whole, comments)


def refreshed_artifact(
    root: str,
    source_sha256: str,
    candidates: DataFrame,
    bodies: DataFrame,
    comments: DataFrame,
    lexicon: Lexicon,
    policy: SelectionPolicy,
    generated_at: datetime,
    rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
) -> Refresh:
    """Bring the labelled artifact of a source up to the present candidates and lexicon.

    A complete artifact of exactly this source, policy and lexicon stays as it is. Otherwise the
    threads still wanted are labelled again from their stored whole texts, the others are
    screened and labelled from ``bodies`` and ``comments``, and both are stored as a new
    artifact; what is no candidate any more is left out. The result equals a run without a
    prior artifact over threads whose texts did not change. An artifact with failed posts is
    incomplete, so the next run tries them again.

    Counts are observed while the results are written; this runs jobs.
    """
    spark = candidates.sparkSession
    selected = materialize(candidates, "candidates")
    state = is_current(read_manifests(spark, root), source_sha256, policy, lexicon.version)
    if state.first()["current"]:
        posts, notes = read_artifact(spark, root, source_sha256)
        row = (selected.count(), 0, posts.count(), notes.count(), 0, 0, True, True)
        return Refresh(posts, notes, spark.createDataFrame([row], COUNTERS))

    prior_posts, prior_notes = read_artifact(spark, root, source_sha256)
    body_texts, note_texts = read_texts(spark, root, source_sha256)
    reused, reused_notes, missing = split_with_texts(
        selected, prior_posts, prior_notes, body_texts, note_texts
    )
    missing = materialize(missing, "missing")
    again, notes_again = relabel(reused, reused_notes, body_texts, note_texts, lexicon)
    fresh = label_threads(missing, bodies, comments, lexicon, rules, threshold)

    posts = again.unionByName(fresh.posts)
    notes = notes_again.unionByName(fresh.comments)
    kept_bodies = body_texts.join(reused.select(*POST_KEY), list(POST_KEY), "left_semi")
    kept_notes = note_texts.join(
        reused_notes.select(*COMMENT_KEY), list(COMMENT_KEY), "left_semi"
    )
    failed = fresh.failures.count()
    seen = {name: Observation(name) for name in ("posts", "comments")}
    one = F.count(F.lit(1)).alias("n")
    write_artifact(
        posts.observe(seen["posts"], one), notes.observe(seen["comments"], one), root,
        source_sha256, policy, lexicon.version, failed == 0, generated_at,
        kept_bodies.unionByName(fresh.body_texts), kept_notes.unionByName(fresh.comment_texts),
    )
    row = (
        selected.count(), missing.count(), seen["posts"].get["n"], seen["comments"].get["n"],
        fresh.screened.count(), failed, failed == 0, False,
    )
    stored_posts, stored_notes = read_artifact(spark, root, source_sha256)
    return Refresh(stored_posts, stored_notes, spark.createDataFrame([row], COUNTERS))

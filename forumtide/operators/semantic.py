"""Labelling of sampled threads: screening, labels, reuse, summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.functions.text import normal_form
from forumtide.operators.lexicon import (
    comment_reaction,
    label_forms,
    label_sentiment,
    label_thread,
)
from forumtide.operators.merge import POST_KEY
from forumtide.operators.metrics import label_totals
from forumtide.operators.screening import THRESHOLD, scan
from forumtide.operators.validate import fill_blank, label_codes
from forumtide.registry import (
    INTENT_LABELS,
    NO_EVIDENCE_LABEL,
    PROMPT_RULES,
    REASON_LABELS,
    SENTIMENT_LABELS,
    Lexicon,
    ScanRule,
)
from forumtide.session import materialize

# Stored excerpt length, joiner, and the size below which shares are indicative.
EXCERPT_CHARS = 500
TERM_JOINER = " · "
LOW_SAMPLE = 5

DIMENSIONS = {
    "topic": "topic", "intent": "intent", "body_sentiment": "body_sentiment",
    "comment_reaction": "comment_reaction",
}


@dataclass(frozen=True)
class SemanticBatch:
    """Labelled rows carry excerpts for display; the whole normalised texts stand beside them."""

    posts: DataFrame
    comments: DataFrame
    screened: DataFrame
    failures: DataFrame
    body_texts: DataFrame
    comment_texts: DataFrame


def split_reuse(
    candidates: DataFrame, prior_posts: DataFrame, prior_comments: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(reused posts, reused comments, missing candidates)`` against a prior artifact."""
    wanted = candidates.select(*POST_KEY)
    posts = prior_posts.join(wanted, list(POST_KEY), "left_semi")
    kept = posts.select(*POST_KEY)
    comments = prior_comments.join(kept, list(POST_KEY), "left_semi")
    missing = candidates.join(prior_posts.select(*POST_KEY), list(POST_KEY), "left_anti")
    return posts, comments, missing


def excerpt(text: Column) -> Column:
    return F.substring(text, 1, EXCERPT_CHARS)


def label_threads(
    candidates: DataFrame,
    bodies: DataFrame,
    comments: DataFrame,
    lexicon: Lexicon,
    rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
) -> SemanticBatch:
    """Screen and label candidate threads.

    ``bodies`` has ``board_id, post_id, body, reported_count, error``; ``comments`` has
    ``board_id, post_id, comment_id, parent_id, published_at, text``. A screened body
    drops its thread and its comments are not looked at; a screened comment drops alone.
    Labels read the whole text; only the stored excerpt is cut. Screened and labelled
    texts are stored once, so that posts, comments and counts share one pass of Python;
    this runs jobs.
    """
    key = list(POST_KEY)
    missing = F.when(F.col("body").isNull(), F.coalesce("error", F.lit("missing")))
    joined = candidates.join(
        bodies.select(*POST_KEY, "body", "reported_count", "error"), key, "left"
    ).withColumn("error", missing.otherwise(F.col("error")))
    failures = joined.where(F.col("error").isNotNull()).select(*POST_KEY, "error")
    scanned = scan(
        joined.where(F.col("error").isNull()), "body", rules, "body_", folds=True,
        beside={"title_folded": normal_form(F.col("title"))},
    )
    checked = materialize(
        label_forms(scanned, "title_folded", "body_folded", lexicon)
        .withColumn("blocked", F.col("body_risk_score") >= threshold)
        .drop("body", "body_findings", "body_folded", "title_folded"),
        "bodies",
    )
    safe_posts = checked.where(~F.col("blocked"))

    parsed = comments.join(safe_posts.select(*POST_KEY), key, "left_semi")
    notes = materialize(
        label_sentiment(
            scan(parsed, "text", rules, "text_", folds=True), "text_folded", lexicon, folded=True
        )
        .withColumn("blocked", F.col("text_risk_score") >= threshold)
        .drop("text", "text_findings", "text_folded"),
        "comments",
    )
    safe_comments = notes.where(~F.col("blocked"))
    screened = (
        checked.where("blocked")
        .select(*POST_KEY, F.lit(None).cast("bigint").alias("comment_id"), F.lit("body").alias("kind"))
        .unionByName(
            notes.where("blocked").select(
                *POST_KEY, F.col("comment_id").cast("bigint"), F.lit("comment").alias("kind")
            )
        )
    )

    seen = notes.groupBy(*POST_KEY).agg(
        F.count(F.lit(1)).alias("_parsed"), F.count_if(~F.col("blocked")).alias("_kept")
    )
    reactions = comment_reaction(safe_comments, POST_KEY)
    zero = F.lit(0).cast("bigint")
    posts = (
        safe_posts.join(seen, key, "left").join(reactions, key, "left")
        .select(
            *POST_KEY, "analysis_unit", "title", "published_at", "source_url", "selection_reason",
            F.col("views").cast("bigint").alias("views"),
            F.col("recommendations").cast("bigint").alias("recommendations"),
            F.col("comments").cast("bigint").alias("comment_count"),
            F.coalesce("_kept", zero).alias("analyzed_comment_count"),
            (F.coalesce("_parsed", zero) == F.col("reported_count")).alias("comments_complete"),
            F.col("sentiment").alias("body_sentiment"),
            F.coalesce("comment_reaction", F.lit("neutral")).alias("comment_reaction"),
            "intent", "topic", "confidence",
            F.array_join("evidence_terms", TERM_JOINER).alias("evidence_terms"),
            excerpt(F.col("body_normalized")).alias("body_excerpt"),
            F.lit(lexicon.version).alias("model_version"),
        )
    )
    kept_comments = safe_comments.select(
        *POST_KEY, "comment_id", "parent_id", "published_at",
        excerpt(F.col("text_normalized")).alias("text"), "sentiment",
        F.lit(lexicon.version).alias("model_version"),
    )
    body_texts = safe_posts.select(
        *POST_KEY, F.coalesce("body_normalized", F.lit("")).alias("whole_text")
    )
    comment_texts = safe_comments.select(
        *POST_KEY, "comment_id", F.coalesce("text_normalized", F.lit("")).alias("whole_text")
    )
    return SemanticBatch(
        posts, kept_comments, screened, failures, body_texts, comment_texts
    )


def relabel(
    posts: DataFrame, comments: DataFrame, body_texts: DataFrame, comment_texts: DataFrame,
    lexicon: Lexicon,
) -> tuple[DataFrame, DataFrame]:
    """Stored rows labelled again under another lexicon, from their whole texts.

    ``body_texts`` and ``comment_texts`` have the key and ``whole_text``, as a labelling run
    gives them or the text store keeps them. The result equals a fresh run. A row without its
    text fails the job: its excerpt is no ground for a label.
    """
    version = F.lit(lexicon.version)
    text = F.when(F.col("whole_text").isNotNull(), F.col("whole_text")).otherwise(
        F.raise_error(F.lit("a stored row has no whole text to label"))
    )
    note_key = [*POST_KEY, "comment_id"]
    fresh = label_sentiment(
        comments.drop("sentiment").join(comment_texts, note_key, "left")
        .withColumn("whole_text", text),
        "whole_text", lexicon,
    )
    new_comments = fresh.withColumn("model_version", version).select(*comments.columns)
    stripped = posts.drop(
        "body_sentiment", "comment_reaction", "intent", "topic", "confidence", "evidence_terms"
    ).join(body_texts, list(POST_KEY), "left").withColumn("whole_text", text)
    labelled = label_thread(stripped, "whole_text", lexicon).withColumnRenamed(
        "sentiment", "body_sentiment"
    )
    new_posts = (
        labelled.join(comment_reaction(fresh, POST_KEY), list(POST_KEY), "left")
        .withColumn("comment_reaction", F.coalesce("comment_reaction", F.lit("neutral")))
        .withColumn("evidence_terms", F.array_join("evidence_terms", TERM_JOINER))
        .withColumn("model_version", version)
        .select(*posts.columns)
    )
    return new_posts, new_comments


def refresh_counters(candidates: DataFrame, missing: DataFrame, batch: SemanticBatch,
                     posts: DataFrame, comments: DataFrame) -> DataFrame:
    """One row of counts for the manifest of a labelling run."""

    def rows(frame: DataFrame) -> Column:
        return frame.agg(F.count(F.lit(1)).alias("n")).scalar()

    failed = rows(batch.failures)
    return candidates.agg(F.count(F.lit(1)).alias("selected_posts")).select(
        "selected_posts", rows(missing).alias("fetched_posts"),
        rows(posts).alias("analyzed_posts"), rows(comments).alias("analyzed_comments"),
        rows(batch.screened).alias("quarantined_items"), failed.alias("failed_posts"),
        (failed == 0).alias("complete"),
    )


def unit_comments(posts: DataFrame, comments: DataFrame, unit: str) -> DataFrame:
    """Comments under the posts of one unit."""
    keys = posts.where(F.col("analysis_unit") == unit).select(*POST_KEY)
    return comments.join(keys, list(POST_KEY), "left_semi")


def unit_distributions(posts: DataFrame) -> DataFrame:
    """Topic, intent, sentiment and reaction shares per unit."""
    return label_totals(posts, DIMENSIONS, "analysis_unit")


def unit_summary(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Per unit: posts, comments, negative-or-mixed shares, and whether the sample is small."""
    def share(column: str) -> Column:
        hit = F.coalesce(F.col(column).isin("negative", "mixed"), F.lit(False))
        return F.count_if(hit) / F.count(F.lit(1))

    per_post = comments.groupBy(*POST_KEY).agg(F.count(F.lit(1)).alias("_n"))
    joined = posts.join(per_post, list(POST_KEY), "left")
    return joined.groupBy("analysis_unit").agg(
        F.count(F.lit(1)).alias("posts"),
        F.coalesce(F.sum("_n"), F.lit(0).cast("bigint")).alias("comments"),
        share("body_sentiment").alias("negative_posts"),
        share("comment_reaction").alias("negative_reactions"),
        F.min("published_at").alias("first_published"),
        F.max("published_at").alias("last_published"),
    ).withColumn("low_sample", F.col("posts") < LOW_SAMPLE)


def evidence_table(posts: DataFrame) -> DataFrame:
    """Labelled posts as shown to a reader."""
    shown = posts.select(
        "title", "selection_reason", "topic", "intent", "body_sentiment", "comment_reaction",
        "evidence_terms", "analyzed_comment_count", "views", "recommendations", "source_url",
    )
    shown = label_codes(shown, "selection_reason", REASON_LABELS)
    shown = label_codes(shown, "intent", INTENT_LABELS)
    shown = label_codes(shown, "body_sentiment", SENTIMENT_LABELS)
    shown = label_codes(shown, "comment_reaction", SENTIMENT_LABELS)
    return fill_blank(shown, "evidence_terms", NO_EVIDENCE_LABEL)

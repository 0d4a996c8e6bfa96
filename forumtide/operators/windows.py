"""Evidence windows, stratified candidates and plain top lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.functions.time import hours_before, period_label
from forumtide.operators.merge import POST_KEY
from forumtide.params import WindowSpec, code
from forumtide.registry import (
    GENERAL_UNITS,
    METRICS,
    SELECTION_ORDER,
    SPARSE_SUFFIX,
    SelectionPolicy,
)
from forumtide.session import materialize

POST_VIEW = ("title", "comments", "recommendations", "views", "published_at", "source_url")
UNANSWERED_LIMIT = 20


def evidence_end(posts: DataFrame) -> Column:
    """Newest observation over all posts (newest publication when never observed).

    A scalar subquery: Spark computes it once and plans the comparison like a literal.
    """
    column = "slot" if "slot" in posts.columns else "published_at"
    return posts.agg(F.max(column).alias("end")).scalar()


def fallback_reason(spec: WindowSpec) -> Column:
    return F.concat(period_label(F.lit(spec.hours)), F.lit(SPARSE_SUFFIX))


def window_choice(posts: DataFrame, spec: WindowSpec, end: Column) -> DataFrame:
    """Per unit: row count in the short window, hours to use, and why if longer."""
    published = F.col("published_at")
    counted = posts.where(F.col("analysis_unit").isNotNull()).groupBy("analysis_unit").agg(
        F.sum((published >= hours_before(end, spec.hours)).cast("bigint")).alias("n_requested")
    )
    if spec.fallback_hours is None:
        return counted.select(
            "analysis_unit", "n_requested", F.lit(spec.hours).alias("effective_hours"),
            F.lit(None).cast("string").alias("fallback_reason"),
        )
    sparse = F.col("n_requested") < spec.minimum
    return counted.select(
        "analysis_unit", "n_requested",
        F.when(sparse, spec.fallback_hours).otherwise(spec.hours).alias("effective_hours"),
        F.when(sparse, fallback_reason(spec)).alias("fallback_reason"),
    )


def select_windows(posts: DataFrame, spec: WindowSpec, unit: str | None = None) -> DataFrame:
    """Rows of every unit's effective window (no upper bound), or of one unit.

    The per-unit choice is stored first (this runs a job), so that joining it back does
    not shuffle the posts by unit.
    """
    end = evidence_end(posts)
    longest = spec.fallback_hours or spec.hours
    scope = posts if unit is None else posts.where(F.col("analysis_unit") == unit)
    # Rows older than the longest window can only matter to the counts, where they add zero.
    choice = materialize(window_choice(scope, spec, end), "windows")
    recent = scope.where(F.col("published_at") >= hours_before(end, longest))
    return (
        recent.join(choice, "analysis_unit")
        .where(F.col("published_at") >= hours_before(end, F.col("effective_hours")))
        .withColumn("window_start", hours_before(end, F.col("effective_hours")))
        .withColumn("window_end", end)
    )


def rank_posts(rows: DataFrame, metric: str, limit: int = 10) -> DataFrame:
    """Top posts by one counter, newest and greatest id first among equals."""
    code("metric", metric)
    if limit <= 0:
        raise ValueError("limit must be positive")
    order = [F.desc(metric), F.desc("published_at"), F.desc("post_id"), F.desc("board_id")]
    return rows.orderBy(*order).limit(limit).select(*POST_VIEW)


def unanswered(rows: DataFrame, limit: int = UNANSWERED_LIMIT) -> DataFrame:
    """Newest posts without a comment."""
    return rank_posts(rows.where(F.col("comments") == 0), "comments", limit)


def unit_limit(policy: SelectionPolicy) -> Column:
    return F.when(
        F.col("analysis_unit").isin(*GENERAL_UNITS), policy.general_per_metric
    ).otherwise(policy.job_per_metric)


def detail_candidates(posts: DataFrame, policy: SelectionPolicy) -> DataFrame:
    """Sample for text labelling: the top posts of every unit by each counter.

    A post on several lists is kept once with the first counter of the fixed order as
    its reason. The window filter uses the largest limit, which Spark applies in every
    map task; the unit's own limit is applied after it.
    """
    newest = posts.agg(F.max("published_at").alias("end")).scalar()
    recent = posts.where(
        F.col("analysis_unit").isNotNull()
        & (F.col("published_at") >= hours_before(newest, policy.window_days * 24))
    ).select(*POST_KEY, "analysis_unit", "published_at", *METRICS)
    ids = (*POST_KEY, "analysis_unit", "published_at")
    long = recent.select(
        *ids, *[F.col(m).cast("bigint").alias(m) for m in METRICS]
    ).unpivot(list(ids), list(SELECTION_ORDER), "metric", "metric_value")
    place = Window.partitionBy("metric", "analysis_unit").orderBy(
        F.desc("metric_value"), F.desc("published_at"), F.desc("post_id"), F.desc("board_id")
    )
    widest = max(policy.job_per_metric, policy.general_per_metric)
    picked = (
        long.withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= widest)
        .where(F.col("place") <= unit_limit(policy))
    )
    order = F.array_position(F.array(*[F.lit(m) for m in SELECTION_ORDER]), F.col("metric"))
    reasons = picked.groupBy(*POST_KEY).agg(
        F.min(F.struct(order.alias("ord"), F.col("metric")))["metric"].alias("selection_reason")
    )
    return posts.join(reasons, list(POST_KEY))

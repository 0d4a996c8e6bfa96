"""Derived measures, retention, bounded review batches and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.functions.time import local_date
from forumtide.operators.merge import POST_KEY
from forumtide.operators.ordering import exact_quantile, integer_bucket, running
from forumtide.params import utc, whole

# Comment-led rule, retention ages and warning ages.
COMMENT_LED_VERSION = "v1"
SHORT_BODY, LED_COMMENTS, LED_SHARE = 50, 3, 0.80
RAW_DAYS, TEXT_DAYS = 30, 90
WARN_DAYS = (60, 75, 85)

_SCORES = {"positive": 1.0, "negative": -1.0}


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def derived_measures(posts: DataFrame, keys: Sequence[str] = ("analysis_unit",)) -> DataFrame:
    """Per-day and per-1,000-view rates, and views relative to the unit median.

    ``posts`` carries counters and the ``slot`` they were seen at. Posts younger than a
    day count as one day old.
    """
    seconds = F.timestamp_diff("SECOND", F.col("published_at"), F.col("slot"))
    days = F.greatest(seconds / F.lit(86400.0), F.lit(1.0))
    median = exact_quantile(
        posts, keys, "views", integer_bucket(F.col("views")), 0.5, "unit_median_views"
    )
    return posts.join(median, list(keys)).select(
        *POST_KEY, *keys, "views",
        (F.col("views") / days).alias("views_per_day"),
        _ratio(F.col("comments") * 1000, F.col("views")).alias("comments_per_1000_views"),
        _ratio(F.col("recommendations") * 1000, F.col("views"))
        .alias("recommendations_per_1000_views"),
        "unit_median_views",
        F.when(F.col("unit_median_views") > 0, F.col("views") / F.col("unit_median_views"))
        .alias("views_to_unit_median"),
    )


def days_in_top(rankings: DataFrame) -> DataFrame:
    """Distinct local days each post was ranked, per counter."""
    return rankings.groupBy(*POST_KEY, "metric").agg(
        F.count_distinct(local_date(F.col("as_of_slot"))).alias("days_in_top")
    )


def _score(sentiment: Column) -> Column:
    score = F.lit(0.0)
    for label, value in _SCORES.items():
        score = F.when(sentiment == label, F.lit(value)).otherwise(score)
    return score


def sentiment_gap(posts: DataFrame, comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Body sentiment minus the mean comment sentiment, each on a scale of -1 to 1."""
    mean = comments.groupBy(*keys).agg(F.avg(_score(F.col("sentiment"))).alias("comment_score"))
    return posts.join(mean, list(keys)).select(
        *keys, _score(F.col("body_sentiment")).alias("body_score"), "comment_score",
        (_score(F.col("body_sentiment")) - F.col("comment_score")).alias("gap"),
    )


def comment_led(posts: DataFrame, comments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mark threads whose text is mostly in the comments."""
    sizes = comments.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_comments"),
        F.sum(F.char_length("text").cast("bigint")).alias("comment_chars"),
    )
    zero = F.lit(0).cast("bigint")
    joined = posts.join(sizes, list(keys), "left").select(
        *keys, F.char_length("body").cast("bigint").alias("body_chars"),
        F.coalesce("n_comments", zero).alias("n_comments"),
        F.coalesce("comment_chars", zero).alias("comment_chars"),
    )
    whole = F.col("body_chars") + F.col("comment_chars")
    led = (F.col("body_chars") <= SHORT_BODY) | (
        (F.col("n_comments") >= LED_COMMENTS) & (F.col("comment_chars") >= F.lit(LED_SHARE) * whole)
    )
    return joined.withColumn("comment_led", led).withColumn(
        "rule_version", F.lit(COMMENT_LED_VERSION)
    )


def retention_plan(
    items: DataFrame, now: datetime, raw_days: int = RAW_DAYS, text_days: int = TEXT_DAYS
) -> DataFrame:
    """Action per stored item ``(kind raw|text, stored_at, processed)``.

    Raw pages go after ``raw_days`` and text after ``text_days``; text never processed is
    marked as such, and warned about before. Facts are not items and are always kept.
    """
    whole(raw_days=raw_days, text_days=text_days)
    at = utc("now", now)

    def older(days: int) -> Column:
        return F.col("stored_at") < F.lit(at - timedelta(days=days))

    raw = F.col("kind") == "raw"
    action = (
        F.when(raw & older(raw_days), "delete_raw")
        .when(raw, "keep")
        .when(older(text_days) & F.col("processed"), "delete_text")
        .when(older(text_days), "expire_unprocessed")
    )
    for days in sorted(WARN_DAYS, reverse=True):
        action = action.when(~F.col("processed") & older(days), f"warn_{days}")
    return items.withColumn("action", action.otherwise("keep"))


def retention_summary(plan: DataFrame) -> DataFrame:
    return plan.groupBy("kind", "action").agg(
        F.count(F.lit(1)).alias("items"), F.min("stored_at").alias("oldest")
    )


def estimated_tokens(text: Column) -> Column:
    size = F.octet_length(text).cast("bigint")
    return F.greatest(F.lit(1).cast("bigint"), F.floor((size + 2) / 3).cast("bigint"))


def review_batch(
    candidates: DataFrame, analysed: DataFrame, max_items: int, token_budget: int
) -> DataFrame:
    """Next texts for review: least certain first, then most engaged.

    ``candidates`` has ``record_id, content_hash, text, confidence, engagement`` of safe
    texts; hashes in ``analysed`` are skipped and copies are taken once. The batch stops
    before it would pass either budget. Positions and tokens used are counted over ranges of
    the order, so either budget may be of any size. Runs jobs.
    """
    whole(max_items=max_items, token_budget=token_budget)
    fresh = candidates.join(analysed.select("content_hash"), "content_hash", "left_anti")
    order = F.struct(
        F.col("confidence"), F.negative("engagement").alias("_less"), F.col("record_id")
    )
    once = fresh.groupBy("content_hash").agg(
        F.min(F.struct(order.alias("o"), estimated_tokens(F.col("text")).alias("tokens"))).alias("_b")
    )
    best = once.select(
        F.col("_b.o.record_id").alias("record_id"), "content_hash",
        F.col("_b.o.confidence").alias("confidence"),
        F.negative(F.col("_b.o._less")).alias("engagement"), F.col("_b.tokens").alias("tokens"),
    )
    ordered = [F.asc("confidence"), F.desc("engagement"), F.asc("record_id")]
    counted = running(best, [], ordered, "tokens")
    return (
        counted.withColumn("position", F.col("place").cast("int"))
        .withColumn("tokens_used", F.col("running"))
        .where((F.col("position") <= max_items) & (F.col("tokens_used") <= token_budget))
        .drop("place", "running")
    )


def reconciliation(
    posts: DataFrame,
    snapshots: DataFrame,
    runs: DataFrame,
    rankings: DataFrame,
    tasks: DataFrame,
    now: datetime,
    slot_hours: int = 6,
    lease_hours: int = 6,
) -> DataFrame:
    """Audit rows ``(check, key, detail)``; an empty result means all is well."""
    at = utc("now", now)
    key = F.concat_ws(":", *POST_KEY)

    def audit(name: str, frame: DataFrame, row_key: Column, detail: Column) -> DataFrame:
        return frame.select(
            F.lit(name).alias("check"), row_key.alias("key"), detail.cast("string").alias("detail")
        )

    copies = posts.groupBy(*POST_KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Slots per post are bounded by the grid, so this window is too.
    order = Window.partitionBy(*POST_KEY).orderBy("slot")
    gaps = (
        snapshots.select(*POST_KEY, "slot")
        .withColumn("before", F.lag("slot").over(order))
        .withColumn("hours", F.timestamp_diff("HOUR", F.col("before"), F.col("slot")))
        .where(F.col("hours") > slot_hours)
        .groupBy(*POST_KEY)
        .agg(F.max("hours").alias("hours"))
    )
    stuck = runs.where(
        (F.col("status") == "running")
        & (F.col("started_at") < F.lit(at - timedelta(hours=lease_hours)))
    )
    wanted = rankings.select(*POST_KEY).distinct().withColumn(
        "task_key", F.concat(F.lit("detail:"), key, F.lit(":deep-v1"))
    )
    untasked = wanted.join(tasks.select("task_key"), "task_key", "left_anti")
    parts = [
        audit("duplicate_post", copies, key, F.col("n")),
        audit("metric_gap", gaps, key, F.col("hours")),
        audit("stuck_run", stuck, F.col("id"), F.col("job_type")),
        audit("missing_task", untasked, key, F.col("task_key")),
    ]
    return reduce(DataFrame.unionByName, parts)


def comment_mismatch(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Audit rows for threads whose stored comments differ from the displayed number."""
    held = comments.groupBy(*POST_KEY).agg(F.count(F.lit(1)).alias("held"))
    joined = posts.join(held, list(POST_KEY), "left")
    n = F.coalesce("held", F.lit(0).cast("bigint"))
    return joined.where(n != F.col("comments")).select(
        F.lit("comment_count").alias("check"), F.concat_ws(":", *POST_KEY).alias("key"),
        F.concat(n.cast("string"), F.lit("/"), F.col("comments").cast("string")).alias("detail"),
    )

"""As-of snapshots and cumulative top-N rankings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.operators.merge import POST_KEY
from forumtide.operators.validate import eligible_posts
from forumtide.params import RankingSpec, code, utc
from forumtide.registry import METRICS

# Fixed value: rows a ranking reader may show, whatever was stored.
READER_LIMIT = 50

ACTIVE_REVIEW = ("pending", "confirmed")
_POST_REF = r"^post:(0|[1-9][0-9]*):(0|[1-9][0-9]*)\z"


def as_of_counters(snapshots: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Counters of each post's latest snapshot, at or before ``as_of`` when given.

    Snapshots are unique per post and slot. Buffers are fixed-width, so this is a
    hash aggregate with map-side combine and no sort.
    """
    rows = snapshots if as_of is None else snapshots.where(F.col("slot") <= F.lit(as_of))
    return rows.groupBy(*POST_KEY).agg(
        *[F.max_by(name, "slot").alias(name) for name in METRICS], F.max("slot").alias("slot")
    )


def latest_snapshots(snapshots: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Each post's whole latest snapshot row."""
    rows = snapshots if as_of is None else snapshots.where(F.col("slot") <= F.lit(as_of))
    rest = [c for c in rows.columns if c not in (*POST_KEY, "slot")]
    best = rows.groupBy(*POST_KEY).agg(F.max(F.struct("slot", *rest)).alias("_best"))
    return best.select(*POST_KEY, "_best.*")


def latest_metrics(posts: DataFrame, snapshots: DataFrame, boards: DataFrame) -> DataFrame:
    """Posts with their board name and newest snapshot; posts never observed are left out."""
    newest = latest_snapshots(snapshots)
    names = boards.select(F.col("id").alias("board_id"), F.col("name").alias("board_name"))
    return posts.join(newest, list(POST_KEY)).join(names, "board_id")


def without_quarantined(posts: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Drop posts whose title is under active quarantine; released ones stay.

    References are parsed to the post key so that the anti join uses the same
    partitioning as the snapshot join.
    """
    ref = F.col("source_ref")
    blocked = quarantine.where(
        (F.col("source_kind") == "title") & F.col("review_state").isin(*ACTIVE_REVIEW)
    ).select(
        F.regexp_extract(ref, _POST_REF, 1).try_cast("int").alias("board_id"),
        F.regexp_extract(ref, _POST_REF, 2).try_cast("bigint").alias("post_id"),
    )
    return posts.join(blocked, list(POST_KEY), "left_anti")


def unpivot_metrics(rows: DataFrame, ids: tuple[str, ...]) -> DataFrame:
    """One row per counter: ``metric, metric_value``."""
    wide = rows.select(*ids, *[F.col(m).cast("bigint").alias(m) for m in METRICS])
    return wide.unpivot(list(ids), list(METRICS), "metric", "metric_value")


def rank_order(value: str = "metric_value") -> list[Column]:
    return [F.desc(value), F.desc("published_at"), F.desc("post_id"), F.desc("board_id")]


def cumulative_top(
    posts: DataFrame, snapshots: DataFrame, quarantine: DataFrame, spec: RankingSpec
) -> DataFrame:
    """Top-N posts per unit and counter as they stood at ``spec.as_of``."""
    return top_of(posts, as_of_counters(snapshots, spec.bounds[1]), quarantine, spec)


def top_of(
    posts: DataFrame, counters: DataFrame, quarantine: DataFrame, spec: RankingSpec
) -> DataFrame:
    """Top-N posts per unit and counter, given each post's counters at ``spec.as_of``.

    The rank filter sits on the window, so Spark keeps N rows per group in every
    map task before it shuffles: a unit with most of the posts costs N rows per task.
    """
    start, end = spec.bounds
    eligible = without_quarantined(eligible_posts(posts, start, end), quarantine).select(
        "analysis_unit", *POST_KEY, "published_at"
    )
    measured = eligible.join(counters.drop("slot"), list(POST_KEY))
    long = unpivot_metrics(measured, ("analysis_unit", *POST_KEY, "published_at"))
    place = Window.partitionBy("analysis_unit", "metric").orderBy(*rank_order())
    return (
        long.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= spec.top_n)
        .select(
            "analysis_unit", "metric", F.lit(end).cast("timestamp_ntz").alias("as_of_slot"),
            "rank", *POST_KEY, "metric_value", F.lit(spec.config_version).alias("config_version"),
        )
    )


def write_ranking(ranking: DataFrame, root: str, spec: RankingSpec) -> str:
    """Replace one slot of the ranking table.

    The slot's own folder is overwritten, so a re-run that ranks fewer units leaves
    no stale rows, and no other slot is touched.
    """
    _, end = spec.bounds
    path = f"{root.rstrip('/')}/as_of={end:%Y%m%dT%H%M%S}"
    ranking.write.mode("overwrite").parquet(path)
    return path


def ranked_posts(ranking: DataFrame) -> DataFrame:
    """Distinct posts over all ranked lists."""
    return ranking.select(*POST_KEY).distinct()


def newest_ranking(rankings: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Per unit and counter, only its latest stored slot (at or before ``as_of``)."""
    rows = rankings
    if as_of is not None:
        rows = rows.where(F.col("as_of_slot") <= F.lit(utc("as_of", as_of)))
    latest = rows.groupBy("analysis_unit", "metric").agg(F.max("as_of_slot").alias("as_of_slot"))
    return rows.join(latest, ["analysis_unit", "metric", "as_of_slot"])


def present_ranking(rankings: DataFrame, posts: DataFrame) -> DataFrame:
    """Ranking rows with the title, date and URL of their post."""
    shown = posts.select(*POST_KEY, "title", "published_at", "source_url")
    return rankings.join(shown, list(POST_KEY))


def read_top(
    rankings: DataFrame, posts: DataFrame, unit: str, metric: str, as_of: datetime | None = None
) -> DataFrame:
    """One list as shown to a reader, held to the reader's own limit."""
    chosen = rankings.where(
        (F.col("analysis_unit") == code("analysis_unit", unit)) & (F.col("metric") == code("metric", metric))
    )
    rows = present_ranking(newest_ranking(chosen, as_of), posts)
    return (
        rows.where(F.col("rank") <= READER_LIMIT)
        .orderBy("rank")
        .limit(READER_LIMIT)
        .select(
            "rank", "title", "metric_value", "published_at", "source_url", "as_of_slot",
            "config_version",
        )
    )

"""Order-independent merges: the same rows in any order or number give the same table.

Each merge is one aggregate on the key, so a hot key is combined before the
shuffle and a replayed batch changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.operators.validate import ordinary

POST_KEY = ("board_id", "post_id")
SNAPSHOT_KEY = ("board_id", "post_id", "slot")
COUNTERS = ("views", "recommendations", "comments")

_OBSERVED_ORDER = (
    "published_at", "title", "analysis_unit", "category", "source_url", "is_notice", "is_ad",
)


def collapse_observations(rows: DataFrame, keys: tuple[str, ...] = POST_KEY) -> DataFrame:
    """One row per key: metadata of the greatest tuple, every counter maximal on its own.

    ``copies`` is the number of observations behind each row.
    """
    counters = [F.max(name).alias(name) for name in COUNTERS]
    grouped = rows.groupBy(*keys).agg(
        F.max(F.struct(*_OBSERVED_ORDER)).alias("_best"),
        *counters,
        F.count(F.lit(1)).alias("copies"),
    )
    return grouped.select(
        *keys, *[F.col(f"_best.{name}").alias(name) for name in _OBSERVED_ORDER], *COUNTERS, "copies"
    )


def upsert_posts(existing: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Latest state per post: newest ``last_seen_at`` wins, equal times by greatest tuple."""
    columns = (
        "board_id", "post_id", "last_seen_at", "published_at", "title", "analysis_unit", "category",
        "source_url", "is_notice", "is_ad",
    )
    both = existing.select(*columns)
    if batch is not None:
        both = both.unionByName(batch.select(*columns))
    rank = F.struct(
        "last_seen_at", "published_at", "title", "analysis_unit",
        F.coalesce("category", F.lit("")).alias("_category"), "source_url", "is_notice", "is_ad",
        "category",
    )
    best = both.groupBy(*POST_KEY).agg(F.max(rank).alias("_best"))
    return best.select(
        *[c if c in POST_KEY else F.col(f"_best.{c}").alias(c) for c in columns]
    )


def _snapshots_by_key(rows: DataFrame) -> tuple[DataFrame, Column]:
    """One row per snapshot key with ``_version`` and ``_other``, and the list they point into.

    They are the places of the least and greatest configuration of the key. All buffers are
    fixed-width, so this is a hash aggregate: no row is sorted, and no key is joined back to
    its rows to learn a name.
    """
    versions = _versions(rows)
    # A missing configuration has no place, so that minima and maxima pass it over.
    placed = rows.withColumn("_version", F.array_position(versions, F.col("config_version")))
    return placed.groupBy(*SNAPSHOT_KEY).agg(
        F.max("observed_at").alias("observed_at"),
        *[F.max(name).alias(name) for name in COUNTERS],
        F.min("_version").alias("_version"), F.max("_version").alias("_other"),
    ), versions


def _versions(rows: DataFrame) -> Column:
    """All configurations of the rows in ascending order.

    There is one per release of the settings, so the list is a scalar subquery.
    """
    named = rows.where(F.col("config_version").isNotNull()).select("config_version").distinct()
    return named.agg(F.array_sort(F.collect_list("config_version")).alias("v")).scalar()


def _named(versions: Column, place: str) -> Column:
    return F.get(versions, (F.col(place) - 1).cast("int"))


def _both(existing: DataFrame, batch: DataFrame | None) -> DataFrame:
    return existing if batch is None else existing.unionByName(batch)


def merge_snapshots(
    existing: DataFrame, batch: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(merged, conflicts)`` of snapshot rows sharing a key.

    Counters and ``observed_at`` keep their greatest value. A key seen under two
    configurations is never merged; it is reported in ``conflicts``.
    """
    grouped, versions = _snapshots_by_key(_both(existing, batch))
    same = F.col("_version").eqNullSafe(F.col("_other"))
    conflicts = grouped.where(~same).select(
        *SNAPSHOT_KEY, _named(versions, "_version").alias("config_version"),
        _named(versions, "_other").alias("other_version"),
    )
    merged = grouped.where(same).withColumn("config_version", _named(versions, "_version"))
    columns = [*SNAPSHOT_KEY, "observed_at", *COUNTERS, "config_version"]
    return merged.select(*columns), conflicts


def merge_snapshots_strict(existing: DataFrame, batch: DataFrame | None = None) -> DataFrame:
    """Merged snapshots; the job fails if any key is pinned to another configuration."""
    grouped, versions = _snapshots_by_key(_both(existing, batch))
    checked = F.when(
        F.col("_version").eqNullSafe(F.col("_other")), _named(versions, "_version")
    ).otherwise(F.raise_error(F.lit("snapshot slot belongs to another configuration")))
    return grouped.withColumn("config_version", checked).select(
        *SNAPSHOT_KEY, "observed_at", *COUNTERS, "config_version"
    )


def insert_absent(existing: DataFrame, candidates: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Existing rows plus the candidates whose key is not there yet."""
    fresh = candidates.join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def detail_tasks(ranking: DataFrame, existing: DataFrame, available_at: Column) -> DataFrame:
    """New follow-up tasks for the distinct ranked posts; known task keys are left alone."""
    keys = ranking.select(*POST_KEY).distinct()
    tasks = keys.select(
        F.concat(
            F.lit("detail:"), F.col("board_id").cast("string"), F.lit(":"),
            F.col("post_id").cast("string"), F.lit(":deep-v1"),
        ).alias("task_key"),
        F.lit("detail_fetch").alias("kind"),
        F.lit("pending").alias("state"),
        F.to_json(F.struct("board_id", "post_id")).alias("payload"),
        available_at.alias("available_at"),
    )
    return tasks.join(existing.select("task_key"), "task_key", "left_anti")


def batch_summary(
    checked: DataFrame, existing_keys: DataFrame, flagged_titles: DataFrame
) -> DataFrame:
    """Per board: posts inserted and updated, titles quarantined, observations rejected.

    ``checked`` carries ``failed``; ``existing_keys`` holds known post keys, and
    ``flagged_titles`` the distinct titles of this batch that screening quarantined.
    """
    valid = F.size("failed") == 0
    per_post = (
        checked.groupBy(*POST_KEY)
        .agg(
            F.sum(valid.cast("bigint")).alias("good"),
            F.sum((~valid).cast("bigint")).alias("bad"),
        )
        .withColumn("written", (F.col("good") > 0).cast("bigint"))
    )
    known = existing_keys.select(*POST_KEY).distinct().withColumn("known", F.lit(1))
    counted = (
        per_post.join(known, list(POST_KEY), "left")
        .groupBy("board_id")
        .agg(
            F.sum(F.when(F.col("known").isNull(), F.col("written")).otherwise(0)).alias("inserted"),
            F.sum(F.when(F.col("known") == 1, F.col("written")).otherwise(0)).alias("updated"),
            F.sum(F.col("bad") + F.greatest(F.col("good") - 1, F.lit(0))).alias("rejected"),
        )
    )
    flagged = flagged_titles.groupBy("board_id").agg(F.count(F.lit(1)).alias("quarantined"))
    return counted.join(flagged, "board_id", "left").select(
        "board_id", "inserted", "updated",
        F.coalesce("quarantined", F.lit(0)).alias("quarantined"), "rejected",
    )


def high_water(posts: DataFrame) -> DataFrame:
    """Greatest ordinary post id per board."""
    return posts.where(ordinary()).groupBy("board_id").agg(F.max("post_id").alias("high_water"))

"""Short-window growth: deltas, rising scores, category scores, daily closes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.functions.time import local_date
from forumtide.operators.merge import POST_KEY
from forumtide.operators.ordering import (
    exact_quantile,
    integer_bucket,
    unit_bucket,
    with_percentile,
)
from forumtide.params import RisingSpec
from forumtide.session import materialize

RISING_METRICS = ("recommendations", "comments", "views")
P90 = 0.90


def post_deltas(snapshots: DataFrame, spec: RisingSpec = RisingSpec()) -> DataFrame:
    """Growth of each post over every window and over the window before it.

    Boundaries are the snapshots nearest to the target times within the tolerance; a
    missing boundary leaves null deltas and ``insufficient_history``, never zero. A post
    has one snapshot per slot, so its group is bounded by the slot grid; all windows are
    found in one aggregate after one shuffle.
    """
    post = Window.partitionBy(*POST_KEY)
    rows = snapshots.select(
        *POST_KEY, "slot", *[F.col(m).cast("bigint").alias(m) for m in RISING_METRICS]
    ).withColumn("_end", F.max("slot").over(post))
    tolerance = spec.tolerance_hours * 3_600_000_000
    micros_per_hour = 3_600_000_000

    def nearest(hours: int) -> Column:
        # Distance of this snapshot from `end - hours`, in microseconds.
        off = F.abs(
            F.timestamp_diff("MICROSECOND", F.col("slot"), F.col("_end"))
            - F.lit(hours * micros_per_hour)
        )
        found = F.struct(off.alias("off"), F.col("slot"), *RISING_METRICS)
        return F.min(F.when(off <= tolerance, found))

    boundaries = []
    for hours in spec.windows_hours:
        boundaries += [
            nearest(hours).alias(f"_s{hours}"), nearest(2 * hours).alias(f"_p{hours}")
        ]
    per_post = rows.groupBy(*POST_KEY).agg(
        F.max("slot").alias("as_of_slot"),
        *[F.max_by(m, "slot").alias(m) for m in RISING_METRICS],
        *boundaries,
    )

    def grown(now: Column, then: Column) -> Column:
        return F.when(now.isNotNull() & then.isNotNull(), F.greatest(now - then, F.lit(0)))

    windows = []
    for hours in spec.windows_hours:
        start, prior = F.col(f"_s{hours}"), F.col(f"_p{hours}")
        valid = start.isNotNull() & prior.isNotNull()
        windows.append(F.struct(
            F.lit(hours).alias("window_hours"),
            F.when(valid, "valid").otherwise("insufficient_history").alias("sample_state"),
            start["slot"].alias("source_start_slot"),
            *[grown(F.col(m), start[m]).alias(f"{m}_delta") for m in RISING_METRICS],
            *[grown(start[m], prior[m]).alias(f"prior_{m}_delta") for m in RISING_METRICS],
        ))
    return per_post.select(
        *POST_KEY, "as_of_slot", F.explode(F.array(*windows)).alias("w")
    ).select(*POST_KEY, "as_of_slot", "w.*")


GROUP = ("analysis_unit", "window_hours", "as_of_slot")


def rising_scores(
    deltas: DataFrame, spec: RisingSpec = RisingSpec(), group: tuple[str, ...] = GROUP
) -> DataFrame:
    """Score valid posts within comparable groups.

    Percentiles are taken on the deltas themselves: ``log1p`` keeps their order. All six
    delta columns are ranked together as one long column. Deltas and paces are read by
    several steps and stored once each; this runs jobs.
    """
    columns = [f"{p}{m}_delta" for p in ("", "prior_") for m in RISING_METRICS]
    ids = list(dict.fromkeys([*POST_KEY, *group]))
    valid = deltas.where(F.col("sample_state") == "valid").select(*ids, *columns)
    long = materialize(valid, "deltas").unpivot(ids, columns, "measure", "delta")
    keys = [*group, "measure"]
    wide = (
        with_percentile(long, keys, "delta", integer_bucket(F.col("delta")), "percentile")
        .groupBy(*ids)
        .agg(*[
            F.max(F.when(F.col("measure") == c, F.col("percentile")))
            .alias(c.replace("_delta", "_percentile"))
            for c in columns
        ])
    )
    weights = spec.weights

    def intensity(prefix: str) -> Column:
        parts = [F.lit(weights[m]) * F.col(f"{prefix}{m}_percentile") for m in RISING_METRICS]
        return reduce(lambda a, b: a + b, parts)

    change = F.col("engagement_intensity") - F.col("prior_engagement_intensity")
    paced = materialize(
        wide.withColumn("engagement_intensity", intensity(""))
        .withColumn("prior_engagement_intensity", intensity("prior_"))
        .withColumn("acceleration", F.greatest(change, F.lit(0.0))),
        "paces",
    )
    share = spec.acceleration_weight
    score = F.lit(1 - share) * F.col("engagement_intensity") + F.lit(share) * F.col(
        "acceleration_percentile"
    )
    return with_percentile(
        paced, list(group), "acceleration", unit_bucket(F.col("acceleration")),
        "acceleration_percentile",
    ).withColumn("rising_score", score)


def _extra(category: str, cohort: tuple[str, ...]) -> list[str]:
    return [] if category in (*POST_KEY, *cohort) else [category]


def category_scores(
    scored: DataFrame, category: str, spec: RisingSpec = RisingSpec(),
    cohort: tuple[str, ...] = ("window_hours",),
) -> DataFrame:
    """Blend of the strongest posts' mean and the share above the cohort's 90th percentile.

    The scores are read three times and stored once; this runs jobs.
    """
    scored = materialize(scored.select(*POST_KEY, *cohort, *_extra(category, cohort), "rising_score"), "scores")
    threshold = exact_quantile(
        scored, cohort, "rising_score", unit_bucket(F.col("rising_score")), P90, "_p90"
    )
    keys = [*cohort, category]
    place = Window.partitionBy(*keys).orderBy(F.desc("rising_score"), *[F.desc(k) for k in POST_KEY])
    top = (
        scored.withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") <= spec.category_top_k)
        .groupBy(*keys)
        .agg(F.avg("rising_score").alias("top_mean"))
    )
    shares = scored.join(threshold, list(cohort)).groupBy(*keys).agg(
        F.avg((F.col("rising_score") >= F.col("_p90")).cast("double")).alias("p90_share"),
        F.count(F.lit(1)).alias("contributing_count"),
    )
    weight = spec.category_top_mean_weight
    blended = F.lit(weight) * F.col("top_mean") + F.lit(1 - weight) * F.col("p90_share")
    state = F.when(F.col("contributing_count") >= spec.category_min_posts, "valid").otherwise(
        "low_sample"
    )
    return top.join(shares, keys).select(
        *keys, "top_mean", "p90_share", blended.alias("rising_score"), "contributing_count",
        state.alias("sample_state"),
    )


def daily_close(snapshots: DataFrame) -> DataFrame:
    """Closing counters per post and local day, with growth since the previous close.

    The first day grows from its own first snapshot. Groups are bounded by the slot grid.
    """
    day = local_date(F.col("slot"))
    closes = snapshots.groupBy(*POST_KEY, day.alias("day")).agg(
        *[F.max_by(m, "slot").alias(f"closing_{m}") for m in RISING_METRICS],
        *[F.min_by(m, "slot").alias(f"_open_{m}") for m in RISING_METRICS],
    )
    order = Window.partitionBy(*POST_KEY).orderBy("day")
    growth = [
        F.greatest(
            F.col(f"closing_{m}")
            - F.coalesce(F.lag(f"closing_{m}").over(order), F.col(f"_open_{m}")),
            F.lit(0),
        ).alias(f"{m}_delta")
        for m in RISING_METRICS
    ]
    return closes.select(*POST_KEY, "day", *[f"closing_{m}" for m in RISING_METRICS], *growth)


def opinion_daily(items: DataFrame) -> DataFrame:
    """Daily opinion per unit and topic from ``published_at, sentiment, quarantined``.

    Quarantined items are excluded from every count but their own; an item without a
    sentiment is eligible but not analysed.
    """
    open_item = ~F.col("quarantined")
    labelled = open_item & F.col("sentiment").isNotNull()

    def n(condition: Column) -> Column:
        return F.count_if(condition)

    return items.groupBy(
        "analysis_unit", "topic", local_date(F.col("published_at")).alias("day")
    ).agg(
        n(labelled & (F.col("sentiment") == "positive")).alias("positive"),
        n(labelled & F.col("sentiment").isin("neutral", "mixed")).alias("neutral"),
        n(labelled & (F.col("sentiment") == "negative")).alias("negative"),
        n(open_item).alias("eligible"),
        n(labelled).alias("analysed"),
        n(F.col("quarantined")).alias("excluded"),
        F.max(F.when(labelled, F.col("published_at"))).alias("fresh_through"),
    )

"""Totals, unit comparison, distributions and inventories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.functions.time import hours_before, range_label
from forumtide.operators.merge import POST_KEY
from forumtide.operators.windows import evidence_end, fallback_reason
from forumtide.params import WindowSpec
from forumtide.registry import GENERAL_UNITS, OTHER_SUFFIX

JOB_WINDOW = WindowSpec(168, 720, 5)


def _total(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column).cast("bigint")), F.lit(0).cast("bigint"))


def engagement_totals(rows: DataFrame, *keys: str) -> DataFrame:
    """Posts and counter totals, zero on empty input; per key when keys are given."""
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("posts"),
        _total("comments").alias("comments"),
        _total("recommendations").alias("recommendations"),
        _total("views").alias("views"),
    )


def unit_comparison(
    posts: DataFrame, spec: WindowSpec = JOB_WINDOW, job_labels: DataFrame | None = None
) -> DataFrame:
    """Totals and per-post rates of every job unit over its effective window.

    Both windows are summed side by side in one pass and the effective one is chosen
    afterwards, so posts are read and shuffled once, already reduced to units.
    """
    end = evidence_end(posts)
    longer = spec.fallback_hours if spec.fallback_hours is not None else spec.hours
    unit = F.col("analysis_unit")
    jobs = posts.where(
        unit.isNotNull() & ~unit.isin(*GENERAL_UNITS) & ~unit.endswith(OTHER_SUFFIX)
    )

    def inside(hours: int) -> Column:
        return F.col("published_at") >= hours_before(end, hours)

    sums = []
    for name, hours in (("short", spec.hours), ("long", longer)):
        sums.append(F.sum(inside(hours).cast("bigint")).alias(f"n_{name}"))
        for metric in ("comments", "recommendations", "views"):
            value = F.when(inside(hours), F.col(metric).cast("bigint")).otherwise(0)
            sums.append(F.sum(value).alias(f"{metric}_{name}"))
    grouped = jobs.groupBy("analysis_unit").agg(*sums)

    sparse = (
        F.col("n_short") < spec.minimum if spec.fallback_hours is not None else F.lit(False)
    )
    picked = grouped.select(
        "analysis_unit",
        F.when(sparse, F.col("n_long")).otherwise(F.col("n_short")).alias("sample_size"),
        *[
            F.when(sparse, F.col(f"{m}_long")).otherwise(F.col(f"{m}_short")).alias(f"total_{m}")
            for m in ("comments", "recommendations", "views")
        ],
        F.when(sparse, longer).otherwise(spec.hours).alias("effective_hours"),
        F.when(sparse, fallback_reason(spec)).alias("fallback_reason"),
    )
    if job_labels is None:
        named = picked.withColumn("job", F.col("analysis_unit"))
    else:
        named = picked.join(job_labels, "analysis_unit", "left").withColumn(
            "job", F.coalesce("job", "analysis_unit")
        )

    def rate(metric: str) -> Column:
        n = F.col("sample_size")
        return F.when(n > 0, F.col(f"total_{metric}") / n).otherwise(F.lit(0.0))

    return named.select(
        "analysis_unit", "job", "sample_size",
        "total_comments", rate("comments").alias("comments_per_post"),
        "total_recommendations", rate("recommendations").alias("recommendations_per_post"),
        "total_views", rate("views").alias("views_per_post"),
        range_label(hours_before(end, F.col("effective_hours")), end).alias("analysis_period"),
        "effective_hours", "fallback_reason",
    )


def source_period(rows: DataFrame) -> DataFrame:
    """First and last publication with the local date-range label."""
    span = rows.agg(
        F.min("published_at").alias("start"), F.max("published_at").alias("end")
    )
    label = range_label(F.col("start"), F.col("end"))
    return span.select(
        "start", "end", label.alias("range_label"), F.concat(label, F.lit(" 게시물")).alias("label")
    )


def distribution(rows: DataFrame, column: str, *keys: str) -> DataFrame:
    """Label counts and shares, per key when keys are given; nulls are not counted.

    The share divides by a total taken over the already counted labels.
    """
    counted = (
        rows.where(F.col(column).isNotNull())
        .groupBy(*keys, F.col(column).alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = counted.groupBy(*keys).agg(F.sum("count").alias("total"))
    if keys:
        joined = counted.join(totals, list(keys))
    else:
        joined = counted.withColumn("total", totals.scalar())
    return joined.select(*keys, "label", "count", (F.col("count") / F.col("total")).alias("share"))


def negative_share(rows: DataFrame, column: str, *keys: str) -> DataFrame:
    """Share of rows labelled negative or mixed; zero on empty input."""
    hit = F.coalesce(F.col(column).isin("negative", "mixed"), F.lit(False)).cast("double")
    return rows.groupBy(*keys).agg(F.coalesce(F.avg(hit), F.lit(0.0)).alias("share"))


def distinct_units(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count_distinct("analysis_unit").alias("units"))


def board_inventory(boards: DataFrame, posts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Posts and snapshots stored per board; boards with none are kept.

    Rows are counted per key first, so a board holding most of the table is reduced
    in the map tasks.
    """
    per_post = posts.groupBy(*POST_KEY).agg(F.count(F.lit(1)).alias("copies"))
    held = per_post.groupBy("board_id").agg(
        F.count(F.lit(1)).alias("posts"),
        F.sum((F.col("copies") > 1).cast("bigint")).alias("duplicate_keys"),
    )
    observed = snapshots.groupBy("board_id").agg(F.count(F.lit(1)).alias("snapshots"))
    names = boards.select(F.col("id").alias("board_id"), F.col("name").alias("board_name"))
    zero = F.lit(0).cast("bigint")
    return (
        names.join(held, "board_id", "left")
        .join(observed, "board_id", "left")
        .select(
            "board_id", "board_name", F.coalesce("posts", zero).alias("posts"),
            F.coalesce("snapshots", zero).alias("snapshots"),
            F.coalesce("duplicate_keys", zero).alias("duplicate_keys"),
        )
    )


def duplicate_keys(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def presentation_snapshot(
    posts: DataFrame, health: DataFrame, comparison: DataFrame, source: Column
) -> DataFrame:
    """JSON rows ``(kind, snapshot)``: one header and one row per unit; nulls are kept.

    The header holds source, totals and run health. Units stay rows, so there may be any
    number of them; a reader orders them by ``comments_per_post``.
    """
    keep = {"ignoreNullFields": "false"}
    totals = engagement_totals(posts).select(F.struct("*").alias("totals"))
    header = health.select(
        F.lit("header").alias("kind"),
        F.to_json(F.struct(
            source.alias("source"),
            totals.scalar().alias("totals"),
            F.struct(
                "total_runs", "succeeded_runs", "failed_runs", "partial_runs", "success_rate"
            ).alias("collection"),
        ), keep).alias("snapshot"),
    )
    units = comparison.select(
        F.lit("unit").alias("kind"), F.to_json(F.struct(*comparison.columns), keep).alias("snapshot")
    )
    return header.unionByName(units)


def label_totals(rows: DataFrame, dimensions: dict[str, str], *keys: str) -> DataFrame:
    """Distributions of several label columns in one pass: ``dimension, label, count, share``."""
    wide = rows.select(*keys, *[F.col(c).alias(name) for name, c in dimensions.items()])
    long = wide.unpivot(list(keys), list(dimensions), "dimension", "value")
    counted = (
        long.where(F.col("value").isNotNull())
        .groupBy(*keys, "dimension", F.col("value").alias("label"))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    # The window runs over counted labels: one row per label, not per post.
    over = Window.partitionBy(*keys, "dimension")
    return counted.withColumn("share", F.col("count") / F.sum("count").over(over))

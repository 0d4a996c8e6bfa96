"""Exact ranks and quantiles of groups too large for one task.

A window ordered over a whole group would sort that group in one task. Here values
are first reduced to distinct values with counts, then numbered in three levels of
buckets. A window never spans more than one bucket, and each level passes only its
totals upwards, so one group may hold most of the table.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.session import materialize

# Bits resolved per level: at most 2**16 buckets meet in one window.
LEVEL_BITS = 16


def running(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], value: str | None = None,
) -> DataFrame:
    """Rows with ``place`` (from 1) and, of ``value``, the sum so far (``running``) per group.

    Rows are cut into ranges of the whole order and counted and summed per range; a range then
    needs only what lies before it, so neither a group nor the whole table is ordered in one
    task. Without ``keys`` the order is global: one row per range is read by the driver.
    ``order`` should leave no ties, else tied rows are placed arbitrarily. Runs jobs.
    """
    keys, order = list(keys), list(order)
    summed = [F.sum(value).alias("_sum")] if value else []
    ranged = materialize(
        rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    totals = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"), *summed)
    names = ["_n", *(["_sum"] if value else [])]
    if keys:
        # A group meets as many rows here as it spans ranges.
        earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
            Window.unboundedPreceding, -1
        )
        starts = totals.select(
            *keys, "_range",
            *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in names],
        )
    else:
        found = totals.orderBy("_range").collect()
        before = [[0, *accumulate(row[c] for row in found)] for c in names]
        starts = rows.sparkSession.createDataFrame(
            [(row["_range"], *[b[i] for b in before]) for i, row in enumerate(found)],
            "_range INT, " + ", ".join(f"{c}_before BIGINT" for c in names),
        )
    within = Window.partitionBy(*keys, "_range").orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    placed = ranged.join(materialize(starts, "range-starts"), [*keys, "_range"]).withColumn(
        "place", F.col("_n_before") + F.row_number().over(within)
    )
    if value:
        placed = placed.withColumn("running", F.col("_sum_before") + F.sum(value).over(so_far))
    return placed.drop("_range", "_n_before", "_sum_before")


def integer_bucket(value: Column) -> Column:
    """Bucket of a non-negative integer: 65,536 neighbouring values share one."""
    return F.shiftright(value.cast("bigint"), LEVEL_BITS)


def unit_bucket(value: Column) -> Column:
    """Bucket of a double in [0, 1], 2**32 over the range."""
    return F.floor(value * float(2 ** (2 * LEVEL_BITS))).cast("bigint")


def ranked_values(rows: DataFrame, keys: Sequence[str], value: str, bucket: Column) -> DataFrame:
    """Distinct values per key with ``n`` copies, rows ``before`` and rows in ``total``.

    ``bucket`` must not decrease as the value grows. The counted values are stored once,
    since all three levels read them; this runs a job.
    """
    keys = list(keys)
    counted = materialize(
        rows.where(F.col(value).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("_b0", bucket)
        .withColumn("_b1", F.shiftright("_b0", LEVEL_BITS)),
        "values",
    )

    def earlier(partition: list[str], order: str) -> Column:
        frame = Window.partitionBy(*partition).orderBy(order).rowsBetween(
            Window.unboundedPreceding, -1
        )
        return F.coalesce(F.sum("n").over(frame), F.lit(0).cast("bigint"))

    fine = counted.groupBy(*keys, "_b1", "_b0").agg(F.sum("n").alias("n"))
    coarse = fine.groupBy(*keys, "_b1").agg(F.sum("n").alias("n"))
    top = coarse.select(
        *keys, "_b1", earlier(keys, "_b1").alias("_above"),
        F.sum("n").over(Window.partitionBy(*keys)).alias("total"),
    )
    middle = fine.select(
        *keys, "_b1", "_b0", earlier([*keys, "_b1"], "_b0").alias("_mid")
    ).join(top, [*keys, "_b1"])
    placed = counted.withColumn("_low", earlier([*keys, "_b0"], value))
    return placed.join(middle.drop("_b1"), [*keys, "_b0"]).select(
        *keys, value, "n",
        (F.col("_above") + F.col("_mid") + F.col("_low")).alias("before"), "total",
    )


def average_percentile() -> Column:
    """Average-rank percentile of a value: ties share the middle of their ranks."""
    return (F.col("before") + (F.col("n") + 1) / F.lit(2.0)) / F.col("total")


def with_percentile(
    rows: DataFrame, keys: Sequence[str], value: str, bucket: Column, output: str
) -> DataFrame:
    """Rows with the average-rank percentile of a non-negative value within its group.

    Zero is often the value of half the rows, so its percentile, one per group, is joined on
    the group alone (a small stored table); only the other rows are joined on their value.
    ``rows`` are read twice more and should be stored. This runs jobs.
    """
    keys = list(keys)
    ranks = materialize(
        ranked_values(rows, keys, value, bucket).select(
            *keys, value, average_percentile().alias(output)
        ), "percentiles",
    )
    none = ranks.where(F.col(value) == 0).drop(value)
    some = ranks.where(F.col(value) != 0)
    still = rows.where(F.col(value) == 0).join(none, keys)
    grown = rows.where(F.col(value) != 0).join(some, [*keys, value])
    return still.unionByName(grown)


def exact_quantile(
    rows: DataFrame, keys: Sequence[str], value: str, bucket: Column, q: float, output: str
) -> DataFrame:
    """Linearly interpolated quantile per key, stored ready to be joined to the rows."""
    keys = list(keys)
    at = F.lit(q) * (F.col("total") - 1)
    low, high = F.floor(at), F.ceil(at)

    def covers(place: Column) -> Column:
        return (F.col("before") <= place) & (place < F.col("before") + F.col("n"))

    ranked = ranked_values(rows, keys, value, bucket)
    # Only the one or two values around the position are kept per key.
    near = ranked.where(covers(low) | covers(high)).groupBy(*keys).agg(
        F.max(F.when(covers(low), F.col(value).cast("double"))).alias("_low"),
        F.max(F.when(covers(high), F.col(value).cast("double"))).alias("_high"),
        F.max(at - low).alias("_part"),
    )
    between = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return materialize(near.select(*keys, between.alias(output)), "quantiles")

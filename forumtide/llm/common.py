"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumtide.session import materialize

# The six white-space characters [\x20\x09-\x0D], and the split between words.
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def whole_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """Words of a text: maximal runs of characters other than the six blanks."""
    return F.array_remove(F.split(text, WORD_GAP), "")


def bucketed_rank(
    rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column], out: str
) -> DataFrame:
    """Zero-based exact rank within ``group`` without sorting a group in one task.

    ``bucket`` must not decrease along ``order``; the rank is the number of rows in earlier
    buckets plus the place within the bucket. Buckets of an evenly spread key are even, so a
    group that holds most of the table is still ranked by many tasks. ``rows`` is read twice
    and should be stored. This runs a job.
    """
    group = list(group)
    earlier = Window.partitionBy(*group).orderBy(bucket).rowsBetween(
        Window.unboundedPreceding, -1
    )
    counts = rows.groupBy(*group, bucket).agg(F.count(F.lit(1)).alias("_ft_n"))
    starts = materialize(
        counts.select(
            *group, bucket,
            F.coalesce(F.sum("_ft_n").over(earlier), F.lit(0).cast("bigint")).alias("_ft_start"),
        ),
        "starts",
    )
    within = Window.partitionBy(*group, bucket).orderBy(*order)
    return (
        rows.join(starts, [*group, bucket])
        .withColumn(out, F.col("_ft_start") + F.row_number().over(within) - 1)
        .drop("_ft_start")
    )


def bucket_bits(n_rows: int, per_bucket: int, most: int = 16) -> int:
    """Bits of a bucket number so that buckets hold about ``per_bucket`` rows.

    At most 2**most buckets, so that the list of bucket totals of one group stays small.
    """
    bits = 0
    while bits < most and n_rows > per_bucket << bits:
        bits += 1
    return bits

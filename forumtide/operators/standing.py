"""Rankings carried from slot to slot.

The standing of a slot holds the newest counters of every post that is still inside the
look-back window. The next slot merges it with what was observed since; the history of
snapshots is not read again. Posts, their units and their quarantine state are always the
present ones. The merge takes maxima, so observations may come late, twice or in any order, and
a slot that is computed again from the same inputs gives the same standing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.functions.time import local_date
from forumtide.operators.merge import POST_KEY
from forumtide.operators.ranking import top_of, write_ranking
from forumtide.params import RankingSpec
from forumtide.registry import METRICS
from forumtide.schemas import RANKING

STANDING = (
    "board_id INT, post_id BIGINT, slot TIMESTAMP_NTZ, "
    + ", ".join(f"{name} BIGINT" for name in METRICS)
)
TOP_DAYS = "board_id INT, post_id BIGINT, metric STRING, span BIGINT, days BINARY"


def newest_counters(rows: DataFrame) -> DataFrame:
    """Each post's counters at its newest slot; of rows of that slot the greatest each."""
    return rows.groupBy(*POST_KEY).agg(
        F.max("slot").alias("slot"),
        *[F.max_by(m, F.struct("slot", m)).cast("bigint").alias(m) for m in METRICS],
    )


def _folder(root: str, spec: RankingSpec) -> str:
    return f"{root.rstrip('/')}/standing/as_of={spec.bounds[1]:%Y%m%dT%H%M%S}"


def advance_slot(
    root: str,
    posts: DataFrame,
    observed: DataFrame,
    quarantine: DataFrame,
    spec: RankingSpec,
    previous: RankingSpec | None = None,
) -> DataFrame:
    """Rank a slot from the standing of ``previous`` and what was observed since.

    ``observed`` are the snapshots after the previous slot, and any earlier ones that came late;
    without ``previous``, all of them. Later slots than ``spec.as_of`` are left to the next
    call. The windows of one series should have one length: a post that has left the window
    is forgotten. Standing and ranking each go to the slot's own folder below ``root``, which
    a repeated call overwrites. Returns the stored ranking. This runs jobs.
    """
    spark, (start, end) = posts.sparkSession, spec.bounds
    seen = observed.where(F.col("slot") <= F.lit(end)).select(
        *POST_KEY, F.col("slot").cast("timestamp_ntz").alias("slot"),
        *[F.col(m).cast("bigint").alias(m) for m in METRICS],
    )
    if previous is not None:
        if previous.bounds[1] >= end:
            raise ValueError("the previous slot must be an earlier one")
        held = spark.read.schema(STANDING).parquet(_folder(root, previous))
        seen = seen.unionByName(held)
    inside = posts.where(F.col("published_at") >= F.lit(start)).select(*POST_KEY)
    newest_counters(seen).join(inside, list(POST_KEY), "left_semi").write.mode(
        "overwrite"
    ).parquet(_folder(root, spec))
    standing = spark.read.schema(STANDING).parquet(_folder(root, spec))
    path = write_ranking(top_of(posts, standing, quarantine, spec), f"{root}/ranking", spec)
    return spark.read.schema(RANKING).parquet(path)


def top_days(ranking: DataFrame) -> DataFrame:
    """``(post, metric, span, days)``: the local days of ranked posts as bitmaps.

    A span is 32,768 days, one bitmap of fixed size; slots of one day set the same bit.
    """
    day = F.date_diff(local_date(F.col("as_of_slot")), F.lit("1970-01-01").cast("date"))
    return ranking.select(*POST_KEY, "metric", day.cast("bigint").alias("day")).groupBy(
        *POST_KEY, "metric", F.bitmap_bucket_number("day").alias("span")
    ).agg(F.bitmap_construct_agg(F.bitmap_bit_position("day")).alias("days"))


def merged_days(*parts: DataFrame) -> DataFrame:
    """Bitmaps of several slots or of earlier merges, in any order and number."""
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy(*POST_KEY, "metric", "span").agg(F.bitmap_or_agg("days").alias("days"))


def count_days(days: DataFrame) -> DataFrame:
    """Distinct local days each post was ranked, per counter."""
    return days.groupBy(*POST_KEY, "metric").agg(
        F.sum(F.bitmap_count("days")).alias("days_in_top")
    )

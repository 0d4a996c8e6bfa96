"""Nested comment payloads to one row per comment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.functions.text import plain_text

PAYLOAD = (
    "STRUCT<cmtcount: STRING, commentlist: ARRAY<STRUCT<list: ARRAY<STRUCT<"
    "__attr__: STRUCT<cmtidx: STRING, cmtpidx: STRING>, o_date: STRING, o_comment: STRING>>>>>"
)


def parse_comments(
    payloads: DataFrame, column: str = "payload", keys: tuple[str, ...] = ("board_id", "post_id")
) -> tuple[DataFrame, DataFrame]:
    """``(comments, status)`` of JSON payloads.

    Comments with a bad id or no text are skipped and the first of each id is kept. The
    first is an aggregate minimum over the position, so a payload full of copies is
    reduced before it is shuffled. ``status`` has the reported and parsed numbers.
    """
    parsed = payloads.select(*keys, F.from_json(F.col(column), PAYLOAD).alias("p"))
    reported = F.col("p.cmtcount").try_cast("bigint")
    # Outer explodes and a null list instead of filters: a filter here would be pushed below
    # the parse and repeat it.
    listed = F.when(reported.isNotNull(), F.col("p.commentlist"))
    groups = parsed.select(*keys, F.posexplode_outer(listed).alias("g", "group"))
    items = groups.select(*keys, "g", F.posexplode_outer("group.list").alias("i", "item"))
    comment_id = F.col("item.__attr__.cmtidx").try_cast("bigint")
    parent = F.col("item.__attr__.cmtpidx")
    rows = items.select(
        *keys, "g", "i", comment_id.alias("comment_id"),
        F.when(parent.isNull(), comment_id).otherwise(parent.try_cast("bigint")).alias("parent_id"),
        F.coalesce("item.o_date", F.lit("")).alias("published_at"),
        plain_text(F.coalesce("item.o_comment", F.lit(""))).alias("text"),
    ).where(
        F.col("comment_id").isNotNull() & F.col("parent_id").isNotNull() & (F.col("text") != "")
    )
    first = rows.groupBy(*keys, "comment_id").agg(
        F.min(F.struct("g", "i", "parent_id", "published_at", "text")).alias("_first")
    )
    comments = first.select(
        *keys, "comment_id", "_first.parent_id", "_first.published_at", "_first.text"
    )
    counted = comments.groupBy(*keys).agg(F.count(F.lit(1)).alias("parsed"))
    n = F.coalesce("parsed", F.lit(0).cast("bigint"))
    status = (
        parsed.select(*keys, reported.alias("reported_count"))
        .join(counted, list(keys), "left")
        .select(
            *keys, "reported_count", n.alias("parsed_count"),
            (n == F.col("reported_count")).alias("complete"),
            F.when(F.col("reported_count").isNull(), "invalid payload").alias("error"),
        )
    )
    return comments, status

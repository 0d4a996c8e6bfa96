"""Row validation, unit mapping, eligibility and batch bounds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.functions.text import SPACE, nfkc, strip
from forumtide.functions.values import MAX_BIGINT, MAX_INT, Site
from forumtide.registry import AD_CLASSES, AD_LABEL, NOTICE_CLASSES, NOTICE_LABEL

# Fixed value: observations that one slot usually carries at most.
USUAL_BATCH = 5_000


def map_units(rows: DataFrame, unit_map: DataFrame, output: str = "mapped_unit") -> DataFrame:
    """Add the analysis unit of ``(board_id, category)``; null when nothing maps.

    A unit-map row with a null category fixes the unit of its whole board. The map
    is a dimension with one row per board category.
    """
    fixed = unit_map.where(F.col("category").isNull()).select(
        "board_id", F.col("unit").alias("_fixed")
    )
    named = unit_map.where(F.col("category").isNotNull()).select(
        "board_id", F.col("category").alias("_category"), F.col("unit").alias("_named")
    )
    keyed = rows.withColumn("_category", strip(nfkc(F.col("category"))))
    return (
        keyed.join(named, ["board_id", "_category"], "left")
        .join(fixed, "board_id", "left")
        .withColumn(output, F.coalesce("_fixed", "_named"))
        .drop("_category", "_fixed", "_named")
    )


def _in_range(column: str, low: int, high: int) -> Column:
    return F.coalesce(F.col(column).between(low, high), F.lit(False))


def _storable(column: str) -> Column:
    value = F.col(column)
    return ~value.contains("\x00") & F.is_valid_utf8(value)


def failed_rules(
    rows: DataFrame, unit_map: DataFrame, site: Site, max_title: int | None = None
) -> DataFrame:
    """Add ``failed``: ids of the observation rules each row breaks, empty when valid.

    ``max_title`` refuses longer titles; without it titles of any length are taken.
    """
    known = unit_map.select("board_id").distinct().withColumn("_board", F.lit(True))
    mapped = map_units(rows, unit_map, "_unit").join(known, "board_id", "left")
    category, title = F.col("category"), F.col("title")
    edge_space = rf"(?U)^{SPACE}|{SPACE}\z"
    rules = {
        "board": F.col("_board"),
        "post_id": _in_range("post_id", 1, MAX_BIGINT),
        "category": (F.char_length(category) > 0)
        & (category == strip(nfkc(category))) & _storable("category"),
        "unit": F.col("_unit").isNotNull() & (F.col("analysis_unit") == F.col("_unit")),
        "title": (F.char_length(title) >= 1) & (F.char_length(title) <= (max_title or MAX_INT))
        & ~title.rlike(edge_space) & _storable("title"),
        "published_at": F.col("published_at").isNotNull(),
        "views": _in_range("views", 0, MAX_BIGINT),
        "recommendations": _in_range("recommendations", 0, MAX_INT),
        "comments": _in_range("comments", 0, MAX_INT),
        "url": F.col("source_url") == site.article_url(F.col("board_id"), F.col("post_id")),
        "kind": F.col("is_notice").isNotNull() & F.col("is_ad").isNotNull()
        & ~(F.col("is_notice") & F.col("is_ad")),
    }
    flags = F.array(
        *[F.when(~F.coalesce(ok, F.lit(False)), F.lit(rule)) for rule, ok in rules.items()]
    )
    return mapped.withColumn("failed", F.array_compact(flags)).drop("_unit", "_board")


def split_valid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, rejected)`` of a frame carrying ``failed``."""
    ok = F.size("failed") == 0
    return checked.where(ok).drop("failed"), checked.where(~ok)


def ordinary() -> Column:
    return ~F.col("is_notice") & ~F.col("is_ad")


def eligible_posts(posts: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Ordinary posts published in the closed range; both bounds reach the scan."""
    published = F.col("published_at")
    return posts.where(ordinary() & (published >= F.lit(start)) & (published <= F.lit(end)))


def oversized_batches(
    rows: DataFrame, keys: tuple[str, ...] = ("board_id", "slot"), limit: int = USUAL_BATCH
) -> DataFrame:
    """Report of batches holding more observations than a slot usually carries; none is refused."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)


def row_kind(classes: Column, label: Column) -> Column:
    """``struct(is_notice, is_ad, ambiguous)`` from a row's class list and label text."""
    lowered = F.transform(classes, F.lower)

    def marked(values: tuple[str, ...], text: str) -> Column:
        overlap = F.arrays_overlap(lowered, F.array(*[F.lit(v) for v in values]))
        return F.coalesce(overlap, F.lit(False)) | F.coalesce(label == text, F.lit(False))

    notice, advert = marked(NOTICE_CLASSES, NOTICE_LABEL), marked(AD_CLASSES, AD_LABEL)
    return F.struct(
        notice.alias("is_notice"), advert.alias("is_ad"), (notice & advert).alias("ambiguous")
    )


def label_codes(rows: DataFrame, column: str, labels: dict[str, str]) -> DataFrame:
    """Replace codes by display labels; an unmapped code keeps itself.

    ``labels`` is a fixed code list, so it becomes a map literal and needs no join.
    """
    pairs = [F.lit(item) for pair in labels.items() for item in pair]
    code = F.col(column)
    shown = F.coalesce(F.try_element_at(F.create_map(*pairs), code), code) if pairs else code
    return rows.withColumn(column, shown)


def fill_blank(rows: DataFrame, column: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(column), F.lit(""))
    return rows.withColumn(column, F.when(value == "", F.lit(text)).otherwise(value))

"""Which landed list pages to admit: incremental stop page, backfill cut, page budget.

All three are "until" rules over pages in order. They are computed as one aggregate
position per source and a comparison, never as an ordered walk of a source in one task.
The per-source results are stored before they are joined back (this runs jobs), so the
rows are not shuffled by source, of which one may hold a third of them.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.operators.ordering import running
from forumtide.operators.validate import ordinary
from forumtide.params import AdmissionSpec, whole
from forumtide.session import materialize

FIRST_BACKFILL_PAGE = 3


def _position() -> Column:
    """Page and row order as one sortable integer."""
    return F.shiftleft(F.col("page").cast("bigint"), 32) + F.col("pos").cast("bigint")


def incremental_status(
    rows: DataFrame, marks: DataFrame, spec: AdmissionSpec = AdmissionSpec()
) -> DataFrame:
    """Per source: pages read, whether the prior mark was reached, and the next mark.

    ``rows`` has ``source_key, page, pos, post_id, is_notice, is_ad``; ``marks`` has
    ``source_key, prior``. A source without a mark, or with a null one, runs for the first
    time. All landed pages are looked at unless the spec names a last one.
    """
    pages = rows.where(F.col("page") >= 1)
    if spec.max_pages is not None:
        pages = pages.where(F.col("page") <= spec.max_pages)
    hit = ordinary() & (F.col("post_id") <= F.col("prior"))
    found = (
        pages.join(marks.select("source_key", "prior"), "source_key", "left")
        .groupBy("source_key")
        .agg(
            F.max("prior").alias("prior"),
            F.min(F.when(hit, F.col("page"))).alias("boundary_page"),
            F.max("page").alias("landed_pages"),
        )
    )
    needed = F.when(F.col("prior").isNull(), F.lit(spec.min_pages)).otherwise(
        F.greatest(F.lit(spec.min_pages), F.col("boundary_page") + spec.overlap_pages)
    )
    # A missing boundary leaves `greatest` with the minimum only, so it is handled apart.
    landed = F.col("landed_pages")
    unmet = F.col("prior").isNotNull() & F.col("boundary_page").isNull()
    read = F.when(unmet, landed).otherwise(F.least(needed, landed))
    reached = F.col("prior").isNull() | F.coalesce(
        F.col("pages_read") >= F.col("boundary_page") + spec.overlap_pages, F.lit(False)
    )
    stops = materialize(
        found.withColumn("pages_read", read).withColumn("boundary_reached", reached), "stops"
    )
    greatest = (
        pages.where(ordinary())
        .join(stops.select("source_key", "pages_read"), "source_key")
        .where(F.col("page") <= F.col("pages_read"))
        .groupBy("source_key")
        .agg(F.max("post_id").alias("greatest"))
    )
    status = stops.join(greatest, "source_key", "left").select(
        "source_key", "pages_read", "boundary_reached",
        F.when(F.col("boundary_reached"), F.col("greatest")).otherwise(F.col("prior"))
        .alias("high_water"),
        F.when(F.col("boundary_reached"), "succeeded").otherwise("partial").alias("status"),
    )
    return materialize(status, "status")


def incremental_rows(rows: DataFrame, status: DataFrame) -> DataFrame:
    """Admitted posts of the succeeded sources, the preferred sighting of each."""
    done = status.where("boundary_reached").select("source_key", "pages_read")
    extra = [
        c for c in rows.columns
        if c not in ("source_key", "board_id", "post_id", "views", "recommendations", "comments",
                     "page", "pos")
    ]
    order = F.struct("views", "recommendations", "comments", "page", "pos", *extra)
    best = (
        rows.join(done, "source_key")
        .where(F.col("page") <= F.col("pages_read"))
        .groupBy("source_key", "board_id", "post_id")
        .agg(F.max(order).alias("_best"))
    )
    return best.select("source_key", "board_id", "post_id", "_best.*")


def backfill_cuts(rows: DataFrame, cutoff: datetime) -> DataFrame:
    """Per source: position of the first ordinary row older than the cutoff, if any."""
    old = ordinary() & (F.col("published_at") < F.lit(cutoff))
    return materialize(
        rows.groupBy("source_key")
        .agg(F.min(F.when(old, _position())).alias("cut"))
        .withColumn("cut_page", F.shiftright("cut", 32).cast("int")),
        "cuts",
    )


def backfill_rows(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows before each source's cut; notices and ads are kept, never cut on."""
    limits = cuts.select("source_key", "cut")
    return (
        rows.join(limits, "source_key")
        .where(F.col("cut").isNull() | (_position() < F.col("cut")))
        .drop("cut")
    )


def backfill_status(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Per source: accepted rows, completeness, and the last ordinary id looked at."""
    before = F.col("cut").isNull() | (F.col("at") < F.col("cut"))
    seen = ordinary() & (F.col("cut").isNull() | (F.col("at") <= F.col("cut")))
    return (
        rows.withColumn("at", _position())
        .join(cuts.select("source_key", "cut"), "source_key")
        .groupBy("source_key")
        .agg(
            F.sum(before.cast("bigint")).alias("accepted"),
            F.max(F.col("cut").isNotNull()).alias("complete"),
            F.max(F.when(seen, F.struct("at", "post_id")))["post_id"].alias("checkpoint_post_id"),
        )
    )


def allocate_pages(
    pages: DataFrame, states: DataFrame, budget: int, cuts: DataFrame | None = None
) -> DataFrame:
    """Spend a page budget round-robin: one page per open source and round.

    ``pages`` has ``source_key, source_order, page``; ``states`` has ``source_key,
    next_page, complete`` (absent sources start at the default page). A source leaves
    after the page holding its cut. The budget may be of any size: turns and rounds are
    counted over ranges of the order, and no source's pages meet in one task. Runs jobs.
    """
    whole(budget=budget)
    open_pages = (
        pages.distinct()
        .join(states.select("source_key", "next_page", "complete"), "source_key", "left")
        .where(~F.coalesce("complete", F.lit(False)))
        .withColumn(
            "resume",
            F.greatest(F.lit(1), F.coalesce("next_page", F.lit(FIRST_BACKFILL_PAGE)) - 1),
        )
        .where(F.col("page") >= F.col("resume"))
    )
    if cuts is not None:
        open_pages = (
            open_pages.join(cuts.select("source_key", "cut_page"), "source_key", "left")
            .where(F.col("cut_page").isNull() | (F.col("page") <= F.col("cut_page")))
        )
    # No source can use more rounds than the budget.
    turns = running(open_pages, ["source_key"], [F.col("page")]).where(F.col("place") <= budget)
    rounds = turns.select(
        "source_key", "source_order", "page", F.col("place").cast("int").alias("round")
    )
    order = [F.col(name) for name in ("round", "source_order", "source_key")]
    spent = running(rounds, [], order).where(F.col("place") <= budget)
    return spent.withColumn("seq", F.col("place").cast("int")).drop("place")

"""Run ledger: claims, accounting, health, cycle status and freshness."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.params import utc, whole

RUN_KEY = ("job_type", "slot")
SETTLED = ("succeeded", "already_succeeded")


def _diagnostic(diagnostics: Column, key: str) -> Column:
    return F.try_variant_get(F.try_parse_json(diagnostics), f"$.{key}", "variant")


def diagnostic_count(diagnostics: Column, key: str) -> Column:
    """Non-negative integer from a JSON object; anything else counts as zero."""
    value = _diagnostic(diagnostics, key)
    number = F.when(F.schema_of_variant(value) == "BIGINT", F.try_variant_get(value, "$", "bigint"))
    return F.greatest(number, F.lit(0).cast("bigint"))


def diagnostic_sources(diagnostics: Column, key: str = "failed_sources") -> Column:
    """Non-empty strings of a JSON list, else an empty list."""
    items = F.try_variant_get(_diagnostic(diagnostics, key), "$", "array<variant>")
    texts = F.filter(items, lambda v: F.schema_of_variant(v) == "STRING")
    names = F.transform(texts, lambda v: F.try_variant_get(v, "$", "string"))
    return F.coalesce(F.filter(names, lambda s: s != ""), F.array().cast("array<string>"))


def claim_slots(requests: DataFrame, runs: DataFrame) -> DataFrame:
    """What claiming each requested ``(job_type, slot)`` would give.

    A succeeded run is replayed with its stored figures; any other run is taken over
    with one more attempt; a new slot starts at attempt one.
    """
    attempts = diagnostic_count(F.col("diagnostics"), "attempts")
    stored = runs.select(
        *RUN_KEY, F.col("id").alias("run_id"), "status", attempts.alias("_attempts"),
        *[
            diagnostic_count(F.col("diagnostics"), key).alias(key)
            for key in ("ranking_rows", "pages_consumed", "accepted")
        ],
        diagnostic_sources(F.col("diagnostics")).alias("failed_sources"),
    )
    joined = requests.join(stored, list(RUN_KEY), "left")
    settled = F.coalesce(F.col("status") == "succeeded", F.lit(False))
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *requests.columns,
        "run_id",
        F.when(settled, "already_succeeded").otherwise("acquired").alias("disposition"),
        F.when(F.col("run_id").isNull(), F.lit(1).cast("bigint"))
        .when(settled, F.col("_attempts")).otherwise(F.col("_attempts") + 1).alias("attempts"),
        *[F.coalesce(key, zero).alias(key) for key in ("ranking_rows", "pages_consumed", "accepted")],
        F.coalesce("failed_sources", F.array().cast("array<string>")).alias("failed_sources"),
    )


def run_accounting(runs: DataFrame, page_budget: int) -> DataFrame:
    """Attempts and page allowance of each run; malformed diagnostics count as zero."""
    if isinstance(page_budget, bool) or not isinstance(page_budget, int):
        raise TypeError("page_budget must be an integer")
    if page_budget < 0:
        raise ValueError("page_budget must not be negative")
    used = diagnostic_count(F.col("diagnostics"), "pages_consumed")
    return runs.select(
        "id", *RUN_KEY, "status",
        diagnostic_count(F.col("diagnostics"), "attempts").alias("attempts"),
        used.alias("pages_consumed"),
        F.greatest(F.lit(page_budget) - used, F.lit(0)).alias("pages_left"),
        ((F.col("status") == "running") & (used < page_budget)).alias("may_reserve"),
    )


def finish_runs(runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Ledger after recording ``outcomes (id, status, finished_at, diagnostics)``."""
    changed = ("status", "finished_at", "diagnostics")
    new = outcomes.select("id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_{c}") for c in changed])
    joined = runs.join(new, "id", "left")
    return joined.select(*[
        F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in changed
        else F.col(c)
        for c in runs.columns
    ])


def run_health(runs: DataFrame, posts: DataFrame) -> DataFrame:
    """Run counts by outcome, success rate, and the newest slot any post was seen in."""
    status = F.col("status")

    def n(value: str) -> Column:
        return F.count_if(status == value)

    counted = runs.agg(
        F.count(F.lit(1)).alias("total_runs"), n("succeeded").alias("succeeded_runs"),
        n("failed").alias("failed_runs"), n("partial").alias("partial_runs"),
    )
    total = F.col("total_runs")
    rate = F.when(total > 0, F.col("succeeded_runs") / total).otherwise(F.lit(0.0))
    latest = posts.agg(F.max("slot").alias("latest_slot")).scalar()
    return counted.withColumn("success_rate", rate).withColumn("latest_slot", latest)


def failed_runs(runs: DataFrame) -> DataFrame:
    """Failed and partial runs; sort by slot descending when shown."""
    return runs.where(F.col("status").isin("failed", "partial"))


def cycle_status(results: DataFrame, *keys: str) -> DataFrame:
    """Outcome of a cycle from its per-source ``status`` and ``backfill_failed`` rows."""
    good = F.count_if(F.col("status").isin(*SETTLED))
    counted = results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("sources"),
        good.alias("succeeded"),
        F.count_if(F.col("status") == "partial").alias("partial"),
        F.count_if(F.col("status") == "failed").alias("failed"),
        F.count_if(F.col("status") == "busy").alias("busy"),
        F.max("backfill_failed").alias("backfill_failed"),
    )
    whole = (F.col("succeeded") == F.col("sources")) & ~F.col("backfill_failed")
    return counted.withColumn(
        "cycle_status",
        F.when(whole, "succeeded").when(F.col("succeeded") > 0, "partial").otherwise("failed"),
    )


def is_fresh(runs: DataFrame, now: datetime, max_age_hours: int) -> DataFrame:
    """One row: did any metadata run succeed recently enough."""
    whole(max_age_hours=max_age_hours)
    cutoff = utc("now", now) - timedelta(hours=max_age_hours)
    good = runs.where(F.col("job_type").startswith("metadata:") & (F.col("status") == "succeeded"))
    newest = good.agg(F.max("finished_at").alias("newest"))
    return newest.select(
        F.coalesce(F.col("newest") >= F.lit(cutoff), F.lit(False)).alias("healthy")
    )

"""Queries over windows, totals and the run ledger."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from forumtide.functions.time import (
    local_label,
    period_label,
    slot_of,
    source_time,
)
from forumtide.operators import ledger, metrics, windows
from forumtide.params import WindowSpec
from forumtide.plans import tables as t
from forumtide.plans.catalog import QUERIES, query
from forumtide.registry import SelectionPolicy

# Publication ends three months before the last snapshot, so the windows are long. At scale
# factor 0.01 some units reach the minimum in the short window and some fall back.
WINDOW = WindowSpec(24 * 200, 24 * 365, 135)
UNIT_WINDOW = WindowSpec(24 * 250, 24 * 365, 190)
POLICY = SelectionPolicy("sample-v1", 365, 5, 20)
NOW = datetime(2024, 1, 29, tzinfo=timezone.utc)

_END = "(SELECT max(slot) FROM latest)"


def _window_sql(short: int, long: int, minimum: int) -> str:
    return f"""
chosen AS (
  SELECT analysis_unit,
         CASE WHEN count(*) FILTER (published_at >= {_END} - to_hours({short})) < {minimum}
              THEN {long} ELSE {short} END AS effective_hours,
         CASE WHEN count(*) FILTER (published_at >= {_END} - to_hours({short})) < {minimum}
              THEN '{short // 24}일 표본 부족' END AS fallback_reason
  FROM latest GROUP BY analysis_unit),
windowed AS (
  SELECT l.*, c.effective_hours, c.fallback_reason FROM latest l
  JOIN chosen c ON c.analysis_unit = l.analysis_unit
  WHERE l.published_at >= {_END} - to_hours(c.effective_hours))"""


@query(
    "WIN-2",
    f"""WITH {t.LATEST},{_window_sql(WINDOW.hours, WINDOW.fallback_hours, WINDOW.minimum)}
SELECT analysis_unit, board_id, post_id, published_at, effective_hours, fallback_reason,
       {_END} - to_hours(effective_hours) AS window_start, {_END} AS window_end FROM windowed""",
)
def window_selection(spark, folder):
    rows = windows.select_windows(t.stored_latest(spark, folder), WINDOW)
    return rows.select(
        "analysis_unit", "board_id", "post_id", "published_at", "effective_hours",
        "fallback_reason", "window_start", "window_end",
    )


@query(
    "AGG-2",
    f"""WITH {t.LATEST},{_window_sql(UNIT_WINDOW.hours, UNIT_WINDOW.fallback_hours, UNIT_WINDOW.minimum)},
sums AS (
  SELECT c.analysis_unit, c.effective_hours, c.fallback_reason, count(w.post_id) AS n,
         CAST(coalesce(sum(w.comments), 0) AS BIGINT) AS c,
         CAST(coalesce(sum(w.recommendations), 0) AS BIGINT) AS r,
         CAST(coalesce(sum(w.views), 0) AS BIGINT) AS v
  FROM chosen c LEFT JOIN windowed w ON w.analysis_unit = c.analysis_unit GROUP BY ALL)
SELECT analysis_unit, analysis_unit AS job, n AS sample_size, c AS total_comments,
       CASE WHEN n > 0 THEN c / n ELSE 0.0::DOUBLE END AS comments_per_post,
       r AS total_recommendations,
       CASE WHEN n > 0 THEN r / n ELSE 0.0::DOUBLE END AS recommendations_per_post,
       v AS total_views, CASE WHEN n > 0 THEN v / n ELSE 0.0::DOUBLE END AS views_per_post,
       strftime({_END} - to_hours(effective_hours) + INTERVAL 9 HOURS, '%Y.%m.%d') || '–' ||
         strftime({_END} + INTERVAL 9 HOURS, '%Y.%m.%d') AS analysis_period,
       effective_hours, fallback_reason FROM sums""",
)
def unit_comparison(spark, folder):
    return metrics.unit_comparison(t.stored_latest(spark, folder), UNIT_WINDOW)


@query(
    "AGG-1",
    f"""WITH {t.LATEST}
SELECT count(*) AS posts, CAST(sum(comments) AS BIGINT) AS comments,
       CAST(sum(recommendations) AS BIGINT) AS recommendations, CAST(sum(views) AS BIGINT) AS views
FROM latest""",
)
def engagement_totals(spark, folder):
    return metrics.engagement_totals(t.latest(spark, folder))


_VIEW = "title, comments, recommendations, views, published_at, source_url"


@query(
    "TOP-1",
    f"""WITH {t.LATEST} SELECT {_VIEW} FROM latest
ORDER BY views DESC, published_at DESC, post_id DESC, board_id DESC LIMIT 10""",
)
def top_posts(spark, folder):
    return windows.rank_posts(t.latest(spark, folder), "views", 10)


@query(
    "TOP-3",
    f"""WITH {t.LATEST},{_window_sql(WINDOW.hours, WINDOW.fallback_hours, WINDOW.minimum)}
SELECT {_VIEW} FROM windowed WHERE analysis_unit = 'building' AND comments = 0
ORDER BY published_at DESC, post_id DESC, board_id DESC LIMIT 20""",
)
def zero_comment_posts(spark, folder):
    rows = windows.select_windows(t.stored_latest(spark, folder), WINDOW, "building")
    return windows.unanswered(rows)


@query(
    "WIN-3",
    f"""WITH {t.LATEST},
recent AS (SELECT * FROM latest
           WHERE published_at >= (SELECT max(published_at) FROM latest) - INTERVAL 365 DAYS),
long AS (
  SELECT board_id, post_id, analysis_unit, published_at,
         unnest(['comments', 'recommendations', 'views']) AS metric,
         unnest([1, 2, 3]) AS ord, unnest([comments, recommendations, views]) AS value FROM recent),
picked AS (
  SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY metric, analysis_unit
    ORDER BY value DESC, published_at DESC, post_id DESC, board_id DESC) <= 5),
reasons AS (
  SELECT board_id, post_id, arg_min(metric, ord) AS selection_reason FROM picked GROUP BY ALL)
SELECT l.board_id, l.post_id, l.analysis_unit, r.selection_reason
FROM latest l JOIN reasons r ON r.board_id = l.board_id AND r.post_id = l.post_id""",
)
def detail_candidates(spark, folder):
    rows = windows.detail_candidates(t.stored_latest(spark, folder), POLICY)
    return rows.select("board_id", "post_id", "analysis_unit", "selection_reason")


@query("WIN-4", f"SELECT event_id, ts, {t.SLOT} AS slot FROM events")
def slot_alignment(spark, folder):
    return t.load(spark, folder, "events").select(
        "event_id", "ts", slot_of(F.col("ts")).alias("slot")
    )


@query(
    "FN-8",
    """SELECT event_id, strftime(ts + INTERVAL 9 HOURS, '%Y-%m-%d %H:%M') AS shown,
       CASE WHEN h = 24 THEN '24시간' WHEN h % 24 = 0 THEN (h // 24) || '일'
            ELSE h || '시간' END AS period
FROM (SELECT *, CAST(floor(value) AS INTEGER) + 1 AS h FROM events)""",
)
def local_labels(spark, folder):
    hours = F.floor("value").cast("int") + 1
    return t.load(spark, folder, "events").select(
        "event_id", local_label(F.col("ts")).alias("shown"), period_label(hours).alias("period")
    )


@query(
    "FN-3",
    """WITH cells AS (
  SELECT event_id, ts + INTERVAL 9 HOURS AS here,
         CASE event_type WHEN 'view' THEN strftime(ts + INTERVAL 5 HOURS, '%H:%M')
              WHEN 'click' THEN strftime(ts + INTERVAL 20 HOURS, '%H:%M')
              WHEN 'purchase' THEN strftime(ts + to_days(CAST(floor(value) AS INTEGER)), '%m-%d')
              WHEN 'error' THEN strftime(ts - to_days(CAST(floor(value) AS INTEGER)), '%Y-%m-%d')
              ELSE 'today' END AS cell, event_type
  FROM events),
found AS (
  SELECT event_id, cell,
    CASE event_type
      WHEN 'error' THEN try_strptime(cell, '%Y-%m-%d')
      WHEN 'purchase' THEN (
        SELECT max(d) FROM (SELECT unnest([
          try_strptime(year(here) || '-' || cell, '%Y-%m-%d'),
          try_strptime((year(here) - 1) || '-' || cell, '%Y-%m-%d'),
          try_strptime((year(here) - 2) || '-' || cell, '%Y-%m-%d'),
          try_strptime((year(here) - 3) || '-' || cell, '%Y-%m-%d'),
          try_strptime((year(here) - 4) || '-' || cell, '%Y-%m-%d')]) AS d) WHERE d <= here)
      WHEN 'signup' THEN NULL
      ELSE (SELECT CASE WHEN c > here THEN c - INTERVAL 1 DAY ELSE c END
            FROM (SELECT try_strptime(strftime(here, '%Y-%m-%d') || ' ' || cell,
                                      '%Y-%m-%d %H:%M') AS c)) END AS found_at
  FROM cells)
SELECT event_id, cell, found_at - INTERVAL 9 HOURS AS published_at FROM found""",
)
def relative_times(spark, folder):
    """Source date cells built from event times, read back against the event time."""
    ts, kind = F.col("ts"), F.col("event_type")
    days = F.floor("value").cast("int")
    cell = (
        F.when(kind == "view", F.date_format(ts + F.expr("INTERVAL 5 HOURS"), "HH:mm"))
        .when(kind == "click", F.date_format(ts + F.expr("INTERVAL 20 HOURS"), "HH:mm"))
        .when(kind == "purchase", F.date_format(ts + F.make_dt_interval(days), "MM-dd"))
        .when(kind == "error", F.date_format(ts - F.make_dt_interval(days), "yyyy-MM-dd"))
        .otherwise("today")
    )
    rows = t.load(spark, folder, "events").select("event_id", "ts", cell.alias("cell"))
    return rows.select(
        "event_id", "cell", source_time(F.col("cell"), F.col("ts")).alias("published_at")
    )


@query(
    "AGG-4",
    f"""WITH {t.POSTS}, span AS (SELECT min(published_at) AS a, max(published_at) AS b FROM posts)
SELECT a AS start, b AS "end",
       strftime(a + INTERVAL 9 HOURS, '%Y.%m.%d') || '–' || strftime(b + INTERVAL 9 HOURS, '%Y.%m.%d')
         AS range_label,
       strftime(a + INTERVAL 9 HOURS, '%Y.%m.%d') || '–' || strftime(b + INTERVAL 9 HOURS, '%Y.%m.%d')
         || ' 게시물' AS label FROM span""",
)
def source_period(spark, folder):
    return metrics.source_period(t.posts(spark, folder))


@query("AGG-10", f"WITH {t.POSTS} SELECT count(DISTINCT analysis_unit) AS units FROM posts")
def distinct_units(spark, folder):
    return metrics.distinct_units(t.posts(spark, folder))


# --- run ledger ---------------------------------------------------------------------------------

_HEALTH = """
SELECT count(*) AS total_runs, count(*) FILTER (status = 'succeeded') AS succeeded_runs,
       count(*) FILTER (status = 'failed') AS failed_runs,
       count(*) FILTER (status = 'partial') AS partial_runs,
       count(*) FILTER (status = 'succeeded') / count(*) AS success_rate"""


@query(
    "AGG-3",
    f"""WITH {t.RUNS},{t.SNAPSHOTS} {_HEALTH},
       (SELECT max(slot) FROM snapshots) AS latest_slot FROM runs""",
)
def run_health(spark, folder):
    return ledger.run_health(t.runs(spark, folder), t.snapshots(spark, folder))


@query(
    "AGG-3",
    f"""WITH {t.RUNS} SELECT id, job_type, slot, status FROM runs
WHERE status IN ('failed', 'partial')""",
)
def failed_runs(spark, folder):
    return ledger.failed_runs(t.runs(spark, folder)).select("id", "job_type", "slot", "status")


@query(
    "AGG-8",
    f"""WITH {t.RUNS},
cycles AS (
  SELECT slot, count(*) AS sources, count(*) FILTER (status = 'succeeded') AS succeeded,
         count(*) FILTER (status = 'partial') AS partial, count(*) FILTER (status = 'failed') AS failed,
         CAST(0 AS BIGINT) AS busy, bool_or(job_type = 'metadata:error' AND status = 'failed')
           AS backfill_failed
  FROM runs GROUP BY slot)
SELECT *, CASE WHEN succeeded = sources AND NOT backfill_failed THEN 'succeeded'
               WHEN succeeded > 0 THEN 'partial' ELSE 'failed' END AS cycle_status FROM cycles""",
)
def cycle_status(spark, folder):
    runs = t.runs(spark, folder)
    broken = (F.col("job_type") == "metadata:error") & (F.col("status") == "failed")
    return ledger.cycle_status(runs.withColumn("backfill_failed", broken), "slot")


@query(
    "OPS-1",
    f"""WITH {t.RUNS}
SELECT coalesce(max(finished_at) >= TIMESTAMP '2024-01-29' - INTERVAL 13 HOURS, false) AS healthy
FROM runs WHERE job_type LIKE 'metadata:%' AND status = 'succeeded'""",
)
def run_freshness(spark, folder):
    return ledger.is_fresh(t.runs(spark, folder), NOW, 13)


@query(
    "JOIN-8",
    f"""WITH {t.RUNS},
kinds AS (SELECT DISTINCT 'metadata:' || event_type AS job_type FROM events),
requests AS (
  SELECT DISTINCT 'metadata:' || event_type AS job_type, {t.SLOT} + INTERVAL 12 HOURS AS slot
  FROM events)
SELECT q.job_type, q.slot, r.id AS run_id,
       CASE WHEN r.status = 'succeeded' THEN 'already_succeeded' ELSE 'acquired' END AS disposition,
       CASE WHEN r.id IS NULL THEN 1 WHEN r.status = 'succeeded' THEN r.attempts
            ELSE r.attempts + 1 END AS attempts,
       coalesce(r.pages_consumed, 0) AS pages_consumed, CAST(0 AS BIGINT) AS accepted,
       CASE WHEN r.id IS NULL THEN '' ELSE r.job_type END AS failed_sources
FROM requests q LEFT JOIN runs r ON r.job_type = q.job_type AND r.slot = q.slot""",
)
def ledger_claims(spark, folder):
    """Claims for slots two grid steps after every run; some exist, the last ones do not."""
    later = slot_of(F.col("ts")) + F.expr("INTERVAL 12 HOURS")
    requests = t.load(spark, folder, "events").select(
        F.concat(F.lit("metadata:"), F.col("event_type")).alias("job_type"), later.alias("slot")
    ).distinct()
    claims = ledger.claim_slots(requests, t.runs(spark, folder))
    return claims.select(
        "job_type", "slot", "run_id", "disposition", "attempts", "pages_consumed", "accepted",
        F.array_join("failed_sources", ",").alias("failed_sources"),
    )


@query(
    "OPS-2",
    f"""WITH {t.RUNS}
SELECT id, job_type, slot, status, attempts, pages_consumed,
       greatest(20 - pages_consumed, 0) AS pages_left, false AS may_reserve FROM runs""",
)
def run_accounting(spark, folder):
    return ledger.run_accounting(t.runs(spark, folder), 20)


@query(
    "OPS-2",
    f"""WITH {t.RUNS}
SELECT id, CASE WHEN status = 'partial' THEN 'succeeded' ELSE status END AS status,
       CASE WHEN status = 'partial' THEN finished_at + INTERVAL 1 HOUR ELSE finished_at END
         AS finished_at FROM runs""",
)
def finished_runs(spark, folder):
    runs = t.runs(spark, folder)
    outcomes = runs.where(F.col("status") == "partial").select(
        "id", F.lit("succeeded").alias("status"),
        (F.col("finished_at") + F.expr("INTERVAL 1 HOUR")).alias("finished_at"), "diagnostics",
    )
    return ledger.finish_runs(runs, outcomes).select("id", "status", "finished_at")


@query(
    "AGG-12",
    f"""SELECT 'unit' AS kind, job AS name, sample_size AS posts, total_comments AS comments,
  total_views AS views FROM ({QUERIES["unit_comparison"].sql})
UNION ALL
SELECT 'header', 'lineitem', posts, comments, views FROM ({QUERIES["engagement_totals"].sql})""",
)
def presentation_snapshot(spark, folder):
    """The snapshot's JSON rows, read back field by field."""
    posts = t.stored_latest(spark, folder)
    health = ledger.run_health(t.runs(spark, folder), t.snapshots(spark, folder))
    source = F.struct(F.lit("lineitem").alias("archive"), F.lit(4).alias("checksums_verified"))
    rows = metrics.presentation_snapshot(
        posts, health, metrics.unit_comparison(posts, UNIT_WINDOW), source
    )

    def field(*paths: str):
        found = [F.get_json_object("snapshot", f"$.{path}") for path in paths]
        return F.coalesce(*found)

    return rows.select(
        "kind", field("job", "source.archive").alias("name"),
        field("sample_size", "totals.posts").cast("bigint").alias("posts"),
        field("total_comments", "totals.comments").cast("bigint").alias("comments"),
        field("total_views", "totals.views").cast("bigint").alias("views"),
    )

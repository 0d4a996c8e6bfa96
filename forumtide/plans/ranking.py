"""Queries over rankings and as-of joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from forumtide.operators import collection, merge, ranking, standing, validate
from forumtide.params import RankingSpec
from forumtide.plans import tables as t
from forumtide.plans.catalog import QUERIES, query
from forumtide.schemas import RANKING
from forumtide.session import scratch_path

SPEC = RankingSpec(t.AS_OF, window_days=365, top_n=50, config_version=t.VERSION)
EARLY = RankingSpec(t.EARLIER, window_days=365, top_n=50, config_version=t.VERSION)


def _top(spark, folder, spec=SPEC):
    return ranking.cumulative_top(
        t.posts(spark, folder), t.snapshots(spark, folder), t.quarantine(spark, folder), spec
    )


def _stored(spark, folder):
    """A ranking table of two slots: each ranked and written once, then read."""
    root = scratch_path(spark, "rankings")
    for spec in (EARLY, SPEC):
        ranking.write_ranking(_top(spark, folder, spec), root, spec)
    return spark.read.schema(RANKING).parquet(f"{root}/*")


def _top_cte(name: str, as_of: str) -> str:
    at = f"TIMESTAMP '{as_of}'"
    return f"""
{name}_eligible AS (
  SELECT p.analysis_unit, p.board_id, p.post_id, p.published_at, s.views, s.recommendations,
         s.comments
  FROM posts p
  JOIN (SELECT * FROM snapshots WHERE slot <= {at}
        QUALIFY row_number() OVER (PARTITION BY board_id, post_id ORDER BY slot DESC) = 1) s
    ON p.board_id = s.board_id AND p.post_id = s.post_id
  WHERE NOT p.is_notice AND NOT p.is_ad
    AND p.published_at >= {at} - INTERVAL 365 DAYS AND p.published_at <= {at}
    AND NOT EXISTS (
      SELECT 1 FROM quarantine q WHERE q.source_kind = 'title'
        AND q.source_ref = 'post:' || p.board_id || ':' || p.post_id
        AND q.review_state IN ('pending', 'confirmed'))
),
{name} AS (
  SELECT analysis_unit, metric, {at} AS as_of_slot,
         CAST(row_number() OVER (PARTITION BY analysis_unit, metric
              ORDER BY metric_value DESC, published_at DESC, post_id DESC, board_id DESC)
              AS INTEGER) AS rank,
         board_id, post_id, metric_value, '{t.VERSION}' AS config_version
  FROM (SELECT analysis_unit, board_id, post_id, published_at, 'views' AS metric,
               views AS metric_value FROM {name}_eligible
        UNION ALL SELECT analysis_unit, board_id, post_id, published_at, 'recommendations',
               recommendations FROM {name}_eligible
        UNION ALL SELECT analysis_unit, board_id, post_id, published_at, 'comments',
               comments FROM {name}_eligible)
  QUALIFY rank <= 50
)"""


BASE = f"WITH {t.SNAPSHOTS},{t.QUARANTINE}"
LATE_CTE = _top_cte("top_late", "1999-06-01 00:00:00")
EARLY_CTE = _top_cte("top_early", "1998-09-01 00:00:00")
STORED = f"""{BASE},{LATE_CTE},{EARLY_CTE},
stored AS (SELECT * FROM top_early UNION ALL SELECT * FROM top_late)"""


@query("WIN-1 FLT-3 JOIN-1 JOIN-3 JOIN-9", f"{BASE},{LATE_CTE} SELECT * FROM top_late")
def cumulative_top(spark, folder):
    return _top(spark, folder)


@query("WIN-1 JOIN-1 AGG-10", f"{BASE},{LATE_CTE} SELECT * FROM top_late")
def carried_top(spark, folder):
    """The later slot ranked from the standing of the earlier one and what was seen since."""
    root = scratch_path(spark, "standing")
    posts, shots, held = (f(spark, folder) for f in (t.posts, t.snapshots, t.quarantine))
    standing.advance_slot(root, posts, shots, held, EARLY)
    since = shots.where(F.col("slot") > F.lit(EARLY.bounds[1]))
    return standing.advance_slot(root, posts, since, held, SPEC, EARLY)


@query(
    "FLT-3",
    f"""WITH {t.POSTS}
SELECT board_id, post_id, analysis_unit, published_at FROM posts
WHERE NOT is_notice AND NOT is_ad
  AND published_at BETWEEN TIMESTAMP '1998-06-01' AND TIMESTAMP '1999-06-01'""",
)
def eligible_posts(spark, folder):
    start, end = SPEC.bounds
    return validate.eligible_posts(t.posts(spark, folder), start, end).select(
        "board_id", "post_id", "analysis_unit", "published_at"
    )


@query(
    "JOIN-1",
    f"""WITH {t.SNAPSHOTS}
SELECT board_id, post_id, views, recommendations, comments, slot FROM snapshots
WHERE slot <= TIMESTAMP '1999-06-01'
QUALIFY row_number() OVER (PARTITION BY board_id, post_id ORDER BY slot DESC) = 1""",
)
def as_of_counters(spark, folder):
    _, end = SPEC.bounds
    return ranking.as_of_counters(t.snapshots(spark, folder), end)


@query(
    "JOIN-2",
    f"""WITH {t.LATEST}
SELECT l.board_id, n_name AS board_name, l.post_id, l.analysis_unit, l.title, l.published_at,
       l.source_url, l.category, l.slot, s.observed_at, l.views, l.recommendations, l.comments,
       s.config_version
FROM latest l JOIN nation ON n_nationkey = l.board_id
JOIN snapshots s ON s.board_id = l.board_id AND s.post_id = l.post_id AND s.slot = l.slot""",
)
def latest_metrics(spark, folder):
    rows = ranking.latest_metrics(
        t.posts(spark, folder), t.snapshots(spark, folder), t.boards(spark, folder)
    )
    return rows.select(
        "board_id", "board_name", "post_id", "analysis_unit", "title", "published_at", "source_url",
        "category", "slot", "observed_at", "views", "recommendations", "comments", "config_version",
    )


@query(
    "JOIN-3",
    f"""WITH {t.POSTS},{t.QUARANTINE}
SELECT board_id, post_id, title FROM posts p WHERE NOT EXISTS (
  SELECT 1 FROM quarantine q WHERE q.source_kind = 'title'
    AND q.source_ref = 'post:' || p.board_id || ':' || p.post_id
    AND q.review_state IN ('pending', 'confirmed'))""",
)
def unquarantined_posts(spark, folder):
    rows = ranking.without_quarantined(t.posts(spark, folder), t.quarantine(spark, folder))
    return rows.select("board_id", "post_id", "title")


@query(
    "JOIN-9",
    f"""WITH {t.SNAPSHOTS}
SELECT board_id, post_id, slot, unnest(['views', 'recommendations', 'comments']) AS metric,
       unnest([views, recommendations, comments]) AS metric_value FROM snapshots""",
)
def long_metrics(spark, folder):
    return ranking.unpivot_metrics(t.snapshots(spark, folder), ("board_id", "post_id", "slot"))


@query(
    "JOIN-4 JOIN-5",
    f"""{STORED}
SELECT r.analysis_unit, r.metric, r.as_of_slot, r.rank, r.board_id, r.post_id, p.title,
       p.published_at, p.source_url, r.metric_value, r.config_version
FROM stored r JOIN posts p ON p.board_id = r.board_id AND p.post_id = r.post_id
WHERE r.rank <= 50 AND r.as_of_slot = (
  SELECT max(c.as_of_slot) FROM stored c
  WHERE c.analysis_unit = r.analysis_unit AND c.metric = r.metric)""",
)
def latest_ranking(spark, folder):
    newest = ranking.newest_ranking(_stored(spark, folder))
    shown = ranking.present_ranking(newest, t.posts(spark, folder))
    return shown.where(F.col("rank") <= ranking.READER_LIMIT).select(
        "analysis_unit", "metric", "as_of_slot", "rank", "board_id", "post_id", "title",
        "published_at", "source_url", "metric_value", "config_version",
    )


@query(
    "TOP-2 JOIN-4 JOIN-5",
    f"""{STORED}
SELECT r.rank, p.title, r.metric_value, p.published_at, p.source_url, r.as_of_slot,
       r.config_version
FROM stored r JOIN posts p ON p.board_id = r.board_id AND p.post_id = r.post_id
WHERE r.analysis_unit = 'building' AND r.metric = 'views' AND r.rank <= 50
  AND r.as_of_slot = (SELECT max(as_of_slot) FROM stored
                      WHERE analysis_unit = 'building' AND metric = 'views')
ORDER BY r.rank LIMIT 50""",
)
def reader_top(spark, folder):
    return ranking.read_top(_stored(spark, folder), t.posts(spark, folder), "building", "views")


@query("SET-1", f"{BASE},{LATE_CTE} SELECT DISTINCT board_id, post_id FROM top_late")
def ranked_union(spark, folder):
    return ranking.ranked_posts(_top(spark, folder))


TASK_KEY = "'detail:' || board_id || ':' || post_id || ':deep-v1'"


@query(
    "MRG-5",
    f"""{BASE},{LATE_CTE},{EARLY_CTE}
SELECT DISTINCT {TASK_KEY} AS task_key, 'detail_fetch' AS kind, 'pending' AS state,
       '{{"board_id":' || board_id || ',"post_id":' || post_id || '}}' AS payload,
       TIMESTAMP '1999-06-01' AS available_at
FROM top_late
WHERE {TASK_KEY} NOT IN (SELECT {TASK_KEY} FROM top_early)""",
)
def detail_tasks(spark, folder):
    _, end = SPEC.bounds
    _, before = EARLY.bounds
    none = spark.createDataFrame([], "task_key STRING")
    stored = merge.detail_tasks(
        _top(spark, folder, EARLY), none, F.lit(before).cast("timestamp_ntz")
    )
    return merge.detail_tasks(_top(spark, folder), stored, F.lit(end).cast("timestamp_ntz"))


@query("MRG-5 WIN-1", QUERIES["detail_tasks"].sql)
def refreshed_slot_tasks(spark, folder):
    """Two slots refreshed one after the other; the tasks that only the second one needs."""
    root, none = scratch_path(spark, "rankings"), spark.createDataFrame([], "task_key STRING")
    _, known = collection.refreshed_slot(_top(spark, folder, EARLY), root, EARLY, none)
    return collection.refreshed_slot(_top(spark, folder), root, SPEC, known)[1]

"""Queries over short-window growth and the derived measures."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from forumtide.operators import derived, lexicon, rising, standing, themes
from forumtide.operators.merge import POST_KEY
from forumtide.params import RisingSpec
from forumtide.plans import tables as t
from forumtide.plans.catalog import QUERIES, query
from forumtide.plans.ranking import STORED, _stored, SPEC
from forumtide.session import materialize

SPEC_RISING = RisingSpec(windows_hours=(24, 168, 720))
COHORT = ("board_id", "window_hours")
NOW = datetime(2001, 9, 1, tzinfo=timezone.utc)

_DELTAS = """
ends AS (SELECT board_id, post_id, max(slot) AS as_of_slot FROM series GROUP BY ALL),
targets AS (
  SELECT e.*, w.window_hours FROM ends e, (SELECT unnest([24, 168, 720]) AS window_hours) w),
starts AS (
  SELECT t.board_id, t.post_id, t.window_hours, s.slot, s.views, s.recommendations, s.comments
  FROM targets t JOIN series s ON s.board_id = t.board_id AND s.post_id = t.post_id
   AND s.slot BETWEEN t.as_of_slot - to_hours(t.window_hours) - INTERVAL 3 HOURS
                  AND t.as_of_slot - to_hours(t.window_hours) + INTERVAL 3 HOURS
  QUALIFY row_number() OVER (PARTITION BY t.board_id, t.post_id, t.window_hours
    ORDER BY abs(epoch_us(s.slot) - epoch_us(t.as_of_slot - to_hours(t.window_hours))), s.slot) = 1),
priors AS (
  SELECT t.board_id, t.post_id, t.window_hours, s.slot, s.views, s.recommendations, s.comments
  FROM targets t JOIN series s ON s.board_id = t.board_id AND s.post_id = t.post_id
   AND s.slot BETWEEN t.as_of_slot - to_hours(2 * t.window_hours) - INTERVAL 3 HOURS
                  AND t.as_of_slot - to_hours(2 * t.window_hours) + INTERVAL 3 HOURS
  QUALIFY row_number() OVER (PARTITION BY t.board_id, t.post_id, t.window_hours
    ORDER BY abs(epoch_us(s.slot) - epoch_us(t.as_of_slot - to_hours(2 * t.window_hours))), s.slot) = 1),
deltas AS (
  SELECT t.board_id, t.post_id, t.as_of_slot, t.window_hours,
         CASE WHEN s.slot IS NOT NULL AND p.slot IS NOT NULL THEN 'valid'
              ELSE 'insufficient_history' END AS sample_state,
         s.slot AS source_start_slot,
         greatest(e.recommendations - s.recommendations, 0) AS recommendations_delta,
         greatest(e.comments - s.comments, 0) AS comments_delta,
         greatest(e.views - s.views, 0) AS views_delta,
         greatest(s.recommendations - p.recommendations, 0) AS prior_recommendations_delta,
         greatest(s.comments - p.comments, 0) AS prior_comments_delta,
         greatest(s.views - p.views, 0) AS prior_views_delta,
         s.slot IS NULL AS no_start, p.slot IS NULL AS no_prior
  FROM targets t
  JOIN series e ON e.board_id = t.board_id AND e.post_id = t.post_id AND e.slot = t.as_of_slot
  LEFT JOIN starts s ON s.board_id = t.board_id AND s.post_id = t.post_id
    AND s.window_hours = t.window_hours
  LEFT JOIN priors p ON p.board_id = t.board_id AND p.post_id = t.post_id
    AND p.window_hours = t.window_hours)"""


@query(
    "RIS-1",
    f"""WITH {t.SERIES},{_DELTAS}
SELECT board_id, post_id, as_of_slot, window_hours, sample_state, source_start_slot,
       CASE WHEN NOT no_start THEN recommendations_delta END AS recommendations_delta,
       CASE WHEN NOT no_start THEN comments_delta END AS comments_delta,
       CASE WHEN NOT no_start THEN views_delta END AS views_delta,
       CASE WHEN NOT no_start AND NOT no_prior THEN prior_recommendations_delta END
         AS prior_recommendations_delta,
       CASE WHEN NOT no_start AND NOT no_prior THEN prior_comments_delta END AS prior_comments_delta,
       CASE WHEN NOT no_start AND NOT no_prior THEN prior_views_delta END AS prior_views_delta
FROM deltas""",
)
def post_deltas(spark, folder):
    return rising.post_deltas(t.counter_series(spark, folder), SPEC_RISING)


def _pct(value: str, partition: str) -> str:
    n = f"count(*) OVER (PARTITION BY {partition})"
    return (
        f"(rank() OVER (PARTITION BY {partition} ORDER BY {value}) - 1 + "
        f"(count(*) OVER (PARTITION BY {partition}, {value}) + 1) / CAST(2 AS DOUBLE)) / {n}"
    )


_W = SPEC_RISING.weights
_PARTS = ("recommendations", "comments", "views")
_SCORES = f"""
percentiles AS (
  SELECT board_id, post_id, window_hours,
         {', '.join(f"{_pct(f'{p}{m}_delta', 'board_id, window_hours')} AS {p}{m}"
                    for p in ('', 'prior_') for m in _PARTS)}
  FROM deltas WHERE sample_state = 'valid'),
paced AS (
  SELECT *,
    {' + '.join(f"CAST({_W[m]!r} AS DOUBLE) * {m}" for m in _PARTS)} AS engagement_intensity,
    {' + '.join(f"CAST({_W[m]!r} AS DOUBLE) * prior_{m}" for m in _PARTS)}
      AS prior_engagement_intensity
  FROM percentiles),
accelerated AS (
  SELECT *, greatest(engagement_intensity - prior_engagement_intensity, CAST(0 AS DOUBLE))
    AS acceleration FROM paced),
ranked AS (
  SELECT *, {_pct('acceleration', 'board_id, window_hours')} AS acceleration_percentile
  FROM accelerated),
scored AS (
  SELECT *, CAST({1 - SPEC_RISING.acceleration_weight!r} AS DOUBLE) * engagement_intensity
    + CAST({SPEC_RISING.acceleration_weight!r} AS DOUBLE) * acceleration_percentile AS rising_score
  FROM ranked)"""


def _scored(spark, folder):
    deltas = rising.post_deltas(t.counter_series(spark, folder), SPEC_RISING)
    return rising.rising_scores(deltas, SPEC_RISING, COHORT)


@query(
    "RIS-2",
    f"""WITH {t.SERIES},{_DELTAS},{_SCORES}
SELECT board_id, post_id, window_hours, recommendations AS recommendations_percentile,
       comments AS comments_percentile, views AS views_percentile,
       round(engagement_intensity, 9) AS engagement_intensity,
       round(acceleration, 9) AS acceleration, round(rising_score, 9) AS rising_score FROM scored""",
)
def rising_scores(spark, folder):
    rows = _scored(spark, folder)
    return rows.select(
        *POST_KEY, "window_hours", "recommendations_percentile", "comments_percentile",
        "views_percentile",
        *[F.round(c, 9).alias(c) for c in ("engagement_intensity", "acceleration", "rising_score")],
    )


@query(
    "RIS-3",
    f"""WITH {t.SERIES},{_DELTAS},{_SCORES},
p90 AS (SELECT window_hours, quantile_cont(rising_score, 0.9) AS p90 FROM scored GROUP BY window_hours),
tops AS (
  SELECT window_hours, board_id, avg(rising_score) AS top_mean FROM (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY window_hours, board_id
      ORDER BY rising_score DESC, board_id DESC, post_id DESC) <= 5) GROUP BY ALL),
shares AS (
  SELECT s.window_hours, s.board_id, avg(CAST(rising_score >= p90 AS DOUBLE)) AS p90_share,
         count(*) AS contributing_count
  FROM scored s JOIN p90 USING (window_hours) GROUP BY ALL)
SELECT window_hours, board_id, round(top_mean, 9) AS top_mean, round(p90_share, 9) AS p90_share,
       round(CAST(0.7 AS DOUBLE) * top_mean + CAST({1 - 0.7!r} AS DOUBLE) * p90_share, 9)
         AS rising_score,
       contributing_count,
       CASE WHEN contributing_count >= 3 THEN 'valid' ELSE 'low_sample' END AS sample_state
FROM tops JOIN shares USING (window_hours, board_id)""",
)
def category_scores(spark, folder):
    rows = rising.category_scores(_scored(spark, folder), "board_id", SPEC_RISING)
    return rows.select(
        "window_hours", "board_id",
        *[F.round(c, 9).alias(c) for c in ("top_mean", "p90_share", "rising_score")],
        "contributing_count", "sample_state",
    )


@query(
    "DAY-1",
    f"""WITH {t.SERIES},
days AS (
  SELECT board_id, post_id, strftime(slot + INTERVAL 9 HOURS, '%Y-%m-%d') AS day,
         arg_max(views, slot) AS closing_views, arg_min(views, slot) AS open_views,
         arg_max(recommendations, slot) AS closing_recommendations,
         arg_min(recommendations, slot) AS open_recommendations,
         arg_max(comments, slot) AS closing_comments, arg_min(comments, slot) AS open_comments
  FROM series GROUP BY ALL)
SELECT board_id, post_id, day, closing_recommendations, closing_comments, closing_views,
  greatest(closing_recommendations - coalesce(lag(closing_recommendations) OVER w, open_recommendations), 0)
    AS recommendations_delta,
  greatest(closing_comments - coalesce(lag(closing_comments) OVER w, open_comments), 0) AS comments_delta,
  greatest(closing_views - coalesce(lag(closing_views) OVER w, open_views), 0) AS views_delta
FROM days WINDOW w AS (PARTITION BY board_id, post_id ORDER BY day)""",
)
def daily_close(spark, folder):
    rows = rising.daily_close(t.counter_series(spark, folder))
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


def _opinion_items(spark, folder):
    """Every turn as an opinion item on the day its conversation number names."""
    turns = t.load(spark, folder, "conversations").select(
        "conv_id", "turn", F.col("role").alias("analysis_unit"), "text"
    )
    labelled = lexicon.label_sentiment(
        lexicon.label_context(turns, F.col("text"), t.SAMPLE_LEXICON), "text", t.SAMPLE_LEXICON
    )
    at = F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.col("conv_id").cast("int")
    )
    return labelled.select(
        "analysis_unit", "topic", at.alias("published_at"),
        F.when(F.col("turn") < 6, F.col("sentiment")).alias("sentiment"),
        F.col("text").contains("@").alias("quarantined"),
    )


_T = t.sql_fold("text")


@query(
    "DAY-2",
    f"""WITH items AS (
  SELECT role AS analysis_unit, {t.sql_strongest('n', t.SAMPLE_LEXICON.topics, 'community')} AS topic,
         TIMESTAMP '2024-01-01' + to_hours(conv_id) AS published_at,
         CASE WHEN turn < 6 THEN {t.sql_sentiment('n')} END AS sentiment,
         contains(text, '@') AS quarantined
  FROM (SELECT *, {_T} AS n FROM conversations))
SELECT analysis_unit, topic, strftime(published_at + INTERVAL 9 HOURS, '%Y-%m-%d') AS day,
       count(*) FILTER (NOT quarantined AND sentiment = 'positive') AS positive,
       count(*) FILTER (NOT quarantined AND sentiment IN ('neutral', 'mixed')) AS neutral,
       count(*) FILTER (NOT quarantined AND sentiment = 'negative') AS negative,
       count(*) FILTER (NOT quarantined) AS eligible,
       count(*) FILTER (NOT quarantined AND sentiment IS NOT NULL) AS analysed,
       count(*) FILTER (quarantined) AS excluded,
       max(published_at) FILTER (NOT quarantined AND sentiment IS NOT NULL) AS fresh_through
FROM items GROUP BY ALL""",
)
def opinion_daily(spark, folder):
    rows = rising.opinion_daily(_opinion_items(spark, folder))
    return rows.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query(
    "DRV-1",
    f"""WITH {t.LATEST},
medians AS (SELECT analysis_unit, quantile_cont(views::DOUBLE, 0.5) AS m FROM latest GROUP BY ALL)
SELECT board_id, post_id, l.analysis_unit, views,
       views / greatest(date_diff('second', published_at, slot) / CAST(86400 AS DOUBLE), 1)
         AS views_per_day,
       CASE WHEN views > 0 THEN comments * 1000 / views ELSE 0 END AS comments_per_1000_views,
       CASE WHEN views > 0 THEN recommendations * 1000 / views ELSE 0 END
         AS recommendations_per_1000_views,
       m AS unit_median_views, views / m AS views_to_unit_median
FROM latest l JOIN medians USING (analysis_unit)""",
)
def derived_measures(spark, folder):
    return derived.derived_measures(t.stored_latest(spark, folder))


@query(
    "DRV-1",
    f"""{STORED}
SELECT board_id, post_id, metric,
       count(DISTINCT strftime(as_of_slot + INTERVAL 9 HOURS, '%Y-%m-%d')) AS days_in_top
FROM stored GROUP BY ALL""",
)
def days_in_top(spark, folder):
    return derived.days_in_top(_stored(spark, folder))


@query("DRV-1 AGG-10", QUERIES["days_in_top"].sql)
def kept_days_in_top(spark, folder):
    """The same from bitmaps: one stored per slot, later merged without reading rankings."""
    ranked = _stored(spark, folder)
    early = F.col("as_of_slot") < F.lit(SPEC.bounds[1]).cast("timestamp_ntz")
    slots = [
        materialize(standing.top_days(ranked.where(part)), "top-days") for part in (early, ~early)
    ]
    return standing.count_days(standing.merged_days(*slots))


@query(
    "DRV-1",
    f"""WITH {t.THREADS},{t.LABELS},
s AS (SELECT board_id, post_id, avg(CASE sentiment WHEN 'positive' THEN 1.0::DOUBLE
        WHEN 'negative' THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END) AS comment_score
      FROM comment_labels GROUP BY ALL),
b AS (SELECT board_id, post_id, CASE body_sentiment WHEN 'positive' THEN 1.0::DOUBLE
        WHEN 'negative' THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END AS body_score FROM labelled)
SELECT board_id, post_id, body_score, comment_score, body_score - comment_score AS gap
FROM b JOIN s USING (board_id, post_id)""",
)
def sentiment_gap(spark, folder):
    posts, comments = t.threads(spark, folder)
    labelled = lexicon.label_sentiment(posts, "body", t.SAMPLE_LEXICON).withColumnRenamed(
        "sentiment", "body_sentiment"
    )
    return derived.sentiment_gap(
        labelled, lexicon.label_sentiment(comments, "text", t.SAMPLE_LEXICON), POST_KEY
    )


@query(
    "DRV-2",
    f"""WITH {t.THREADS},
sizes AS (SELECT board_id, post_id, count(*) AS n, CAST(sum(length(text)) AS BIGINT) AS c
          FROM thread_comments GROUP BY ALL)
SELECT t.board_id, t.post_id, length(body) AS body_chars, coalesce(n, 0) AS n_comments,
       coalesce(c, 0) AS comment_chars,
       length(body) <= 50 OR (coalesce(n, 0) >= 3 AND
         coalesce(c, 0) >= CAST(0.8 AS DOUBLE) * (length(body) + coalesce(c, 0))) AS comment_led,
       'v1' AS rule_version
FROM threads t LEFT JOIN sizes s ON s.board_id = t.board_id AND s.post_id = t.post_id""",
)
def comment_led(spark, folder):
    posts, comments = t.threads(spark, folder)
    return derived.comment_led(posts, comments, POST_KEY)


def _stored_items(spark, folder):
    orders = t.load(spark, folder, "orders")
    return orders.select(
        F.col("o_orderkey").alias("item_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "raw").otherwise("text").alias("kind"),
        F.col("o_orderdate").alias("stored_at"), (F.col("o_orderstatus") == "F").alias("processed"),
    )


_ITEMS = """
items AS (
  SELECT o_orderkey AS item_id,
         CASE WHEN o_orderpriority = '1-URGENT' THEN 'raw' ELSE 'text' END AS kind,
         o_orderdate AS stored_at, o_orderstatus = 'F' AS processed,
         TIMESTAMP '2001-09-01' AS now FROM orders),
plan AS (
  SELECT item_id, kind, stored_at, processed,
    CASE WHEN kind = 'raw' AND stored_at < now - INTERVAL 30 DAYS THEN 'delete_raw'
         WHEN kind = 'raw' THEN 'keep'
         WHEN stored_at < now - INTERVAL 90 DAYS AND processed THEN 'delete_text'
         WHEN stored_at < now - INTERVAL 90 DAYS THEN 'expire_unprocessed'
         WHEN NOT processed AND stored_at < now - INTERVAL 85 DAYS THEN 'warn_85'
         WHEN NOT processed AND stored_at < now - INTERVAL 75 DAYS THEN 'warn_75'
         WHEN NOT processed AND stored_at < now - INTERVAL 60 DAYS THEN 'warn_60'
         ELSE 'keep' END AS action FROM items)"""


@query("RET-1", f"WITH {_ITEMS} SELECT * FROM plan")
def retention_plan(spark, folder):
    return derived.retention_plan(_stored_items(spark, folder), NOW)


@query(
    "RET-1",
    f"""WITH {_ITEMS}
SELECT kind, action, count(*) AS items, min(stored_at) AS oldest FROM plan GROUP BY kind, action""",
)
def retention_summary(spark, folder):
    return derived.retention_summary(derived.retention_plan(_stored_items(spark, folder), NOW))


@query(
    "REV-1",
    f"""WITH n AS (SELECT doc_id, text, n_chars, sha256(text) AS content_hash, {_T} AS n FROM documents),
c AS (SELECT *, {t.sql_confidence('n')} AS confidence,
             greatest(1, (strlen(text) + 2) // 3) AS tokens FROM n
      WHERE content_hash NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src1')),
once AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY content_hash
           ORDER BY confidence, n_chars DESC, doc_id) = 1),
head AS (SELECT * FROM once ORDER BY confidence, n_chars DESC, doc_id LIMIT 40),
run AS (SELECT *, CAST(row_number() OVER (ORDER BY confidence, n_chars DESC, doc_id) AS INTEGER) AS position,
               CAST(sum(tokens) OVER (ORDER BY confidence, n_chars DESC, doc_id
                 ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tokens_used FROM head)
SELECT doc_id AS record_id, content_hash, confidence, n_chars AS engagement, tokens, position,
       tokens_used
FROM run WHERE tokens_used <= 20000""",
)
def review_batch(spark, folder):
    docs = t.load(spark, folder, "documents").withColumn("content_hash", F.sha2("text", 256))
    labelled = lexicon.label_sentiment(docs, "text", t.SAMPLE_LEXICON)
    candidates = labelled.select(
        F.col("doc_id").alias("record_id"), "content_hash", "text", "confidence",
        F.col("n_chars").alias("engagement"),
    )
    analysed = docs.where(F.col("source") == "src1")
    return derived.review_batch(candidates, analysed, 40, 20_000)


@query(
    "REC-1",
    f"""{STORED},{t.SERIES},{t.RUNS},
gaps AS (
  SELECT board_id, post_id, date_diff('hour', lag(slot) OVER (PARTITION BY board_id, post_id
           ORDER BY slot), slot) AS hours FROM series)
SELECT 'duplicate_post' AS "check", board_id || ':' || post_id AS key, '2' AS detail
FROM posts WHERE post_id IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
UNION ALL
SELECT 'metric_gap' AS "check", board_id || ':' || post_id AS key, CAST(max(hours) AS VARCHAR) AS detail
FROM gaps WHERE hours > 6 GROUP BY board_id, post_id
UNION ALL
SELECT 'stuck_run', id, job_type FROM runs
WHERE status = 'partial' AND started_at < TIMESTAMP '2024-01-20' - INTERVAL 6 HOURS
UNION ALL
SELECT DISTINCT 'missing_task', board_id || ':' || post_id,
       'detail:' || board_id || ':' || post_id || ':deep-v1' FROM top_late
WHERE board_id || ':' || post_id NOT IN (SELECT board_id || ':' || post_id FROM top_early)""",
)
def reconciliation(spark, folder):
    """Audits with partial runs taken as still running and pending orders imported twice."""
    from forumtide.operators import merge

    none = spark.createDataFrame([], "task_key STRING")
    ranked = _stored(spark, folder)
    late = F.col("as_of_slot") == F.lit(SPEC.bounds[1]).cast("timestamp_ntz")
    tasks = merge.detail_tasks(ranked.where(~late), none, F.lit(NOW.replace(tzinfo=None)))
    posts, orders = t.posts(spark, folder), t.load(spark, folder, "orders")
    pending = orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("post_id"))
    runs = t.runs(spark, folder).withColumn(
        "status", F.when(F.col("status") == "partial", "running").otherwise(F.col("status"))
    )
    return derived.reconciliation(
        posts.unionByName(posts.join(pending, "post_id", "left_semi").select(*posts.columns)),
        t.counter_series(spark, folder), runs, ranked.where(late), tasks, datetime(2024, 1, 20, tzinfo=timezone.utc),
    )


@query(
    "REC-1",
    f"""WITH {t.LATEST},
held AS (SELECT l_orderkey AS post_id, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT 'comment_count' AS "check", board_id || ':' || l.post_id AS key,
       coalesce(n, 0) || '/' || comments AS detail
FROM latest l LEFT JOIN held h ON h.post_id = l.post_id WHERE coalesce(n, 0) <> comments""",
)
def comment_mismatch(spark, folder):
    rows = t.observations(spark, folder).select(*POST_KEY)
    return derived.comment_mismatch(t.latest(spark, folder), rows)


# The clustering in SQL.
_THEMES = 6
_GRAMS = f"""
texts AS (
  SELECT conv_id || ':' || turn AS id, {t.sql_fold('text')} AS normal FROM conversations),
grams AS (
  SELECT id, gram, count(*) AS n FROM (
    SELECT id, unnest(list_transform(range(1, length(normal) - 1), lambda i: substr(normal, i, 3)))
      AS gram FROM texts WHERE length(normal) > 2)
  GROUP BY ALL),
frequencies AS (SELECT gram, count(*) AS texts FROM grams GROUP BY gram),
raw AS (
  SELECT id, gram, n * ln((SELECT count(DISTINCT id) + 1.0::DOUBLE FROM texts) / (f.texts + 1)) AS w
  FROM grams JOIN frequencies f USING (gram)),
weights AS MATERIALIZED (
  SELECT id, gram, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM raw WHERE w > 0),
seeds AS (
  SELECT id, row_number() OVER (ORDER BY md5(id), id) - 1 AS theme
  FROM (SELECT DISTINCT id FROM texts) QUALIFY theme < {_THEMES})"""


# Centres by the texts of the least ids, and the nearest of them for each text.
_FIRST_THEMES = """,
centre0 AS MATERIALIZED (SELECT theme, gram, w FROM weights JOIN seeds USING (id)),
assigned0 AS MATERIALIZED (
  SELECT id, CAST(coalesce(theme, 0) AS INTEGER) AS theme
  FROM (SELECT DISTINCT id FROM texts) LEFT JOIN (
    SELECT v.id, c.theme FROM weights v JOIN centre0 c USING (gram) GROUP BY v.id, c.theme
    QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY round(sum(v.w * c.w), 9) DESC, c.theme) = 1)
  USING (id))"""
# Rounds have rows of texts (id) and of centres (gram); there is none after one without moves.
_ROUNDS = """,
rounds AS (
  SELECT 0 AS place, id, theme, NULL::VARCHAR AS gram, NULL::DOUBLE AS w, true AS moves FROM assigned0
  UNION ALL
  SELECT 0, NULL, CAST(theme AS INTEGER), gram, w, true FROM centre0
  UNION ALL (
  WITH before AS (SELECT id, theme FROM rounds WHERE gram IS NULL),
  held AS (SELECT theme, gram, sum(w) AS w FROM weights JOIN before USING (id) GROUP BY ALL),
  centre AS (
    SELECT theme, gram, w / sqrt(sum(w * w) OVER (PARTITION BY theme)) AS w FROM held
    UNION ALL
    SELECT theme, gram, w FROM rounds
    WHERE gram IS NOT NULL AND theme NOT IN (SELECT theme FROM held)),
  nearest AS (
    SELECT v.id, c.theme FROM weights v JOIN centre c USING (gram) GROUP BY v.id, c.theme
    QUALIFY row_number() OVER (PARTITION BY v.id ORDER BY round(sum(v.w * c.w), 9) DESC, c.theme) = 1),
  after AS (
    SELECT id, b.theme AS before, coalesce(n.theme, 0) AS theme
    FROM before b LEFT JOIN nearest n USING (id)),
  found AS (
    SELECT id, theme, NULL::VARCHAR AS gram, NULL::DOUBLE AS w FROM after
    UNION ALL SELECT NULL, theme, gram, w FROM centre)
  SELECT (SELECT max(place) + 1 FROM rounds), id, theme, gram, w,
         EXISTS (SELECT 1 FROM after WHERE theme <> before)
  FROM found WHERE (SELECT bool_or(moves) FROM rounds)))"""


def _safe_turns(spark, folder):
    """Conversation turns that pass screening; the supplied ones all do."""
    from forumtide.operators import screening

    turns = t.load(spark, folder, "conversations")
    safe = screening.scan(turns, "text").where(F.col("risk_score") < screening.THRESHOLD)
    return safe.select(
        F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        "text",
    )


@query("CLU-1", f"WITH {_GRAMS} SELECT gram, texts FROM frequencies")
def theme_grams(spark, folder):
    """Exact document frequencies of the grams behind the themes."""
    counts = themes.gram_counts(_safe_turns(spark, folder))
    return themes.gram_frequencies(counts).select("gram", "texts")


@query("CLU-1", f"WITH {_GRAMS}{_FIRST_THEMES} SELECT id, theme FROM assigned0")
def theme_first_assignment(spark, folder):
    """Themes before any centre has moved."""
    assigned = themes.first_assignments(_safe_turns(spark, folder), k=_THEMES)
    return assigned.select("id", "theme")


@query(
    "CLU-1",
    f"""WITH RECURSIVE {_GRAMS}{_FIRST_THEMES}{_ROUNDS}
SELECT theme, count(*) AS size, list(id ORDER BY id)[1:3] AS representatives
FROM rounds WHERE gram IS NULL AND place = (SELECT max(place) FROM rounds) GROUP BY theme""",
)
def theme_clusters(spark, folder):
    """Themes of the conversation turns that pass screening."""
    return themes.theme_summary(themes.theme_assignments(_safe_turns(spark, folder), k=_THEMES))

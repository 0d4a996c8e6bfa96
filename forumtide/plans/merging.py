"""Queries over merges, validation and page admission."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from forumtide.operators import admission, collection, merge, metrics, screening, validate
from forumtide.operators.merge import POST_KEY
from forumtide.params import AdmissionSpec
from forumtide.plans import tables as t
from forumtide.plans.catalog import QUERIES, query
from forumtide.registry import ScanRule
from forumtide.schemas import QUARANTINE, SNAPSHOT
from forumtide.session import materialize, scratch_path
from forumtide.streaming import ingest

HALF = datetime(1999, 1, 1)
ADMIT = AdmissionSpec(min_pages=2, overlap_pages=1)
CUTOFF = datetime(1995, 3, 1)
BUDGET = 15

_ORDER = (
    "published_at DESC, title DESC, analysis_unit DESC, category DESC, source_url DESC, "
    "is_notice DESC, is_ad DESC"
)
_COLLAPSED = """
collapsed AS (
  SELECT b.board_id, b.post_id, b.slot, b.title, b.analysis_unit, b.category, b.published_at,
         b.source_url, b.is_notice, b.is_ad, g.views, g.recommendations, g.comments, g.copies
  FROM (SELECT * FROM observations
        QUALIFY row_number() OVER (PARTITION BY board_id, post_id, slot ORDER BY """ + _ORDER + """) = 1) b
  JOIN (SELECT board_id, post_id, slot, max(views) AS views, max(recommendations)
               AS recommendations, max(comments) AS comments, count(*) AS copies
        FROM observations GROUP BY ALL) g
    ON b.board_id = g.board_id AND b.post_id = g.post_id AND b.slot = g.slot
)"""


@query("MRG-1", f"WITH {t.OBSERVATIONS},{_COLLAPSED} SELECT * FROM collapsed")
def collapsed_observations(spark, folder):
    rows = merge.collapse_observations(t.observations(spark, folder), merge.SNAPSHOT_KEY)
    return rows.select(
        "board_id", "post_id", "slot", "title", "analysis_unit", "category", "published_at",
        "source_url", "is_notice", "is_ad", "views", "recommendations", "comments", "copies",
    )


@query(
    "MRG-2",
    f"""WITH {t.OBSERVATIONS}
SELECT board_id, post_id, observed_at AS last_seen_at, published_at, title, analysis_unit,
       category, source_url, is_notice, is_ad
FROM observations
QUALIFY row_number() OVER (PARTITION BY board_id, post_id
                           ORDER BY observed_at DESC, {_ORDER}) = 1""",
)
def canonical_posts(spark, folder):
    """Later half of the sightings merged into the earlier half."""
    seen = t.observations(spark, folder).withColumn("last_seen_at", F.col("observed_at"))
    earlier = merge.upsert_posts(seen.where(F.col("slot") < F.lit(HALF)))
    return merge.upsert_posts(earlier, seen.where(F.col("slot") >= F.lit(HALF)))


_GROUPED = """
grouped AS (
  SELECT board_id, post_id, slot, max(observed_at) AS observed_at, max(views) AS views,
         max(recommendations) AS recommendations, max(comments) AS comments,
         min(config_version) AS config_version, max(config_version) AS other_version
  FROM observations GROUP BY board_id, post_id, slot
)"""


def _merged(spark, folder):
    columns = (*merge.SNAPSHOT_KEY, "observed_at", *merge.COUNTERS, "config_version")
    return merge.merge_snapshots(t.observations(spark, folder).select(*columns))


@query(
    "MRG-3",
    f"""WITH {t.OBSERVATIONS},{_GROUPED}
SELECT board_id, post_id, slot, observed_at, views, recommendations, comments, config_version
FROM grouped WHERE config_version = other_version""",
)
def merged_snapshots(spark, folder):
    return _merged(spark, folder)[0]


@query(
    "MRG-3",
    f"""WITH {t.OBSERVATIONS},{_GROUPED}
SELECT board_id, post_id, slot, config_version, other_version
FROM grouped WHERE config_version <> other_version""",
)
def snapshot_conflicts(spark, folder):
    return _merged(spark, folder)[1]


@query(
    "MRG-4",
    """SELECT n_nationkey AS id, n_name AS name FROM nation
UNION ALL
SELECT DISTINCT s_nationkey + 1000 AS id, 'Supplier ' || s_nationkey AS name FROM supplier""",
)
def board_dimension(spark, folder):
    """Boards of the suppliers inserted beside the known boards; known ids stay as they are."""
    nation = t.boards(spark, folder)
    fresh = t.load(spark, folder, "supplier").select(
        (F.col("s_nationkey") + 1000).alias("id"),
        F.concat(F.lit("Supplier "), F.col("s_nationkey").cast("string")).alias("name"),
    ).distinct()
    renamed = nation.select("id", F.lower("name").alias("name"))
    return merge.insert_absent(nation, fresh.unionByName(renamed), ("id",))


# --- validation ---------------------------------------------------------------------------------


def _incoming(spark, folder, orders=None):
    """Observations with the faults real orders and customers happen to show."""
    customers = t.load(spark, folder, "customer")
    if orders is None:
        orders = t.load(spark, folder, "orders")
    board, post = F.col("c_nationkey").cast("int"), F.col("o_orderkey")
    url = t.SITE.article_url(board, post)
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        board.alias("board_id"), post.alias("post_id"), F.lower("c_mktsegment").alias("analysis_unit"),
        F.col("c_mktsegment").alias("category"),
        F.when(priority == "3-MEDIUM", F.concat(priority, F.lit(" "))).otherwise(priority).alias("title"),
        F.col("o_orderdate").alias("published_at"),
        F.floor("c_acctbal").cast("bigint").alias("views"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("recommendations"),
        F.floor(F.col("c_acctbal") * 1000).cast("bigint").alias("comments"),
        F.when(status == "O", F.concat(url, F.lit("/"))).otherwise(url).alias("source_url"),
        (priority == "1-URGENT").alias("is_notice"), (status == "F").alias("is_ad"),
    )


def _unit_map(spark, folder):
    """Board 0 is fixed, board 3 maps nothing, and the rest map every segment but one."""
    pairs = t.load(spark, folder, "customer").select(
        F.col("c_nationkey").cast("int").alias("board_id"), F.col("c_mktsegment").alias("category")
    ).distinct()
    named = pairs.where(
        (F.col("board_id") != 3) & (F.col("board_id") != 0) & (F.col("category") != "MACHINERY")
    ).withColumn("unit", F.lower("category"))
    fixed = pairs.where(F.col("board_id") == 0).select(
        "board_id", F.lit(None).cast("string").alias("category"), F.lit("building").alias("unit")
    ).distinct()
    return named.unionByName(fixed)


_UNIT = """CASE WHEN c_nationkey = 0 THEN 'building'
            WHEN c_nationkey = 3 OR c_mktsegment = 'MACHINERY' THEN NULL
            ELSE lower(c_mktsegment) END"""
_FAULTS = f"""
faults AS (
  SELECT CAST(c_nationkey AS INTEGER) AS board_id, o_orderkey AS post_id,
    [CASE WHEN c_nationkey = 3 THEN 'board' END,
     CASE WHEN o_orderkey < 1 THEN 'post_id' END,
     CASE WHEN ({_UNIT}) IS NULL OR ({_UNIT}) <> lower(c_mktsegment) THEN 'unit' END,
     CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'title' END,
     CASE WHEN floor(c_acctbal) < 0 THEN 'views' END,
     CASE WHEN floor(c_acctbal * 1000) < 0 OR floor(c_acctbal * 1000) > 2147483647
          THEN 'comments' END,
     CASE WHEN o_orderstatus = 'O' THEN 'url' END,
     CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus = 'F' THEN 'kind' END] AS rules
  FROM orders JOIN customer ON o_custkey = c_custkey
),
checked AS (
  SELECT board_id, post_id, array_to_string(list_filter(rules, lambda x: x IS NOT NULL), ',')
           AS failed
  FROM faults
)"""


def _checked(spark, folder):
    return validate.failed_rules(_incoming(spark, folder), _unit_map(spark, folder), t.SITE)


@query("FLT-1", f"WITH {_FAULTS} SELECT board_id, post_id, failed FROM checked")
def observation_faults(spark, folder):
    return _checked(spark, folder).select(
        "board_id", "post_id", F.array_join("failed", ",").alias("failed")
    )


@query(
    "FLT-2",
    f"""SELECT CAST(c_nationkey AS INTEGER) AS board_id, c_custkey, {_UNIT} AS unit
FROM customer WHERE ({_UNIT}) IS NOT NULL""",
)
def mapped_units(spark, folder):
    rows = t.load(spark, folder, "customer").select(
        F.col("c_nationkey").cast("int").alias("board_id"), "c_custkey",
        F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("\t")).alias("category"),
    )
    mapped = validate.map_units(rows, _unit_map(spark, folder), "unit")
    return mapped.where(F.col("unit").isNotNull()).select("board_id", "c_custkey", "unit")


@query(
    "FLT-7",
    f"""WITH {t.OBSERVATIONS}
SELECT board_id, slot, count(*) AS n FROM observations GROUP BY ALL HAVING count(*) > 3""",
)
def oversized_batches(spark, folder):
    return validate.oversized_batches(t.observations(spark, folder), ("board_id", "slot"), 3)


@query(
    "FLT-8",
    """WITH kinds AS (
  SELECT o_orderkey AS post_id, o_orderstatus IN ('F', 'P') AS is_notice,
         (o_orderpriority = '5-LOW' OR o_orderstatus = 'P') AS is_ad FROM orders)
SELECT post_id, is_notice, is_ad, is_notice AND is_ad AS ambiguous FROM kinds""",
)
def row_kinds(spark, folder):
    """Kinds from class lists and label texts built from order attributes."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    classes = F.array(
        F.when(status == "F", "Notice-Row").otherwise("row"),
        F.when(priority == "5-LOW", "AD").otherwise("plain"),
        F.when(status == "P", "advertisement").otherwise("plain"),
    )
    label = F.when(status == "P", "공지").otherwise("")
    kind = validate.row_kind(classes, label)
    rows = t.load(spark, folder, "orders").select(F.col("o_orderkey").alias("post_id"), kind.alias("k"))
    return rows.select("post_id", "k.is_notice", "k.is_ad", "k.ambiguous")


@query(
    "FLT-9",
    """SELECT event_id, CASE event_type WHEN 'view' THEN '조회' WHEN 'purchase' THEN '추천'
         ELSE event_type END AS event_type,
       CASE WHEN value > 100 THEN props ELSE '직접 표현 없음' END AS evidence FROM events""",
)
def display_labels(spark, folder):
    rows = t.load(spark, folder, "events").select(
        "event_id", "event_type", F.when(F.col("value") > 100, F.col("props")).alias("evidence")
    )
    shown = validate.label_codes(rows, "event_type", {"view": "조회", "purchase": "추천"})
    return validate.fill_blank(shown, "evidence", "직접 표현 없음")


_URGENT = (ScanRule("title.urgent", 70, r"1-urgent", ("1-urgent",)),)


@query(
    "MRG-6",
    f"""WITH {_FAULTS},
per_post AS (
  SELECT c.board_id, c.post_id, count(*) FILTER (failed = '') AS good,
         count(*) FILTER (failed <> '') AS bad
  FROM checked c GROUP BY ALL),
known AS (SELECT o_orderkey AS post_id FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'),
flagged AS (
  SELECT board_id, count(*) AS quarantined FROM (
    SELECT DISTINCT CAST(c_nationkey AS INTEGER) AS board_id, o_orderkey, o_orderpriority
    FROM orders JOIN customer ON o_custkey = c_custkey
    JOIN checked k ON k.post_id = o_orderkey
    WHERE o_orderpriority = '1-URGENT' AND k.failed = '') GROUP BY board_id)
SELECT p.board_id,
       CAST(count(*) FILTER (good > 0 AND k.post_id IS NULL) AS BIGINT) AS inserted,
       CAST(count(*) FILTER (good > 0 AND k.post_id IS NOT NULL) AS BIGINT) AS updated,
       CAST(coalesce(any_value(f.quarantined), 0) AS BIGINT) AS quarantined,
       CAST(sum(bad + greatest(good - 1, 0)) AS BIGINT) AS rejected
FROM per_post p LEFT JOIN known k ON k.post_id = p.post_id
LEFT JOIN flagged f ON f.board_id = p.board_id
GROUP BY p.board_id""",
)
def batch_summary(spark, folder):
    checked = materialize(_checked(spark, folder), "checked")
    known = t.posts(spark, folder).where(F.col("published_at") < F.lit(datetime(1998, 1, 1)))
    titles = validate.split_valid(checked)[0].select("board_id", "post_id", "title").distinct()
    flagged = screening.scan(titles, "title", _URGENT).where(
        F.col("risk_score") >= screening.THRESHOLD
    )
    return merge.batch_summary(checked, known, flagged)


_FETCHED = datetime(2024, 1, 20, tzinfo=timezone.utc)


def _collected(spark, folder):
    incoming = _incoming(spark, folder).withColumns({
        "slot": F.lit(datetime(2024, 1, 20)).cast("timestamp_ntz"),
        "config_version": F.lit(t.VERSION),
    })
    stored = t.posts(spark, folder).where(F.col("published_at") < F.lit(datetime(1998, 1, 1)))
    return collection.collect_batch(
        incoming, _unit_map(spark, folder), t.SITE,
        stored.withColumn("last_seen_at", F.col("published_at")),
        spark.createDataFrame([], SNAPSHOT), spark.createDataFrame([], QUARANTINE), _FETCHED,
        _URGENT,
    )


@query("MRG-6 FLT-1 TXT-2", QUERIES["batch_summary"].sql)
def collected_summary(spark, folder):
    """A batch validated, collapsed, screened and merged: what it did per board."""
    return _collected(spark, folder).summary


@query(
    "MRG-2 MRG-3 FLT-1",
    f"""WITH {_FAULTS},{t.POSTS}
SELECT CAST(c_nationkey AS INTEGER) AS board_id, o_orderkey AS post_id,
       o_orderpriority AS title, CAST(floor(c_acctbal) AS BIGINT) AS views, true AS observed
FROM orders JOIN customer ON o_custkey = c_custkey JOIN checked k ON k.post_id = o_orderkey
WHERE k.failed = ''
UNION ALL
SELECT board_id, post_id, title, NULL, false FROM posts
WHERE published_at < TIMESTAMP '1998-01-01'
  AND post_id NOT IN (SELECT post_id FROM checked WHERE failed = '')""",
)
def collected_tables(spark, folder):
    """Posts after a collected batch, with the counters of the batch's snapshots."""
    done = _collected(spark, folder)
    shots = done.snapshots.select(*POST_KEY, "views", F.lit(True).alias("observed"))
    return done.posts.select(*POST_KEY, "title").join(shots, list(POST_KEY), "left").select(
        *POST_KEY, "title", "views", F.coalesce("observed", F.lit(False)).alias("observed")
    )


def _ingested(spark, folder):
    """Orders as a stream of observations, with their faults and their hostile titles."""
    orders = (
        spark.readStream.schema(t.SCHEMAS["orders"]).option("pathGlobFilter", "orders.parquet")
        .parquet(folder)
    )
    incoming = _incoming(spark, folder, orders).withColumns({
        "slot": F.col("published_at"), "observed_at": F.col("published_at"),
        "config_version": F.lit(t.VERSION),
    })
    tables = ingest.Ingested.at(spark, scratch_path(spark, "ingested"))
    ingest.ingest_stream(
        incoming, _unit_map(spark, folder), t.SITE, tables, scratch_path(spark, "ingest-state"),
        _URGENT,
    ).awaitTermination()
    return tables


_GOOD = f"""{_FAULTS},
good AS (
  SELECT CAST(c_nationkey AS INTEGER) AS board_id, o_orderkey AS post_id, o_orderpriority AS title,
         o_orderdate AS seen, CAST(floor(c_acctbal) AS BIGINT) AS views
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_orderkey IN (SELECT post_id FROM checked WHERE failed = ''))"""


@query(
    "STR-2 FLT-1 MRG-2 MRG-3",
    f"""WITH {_GOOD}
SELECT board_id, post_id, title, seen AS last_seen_at, seen AS slot, views FROM good""",
)
def ingested_posts(spark, folder):
    """Posts and snapshots that a validated and screened stream leaves behind."""
    tables = _ingested(spark, folder)
    shots = tables.snapshots.read().select(*POST_KEY, "slot", "views")
    posts = tables.posts.read().select(*POST_KEY, "title", "last_seen_at")
    return posts.join(shots, list(POST_KEY), "full").select(
        *POST_KEY, "title", "last_seen_at", "slot", "views"
    )


@query(
    "STR-2 FLT-1 FLT-2",
    f"WITH {_FAULTS} SELECT board_id, post_id, failed FROM checked WHERE failed <> ''",
)
def ingested_rejects(spark, folder):
    """Observations that the stream refused, with the rules they broke."""
    return _ingested(spark, folder).rejected().select(
        *POST_KEY, F.array_join("failed", ",").alias("failed")
    )


@query(
    "STR-2 STR-5 TXT-2",
    f"""WITH {_GOOD}
SELECT 'title' AS source_kind, 'post:' || board_id || ':' || post_id AS source_ref,
       sha256(title) AS content_hash, 70 AS risk_score, min(seen) AS quarantined_at,
       'pending' AS review_state
FROM good WHERE title = '1-URGENT' GROUP BY ALL""",
)
def ingested_quarantine(spark, folder):
    """Titles that the stream quarantined beside their posts."""
    return _ingested(spark, folder).quarantine.read().select(
        "source_kind", "source_ref", "content_hash", "risk_score", "quarantined_at",
        "review_state",
    )


@query(
    "STR-2 MRG-6",
    f"""WITH {_GOOD}
SELECT c.board_id, CAST(count(*) FILTER (failed = '') AS BIGINT) AS inserted,
       CAST(0 AS BIGINT) AS updated,
       CAST((SELECT count(*) FROM good g WHERE g.board_id = c.board_id AND title = '1-URGENT')
         AS BIGINT) AS quarantined,
       CAST(count(*) FILTER (failed <> '') AS BIGINT) AS rejected
FROM checked c GROUP BY c.board_id""",
)
def ingested_summary(spark, folder):
    """What the stream did per board, summed over its batches."""
    counts = ("inserted", "updated", "quarantined", "rejected")
    return _ingested(spark, folder).summary().groupBy("board_id").agg(
        *[F.sum(name).alias(name) for name in counts]
    )


@query(
    "MRG-8",
    f"""WITH {t.POSTS}
SELECT board_id, max(post_id) AS high_water FROM posts WHERE NOT is_notice AND NOT is_ad
GROUP BY board_id""",
)
def high_water(spark, folder):
    return merge.high_water(t.posts(spark, folder))


# --- admission ----------------------------------------------------------------------------------

_STATUS = f"""
found AS (
  SELECT r.source_key, any_value(m.prior) AS prior,
         min(page) FILTER (NOT is_notice AND NOT is_ad AND post_id <= m.prior) AS boundary_page,
         max(page) AS landed
  FROM page_rows r LEFT JOIN marks m ON m.source_key = r.source_key
  WHERE page >= 1 GROUP BY r.source_key),
stops AS (
  SELECT *, least(CASE WHEN prior IS NULL THEN 2 WHEN boundary_page IS NULL THEN landed
                       ELSE greatest(2, boundary_page + 1) END, landed) AS pages_read FROM found),
reached AS (
  SELECT *, prior IS NULL OR coalesce(pages_read >= boundary_page + 1, false) AS boundary_reached
  FROM stops),
status AS (
  SELECT s.source_key, any_value(s.pages_read) AS pages_read,
         bool_and(s.boundary_reached) AS boundary_reached,
         CASE WHEN bool_and(s.boundary_reached)
              THEN max(r.post_id) FILTER (NOT is_notice AND NOT is_ad)
              ELSE any_value(s.prior) END AS high_water,
         CASE WHEN bool_and(s.boundary_reached) THEN 'succeeded' ELSE 'partial' END AS status
  FROM reached s JOIN page_rows r ON r.source_key = s.source_key AND r.page BETWEEN 1 AND s.pages_read
  GROUP BY s.source_key)"""


def _status(spark, folder):
    return admission.incremental_status(t.page_rows(spark, folder), t.marks(spark, folder), ADMIT)


@query(
    "MRG-7",
    f"""WITH {t.PAGE_ROWS},{t.MARKS},{_STATUS} SELECT * FROM status""",
)
def incremental_status(spark, folder):
    return _status(spark, folder)


@query(
    "MRG-7",
    f"""WITH {t.PAGE_ROWS},{t.MARKS},{_STATUS}
SELECT r.source_key, r.board_id, r.post_id, r.views, r.recommendations, r.comments, r.page, r.pos,
       r.published_at, r.is_notice, r.is_ad
FROM page_rows r JOIN status s ON s.source_key = r.source_key
WHERE s.boundary_reached AND r.page <= s.pages_read
QUALIFY row_number() OVER (PARTITION BY r.source_key, r.board_id, r.post_id
  ORDER BY views DESC, recommendations DESC, comments DESC, page DESC, pos DESC,
           published_at DESC, is_notice DESC, is_ad DESC) = 1""",
)
def incremental_admission(spark, folder):
    return admission.incremental_rows(t.page_rows(spark, folder), _status(spark, folder))


_CUTS = """
cuts AS (
  SELECT source_key, min((page, pos)) FILTER (
           NOT is_notice AND NOT is_ad AND published_at < TIMESTAMP '1995-03-01') AS cut
  FROM page_rows GROUP BY source_key)"""


@query(
    "MRG-9",
    f"""WITH {t.PAGE_ROWS},{_CUTS}
SELECT r.source_key, r.page, r.pos, r.post_id, r.published_at, r.is_notice, r.is_ad
FROM page_rows r JOIN cuts c ON c.source_key = r.source_key
WHERE c.cut IS NULL OR (r.page, r.pos) < c.cut""",
)
def backfill_cut(spark, folder):
    rows = t.page_rows(spark, folder)
    kept = admission.backfill_rows(rows, admission.backfill_cuts(rows, CUTOFF))
    return kept.select(
        "source_key", "page", "pos", "post_id", "published_at", "is_notice", "is_ad"
    )


@query(
    "MRG-9",
    f"""WITH {t.PAGE_ROWS},{_CUTS}
SELECT r.source_key, count(*) FILTER (c.cut IS NULL OR (r.page, r.pos) < c.cut) AS accepted,
       bool_or(c.cut IS NOT NULL) AS complete,
       (max((r.page, r.pos, r.post_id)) FILTER (NOT is_notice AND NOT is_ad
          AND (c.cut IS NULL OR (r.page, r.pos) <= c.cut)))[3] AS checkpoint_post_id
FROM page_rows r JOIN cuts c ON c.source_key = r.source_key GROUP BY r.source_key""",
)
def backfill_status(spark, folder):
    rows = t.page_rows(spark, folder)
    return admission.backfill_status(rows, admission.backfill_cuts(rows, CUTOFF))


@query(
    "MRG-10",
    f"""WITH {t.PAGE_ROWS},{_CUTS},
states AS (
  SELECT 'source-' || s_suppkey AS source_key, s_acctbal < 0 AS complete,
         CAST(s_nationkey // 4 AS INTEGER) AS next_page FROM supplier WHERE s_nationkey < 20),
open_pages AS (
  SELECT DISTINCT p.source_key, p.page, p.source_key AS source_order
  FROM page_rows p LEFT JOIN states s ON s.source_key = p.source_key
  JOIN cuts c ON c.source_key = p.source_key
  WHERE NOT coalesce(s.complete, false)
    AND p.page >= greatest(1, coalesce(s.next_page, 3) - 1)
    AND (c.cut IS NULL OR p.page <= c.cut[1])),
rounds AS (
  SELECT source_key, page,
         CAST(row_number() OVER (PARTITION BY source_key ORDER BY page) AS INTEGER) AS round
  FROM open_pages)
SELECT CAST(row_number() OVER (ORDER BY round, source_key) AS INTEGER) AS seq, source_key, page, round
FROM rounds ORDER BY round, source_key LIMIT {BUDGET}""",
)
def budget_allocation(spark, folder):
    return _allocated(spark, folder).select("seq", "source_key", "page", "round")


def _backfill_states(spark, folder):
    """A state for every supplier, except those of nations 20 and above: sources never begun."""
    return t.load(spark, folder, "supplier").where(F.col("s_nationkey") < 20).select(
        F.concat(F.lit("source-"), F.col("s_suppkey").cast("string")).alias("source_key"),
        F.floor(F.col("s_nationkey") / 4).cast("int").alias("next_page"),
        (F.col("s_acctbal") < 0).alias("complete"),
    )


def _allocated(spark, folder):
    rows = t.page_rows(spark, folder)
    pages = rows.select("source_key", F.col("source_key").alias("source_order"), "page")
    cuts = admission.backfill_cuts(rows, CUTOFF)
    return admission.allocate_pages(pages, _backfill_states(spark, folder), BUDGET, cuts)



@query(
    "AGG-11",
    f"""WITH {t.SNAPSHOTS}
SELECT n_nationkey AS board_id, n_name AS board_name, coalesce(p.posts, 0) AS posts,
       coalesce(s.snapshots, 0) AS snapshots, coalesce(p.duplicate_keys, 0) AS duplicate_keys
FROM nation
LEFT JOIN (SELECT board_id, count(*) AS posts, count(*) FILTER (n > 1) AS duplicate_keys
           FROM (SELECT board_id, post_id, count(*) AS n FROM posts GROUP BY ALL) GROUP BY board_id) p
  ON p.board_id = n_nationkey
LEFT JOIN (SELECT board_id, count(*) AS snapshots FROM snapshots GROUP BY board_id) s
  ON s.board_id = n_nationkey""",
)
def board_inventory(spark, folder):
    return metrics.board_inventory(
        t.boards(spark, folder), t.posts(spark, folder), t.snapshots(spark, folder)
    )


@query(
    "AGG-11",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL
HAVING count(*) > 1""",
)
def duplicate_lines(spark, folder):
    return metrics.duplicate_keys(t.load(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "MRG-9 MRG-10",
    f"""WITH {t.PAGE_ROWS}, spent AS (SELECT source_key, page FROM ({QUERIES["budget_allocation"].sql})),
states AS (
  SELECT 'source-' || s_suppkey AS source_key, s_acctbal < 0 AS complete,
         CAST(s_nationkey // 4 AS INTEGER) AS next_page FROM supplier WHERE s_nationkey < 20),
last AS (SELECT source_key, max(page) AS page FROM spent GROUP BY source_key),
landed AS (SELECT r.* FROM page_rows r JOIN spent s ON s.source_key = r.source_key AND s.page = r.page),
cut AS (
  SELECT source_key, min((page, pos)) FILTER (
           NOT is_notice AND NOT is_ad AND published_at < TIMESTAMP '1995-03-01') AS cut
  FROM landed GROUP BY source_key),
found AS (
  SELECT r.source_key, bool_or(c.cut IS NOT NULL) AS complete,
         (max((r.page, r.pos, r.post_id)) FILTER (NOT is_notice AND NOT is_ad
            AND (c.cut IS NULL OR (r.page, r.pos) <= c.cut)))[3] AS checkpoint_post_id
  FROM landed r JOIN cut c ON c.source_key = r.source_key GROUP BY r.source_key)
SELECT coalesce(s.source_key, l.source_key) AS source_key,
       CAST(coalesce(l.page + 1, s.next_page) AS INTEGER) AS next_page,
       coalesce(f.complete, s.complete, false) AS complete, f.checkpoint_post_id,
       l.page IS NOT NULL AS moved
FROM states s FULL JOIN last l ON l.source_key = s.source_key
LEFT JOIN found f ON f.source_key = l.source_key""",
)
def next_backfill_state(spark, folder):
    """Backfill states after the pages of one budget were read and stored."""
    rows = t.page_rows(spark, folder)
    states = _backfill_states(spark, folder).withColumn(
        "checkpoint_post_id", F.lit(None).cast("bigint")
    )
    spent = materialize(_allocated(spark, folder), "spent")
    landed = materialize(
        rows.join(spent.select("source_key", "page"), ["source_key", "page"]), "landed"
    )
    status = admission.backfill_status(landed, admission.backfill_cuts(landed, CUTOFF))
    after = collection.next_backfill_state(states, spent, status, _FETCHED)
    return after.select(
        "source_key", F.col("next_page").cast("int").alias("next_page"), "complete",
        "checkpoint_post_id", F.col("updated_at").isNotNull().alias("moved"),
    )

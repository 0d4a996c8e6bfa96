"""The model tables, derived from the supplied parquet tables by Spark.

Each adapter has its check SQL beside it as a common table expression, so that a
query and its SQL start from the same rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forumtide.functions.text import digest
from forumtide.functions.time import slot_of
from forumtide.functions.values import Site
from forumtide.operators.ranking import as_of_counters
from forumtide.registry import Lexicon, ScanRule
from forumtide.session import materialize

SITE = Site("forum.example.com", "/board/main", category="general")
AS_OF = datetime(1999, 6, 1, tzinfo=timezone.utc)
EARLIER = datetime(1998, 9, 1, tzinfo=timezone.utc)
VERSION = "c0ffee" + "0" * 58

# Terms that occur in the supplied texts.
SAMPLE_LEXICON = Lexicon(
    version="sample-v1",
    positive=("erhe", "ouon", "tion"),
    negative=("with", "pour", "nicht"),
    intents=(
        ("request", ("from", "this", "que la")),
        ("question", ("was", "und", "les")),
        ("praise", ("erhe", "die")),
    ),
    topics=(
        ("balance", ("thing", "ment", "über")),
        ("growth", ("ander", "eaux", "ción")),
        ("events", ("the", "der", "los")),
    ),
    default_intent="information",
    default_topic="community",
)

# Patterns that occur in the supplied texts.
SAMPLE_RULES = (
    ScanRule("text.email", 40, r"[a-z0-9._%+-]+@[a-z0-9-]+(?:\.[a-z0-9-]+)+", ("@",)),
    ScanRule("text.token", 70, r"token = \"[0-9a-f]{8,}\"", ("token",)),
    ScanRule("text.licence", 60, r"licensed under (?:the )?[a-z-]+", ("licensed",)),
)


# Declared, so that opening a table starts no job to look at its files.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
    "c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
    "p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
    "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def boards(spark: SparkSession, folder: str) -> DataFrame:
    return load(spark, folder, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name")
    )


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """One post per order; its board and unit come from the customer."""
    orders = load(spark, folder, "orders")
    customers = load(spark, folder, "customer")
    pending = F.col("o_orderstatus") == "P"
    board, post = F.col("c_nationkey").cast("int"), F.col("o_orderkey")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        board.alias("board_id"), post.alias("post_id"),
        F.lower("c_mktsegment").alias("analysis_unit"),
        F.col("o_orderpriority").alias("category"),
        F.concat(F.lit("Order "), post.cast("string")).alias("title"),
        F.col("o_orderdate").alias("published_at"),
        SITE.article_url(board, post).alias("source_url"),
        (pending & (F.col("o_orderpriority") == "1-URGENT")).alias("is_notice"),
        (pending & (F.col("o_orderpriority") == "5-LOW")).alias("is_ad"),
    )


POSTS = """
posts AS (
  SELECT CAST(c_nationkey AS INTEGER) AS board_id, o_orderkey AS post_id,
         lower(c_mktsegment) AS analysis_unit, o_orderpriority AS category,
         'Order ' || o_orderkey AS title, o_orderdate AS published_at,
         'https://forum.example.com/board/main/' || c_nationkey || '/' || o_orderkey AS source_url,
         o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' AS is_notice,
         o_orderstatus = 'P' AND o_orderpriority = '5-LOW' AS is_ad
  FROM orders JOIN customer ON o_custkey = c_custkey
)"""


def observations(spark: SparkSession, folder: str) -> DataFrame:
    """One sighting of a post per line item; titles and configurations vary between them."""
    lines = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("post_id"),
        F.col("l_shipdate").alias("slot"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("observed_at"),
        F.floor("l_extendedprice").cast("bigint").alias("views"),
        F.floor("l_quantity").cast("bigint").alias("recommendations"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("comments"),
        "l_returnflag",
    )
    return lines.join(posts(spark, folder), "post_id").select(
        "board_id", "post_id", "analysis_unit", "category",
        F.concat("title", F.lit(" "), "l_returnflag").alias("title"),
        "published_at", "source_url", "is_notice", "is_ad", "slot", "observed_at",
        "views", "recommendations", "comments",
        digest(F.concat(F.lit("config "), F.col("l_returnflag"))).alias("config_version"),
    )


OBSERVATIONS = POSTS + """,
observations AS (
  SELECT board_id, post_id, analysis_unit, category, title || ' ' || l_returnflag AS title,
         published_at, source_url, is_notice, is_ad, l_shipdate AS slot,
         l_shipdate + to_hours(l_linenumber) AS observed_at,
         CAST(floor(l_extendedprice) AS BIGINT) AS views,
         CAST(floor(l_quantity) AS BIGINT) AS recommendations,
         CAST(l_linenumber - 1 AS BIGINT) AS comments,
         sha256('config ' || l_returnflag) AS config_version
  FROM lineitem JOIN posts ON l_orderkey = post_id
)"""


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot per post and slot.

    Line items are combined before the join, so one order holding most of them reaches
    the join as one row per ship date.
    """
    lines = load(spark, folder, "lineitem")
    slots = lines.groupBy(F.col("l_orderkey").alias("post_id"), F.col("l_shipdate").alias("slot")).agg(
        F.max("l_extendedprice").alias("price"), F.max("l_quantity").alias("quantity"),
        F.max("l_linenumber").alias("line"),
    )
    keys = posts(spark, folder).select("board_id", "post_id").distinct()
    return slots.join(keys, "post_id").select(
        "board_id", "post_id", "slot",
        (F.col("slot") + F.make_dt_interval(F.lit(0), F.col("line"))).alias("observed_at"),
        F.floor("price").cast("bigint").alias("views"),
        F.floor("quantity").cast("bigint").alias("recommendations"),
        (F.col("line") - 1).cast("bigint").alias("comments"),
        F.lit(VERSION).alias("config_version"),
    )


SNAPSHOTS = POSTS + f""",
snapshots AS (
  SELECT board_id, post_id, l_shipdate AS slot,
         l_shipdate + to_hours(max(l_linenumber)) AS observed_at,
         CAST(floor(max(l_extendedprice)) AS BIGINT) AS views,
         CAST(floor(max(l_quantity)) AS BIGINT) AS recommendations,
         CAST(max(l_linenumber) - 1 AS BIGINT) AS comments,
         '{VERSION}' AS config_version
  FROM lineitem JOIN posts ON l_orderkey = post_id
  GROUP BY board_id, post_id, l_shipdate
)"""


def quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Title quarantine of the most expensive orders, in all review states."""
    state = (
        F.when(F.col("o_orderpriority") == "2-HIGH", "confirmed")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "released")
        .otherwise("pending")
    )
    released = state == "released"
    orders, customers = load(spark, folder, "orders"), load(spark, folder, "customer")
    ref = F.concat(
        F.lit("post:"), F.col("c_nationkey").cast("string"), F.lit(":"),
        F.col("o_orderkey").cast("string"),
    )
    return (
        orders.where(F.col("o_totalprice") >= 400000)
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            digest(ref).alias("id"), F.lit("title").alias("source_kind"), ref.alias("source_ref"),
            digest(F.col("o_orderkey").cast("string")).alias("content_hash"),
            state.alias("review_state"),
            F.when(released, F.concat(F.lit("clerk "), F.col("o_orderstatus"))).alias("reviewer"),
            F.when(released, F.lit("checked")).alias("note"),
            F.when(released, F.col("o_orderdate")).alias("released_at"),
        )
    )


QUARANTINE = """
quarantine AS (
  SELECT sha256('post:' || c_nationkey || ':' || o_orderkey) AS id, 'title' AS source_kind,
         'post:' || c_nationkey || ':' || o_orderkey AS source_ref,
         sha256(CAST(o_orderkey AS VARCHAR)) AS content_hash,
         CASE o_orderpriority WHEN '2-HIGH' THEN 'confirmed' WHEN '3-MEDIUM' THEN 'released'
              ELSE 'pending' END AS review_state,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'clerk ' || o_orderstatus END AS reviewer,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'checked' END AS note,
         CASE WHEN o_orderpriority = '3-MEDIUM' THEN o_orderdate END AS released_at
  FROM orders JOIN customer ON o_custkey = c_custkey
  WHERE o_totalprice >= 400000
)"""


def latest(spark: SparkSession, folder: str) -> DataFrame:
    """Posts with their newest counters, for one reading: columns and filters reach the scans."""
    counters = as_of_counters(snapshots(spark, folder))
    return posts(spark, folder).join(counters, ["board_id", "post_id"])


def stored_latest(spark: SparkSession, folder: str) -> DataFrame:
    """The same, stored as the latest-metrics table would be, for queries that read it again."""
    return materialize(latest(spark, folder), "latest")


LATEST = SNAPSHOTS + """,
latest AS (
  SELECT p.*, s.views, s.recommendations, s.comments, s.slot
  FROM posts p JOIN (
    SELECT * FROM snapshots
    QUALIFY row_number() OVER (PARTITION BY board_id, post_id ORDER BY slot DESC) = 1
  ) s ON p.board_id = s.board_id AND p.post_id = s.post_id
)"""


def page_rows(spark: SparkSession, folder: str) -> DataFrame:
    """List-page rows: a supplier's line items as pages of posts."""
    lines = load(spark, folder, "lineitem")
    return lines.select(
        F.concat(F.lit("source-"), F.col("l_suppkey").cast("string")).alias("source_key"),
        F.col("l_linenumber").alias("page"), F.col("l_partkey").alias("pos"),
        F.lit(1).alias("board_id"), F.col("l_orderkey").alias("post_id"),
        F.col("l_shipdate").alias("published_at"),
        F.floor("l_extendedprice").cast("bigint").alias("views"),
        F.floor("l_quantity").cast("bigint").alias("recommendations"),
        F.floor(F.col("l_discount") * 100).cast("bigint").alias("comments"),
        (F.col("l_tax") > 0.075).alias("is_notice"),
        ((F.col("l_tax") <= 0.075) & (F.col("l_discount") > 0.095)).alias("is_ad"),
    )


PAGE_ROWS = """
page_rows AS (
  SELECT 'source-' || l_suppkey AS source_key, l_linenumber AS page, l_partkey AS pos,
         1 AS board_id, l_orderkey AS post_id, l_shipdate AS published_at,
         CAST(floor(l_extendedprice) AS BIGINT) AS views,
         CAST(floor(l_quantity) AS BIGINT) AS recommendations,
         CAST(floor(l_discount * 100) AS BIGINT) AS comments,
         l_tax > CAST(0.075 AS DOUBLE) AS is_notice,
         l_tax <= CAST(0.075 AS DOUBLE) AND l_discount > CAST(0.095 AS DOUBLE) AS is_ad
  FROM lineitem
)"""


def marks(spark: SparkSession, folder: str) -> DataFrame:
    """Prior high-water mark per source; suppliers in debt have a null one, some have no row."""
    return load(spark, folder, "supplier").where("s_nationkey <> 3").select(
        F.concat(F.lit("source-"), F.col("s_suppkey").cast("string")).alias("source_key"),
        F.when(F.col("s_acctbal") >= 0, F.floor(F.col("s_acctbal") / 20).cast("bigint")).alias("prior"),
    )


MARKS = """
marks AS (
  SELECT 'source-' || s_suppkey AS source_key,
         CASE WHEN s_acctbal >= 0 THEN CAST(floor(s_acctbal / 20) AS BIGINT) END AS prior
  FROM supplier WHERE s_nationkey <> 3
)"""


def counter_series(spark: SparkSession, folder: str) -> DataFrame:
    """Running event counts per user and slot, as the snapshots of one post per user.

    Events are counted per slot first, so the running window holds one row per slot.
    """
    events = load(spark, folder, "events")
    kind = F.col("event_type")
    per_slot = events.groupBy("user_id", slot_of(F.col("ts")).alias("slot")).agg(
        F.count_if(kind == "view").alias("v"), F.count_if(kind == "purchase").alias("r"),
        F.count_if(kind == "click").alias("c"),
    )
    so_far = Window.partitionBy("user_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    return per_slot.select(
        (F.col("user_id") % 5).cast("int").alias("board_id"), F.col("user_id").alias("post_id"),
        "slot", F.sum("v").over(so_far).alias("views"),
        F.sum("r").over(so_far).alias("recommendations"), F.sum("c").over(so_far).alias("comments"),
    )


SLOT = "time_bucket(INTERVAL '6 hours', ts, TIMESTAMP '2000-01-01 03:20:00')"

SERIES = f"""
series AS (
  SELECT CAST(user_id % 5 AS INTEGER) AS board_id, user_id AS post_id, slot,
         CAST(sum(v) OVER w AS BIGINT) AS views, CAST(sum(r) OVER w AS BIGINT) AS recommendations,
         CAST(sum(c) OVER w AS BIGINT) AS comments
  FROM (
    SELECT user_id, {SLOT} AS slot, count(*) FILTER (event_type = 'view') AS v,
           count(*) FILTER (event_type = 'purchase') AS r,
           count(*) FILTER (event_type = 'click') AS c
    FROM events GROUP BY ALL
  )
  WINDOW w AS (PARTITION BY user_id ORDER BY slot ROWS UNBOUNDED PRECEDING)
)"""


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """One collection run per event type and slot."""
    events = load(spark, folder, "events")
    job = F.concat(F.lit("metadata:"), F.col("event_type"))
    grouped = events.groupBy(job.alias("job_type"), slot_of(F.col("ts")).alias("slot")).agg(
        F.max("value").alias("top"), F.min("value").alias("low"), F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("started_at"), F.max("ts").alias("finished_at"),
    )
    status = (
        F.when(F.col("top") > 200, "failed").when(F.col("top") > 120, "partial")
        .otherwise("succeeded")
    )
    pages = F.floor(F.col("low") * 10).cast("bigint") - 3
    diagnostics = F.concat(
        F.lit('{"attempts":'), F.col("n").cast("string"), F.lit(',"pages_consumed":'),
        pages.cast("string"), F.lit(',"accepted":"'), F.col("n").cast("string"),
        F.lit('","failed_sources":["'), F.col("job_type"), F.lit('",7,""]}'),
    )
    return grouped.select(
        F.concat("job_type", F.lit("@"), F.date_format("slot", "yyyyMMddHHmm")).alias("id"),
        "job_type", "slot", status.alias("status"), F.lit(VERSION).alias("config_version"),
        "started_at", "finished_at", diagnostics.alias("diagnostics"),
    )


RUNS = f"""
run_groups AS (
  SELECT 'metadata:' || event_type AS job_type, {SLOT} AS slot, max(value) AS top,
         min(value) AS low, count(*) AS n, min(ts) AS started_at, max(ts) AS finished_at
  FROM events GROUP BY ALL
),
runs AS (
  SELECT job_type || '@' || strftime(slot, '%Y%m%d%H%M') AS id, job_type, slot,
         CASE WHEN top > 200 THEN 'failed' WHEN top > 120 THEN 'partial' ELSE 'succeeded' END
           AS status,
         started_at, finished_at, n AS attempts,
         greatest(CAST(floor(low * 10) AS BIGINT) - 3, 0) AS pages_consumed
  FROM run_groups
)"""


def threads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """``(posts, comments)``: the first turn of a conversation and the turns after it."""
    turns = load(spark, folder, "conversations")
    keys = [F.lit(1).alias("board_id"), F.col("conv_id").alias("post_id")]
    first = turns.where(F.col("turn") == 0).select(
        *keys, F.col("role").alias("analysis_unit"),
        F.concat(F.lit("Thread "), F.col("conv_id").cast("string")).alias("title"),
        F.col("text").alias("body"),
    )
    rest = turns.where(F.col("turn") > 0).select(
        *keys, F.col("turn").alias("comment_id"), F.col("turn").alias("parent_id"),
        F.col("role").alias("published_at"), "text",
    )
    return first, rest


THREADS = """
threads AS (
  SELECT 1 AS board_id, conv_id AS post_id, role AS analysis_unit, 'Thread ' || conv_id AS title,
         text AS body
  FROM conversations WHERE turn = 0
),
thread_comments AS (
  SELECT 1 AS board_id, conv_id AS post_id, turn AS comment_id, role AS published_at, text
  FROM conversations WHERE turn > 0
)"""


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as post bodies, one unit per source."""
    return load(spark, folder, "documents").select(
        F.lit(2).alias("board_id"), F.col("doc_id").alias("post_id"),
        F.col("source").alias("analysis_unit"),
        F.concat(F.lit("Document "), F.col("lang")).alias("title"), F.col("text").alias("body"),
    )


DOCUMENTS = """
docs AS (
  SELECT 2 AS board_id, doc_id AS post_id, source AS analysis_unit, 'Document ' || lang AS title,
         text AS body
  FROM documents
)"""


# --- check-SQL fragments for text rules -------------------------------------------------------


def sql_fold(text: str) -> str:
    return (
        f"replace(lower(trim(regexp_replace({text}, '[ \\t\\n\\r]+', ' ', 'g'))), 'ß', 'ss')"
    )


def sql_hits(normal: str, terms: tuple[str, ...]) -> str:
    return " + ".join(f"CAST(contains({normal}, '{t}') AS INTEGER)" for t in terms)


def sql_sentiment(normal: str, lexicon: Lexicon = SAMPLE_LEXICON) -> str:
    up, down = sql_hits(normal, lexicon.positive), sql_hits(normal, lexicon.negative)
    return (
        f"CASE WHEN ({up}) > 0 AND ({down}) > 0 THEN 'mixed' WHEN ({up}) > 0 THEN 'positive' "
        f"WHEN ({down}) > 0 THEN 'negative' ELSE 'neutral' END"
    )


def sql_confidence(normal: str, lexicon: Lexicon = SAMPLE_LEXICON) -> str:
    hits = sql_hits(normal, lexicon.positive + lexicon.negative)
    return (
        f"CASE WHEN ({hits}) > 0 THEN least(CAST(0.95 AS DOUBLE), "
        f"CAST(0.45 AS DOUBLE) + CAST(0.15 AS DOUBLE) * ({hits})) ELSE CAST(0.35 AS DOUBLE) END"
    )


def sql_evidence(normal: str, joiner: str, lexicon: Lexicon = SAMPLE_LEXICON) -> str:
    terms = ", ".join(
        f"CASE WHEN contains({normal}, '{t}') THEN '{t}' END"
        for t in lexicon.positive + lexicon.negative
    )
    return f"array_to_string(list_filter([{terms}], lambda x: x IS NOT NULL)[1:5], '{joiner}')"


def sql_strongest(normal: str, groups, default: str) -> str:
    """Greatest count wins, earlier group on ties."""
    scores = [(label, f"({sql_hits(normal, terms)})") for label, terms in groups]
    best = f"greatest({', '.join(score for _, score in scores)})"
    arms = " ".join(f"WHEN {score} = {best} THEN '{label}'" for label, score in scores)
    return f"CASE WHEN {best} = 0 THEN '{default}' {arms} END"


LABELS = f"""
thread_labels AS (
  SELECT board_id, post_id, analysis_unit, title, body,
         {sql_sentiment('n')} AS body_sentiment, {sql_confidence('n')} AS confidence,
         {sql_evidence('n', ' · ')} AS evidence_terms,
         {sql_strongest('c', SAMPLE_LEXICON.intents, SAMPLE_LEXICON.default_intent)} AS intent,
         {sql_strongest('c', SAMPLE_LEXICON.topics, SAMPLE_LEXICON.default_topic)} AS topic
  FROM (SELECT *, {sql_fold('body')} AS n, {sql_fold("title || ' ' || body")} AS c FROM threads)
),
comment_labels AS (
  SELECT *, {sql_sentiment('n')} AS sentiment
  FROM (SELECT *, {sql_fold('text')} AS n FROM thread_comments)
),
reaction_counts AS (
  SELECT board_id, post_id, count(*) FILTER (sentiment = 'positive') AS p,
         count(*) FILTER (sentiment = 'negative') AS m, count(*) FILTER (sentiment = 'mixed') AS x
  FROM comment_labels GROUP BY ALL
),
reactions AS (
  SELECT board_id, post_id,
         CASE WHEN greatest(p, m, x) = 0 THEN 'neutral'
              WHEN CAST(p = greatest(p, m, x) AS INTEGER) + CAST(m = greatest(p, m, x) AS INTEGER)
                   + CAST(x = greatest(p, m, x) AS INTEGER) > 1 THEN 'mixed'
              WHEN p = greatest(p, m, x) THEN 'positive'
              WHEN m = greatest(p, m, x) THEN 'negative' ELSE 'mixed' END AS comment_reaction
  FROM reaction_counts
),
labelled AS (
  SELECT t.*, coalesce(r.comment_reaction, 'neutral') AS comment_reaction
  FROM thread_labels t LEFT JOIN reactions r ON t.board_id = r.board_id AND t.post_id = r.post_id
)"""

"""Queries over sources: contracts, URLs, pages, comments, bundles, streams."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.functions.text import plain_text
from forumtide.functions.values import (
    approved_url,
    article_identity,
    grouped_integer,
    safe_cells,
)
from forumtide.operators import ranking
from forumtide.plans import tables as t
from forumtide.plans import merging  # noqa: F401  (registers a query whose SQL is shared)
from forumtide.plans.catalog import QUERIES, query
from forumtide.registry import SELECTION_POLICY
from forumtide.session import materialize, scratch_path
from forumtide.sources import artifact, bundle, comments, contracts, pages
from forumtide.streaming import slots

EVENT_CONTRACT = contracts.Contract(
    "events", ("event_id", "ts", "user_id", "event_type", "value", "props"),
    integers=("event_id", "user_id", "value"), required_text=("event_type", "props"),
    timestamps=("ts", "props"), required_timestamps=("ts",), grain=("user_id", "event_type"),
)


@query(
    "SRC-1",
    """SELECT 'events' AS "table", 'value' AS "column", 'integer' AS rule, count(*) AS n FROM events
WHERE NOT regexp_full_match(CAST(value AS VARCHAR), '[0-9]+')
UNION ALL
SELECT 'events', 'props', 'timestamp', count(*) FROM events
UNION ALL
SELECT 'events', 'user_id,event_type', 'duplicate', CAST(sum(n - 1) AS BIGINT)
FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1)""",
)
def contract_violations(spark, folder):
    strings = contracts.as_strings(t.load(spark, folder, "events"))
    return contracts.apply_contract(strings, EVENT_CONTRACT)[1]


ORDER_CONTRACT = contracts.Contract(
    "orders",
    ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"),
    integers=("o_orderkey", "o_custkey"), required_text=("o_orderstatus", "o_orderpriority"),
    timestamps=("o_orderdate",), required_timestamps=("o_orderdate",), grain=("o_orderkey",),
)


@query(
    "SRC-1",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders",
)
def contract_rows(spark, folder):
    """The orders table read back as text and typed again by its contract."""
    strings = contracts.as_strings(t.load(spark, folder, "orders"))
    return contracts.apply_contract(strings, ORDER_CONTRACT)[0].drop("o_totalprice")


def _faulty_csv(spark, folder) -> str:
    """The orders as CSV parts; of every 50 keys two break the row, one the customer number."""
    at = F.pmod("o_orderkey", F.lit(50))
    customer = F.when(at == 2, F.lit("none")).otherwise(F.col("o_custkey").cast("string"))
    fields = [
        F.col("o_orderkey").cast("string"), customer, F.col("o_orderstatus"),
        F.col("o_totalprice").cast("string"), F.col("o_orderdate").cast("string"),
        F.when(at == 1, F.lit(None)).otherwise(F.col("o_orderpriority")),
        F.when(at == 0, F.lit("extra")),
    ]
    lines = t.load(spark, folder, "orders").select(
        F.concat_ws(",", *fields).alias(",".join(ORDER_CONTRACT.columns))
    )
    path = scratch_path(spark, "orders-csv")
    # One column whose separator never occurs: header and lines are written as they are.
    lines.repartition(3).write.option("header", True).option("sep", "\x01").csv(path)
    return path


@query(
    "SRC-1",
    """SELECT 'orders' AS "table", '*' AS "column", 'fields' AS rule, count(*) AS n FROM orders
WHERE o_orderkey % 50 IN (0, 1)
UNION ALL
SELECT 'orders', 'o_custkey', 'integer', count(*) FROM orders WHERE o_orderkey % 50 = 2""",
)
def csv_violations(spark, folder):
    """Violations found in CSV files, malformed rows among them."""
    strings = contracts.read_strings(spark, _faulty_csv(spark, folder), ORDER_CONTRACT)
    return contracts.apply_contract(strings, ORDER_CONTRACT)[1]


@query(
    "SET-3",
    """SELECT k AS key, status FROM (
  SELECT o_orderkey AS k, 'unexpected' AS status FROM orders
  WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
  UNION ALL
  SELECT DISTINCT l_orderkey, 'missing' FROM lineitem
  WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders))""",
)
def key_differences(spark, folder):
    orders = t.load(spark, folder, "orders").select(F.col("o_orderkey").alias("key"))
    lines = t.load(spark, folder, "lineitem").select(F.col("l_orderkey").alias("key"))
    return contracts.set_difference(orders, lines, ("key",))


@query(
    "SRC-2",
    """SELECT 'region' AS name, 'mismatch' AS status, (SELECT count(*) FROM region) AS n_rows
UNION ALL SELECT 'nation', 'unexpected', (SELECT count(*) FROM nation)
UNION ALL SELECT 'supplier', 'ok', (SELECT count(*) FROM supplier)
UNION ALL SELECT 'orders', 'ok', (SELECT count(*) FROM orders)
UNION ALL SELECT 'ghost', 'missing', 0""",
)
def bundle_integrity(spark, folder):
    """Tables written as bounded files, checked against a list that alters, omits and invents."""
    root, names = scratch_path(spark, "bundle"), ("region", "nation", "supplier", "orders")
    for name in names:
        rows = t.load(spark, folder, name)
        rows.write.option("maxRecordsPerFile", bundle.ROWS_PER_FILE).parquet(f"{root}/{name}")
    files = bundle.file_digests(spark, root, "*.parquet")
    member = F.substring_index("name", "/", 1)
    altered = F.when(member == "region", F.reverse("sha256")).otherwise(F.col("sha256"))
    ghost = spark.range(1).select(
        F.lit("ghost/part-0.parquet").alias("name"), F.repeat(F.lit("0"), 64).alias("sha256")
    )
    listed = files.where(member != "nation").select("name", altered.alias("sha256"))
    states = bundle.integrity(files, listed.unionByName(ghost)).select(
        member.alias("name"), "status"
    ).distinct()
    counts = reduce(DataFrame.unionByName, [
        spark.read.parquet(f"{root}/{name}").agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("name"), "n_rows") for name in names
    ])
    zero = F.lit(0).cast("bigint")
    return states.join(counts, "name", "left").select(
        "name", "status", F.coalesce("n_rows", zero).alias("n_rows")
    )


@query(
    "SRC-3",
    """SELECT source AS release, doc_id FROM documents
WHERE source = (SELECT max(source) FROM documents)""",
)
def newest_release(spark, folder):
    rows = t.load(spark, folder, "documents").select(F.col("source").alias("release"), "doc_id")
    return bundle.newest_complete(rows)


_MANIFESTS = """
manifests AS (
  SELECT doc_id, quality AS schema_version, 'sha-' || toxic AS source_sha256 FROM labels)"""


def _manifests(spark, folder):
    """Manifest rows from the label table: two schema versions, two sources."""
    policy = SELECTION_POLICY
    return t.load(spark, folder, "labels").select(
        F.col("doc_id").cast("string").alias("folder"), F.col("quality").alias("schema_version"),
        F.concat(F.lit("sha-"), F.col("toxic").cast("string")).alias("source_sha256"),
        F.lit("v1").alias("model_version"), F.lit(policy.version).alias("policy_version"),
        F.lit(policy.window_days).alias("window_days"),
        F.lit(policy.job_per_metric).alias("job_per_metric"),
        F.lit(policy.general_per_metric).alias("general_per_metric"),
        (F.col("quality") == F.col("toxic")).alias("complete"),
    )


@query(
    "SRC-4",
    f"""WITH {_MANIFESTS}
SELECT d.doc_id, d.n_chars FROM documents d WHERE d.doc_id IN (
  SELECT doc_id FROM manifests WHERE schema_version = 1 AND source_sha256 = 'sha-0')""",
)
def matching_artifact_rows(spark, folder):
    """Stored rows whose manifest has this schema version and source."""
    good = artifact.matching_manifests(_manifests(spark, folder), "sha-0").select(
        F.col("folder").cast("bigint").alias("doc_id")
    )
    rows = t.load(spark, folder, "documents").select("doc_id", "n_chars")
    return rows.join(good, "doc_id", "left_semi")


@query(
    "TXT-9",
    f"""WITH {_MANIFESTS}
SELECT count(*) > 0 AS current FROM manifests JOIN labels l USING (doc_id)
WHERE schema_version = 1 AND source_sha256 = 'sha-1' AND l.quality = l.toxic""",
)
def artifact_is_current(spark, folder):
    return artifact.is_current(_manifests(spark, folder), "sha-1", SELECTION_POLICY, "v1")


# --- URLs and cells -----------------------------------------------------------------------------


@query(
    "FLT-5",
    """SELECT page_id, CASE WHEN regexp_matches(url, '^https://m\\.therou\\.example\\.com(:|/|\\?|#|$)')
       THEN url ELSE '' END AS url FROM pages""",
)
def approved_urls(spark, folder):
    return t.load(spark, folder, "pages").select(
        "page_id", approved_url(F.concat(F.lit(" "), "url"), "m.therou.example.com").alias("url")
    )


@query(
    "FLT-6",
    f"""WITH {t.POSTS},
links AS (
  SELECT board_id, post_id, c.o_orderpriority AS kind FROM posts JOIN orders c ON c.o_orderkey = post_id)
SELECT board_id, post_id AS link_id,
       CASE WHEN kind IN ('1-URGENT', '2-HIGH') AND post_id > 0 THEN post_id END AS post_id,
       CASE WHEN kind IN ('1-URGENT', '2-HIGH') AND post_id > 0 THEN
         'https://forum.example.com/board/main/' || board_id || '/' || post_id END AS url,
       CASE kind WHEN '3-MEDIUM' THEN 'query' WHEN '4-NOT SPECIFIED' THEN 'foreign'
                 WHEN '5-LOW' THEN 'board' ELSE CASE WHEN post_id < 1 THEN 'post' END END AS reason
FROM links""",
)
def article_links(spark, folder):
    """Links of every accepted and rejected form, built from the posts."""
    orders = t.load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("post_id"), F.col("o_orderpriority").alias("kind")
    )
    rows = t.posts(spark, folder).select("board_id", "post_id").join(orders, "post_id")
    path = F.concat(
        F.lit("/board/main/"), F.col("board_id").cast("string"), F.lit("/0"),
        F.col("post_id").cast("string"),
    )
    href = (
        F.when(F.col("kind") == "1-URGENT", F.concat(path, F.lit("?p=7")))
        .when(F.col("kind") == "2-HIGH", F.concat(F.lit("https://FORUM.example.com:443"), path))
        .when(F.col("kind") == "3-MEDIUM", F.concat(path, F.lit("?p=0")))
        .when(F.col("kind") == "4-NOT SPECIFIED", F.concat(F.lit("http://forum.example.com"), path))
        .otherwise(F.replace(path, F.lit("/main/"), F.lit("/main/9")))
    )
    found = rows.withColumn("a", article_identity(href, F.col("board_id"), t.SITE))
    return found.select(
        "board_id", F.col("post_id").alias("link_id"), "a.post_id", "a.url", "a.reason"
    )


@query(
    "FN-4",
    """SELECT l_orderkey, l_linenumber, l_partkey,
       CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice) AS BIGINT)
            WHEN l_returnflag = 'N' THEN CAST(floor(l_quantity) AS BIGINT) END AS value
FROM lineitem""",
)
def grouped_integers(spark, folder):
    """Numbers with thousands commas, plain numbers, and malformed ones."""
    price = F.floor("l_extendedprice").cast("bigint")
    text = (
        F.when(F.col("l_returnflag") == "A", F.concat(F.lit(" "), F.format_number(price, 0)))
        .when(F.col("l_returnflag") == "N", F.floor("l_quantity").cast("bigint").cast("string"))
        .otherwise(F.concat(price.cast("string"), F.lit(",1")))
    )
    return t.load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", grouped_integer(text).alias("value")
    )


@query(
    "CSV-1",
    """SELECT event_id, CASE WHEN event_type = 'view' THEN '''=view' WHEN event_type = 'click'
  THEN '''-click' ELSE event_type END AS event_type, props, value FROM events""",
)
def csv_safe(spark, folder):
    kind = F.col("event_type")
    cell = F.when(kind == "view", F.concat(F.lit("="), kind)).when(
        kind == "click", F.concat(F.lit("-"), kind)
    ).otherwise(kind)
    rows = t.load(spark, folder, "events").select(
        "event_id", cell.alias("event_type"), "props", "value"
    )
    return safe_cells(rows)


# --- pages and comments -------------------------------------------------------------------------

_DECODED = "inner_html"
for _name, _char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    # Entities cut off at the end of a title lack their semicolon.
    _DECODED = f"regexp_replace({_DECODED}, '&{_name};?', '{_char}', 'g')"
_PLAIN = f"trim(regexp_replace(regexp_replace({_DECODED}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(
    "SRC-8 FN-2",
    f"""WITH a AS (
  SELECT page_id, regexp_extract(html, '(?s)<article>(.*?)</article>', 1) AS inner_html FROM pages)
SELECT page_id, {_PLAIN} AS body, CAST(NULL AS VARCHAR) AS error FROM a""",
)
def page_articles(spark, folder):
    return pages.parse_articles(t.load(spark, folder, "pages"), "html", "article").select(
        "page_id", "body", "error"
    )


@query(
    "SRC-8",
    """SELECT page_id, CAST(NULL AS VARCHAR) AS body, 'article body is missing' AS error FROM pages""",
)
def page_articles_missing(spark, folder):
    """The same pages asked for a container none of them has."""
    return pages.parse_articles(
        t.load(spark, folder, "pages"), "html", "article", "forum-body"
    ).select("page_id", "body", "error")


@query(
    "FN-2",
    """SELECT conv_id, turn, trim(regexp_replace(text, '\\s+', ' ', 'g')) || ' & < end' AS plain
FROM conversations""",
)
def plain_texts(spark, folder):
    """Twice-escaped markup around every turn comes back as its text."""
    wrapped = F.concat(
        F.lit("<div><b>"), F.col("text"), F.lit("</b>&amp;amp;<br>&amp;lt; <i>end</i></div>")
    )
    return t.load(spark, folder, "conversations").select(
        "conv_id", "turn", plain_text(wrapped).alias("plain")
    )


_FETCHED = datetime(2024, 1, 1, 3, 0, 0)
PER_PAGE = 500


def _list_pages(spark, folder):
    """List pages written from the orders: one page per board and run of post ids.

    A page holds one board of at most 500 neighbouring ids, so gathering its rows is bounded.
    """
    rows = t.posts(spark, folder).withColumn("page", F.floor(F.col("post_id") / PER_PAGE).cast("int"))
    cell = F.concat(
        F.lit('<tr class="'), F.when(F.col("is_notice"), "notice").otherwise("row"),
        F.lit('"><td class="num">1</td><td class="tit"><div class="text-wrap">'),
        F.lit('<a class="subject-link" href="/board/main/'), F.col("board_id").cast("string"),
        F.lit("/"), F.col("post_id").cast("string"), F.lit('?p=1"><span class="category">['),
        F.col("analysis_unit"), F.lit("]</span> "), F.col("title"), F.lit("</a>"),
        F.lit('<span class="con-comment">['), (F.col("post_id") % 7).cast("string"),
        F.lit("]</span></div>"),
        F.when(F.col("is_ad"), '<span class="label">광고</span>').otherwise(""),
        F.lit('</td><td class="user">u</td><td class="date">'),
        F.date_format("published_at", "yyyy-MM-dd"), F.lit('</td><td class="view">'),
        F.format_number(F.col("post_id"), 0), F.lit('</td><td class="reco">'),
        F.when(F.col("is_notice"), "x").otherwise("3"), F.lit("</td></tr>"),
    )
    head = "".join(f"<th>{name}</th>" for name in pages.HEADER)
    # Parsing costs far more than its bytes suggest, so the pages keep all their partitions.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.repartition(parts, "board_id", "page")
        .groupBy("board_id", "page")
        .agg(F.sort_array(F.collect_list(F.struct("post_id", cell.alias("html")))).alias("rows"))
        .select(
            "board_id", "page",
            F.concat(
                F.lit(f"<html><body><table><thead><tr>{head}</tr></thead><tbody>"),
                F.array_join(F.transform("rows", lambda r: r["html"]), ""),
                F.lit("</tbody></table></body></html>"),
            ).cast("binary").alias("html"),
            F.lit(_FETCHED).cast("timestamp_ntz").alias("fetched_at"),
        )
    )


_PAGES = f"""
paged AS (SELECT *, CAST(floor(post_id / {PER_PAGE}) AS INTEGER) AS page FROM posts),
verdicts AS (
  SELECT board_id, page,
         arg_min(CASE WHEN post_id < 1 THEN 'url post' WHEN is_notice THEN 'recommendations' END,
                 post_id) FILTER (post_id < 1 OR is_notice) AS reject_reason
  FROM paged GROUP BY board_id, page)"""


@query(
    "SRC-7",
    f"WITH {t.POSTS},{_PAGES} SELECT * FROM verdicts",
)
def list_page_verdicts(spark, folder):
    parsed = pages.parse_list_pages(_list_pages(spark, folder), t.SITE)
    return parsed.select("board_id", "page", "reject_reason")


@query(
    "SRC-7 FLT-2 FLT-6 FLT-8",
    f"""WITH {t.POSTS},{_PAGES}
SELECT p.board_id, p.page, p.post_id, p.analysis_unit, p.title,
       date_trunc('day', p.published_at) - INTERVAL 9 HOURS AS published_at, p.post_id AS views,
       CAST(3 AS BIGINT) AS recommendations, p.post_id % 7 AS comments, p.source_url, p.is_notice,
       p.is_ad
FROM paged p JOIN verdicts v ON v.board_id = p.board_id AND v.page = p.page
WHERE v.reject_reason IS NULL AND p.analysis_unit <> 'machinery'""",
)
def page_records(spark, folder):
    """Records of the accepted list pages; one segment has no unit and is dropped."""
    unit_map = t.load(spark, folder, "customer").where(
        F.col("c_mktsegment") != "MACHINERY"
    ).select(
        F.col("c_nationkey").cast("int").alias("board_id"),
        F.lower("c_mktsegment").alias("category"), F.lower("c_mktsegment").alias("unit"),
    ).distinct()
    rows = pages.list_records(pages.parse_list_pages(_list_pages(spark, folder), t.SITE), unit_map)
    return rows.select(
        "board_id", "page", "post_id", "analysis_unit", "title", "published_at", "views",
        "recommendations", "comments", "source_url", "is_notice", "is_ad",
    )


@query(
    "SRC-7",
    "SELECT page_id, 'header missing' AS reject_reason FROM pages",
)
def raw_page_rejects(spark, folder):
    """The supplied web pages hold no list table, so each is refused."""
    raw = t.load(spark, folder, "pages").select(
        "page_id", F.lit(1).alias("board_id"), F.col("html").cast("binary").alias("html"),
        F.lit(_FETCHED).cast("timestamp_ntz").alias("fetched_at"),
    )
    return pages.parse_list_pages(raw, t.SITE).select("page_id", "reject_reason")


def _payloads(spark, folder):
    """Comment payloads: the lines of each turn, every line twice, one with a bad id."""
    turns = t.load(spark, folder, "conversations")
    lines = F.split("text", "\n")
    listed = F.transform(
        F.concat(lines, lines),
        lambda line, i: F.struct(
            F.struct(
                F.when(i == 0, "bad").otherwise((i % F.size(lines)).cast("string")).alias("cmtidx")
            ).alias("__attr__"),
            F.lit("now").alias("o_date"), F.concat(F.lit("<p>"), line, F.lit("</p>")).alias("o_comment"),
        ),
    )
    payload = F.to_json(F.struct(
        F.when(F.col("role") == "system", "many").otherwise(F.size(lines).cast("string"))
        .alias("cmtcount"),
        F.array(F.struct(listed.alias("list"))).alias("commentlist"),
    ))
    return turns.select(
        F.col("conv_id").alias("board_id"), F.col("turn").alias("post_id"), payload.alias("payload")
    )


_LINES = """
turn_lines AS (
  SELECT conv_id AS board_id, turn AS post_id, role, len(string_split(text, chr(10))) AS n,
         unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS i
  FROM conversations),
kept AS (
  SELECT board_id, post_id, i AS comment_id, i AS parent_id, 'now' AS published_at,
         trim(regexp_replace(line, '\\s+', ' ', 'g')) AS text
  FROM turn_lines WHERE role <> 'system' AND trim(regexp_replace(line, '\\s+', ' ', 'g')) <> '')"""


@query("SRC-9", f"WITH {_LINES} SELECT * FROM kept")
def comment_explode(spark, folder):
    return comments.parse_comments(_payloads(spark, folder))[0]


@query(
    "SRC-9",
    f"""WITH {_LINES},
counts AS (SELECT board_id, post_id, count(*) AS parsed FROM kept GROUP BY ALL)
SELECT c.conv_id AS board_id, c.turn AS post_id,
       CASE WHEN role <> 'system' THEN len(string_split(text, chr(10))) END AS reported_count,
       coalesce(k.parsed, 0) AS parsed_count,
       CASE WHEN role <> 'system' THEN coalesce(k.parsed, 0) = len(string_split(text, chr(10))) END
         AS complete,
       CASE WHEN role = 'system' THEN 'invalid payload' END AS error
FROM conversations c LEFT JOIN counts k ON k.board_id = c.conv_id AND k.post_id = c.turn""",
)
def comment_completeness(spark, folder):
    return comments.parse_comments(_payloads(spark, folder))[1]


# --- sinks and streams --------------------------------------------------------------------------


@query(
    "SRC-5 SRC-2",
    f"""WITH {t.LATEST}
SELECT l.board_id::BIGINT AS board_id, n_name AS board_name, l.post_id, l.analysis_unit, l.title,
       l.published_at, l.source_url, l.views, l.recommendations, l.comments
FROM latest l JOIN nation ON n_nationkey = l.board_id""",
)
def release_roundtrip(spark, folder):
    """A release written, verified by its checksums, and read back under its contracts."""
    return _released(spark, folder)["latest_post_metrics"].select(
        "board_id", "board_name", "post_id", "analysis_unit", "title", "published_at", "source_url",
        "views", "recommendations", "comments",
    )


def _released(spark, folder):
    """All four datasets of a release as read back."""
    version = F.lit(t.VERSION)
    # Two datasets are written from the posts, so they are joined once.
    posts = materialize(ranking.latest_metrics(
        t.posts(spark, folder), t.snapshots(spark, folder), t.boards(spark, folder)
    ).select(
        "board_id", "board_name", "post_id", "analysis_unit", "title", "published_at", "source_url",
        F.col("category").alias("current_category"), F.col("slot").alias("observed_at_slot_kst"),
        F.col("observed_at").alias("observed_at_actual"), "views", "recommendations", "comments",
        "config_version",
    ), "release-posts")
    ranked = posts.select(
        "analysis_unit", F.lit("views").alias("metric"),
        F.col("observed_at_slot_kst").alias("as_of_slot_kst"), F.col("post_id").alias("rank"),
        "board_id", "post_id", "title", "source_url", F.col("views").alias("metric_value"),
        "config_version",
    )
    runs = t.runs(spark, folder).select(
        "id", "job_type", F.col("slot").alias("scheduled_at_slot_kst"), "status", "config_version",
        "started_at", "finished_at", "diagnostics",
    )
    held = t.quarantine(spark, folder).select(
        "id", "source_kind", "source_ref", "content_hash", F.lit("[]").alias("findings"),
        F.lit(70).alias("risk_score"), F.lit(_FETCHED).cast("timestamp_ntz").alias("quarantined_at"),
        "review_state", "reviewer", "note", "released_at",
    )
    root = scratch_path(spark, "releases")
    bundle.write_release(
        {"latest_post_metrics": posts.withColumn("config_version", version),
         "cumulative_top50": ranked, "collection_runs": runs, "security_quarantine": held},
        root, "20240101-000000",
    )
    return bundle.read_release(spark, root, t.SITE.host)


# What the check compares of each dataset: the rows, and a sum over a digest of their values.
_RELEASE_DIGESTS = {
    "latest_post_metrics": (
        "board_id", "board_name", "post_id", "analysis_unit", "title", "source_url", "views",
        "recommendations", "comments",
    ),
    "cumulative_top50": (
        "analysis_unit", "metric", "rank", "board_id", "post_id", "title", "source_url",
        "metric_value",
    ),
    "collection_runs": ("id", "job_type", "status"),
    "security_quarantine": (
        "id", "source_kind", "source_ref", "content_hash", "findings", "risk_score",
        "review_state", "reviewer", "note",
    ),
}


def _release_digest_sql(name: str, source: str) -> str:
    values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in _RELEASE_DIGESTS[name])
    digest_ = f"CAST('0x' || substr(md5(concat_ws('|', {values})), 1, 10) AS BIGINT)"
    return (
        f"SELECT '{name}' AS dataset, count(*) AS n, CAST(sum({digest_}) AS BIGINT) AS digest "
        f"FROM ({source})"
    )


@query(
    "SRC-5 SRC-2 SRC-3",
    f"""WITH {t.LATEST},{t.RUNS},{t.QUARANTINE},
posts_out AS (
  SELECT l.board_id, n_name AS board_name, l.post_id, l.analysis_unit, l.title, l.source_url,
         l.views, l.recommendations, l.comments
  FROM latest l JOIN nation ON n_nationkey = l.board_id)
"""
    + " UNION ALL ".join(
        _release_digest_sql(name, source) for name, source in (
            ("latest_post_metrics", "SELECT * FROM posts_out"),
            ("cumulative_top50",
             "SELECT *, 'views' AS metric, post_id AS rank, views AS metric_value FROM posts_out"),
            ("collection_runs", "SELECT * FROM runs"),
            ("security_quarantine",
             "SELECT *, '[]' AS findings, 70 AS risk_score FROM quarantine"),
        )
    ),
)
def release_datasets(spark, folder):
    """Rows and digests of all four datasets of a release, read back."""
    read = _released(spark, folder)

    def digested(name):
        values = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in _RELEASE_DIGESTS[name]]
        digits = F.substring(F.md5(F.concat_ws("|", *values)), 1, 10)
        return read[name].agg(
            F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n"),
            F.sum(F.conv(digits, 16, 10).cast("bigint")).alias("digest"),
        )

    frames = [digested(name) for name in _RELEASE_DIGESTS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2]).unionByName(frames[3])


@query(
    "SRC-6 SRC-4",
    f"""WITH {t.THREADS},{t.LABELS}
SELECT board_id, post_id, body_sentiment, topic, 'sample-v1' AS model_version FROM labelled""",
)
def artifact_roundtrip(spark, folder):
    """Labels stored as an artifact and read back through its manifest."""
    from forumtide.operators import lexicon, semantic
    from forumtide.operators.merge import POST_KEY

    posts, notes = t.threads(spark, folder)
    counts = notes.groupBy(*POST_KEY).agg(F.count(F.lit(1)).alias("n"))
    candidates = posts.join(counts, list(POST_KEY), "left").select(
        *POST_KEY, "analysis_unit", "title",
        F.lit(_FETCHED).cast("timestamp_ntz").alias("published_at"), F.lit("").alias("source_url"),
        F.lit("views").alias("selection_reason"), F.lit(0).alias("views"),
        F.lit(0).alias("recommendations"), F.coalesce("n", F.lit(0)).alias("comments"),
    )
    bodies = posts.select(
        *POST_KEY, "body", F.lit(0).cast("bigint").alias("reported_count"),
        F.lit(None).cast("string").alias("error"),
    )
    batch = semantic.label_threads(candidates, bodies, notes, t.SAMPLE_LEXICON)
    root = scratch_path(spark, "artifact")
    artifact.write_artifact(
        batch.posts, batch.comments, root, "sha-of-source", SELECTION_POLICY,
        t.SAMPLE_LEXICON.version, True, _FETCHED,
    )
    stored, _ = artifact.read_artifact(spark, root, "sha-of-source")
    return stored.select(*POST_KEY, "body_sentiment", "topic", "model_version")


def _either(folder, name):
    """Path pattern of one supplied table, whether it is a file or a folder of part files.

    A stream takes a single file only by a pattern, so the last letter is one.
    """
    return f"{folder.rstrip('/')}/{name}.parque[t]"


def _stream(spark, folder, name):
    """One of the supplied tables as a file stream."""
    return spark.readStream.schema(t.SCHEMAS[name]).parquet(_either(folder, name))


@query(
    "STR-1",
    f"""SELECT {t.SLOT} AS slot, user_id, CAST(floor(max(value)) AS BIGINT) AS views,
       CAST(floor(max(value * 2)) AS BIGINT) AS recommendations,
       CAST(floor(max(value * 3)) AS BIGINT) AS comments
FROM events GROUP BY ALL""",
)
def slot_stream(spark, folder):
    """Slot snapshots of the event stream, reduced per batch and merged on read."""
    counted = _stream(spark, folder, "events").select(
        "ts", "user_id", F.floor("value").cast("bigint").alias("views"),
        F.floor(F.col("value") * 2).cast("bigint").alias("recommendations"),
        F.floor(F.col("value") * 3).cast("bigint").alias("comments"),
    )
    path = scratch_path(spark, "slots")
    slots.run_to_folder(
        counted, path, scratch_path(spark, "slots-state"),
        lambda batch: slots.slot_snapshots(batch, "ts", ("user_id",)),
    )
    return slots.read_slots(spark, path, ("user_id",))


@query("STR-4", "SELECT event_id, user_id, event_type FROM events")
def replay_stream(spark, folder):
    """Every event sent three times; whatever was stored before is not stored again."""
    events = _stream(spark, folder, "events").withColumn(
        "copy", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3)))
    )
    path = scratch_path(spark, "replays")
    slots.store_once(
        events.select("event_id", "user_id", "event_type", "ts"), path, ("event_id",), "ts",
        scratch_path(spark, "replays-state"),
    )
    return spark.read.parquet(path).select("event_id", "user_id", "event_type")


def _observation_stream(spark, folder):
    """Line items as a stream of observations, joined to the posts as a static table."""
    lines = _stream(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("post_id"), F.col("l_shipdate").alias("slot"),
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("observed_at"),
        F.floor("l_extendedprice").cast("bigint").alias("views"),
        F.floor("l_quantity").cast("bigint").alias("recommendations"),
        (F.col("l_linenumber") - 1).cast("bigint").alias("comments"), "l_returnflag",
    )
    return lines.join(t.posts(spark, folder), "post_id").withColumn(
        "title", F.concat("title", F.lit(" "), "l_returnflag")
    ).withColumn("config_version", F.lit(t.VERSION)).drop("l_returnflag")


def _upserted(spark, folder):
    posts = slots.post_table(spark, scratch_path(spark, "posts"))
    snapshots = slots.snapshot_table(spark, scratch_path(spark, "snapshots"))
    query_ = slots.upsert_stream(
        _observation_stream(spark, folder), posts, snapshots, scratch_path(spark, "upsert-state")
    )
    query_.awaitTermination()
    return posts, snapshots


@query("STR-2", QUERIES["canonical_posts"].sql)
def upsert_stream_posts(spark, folder):
    """The post table a stream of observations leaves behind."""
    posts, _ = _upserted(spark, folder)
    posts.compact()
    return posts.read()


@query(
    "STR-2",
    f"""WITH {t.OBSERVATIONS}
SELECT board_id, post_id, slot, max(observed_at) AS observed_at, max(views) AS views,
       max(recommendations) AS recommendations, max(comments) AS comments
FROM observations GROUP BY ALL""",
)
def upsert_stream_snapshots(spark, folder):
    """The snapshot table a stream of observations leaves behind."""
    _, snapshots = _upserted(spark, folder)
    return snapshots.read().drop("config_version", "slot_month")


@query(
    "STR-5",
    """SELECT doc_id, lang, regexp_matches(text, '(?i)licensed under (?:the )?[a-z-]+')
  OR regexp_matches(text, '(?i)token = "[0-9a-f]{8,}"') AS quarantined FROM documents""",
)
def screened_stream(spark, folder):
    """Documents screened as they stream in: one pass, both branches stored apart."""
    path = scratch_path(spark, "screened")
    slots.run_to_folder(
        _stream(spark, folder, "documents"), path, scratch_path(spark, "screened-state"),
        lambda batch: slots.screened(batch, "text", t.SAMPLE_RULES, 60).select(
            "doc_id", "lang", "quarantined"
        ),
        "quarantined",
    )
    # The branch is a folder name, which is read back as text.
    return spark.read.parquet(path).select(
        "doc_id", "lang", F.col("quarantined").cast("boolean").alias("quarantined")
    )


@query(
    "STR-3",
    """SELECT o_orderstatus, count(*) AS orders, CAST(round(sum(o_totalprice)) AS BIGINT) AS total
FROM orders GROUP BY o_orderstatus""",
)
def release_stream(spark, folder):
    """A summary written by the trigger that a newly completed folder sets off."""
    out = scratch_path(spark, "summaries")

    def summarise(found: str) -> None:
        # A table of part files is announced by its own folder.
        release = found.removesuffix("/orders.parquet")
        orders = t.load(spark, release, "orders")
        orders.groupBy("o_orderstatus").agg(
            F.count(F.lit(1)).alias("orders"),
            F.round(F.sum("o_totalprice")).cast("bigint").alias("total"),
        ).write.mode("overwrite").parquet(out)

    # The orders stand for the marker that completes the folder.
    slots.on_new_release(
        spark, _either(folder, "orders"), scratch_path(spark, "releases-state"), summarise,
        scratch_path(spark, "release-ledger"), "*.parquet",
    ).awaitTermination()
    return spark.read.parquet(out)

"""Queries over text: normal forms, screening, lexicon labels, summaries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from forumtide.functions.text import digest, nfkc, normal_form
from forumtide.operators import lexicon, metrics, screening, semantic
from forumtide.operators.merge import POST_KEY
from forumtide.plans import tables as t
from forumtide.plans.catalog import query
from forumtide.registry import (
    DOMAIN_LEXICON,
    INTENT_LABELS,
    SENTIMENT_LABELS,
    Lexicon,
)
from forumtide.session import scratch_path

LEX = t.SAMPLE_LEXICON
NOW = datetime(2024, 2, 1, tzinfo=timezone.utc)
SECOND_LEXICON = Lexicon(
    version="sample-v2", positive=LEX.negative, negative=LEX.positive,
    intents=tuple(reversed(LEX.intents)), topics=tuple(reversed(LEX.topics)),
    default_intent=LEX.default_intent, default_topic=LEX.default_topic,
)


@query("FN-1", f"SELECT doc_id, sha256({t.sql_fold('text')}) AS normal_hash FROM documents")
def text_normal_form(spark, folder):
    return t.load(spark, folder, "documents").select(
        "doc_id", digest(normal_form(F.col("text"))).alias("normal_hash")
    )


@query("FN-5", "SELECT conv_id, turn, sha256(text) AS digest FROM conversations")
def text_digest(spark, folder):
    return t.load(spark, folder, "conversations").select(
        "conv_id", "turn", digest(nfkc(F.col("text"))).alias("digest")
    )


_N = t.sql_fold("body")


@query(
    "TXT-4",
    f"""WITH {t.DOCUMENTS}, n AS (SELECT post_id, {_N} AS n FROM docs)
SELECT post_id, {t.sql_sentiment('n')} AS sentiment, {t.sql_confidence('n')} AS confidence,
       {t.sql_evidence('n', ',')} AS evidence FROM n""",
)
def lexicon_labels(spark, folder):
    rows = lexicon.label_sentiment(t.documents(spark, folder), "body", LEX)
    return rows.select(
        "post_id", "sentiment", "confidence", F.array_join("evidence_terms", ",").alias("evidence")
    )


@query(
    "TXT-5",
    f"""WITH {t.DOCUMENTS}, n AS (SELECT post_id, {t.sql_fold("title || ' ' || body")} AS n FROM docs)
SELECT post_id, {t.sql_strongest('n', LEX.intents, LEX.default_intent)} AS intent,
       {t.sql_strongest('n', LEX.topics, LEX.default_topic)} AS topic FROM n""",
)
def strongest_label(spark, folder):
    rows = t.documents(spark, folder)
    text = F.concat_ws(" ", "title", "body")
    return lexicon.label_context(rows, text, LEX).select("post_id", "intent", "topic")


@query("AGG-7", f"WITH {t.THREADS},{t.LABELS} SELECT * FROM reactions")
def comment_reaction(spark, folder):
    comments = lexicon.label_sentiment(t.threads(spark, folder)[1], "text", LEX)
    return lexicon.comment_reaction(comments, POST_KEY)


def _labelled(spark, folder):
    posts, comments = t.threads(spark, folder)
    return lexicon.label_posts(posts, comments, POST_KEY, LEX)


@query(
    "TXT-6",
    f"""WITH {t.THREADS},{t.LABELS}
SELECT board_id, post_id, body_sentiment, comment_reaction, intent, topic, confidence,
       evidence_terms, 'sample-v1' AS model_version FROM labelled""",
)
def post_labels(spark, folder):
    return _labelled(spark, folder).select(
        *POST_KEY, "body_sentiment", "comment_reaction", "intent", "topic", "confidence",
        F.array_join("evidence_terms", " · ").alias("evidence_terms"), "model_version",
    )


@query(
    "AGG-5",
    f"""WITH {t.THREADS},{t.LABELS}
SELECT topic AS label, count(*) AS count, count(*) / (SELECT count(*) FROM labelled) AS share
FROM labelled GROUP BY topic""",
)
def label_distribution(spark, folder):
    return metrics.distribution(_labelled(spark, folder), "topic")


@query(
    "AGG-6",
    f"""WITH {t.THREADS},{t.LABELS}
SELECT avg(CAST(body_sentiment IN ('negative', 'mixed') AS DOUBLE)) AS share FROM labelled""",
)
def negative_share(spark, folder):
    return metrics.negative_share(_labelled(spark, folder), "body_sentiment")


# --- screening ----------------------------------------------------------------------------------


def _sql_findings(source: str, keys: str) -> str:
    parts = []
    for rule in t.SAMPLE_RULES:
        pattern = "(?i)" + rule.pattern
        parts.append(
            f"SELECT {keys}, '{rule.rule_id}' AS rule_id, {rule.score} AS score, "
            f"regexp_extract(text, '{pattern}') AS m FROM {source}"
        )
    return f"found AS (SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE m <> '')"


_ESCAPED = (
    "replace(replace(replace(replace(replace(left(m, 160), '&', '&amp;'), '<', '&lt;'), "
    "'>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
)
_DOC_FOUND = _sql_findings("documents", "doc_id")


@query(
    "TXT-1 FN-6",
    f"""WITH {_DOC_FOUND}
SELECT doc_id, rule_id, score, sha256(m) AS evidence_hash, {_ESCAPED} AS escaped_evidence,
       CAST(least(100, sum(score) OVER (PARTITION BY doc_id)) AS INTEGER) AS risk_score FROM found""",
)
def scan_findings(spark, folder):
    rows = screening.scan(t.load(spark, folder, "documents"), "text", t.SAMPLE_RULES)
    return rows.select("doc_id", "risk_score", F.explode("findings").alias("f")).select(
        "doc_id", "f.rule_id", "f.score", "f.evidence_hash", "f.escaped_evidence", "risk_score"
    )


@query(
    "TXT-1",
    """SELECT lang, count(*) AS texts, CAST(0 AS BIGINT) AS flagged FROM documents GROUP BY lang""",
)
def prompt_screening(spark, folder):
    """The built-in prompt rules over every document; the supplied texts are all clean."""
    rows = screening.scan(t.load(spark, folder, "documents"), "text")
    return rows.groupBy("lang").agg(
        F.count(F.lit(1)).alias("texts"), F.count_if(F.col("risk_score") > 0).alias("flagged")
    )


def _flagged(spark, folder):
    texts = t.load(spark, folder, "documents").select(
        F.concat(F.lit("post:2:"), F.col("doc_id").cast("string")).alias("source_ref"), "text"
    )
    known = screening.quarantine_rows(
        texts.where(F.col("text").contains("token")), "body", NOW, t.SAMPLE_RULES, 70
    )
    return screening.quarantine_rows(texts, "body", NOW, t.SAMPLE_RULES, 40, existing=known)


@query(
    "TXT-2",
    f"""WITH {_DOC_FOUND},
scored AS (SELECT d.doc_id, d.text, CAST(least(100, sum(f.score)) AS INTEGER) AS risk_score,
                  string_agg(f.rule_id, ',' ORDER BY f.rule_id) AS rules
           FROM documents d JOIN found f ON f.doc_id = d.doc_id GROUP BY ALL),
rows AS (SELECT 'body' AS source_kind, 'post:2:' || doc_id AS source_ref,
                sha256(text) AS content_hash, risk_score, rules, text FROM scored WHERE risk_score >= 40)
SELECT DISTINCT sha256(source_kind || chr(10) || source_ref || chr(10) || content_hash) AS id,
       source_kind, source_ref, content_hash, risk_score, rules, 'pending' AS review_state
FROM rows WHERE NOT (contains(text, 'token') AND risk_score >= 70)""",
)
def quarantine_rows(spark, folder):
    rows = _flagged(spark, folder)
    rules = F.sort_array(F.transform("findings", lambda f: f["rule_id"]))
    return rows.select(
        "id", "source_kind", "source_ref", "content_hash", "risk_score",
        F.array_join(rules, ",").alias("rules"), "review_state",
    )


@query(
    "TXT-2",
    f"""WITH {_DOC_FOUND},
scored AS (SELECT d.doc_id, d.text, d.lang, CAST(least(100, sum(f.score)) AS INTEGER) AS risk_score,
                  string_agg(f.rule_id, ',' ORDER BY f.rule_id) AS rules
           FROM documents d JOIN found f ON f.doc_id = d.doc_id GROUP BY ALL)
SELECT 'body' AS source_kind, sha256(text) AS content_hash, count(*) AS texts,
       count(DISTINCT CASE WHEN lang = 'de' THEN ' ' || doc_id END)
         + max(CASE WHEN lang = 'fr' THEN 1 ELSE 0 END) AS source_refs,
       any_value(risk_score) AS risk_score, any_value(rules) AS rules
FROM scored WHERE risk_score >= 40 AND lang IN ('fr', 'de') GROUP BY text""",
)
def unnamed_quarantine(spark, folder):
    """Harmful documents whose reference is missing (fr) or untrimmed (de)."""
    lang, number = F.col("lang"), F.col("doc_id").cast("string")
    ref = F.when(lang == "fr", F.lit(None)).when(lang == "de", F.concat(F.lit(" "), number))
    texts = t.load(spark, folder, "documents").select(
        ref.otherwise(number).alias("source_ref"), "text"
    )
    rows = screening.unnamed_quarantine(texts, "body", NOW, t.SAMPLE_RULES, 40)
    rules = F.sort_array(F.transform("findings", lambda f: f["rule_id"]))
    return rows.select(
        "source_kind", "content_hash", "texts", "source_refs", "risk_score",
        F.array_join(rules, ",").alias("rules"),
    )


def _decisions(spark, folder):
    """Review decisions over the quarantine: one per order, some twice, some for no row."""
    orders, customers = t.load(spark, folder, "orders"), t.load(spark, folder, "customer")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    ref = F.concat(
        F.lit("post:"), F.col("c_nationkey").cast("string"), F.lit(":"),
        F.col("o_orderkey").cast("string"),
    )
    base = rows.select(
        (F.col("o_orderkey") * 2).alias("seq"), digest(ref).alias("id"),
        F.concat(F.lit("clerk "), F.when(F.col("c_acctbal") > 5000, F.col("o_orderstatus"))
                 .otherwise("O")).alias("reviewer"),
        F.when(F.col("c_acctbal") < 0, " checked").otherwise("checked").alias("note"),
        "o_orderstatus",
    )
    again = base.select(
        (F.col("seq") + 1).alias("seq"), "id",
        F.when(F.col("o_orderstatus") == "F", "other clerk").otherwise(F.col("reviewer"))
        .alias("reviewer"), "note", "o_orderstatus",
    )
    return base.unionByName(again).drop("o_orderstatus")


_DECISIONS = """
base AS (
  SELECT o_orderkey * 2 AS seq, sha256('post:' || c_nationkey || ':' || o_orderkey) AS id,
         'clerk ' || CASE WHEN c_acctbal > 5000 THEN o_orderstatus ELSE 'O' END AS reviewer,
         CASE WHEN c_acctbal < 0 THEN ' checked' ELSE 'checked' END AS note, o_orderstatus
  FROM orders JOIN customer ON o_custkey = c_custkey),
decisions AS (
  SELECT seq, id, reviewer, note FROM base
  UNION ALL
  SELECT seq + 1, id, CASE WHEN o_orderstatus = 'F' THEN 'other clerk' ELSE reviewer END, note FROM base),
firsts AS (
  SELECT id, min(seq) AS first_seq, arg_min(reviewer, seq) AS first_reviewer,
         arg_min(note, seq) AS first_note
  FROM decisions WHERE note = trim(note) GROUP BY id),
outcomes AS (
  SELECT d.seq, d.id, d.reviewer, d.note,
    CASE WHEN d.note <> trim(d.note) THEN 'invalid' WHEN q.id IS NULL THEN 'not_found'
         WHEN q.review_state = 'released' AND q.reviewer = d.reviewer AND q.note = d.note
           THEN 'replayed'
         WHEN q.review_state = 'pending' AND d.seq = f.first_seq THEN 'released'
         WHEN q.review_state = 'pending' AND d.reviewer = f.first_reviewer
              AND d.note = f.first_note THEN 'replayed'
         ELSE 'conflict' END AS outcome
  FROM decisions d LEFT JOIN quarantine q ON q.id = d.id LEFT JOIN firsts f ON f.id = d.id)"""


def _outcomes(spark, folder):
    return screening.review_outcomes(_decisions(spark, folder), t.quarantine(spark, folder))


@query("TXT-3", f"WITH {t.QUARANTINE},{_DECISIONS} SELECT * FROM outcomes")
def review_outcomes(spark, folder):
    return _outcomes(spark, folder)


@query(
    "TXT-3",
    f"""WITH {t.QUARANTINE},{_DECISIONS},
done AS (SELECT * FROM outcomes WHERE outcome = 'released')
SELECT q.id, CASE WHEN d.id IS NULL THEN q.review_state ELSE 'released' END AS review_state,
       coalesce(d.reviewer, q.reviewer) AS reviewer, coalesce(d.note, q.note) AS note,
       CASE WHEN d.id IS NULL THEN q.released_at ELSE TIMESTAMP '2024-02-01' END AS released_at
FROM quarantine q LEFT JOIN done d ON d.id = q.id""",
)
def reviewed_quarantine(spark, folder):
    held = t.quarantine(spark, folder)
    return screening.apply_reviews(held, _outcomes(spark, folder), NOW).select(
        "id", "review_state", "reviewer", "note", "released_at"
    )


@query(
    "TXT-3",
    f"""WITH {t.QUARANTINE},{_DECISIONS},
tasks AS (
  SELECT 'released-analysis:' || q.id || ':v1' AS task_key,
         '{{"quarantine_id":"' || q.id || '","source_kind":"title","source_ref":"' || q.source_ref
           || '"}}' AS payload
  FROM quarantine q WHERE q.id IN (SELECT id FROM outcomes WHERE outcome IN ('released', 'replayed')))
SELECT task_key, 'released_analysis' AS kind, 'pending' AS state, payload,
       sha256(payload) AS payload_hash, TIMESTAMP '2024-02-01' AS available_at FROM tasks""",
)
def release_tasks(spark, folder):
    none = spark.createDataFrame([], "task_key STRING")
    return screening.release_tasks(
        t.quarantine(spark, folder), _outcomes(spark, folder), none, NOW
    )


# --- semantic batch -----------------------------------------------------------------------------


def _thread_inputs(spark, folder):
    """Candidates, bodies and comments of all conversations; system threads have no body."""
    posts, comments = t.threads(spark, folder)
    counts = comments.groupBy(*POST_KEY).agg(F.count(F.lit(1)).alias("n"))
    joined = posts.join(counts, list(POST_KEY), "left").withColumn(
        "n", F.coalesce("n", F.lit(0).cast("bigint"))
    )
    candidates = joined.select(
        *POST_KEY, "analysis_unit", "title",
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("published_at"),
        t.SITE.article_url(F.col("board_id"), F.col("post_id")).alias("source_url"),
        F.lit("comments").alias("selection_reason"),
        F.char_length("body").cast("bigint").alias("views"), F.col("n").alias("recommendations"),
        F.col("n").alias("comments"),
    )
    bodies = joined.select(
        *POST_KEY, F.when(F.col("analysis_unit") != "system", F.col("body")).alias("body"),
        F.when(F.col("n") > 5, F.col("n") + 1).otherwise(F.col("n")).alias("reported_count"),
        F.lit(None).cast("string").alias("error"),
    )
    return candidates, bodies, comments


def _batch(spark, folder):
    return semantic.label_threads(*_thread_inputs(spark, folder), LEX, t.SAMPLE_RULES, 60)


_BLOCK = " OR ".join(
    f"regexp_matches(text, '(?i){rule.pattern}')" for rule in t.SAMPLE_RULES if rule.score >= 60
)
# Threads whose body or comments are blocked, in the terms of the thread check SQL.
_SEMANTIC = f"""
all_threads AS (
  SELECT 1 AS board_id, conv_id AS post_id, role AS analysis_unit, 'Thread ' || conv_id AS title,
         text AS body, {_BLOCK} AS blocked
  FROM conversations WHERE turn = 0),
all_comments AS (
  SELECT 1 AS board_id, conv_id AS post_id, turn AS comment_id, role AS published_at, text,
         {_BLOCK} AS blocked
  FROM conversations WHERE turn > 0),
threads AS (SELECT * FROM all_threads WHERE analysis_unit <> 'system' AND NOT blocked),
thread_comments AS (
  SELECT c.* FROM all_comments c
  WHERE NOT c.blocked AND c.post_id IN (SELECT post_id FROM threads)),
{t.LABELS},
sizes AS (
  SELECT l.*, (SELECT count(*) FROM all_comments c WHERE c.post_id = l.post_id) AS n,
         (SELECT count(*) FROM thread_comments c WHERE c.post_id = l.post_id) AS kept
  FROM labelled l)"""


@query(
    "TXT-7",
    f"""WITH {_SEMANTIC}
SELECT board_id, post_id, analysis_unit, title, length(body) AS views, n AS comment_count,
       kept AS analyzed_comment_count, n <= 5 AS comments_complete, body_sentiment,
       comment_reaction, intent, topic, confidence, evidence_terms, left(body, 500) AS body_excerpt,
       'sample-v1' AS model_version FROM sizes""",
)
def semantic_posts(spark, folder):
    return _batch(spark, folder).posts.select(
        "board_id", "post_id", "analysis_unit", "title", "views", "comment_count",
        "analyzed_comment_count", "comments_complete", "body_sentiment", "comment_reaction",
        "intent", "topic", "confidence", "evidence_terms", "body_excerpt", "model_version",
    )


@query(
    "TXT-7",
    f"""WITH {_SEMANTIC}
SELECT board_id, post_id, comment_id, comment_id AS parent_id, published_at,
       left(text, 500) AS text, sentiment, 'sample-v1' AS model_version FROM comment_labels""",
)
def semantic_comments(spark, folder):
    return _batch(spark, folder).comments


@query(
    "AGG-9",
    f"""WITH {_SEMANTIC}
SELECT (SELECT count(*) FROM all_threads) AS selected_posts,
       (SELECT count(*) FROM all_threads) AS fetched_posts,
       (SELECT count(*) FROM labelled) AS analyzed_posts,
       (SELECT count(*) FROM comment_labels) AS analyzed_comments,
       (SELECT count(*) FROM all_threads WHERE analysis_unit <> 'system' AND blocked)
         + (SELECT count(*) FROM all_comments c WHERE blocked
            AND c.post_id IN (SELECT post_id FROM threads)) AS quarantined_items,
       (SELECT count(*) FROM all_threads WHERE analysis_unit = 'system') AS failed_posts,
       (SELECT count(*) FROM all_threads WHERE analysis_unit = 'system') = 0 AS complete""",
)
def refresh_counters(spark, folder):
    candidates, bodies, comments = _thread_inputs(spark, folder)
    batch = semantic.label_threads(candidates, bodies, comments, LEX, t.SAMPLE_RULES, 60)
    return semantic.refresh_counters(candidates, candidates, batch, batch.posts, batch.comments)


_PRIOR = "length(body) > 300"


def _reuse(spark, folder):
    candidates = _thread_inputs(spark, folder)[0]
    batch = _batch(spark, folder)
    long = batch.posts.where(F.col("views") > 300)
    return semantic.split_reuse(candidates, long, batch.comments)


@query(
    "JOIN-7",
    f"""WITH {_SEMANTIC}, prior AS (SELECT post_id FROM labelled WHERE {_PRIOR})
SELECT board_id, post_id, 'reused' AS state FROM labelled WHERE {_PRIOR}
UNION ALL
SELECT board_id, post_id, 'missing' FROM all_threads
WHERE post_id NOT IN (SELECT post_id FROM prior)""",
)
def reuse_split(spark, folder):
    posts, _, missing = _reuse(spark, folder)
    return posts.select(*POST_KEY, F.lit("reused").alias("state")).unionByName(
        missing.select(*POST_KEY, F.lit("missing").alias("state"))
    )


@query(
    "SET-2 JOIN-7",
    f"""WITH {_SEMANTIC}
SELECT board_id, post_id, body_sentiment, model_version, prior FROM (
  SELECT board_id, post_id, body_sentiment, 'sample-v1' AS model_version, true AS prior
  FROM labelled WHERE {_PRIOR}
  UNION ALL
  SELECT board_id, post_id, body_sentiment, 'sample-v1', NULL FROM labelled WHERE NOT ({_PRIOR}))""",
)
def combined_artifact(spark, folder):
    """Reused rows beside newly labelled ones; columns only one side has are null."""
    reused, _, missing = _reuse(spark, folder)
    _, bodies, comments = _thread_inputs(spark, folder)
    fresh = semantic.label_threads(missing, bodies, comments, LEX, t.SAMPLE_RULES, 60).posts
    both = reused.withColumn("prior", F.lit(True)).unionByName(fresh, allowMissingColumns=True)
    return both.select(*POST_KEY, "body_sentiment", "model_version", "prior")


def _relabel_sql() -> str:
    """The thread labels again, over the whole texts and with the second lexicon."""
    n, c = t.sql_fold("body"), t.sql_fold("title || ' ' || body")
    return f"""
relabelled AS (
  SELECT board_id, post_id, {t.sql_sentiment('n', SECOND_LEXICON)} AS body_sentiment,
         {t.sql_confidence('n', SECOND_LEXICON)} AS confidence,
         {t.sql_strongest('c', SECOND_LEXICON.intents, LEX.default_intent)} AS intent,
         {t.sql_strongest('c', SECOND_LEXICON.topics, LEX.default_topic)} AS topic
  FROM (SELECT *, {n} AS n, {c} AS c FROM threads)),
recounted AS (
  SELECT post_id, count(*) FILTER (s = 'positive') AS p, count(*) FILTER (s = 'negative') AS m,
         count(*) FILTER (s = 'mixed') AS x
  FROM (SELECT post_id, {t.sql_sentiment('k', SECOND_LEXICON)} AS s
        FROM (SELECT post_id, {t.sql_fold('text')} AS k FROM thread_comments))
  GROUP BY post_id)"""


@query(
    "TXT-8",
    f"""WITH {_SEMANTIC},{_relabel_sql()}
SELECT r.board_id, r.post_id, r.body_sentiment, r.confidence, r.intent, r.topic,
       CASE WHEN coalesce(greatest(p, m, x), 0) = 0 THEN 'neutral'
            WHEN CAST(p = greatest(p, m, x) AS INTEGER) + CAST(m = greatest(p, m, x) AS INTEGER)
                 + CAST(x = greatest(p, m, x) AS INTEGER) > 1 THEN 'mixed'
            WHEN p = greatest(p, m, x) THEN 'positive' WHEN m = greatest(p, m, x) THEN 'negative'
            ELSE 'mixed' END AS comment_reaction, 'sample-v2' AS model_version
FROM relabelled r LEFT JOIN recounted c ON c.post_id = r.post_id""",
)
def relabelled_posts(spark, folder):
    batch = _batch(spark, folder)
    posts, _ = semantic.relabel(
        batch.posts, batch.comments, batch.body_texts, batch.comment_texts, SECOND_LEXICON
    )
    return posts.select(
        *POST_KEY, "body_sentiment", "confidence", "intent", "topic", "comment_reaction",
        "model_version",
    )


# Two runs over one source. Candidates are chosen by a counter (the length of the body stands for
# views): the second run has a later range and the second lexicon, so some threads are reused,
# some are new and some are gone.
_FIRST_RANGE, _SECOND_RANGE = "views > 120", "views < 300"
_REFRESHED = f"""WITH {_SEMANTIC},{_relabel_sql()},
wanted AS (
  SELECT post_id FROM (SELECT post_id, length(body) AS views FROM all_threads)
  WHERE {_SECOND_RANGE})"""


def _refreshed(spark, folder):
    from forumtide.operators.refresh import refreshed_artifact
    from forumtide.registry import SELECTION_POLICY

    candidates, bodies, comments = _thread_inputs(spark, folder)
    root, runs = scratch_path(spark, "refreshed"), []
    for hour, (chosen, lex) in enumerate(
        ((_FIRST_RANGE, LEX), (_SECOND_RANGE, SECOND_LEXICON))
    ):
        runs.append(refreshed_artifact(
            root, "sha-of-source", candidates.where(chosen), bodies, comments, lex,
            SELECTION_POLICY, datetime(2024, 2, 1, hour), t.SAMPLE_RULES, 60,
        ))
    return runs


@query(
    "TXT-7 TXT-8 TXT-9 SRC-4 SRC-6 JOIN-7",
    _REFRESHED + """
SELECT r.board_id, r.post_id, r.body_sentiment, r.confidence, r.intent, r.topic,
       CASE WHEN coalesce(greatest(p, m, x), 0) = 0 THEN 'neutral'
            WHEN CAST(p = greatest(p, m, x) AS INTEGER) + CAST(m = greatest(p, m, x) AS INTEGER)
                 + CAST(x = greatest(p, m, x) AS INTEGER) > 1 THEN 'mixed'
            WHEN p = greatest(p, m, x) THEN 'positive' WHEN m = greatest(p, m, x) THEN 'negative'
            ELSE 'mixed' END AS comment_reaction,
       s.kept AS analyzed_comment_count, left(s.body, 500) AS body_excerpt,
       'sample-v2' AS model_version
FROM relabelled r JOIN sizes s ON s.post_id = r.post_id
LEFT JOIN recounted c ON c.post_id = r.post_id
WHERE r.post_id IN (SELECT post_id FROM wanted)""",
)
def refreshed_posts(spark, folder):
    """Stored posts after a second run with another lexicon and other candidates."""
    return _refreshed(spark, folder)[1].posts.select(
        *POST_KEY, "body_sentiment", "confidence", "intent", "topic", "comment_reaction",
        "analyzed_comment_count", "body_excerpt", "model_version",
    )


@query(
    "TXT-7 TXT-8 SRC-6",
    _REFRESHED + f"""
SELECT board_id, post_id, comment_id, left(text, 500) AS text,
       {t.sql_sentiment('n', SECOND_LEXICON)} AS sentiment, 'sample-v2' AS model_version
FROM (SELECT *, {t.sql_fold('text')} AS n FROM thread_comments)
WHERE post_id IN (SELECT post_id FROM wanted)""",
)
def refreshed_comments(spark, folder):
    """Stored comments after the second run."""
    return _refreshed(spark, folder)[1].comments.select(
        *POST_KEY, "comment_id", "text", "sentiment", "model_version"
    )


@query(
    "TXT-9 AGG-9 JOIN-7",
    _REFRESHED + f""",
runs AS (
  SELECT 1 AS run, post_id, true AS chosen, false AS stored
  FROM (SELECT post_id, length(body) AS views FROM all_threads) WHERE {_FIRST_RANGE}
  UNION ALL
  SELECT 2, post_id, true, post_id IN (
    SELECT post_id FROM threads WHERE post_id IN (
      SELECT post_id FROM (SELECT post_id, length(body) AS views FROM all_threads)
      WHERE {_FIRST_RANGE}))
  FROM wanted),
items AS (
  SELECT run, count(*) AS selected_posts, count(*) FILTER (NOT stored) AS fetched_posts,
         count(*) FILTER (post_id IN (SELECT post_id FROM threads)) AS analyzed_posts,
         CAST(coalesce(sum((SELECT kept FROM sizes s WHERE s.post_id = runs.post_id)), 0) AS BIGINT)
           AS analyzed_comments,
         count(*) FILTER (NOT stored AND post_id IN (
           SELECT post_id FROM all_threads WHERE analysis_unit <> 'system' AND blocked))
         + CAST(coalesce(sum((SELECT count(*) FROM all_comments c WHERE blocked
             AND NOT stored AND c.post_id = runs.post_id
             AND c.post_id IN (SELECT post_id FROM threads))), 0) AS BIGINT) AS quarantined_items,
         count(*) FILTER (post_id IN (
           SELECT post_id FROM all_threads WHERE analysis_unit = 'system')) AS failed_posts
  FROM runs GROUP BY run)
SELECT *, failed_posts = 0 AS complete, false AS current FROM items""",
)
def refresh_runs(spark, folder):
    """Counters of the two runs, observed while their results were written."""
    runs = _refreshed(spark, folder)
    counted = [run.counters.withColumn("run", F.lit(i)) for i, run in enumerate(runs, 1)]
    return counted[0].unionByName(counted[1])


@query(
    "TXT-10",
    f"""WITH {t.THREADS},{t.LABELS},
long AS (
  SELECT analysis_unit, unnest(['topic', 'intent', 'body_sentiment', 'comment_reaction']) AS dimension,
         unnest([topic, intent, body_sentiment, comment_reaction]) AS label FROM labelled)
SELECT analysis_unit, dimension, label, count(*) AS count,
       count(*) / sum(count(*)) OVER (PARTITION BY analysis_unit, dimension) AS share
FROM long GROUP BY analysis_unit, dimension, label""",
)
def semantic_distributions(spark, folder):
    return semantic.unit_distributions(_labelled(spark, folder))


@query(
    "TXT-10",
    f"""WITH {_SEMANTIC}
SELECT analysis_unit, count(*) AS posts, CAST(sum(kept) AS BIGINT) AS comments,
       count(*) FILTER (body_sentiment IN ('negative', 'mixed')) / count(*) AS negative_posts,
       count(*) FILTER (comment_reaction IN ('negative', 'mixed')) / count(*) AS negative_reactions,
       count(*) < 5 AS low_sample
FROM sizes GROUP BY analysis_unit""",
)
def semantic_summary(spark, folder):
    batch = _batch(spark, folder)
    return semantic.unit_summary(batch.posts, batch.comments).drop(
        "first_published", "last_published"
    )


def _case(column: str, labels: dict[str, str]) -> str:
    arms = " ".join(f"WHEN '{code}' THEN '{shown}'" for code, shown in labels.items())
    return f"CASE {column} {arms} ELSE {column} END"


@query(
    "TXT-10 FLT-9",
    f"""WITH {_SEMANTIC}
SELECT title, '댓글 상위' AS selection_reason, topic, {_case('intent', INTENT_LABELS)} AS intent,
       {_case('body_sentiment', SENTIMENT_LABELS)} AS body_sentiment,
       {_case('comment_reaction', SENTIMENT_LABELS)} AS comment_reaction,
       CASE WHEN evidence_terms = '' THEN '직접 표현 없음' ELSE evidence_terms END AS evidence_terms,
       kept AS analyzed_comment_count, length(body) AS views
FROM sizes""",
)
def evidence_table(spark, folder):
    return semantic.evidence_table(_batch(spark, folder).posts).drop("recommendations", "source_url")


@query(
    "JOIN-6",
    f"""WITH {t.THREADS}
SELECT c.board_id, c.post_id, c.comment_id FROM thread_comments c
WHERE c.post_id IN (SELECT post_id FROM threads WHERE analysis_unit = 'system')""",
)
def unit_comments(spark, folder):
    posts, comments = t.threads(spark, folder)
    return semantic.unit_comments(posts, comments, "system").select(*POST_KEY, "comment_id")


def _catalogue_sql() -> str:
    names = {"positive": "감성·긍정", "negative": "감성·부정"}
    rows = [("sentiment", 0, names["positive"], DOMAIN_LEXICON.positive),
            ("sentiment", 1, names["negative"], DOMAIN_LEXICON.negative)]
    rows += [("intent", i, f"의도·{INTENT_LABELS[k]}", v)
             for i, (k, v) in enumerate(DOMAIN_LEXICON.intents)]
    rows += [("topic", i, f"주제·{k}", v) for i, (k, v) in enumerate(DOMAIN_LEXICON.topics)]
    values = ", ".join(
        f"('{kind}', {order}, '{rule}', '{' · '.join(terms)}')" for kind, order, rule, terms in rows
    )
    hits = " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, {order} AS label_ord, "
        f"count(*) FILTER ({' OR '.join(f'contains(n, $${fold}$$)' for fold in folds)}) AS documents "
        "FROM normals"
        for kind, order, folds in _catalogue_terms()
    )
    return f"""WITH normals AS (SELECT {t.sql_fold('text')} AS n FROM documents),
hits AS ({hits}),
rules AS (SELECT * FROM (VALUES {values}) v(kind, label_ord, rule, terms))
SELECT r.kind, r.label_ord, r.rule, r.terms, h.documents
FROM rules r JOIN hits h ON h.kind = r.kind AND h.label_ord = r.label_ord"""


def _catalogue_terms():
    from forumtide.functions.text import fold

    groups = [("sentiment", 0, DOMAIN_LEXICON.positive), ("sentiment", 1, DOMAIN_LEXICON.negative)]
    for kind, pairs in (("intent", DOMAIN_LEXICON.intents), ("topic", DOMAIN_LEXICON.topics)):
        groups += [(kind, i, terms) for i, (_, terms) in enumerate(pairs)]
    return [(kind, order, [fold(term) for term in terms]) for kind, order, terms in groups]


@query("TXT-11", _catalogue_sql())
def rule_catalogue(spark, folder):
    """The rule table with the number of documents each rule touches."""
    normals = t.load(spark, folder, "documents").select(normal_form(F.col("text")).alias("n"))
    groups = _catalogue_terms()
    counts = normals.agg(*[
        F.count_if(F.greatest(*[F.col("n").contains(f) for f in folds], F.lit(False)))
        .alias(f"{kind}_{order}")
        for kind, order, folds in groups
    ])
    pairs = F.array(*[
        F.struct(
            F.lit(kind).alias("kind"), F.lit(order).alias("label_ord"),
            F.col(f"{kind}_{order}").alias("documents"),
        )
        for kind, order, _ in groups
    ])
    hits = counts.select(F.explode(pairs).alias("h")).select("h.*")
    rules = lexicon.rule_catalogue(lexicon.lexicon_frame(spark, DOMAIN_LEXICON))
    return rules.join(hits, ["kind", "label_ord"])



"""Explicit schemas of the model tables, as DDL."""

OBSERVATION = (
    "board_id INT, post_id BIGINT, analysis_unit STRING, category STRING, title STRING, "
    "published_at TIMESTAMP_NTZ, views BIGINT, recommendations INT, comments INT, "
    "source_url STRING, is_notice BOOLEAN, is_ad BOOLEAN"
)
POST = (
    "board_id INT, post_id BIGINT, analysis_unit STRING, title STRING, published_at TIMESTAMP_NTZ, "
    "source_url STRING, is_notice BOOLEAN, is_ad BOOLEAN, category STRING, "
    "last_seen_at TIMESTAMP_NTZ"
)
SNAPSHOT = (
    "board_id INT, post_id BIGINT, slot TIMESTAMP_NTZ, observed_at TIMESTAMP_NTZ, views BIGINT, "
    "recommendations BIGINT, comments BIGINT, config_version STRING"
)
RANKING = (
    "analysis_unit STRING, metric STRING, as_of_slot TIMESTAMP_NTZ, rank INT, board_id INT, "
    "post_id BIGINT, metric_value BIGINT, config_version STRING"
)
RUN = (
    "id STRING, job_type STRING, slot TIMESTAMP_NTZ, status STRING, config_version STRING, "
    "started_at TIMESTAMP_NTZ, finished_at TIMESTAMP_NTZ, diagnostics STRING"
)
FINDING = (
    "STRUCT<rule_id: STRING, score: INT, evidence_hash: STRING, escaped_evidence: STRING>"
)
QUARANTINE = (
    "id STRING, source_kind STRING, source_ref STRING, content_hash STRING, "
    f"findings ARRAY<{FINDING}>, risk_score INT, quarantined_at TIMESTAMP_NTZ, "
    "review_state STRING, reviewer STRING, note STRING, released_at TIMESTAMP_NTZ"
)
TASK = (
    "task_key STRING, kind STRING, state STRING, payload STRING, payload_hash STRING, "
    "available_at TIMESTAMP_NTZ"
)
LIST_PAGE = (
    "source_key STRING, board_id INT, page INT, html BINARY, fetched_at TIMESTAMP_NTZ"
)
ARTIFACT_POST = (
    "board_id INT, post_id BIGINT, analysis_unit STRING, title STRING, published_at TIMESTAMP_NTZ, "
    "source_url STRING, selection_reason STRING, views BIGINT, recommendations BIGINT, "
    "comment_count BIGINT, analyzed_comment_count BIGINT, comments_complete BOOLEAN, "
    "body_sentiment STRING, comment_reaction STRING, intent STRING, topic STRING, "
    "confidence DOUBLE, evidence_terms STRING, body_excerpt STRING, model_version STRING"
)
ARTIFACT_COMMENT = (
    "board_id INT, post_id BIGINT, comment_id BIGINT, parent_id BIGINT, published_at STRING, "
    "text STRING, sentiment STRING, model_version STRING"
)

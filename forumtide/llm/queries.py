"""One query per operator over whole tables, and the corpus pipeline, with check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from forumtide.llm import (
    bpe,
    jaccard_tree,
    line_dedup,
    merkle,
    mixing,
    phrases,
    quality_model,
    quality_rules,
    sharding,
    substring_dedup,
    topk,
    url_filters,
    warc,
)
from forumtide.llm.common import table
from forumtide.plans.catalog import Query

LLM_QUERIES: dict[str, Query] = {}


def llm_query(sql: str | None = None):
    """Register a query under its function name."""

    def register(run):
        LLM_QUERIES[run.__name__] = Query(run.__name__, (), run, sql)
        return run

    return register


def load_llm() -> dict[str, Query]:
    return LLM_QUERIES


_RULES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), words AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs
), windows AS (
  SELECT rid, p, array_to_string(w[p : p + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(generate_series(1, len(w) - 7)) AS p FROM words WHERE len(w) >= 8)
), repeated AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, g) AS c FROM windows)
  WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT p + k) AS n_repeat_words
  FROM repeated, (SELECT unnest(range(8)) AS k) GROUP BY rid
), lines AS (
  SELECT rid, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid
), measured AS (
  SELECT rid, doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    CAST(coalesce(list_sum(list_transform(range(CAST(ceil(len(w) / 1000) AS BIGINT)), lambda k:
      len(list_distinct(w[k * 1000 + 1 : k * 1000 + 1000])))), 0) AS BIGINT)
      AS n_window_distinct_words
  FROM words LEFT JOIN covered USING (rid) LEFT JOIN lines USING (rid)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 40 * n_lines
    OR word_chars > 25 * n_words OR 100 * n_window_distinct_words < 20 * n_words) AS kept
FROM judged
"""


@llm_query(_RULES_SQL)
def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.record(quality_rules.measure(table(spark, sf_dir, "documents")))
    return quality_rules.judged(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


_LINES_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
  FROM documents
), lines AS (
  SELECT rid, doc_id, pos, line, key FROM (
    SELECT rid, doc_id, pos, ls[pos] AS line,
      translate(trim(ls[pos], E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT rid, doc_id, ls, unnest(generate_series(1, len(ls))) AS pos FROM docs))
), shared AS (
  SELECT key, max(doc_id) AS last_doc FROM lines
  WHERE length(key) >= 20 AND doc_id IS NOT NULL GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT rid, lines.doc_id, pos, line, coalesce(lines.doc_id <> last_doc, FALSE) AS goes
  FROM lines LEFT JOIN shared ON lines.key = shared.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT goes), ''))
    AS kept_sha256
FROM marked GROUP BY rid, doc_id
"""


@llm_query(_LINES_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


_MIX_SQL = r"""
WITH sizes AS (
  SELECT source, CAST(sum(strlen(coalesce(text, '')) + 1) AS BIGINT) AS size
  FROM documents GROUP BY source
), totals AS (
  SELECT CAST(sum(size) AS DOUBLE) AS total, CAST(count(*) AS DOUBLE) AS weights FROM sizes
), rates AS (
  SELECT source, rate, greatest(1, CAST(ceil(rate / 64) AS BIGINT)) AS parts FROM (
    SELECT source, total * (1.0::DOUBLE / weights) / CAST(size AS DOUBLE) AS rate FROM sizes, totals)
), terms AS (
  SELECT source, rate, parts, k,
    exp(-r + CASE WHEN k = 0 THEN 0 ELSE k * ln(r) - lgamma(CAST(k + 1 AS DOUBLE)) END) AS p
  FROM (SELECT source, rate, parts, r, unnest(range(CAST(ceil(r + 12 * sqrt(r) + 41) AS BIGINT))) AS k
    FROM (SELECT *, rate / parts AS r FROM rates))
), cdf AS (
  SELECT source, rate, parts, list(p ORDER BY k) AS ps FROM (
    SELECT source, rate, parts, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS p FROM terms)
  GROUP BY source, rate, parts
), keyed AS (
  SELECT d.*, rate, ps, parts,
    coalesce(CAST(doc_id AS VARCHAR), 'null:' || md5(coalesce(text, ''))) AS drawn_by
  FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
), drawn AS (
  SELECT *, CAST(list_sum(list_transform(range(parts), lambda i: len(list_filter(ps, lambda p: p <= CAST(
      CAST('0x' || substr(md5('mix-1:' || drawn_by || CASE WHEN i > 0 THEN ':' || i ELSE '' END), 1, 13)
        AS BIGINT) AS DOUBLE) / 4503599627370496)))) AS BIGINT) AS n_copies
  FROM keyed
)
SELECT doc_id, text, lang, source, n_chars, n_copies, copy,
  md5('mix-1:order:' || drawn_by || ':' || copy) AS shuffle_key
FROM (SELECT *, CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy FROM drawn)
"""


@llm_query(_MIX_SQL)
def op2_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(table(spark, sf_dir, "documents"), explain=True).drop("rate")


@llm_query()
def op4_stratified_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.described(table(spark, sf_dir, "documents"))
    return sharding.interleaved(rows, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@llm_query()
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, bpe.public_tokenizer(spark))


@llm_query()
def op3_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = quality_model.fitted(docs, table(spark, sf_dir, "labels"))
    return quality_model.scored(docs, trees)


_WARC_SQL = r"""
WITH records AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS d
  FROM pages
), firsts AS (
  SELECT d, min(page_id) AS first FROM records WHERE payload_bytes >= 100 GROUP BY d
)
SELECT page_id, payload_bytes, records.d AS payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit'
    ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM records LEFT JOIN firsts ON records.d = firsts.d AND payload_bytes >= 100
"""


@llm_query(_WARC_SQL)
def op1_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_TOPK_SQL = r"""
WITH fit AS (
  SELECT vec_id, list_transform(embedding, lambda x:
    CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x:
    x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p:
      coalesce(p[1], 0) * coalesce(p[2], 0))) AS BIGINT) AS score
  FROM fit q, fit c WHERE q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@llm_query(_TOPK_SQL)
def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


_SPANS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT rid, doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) AS g
  FROM (SELECT rid, doc_id, w, unnest(generate_series(1, len(w) - 49)) AS p FROM docs
    WHERE len(w) >= 50)
), firsts AS (
  SELECT g, min(doc_id) AS first FROM windows GROUP BY g HAVING count(*) > 1
), gone AS (
  SELECT rid, list(DISTINCT p + k) AS places
  FROM windows JOIN firsts USING (g), (SELECT unnest(range(50)) AS k)
  WHERE doc_id > first GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
  CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN places IS NULL THEN w ELSE
    list_filter(w, lambda x, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM docs LEFT JOIN gone USING (rid)
"""


@llm_query(_SPANS_SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.deduplicated(table(spark, sf_dir, "documents"))


@llm_query()
def op7_jaccard_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_tree.components(docs, words=4, percent=85).select(
        "doc_id", "n_shingles", "component_id"
    )


_URL_SQL = r"""
WITH rules(action, rule_host, rule_path) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
    ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), rests AS (
  SELECT row_number() OVER () AS rid, page_id, CASE WHEN contains(url, '://')
    THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), hosts AS (
  SELECT rid, page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rests
), parts AS (
  SELECT rid, page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
  FROM hosts
), fitting AS (
  SELECT rid, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(action, length(rule_host || rule_path)) AS action
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
    AND starts_with(path, rule_path)
  GROUP BY rid
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN fitting USING (rid)
"""


@llm_query(_URL_SQL)
def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(table(spark, sf_dir, "pages"), url_filters.rule_table(spark))


_MERKLE_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER () AS rid,
    concat(CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END,
      coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
      CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END)
      AS front,
    CASE WHEN crc32 % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS changed
  FROM (SELECT *, CAST(doc_id AS VARCHAR) AS d, CRC32_OF_D AS crc32 FROM documents)
), leaves AS (
  SELECT rid, doc_id, source, row_number() OVER (PARTITION BY source
      ORDER BY doc_id NULLS FIRST, sha256(front || coalesce(strlen(text) || ':' || text, '-'))) - 1
      AS pos,
    count(*) OVER (PARTITION BY source) AS n,
    sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
    sha256(front || coalesce(strlen(changed) || ':' || changed, '-')) AS probe
  FROM docs
), nodes(tree, source, lvl, pos, n, h) AS (
  SELECT 0, source, 0, pos, n, leaf FROM leaves
  UNION ALL
  SELECT tree, source, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY tree, source, lvl, n, pos // 3
), tops AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos,
    count(*) OVER () AS n
  FROM nodes WHERE n = 1
), upper(lvl, pos, n, h) AS (
  SELECT 0, pos, n, h FROM tops
  UNION ALL
  SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM upper WHERE n > 1 GROUP BY lvl, n, pos // 3
), steps AS (
  SELECT rid, 0 AS tree, lvl, nodes.pos % 3 AS place, nodes.pos < leaves.pos // pow3 AS before, h
  FROM (SELECT *, CAST(3 ** lvl AS BIGINT) AS pow3 FROM nodes) nodes
  JOIN leaves ON leaves.source IS NOT DISTINCT FROM nodes.source
    AND nodes.pos // 3 = leaves.pos // (3 * pow3) AND nodes.pos <> leaves.pos // pow3
  WHERE nodes.n > 1
  UNION ALL
  SELECT rid, 1, lvl, upper.pos % 3, upper.pos < tops.pos // pow3, upper.h
  FROM leaves JOIN tops ON leaves.source IS NOT DISTINCT FROM tops.source
  JOIN (SELECT *, CAST(3 ** lvl AS BIGINT) AS pow3 FROM upper) upper
    ON upper.pos // 3 = tops.pos // (3 * pow3) AND upper.pos <> tops.pos // pow3
  WHERE upper.n > 1
), proofs AS (
  SELECT rid, sha256(string_agg(h, '' ORDER BY tree, lvl, place)) AS proof FROM steps GROUP BY rid
), heights AS (
  SELECT rid, lower_levels, (SELECT max(lvl) FROM upper) AS upper_levels
  FROM leaves JOIN (SELECT source, max(lvl) AS lower_levels FROM nodes GROUP BY source) m
    ON leaves.source IS NOT DISTINCT FROM m.source
), rungs AS (
  SELECT rid, CASE WHEN tree = 0 THEN lvl ELSE lower_levels + lvl END AS step,
    coalesce(string_agg(h, '' ORDER BY place) FILTER (WHERE before), '') AS l,
    coalesce(string_agg(h, '' ORDER BY place) FILTER (WHERE NOT before), '') AS r
  FROM steps JOIN heights USING (rid) GROUP BY ALL
), folded(rid, step, h) AS (
  SELECT rid, 0, probe FROM leaves
  UNION ALL
  SELECT f.rid, f.step + 1, sha256(coalesce(l, '') || f.h || coalesce(r, ''))
  FROM folded f JOIN heights USING (rid) LEFT JOIN rungs ON rungs.rid = f.rid
    AND rungs.step = f.step
  WHERE f.step < lower_levels + upper_levels
)
SELECT doc_id, leaf, tops.h AS subroot, root, coalesce(proof, sha256('')) AS proof_sha256,
  folded.h AS folded_root, folded.h = root AS verified
FROM leaves JOIN tops ON leaves.source IS NOT DISTINCT FROM tops.source
JOIN (SELECT h AS root FROM upper WHERE n = 1) ON TRUE
JOIN heights USING (rid) LEFT JOIN proofs USING (rid)
JOIN folded ON folded.rid = leaves.rid AND folded.step = lower_levels + upper_levels
"""
# CRC-32 in SQL: eight steps of the polynomial 0xEDB88320 for each byte of the decimal number.
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(range(1, length(d) + 1), lambda i: CAST(ascii(d[i]) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
    lambda x, k: xor(x >> 1, (x & 1) * 3988292384))))"""


@llm_query(_MERKLE_SQL.replace("CRC32_OF_D", _CRC))
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verified(
        docs, ["doc_id", "source", "lang", "n_chars", "text"], order="doc_id", group="source",
        changed={"text": tampered},
    )


_PHRASES_SQL = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents)
), counted AS (
  SELECT lang, phrase, count(*) AS f FROM (
    SELECT lang, unnest(list_concat(list_transform(w, lambda x: [x]),
      CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i : i + 1])
        ELSE [] END,
      CASE WHEN len(w) > 2 THEN list_transform(range(1, len(w) - 1), lambda i: w[i : i + 2])
        ELSE [] END)) AS phrase
    FROM pieces)
  GROUP BY lang, phrase
), sizes AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE len(phrase) = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, f AS a FROM counted WHERE len(phrase) > 1 AND f >= 10
), cuts AS (
  SELECT c.lang, c.phrase, a, k, l.f AS l, r.f AS r,
    CAST(1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(phrase))) AS k FROM candidates) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = c.phrase[1 : k]
  JOIN counted r ON r.lang = c.lang AND r.phrase = c.phrase[k + 1 : ]
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, unnest([phrase[1:2], phrase[2:3]]) AS phrase, a AS longer
  FROM candidates WHERE len(phrase) = 3
), covered AS (
  SELECT lang, phrase, max(longer) AS longer FROM inside GROUP BY lang, phrase
), ranked AS (
  SELECT lowest.lang, array_to_string(lowest.phrase, ' ') AS phrase, a, l, r, n, score,
    row_number() OVER (PARTITION BY lowest.lang
      ORDER BY score DESC, a DESC, array_to_string(lowest.phrase, ' ')) AS rank
  FROM lowest JOIN sizes USING (lang)
  LEFT JOIN covered ON covered.lang = lowest.lang AND covered.phrase = lowest.phrase
  WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
"""


@llm_query(_PHRASES_SQL)
def op12_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))


@llm_query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)

"""Hostile-text screening, quarantine rows and their review."""

from __future__ import annotations

import hashlib
import html
import re
import sys
import unicodedata
from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import lru_cache, reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forumtide.functions.text import (
    SPACE,
    digest,
    fold,
    is_stable,
    let,
    once_per_row,
    stable_form,
)
from forumtide.params import code, utc, whole
from forumtide.registry import INVISIBLE_RULE_ID, INVISIBLE_SCORE, PROMPT_RULES, ScanRule
from forumtide.schemas import FINDING

# Screening and audit limits.
THRESHOLD = 70
MAX_SCORE = 100
EVIDENCE_CHARS = 160

QUARANTINE_KEY = ("source_kind", "source_ref", "content_hash")
_HIDDEN_CATEGORIES = ("Cc", "Cf")


@lru_cache(maxsize=1)
def _hidden_chars() -> re.Pattern[str]:
    """Pattern of one control or format character, built from the Unicode database."""
    hits = [c for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) in _HIDDEN_CATEGORIES]
    return re.compile("[" + "".join(f"\\U{c:08x}" for c in hits) + "]")


def evidence(match: str) -> dict[str, str]:
    """Hash of the whole match, and a clipped form that is safe to show."""

    def visible(found: re.Match[str]) -> str:
        code = ord(found.group())
        return f"\\u{code:04x}" if code < 0x10000 else f"\\U{code:08x}"

    shown = _hidden_chars().sub(visible, match[:EVIDENCE_CHARS])
    return {
        "evidence_hash": hashlib.sha256(match.encode("utf-8")).hexdigest(),
        "escaped_evidence": html.escape(shown, quote=True),
    }


def scan_text(text: str, rules: Sequence[tuple[str, int, re.Pattern[str]]]) -> tuple[str, list[dict]]:
    """Normalised text and findings of one string."""
    normalized = unicodedata.normalize("NFKC", text)
    hidden = _hidden_chars()
    findings = []
    found = hidden.findall(normalized)
    unseen = "".join(c for c in found if c not in "\n\t\r")
    if unseen:
        findings.append({"rule_id": INVISIBLE_RULE_ID, "score": INVISIBLE_SCORE, **evidence(unseen)})
    readings = [normalized]
    if found:
        readings = [hidden.sub(" ", normalized), hidden.sub("", normalized)]
    for rule_id, score, pattern in rules:
        hits = (pattern.search(reading) for reading in readings)
        first = next((hit for hit in hits if hit), None)
        if first:
            findings.append({"rule_id": rule_id, "score": score, **evidence(first.group())})
    return normalized, findings


def compile_rules(rules: Sequence[ScanRule]) -> list[tuple[str, int, re.Pattern[str]]]:
    return [(r.rule_id, r.score, re.compile(r.pattern, re.IGNORECASE)) for r in rules]


def needs_scan(text: Column, rules: Sequence[ScanRule]) -> Column:
    """False only where no rule can fire: stable text without any rule's anchor.

    Line breaks are dropped before the search because rules also read the text with
    control characters removed.
    """
    if not all(rule.anchors for rule in rules):
        return text.isNotNull()
    words = sorted({anchor.lower() for rule in rules for anchor in rule.anchors})
    # Anchors that contain another one can add nothing.
    words = [w for w in words if not any(o != w and o in w for o in words)]
    joined = text
    for control in "\n\r\t":
        joined = F.replace(joined, F.lit(control), F.lit(""))

    def any_anchor(lowered: Column) -> Column:
        return reduce(lambda a, b: a | b, [lowered.contains(word) for word in words])

    return ~is_stable(text) | let(F.lower(joined), any_anchor)


def scan(
    rows: DataFrame, column: str, rules: Sequence[ScanRule] = PROMPT_RULES, prefix: str = "",
    *, folds: bool = False, beside: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``normalized``, ``findings`` and ``risk_score`` (with an optional name prefix).

    Rows that provably trip nothing are answered in the JVM; the rest go to Python in
    Arrow batches with their whole text. ``folds`` also adds ``folded``, the normal form of the
    normalised text. It and the columns of ``beside`` share the pass of Python: every further
    pass in a task takes a Python worker of its own.
    """

    # Declared non-deterministic so that no filter on the result repeats the scan below it.
    @once_per_row
    @pandas_udf(f"normalized STRING, findings ARRAY<{FINDING}>, folded STRING")
    def scan_batch(texts: pd.Series) -> pd.DataFrame:
        compiled = compile_rules(rules)
        done = [(None, []) if t is None else scan_text(t, compiled) for t in texts]
        out = pd.DataFrame(done, columns=["normalized", "findings"])
        folded = [fold(n) if folds and n is not None else None for n, _ in done]
        return out.assign(folded=pd.Series(folded, dtype=object))

    text = F.col(column)
    raw = f"_{prefix}scan"
    suspect = needs_scan(text, rules)
    findings = F.coalesce(F.col(f"{raw}.findings"), F.array().cast(f"array<{FINDING}>"))
    total = F.aggregate(F.col(f"{prefix}findings"), F.lit(0), lambda n, f: n + f["score"])
    scanned = rows.withColumns({raw: scan_batch(F.when(suspect, text)), **(beside or {})})
    if folds:
        # Texts that were not sent to Python are stable.
        plain = F.coalesce(F.col(f"{raw}.folded"), stable_form(text))
        scanned = scanned.withColumn(f"{prefix}folded", plain)
    return (
        scanned.withColumn(f"{prefix}normalized", F.coalesce(F.col(f"{raw}.normalized"), text))
        .withColumn(f"{prefix}findings", findings)
        .withColumn(f"{prefix}risk_score", F.least(F.lit(MAX_SCORE), total))
        .drop(raw)
    )


def _hidden(text: Column, *, allow_lines: bool = False) -> Column:
    kept = r"&&[^\n\r\t]" if allow_lines else ""
    return text.rlike(rf"[\p{{Cc}}\p{{Cf}}{kept}]")


def _audit_text(
    text: Column, longest: int | None = None, *, allow_lines: bool = False
) -> Column:
    """Trimmed, non-empty, free of hidden characters and, if asked, bounded."""
    trimmed = ~text.rlike(rf"(?U)^{SPACE}|{SPACE}\z")
    good = (text != "") & trimmed & ~_hidden(text, allow_lines=allow_lines)
    if longest is not None:
        good = good & (F.char_length(text) <= longest)
    return F.coalesce(good, F.lit(False))


def quarantine_rows(
    texts: DataFrame,
    kind: str,
    quarantined_at: datetime | Column,
    rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
    existing: DataFrame | None = None,
) -> DataFrame:
    """New quarantine rows for ``texts (source_ref, text)``; a replay gives none.

    The identity is kind, reference and hash of the normalised text, and the row id is
    its digest, so every run produces the same rows. No raw text is stored. Harmful texts
    whose reference is unusable are left to :func:`unnamed_quarantine`. ``quarantined_at`` may
    be a column of the texts; of copies the earliest stands.
    """
    named = texts.where(_audit_text(F.col("source_ref")))
    flagged = _flagged(named, kind, rules, threshold, quarantined_at)
    keyed = flagged.select(
        "source_kind", "source_ref", "content_hash", "findings", "risk_score", "quarantined_at"
    )
    if existing is not None:
        keyed = keyed.join(existing.select(*QUARANTINE_KEY), list(QUARANTINE_KEY), "left_anti")
    # Copies share their normalised text, hence their findings; any one stands for all.
    once = keyed.groupBy(*QUARANTINE_KEY).agg(
        F.any_value("findings").alias("findings"), F.any_value("risk_score").alias("risk_score"),
        F.min("quarantined_at").alias("quarantined_at"),
    )
    return once.select(
        digest(F.concat_ws("\n", *QUARANTINE_KEY)).alias("id"), *QUARANTINE_KEY,
        "findings", "risk_score", "quarantined_at",
        F.lit("pending").alias("review_state"),
        *[F.lit(None).cast("string").alias(name) for name in ("reviewer", "note")],
        F.lit(None).cast("timestamp_ntz").alias("released_at"),
    )


def _flagged(
    texts: DataFrame, kind: str, rules: Sequence[ScanRule], threshold: int,
    quarantined_at: datetime | Column,
) -> DataFrame:
    code("source_kind", kind)
    whole(threshold=threshold)
    if isinstance(quarantined_at, datetime):
        quarantined_at = F.lit(utc("quarantined_at", quarantined_at))
    return scan(texts, "text", rules).where(F.col("risk_score") >= threshold).withColumns({
        "source_kind": F.lit(kind), "content_hash": digest(F.col("normalized")),
        "quarantined_at": quarantined_at.cast("timestamp_ntz"),
    })


def unusable_references(texts: DataFrame) -> DataFrame:
    """Texts that no audit can name: reference missing, untrimmed or with hidden characters."""
    return texts.where(~_audit_text(F.col("source_ref")))


def unnamed_quarantine(
    texts: DataFrame,
    kind: str,
    quarantined_at: datetime | Column,
    rules: Sequence[ScanRule] = PROMPT_RULES,
    threshold: int = THRESHOLD,
) -> DataFrame:
    """Harmful texts with an unusable reference, one row per text: the rejected output.

    They cannot become quarantine rows, which are found and released by reference, but they
    are scanned like all others and must not go further. ``source_refs`` counts the distinct
    unusable references (a missing one counts once).
    """
    flagged = _flagged(unusable_references(texts), kind, rules, threshold, quarantined_at)
    missing = F.max(F.col("source_ref").isNull().cast("int"))
    return flagged.groupBy("source_kind", "content_hash").agg(
        F.count(F.lit(1)).alias("texts"),
        (F.count_distinct("source_ref") + missing).alias("source_refs"),
        F.any_value("findings").alias("findings"), F.any_value("risk_score").alias("risk_score"),
        F.min("quarantined_at").alias("quarantined_at"),
    )


def review_outcomes(
    decisions: DataFrame, quarantine: DataFrame, longest: int | None = None
) -> DataFrame:
    """Outcome of each release decision ``(seq, id, reviewer, note)``.

    ``released`` changes a pending row, ``replayed`` repeats an earlier decision word
    for word, ``conflict`` would overwrite history, ``not_found`` has no row, and
    ``invalid`` breaks the audit text rules (``longest`` also refuses longer reviewers and
    notes). Among decisions of one batch for the same
    row the lowest ``seq`` acts first.
    """
    audit_ok = _audit_text(F.col("reviewer"), longest) & _audit_text(
        F.col("note"), longest, allow_lines=True
    )
    judged = decisions.withColumn("_ok", audit_ok)
    first = judged.where("_ok").groupBy("id").agg(
        F.min(F.struct("seq", "reviewer", "note")).alias("_first")
    )
    held = quarantine.select(
        "id", "review_state", F.col("reviewer").alias("_reviewer"), F.col("note").alias("_note")
    )
    same_as_held = (F.col("reviewer") == F.col("_reviewer")) & (F.col("note") == F.col("_note"))
    same_as_first = (F.col("reviewer") == F.col("_first.reviewer")) & (
        F.col("note") == F.col("_first.note")
    )
    state = F.col("review_state")
    outcome = (
        F.when(~F.col("_ok"), "invalid")
        .when(state.isNull(), "not_found")
        .when((state == "released") & same_as_held, "replayed")
        .when((state == "pending") & (F.col("seq") == F.col("_first.seq")), "released")
        .when((state == "pending") & same_as_first, "replayed")
        .otherwise("conflict")
    )
    return (
        judged.join(held, "id", "left").join(first, "id", "left")
        .select("seq", "id", "reviewer", "note", outcome.alias("outcome"))
    )


def apply_reviews(quarantine: DataFrame, outcomes: DataFrame, now: datetime) -> DataFrame:
    """Quarantine after the ``released`` outcomes; every other row is unchanged."""
    done = outcomes.where(F.col("outcome") == "released").select(
        "id", F.col("reviewer").alias("_reviewer"), F.col("note").alias("_note")
    )
    stamp = F.lit(utc("now", now)).cast("timestamp_ntz")
    hit = F.col("_reviewer").isNotNull()
    updates = {
        "review_state": F.lit("released"), "reviewer": F.col("_reviewer"),
        "note": F.col("_note"), "released_at": stamp,
    }
    joined = quarantine.join(done, "id", "left")
    return joined.select(*[
        F.when(hit, updates[c]).otherwise(F.col(c)).alias(c) if c in updates else F.col(c)
        for c in quarantine.columns
    ])


def release_tasks(
    quarantine: DataFrame, outcomes: DataFrame, existing: DataFrame, now: datetime
) -> DataFrame:
    """One follow-up task per released row that has none yet."""
    ids = outcomes.where(F.col("outcome").isin("released", "replayed")).select("id").distinct()
    payload = F.to_json(F.struct(F.col("id").alias("quarantine_id"), "source_kind", "source_ref"))
    tasks = quarantine.join(ids, "id", "left_semi").select(
        F.concat(F.lit("released-analysis:"), F.col("id"), F.lit(":v1")).alias("task_key"),
        F.lit("released_analysis").alias("kind"),
        F.lit("pending").alias("state"),
        payload.alias("payload"),
        digest(payload).alias("payload_hash"),
        F.lit(utc("now", now)).cast("timestamp_ntz").alias("available_at"),
    )
    return tasks.join(existing.select("task_key"), "task_key", "left_anti")


def task_conflicts(tasks: DataFrame, existing: DataFrame) -> DataFrame:
    """Stored tasks that use one of these keys for different work."""
    stored = existing.select(
        "task_key", F.col("kind").alias("_kind"), F.col("payload_hash").alias("_hash")
    )
    same = F.col("kind").eqNullSafe(F.col("_kind")) & F.col("payload_hash").eqNullSafe(F.col("_hash"))
    return tasks.join(stored, "task_key").where(~same).select("task_key")

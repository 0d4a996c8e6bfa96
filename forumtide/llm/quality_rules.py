"""Quality rules kept as a ledger of measurements and failure bits.

``measure`` scans each whole text once, ``record`` turns the measurements into one bit per
rule, and policies are masks over those bits: applying another policy or asking what a rule
contributes reads the ledger only. Built-in functions only; every document is one row and
nothing is shuffled.

Defined results: a null or empty text has no words and fails ``few_words``. A null doc_id is
kept as null. Repeated rows give repeated ledger rows. An empty table gives an empty ledger.
Columns of the input other than doc_id and text are not read; ``filter_documents`` passes all
input columns through unchanged, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.llm.common import BLANKS, let, whole_text, words_of

SYMBOLS = "#*$%&|<>"
WINDOW = 8
DISTINCT_WINDOW = 1000


# Rule i sets bit i of a ledger row when its condition holds. The order is part of the stored
# format: new rules are appended, none is moved or changed. The last rule counts distinct words
# per window, since their share in a whole text falls with its length.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "100 * n_symbols > 10 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 40 * n_lines"),
    ("long_words", "word_chars > 25 * n_words"),
    ("few_distinct_words", "100 * n_distinct_words < 20 * n_words"),
    ("few_distinct_in_windows", "100 * n_window_distinct_words < 20 * n_words"),
)
RULE_NAMES = tuple(name for name, _ in RULES)


@dataclass(frozen=True)
class Policy:
    """A named version: a document is rejected when any of its rules fails."""

    version: str
    rejects: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULE_NAMES.index(name) for name in self.rejects)


BASE = Policy("base", ("few_words", "repeated_windows"))
# Versions stay, so that an old verdict can be told again from its ledger.
WHOLE_TEXT = Policy("2", RULE_NAMES[:6])
PRODUCTION = Policy("3", (*RULE_NAMES[:5], "few_distinct_in_windows"))
POLICIES = {policy.version: policy for policy in (BASE, WHOLE_TEXT, PRODUCTION)}


def _without(text: Column, characters: str) -> Column:
    for character in characters:
        text = F.replace(text, F.lit(character))
    return text


def _paired(items: Column, step: int) -> Column:
    """Hash of each item with the one ``step`` places on (null past the end)."""
    shifted = F.slice(items, F.lit(1 + step), F.size(items))
    return F.zip_with(items, shifted, lambda a, b: F.xxhash64(a, b))


def _window_hashes(words: Column) -> Column:
    """Hashes of all 8-word windows: word hashes are paired at distance 1, 2 and 4."""
    eights = let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda ones: let(
            _paired(ones, 1), lambda twos: let(_paired(twos, 2), lambda fours: _paired(fours, 4))
        ),
    )
    return F.slice(eights, F.lit(1), F.greatest(F.size(words) - (WINDOW - 1), F.lit(0)))


def _covered(places: Column) -> Column:
    """Words in windows starting at the sorted places: neighbours share what they overlap."""
    following = F.slice(places, F.lit(2), F.size(places))
    steps = F.zip_with(
        places, following,
        lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, step: total + step)


def _repeated_places(hashes: Column) -> Column:
    """Sorted places whose window hash occurs twice or more: equal neighbours once sorted."""

    def neighbours(ordered: Column) -> Column:
        following = F.slice(ordered, F.lit(2), F.size(ordered))
        pairs = F.zip_with(
            ordered, following,
            lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])),
        )
        both = F.flatten(F.filter(pairs, lambda pair: pair.isNotNull()))
        return F.array_sort(F.array_distinct(both))

    placed = F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p")))
    return let(F.array_sort(placed), neighbours)


def _repeat_words(words: Column) -> Column:
    """Words inside 8-word windows found twice or more; most texts stop at the first test."""
    return let(
        _window_hashes(words),
        lambda hashes: F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes),
            let(_repeated_places(hashes), _covered),
        ).otherwise(F.lit(0).cast("bigint")),
    )


def _window_distinct_words(words: Column) -> Column:
    """Distinct words of each window of consecutive words, summed over the whole text."""

    def total(words: Column) -> Column:
        last = F.floor(F.greatest(F.size(words) - 1, F.lit(0)) / DISTINCT_WINDOW).cast("int")
        counts = F.transform(
            F.sequence(F.lit(0), last),
            lambda k: F.size(F.array_distinct(
                F.slice(words, k * DISTINCT_WINDOW + 1, F.lit(DISTINCT_WINDOW))
            )),
        )
        return F.aggregate(counts, F.lit(0).cast("bigint"), lambda so_far, n: so_far + n)

    return let(words, total)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id with the measurements of its whole text."""
    text = F.col("_ft_text")
    lines = F.filter(
        F.split(text, "\n"), lambda line: F.octet_length(F.btrim(line, F.lit(BLANKS))) > 0
    )
    bytes_of_blanks = F.octet_length(text) - F.octet_length(_without(text, BLANKS))
    prepared = docs.select("doc_id", whole_text().alias("_ft_text")).select(
        "doc_id", "_ft_text", words_of(text).alias("_ft_words")
    )
    line_counts = let(
        lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))
    )
    words = F.col("_ft_words")
    return prepared.select(
        "doc_id",
        F.size(words).cast("bigint").alias("n_words"),
        (F.char_length(text) - bytes_of_blanks).cast("bigint").alias("word_chars"),
        (F.octet_length(text) - F.octet_length(_without(text, SYMBOLS)))
        .cast("bigint").alias("n_symbols"),
        line_counts.alias("_ft_lines"),
        _repeat_words(words).alias("n_repeat_words"),
        F.size(F.array_distinct(words)).cast("bigint").alias("n_distinct_words"),
        _window_distinct_words(words).alias("n_window_distinct_words"),
    ).select(
        "doc_id", "n_words", "word_chars", "n_symbols",
        F.col("_ft_lines.n").cast("bigint").alias("n_lines"),
        (F.col("_ft_lines.n") - F.col("_ft_lines.d")).cast("bigint").alias("n_dup_lines"),
        "n_repeat_words", "n_distinct_words", "n_window_distinct_words",
    )


def record(measures: DataFrame) -> DataFrame:
    """The ledger: measurements and ``failures``, one bit per failed rule."""
    bits = [
        F.when(F.expr(failed), F.lit(1 << place)).otherwise(F.lit(0))
        for place, (_, failed) in enumerate(RULES)
    ]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measures.withColumn("failures", total.cast("bigint"))


def judged(ledger: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """Verdicts of one policy version; ``base_failed`` always means the base rules."""
    failed = F.col("failures")
    return ledger.withColumns({
        "policy": F.lit(policy.version),
        "base_failed": failed.bitwiseAND(F.lit(BASE.mask)) != 0,
        "kept": failed.bitwiseAND(F.lit(BASE.mask | policy.mask)) == 0,
    })


def ablation(ledger: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """Per rule of the policy: documents failing it, and those only it rejects.

    ``failing`` has the rule's bit set; ``recovered`` has no other bit of the policy set, so
    these documents would be kept without the rule. One global aggregate over the bits.
    """
    active = F.col("failures").bitwiseAND(F.lit(policy.mask))
    sums = []
    for name in policy.rejects:
        bit = 1 << RULE_NAMES.index(name)
        sums += [
            F.coalesce(F.sum((active.bitwiseAND(F.lit(bit)) != 0).cast("bigint")), F.lit(0))
            .alias(f"f_{name}"),
            F.coalesce(F.sum((active == bit).cast("bigint")), F.lit(0)).alias(f"r_{name}"),
        ]
    totals = ledger.agg(*sums)
    return totals.select(F.inline(F.array(*[
        F.struct(
            F.lit(policy.version).alias("policy"), F.lit(name).alias("rule"),
            F.col(f"f_{name}").alias("failing"), F.col(f"r_{name}").alias("recovered"),
        )
        for name in policy.rejects
    ])))


def filter_documents(docs: DataFrame, policy: Policy = PRODUCTION) -> DataFrame:
    """The input rows that the policy keeps, columns unchanged.

    The verdict is computed beside the row, so nothing is joined and repeated or null ids
    need no care.
    """
    row = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("_ft_row")
    packed = docs.select(row, whole_text().alias("text"))
    carried = packed.select(F.col("_ft_row").alias("doc_id"), "text")
    kept = judged(record(measure(carried)), policy).where("kept")
    return kept.select("doc_id.*")

"""Deterministic theme clusters over safe text: TF-IDF of character grams, spherical k-means.

Weights are one narrow table (text, gram, w) and document frequencies are exact. Seeds are
the texts of the least hashed ids, so nothing is drawn at random, and every step is a join or an
aggregate: a text may be of any length, and no vector, text or cluster is held by one task.
Rounds go on until no text changes its theme. A round moves the centres by the texts that changed
and compares every text with every centre.
"""

from __future__ import annotations

from functools import reduce
from operator import xor

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.functions.text import normal_form
from forumtide.session import discard, materialize

GRAM = 3
# Similarities are compared to this many decimals, so that the order of sums decides nothing.
DECIMALS = 9
# Centres are summed anew once a theme has shrunk so much: taking texts off leaves rounding errors.
SHRUNK = 100


def gram_counts(texts: DataFrame, gram: int = GRAM) -> DataFrame:
    """``(id, gram, n)``: occurrences of each run of code points in the normal form."""
    grams = F.regexp_extract_all("_normal", F.lit(rf"(?s)(?=(.{{{gram}}}))."), F.lit(1))
    # Texts are dealt out before they are taken apart: their grams are then counted in place. The
    # number is given, as few short texts make many grams and small partitions must not merge.
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = texts.select("id", normal_form(F.col("text")).alias("_normal")).repartition(parts, "id")
    return rows.select("id", F.explode(grams).alias("gram")).groupBy("id", "gram").agg(
        F.count(F.lit(1)).alias("n")
    )


def gram_frequencies(counts: DataFrame) -> DataFrame:
    """Number of texts that have each gram."""
    return counts.groupBy("gram").agg(F.count(F.lit(1)).alias("texts"))


def gram_weights(counts: DataFrame, n_texts: int) -> DataFrame:
    """``(text, gram, w)``: TF-IDF by numbers of text and gram, not scaled; zeros are left out.

    The frequencies are stored first, so that few of them do not shuffle the counts, and number
    the grams. Rows of a text are kept together: every round sums over them in place. Runs jobs.
    """
    rarity = F.ln(F.lit(n_texts + 1.0) / (F.col("texts") + 1))
    grams = materialize(
        gram_frequencies(counts).select(
            "gram", rarity.alias("rarity"), F.monotonically_increasing_id().alias("number")
        ),
        "theme-frequencies",
    )
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return counts.join(grams.where("rarity > 0"), "gram").select(
        F.col("id").alias("text"), F.col("number").alias("gram"),
        (F.col("n") * F.col("rarity")).alias("w"),
    ).repartition(parts, "text")


def _by_theme(k: int, *terms: str) -> list[Column]:
    """Columns of SQL for each theme ``{i}``."""
    return [F.expr(term.format(i=i)) for term in terms for i in range(k)]


def first_centres(names: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    """``(gram, _c0, ...)`` for all grams: the texts of the ``k`` least hashed ids, in that order.

    ``names`` has the number and id of each text. Centres are not scaled.
    """
    order = Window.orderBy("_hash", "id")
    seeds = (
        names.select("text", "id", F.md5(F.col("id").cast("string")).alias("_hash"))
        .orderBy("_hash", "id").limit(k)
        .withColumn("theme", F.row_number().over(order) - 1)  # k rows
    )
    return weights.join(seeds.select("text", "theme"), "text", "left").groupBy("gram").agg(
        *_by_theme(k, "sum(if(theme = {i}, w, 0D)) AS _c{i}")
    )


def nearest_centre(weights: DataFrame, centres: DataFrame, k: int) -> DataFrame:
    """``(text, length, theme)``: the most similar centre, the first of equal ones."""
    norms = centres.agg(*_by_theme(k, "sqrt(sum(_c{i} * _c{i})) AS _n{i}"))
    sums = weights.join(centres, "gram").groupBy("text").agg(
        F.expr("sqrt(sum(w * w)) AS length"), *_by_theme(k, "sum(w * _c{i}) AS _s{i}")
    )
    # A theme whose first text has no weights has no centre.
    alike = f"coalesce(round(_s{{i}} / length / nullif(_n{{i}}, 0D), {DECIMALS}), 0D)"
    scored = F.array(*_by_theme(k, f"struct({alike} AS s, -{{i}} AS i)"))
    return sums.crossJoin(norms).select(
        "text", "length", F.negative(F.array_max(scored)["i"]).alias("theme")
    )


def _moved(
    weights: DataFrame, centres: DataFrame, changes: DataFrame, was: list[int], now: list[int]
) -> DataFrame:
    """Centres after texts changed from theme ``before`` (-1: none) to ``theme``.

    ``was`` and ``now`` are the sizes of themes. A theme without texts keeps its centre; what
    was kept so goes once it has texts.
    """
    k = len(now)
    kept = [
        F.expr(f"_c{i}" if was[i] or not now[i] else "0D").alias(f"_c{i}") for i in range(k)
    ]
    added = [
        F.expr(f"if(theme = {i}, w, if(before = {i}, -w, 0D)) / length" if now[i] else "0D").alias(f"_c{i}")
        for i in range(k)
    ]
    come = weights.join(changes, "text").select("gram", *added)
    return centres.select("gram", *kept).unionByName(come).groupBy("gram").agg(
        *_by_theme(k, "sum(_c{i}) AS _c{i}")
    )


def _start(
    texts: DataFrame, k: int, gram: int
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Stored names ``(text, id)``, weights, first centres and first themes. Runs jobs."""
    names = materialize(
        texts.select("id").distinct().withColumn("text", F.monotonically_increasing_id()),
        "theme-names",
    )
    numbered = texts.join(names.withColumnRenamed("text", "_number"), "id").select(
        F.col("_number").alias("id"), "text"
    )
    counts = materialize(gram_counts(numbered, gram), "theme-grams")
    weights = materialize(gram_weights(counts, names.count()), "theme-weights")
    discard(counts)
    centres = materialize(first_centres(names, weights, k), "theme-centres")
    return names, weights, centres, materialize(nearest_centre(weights, centres, k), "themes")


def _named(texts: DataFrame, names: DataFrame, assigned: DataFrame) -> DataFrame:
    """``(id, theme, text)``; a text without weights is in the first theme."""
    themes = names.join(assigned.select("text", "theme"), "text", "left").select(
        "id", F.coalesce("theme", F.lit(0)).alias("theme")
    )
    return themes.join(texts, "id").select("id", "theme", "text")


def first_assignments(texts: DataFrame, k: int, gram: int = GRAM) -> DataFrame:
    """Theme of each ``(id, text)`` before any centre has moved. Runs jobs."""
    kept = materialize(texts.select("id", "text"), "theme-texts")
    names, _, _, assigned = _start(kept, k, gram)
    return _named(kept, names, assigned)


def theme_assignments(texts: DataFrame, k: int, gram: int = GRAM) -> DataFrame:
    """Theme of each ``(id, text)`` once a round changes the theme of no text. Runs jobs."""
    kept = materialize(texts.select("id", "text"), "theme-texts")
    names, weights, centres, assigned = _start(kept, k, gram)
    changes = assigned.withColumn("before", F.lit(-1))
    was, most, seen = [0] * k, [0] * k, set()
    while True:
        now, mark = _sizes(assigned, k)
        # Only rounding can bring an assignment back; its rounds would repeat for ever.
        if mark in seen:
            return _named(kept, names, assigned)
        seen.add(mark)
        most = [max(pair) for pair in zip(most, now)]
        if any(0 < n * SHRUNK < m for n, m in zip(now, most)):
            was, most = [0] * k, now
            changes = assigned.withColumn("before", F.lit(-1))
        moved = materialize(_moved(weights, centres, changes, was, now), "theme-centres")
        again = materialize(
            nearest_centre(weights, moved, k).join(
                assigned.select("text", F.col("theme").alias("before")), "text"
            ),
            "themes",
        )
        for old in (centres, assigned, changes):
            discard(old)
        changes = materialize(again.where("theme <> before"), "theme-changes")
        centres, assigned, was = moved, again, now


def _sizes(assigned: DataFrame, k: int) -> tuple[list[int], int]:
    """Number of texts in each theme, and a fingerprint of all assignments."""
    rows = assigned.groupBy("theme").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("text", "theme")).alias("mark")
    ).collect()  # k rows
    found = {row["theme"]: row["n"] for row in rows}
    return [found.get(i, 0) for i in range(k)], reduce(xor, (row["mark"] for row in rows), 0)


def theme_summary(assigned: DataFrame, representatives: int = 3) -> DataFrame:
    """Size and lowest-id representatives of each theme."""
    place = Window.partitionBy("theme").orderBy("id")
    few = (
        assigned.select("theme", "id").withColumn("place", F.row_number().over(place))
        .where(F.col("place") <= representatives)
        .groupBy("theme")
        .agg(F.sort_array(F.collect_list("id")).alias("representatives"))
    )
    sizes = assigned.groupBy("theme").agg(F.count(F.lit(1)).alias("size"))
    return sizes.join(few, "theme")

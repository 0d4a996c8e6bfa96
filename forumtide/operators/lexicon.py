"""Lexicon labels as plain column expressions over normalised text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.functions.text import fold, joined_forms, normal_form
from forumtide.registry import INTENT_LABELS, Lexicon

# Confidence scale and evidence size.
BASE, STEP, CEILING, UNSEEN = 0.45, 0.15, 0.95, 0.35
EVIDENCE_TERMS = 5


def terms_present(normal: Column, terms: Sequence[str]) -> Column:
    """The terms found in normalised text, in list order.

    Terms are folded once while planning; each test is a codegen ``contains``.
    """
    hits = [F.when(normal.contains(fold(term)), F.lit(term)) for term in terms]
    return F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")


def term_count(normal: Column, terms: Sequence[str]) -> Column:
    """Number of distinct list entries present (not of their occurrences)."""
    total = F.lit(0)
    for term in terms:
        total = total + normal.contains(fold(term)).cast("int")
    return total


def sentiment_of(positive: Column, negative: Column) -> Column:
    up, down = F.size(positive) > 0, F.size(negative) > 0
    return (
        F.when(up & down, "mixed").when(up, "positive").when(down, "negative").otherwise("neutral")
    )


def strongest(
    normal: Column, groups: Sequence[tuple[str, Sequence[str]]], default: str
) -> Column:
    """Group with most terms present; ties go to the earlier group, none to the default."""
    scored = [
        F.struct(
            term_count(normal, terms).alias("score"), F.lit(-place).alias("place"),
            F.lit(label).alias("label"),
        )
        for place, (label, terms) in enumerate(groups)
    ]
    if not scored:
        return F.lit(default)
    best = F.array_max(F.array(*scored))
    return F.when(best["score"] > 0, best["label"]).otherwise(F.lit(default))


def label_sentiment(
    rows: DataFrame, column: str, lexicon: Lexicon, folded: bool = False
) -> DataFrame:
    """Add ``sentiment``, ``confidence`` and ``evidence_terms`` of a text column.

    ``folded`` says that the column holds normal forms already.
    """
    text = F.col(column)
    found = (
        rows.withColumn("_normal", text if folded else normal_form(text))
        .withColumn("_up", terms_present(F.col("_normal"), lexicon.positive))
        .withColumn("_down", terms_present(F.col("_normal"), lexicon.negative))
    )
    hits = F.size("_up") + F.size("_down")
    confidence = F.when(
        hits > 0, F.least(F.lit(CEILING), F.lit(BASE) + F.lit(STEP) * hits)
    ).otherwise(F.lit(UNSEEN))
    terms = F.slice(F.array_distinct(F.concat("_up", "_down")), 1, EVIDENCE_TERMS)
    return (
        found.withColumn("sentiment", sentiment_of(F.col("_up"), F.col("_down")))
        .withColumn("confidence", confidence)
        .withColumn("evidence_terms", terms)
        .drop("_normal", "_up", "_down")
    )


def label_context(
    rows: DataFrame, text: Column, lexicon: Lexicon, folded: bool = False
) -> DataFrame:
    """Add ``intent`` and ``topic`` of a text expression, or of a normal form (``folded``)."""
    return (
        rows.withColumn("_normal", text if folded else normal_form(text))
        .withColumn("intent", strongest(F.col("_normal"), lexicon.intents, lexicon.default_intent))
        .withColumn("topic", strongest(F.col("_normal"), lexicon.topics, lexicon.default_topic))
        .drop("_normal")
    )


def label_thread(rows: DataFrame, column: str, lexicon: Lexicon) -> DataFrame:
    """Sentiment of a text column, and context of ``title`` and that text.

    Both normal forms come from one pass of Python.
    """
    forms = rows.withColumns(
        {"_text_form": normal_form(F.col(column)), "_title_form": normal_form(F.col("title"))}
    )
    return label_forms(forms, "_title_form", "_text_form", lexicon).drop("_title_form", "_text_form")


def label_forms(rows: DataFrame, title: str, text: str, lexicon: Lexicon) -> DataFrame:
    """:func:`label_thread` of normal forms that are at hand."""
    return label_context(
        label_sentiment(rows, text, lexicon, folded=True),
        joined_forms(F.col(title), F.col(text)), lexicon, folded=True,
    )


def comment_reaction(labelled: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Most common non-neutral sentiment of each post's comments.

    Equal leaders give ``mixed``, no expression gives ``neutral``.
    """
    kinds = ("positive", "negative", "mixed")
    counted = labelled.groupBy(*keys).agg(
        *[F.count_if(F.col("sentiment") == kind).alias(kind) for kind in kinds]
    )
    top = F.greatest(*kinds)
    leaders = sum(((F.col(kind) == top).cast("int") for kind in kinds), F.lit(0))
    reaction = F.when(top == 0, "neutral").when(leaders > 1, "mixed")
    for kind in kinds:
        reaction = reaction.when(F.col(kind) == top, kind)
    return counted.select(*keys, reaction.alias("comment_reaction"))


def label_posts(posts: DataFrame, comments: DataFrame, keys: Sequence[str], lexicon: Lexicon) -> DataFrame:
    """Labels of posts ``(keys, title, body)`` with comments ``(keys, text)``.

    Sentiment, confidence and evidence come from the body alone; intent and topic from
    title and body; the reaction from the comments.
    """
    context = label_thread(posts, "body", lexicon).withColumnRenamed("sentiment", "body_sentiment")
    reactions = comment_reaction(label_sentiment(comments, "text", lexicon), keys)
    return (
        context.join(reactions, list(keys), "left")
        .withColumn("comment_reaction", F.coalesce("comment_reaction", F.lit("neutral")))
        .withColumn("model_version", F.lit(lexicon.version))
    )


def lexicon_frame(spark: SparkSession, lexicon: Lexicon) -> DataFrame:
    """The lexicon as a dimension ``(kind, label, label_ord, term, term_ord)``."""
    rows = []
    for order, (label, terms) in enumerate(
        (("positive", lexicon.positive), ("negative", lexicon.negative))
    ):
        rows += [("sentiment", label, order, term, i) for i, term in enumerate(terms)]
    for kind, groups in (("intent", lexicon.intents), ("topic", lexicon.topics)):
        for order, (label, terms) in enumerate(groups):
            rows += [(kind, label, order, term, i) for i, term in enumerate(terms)]
    return spark.createDataFrame(
        rows, "kind STRING, label STRING, label_ord INT, term STRING, term_ord INT"
    )


def rule_catalogue(dimension: DataFrame) -> DataFrame:
    """All terms per label in their order; a reader shows as many as fit."""
    names = {
        "positive": "감성·긍정", "negative": "감성·부정",
        **{label: f"의도·{shown}" for label, shown in INTENT_LABELS.items()},
    }
    pairs = [F.lit(item) for pair in names.items() for item in pair]
    shown = F.when(F.col("kind") == "topic", F.concat(F.lit("주제·"), F.col("label"))).otherwise(
        F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("label")), F.col("label"))
    )
    return (
        dimension.groupBy("kind", "label", "label_ord")
        .agg(F.sort_array(F.collect_list(F.struct("term_ord", "term"))).alias("terms"))
        .select(
            "kind", "label_ord", shown.alias("rule"),
            F.array_join(F.transform("terms", lambda t: t["term"]), " · ").alias("terms"),
        )
    )

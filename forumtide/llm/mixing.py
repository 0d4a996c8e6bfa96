"""Mixing sources to target weights by Poisson replication.

Each source gets a mean repetition rate so that its expected share of bytes is its target
weight. A document's count inverts the Poisson distribution at a uniform number hashed from
seed and doc_id; it is exploded by that count and all copies are shuffled by a hashed key.
Every document decides alone, so the result does not depend on partitions or retries.

A rate above ``PART_RATE`` is cut into equal parts of at most that rate. Each part draws with a
number of its own and the counts add up, which is exact: a sum of Poisson counts is a Poisson
count. So the table of probabilities is short whatever the rate.

Defined results: a null source is a source of its own. A null or empty text counts as one
byte, as does the end of every other text. A null doc_id draws by the digest of its text; rows
with equal doc_id draw the same count. Sources without a target weight get none of the mix.
An empty table gives no rows. Added columns (``copy`` and ``shuffle_key``, and ``rate`` and
``n_copies`` where asked for) replace input columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.llm.common import let, whole_text
from forumtide.session import materialize

SEED = "mix-1"
UNIT_BITS = 52
PART_RATE = 64
# Copies of one document are numbered in runs of this length.
COPY_RUN = 4096


def _size() -> Column:
    return (F.octet_length(whole_text()) + 1).cast("bigint")


def hashed_unit(seed: str, key: Column) -> Column:
    """Uniform number in [0, 1) from the first 52 bits of a digest of seed and key."""
    digits = F.substring(F.md5(F.concat_ws(":", F.lit(seed), key)), 1, UNIT_BITS // 4)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**UNIT_BITS))


def _cumulative(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... far enough for every 52-bit uniform number.

    Terms are built from logarithms, so a large rate does not underflow.
    """
    last = F.ceil(rate + 12 * F.sqrt(rate) + 40).cast("int")

    def step(state: Column, k: Column) -> Column:
        log_term = state["log_term"] + F.ln(rate) - F.ln(k.cast("double"))
        below = state["below"] + F.exp(log_term)
        return F.struct(
            log_term.alias("log_term"), below.alias("below"),
            F.concat(state["cdf"], F.array(below)).alias("cdf"),
        )

    start = F.struct(
        (-rate).alias("log_term"), F.exp(-rate).alias("below"),
        F.array(F.exp(-rate)).alias("cdf"),
    )
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["cdf"])


def source_rates(
    docs: DataFrame, weights: DataFrame | None = None, total: float | None = None
) -> DataFrame:
    """source, rate and the cumulative Poisson probabilities of every weighted source.

    ``weights`` has source and weight (all sources alike when omitted); they are scaled to
    sum to one. ``total`` is the wanted size of the mix in bytes, the input's own if omitted.
    One row per source, stored. This runs a job.
    """
    sizes = materialize(
        docs.groupBy("source").agg(F.sum(_size()).alias("_ft_size")), "source-sizes"
    )
    if weights is None:
        wanted = sizes.select("source", "_ft_size", F.lit(1.0).alias("_ft_weight"))
    else:
        given = weights.select(F.col("source").alias("_ft_name"), F.col("weight").cast("double"))
        wanted = sizes.join(given, F.col("source").eqNullSafe(F.col("_ft_name"))).select(
            "source", "_ft_size", F.col("weight").alias("_ft_weight")
        )
    wanted = wanted.where(F.col("_ft_weight") > 0)
    sums = wanted.agg(F.sum("_ft_weight").alias("_ft_weights")).first()
    size = sizes.agg(F.sum("_ft_size")).first()[0] if total is None else total
    rate = F.lit(float(size or 0)) * (F.col("_ft_weight") / F.lit(sums[0] or 1.0)) / F.col("_ft_size")
    rated = wanted.select("source", rate.alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_RATE).cast("int"))
    cut = rated.withColumn("_ft_parts", parts)
    return materialize(
        cut.withColumn("_ft_cdf", _cumulative(F.col("rate") / F.col("_ft_parts"))), "rates"
    )


def _key() -> Column:
    """What a row draws by: its id, or the digest of its text."""
    return F.coalesce(
        F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(whole_text()))
    )


def _count(seed: str) -> Column:
    """The drawn number of copies: one inversion per part of the rate."""

    def inverse(key: Column) -> Column:
        return let(hashed_unit(seed, key), lambda u: F.size(
            F.filter(F.col("_ft_cdf"), lambda p: p <= u)
        ).cast("bigint"))

    more = F.aggregate(
        F.sequence(F.lit(1), F.col("_ft_parts") - 1), F.lit(0).cast("bigint"),
        lambda total, part: total + inverse(F.concat_ws(":", _key(), part.cast("string"))),
    )
    return inverse(_key()) + F.when(F.col("_ft_parts") > 1, more).otherwise(F.lit(0))


def poisson_mix(
    docs: DataFrame,
    weights: DataFrame | None = None,
    total: float | None = None,
    seed: str = SEED,
    explain: bool = False,
) -> DataFrame:
    """All copies of the mix, globally shuffled, with ``copy`` and ``shuffle_key``.

    ``explain`` also keeps ``rate`` and ``n_copies``. The rates are a reduced, stored table;
    Spark broadcasts it only below its own size threshold and otherwise splits a source that
    holds much of the table over many tasks.
    """
    added = {"copy", "shuffle_key", "rate", "n_copies"}
    names = [c for c in docs.columns if c not in added]
    rates = source_rates(docs, weights, total).select(
        F.col("source").alias("_ft_name"), "rate", "_ft_parts", "_ft_cdf"
    )
    counted = (
        docs.select(*[f"`{c}`" for c in names])
        .join(rates, F.col("source").eqNullSafe(F.col("_ft_name")))
        .withColumn("n_copies", _count(seed))
        .where(F.col("n_copies") > 0)
    )
    last = F.col("n_copies") - 1
    runs = counted.withColumn(
        "_ft_run", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(n_copies - 1) div {COPY_RUN}")))
    )
    begin = F.col("_ft_run") * COPY_RUN
    numbers = F.sequence(begin + 1, F.least(begin + COPY_RUN, last + 1))
    copies = runs.select(
        *[f"`{c}`" for c in names], *(["rate", "n_copies"] if explain else []),
        F.explode(numbers.cast("array<int>")).alias("copy"),
    )
    key = F.md5(F.concat_ws(
        ":", F.lit(seed), F.lit("order"), _key(), F.col("copy").cast("string"),
    ))
    # Partitions drawn by the hashed key and sorted by it are one uniformly random order.
    return copies.withColumn("shuffle_key", key).repartition("shuffle_key").sortWithinPartitions(
        "shuffle_key"
    )

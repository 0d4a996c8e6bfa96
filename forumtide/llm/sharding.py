"""Sharding by proportional stratified interleaving.

Rows are shuffled within their source by a seeded hash and ranked; the rank divided by the
source's size spreads every source evenly over (0, 1). Sorted by that fraction, every
contiguous cut holds each source in proportion to its share, and cuts of equal length differ
by one row at most (law ``rows``).

Both ranks are exact and computed over even buckets, so neither a source that holds most of
the table nor the global order ever meets in one task.

Defined results: a null source is a source of its own. A null text has size 1 and the check
sum of the empty text. Rows with equal doc_id and text are ordered arbitrarily among
themselves, which leaves the result the same as a multiset. An empty table gives no rows.
Added columns replace input columns of the same names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumtide.llm.common import bucket_bits, bucketed_rank, whole_text
from forumtide.session import materialize

SEED = 20
BUCKET_ROWS = 256


def described(docs: DataFrame) -> DataFrame:
    """The narrow row that is dealt out: id, source, size and check sum of the text."""
    return docs.select(
        "doc_id", "source",
        (F.octet_length(whole_text()) + 1).cast("bigint").alias("size"),
        F.crc32(whole_text().cast("binary")).alias("text_crc32"),
    )


def _bucket(unit: Column, bits: int) -> Column:
    return F.floor(unit * float(1 << bits)).cast("bigint")


def interleaved(rows: DataFrame, shards: int = 8, seed: int = SEED) -> DataFrame:
    """Adds shard and slot (place within the shard, from 0). This runs jobs."""
    if shards < 1:
        raise ValueError("shards must be positive")
    own = {"shard", "slot"}
    names = [c for c in rows.columns if c not in own]
    mixed = F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size")
    # The top 52 bits of the hash as a number in [0, 1).
    unit = F.shiftrightunsigned(mixed, 12) / float(1 << 52)
    keyed = materialize(
        rows.select(
            *[f"`{c}`" for c in names],
            F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")).alias("_ft_source"),
            unit.alias("_ft_key"),
        ),
        "shard-rows",
    )
    totals = materialize(
        keyed.groupBy("_ft_source").agg(F.count(F.lit(1)).alias("_ft_total")), "shard-totals"
    )
    facts = totals.agg(F.sum("_ft_total"), F.count(F.lit(1))).first()
    n_rows, n_sources = facts[0] or 0, facts[1]
    ties = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    bits = bucket_bits(n_rows, BUCKET_ROWS * max(1, n_sources // 4))
    ranked = bucketed_rank(
        keyed.withColumn("_ft_bucket", _bucket(F.col("_ft_key"), bits)),
        ["_ft_source"], "_ft_bucket", [F.col("_ft_key"), *ties], "_ft_rank",
    )
    share = (F.col("_ft_rank") + F.lit(0.5)) / F.col("_ft_total")
    spread = materialize(
        ranked.drop("_ft_bucket").join(totals, "_ft_source").withColumn("_ft_share", share),
        "shard-shares",
    )
    bits = bucket_bits(n_rows, BUCKET_ROWS)
    placed = bucketed_rank(
        spread.withColumn("_ft_bucket", _bucket(F.col("_ft_share"), bits)).withColumn(
            "_ft_all", F.lit(0)
        ),
        ["_ft_all"], "_ft_bucket",
        [F.col("_ft_share"), F.col("_ft_source"), F.col("_ft_rank")], "_ft_place",
    )
    place = F.col("_ft_place")
    shard = F.expr(f"(({shards} * (_ft_place + 1) + {n_rows} - 1) div {max(n_rows, 1)}) - 1")
    first = F.expr(f"(shard * {n_rows}L) div {shards}")
    return (
        placed.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (place - first).cast("bigint"))
        .select(*[f"`{c}`" for c in names], "shard", "slot")
    )



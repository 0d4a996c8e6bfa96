"""String-first table contracts: lexical rules, typed rows, violation counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.functions.text import strip
from forumtide.functions.values import approved_url


@dataclass(frozen=True)
class Contract:
    """Exact columns of one table and what each must look like."""

    name: str
    columns: tuple[str, ...]
    integers: tuple[str, ...] = ()
    required_text: tuple[str, ...] = ()
    timestamps: tuple[str, ...] = ()
    required_timestamps: tuple[str, ...] = ()
    grain: tuple[str, ...] = ()
    url_column: str | None = None


# The four tables of a release.
RELEASE_CONTRACTS: tuple[Contract, ...] = (
    Contract(
        "latest_post_metrics",
        ("board_id", "board_name", "post_id", "analysis_unit", "title", "published_at",
         "source_url", "current_category", "observed_at_slot_kst", "observed_at_actual", "views",
         "recommendations", "comments", "config_version"),
        integers=("board_id", "post_id", "views", "recommendations", "comments"),
        required_text=("board_name", "analysis_unit", "title", "source_url", "current_category",
                       "config_version"),
        timestamps=("published_at", "observed_at_slot_kst", "observed_at_actual"),
        required_timestamps=("published_at", "observed_at_slot_kst", "observed_at_actual"),
        grain=("board_id", "post_id"),
        url_column="source_url",
    ),
    Contract(
        "cumulative_top50",
        ("analysis_unit", "metric", "as_of_slot_kst", "rank", "board_id", "post_id", "title",
         "source_url", "metric_value", "config_version"),
        integers=("rank", "board_id", "post_id", "metric_value"),
        required_text=("analysis_unit", "metric", "title", "source_url", "config_version"),
        timestamps=("as_of_slot_kst",),
        required_timestamps=("as_of_slot_kst",),
        grain=("analysis_unit", "metric", "as_of_slot_kst", "rank"),
        url_column="source_url",
    ),
    Contract(
        "collection_runs",
        ("id", "job_type", "scheduled_at_slot_kst", "status", "config_version", "started_at",
         "finished_at", "diagnostics"),
        required_text=("id", "job_type", "status", "config_version"),
        timestamps=("scheduled_at_slot_kst", "started_at", "finished_at"),
        required_timestamps=("scheduled_at_slot_kst",),
        grain=("id",),
    ),
    Contract(
        "security_quarantine",
        ("id", "source_kind", "source_ref", "content_hash", "findings", "risk_score",
         "quarantined_at", "review_state", "reviewer", "note", "released_at"),
        integers=("risk_score",),
        required_text=("id", "source_kind", "source_ref", "content_hash", "findings",
                       "review_state"),
        timestamps=("quarantined_at", "released_at"),
        required_timestamps=("quarantined_at",),
        grain=("id",),
    ),
)


class ContractError(ValueError):
    """A table does not keep its contract."""


def utc_timestamp(text: Column) -> Column:
    """Timestamp text as naive UTC; text without an offset is taken as UTC; null if unreadable."""
    return _utc_from_clean(strip(text))


# Times as releases write them; they are UTC and need none of the rules for offsets.
_PLAIN_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]{1,6})?\z"
# Text that begins and ends with a visible character, so that there is nothing to strip.
_BARE = r"(?s)^[!-~가-힣](?:.*[!-~가-힣])?\z"


def _utc_from_clean(clean: Column) -> Column:
    plain = clean.rlike(_PLAIN_TIME)
    return F.when(plain, clean.try_cast("timestamp_ntz")).otherwise(_utc_by_rules(clean))


def _stripped(text: Column) -> Column:
    return F.when(text.rlike(_BARE), text).otherwise(strip(text))


def _utc_by_rules(clean: Column) -> Column:
    zoned = F.regexp_replace(clean, r"([+-][0-9]{2})\z", "$1:00")
    has_time = clean.rlike(r"[0-9]:[0-9]{2}")
    has_zone = clean.rlike(r"(?:Z|[0-9]:[0-9]{2}(?::[0-9.]+)?\s*[+-][0-9]{2}(?::?[0-9]{2})?)\z")
    whole = (
        F.when(has_time & has_zone, zoned)
        .when(has_time, F.concat(clean, F.lit("Z")))
        .otherwise(F.concat(clean, F.lit("T00:00:00Z")))
    )
    instant = whole.try_cast("timestamp")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), instant.cast("timestamp_ntz"))


def _clean(column: str) -> str:
    return f"_clean_{column}"


def _instant(column: str) -> str:
    return f"_at_{column}"


def _prepared(strings: DataFrame, contract: Contract) -> DataFrame:
    """Stripped text and parsed times of the ruled columns, computed once per row."""
    ruled = sorted({*contract.required_text, *contract.integers, *contract.timestamps})
    cleaned = strings.withColumns({_clean(c): _stripped(F.coalesce(c, F.lit(""))) for c in ruled})
    if not contract.timestamps:
        return cleaned
    return cleaned.withColumns({
        _instant(c): _utc_from_clean(F.col(_clean(c))) for c in contract.timestamps
    })


def _row_failures(contract: Contract) -> Column:
    failures = []

    def fail(condition: Column, column: str, rule: str) -> None:
        failures.append(F.when(
            F.coalesce(condition, F.lit(True)),
            F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule")),
        ))

    for column in contract.required_text:
        fail(F.col(_clean(column)) == "", column, "blank")
    for column in contract.integers:
        raw = F.col(_clean(column))
        digits = raw.rlike(r"^[0-9]+\z")

        def broken(rule: str) -> Column:
            return F.struct(F.lit(column).alias("column"), F.lit(rule).alias("rule"))

        # At most one of these rules is broken, and most values break none.
        failures.append(
            F.when(raw.rlike(r"^[0-9]{1,18}\z"), F.lit(None))
            .when(raw.rlike(r"^-[0-9]+\z"), broken("negative"))
            .when(~digits, broken("integer"))
            .when(raw.try_cast("bigint").isNull(), broken("range"))
        )
    for column in contract.timestamps:
        value = F.col(_clean(column))
        fail((value != "") & F.col(_instant(column)).isNull(), column, "timestamp")
        if column in contract.required_timestamps:
            fail(value == "", column, "missing")
    return F.array_compact(F.array(*failures))


# Raw line of a CSV row whose number of fields is not the contract's.
MALFORMED = "_malformed"


def check_columns(frame: DataFrame, contract: Contract) -> None:
    if tuple(frame.columns) not in (contract.columns, (*contract.columns, MALFORMED)):
        raise ContractError(f"{contract.name}: columns do not match the contract")


def apply_contract(
    strings: DataFrame, contract: Contract, host: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(rows, violations)`` of an all-string table.

    ``rows`` are the typed rows that break no row rule; ``violations`` counts broken
    rules as ``(table, column, rule, n)``, duplicate grain rows included.
    """
    judged = judge(strings, contract, host)
    return judged_rows(judged, contract), judged_violations(judged, contract)


def _grain(column: str) -> str:
    return f"_grain_{column}"


def judge(strings: DataFrame, contract: Contract, host: str | None = None) -> DataFrame:
    """Every row once: its typed columns, ``_failed`` rules, whether it ``_fits`` and its grain.

    Stored, it serves both :func:`judged_rows` and :func:`judged_violations`, so that a table
    is parsed and its rules are asked once.
    """
    check_columns(strings, contract)
    failures, fits = _row_failures(contract), F.lit(True)
    if MALFORMED in strings.columns:
        # Fields of such a row cannot be told apart: one violation, and no other rule is asked.
        misfit = F.array(F.struct(F.lit("*").alias("column"), F.lit("fields").alias("rule")))
        fits = F.col(MALFORMED).isNull()
        failures = F.when(~fits, misfit).otherwise(failures)
    return _prepared(strings, contract).select(
        *[_typed(c, contract, host) for c in contract.columns], failures.alias("_failed"),
        fits.alias("_fits"), *[F.col(c).alias(_grain(c)) for c in contract.grain],
    )


def judged_rows(judged: DataFrame, contract: Contract) -> DataFrame:
    """The typed rows that break no row rule."""
    return judged.where(F.size("_failed") == 0).select(*contract.columns)


def judged_violations(judged: DataFrame, contract: Contract) -> DataFrame:
    """Broken rules counted as ``(table, column, rule, n)``, duplicate grain rows included."""
    # The outer form keeps Spark from repeating the rules in a filter below the explode.
    broken = (
        judged.select(F.explode_outer("_failed").alias("f"))
        .where(F.col("f").isNotNull())
        .groupBy(F.col("f.column").alias("column"), F.col("f.rule").alias("rule"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parts = [broken.select(F.lit(contract.name).alias("table"), "column", "rule", "n")]
    if contract.grain:
        # Written text, not values: a row that breaks a rule is a copy like any other.
        copies = judged.where("_fits").groupBy(*[_grain(c) for c in contract.grain]).agg(
            F.count(F.lit(1)).alias("n")
        )
        parts.append(
            copies.where(F.col("n") > 1)
            .agg(F.sum(F.col("n") - 1).alias("n"))
            .where(F.col("n") > 0)
            .select(
                F.lit(contract.name).alias("table"), F.lit(",".join(contract.grain)).alias("column"),
                F.lit("duplicate").alias("rule"), "n",
            )
        )
    return reduce(DataFrame.unionByName, parts)


def _typed(column: str, contract: Contract, host: str | None) -> Column:
    value = F.col(column)
    if column in contract.integers:
        return F.col(_clean(column)).try_cast("bigint").alias(column)
    if column in contract.timestamps:
        return F.col(_instant(column)).alias(column)
    if column == contract.url_column and host is not None:
        return F.coalesce(approved_url(value, host), F.lit("")).alias(column)
    return value


def assert_contract(violations: DataFrame) -> None:
    """Raise on the first few violations (reads back at most ten counted rules)."""
    found = violations.limit(10).collect()
    if found:
        lines = ", ".join(f"{r['table']}.{r['column']} {r['rule']} x{r['n']}" for r in found)
        raise ContractError(f"contract violations: {lines}")


def read_strings(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """CSV rows with every column as text, and :data:`MALFORMED` for the rows that do not fit.

    Every file's own header must name the contract's columns in their order; a file that does
    not fails the job that reads it. Rows with missing or extra fields keep their raw line in
    the last column and become violations. Columns are not pruned while parsing, so that a
    malformed row is found whatever a query selects.
    """
    schema = ", ".join(f"`{name}` STRING" for name in (*contract.columns, MALFORMED))
    return (
        spark.read.schema(schema)
        .options(header="true", multiLine="true", quote='"', escape='"', encoding="UTF-8",
                 enforceSchema="false", mode="PERMISSIVE", columnPruning="false",
                 columnNameOfCorruptRecord=MALFORMED)
        .csv(path)
    )


def as_strings(frame: DataFrame) -> DataFrame:
    """Every column as text, for checking a table as if it had arrived in a CSV file."""
    return frame.select(*[F.col(c).cast("string").alias(c) for c in frame.columns])


def set_difference(left: DataFrame, right: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys on one side only: ``missing`` from the left, ``unexpected`` on the left.

    One aggregate over both sides, whose buffers are two flags: copies of a key are combined
    before the shuffle and nothing is sorted or held for a join. A key with a null equals none,
    so it is reported for every side that has it.
    """
    both = left.select(*keys, F.lit(True).alias("_left"), F.lit(False).alias("_right")).unionByName(
        right.select(*keys, F.lit(False).alias("_left"), F.lit(True).alias("_right"))
    )
    seen = both.groupBy(*keys).agg(F.max("_left").alias("_left"), F.max("_right").alias("_right"))
    alone = ~(F.col("_left") & F.col("_right")) | reduce(
        lambda a, b: a | b, [F.col(k).isNull() for k in keys]
    )
    status = F.array_compact(F.array(
        F.when(F.col("_right"), F.lit("missing")), F.when(F.col("_left"), F.lit("unexpected"))
    ))
    return seen.where(alone).select(*keys, F.explode(status).alias("status"))

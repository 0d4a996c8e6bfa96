"""Integers, URLs and spreadsheet-safe cells."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumtide.functions.text import SPACE, let, strip

# Integer text format of list pages and the number ranges.
GROUPED_INTEGER = r"^(?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+)\z"
MAX_BIGINT = 2**63 - 1
MAX_INT = 2**31 - 1

# Prefixes a spreadsheet reads as a formula.
FORMULA_PREFIX = r"^[=+\-@\t\r]"


def grouped_integer(value: Column, longest: int | None = None) -> Column:
    """Non-negative integer with optional well-formed thousands commas, else null.

    ``longest`` also refuses texts of more characters; leading zeros may make any length.
    """

    def read(compact: Column) -> Column:
        fits = compact.rlike(GROUPED_INTEGER)
        if longest is not None:
            fits = fits & (F.char_length(compact) <= longest)
        return F.when(fits, F.replace(compact, F.lit(","), F.lit("")).try_cast("bigint"))

    # Stripping costs more than reading, so it is left to texts that are no integer as they are.
    return F.when(value.rlike(GROUPED_INTEGER), read(value)).otherwise(let(strip(value), read))


@dataclass(frozen=True)
class Site:
    """Where the posts live: the only host and board path that count as ours."""

    host: str
    board_path: str
    category: str | None = None
    max_page: int = 100_000
    max_href: int | None = None

    def article_url(self, board_id: Column, post_id: Column) -> Column:
        return F.concat(
            F.lit(f"https://{self.host}{self.board_path}/"),
            board_id.cast("string"), F.lit("/"), post_id.cast("string"),
        )


def approved_url(url: Column, host: str) -> Column:
    """The stripped URL when it is https on exactly this host, else an empty string."""
    clean = strip(url)
    ours = rf"^(?i:https)://(?:[^/?#]*@)?(?i:{re.escape(host)})(?::[^/?#]*)?(?:[/?#]|\z)"
    return F.when(clean.rlike(ours), clean).otherwise(F.lit(""))


def article_identity(href: Column, board_id: Column, site: Site) -> Column:
    """``struct(post_id, url, reason)`` of a list-page link; ``reason`` is null when accepted."""
    host = re.escape(site.host)
    shape = (
        rf"^(?:(?i:https)://(?i:{host})(?::0*443|:)?)?"
        rf"{re.escape(site.board_path)}/([0-9]+)/([0-9]+)(?:\?([^#]*))?\z"
    )
    clean = F.coalesce(
        (href != "") & ~href.contains("#") & ~href.rlike(f"(?U){SPACE}"), F.lit(False)
    )
    if site.max_href is not None:
        clean = clean & (F.char_length(href) <= site.max_href)
    # Of an href of this shape, what stands before and after the first question mark.
    query = F.get(F.split(href, r"\?", 2), F.lit(1))
    path = F.substring_index(href, "?", 1)

    def known(pair: Column) -> Column:
        name, text = F.try_url_decode(F.get(pair, F.lit(0))), F.try_url_decode(F.get(pair, F.lit(1)))
        page = F.when(text.rlike(r"^[0-9]+\z"), text.try_cast("bigint"))
        found = (name == "p") & page.between(1, site.max_page)
        if site.category is not None:
            found = found | ((name == "category") & (text == site.category))
        return F.coalesce(found, F.lit(False))

    query_ok = ~href.contains("?") | (
        ~query.contains("&") & let(F.split(query, "=", 2), known)
    )
    ours = clean & href.rlike(shape)
    parts = F.struct(
        ours.alias("ours"),
        F.when(ours, F.substring_index(F.substring_index(path, "/", -2), "/", 1).try_cast("bigint"))
        .alias("board"),
        F.when(ours, F.substring_index(path, "/", -1).try_cast("bigint")).alias("post"),
    )

    def judged(part: Column) -> Column:
        reason = (
            F.when(~clean, "malformed")
            .when(~part["ours"], "foreign")
            .when(~query_ok, "query")
            .when(part["board"].isNull() | (part["board"] != board_id), "board")
            .when(part["post"].isNull() | (part["post"] < 1), "post")
        )
        return F.struct(part["post"].alias("post"), part["board"].alias("board"), reason.alias("reason"))

    def shown(found: Column) -> Column:
        accepted = found["reason"].isNull()
        return F.struct(
            F.when(accepted, found["post"]).alias("post_id"),
            F.when(accepted, site.article_url(found["board"], found["post"])).alias("url"),
            found["reason"].alias("reason"),
        )

    return let(let(parts, judged), shown)


def safe_cell(value: Column) -> Column:
    """Neutralise a string cell that a spreadsheet would run as a formula."""
    return F.when(value.rlike(FORMULA_PREFIX), F.concat(F.lit("'"), value)).otherwise(value)


def safe_cells(frame: DataFrame) -> DataFrame:
    """Apply :func:`safe_cell` to every string column."""
    names = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.StringType)]
    return frame.withColumns({name: safe_cell(F.col(name)) for name in names}) if names else frame

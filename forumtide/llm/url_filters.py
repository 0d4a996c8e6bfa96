"""URL filters: allow and block rules over host suffixes and path prefixes.

A rule names a host and the beginning of a path. It fits the host itself and every subdomain,
when the path of the URL begins with the rule's path. Of all fitting rules the longest wins
(code points of host and path together; then the longer host, then block before allow). What
no rule fits is allowed.

A URL is expanded into expressions, one per shape of rule: so many labels of the host's end,
so much of the path's beginning. Expressions meet rules in an equi-join on the first bytes of
their SHA-256; the full digests then confirm, so a rule list can be handed on as digests.
Only the part of a URL that some rule could look at matters: URLs are reduced to that head
and heads are judged once, so a host that owns a third of all pages is one row of the join.
Built-in functions only.

Defined results: the host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the
end, A-Z in lower case (a port or user stays part of it); the path follows up to ``?``, ``#`` or
the end. Without ``://``, or for a null URL, both are empty and no rule fits. An empty path
fits no rule. Repeated rows give repeated rows, a null id stays null, empty tables give no
rows, an empty rule list allows all. Input columns other than the id and the URL are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forumtide.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ALLOW, BLOCK = "allow", "block"
# Hexadecimal digits of the digest that the join compares: 4 bytes.
SHORT = 8
# (action, host, path)
RULES = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path of a URL, both empty without ``://``."""
    place = F.instr(url, "://")
    rest = F.when(place > 0, F.substr(url, place + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    after = F.substr(rest, F.char_length(host) + 1)
    return F.translate(host, UPPER, LOWER), F.regexp_extract(after, r"^[^?#]*", 0)


def _slashes(path: Column) -> Column:
    return F.char_length(path) - F.char_length(F.replace(path, F.lit("/"), F.lit("")))


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """Rules as action, host and path; any DataFrame of these columns serves as well."""
    return spark.createDataFrame(
        [tuple(rule) for rule in rules], "action string, host string, path string"
    )


def prepared(rules: DataFrame) -> DataFrame:
    """One row per distinct rule: digests, place in the precedence, and shape.

    A path that ends with a slash is cut from URLs after as many slashes, any other one after
    as many characters, so a URL has few expressions however many rules there are.
    """
    closed = F.col("path").endswith("/")
    distinct = rules.groupBy(F.translate("host", UPPER, LOWER).alias("host"), "path").agg(
        F.max("action").alias("action")  # block, if the list says both
    )
    rule = F.concat("host", "path")
    return distinct.select(
        "action", rule.alias("rule"), F.sha2(rule, 256).alias("digest"),
        F.char_length("host").alias("host_length"),
        _labels(F.col("host")).alias("labels"),
        F.when(closed, _slashes(F.col("path"))).otherwise(F.lit(0)).alias("slashes"),
        F.when(closed, F.lit(0)).otherwise(F.char_length("path")).alias("length"),
    )


def _path_part(path: Column, slashes: Column, length: Column) -> Column:
    """The beginning of a path that rules of one shape compare; null if it is too short."""
    to_slash = F.concat(F.call_function("substring_index", path, F.lit("/"), slashes), F.lit("/"))
    return F.when(
        slashes > 0, F.when(_slashes(path) >= slashes, to_slash)
    ).otherwise(F.when(F.char_length(path) >= length, F.substr(path, F.lit(1), length)))


def _host_part(host: Column, labels: Column) -> Column:
    return F.when(
        _labels(host) >= labels, F.call_function("substring_index", host, F.lit("."), -labels)
    )


def _expressions(shapes: Sequence) -> Column:
    """Array of the expressions of a URL's head, one per shape that it is long enough for."""
    made = F.transform(
        F.array(*[
            F.struct(F.lit(s["labels"]).alias("labels"), F.lit(s["slashes"]).alias("slashes"),
                     F.lit(s["length"]).alias("length"))
            for s in shapes
        ]),
        lambda s: F.concat(
            _host_part(F.col("_ft_host"), s["labels"]),
            _path_part(F.col("_ft_path"), s["slashes"], s["length"]),
        ),
    )
    return F.array_distinct(F.array_compact(made))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """The input's page_id with host, path, rule and verdict. This runs jobs.

    The shapes of the rules are read by the driver: distinct triples of small counts, bounded
    by the longest rule and not by the number of rules or pages.
    """
    host, path = host_and_path(F.col(url))
    parts = pages.select("page_id", host.alias("host"), path.alias("path"))
    table = materialize(prepared(rules), "url-rules")
    shapes = table.select("labels", "slashes", "length").distinct().collect()
    if not shapes:
        return parts.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(ALLOW).alias("verdict")
        )
    # What any rule could look at: the last labels, and the path through the last slash or
    # character that a shape cuts at.
    most = {name: max(s[name] for s in shapes) for name in ("labels", "slashes", "length")}
    closed = F.regexp_extract("path", rf"^(?:[^/]*/){{0,{most['slashes']}}}", 0)
    path_head = F.substr(
        F.col("path"), F.lit(1), F.greatest(F.char_length(closed), F.lit(most["length"]))
    )
    located = parts.withColumns({
        "_ft_host": F.substring_index("host", ".", -most["labels"]), "_ft_path": path_head,
    })
    heads = located.select("_ft_host", "_ft_path").where("_ft_path <> ''").distinct()
    exploded = heads.select("_ft_host", "_ft_path", F.explode(_expressions(shapes)).alias("_ft_e"))
    digests = exploded.select("_ft_host", "_ft_path", F.sha2("_ft_e", 256).alias("_ft_digest"))
    short = F.substr(F.col("_ft_digest"), F.lit(1), F.lit(SHORT))
    listed = table.withColumn("_ft_short", F.substr("digest", F.lit(1), F.lit(SHORT)))
    confirmed = digests.withColumn("_ft_short", short).join(listed, "_ft_short").where(
        F.col("_ft_digest") == F.col("digest")
    )
    precedence = F.struct(F.char_length("rule"), "host_length", "action", "rule")
    decided = confirmed.groupBy("_ft_host", "_ft_path").agg(F.max(precedence).alias("_ft_best"))
    verdicts = materialize(
        decided.select("_ft_host", "_ft_path", "_ft_best.rule", "_ft_best.action"), "url-heads"
    )
    return located.join(verdicts, ["_ft_host", "_ft_path"], "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("action", F.lit(ALLOW)).alias("verdict"),
    )

"""Raw HTML pages to records.

Each page becomes nested raw fields. A page whose markup is proven regular (one plain table
of rows written one way, no entities, comments or scripts) gives them to regular expressions
in the JVM; any other page goes to the standard HTML parser in a task. Every rule about those
fields (URLs, numbers, times, row kinds, page rejection) is a Spark expression over the nested
rows, so no row needs Python again and pages are judged without a shuffle.
"""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from forumtide.functions.text import is_stable, let, once_per_row, plain_text
from forumtide.functions.time import source_time
from forumtide.functions.values import Site, article_identity, grouped_integer
from forumtide.operators.validate import map_units, row_kind

# Header, cell classes and markers of list pages.
HEADER = ("번호", "제목", "글쓴이", "등록일", "조회", "추천")
CELL_CLASSES = ("num", "tit", "user", "date", "view", "reco")
TITLE_CELL, DATE_CELL, VIEWS_CELL, RECO_CELL = 1, 3, 4, 5
WRAP_CLASS, LINK_CLASS, CATEGORY_CLASS, COMMENT_CLASS = (
    "text-wrap", "subject-link", "category", "con-comment",
)
LABEL_CLASSES = ("row-label", "label")
CATEGORY_MARK = r"^\[([^\]\[\r\n]+)\]\z"
COMMENT_MARK = r"^\[((?:[0-9]+|[0-9]{1,3}(?:,[0-9]{3})+))\]\z"

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}
_ENDS_BEFORE = {"tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
                "tbody": {"thead", "tbody", "tr", "td", "th"}}

_RAW = (
    "header STRING, rows ARRAY<STRUCT<classes: ARRAY<STRING>, row_text: STRING, "
    "cell_classes: ARRAY<STRING>, cells: ARRAY<STRING>, wraps: INT, links: INT, "
    "article_links: INT, href: STRING, category_marks: INT, lead: STRING, category: STRING, "
    "title: STRING, comment_marks: INT, comment: STRING, label: STRING>>"
)


class _Element:
    __slots__ = ("tag", "attrs", "children", "parent")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.children, self.parent = tag, attrs, [], parent

    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self):
        for child in self.children:
            if isinstance(child, _Element):
                yield child
                yield from child.walk()

    def all(self, tag: str, cls: str | None = None) -> list["_Element"]:
        return [e for e in self.walk() if e.tag == tag and (cls is None or cls in e.classes())]

    def direct(self, tag: str, cls: str | None = None) -> list["_Element"]:
        return [
            e for e in self.children
            if isinstance(e, _Element) and e.tag == tag and (cls is None or cls in e.classes())
        ]

    def text(self) -> str:
        return " ".join(_texts(self.children).split())

    def raw_text(self) -> str:
        return "".join(c.raw_text() if isinstance(c, _Element) else c for c in self.children)


def _texts(nodes) -> str:
    parts = [n.text() if isinstance(n, _Element) else n.strip() for n in nodes]
    return " ".join(" ".join(p for p in parts if p).split())


class _Tree(HTMLParser):
    """Builds just enough of a tree to look at one table."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Element("", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in _ENDS_BEFORE:
            while self.at.tag in _ENDS_BEFORE[tag]:
                self.at = self.at.parent
        node = _Element(tag, dict(attrs), self.at)
        self.at.children.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(_Element(tag, dict(attrs), self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.children.append(data)


def _row_fields(row: _Element, board_path: str) -> tuple:
    cells = row.direct("td")
    title_cell = cells[TITLE_CELL] if len(cells) > TITLE_CELL else _Element("td", {}, None)
    wraps = title_cell.direct("div", WRAP_CLASS)
    wrap = wraps[0] if wraps else _Element("div", {}, None)
    links = [a for a in wrap.all("a", LINK_CLASS) if a.attrs.get("href") is not None]
    article = [a for a in wrap.all("a") if f"{board_path}/" in (a.attrs.get("href") or "")]
    link = links[0] if links else _Element("a", {}, None)
    marks = title_cell.all("span", CATEGORY_CLASS)
    direct = link.direct("span", CATEGORY_CLASS)
    single = len(marks) == 1 and len(direct) == 1 and marks[0] is direct[0]
    lead = title = category = ""
    if single:
        at = next(i for i, child in enumerate(link.children) if child is marks[0])
        lead, title = _texts(link.children[:at]), _texts(link.children[at + 1:])
        category = unicodedata.normalize("NFKC", marks[0].raw_text()).strip()
    comments = wrap.direct("span", COMMENT_CLASS)
    labels = [e for e in title_cell.walk() if set(e.classes()) & set(LABEL_CLASSES)]
    return (
        row.classes(), row.text(), [" ".join(c.classes()).casefold() for c in cells],
        [c.text() for c in cells], len(wraps), len(links),
        len(article) if article and article[0] is link else -len(article),
        link.attrs.get("href"), 1 if single else 0, lead, category, title, len(comments),
        comments[0].text() if comments else "", labels[0].text() if labels else "",
    )


_ROW_NAMES = (
    "classes", "row_text", "cell_classes", "cells", "wraps", "links", "article_links", "href",
    "category_marks", "lead", "category", "title", "comment_marks", "comment", "label",
)


def page_fields(html: bytes, board_path: str) -> tuple[str, list[dict]]:
    """Header state and raw row fields of one list page."""
    try:
        text = html.decode("utf-8")
    except UnicodeDecodeError:
        return "not utf-8", []
    tree = _Tree()
    tree.feed(text)
    tree.close()
    state = "missing"
    for table in tree.root.all("table"):
        names = [c.text() for head in table.all("thead") for c in head.all("th")]
        if tuple(names) == HEADER:
            rows = [r for body in table.all("tbody") for r in body.all("tr")]
            return "ok", [dict(zip(_ROW_NAMES, _row_fields(r, board_path))) for r in rows]
        if set(names) & set(HEADER):
            state = "incomplete"
    return state, []


# Tags that may stand around the table of a regular page: they hold text and hide nothing.
_FRAME_TAGS = "html|head|body|main|section|div|p|span|b|ul|li|h1|h2|h3|br|hr"
# No run is given back: what follows it is never one of its characters.
_VALUE, _TEXT, _GAP = r'([^"<>&]*+)', r"([^<>&]*+)", r"[ \t\n\r]*+"
_REGULAR_CELL = rf'<td class="{_VALUE}">{_TEXT}</td>{_GAP}'
# Groups: 1 row classes; 2, 3 first cell; 4 title cell classes; 5 href; 6 category; 7 title;
# 8 comment; 9 label; then class and text of the last four cells.
_REGULAR_ROW = (
    rf'<tr class="{_VALUE}">{_GAP}{_REGULAR_CELL}<td class="{_VALUE}">{_GAP}'
    rf'<div class="{WRAP_CLASS}">{_GAP}<a class="{LINK_CLASS}" href="{_VALUE}">{_GAP}'
    rf'<span class="{CATEGORY_CLASS}">{_TEXT}</span>{_TEXT}</a>{_GAP}'
    rf'<span class="{COMMENT_CLASS}">{_TEXT}</span>{_GAP}</div>{_GAP}'
    rf'(?:<span class="(?:{"|".join(LABEL_CLASSES)})">{_TEXT}</span>{_GAP})?</td>{_GAP}'
    + _REGULAR_CELL * 4 + "</tr>"
)
# A row's fields in one string; stable text has none of the marks.
_ROW_MARK, _FIELD_MARK, _END_MARK = "\x01", "\x02", "\x03"
_MARKED_ROW = _ROW_MARK + _FIELD_MARK.join(f"${i}" for i in range(1, 18)) + _END_MARK
_REGULAR_HEAD = (
    rf"<thead>{_GAP}<tr>{_GAP}" + _GAP.join(f"<th>{name}</th>" for name in HEADER)
    + rf"{_GAP}</tr>{_GAP}</thead>"
)


def _between(text: Column, start: str, end: str) -> Column:
    return F.substring_index(F.substring_index(text, start, -1), end, 1)


def regular_rows(text: Column) -> Column:
    """The rows of a page as marked fields if the page is regular, else null.

    Everything around the rows is checked, and what is left of the table once the rows are
    taken out must be blank, so nothing that the HTML parser would see is passed over. The
    row pattern passes over the table once, whatever the number of rows and fields.
    """

    def once(part: str) -> Column:
        return F.char_length(text) - F.char_length(F.replace(text, F.lit(part), F.lit(""))) == len(part)

    head = F.substring_index(text, "<tbody>", 1)
    around = F.concat(
        F.substring_index(text, "<table>", 1), F.lit("\n"), F.substring_index(text, "</table>", -1)
    )
    body = _between(text, "<tbody>", "</tbody>")
    regular = (
        is_stable(text) & ~text.contains("&")
        & once("<table>") & once("<tbody>") & once("</tbody>") & once("</table>")
        & head.rlike(rf"<table>{_GAP}{_REGULAR_HEAD}{_GAP}\z")
        & text.rlike(rf"</tbody>{_GAP}</table>")
        & ~F.regexp_replace(around, rf"</?(?:{_FRAME_TAGS})>", "").rlike("[<>]")
    )

    def marked_rows(marked: Column) -> Column:
        left = F.regexp_replace(marked, f"{_ROW_MARK}[^{_END_MARK}]*+{_END_MARK}", "")
        pieces = F.split(marked, _ROW_MARK)
        return F.when(
            F.btrim(left, F.lit(" \t\n\r")) == "", F.slice(pieces, F.lit(2), F.size(pieces))
        )

    return F.when(regular, let(F.regexp_replace(body, _REGULAR_ROW, _MARKED_ROW), marked_rows))


def _regular_fields(rows: Column, site: Site) -> Column:
    """The raw fields of a regular page's rows, as :func:`page_fields` gives them."""

    def fields(row: Column) -> Column:
        part = F.struct(
            F.split(F.substring_index(row, _END_MARK, 1), _FIELD_MARK).alias("held"),
            row.rlike("[\\t\\n\\r]|  ").alias("spaced"),
        )

        def made(found: Column) -> Column:
            held = found["held"]

            def at(group: int) -> Column:
                value = F.get(held, F.lit(group - 1))
                return F.trim(
                    F.when(found["spaced"], F.regexp_replace(value, r"[ \t\n\r]+", " "))
                    .otherwise(value)
                )

            def names(group: int) -> Column:
                return F.lower(at(group))

            last = [10, 12, 14, 16]
            blank = F.lit("")
            return F.struct(
                F.array_remove(F.split(at(1), " "), "").alias("classes"), blank.alias("row_text"),
                F.array(names(2), names(4), *[names(g) for g in last]).alias("cell_classes"),
                F.array(at(3), blank, *[at(g + 1) for g in last]).alias("cells"),
                F.lit(1).alias("wraps"), F.lit(1).alias("links"),
                F.get(held, F.lit(4)).contains(f"{site.board_path}/").cast("int")
                .alias("article_links"),
                F.get(held, F.lit(4)).alias("href"), F.lit(1).alias("category_marks"),
                blank.alias("lead"),
                F.btrim(F.get(held, F.lit(5)), F.lit(" \t\n\r")).alias("category"),
                at(7).alias("title"), F.lit(1).alias("comment_marks"), at(8).alias("comment"),
                at(9).alias("label"),
            )

        return let(part, made)

    return F.struct(F.lit("ok").alias("header"), F.transform(rows, fields).alias("rows"))


def _checked_row(row: Column, board_id: Column, fetched_at: Column, site: Site) -> Column:
    """One raw row as typed fields with the first broken rule as ``reason``."""
    n_cells = F.size(row["cells"])
    mark = F.regexp_extract(row["comment"], COMMENT_MARK, 1)

    def cell(at: int) -> Column:
        return F.get(row["cells"], F.lit(at))

    typed = F.struct(
        article_identity(row["href"], board_id, site).alias("link"),
        F.trim(F.regexp_extract(row["category"], CATEGORY_MARK, 1)).alias("category"),
        F.when(row["comment"] == "", F.lit(0).cast("bigint")).otherwise(grouped_integer(mark))
        .alias("comments"),
        row_kind(row["classes"], row["label"]).alias("kind"),
        source_time(cell(DATE_CELL), fetched_at).alias("published_at"),
        grouped_integer(cell(VIEWS_CELL)).alias("views"),
        grouped_integer(cell(RECO_CELL)).alias("recommendations"),
    )
    classes_ok = F.lit(True)
    for at, name in enumerate(CELL_CLASSES):
        held = F.concat(F.lit(" "), F.get(row["cell_classes"], F.lit(at)), F.lit(" "))
        classes_ok = classes_ok & F.coalesce(held.contains(f" {name} "), F.lit(False))

    def judged(field: Column) -> Column:
        empty = (n_cells == 0) & (row["row_text"] == "")
        reason = (
            F.when(empty, F.lit(None).cast("string"))
            .when(n_cells != len(HEADER), "cell count")
            .when(~classes_ok, "cell classes")
            .when(row["wraps"] != 1, "title structure")
            .when(row["links"] != 1, "anchor")
            .when(row["article_links"] != 1, "ambiguous url")
            .when(field["link"]["reason"].isNotNull(),
                  F.concat(F.lit("url "), field["link"]["reason"]))
            .when((row["category_marks"] != 1) | (field["category"] == ""), "category")
            .when((row["lead"] != "") | (row["title"] == ""), "title")
            .when((row["comment_marks"] != 1) | field["comments"].isNull(), "comments")
            .when(field["kind"]["ambiguous"], "row kind")
            .when(field["published_at"].isNull(), "date")
            .when(field["views"].isNull(), "views")
            .when(field["recommendations"].isNull(), "recommendations")
        )
        return F.struct(
            empty.alias("empty"), reason.alias("reason"),
            field["link"]["post_id"].alias("post_id"), field["category"].alias("category"),
            row["title"].alias("title"), field["published_at"].alias("published_at"),
            field["views"].alias("views"), field["recommendations"].alias("recommendations"),
            field["comments"].alias("comments"), field["link"]["url"].alias("source_url"),
            field["kind"]["is_notice"].alias("is_notice"), field["kind"]["is_ad"].alias("is_ad"),
        )

    return let(typed, judged)


def parse_list_pages(pages: DataFrame, site: Site, max_bytes: int | None = None) -> DataFrame:
    """Pages with their checked ``rows`` and a ``reject_reason``, null when accepted.

    ``pages`` has ``board_id, html BINARY, fetched_at`` and any identifying columns. One
    broken row rejects its page; a page without article rows is rejected too, as is one of
    more than ``max_bytes`` where that is given. Refused pages never reach Python.
    """
    board_path = site.board_path

    @once_per_row
    @pandas_udf(_RAW)
    def extract(bodies: pd.Series) -> pd.DataFrame:
        done = [(None, []) if b is None else page_fields(bytes(b), board_path) for b in bodies]
        return pd.DataFrame(done, columns=["header", "rows"])

    size = F.octet_length("html")
    oversized = F.lit(False) if max_bytes is None else F.coalesce(size > max_bytes, F.lit(False))
    sized = F.coalesce(size > 0, F.lit(False)) & ~oversized
    text = F.col("html").cast("string")
    found = pages.withColumn(
        "_regular", F.when(sized & F.is_valid_utf8(text), regular_rows(text))
    )
    raw = found.withColumn(
        "_parsed", extract(F.when(sized & F.col("_regular").isNull(), F.col("html")))
    ).withColumn(
        "_raw", F.when(F.col("_regular").isNotNull(), _regular_fields(F.col("_regular"), site))
        .otherwise(F.col("_parsed"))
    ).drop("_regular", "_parsed")
    checked = raw.withColumn(
        "rows",
        F.transform(
            "_raw.rows",
            lambda r: _checked_row(r, F.col("board_id"), F.col("fetched_at"), site),
        ),
    )
    broken = F.get(F.filter(F.transform("rows", lambda r: r["reason"]), lambda x: x.isNotNull()), F.lit(0))
    articles = F.size(F.filter("rows", lambda r: ~r["empty"]))
    reason = (
        F.when(F.coalesce(size, F.lit(0)) == 0, "empty page")
        .when(oversized, "oversized page")
        .when(F.col("_raw.header") != "ok", F.concat(F.lit("header "), F.col("_raw.header")))
        .when(broken.isNotNull(), broken)
        .when(articles == 0, "no article rows")
    )
    return checked.withColumn("reject_reason", reason).drop("_raw", "html")


def list_records(parsed: DataFrame, unit_map: DataFrame) -> DataFrame:
    """Observations of the accepted pages; categories without a unit are dropped."""
    keep = [c for c in parsed.columns if c not in ("rows", "reject_reason")]
    # A filter on the reason would be pushed below the rules and have them computed twice.
    accepted = F.when(F.col("reject_reason").isNull(), F.col("rows"))
    rows = (
        parsed.select(*keep, F.posexplode_outer(accepted).alias("pos", "r"))
        .where(~F.col("r.empty"))
        .select(*keep, "pos", "r.*")
        .drop("empty", "reason")
    )
    return map_units(rows, unit_map, "analysis_unit").where(F.col("analysis_unit").isNotNull())


class _Container(HTMLParser):
    """Source offsets of the first container matching a tag and optional id."""

    def __init__(self, source: str, tag: str, element_id: str | None) -> None:
        super().__init__(convert_charrefs=True)
        self.source, self.tag, self.element_id = source, tag, element_id
        self.lines = [0]
        for line in source.split("\n"):
            self.lines.append(self.lines[-1] + len(line) + 1)
        self.depth, self.start, self.end = 0, None, None
        self.feed(source)
        self.close()

    def _offset(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if self.end is not None or tag != self.tag:
            return
        if self.start is not None:
            self.depth += 1
        elif self.element_id is None or dict(attrs).get("id") == self.element_id:
            self.start = self._offset() + len(self.get_starttag_text())
            self.depth = 1

    def handle_endtag(self, tag):
        if self.start is None or self.end is not None or tag != self.tag:
            return
        self.depth -= 1
        if self.depth == 0:
            self.end = self._offset()


def container_markup(source: str, tag: str, element_id: str | None) -> str | None:
    found = _Container(source, tag, element_id)
    return None if found.start is None else source[found.start:found.end]


def parse_articles(
    pages: DataFrame, column: str = "html", tag: str = "div", element_id: str | None = None
) -> DataFrame:
    """Add ``body`` (plain text of the container) and ``error`` when there is none.

    Pages without the container's tag are answered in the JVM.
    """

    @once_per_row
    @pandas_udf("string")
    def inside(sources: pd.Series) -> pd.Series:
        return pd.Series(
            [None if s is None else container_markup(s, tag, element_id) for s in sources],
            dtype=object,
        )

    may_hold = F.col(column).rlike(f"(?i)<{tag}[\\s>/]")
    found = pages.withColumn("_inner", inside(F.when(may_hold, F.col(column))))
    return (
        found.withColumn("body", plain_text(F.col("_inner")))
        .withColumn("error", F.when(F.col("_inner").isNull(), "article body is missing"))
        .drop("_inner")
    )

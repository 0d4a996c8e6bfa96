"""Regular list pages are read in the JVM, and exactly as the HTML parser reads them."""

import random

from pyspark.sql import functions as F

from forumtide.sources import pages
from tests.test_sources import FETCHED, HEAD, SITE, list_row

AFTER = '<html><body><div>menu <b>x</b></div>{table}<p>end</p></body></html>'


def _page(*rows, gap=""):
    return AFTER.format(table=f"<table>{gap}{HEAD}{gap}<tbody>{gap.join(rows)}{gap}</tbody>{gap}</table>")


def _plain_row(rng):
    """A row as the site writes it; now and then one field is faulty."""
    gap = rng.choice(["", " ", "\n  "])

    def one_of(good, bad):
        return rng.choice(bad if rng.random() < 0.04 else good)

    row = list_row(
        rng.randint(1, 99), category=one_of(["[히어로]", "[ a ]"], ["x", "[]"]),
        title=one_of(["제목", " two  words ", "ünï\tcode\n!"], [""]),
        comment=one_of(["[3]", "", "[1,234]"], ["n"]),
        date=one_of(["07-15", "11:59", "2026-07-01"], ["soon"]),
        views=one_of(["1,234", " 7 "], ["-1"]), cls=one_of(["", "row ad", "Notice"], ["notice ad"]),
        board=one_of([2294], [7]),
    )
    if rng.random() < 0.3:
        row = row.replace("</div></td>", '</div><span class="label">광고</span></td>')
    return row.replace("><td", f">{gap}<td")


IRREGULAR = [
    _page(list_row(title="a &amp; b")), _page(list_row(title="a<b>c</b>")), _page(list_row(title="nb\xa0sp")),
    _page(list_row(title="ﬁ ligature")), _page(list_row(), "<tr></tr>"), _page(list_row(), "stray"),
    _page(list_row().replace('<td class="num">', "<td class='num'>")), _page(list_row().replace("<tr", "<TR")),
    _page(list_row()).replace("<div>menu", "<script>'<tbody>'</script><div>menu"),
    _page(list_row()).replace("<p>end", "<table></table><p>end"), _page(list_row(), list_row(cells="<td></td>")),
    _page(list_row()).replace("<th>조회</th>", "<th>본 수</th>"), _page(list_row()).replace("<div>menu", "<!-- <div>menu -->"),
    _page(list_row()).replace("<table>", "<title><table></title><table>"), _page(list_row()).replace("<p>end", "a < b"),
    _page(list_row(lead="pre")), _page(list_row(anchor="<i>x</i>")), _page(list_row()).replace("</table>", "</table"),
]


def _frame(spark, htmls):
    rows = [(i, 2294, h.encode(), FETCHED) for i, h in enumerate(htmls)]
    return spark.createDataFrame(rows, "page INT, board_id INT, html BINARY, fetched_at TIMESTAMP_NTZ")


def _regular(spark, htmls):
    text = F.col("html").cast("string")
    return [r[0] for r in _frame(spark, htmls).orderBy("page").select(
        pages.regular_rows(text).isNotNull()).collect()]


def test_regular_pages_read_like_the_parser_reads_them(spark):
    rng = random.Random(2)
    htmls = [
        _page(*[_plain_row(rng) for _ in range(rng.randint(1, 4))], gap=rng.choice(["", "\n", " \t"]))
        for _ in range(300)
    ]
    assert all(_regular(spark, htmls))
    # A comment at the end changes nothing for the parser and makes a page irregular.
    twins = [html + "<!---->" for html in htmls]
    assert not any(_regular(spark, twins))
    one, two = (
        [str(r) for r in pages.parse_list_pages(_frame(spark, h), SITE).orderBy("page").collect()]
        for h in (htmls, twins)
    )
    assert one == two and sum("reject_reason=None" in r for r in one) > 10


def test_other_pages_are_left_to_the_parser(spark):
    assert not any(_regular(spark, IRREGULAR))


def test_a_large_regular_page(spark):
    html = _page(*[list_row(i + 1) for i in range(20_000)])
    got = pages.parse_list_pages(_frame(spark, [html]), SITE).first()
    assert got["reject_reason"] is None and len(got["rows"]) == 20_000
    assert _regular(spark, [html]) == [True]


def test_the_supplied_page_records_need_no_python(spark):
    from forumtide.plans.intake import _list_pages

    made = _list_pages(spark, "/root/testdata/sf0.001")
    text = F.col("html").cast("string")
    left = made.where(pages.regular_rows(text).isNull()).count()
    assert made.count() > 50 and left == 0


def test_each_page_passes_the_rules_once(spark):
    """Dropping refused pages does not have the rules of all rows computed a second time."""
    from forumtide.plans.intake import page_records

    made = page_records(spark, "/root/testdata/sf0.001")
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ambiguous url") == 1

import re
import unicodedata

from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from forumtide.functions.text import (
    COMMON_CHARS,
    STABLE_CHARS,
    collapse_space,
    digest,
    fold,
    is_stable,
    nfkc,
    normal_form,
    plain_text,
    strip,
    strip_markup,
)
from forumtide.functions.values import (
    Site,
    approved_url,
    article_identity,
    grouped_integer,
    safe_cells,
)

SITE = Site("forum.example.com", "/board/main", category="히어로")


def column(spark, values, *expressions):
    frame = spark.createDataFrame(list(enumerate(values)), "i INT, v STRING")
    rows = frame.select("i", *[e.alias(f"o{n}") for n, e in enumerate(expressions)]).orderBy("i")
    return [tuple(r)[1:] for r in rows.collect()]


def test_stable_characters_need_no_normalisation():
    classes = [re.compile(f"[{c}]") for c in (STABLE_CHARS, COMMON_CHARS)]
    stable = [chr(c) for c in range(0x110000) if classes[0].match(chr(c))]
    assert len(stable) > 30_000
    assert all(c in set(stable) for c in map(chr, range(0x110000)) if classes[1].match(c))
    for char in stable:
        assert unicodedata.normalize("NFKC", char) == char
        assert unicodedata.combining(char) == 0
        assert char in "\n\t\r" or unicodedata.category(char) not in ("Cc", "Cf")
        assert char.casefold() == char.lower().replace("ß", "ss")
    # No stable character joins the one before it.
    for before in "aAe가각ㄱかカ一":
        for char in stable[:400] + stable[-400:]:
            assert unicodedata.normalize("NFKC", before + char) == (
                unicodedata.normalize("NFKC", before) + char
            )


SAMPLES = [
    "", " ", "Plain  text\n here ", "ＦＵＬＬ　width", "Straße GROSS", "İstanbul", "ﬁne ①②",
    "가나다 라마", "각", "é", "a​b", "a\x1cb", "tab\tand\r\nline", "ß", "Μάϊος", "\xa0x\xa0",
    "naïve Ünïcode", "漢字かなカナ", "µ ª º ¼",
]


def test_normal_form_equals_python(spark):
    got = column(spark, SAMPLES, normal_form(F.col("v")), nfkc(F.col("v")))
    assert got == [(fold(s), unicodedata.normalize("NFKC", s)) for s in SAMPLES]


def test_null_text_stays_null(spark):
    exprs = [normal_form(F.col("v")), nfkc(F.col("v")), plain_text(F.col("v")), digest(F.col("v"))]
    assert column(spark, [None], *exprs) == [(None,) * 4]


def test_random_texts_fold_alike(spark):
    found = []

    @given(st.lists(st.text(alphabet=st.sampled_from(
        list("aZß éÉ가ㄱ①Ａ​\xa0́\t\n -–") + ["ᄒ", "ᅡ"]), max_size=12),
        min_size=40, max_size=60))
    def collect(texts):
        found.extend(texts)

    collect()
    texts = sorted(set(found))
    got = column(spark, texts, normal_form(F.col("v")), is_stable(F.col("v")))
    for text, (normal, stable) in zip(texts, got):
        assert normal == fold(text)
        if stable:
            assert unicodedata.normalize("NFKC", text) == text


def test_plain_text(spark):
    cases = [
        ("plain  text", "plain text"),
        ("<p>one</p><p>two</p>", "one two"),
        ("&lt;b&gt;bold&lt;/b&gt; &amp;amp; more", "bold & more"),
        ("a&nbsp;b&amp;nbsp;c", "a b c"),
        ("x<script>var a='</p>';</script>y<style>p{}</style>z", "x y z"),
        ("keep<!-- drop -->this", "keepthis"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("line<br>break<br/>end", "line break end"),
    ]
    markups, texts = zip(*cases)
    assert [strip_markup(m) for m in markups] == list(texts)
    assert column(spark, markups, plain_text(F.col("v"))) == [(t,) for t in texts]


def test_strip_matches_python(spark):
    values = [" a ", "\x1fa　", "  b c \n", "\n"]
    got = column(spark, values, strip(F.col("v")), collapse_space(F.col("v")))
    assert got == [(v.strip(), " ".join(v.split())) for v in values]


def test_grouped_integer(spark):
    cases = [
        ("0", 0), ("12", 12), (" 1,234 ", 1234), ("1,234,567", 1234567), ("0012", 12),
        ("12,34", None), ("1,2345", None), ("", None), ("-1", None), ("1.0", None), ("1e3", None),
        ("9" * 33, None), ("9" * 19, None), ("١٢", None), ("12\n3", None),
    ]
    got = column(spark, [text for text, _ in cases], grouped_integer(F.col("v")))
    assert got == [(value,) for _, value in cases]


def test_approved_url(spark):
    cases = [
        ("https://forum.example.com/a", True), ("HTTPS://Forum.Example.com/a", True),
        (" https://forum.example.com ", True), ("https://user@forum.example.com:8443/x", True),
        ("http://forum.example.com/a", False), ("https://forum.example.com.evil.org/", False),
        ("https://evil.org/https://forum.example.com/", False), ("not a url", False), (None, False),
    ]
    got = column(spark, [url for url, _ in cases], approved_url(F.col("v"), SITE.host))
    assert got == [((url or "").strip() if kept else "",) for url, kept in cases]


def test_article_identity(spark):
    cases = [
        ("/board/main/7/12", None), ("https://forum.example.com/board/main/7/12", None),
        ("https://forum.example.com:443/board/main/7/12", None), ("/board/main/7/0012", None),
        ("/board/main/7/12?p=1", None), ("/board/main/7/12?p=100000", None),
        ("/board/main/7/12?category=%ED%9E%88%EC%96%B4%EB%A1%9C", None),
        ("/board/main/7/12?p=0", "query"), ("/board/main/7/12?p=100001", "query"),
        ("/board/main/7/12?p=1&p=2", "query"), ("/board/main/7/12?", "query"),
        ("/board/main/7/12?category=x", "query"), ("/board/main/7/12?q=1", "query"),
        ("/board/main/7/12#top", "malformed"), (" /board/main/7/12", "malformed"),
        ("/board/main/7/1　2", "malformed"), ("", "malformed"), (None, "malformed"),
        ("/" + "x" * 2048, "foreign"),
        ("http://forum.example.com/board/main/7/12", "foreign"),
        ("https://a@forum.example.com/board/main/7/12", "foreign"),
        ("https://forum.example.com:80/board/main/7/12", "foreign"),
        ("//forum.example.com/board/main/7/12", "foreign"), ("/board/main/7/12/", "foreign"),
        ("/board/main/8/12", "board"), ("/board/main/7/0", "post"),
        ("/board/main/7/9223372036854775808", "post"),
    ]
    got = column(spark, [href for href, _ in cases], article_identity(F.col("v"), F.lit(7), SITE))
    url = "https://forum.example.com/board/main/7/12"
    for (href, reason), (found,) in zip(cases, got):
        assert found["reason"] == reason, href
        assert (found["post_id"], found["url"]) == ((12, url) if reason is None else (None, None))


def test_formula_cells_are_quoted(spark):
    frame = spark.createDataFrame(
        [("=1+1", 1), ("+a", 2), ("-a", 3), ("@a", 4), ("\ta", 5), ("\ra", 6), ("a=1", 7), (None, 8)],
        "s STRING, n INT",
    )
    got = [r["s"] for r in safe_cells(frame).orderBy("n").collect()]
    assert got == ["'=1+1", "'+a", "'-a", "'@a", "'\ta", "'\ra", "a=1", None]

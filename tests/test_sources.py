import hashlib
import os
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from forumtide.functions.values import Site
from forumtide.registry import SELECTION_POLICY, unit_map_frame
from forumtide.schemas import ARTIFACT_COMMENT, ARTIFACT_POST
from forumtide.sources import artifact, bundle, comments, contracts, pages

HOST = "forum.example.com"
SITE = Site(HOST, "/board/main", category="히어로")
POSTS, RANKS, RUNS, HELD = contracts.RELEASE_CONTRACTS
GOOD = {
    "board_id": "1", "board_name": "b", "post_id": "7", "analysis_unit": "hero", "title": 'a, "b"\nc',
    "published_at": "2026-07-20 04:20:00+09", "source_url": f"https://{HOST}/x", "current_category": "c",
    "observed_at_slot_kst": "2026-07-20T04:20:00Z", "observed_at_actual": "2026-07-20 04:20:00.5",
    "views": "12", "recommendations": "0", "comments": "3", "config_version": "v",
}


def strings(spark, rows):
    schema = ", ".join(f"{c} STRING" for c in POSTS.columns)
    return spark.createDataFrame([tuple(r[c] for c in POSTS.columns) for r in rows], schema)


def test_good_row_is_typed(spark):
    rows, violations = contracts.apply_contract(strings(spark, [GOOD]), POSTS, HOST)
    got = rows.first()
    assert violations.count() == 0
    assert (got["post_id"], got["views"], got["source_url"]) == (7, 12, GOOD["source_url"])
    assert got["published_at"] == datetime(2026, 7, 19, 19, 20)
    assert got["observed_at_slot_kst"] == datetime(2026, 7, 20, 4, 20)
    assert got["observed_at_actual"] == datetime(2026, 7, 20, 4, 20, 0, 500000)


BAD = [
    ("views", "12.0", "integer"), ("views", "1e3", "integer"), ("views", "-1", "negative"),
    ("views", "", "integer"), ("views", None, "integer"), ("views", str(2**63), "range"),
    ("views", "x", "integer"), ("title", "  ", "blank"), ("title", None, "blank"),
    ("published_at", "soon", "timestamp"), ("published_at", "", "missing"), ("published_at", None, "missing"),
    ("published_at", "2026-02-30", "timestamp"),
]


def test_broken_rules_are_counted(spark):
    rows = [{**GOOD, "post_id": str(i), column: value} for i, (column, value, _) in enumerate(BAD)]
    rows += [{**GOOD, "post_id": "99"}, {**GOOD, "post_id": "99", "title": "copy"}]
    typed, violations = contracts.apply_contract(strings(spark, rows), POSTS, HOST)
    got = {(r["column"], r["rule"]): r["n"] for r in violations.collect()}
    expected: dict = {("board_id,post_id", "duplicate"): 1}
    for column, _, rule in BAD:
        expected[(column, rule)] = expected.get((column, rule), 0) + 1
    assert got == expected and typed.count() == 2
    with pytest.raises(contracts.ContractError, match="duplicate"):
        contracts.assert_contract(violations)


def test_foreign_urls_are_blanked_and_columns_checked(spark):
    rows, _ = contracts.apply_contract(strings(spark, [{**GOOD, "source_url": "https://evil.org/"}]), POSTS, HOST)
    assert rows.first()["source_url"] == ""
    with pytest.raises(contracts.ContractError):
        contracts.apply_contract(strings(spark, [GOOD]).drop("title"), POSTS)
    empty, violations = contracts.apply_contract(strings(spark, [GOOD]).limit(0), POSTS)
    assert empty.count() == 0 and violations.count() == 0 and dict(empty.dtypes)["views"] == "bigint"


def test_csv_header_is_exact(spark, folder):
    path = Path(folder) / "x.csv"
    body = "﻿" + ",".join(POSTS.columns) + "\n" + ",".join(
        '"' + GOOD[c].replace('"', '""') + '"' for c in POSTS.columns) + "\n"
    path.write_text(body, encoding="utf-8")
    got = contracts.read_strings(spark, str(path), POSTS).first()
    assert got["title"] == GOOD["title"] and got["board_id"] == "1"
    path.write_text(body.replace("post_id", "post"), encoding="utf-8")
    with pytest.raises(Exception, match="(?i)header"):
        contracts.read_strings(spark, str(path), POSTS).collect()


NOTES = contracts.Contract("notes", ("id", "reviewer", "note"), integers=("id",), required_text=("note",))


def test_every_file_has_the_header_in_order(spark, folder):
    (Path(folder) / "a.csv").write_text("id,reviewer,note\n1,ann,x\n")
    (Path(folder) / "b.csv").write_text("id,note,reviewer\n2,y,bob\n")
    with pytest.raises(Exception, match="(?i)header"):
        contracts.read_strings(spark, folder, NOTES).collect()


def test_rows_with_missing_or_extra_fields_are_violations(spark, folder):
    (Path(folder) / "a.csv").write_text(
        'id,reviewer,note\n1,ann,x\n2,bob,y,EXTRA\n3,cid\nz,dee,"two\nlines"\n4,eve,""\n')
    rows, violations = contracts.apply_contract(contracts.read_strings(spark, folder, NOTES), NOTES)
    assert [tuple(r) for r in rows.collect()] == [(1, "ann", "x")]
    assert {tuple(r)[1:] for r in violations.collect()} == {
        ("*", "fields", 2), ("id", "integer", 1), ("note", "blank", 1)}
    assert contracts.read_strings(spark, folder, NOTES).select("id").count() == 5


def release(spark, titles):
    when = datetime(2026, 7, 20, 4, 20)
    posts = spark.createDataFrame(
        [(1, "b", i, "hero", t, when, f"https://{HOST}/x", "c", when, when, 1, 2, 3, "v") for i, t in enumerate(titles)],
        "board_id INT, board_name STRING, post_id BIGINT, analysis_unit STRING, title STRING, "
        "published_at TIMESTAMP_NTZ, source_url STRING, current_category STRING, observed_at_slot_kst TIMESTAMP_NTZ, "
        "observed_at_actual TIMESTAMP_NTZ, views BIGINT, recommendations BIGINT, comments BIGINT, config_version STRING")
    frames = {"latest_post_metrics": posts}
    for contract in (RANKS, RUNS, HELD):
        frames[contract.name] = spark.createDataFrame([], ", ".join(f"{c} STRING" for c in contract.columns))
    return frames


def test_release_is_written_once_and_verified(spark, folder):
    titles = ['plain', 'comma, "quote"', "line\nbreak", "한글"]
    first = bundle.write_release(release(spark, titles), folder, "20260701-000000")
    with pytest.raises(FileExistsError):
        bundle.write_release(release(spark, titles), folder, "20260701-000000")
    second = bundle.write_release(release(spark, titles[:2]), folder, "20260702-000000")
    os.makedirs(f"{folder}/release=20260703-000000")  # never completed
    assert bundle.latest_release(spark, folder).endswith("release=20260702-000000")
    assert bundle.latest_release(spark, first) == first
    assert sorted(r["title"] for r in bundle.read_release(spark, first, HOST)["latest_post_metrics"].collect()) == sorted(titles)
    assert bundle.read_release(spark, folder)["latest_post_metrics"].count() == 2
    assert not [n for n in os.listdir(folder) if n.startswith("_staging")]

    data = next(p for p in Path(second).glob("latest_post_metrics/*.csv"))
    (data.parent / f".{data.name}.crc").unlink()  # the local file system's own checksum
    data.write_bytes(data.read_bytes() + b"\n")
    with pytest.raises(contracts.ContractError, match="mismatch"):
        bundle.verify_release(spark, second)
    extra = Path(first) / "latest_post_metrics" / "extra.csv"
    extra.write_text("x")
    with pytest.raises(contracts.ContractError, match="unexpected"):
        bundle.verify_release(spark, first)
    extra.unlink()
    bundle.verify_release(spark, first)
    next(p for p in Path(first).glob("collection_runs/*.csv")).unlink()
    with pytest.raises(contracts.ContractError, match="missing"):
        bundle.verify_release(spark, first)
    with pytest.raises(contracts.ContractError):
        bundle.write_release({"latest_post_metrics": strings(spark, [GOOD])}, folder, "x")
    with pytest.raises(FileNotFoundError):
        bundle.latest_release(spark, f"{folder}/nothing")


def test_manifest_lines(spark, folder):
    good = hashlib.sha256(b"x").hexdigest()
    Path(folder, bundle.MANIFEST).write_text(f"{good.upper()}  *a.csv\n{good}  a.csv\nshort  b.csv\n")
    rows = {(r["name"], r["sha256"], r["valid"]) for r in bundle.read_manifest(spark, folder).collect()}
    assert rows == {("a.csv", good, True), ("b.csv", "short", False)}
    files = spark.createDataFrame([("a.csv", good), ("c.csv", good)], "name STRING, sha256 STRING")
    got = {r["name"]: r["status"] for r in bundle.integrity(files, bundle.read_manifest(spark, folder)).collect()}
    assert got == {"a.csv": "duplicate", "b.csv": "missing", "c.csv": "unexpected"}


def test_artifact_lifecycle(spark, folder):
    when = datetime(2026, 7, 20)
    empty_posts, empty_comments = artifact.read_artifact(spark, folder, "sha")
    assert empty_posts.count() == 0 and empty_comments.count() == 0
    posts = spark.createDataFrame([], ARTIFACT_POST)
    one = spark.createDataFrame([(1, 2, 3, 3, "now", "t", "neutral", "m")], ARTIFACT_COMMENT)

    def current(sha="sha", model="m"):
        return artifact.is_current(artifact.read_manifests(spark, folder), sha, SELECTION_POLICY, model).first()[0]

    assert not current()
    artifact.write_artifact(posts, one, folder, "sha", SELECTION_POLICY, "m", False, when)
    assert not current() and artifact.read_artifact(spark, folder, "sha")[1].count() == 1
    artifact.write_artifact(posts, one.limit(0), folder, "sha", SELECTION_POLICY, "m", True, datetime(2026, 7, 21))
    assert current() and not current(model="n") and not current(sha="other")
    assert artifact.read_artifact(spark, folder, "sha")[1].count() == 0


PAYLOADS = [
    ('{"cmtcount": 3, "commentlist": [{"list": [{"__attr__": {"cmtidx": "5", "cmtpidx": "5"}, "o_date": "d", '
     '"o_comment": "&amp;lt;b&amp;gt;first&amp;lt;/b&amp;gt;"}, {"__attr__": {"cmtidx": 6, "cmtpidx": 5}, "o_comment": "reply"}]}, '
     '{"list": [{"__attr__": {"cmtidx": 5}, "o_comment": "again"}, {"__attr__": {"cmtidx": "x"}, "o_comment": "bad id"}, '
     '{"__attr__": {"cmtidx": 8}, "o_comment": "<br>"}, {"__attr__": {"cmtidx": 9, "cmtpidx": "y"}, "o_comment": "bad parent"}, '
     '{"__attr__": {"cmtidx": 7}, "o_comment": "own parent"}]}]}'),
    '{"cmtcount": 2, "commentlist": []}', '{"commentlist": []}', "not json", '{"cmtcount": 0}',
]


def test_comment_payloads(spark):
    frame = spark.createDataFrame([(1, i, p) for i, p in enumerate(PAYLOADS)], "board_id INT, post_id BIGINT, payload STRING")
    rows, status = comments.parse_comments(frame)
    got = [(r["comment_id"], r["parent_id"], r["published_at"], r["text"]) for r in rows.orderBy("comment_id").collect()]
    assert got == [(5, 5, "d", "first"), (6, 5, "", "reply"), (7, 7, "", "own parent")]
    assert [(r["reported_count"], r["parsed_count"], r["complete"], r["error"]) for r in status.orderBy("post_id").collect()] == [
        (3, 3, True, None), (2, 0, False, None), (None, 0, None, "invalid payload"),
        (None, 0, None, "invalid payload"), (0, 0, True, None)]


FETCHED = datetime(2026, 7, 15, 3, 0)
HEAD = "<thead><tr>" + "".join(f"<th>{h}</th>" for h in pages.HEADER) + "</tr></thead>"


def list_row(post=12, category="[히어로]", title="제목", comment="[3]", date="07-15", views="1,234", reco="5",
             cls="", label="", board=2294, anchor="", lead="", cells=""):
    return (f'<tr class="{cls}"><td class="num">1</td><td class="tit">{label}<div class="text-wrap">'
            f'<a class="subject-link" href="/board/main/{board}/{post}">{lead}<span class="category">{category}</span>'
            f' {title}</a> <span class="con-comment">{comment}</span>{anchor}</div></td><td class="user">u</td>'
            f'<td class="date">{date}</td><td class="view">{views}</td><td class="reco">{reco}</td>{cells}</tr>')


def page(*rows, head=HEAD):
    return f"<html><table><tr><td>menu</td></tr></table><table>{head}<tbody>{''.join(rows)}</tbody></table></html>"


def parsed(spark, htmls, board=2294):
    rows = [(i, board, h if isinstance(h, (bytes, type(None))) else h.encode(), FETCHED) for i, h in enumerate(htmls)]
    frame = spark.createDataFrame(rows, "page INT, board_id INT, html BINARY, fetched_at TIMESTAMP_NTZ")
    return pages.parse_list_pages(frame, SITE)


def test_list_page_records(spark):
    html = page(
        list_row(1, cls="notice"), list_row(2, label='<span class="label">광고</span>', comment=""),
        list_row(3, title="a <b>bold</b> &amp; more", date="11:59", category="[ 히어로 ]"),
        list_row(4, category="[없음]"), "<tr></tr>")
    got = pages.list_records(parsed(spark, [html]), unit_map_frame(spark)).orderBy("post_id").collect()
    assert [(r["post_id"], r["title"], r["comments"], r["is_notice"], r["is_ad"]) for r in got] == [
        (1, "제목", 3, True, False), (2, "제목", 0, False, True), (3, "a bold & more", 3, False, False)]
    assert got[0]["views"] == 1234 and got[0]["analysis_unit"] == "hero"
    assert got[0]["published_at"] == datetime(2026, 7, 14, 15) and got[2]["published_at"] == datetime(2026, 7, 15, 2, 59)
    assert got[0]["source_url"] == f"https://{HOST}/board/main/2294/1"


REJECTED = [
    (None, "empty page"), ("", "empty page"), (b"\xff\xfe", "header not utf-8"),
    ("<html>please log in</html>", "header missing"), (page(list_row(), head=HEAD.replace("추천", "좋아요")), "header incomplete"),
    (page(), "no article rows"), (page("<tr>stray</tr>"), "cell count"),
    (page(list_row(), list_row(cells="<td></td>")), "cell count"),
    (page(list_row().replace('class="view"', 'class="seen"')), "cell classes"),
    (page(list_row().replace('class="text-wrap"', 'class="wrap"')), "title structure"),
    (page(list_row().replace("subject-link", "link")), "anchor"),
    (page(list_row(anchor='<a href="/board/main/2294/9">x</a>')), "ambiguous url"),
    (page(list_row(board=2295)), "url board"), (page(list_row(post=0)), "url post"),
    (page(list_row(category="히어로")), "category"), (page(list_row(lead="pre")), "title"), (page(list_row(title="")), "title"),
    (page(list_row(comment="3")), "comments"), (page(list_row(comment="[1,23]")), "comments"),
    (page(list_row(cls="notice ad")), "row kind"), (page(list_row(date="soon")), "date"),
    (page(list_row(views="-1")), "views"), (page(list_row(reco="")), "recommendations"),
]


def test_bad_pages_are_refused(spark):
    got = parsed(spark, [html for html, _ in REJECTED]).orderBy("page").collect()
    assert [r["reject_reason"] for r in got] == [reason for _, reason in REJECTED]


def test_article_container(spark):
    rows = [('<div id="body">one<div>two</div>three</div><div>no</div>', "one two three"),
            ("<DIV ID='x'></DIV><div id=body>&lt;b&gt;x&lt;/b&gt;\n<br>y", "x y"), ("<p>none</p>", None), ("", None)]
    frame = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(rows)], "i INT, html STRING")
    got = pages.parse_articles(frame, "html", "div", "body").orderBy("i").collect()
    assert [r["body"] for r in got] == [b for _, b in rows]
    assert [r["error"] for r in got] == [None, None, "article body is missing", "article body is missing"]


def test_release_files_are_parsed_once_and_posts_joined_once(spark):
    """Rows and violations of a read release come from one stored, judged table."""
    from forumtide.plans.intake import _released

    for frame in _released(spark, "/root/testdata/sf0.001").values():
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "csv" not in plan and "RLIKE" not in plan


def test_plain_times_read_like_times_with_rules(spark):
    texts = ["2024-02-29 23:59:59.123456", "2024-02-30 00:00:00", "2024-01-01 24:00:00", "0001-01-01 00:00:00",
             "9999-12-31 23:59:59.9", "2024-01-01 00:00:60", "2024-13-01 00:00:00"]
    rows = spark.createDataFrame([(x,) for x in texts], "x STRING")
    for plain, ruled in rows.select(
        contracts._utc_from_clean(F.col("x")), contracts._utc_by_rules(F.col("x"))
    ).collect():
        assert plain == ruled


def test_set_difference_aggregates_both_sides_at_once(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c")], "k INT, v STRING")
    right = spark.createDataFrame([(1, "a"), (2, None), (4, "d"), (4, "d")], "k INT, v STRING")
    found = contracts.set_difference(left, right, ("k", "v"))
    assert sorted((r["k"], r["status"]) for r in found.collect()) == [
        (2, "missing"), (2, "unexpected"), (3, "unexpected"), (4, "missing")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 1

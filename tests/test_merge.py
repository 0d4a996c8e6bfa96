import random
import unicodedata
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from forumtide.functions.values import Site
from forumtide.operators import merge
from forumtide.operators.validate import (
    failed_rules,
    map_units,
    oversized_batches,
    row_kind,
    split_valid,
)
from forumtide.registry import CATEGORY_UNITS, SOURCES, boards_frame, unit_map_frame
from forumtide.schemas import OBSERVATION, POST, SNAPSHOT

SITE = Site("forum.example.com", "/board/main")
T0 = datetime(2026, 7, 1, 3, 20)
A, B = "a" * 64, "b" * 64


def observation(post_id=1, board=2294, category="히어로", unit="hero", **changes):
    row = {
        "board_id": board, "post_id": post_id, "analysis_unit": unit, "category": category,
        "title": "title", "published_at": T0, "views": 1, "recommendations": 1, "comments": 1,
        "source_url": f"https://forum.example.com/board/main/{board}/{post_id}",
        "is_notice": False, "is_ad": False,
    }
    return {**row, **changes}


def frame(spark, rows):
    return spark.createDataFrame(rows, OBSERVATION)


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_registry_shape(spark):
    units = {u for m in CATEGORY_UNITS.values() for u in m.values()}
    assert len(SOURCES) == 8 and len(units) == 53
    assert boards_frame(spark).count() == 8 and unit_map_frame(spark).count() == 56


def test_collapse_takes_metadata_and_counters_apart(spark):
    rows = [
        observation(title="b", views=100, recommendations=5, comments=1),
        observation(title="a", views=150, recommendations=2, comments=4),
    ]
    for order in (rows, rows[::-1]):
        got = merge.collapse_observations(frame(spark, order)).first()
        assert (got["title"], got["views"], got["recommendations"], got["comments"], got["copies"]) == (
            "b", 150, 5, 4, 2)
    later = observation(title="a", published_at=T0 + timedelta(days=1))
    assert merge.collapse_observations(frame(spark, [*rows, later])).first()["title"] == "a"


def test_titles_compare_by_bytes(spark):
    rows = [observation(title="Z"), observation(title="a"), observation(title="가")]
    assert merge.collapse_observations(frame(spark, rows)).first()["title"] == "가"


def post_row(seen, post_id=1, **changes):
    row = observation(post_id, **changes)
    for counter in merge.COUNTERS:
        row.pop(counter)
    return {**row, "last_seen_at": seen}


def test_upsert_is_monotone_and_order_free(spark):
    rng = random.Random(3)
    rows = [
        post_row(T0 + timedelta(hours=rng.randint(0, 3)), rng.randint(1, 4), title=rng.choice("abc"),
                 category=rng.choice(["히어로", None]), is_notice=rng.random() < 0.5)
        for _ in range(60)
    ]
    whole = as_set(merge.upsert_posts(spark.createDataFrame(rows, POST)))
    for _ in range(3):
        rng.shuffle(rows)
        cut = rng.randint(1, 59)
        first = spark.createDataFrame(rows[:cut], POST)
        second = spark.createDataFrame(rows[cut:], POST)
        merged = merge.upsert_posts(merge.upsert_posts(first), second)
        assert as_set(merged) == whole
        assert as_set(merge.upsert_posts(merged, second)) == whole


def test_older_sighting_never_wins(spark):
    old, new = post_row(T0, title="zzz"), post_row(T0 + timedelta(hours=1), title="aaa")
    for a, b in ((old, new), (new, old)):
        got = merge.upsert_posts(spark.createDataFrame([a], POST), spark.createDataFrame([b], POST))
        assert got.first()["title"] == "aaa"


def snapshot(post_id=1, slot=T0, config=A, views=1, recs=1, comments=1, seen=T0):
    return (2294, post_id, slot, seen, views, recs, comments, config)


def test_snapshot_merge_and_conflict(spark):
    rows = [snapshot(views=100, recs=5, comments=1), snapshot(views=150, recs=2, comments=4),
            snapshot(2), snapshot(2, config=B), snapshot(2, slot=T0 + timedelta(hours=6), config=B)]
    both = spark.createDataFrame(rows, SNAPSHOT)
    merged, conflicts = merge.merge_snapshots(both)
    got = {(r["post_id"], r["slot"]): (r["views"], r["recommendations"], r["comments"])
           for r in merged.collect()}
    assert got == {(1, T0): (150, 5, 4), (2, T0 + timedelta(hours=6)): (1, 1, 1)}
    assert [(r["post_id"], r["config_version"], r["other_version"]) for r in conflicts.collect()] == [
        (2, A, B)]
    with pytest.raises(Exception, match="another configuration"):
        merge.merge_snapshots_strict(both).collect()
    assert "SortAggregate" not in merged._jdf.queryExecution().executedPlan().toString()
    again, _ = merge.merge_snapshots(merged, merged)
    assert as_set(again) == as_set(merged)


def test_conflicts_are_named_without_a_second_look_at_the_rows(spark):
    """Joining torn keys back sorted all rows of a task, and its memory grew with them."""
    rows = [snapshot(config=c) for c in ("c" * 64, B, None, A)] + [snapshot(2, config=None)]
    merged, conflicts = merge.merge_snapshots(spark.createDataFrame(rows, SNAPSHOT))
    assert as_set(conflicts) == {(2294, 1, T0, A, "c" * 64)}
    assert [(r["post_id"], r["config_version"]) for r in merged.collect()] == [(2, None)]
    plan = conflicts._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SortAggregate" not in plan



def test_insert_absent_and_high_water(spark):
    old = spark.createDataFrame([(1, "one")], "id INT, name STRING")
    new = spark.createDataFrame([(1, "uno"), (2, "two")], "id INT, name STRING")
    assert as_set(merge.insert_absent(old, new, ("id",))) == {(1, "one"), (2, "two")}
    rows = [post_row(T0, 5), post_row(T0, 9, is_notice=True), post_row(T0, 8, is_ad=True)]
    assert merge.high_water(spark.createDataFrame(rows, POST)).first()["high_water"] == 5


INVALID = {
    "post_id": dict(post_id=0, source_url="https://forum.example.com/board/main/2294/0"),
    "views": dict(views=-1), "recommendations": dict(recommendations=-1), "comments": dict(comments=-5),
    "url": dict(source_url="https://forum.example.com/board/main/2294/2"),
    "kind": dict(is_notice=True, is_ad=True), "unit": dict(unit="paladin"),
    "title": dict(title=" padded"), "published_at": dict(published_at=None),
}


def test_observation_rules(spark):
    cases = list(INVALID.items()) + [
        ("", dict(title="x" * 5000)), ("title", dict(title="")), ("title", dict(title="a\x00b")),
        ("category,unit", dict(category="")), ("board,unit", dict(board=1)),
        ("category", dict(category="히어로 ")), ("category", dict(category=unicodedata.normalize("NFD", "히어로"))),
        ("", dict(title="x" * 500)), ("", dict(views=2**40)),
        ("", dict(board=5974, category="아무거나", unit="free")),
    ]
    rows = [{**observation(**changes)} for _, changes in cases]
    checked = failed_rules(frame(spark, rows).withColumn("n", F.monotonically_increasing_id()),
                           unit_map_frame(spark), SITE)
    got = sorted(",".join(r["failed"]) for r in checked.collect())
    assert got == sorted(expected for expected, _ in cases)


def test_mixed_batch_counts(spark):
    """Nine observations: two posts seen twice, one new, four invalid."""
    rows = [observation(1), observation(1, views=3), observation(2), observation(2, title="b"),
            observation(3), observation(4, views=-1), observation(5, title=""),
            observation(6, is_notice=True, is_ad=True), observation(0)]
    checked = failed_rules(frame(spark, rows), unit_map_frame(spark), SITE)
    known = spark.createDataFrame([(2294, 3)], "board_id INT, post_id BIGINT")
    flagged = spark.createDataFrame([(2294, 1, "t")], "board_id INT, post_id BIGINT, title STRING")
    first = merge.batch_summary(checked, known.limit(0), flagged).first()
    assert tuple(first) == (2294, 3, 0, 1, 6)
    second = merge.batch_summary(checked, known, flagged.limit(0)).first()
    assert tuple(second) == (2294, 2, 1, 0, 6)
    assert split_valid(checked)[0].count() == 5 and split_valid(checked)[1].count() == 4


def test_units_and_kinds(spark):
    rows = spark.createDataFrame(
        [(2294, " 히어로 "), (2294, "없음"), (2295, "아크（불독）"), (2300, "x"), (9, "x")],
        "board_id INT, category STRING")
    got = {(r[0], r[1]): r[2] for r in map_units(rows, unit_map_frame(spark)).select(
        "board_id", "category", "mapped_unit").collect()}
    assert list(got.values()).count(None) == 2
    assert got[(2294, " 히어로 ")] == "hero" and got[(2300, "x")] == "qna"
    assert got[(2295, "아크（불독）")] == "arch_mage_fire_poison"
    kinds = spark.createDataFrame(
        [(["Notice"], ""), ([], "광고"), (["row"], "잡담"), (["ad"], "공지"), (None, None)],
        "c ARRAY<STRING>, l STRING").select(row_kind(F.col("c"), F.col("l")).alias("k"))
    assert [tuple(r["k"]) for r in kinds.collect()] == [
        (True, False, False), (False, True, False), (False, False, False), (True, True, True),
        (False, False, False)]


def test_batch_bound(spark):
    rows = spark.range(11).select(F.lit(1).alias("board_id"), (F.col("id") % 2).alias("slot"))
    assert as_set(oversized_batches(rows, limit=5)) == {(1, 0, 6)}
    assert oversized_batches(rows, limit=6).count() == 0

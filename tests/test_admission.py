import random
from datetime import datetime, timedelta

import pytest

from forumtide.operators import admission
from forumtide.params import AdmissionSpec

T0 = datetime(2026, 7, 1)
ROWS = ("source_key STRING, page INT, pos INT, board_id INT, post_id BIGINT, published_at TIMESTAMP_NTZ, "
        "views BIGINT, recommendations BIGINT, comments BIGINT, is_notice BOOLEAN, is_ad BOOLEAN")


def row(page, pos, post_id, source="s", views=1, recs=0, comments=0, notice=False, ad=False, age=0):
    return (source, page, pos, 1, post_id, T0 - timedelta(days=age), views, recs, comments, notice, ad)


def walk(rows, prior, spec):
    """Brute force: read pages in order until the rule says stop."""
    pages = sorted({r[1] for r in rows if r[1] <= spec.max_pages})
    boundary = greatest = None
    read = 0
    for page in range(1, min(max(pages), spec.max_pages) + 1):
        read = page
        for r in sorted(x for x in rows if x[1] == page):
            if not (r[9] or r[10]):
                greatest = r[4] if greatest is None else max(greatest, r[4])
                if prior is not None and boundary is None and r[4] <= prior:
                    boundary = page
        if page >= spec.min_pages and (
            prior is None or (boundary is not None and page >= boundary + spec.overlap_pages)
        ):
            break
    reached = prior is None or (boundary is not None and read >= boundary + spec.overlap_pages)
    return read, reached, greatest if reached else prior


def test_status_and_rows_equal_a_walk(spark):
    rng = random.Random(11)
    spec = AdmissionSpec(min_pages=2, overlap_pages=1, max_pages=5)
    rows, marks, expected = [], [], {}
    for n in range(40):
        source, prior = f"s{n}", rng.choice([None, 20, 40, 60, 80])
        mine = [row(p, i, rng.randint(90 - 15 * p, 110 - 5 * p), source, rng.randint(1, 3),
                    rng.randint(0, 2), rng.randint(0, 2), rng.random() < 0.1)
                for p in range(1, rng.randint(2, 7)) for i in range(4)]
        rows += mine
        marks.append((source, prior))
        expected[source] = walk(mine, prior, spec)
    frame = spark.createDataFrame(rows, ROWS)
    status = admission.incremental_status(
        frame, spark.createDataFrame(marks, "source_key STRING, prior BIGINT"), spec)
    got = {r["source_key"]: (r["pages_read"], r["boundary_reached"], r["high_water"]) for r in status.collect()}
    assert got == expected
    assert {s for _, s, _ in got.values()} == {True, False}
    best = {}
    for r in rows:
        read, reached, _ = expected[r[0]]
        if reached and r[1] <= read:
            key, order = (r[0], r[4]), (r[6], r[7], r[8], r[1], r[2])
            best[key] = max(best.get(key, order), order)
    kept = admission.incremental_rows(frame, status).collect()
    assert {(r["source_key"], r["post_id"]): (r["views"], r["recommendations"], r["comments"], r["page"], r["pos"])
            for r in kept} == best


def test_boundary_page_reads_the_overlap(spark):
    spec = AdmissionSpec(max_pages=100)
    pages = [row(p, 0, 100 - 10 * p) for p in range(1, 9)]
    mark = spark.createDataFrame([("s", 60)], "source_key STRING, prior BIGINT")
    got = admission.incremental_status(spark.createDataFrame(pages, ROWS), mark, spec).first()
    assert (got["pages_read"], got["status"], got["high_water"]) == (5, "succeeded", 90)
    last = AdmissionSpec(max_pages=4)
    got = admission.incremental_status(spark.createDataFrame(pages, ROWS), mark, last).first()
    assert (got["pages_read"], got["status"], got["high_water"]) == (4, "partial", 60)


def test_backfill_cut_equals_a_walk(spark):
    rng = random.Random(5)
    rows, cutoff = [], T0 - timedelta(days=10)
    for n in range(30):
        rows += [row(p, i, rng.randint(1, 10**12), f"s{n}", notice=rng.random() < 0.2,
                     age=rng.choice([0, 5, 9, 10, 10, 11] if n % 3 else [0, 1]))
                 for p in range(1, 4) for i in range(3)]
    expected, states = set(), {}
    for source in {r[0] for r in rows}:
        done, checkpoint, n = False, None, 0
        for r in sorted(x for x in rows if x[0] == source):
            ordinary = not r[9]
            if ordinary and not done:
                checkpoint = r[4]
                done = r[5] < cutoff
            if done:
                break
            expected.add(r)
            n += 1
        states[source] = (n, done, checkpoint)
    frame = spark.createDataFrame(rows, ROWS)
    cuts = admission.backfill_cuts(frame, cutoff)
    kept = admission.backfill_rows(frame, cuts).select(*frame.columns)
    assert {tuple(r) for r in kept.collect()} == expected
    assert {r["source_key"]: (r["accepted"], r["complete"], r["checkpoint_post_id"])
            for r in admission.backfill_status(frame, cuts).collect()} == states


def test_budget_goes_round_the_sources(spark):
    pages = spark.createDataFrame(
        [(f"s{n}", n, p) for n in range(8) for p in range(1, 8)],
        "source_key STRING, source_order INT, page INT")
    none = spark.createDataFrame([], "source_key STRING, next_page INT, complete BOOLEAN")
    got = admission.allocate_pages(pages, none, 16).orderBy("seq").collect()
    assert [(r["source_order"], r["page"]) for r in got] == [(n, p) for p in (2, 3) for n in range(8)]
    states = spark.createDataFrame([("s0", 5, False), ("s1", 1, False), ("s2", 9, True)], none.schema)
    cuts = spark.createDataFrame([("s3", 2)], "source_key STRING, cut_page INT")
    got = admission.allocate_pages(pages.where("source_order < 4"), states, 40, cuts).orderBy("seq").collect()
    by_source = {}
    for r in got:
        by_source.setdefault(r["source_key"], []).append(r["page"])
    assert by_source == {"s0": [4, 5, 6, 7], "s1": [1, 2, 3, 4, 5, 6, 7], "s3": [2]}
    assert admission.allocate_pages(pages, none, 0).count() == 0
    with pytest.raises(ValueError):
        admission.allocate_pages(pages, none, -1)

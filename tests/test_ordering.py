"""Places and running totals counted over ranges of an order."""

import random

import pytest
from pyspark.sql import functions as F

from forumtide.operators.admission import allocate_pages
from forumtide.operators.derived import review_batch
from forumtide.operators.ordering import running


def _one_task(frame):
    text = frame._jdf.queryExecution().toString()
    return "SinglePartition" in text


def test_running_totals_of_groups_and_of_everything(spark):
    rng = random.Random(4)
    rows = [("hot" if rng.random() < 0.6 else f"g{i % 9}", rng.randint(-50, 50), i) for i in range(2000)]
    frame = spark.createDataFrame(rows, "g STRING, v INT, i INT")
    order = [F.desc("v"), F.asc("i")]
    for keys in ([], ["g"]):
        got = running(frame, keys, order, "v")
        assert not _one_task(got)
        seen = {}
        expected = set()
        for g, v, i in sorted(rows, key=lambda r: (-r[1], r[2])):
            n, total = seen.get(g if keys else None, (0, 0))
            seen[g if keys else None] = (n + 1, total + v)
            expected.add((g, v, i, n + 1, total + v))
        assert set(map(tuple, got.collect())) == expected
    assert running(frame.limit(0), [], order).count() == 0


@pytest.mark.parametrize("budget", [0, 1, 7, 10_000])
def test_budgets_of_any_size(spark, budget):
    pages = [(f"s{s}", s, p) for s in range(5) for p in range(1, 4 + 90 * (s == 2))]
    frame = spark.createDataFrame(pages, "source_key STRING, source_order INT, page INT")
    states = spark.createDataFrame([("s1", 2, False), ("s4", 1, True)],
                                   "source_key STRING, next_page INT, complete BOOLEAN")
    got = allocate_pages(frame, states, budget)
    assert not _one_task(got)
    turns = {}
    for s, o, p in sorted(pages):
        if s != "s4" and p >= (1 if s == "s1" else 2):
            turns.setdefault(s, []).append((o, p))
    order = sorted((k + 1, o, s, p) for s, held in turns.items() for k, (o, p) in enumerate(held))
    expected = [(s, o, p, k, n) for n, (k, o, s, p) in enumerate(order, 1)][:budget]
    assert sorted(map(tuple, got.select("source_key", "source_order", "page", "round", "seq").collect()),
                  key=lambda r: r[4]) == expected


@pytest.mark.parametrize("items, tokens", [(5, 10**6), (10**6, 40), (10**6, 10**9)])
def test_review_batches_of_any_size(spark, items, tokens):
    rows = [(f"r{i:03}", f"h{i % 70}", "x" * (i % 13), (i * 7 % 10) / 10, i % 4) for i in range(200)]
    frame = spark.createDataFrame(
        rows, "record_id STRING, content_hash STRING, text STRING, confidence DOUBLE, engagement INT")
    done = spark.createDataFrame([("h3",)], "content_hash STRING")
    got = review_batch(frame, done, items, tokens)
    assert not _one_task(got)
    best = {}
    for r in rows:
        key = (r[3], -r[4], r[0])
        if r[1] != "h3" and (r[1] not in best or key < best[r[1]][0]):
            best[r[1]] = (key, max(1, (len(r[2]) + 2) // 3))
    used, expected = 0, []
    for n, (key, cost) in enumerate(sorted(best.values()), 1):
        used += cost
        if n <= items and used <= tokens:
            expected.append((key[2], n, used))
    assert sorted(map(tuple, got.select("record_id", "position", "tokens_used").collect()),
                  key=lambda r: r[1]) == expected

"""Rankings carried over slots equal full rankings; days as bitmaps equal counted days."""

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from forumtide.operators import derived, standing
from forumtide.operators.ranking import cumulative_top
from forumtide.params import RankingSpec
from forumtide.schemas import POST, QUARANTINE, SNAPSHOT

T0 = datetime(2026, 7, 1)
SLOTS = [T0 + timedelta(hours=6 * i) for i in range(1, 6)]


def _spec(slot):
    return RankingSpec(slot.replace(tzinfo=timezone.utc), window_days=1, top_n=3)


def _world(spark, slot_number):
    """Posts, snapshots in order of arrival, and quarantine as they are at one slot."""
    rng = random.Random(7)
    posts, shots = [], []
    for i in range(40):
        born = T0 - timedelta(hours=rng.randint(-20, 24))
        unit = "hero" if i % 3 or slot_number < 3 else "mage"  # some posts change their unit
        posts.append((1, i, unit, f"t{i}", born, "u", i % 11 == 0, False, "c", born))
        for n, slot in enumerate([T0, *SLOTS]):
            if rng.random() < 0.7:
                late = rng.random() < 0.15
                row = (1, i, slot, slot, rng.randint(0, 30), rng.randint(0, 9), rng.randint(0, 9), "a")
                shots.append((n + 1 if late else n, row))
                if rng.random() < 0.1:  # the same slot again, with other counters
                    shots.append((n, (*row[:4], row[4] + 5, row[5], row[6] + 1, "a")))
    held = [
        (f"q{i}", "title", f"post:1:{i}", "h", [], 70, T0,
         "released" if slot_number > i % 5 else "pending", None, None, None) for i in range(0, 40, 7)
    ]
    return (
        spark.createDataFrame(posts, POST), shots, spark.createDataFrame(held, QUARANTINE)
    )


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_five_slots_in_a_row_equal_full_rankings(spark, folder):
    previous, ranked = None, []
    for number, slot in enumerate(SLOTS, 1):
        posts, shots, held = _world(spark, number)
        arrived = [row for at, row in shots if at <= number]
        new = arrived if previous is None else [row for at, row in shots if at == number]
        spec = _spec(slot)
        got = standing.advance_slot(
            folder, posts, spark.createDataFrame(new, SNAPSHOT), held, spec, previous
        )
        merged = spark.createDataFrame(arrived, SNAPSHOT).groupBy("board_id", "post_id", "slot").agg(
            *[F.max(c).alias(c) for c in ("views", "recommendations", "comments")])
        full = cumulative_top(posts, merged, held, spec)
        assert _rows(got) == _rows(full) and got.count() > 5
        # The same slot again, and the standing holds no post that has left the window.
        again = standing.advance_slot(
            folder, posts, spark.createDataFrame(new, SNAPSHOT), held, spec, previous)
        assert _rows(again) == _rows(full)
        ranked.append(again)
        kept = spark.read.parquet(f"{folder}/standing/as_of={spec.bounds[1]:%Y%m%dT%H%M%S}")
        gone = kept.join(posts, ["board_id", "post_id"]).where(
            F.col("published_at") < F.lit(spec.bounds[0]))
        assert gone.count() == 0
        previous = spec
    parts = [standing.top_days(frame) for frame in ranked]
    both = standing.merged_days(standing.merged_days(*parts[:3]), *parts[2:], parts[0])
    everything = ranked[0]
    for frame in ranked[1:]:
        everything = everything.unionByName(frame)
    counted = standing.count_days(both)
    assert _rows(counted.select("board_id", "post_id", "metric", "days_in_top")) == _rows(
        derived.days_in_top(everything).select("board_id", "post_id", "metric", "days_in_top"))
    assert {r["days_in_top"] for r in counted.collect()} == {1, 2}


def test_slots_go_forward_only(spark, folder):
    posts, shots, held = _world(spark, 1)
    rows = spark.createDataFrame([row for _, row in shots], SNAPSHOT)
    with pytest.raises(ValueError, match="earlier"):
        standing.advance_slot(folder, posts, rows, held, _spec(SLOTS[0]), _spec(SLOTS[1]))

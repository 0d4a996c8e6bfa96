from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from forumtide.operators import ranking
from forumtide.operators.merge import detail_tasks
from forumtide.params import RankingSpec, code
from forumtide.schemas import POST, QUARANTINE, SNAPSHOT

AS_OF = datetime(2026, 7, 15, 3, 20, tzinfo=timezone.utc)
END = AS_OF.replace(tzinfo=None)
CUTOFF = END - timedelta(days=90)
CONFIG = "c" * 64


def post(post_id, published, unit="hero", notice=False, ad=False):
    return (1, post_id, unit, f"t{post_id}", published, "u", notice, ad, "c", END)


def shot(post_id, slot, views, recs=0, comments=0):
    return (1, post_id, slot, slot, views, recs, comments, CONFIG)


def held(post_id, state, kind="title"):
    return (f"q{post_id}", kind, f"post:1:{post_id}", "h", [], 70, END, state, None, None, None)


@pytest.fixture(scope="module")
def tables(spark):
    posts = [post(i, END - timedelta(hours=i)) for i in range(1, 61)]
    shots = [shot(i, END - timedelta(hours=6), i, 2 * i, 3 * i) for i in range(1, 61)]
    shots += [shot(1, END, 1000), shot(2, END + timedelta(hours=6), 9999)]
    special = {101: (CUTOFF, {}), 102: (CUTOFF - timedelta(microseconds=1), {}),
               103: (END + timedelta(microseconds=1), {}), 104: (END, {"notice": True}),
               105: (END, {"ad": True}), 106: (END, {}), 107: (END, {}), 108: (END, {}), 109: (END, {})}
    for post_id, (at, flags) in special.items():
        posts.append(post(post_id, at, "side", **flags))
        shots.append(shot(post_id, END, 5))
    posts.append(post(110, END, "side"))  # never observed
    quarantine = [held(106, "pending"), held(107, "confirmed"), held(108, "released"),
                  held(109, "pending", "body")]
    return (spark.createDataFrame(posts, POST), spark.createDataFrame(shots, SNAPSHOT),
            spark.createDataFrame(quarantine, QUARANTINE))


def top(tables, **spec):
    return ranking.cumulative_top(*tables, RankingSpec(AS_OF, config_version=CONFIG, **spec))


def test_group_size_and_order(tables):
    rows = top(tables).where("analysis_unit = 'hero'").collect()
    assert len(rows) == 150
    views = {r["rank"]: (r["post_id"], r["metric_value"]) for r in rows if r["metric"] == "views"}
    # The snapshot at the slot itself counts, the later one does not.
    assert views[1] == (1, 1000) and views[2] == (60, 60) and len(views) == 50
    assert {r["as_of_slot"] for r in rows} == {END} and {r["config_version"] for r in rows} == {CONFIG}


def test_eligibility_edges(tables):
    rows = top(tables).where("analysis_unit = 'side' and metric = 'views'").orderBy("rank").collect()
    # Equal values: newer first, then the greater id; the cutoff itself is included.
    assert [r["post_id"] for r in rows] == [109, 108, 101]


def test_stored_slot_is_replaced_whole(spark, tables, folder):
    spec = RankingSpec(AS_OF, config_version=CONFIG)
    path = ranking.write_ranking(top(tables), folder, spec)
    other = RankingSpec(AS_OF - timedelta(hours=6), config_version=CONFIG)
    ranking.write_ranking(ranking.cumulative_top(*tables, other), folder, other)
    before = spark.read.parquet(path).count()
    assert ranking.write_ranking(top(tables), folder, spec) == path
    assert spark.read.parquet(path).count() == before
    posts, shots, quarantine = tables
    fewer = ranking.cumulative_top(posts.where("analysis_unit = 'hero'"), shots, quarantine, spec)
    ranking.write_ranking(fewer, folder, spec)
    table = spark.read.parquet(f"{folder}/as_of=*")
    assert table.where(F.col("as_of_slot") == F.lit(END)).select("analysis_unit").distinct().count() == 1
    assert table.where(F.col("as_of_slot") < F.lit(END)).count() > 0


def test_reader_keeps_its_own_limit(spark, tables):
    rankings = top(tables, top_n=60).unionByName(
        ranking.cumulative_top(*tables, RankingSpec(AS_OF - timedelta(hours=6), config_version=CONFIG)))
    shown = ranking.read_top(rankings, tables[0], "hero", "views").collect()
    assert len(shown) == 50 and shown[0]["title"] == "t1" and {r["as_of_slot"] for r in shown} == {END}
    early = ranking.read_top(rankings, tables[0], "hero", "views", AS_OF - timedelta(minutes=1)).collect()
    assert {r["as_of_slot"] for r in early} == {END - timedelta(hours=6)}
    assert ranking.read_top(rankings, tables[0], "nobody", "views").count() == 0


def test_tasks_are_distinct_and_kept(spark, tables):
    rows = top(tables, top_n=2)
    none = spark.createDataFrame([], "task_key STRING")
    at = F.lit(END).cast("timestamp_ntz")
    tasks = detail_tasks(rows, none, at)
    keys = [r["task_key"] for r in tasks.collect()]
    assert len(keys) == len(set(keys)) == ranking.ranked_posts(rows).count()
    assert detail_tasks(rows, tasks, at).count() == 0
    assert '{"board_id":1,"post_id":1}' in {r["payload"] for r in tasks.collect()}


def test_parameters_are_checked():
    for bad in (dict(window_days=0), dict(top_n=0), dict(config_version="x" * 64)):
        with pytest.raises(ValueError):
            RankingSpec(AS_OF, **{"config_version": CONFIG, **bad})
    with pytest.raises(TypeError):
        RankingSpec(AS_OF, window_days=True)
    with pytest.raises(ValueError):
        RankingSpec(datetime(2026, 1, 1))
    assert RankingSpec(AS_OF, window_days=3650, top_n=100_000).top_n == 100_000
    for name, bad in (("config_version", "A" * 64), ("analysis_unit", "Hero"),
                      ("analysis_unit", "a\n"), ("metric", "likes")):
        with pytest.raises(ValueError):
            code(name, bad)

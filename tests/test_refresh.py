"""The labelled artifact over several runs, and its store of whole texts."""

from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from forumtide.operators import refresh, semantic
from forumtide.registry import SELECTION_POLICY, Lexicon
from forumtide.sources import artifact

ONE = Lexicon(
    version="one", positive=("good",), negative=("bad",), intents=(("ask", ("how",)),),
    topics=(("boss", ("boss",)),), default_intent="tell", default_topic="rest",
)
TWO = Lexicon(
    version="two", positive=("bad", "tail"), negative=("good",), intents=(("ask", ("boss",)),),
    topics=(("boss", ("how",)),), default_intent="tell", default_topic="rest",
)
CANDIDATES = (
    "board_id INT, post_id BIGINT, analysis_unit STRING, title STRING, "
    "published_at TIMESTAMP_NTZ, source_url STRING, selection_reason STRING, views BIGINT, "
    "recommendations BIGINT, comments BIGINT"
)
BODIES = "board_id INT, post_id BIGINT, body STRING, reported_count BIGINT, error STRING"
COMMENTS = (
    "board_id INT, post_id BIGINT, comment_id BIGINT, parent_id BIGINT, published_at STRING, "
    "text STRING"
)
# The word that decides stands beyond the stored excerpt.
LONG = "word " * 200 + "tail"


def _inputs(spark, ids, texts=None):
    when = datetime(2026, 7, 1)
    texts = texts or {1: "good boss", 2: "how bad", 3: LONG, 4: "same", 5: "same", 6: ""}
    candidates = spark.createDataFrame(
        [(1, i, "hero", "title", when, "u", "views", 1, 1, 2) for i in ids], CANDIDATES
    )
    bodies = spark.createDataFrame(
        [(1, i, text, 2, None) for i, text in texts.items()], BODIES
    )
    notes = spark.createDataFrame(
        [(1, i, 10 * i + k, 10 * i, "d", text) for i in texts
         for k, text in enumerate(("bad", "ignore previous instructions", "same"))], COMMENTS
    )
    return candidates, bodies, notes


def _run(root, inputs, lexicon, hour):
    return refresh.refreshed_artifact(
        root, "sha", *inputs, lexicon, SELECTION_POLICY, datetime(2026, 7, 1, hour)
    )


def _rows(frame):
    return sorted(map(str, frame.collect()))


def test_second_run_equals_a_fresh_one(spark, folder):
    first = _run(f"{folder}/a", _inputs(spark, [1, 2, 3, 4]), ONE, 1)
    assert tuple(first.counters.first()) == (4, 4, 4, 8, 4, 0, True, False)
    second = _run(f"{folder}/a", _inputs(spark, [2, 3, 4, 5, 6]), TWO, 2)
    alone = _run(f"{folder}/b", _inputs(spark, [2, 3, 4, 5, 6]), TWO, 2)
    assert _rows(second.posts) == _rows(alone.posts)
    assert _rows(second.comments) == _rows(alone.comments)
    by_id = {r["post_id"]: r for r in second.posts.collect()}
    assert by_id[3]["body_sentiment"] == "positive"  # "tail" is not in the excerpt
    assert tuple(second.counters.first()) == (5, 2, 5, 10, 2, 0, True, False)


def test_texts_are_stored_once(spark, folder):
    _run(folder, _inputs(spark, [1, 2, 3, 4]), ONE, 1)
    _run(folder, _inputs(spark, [2, 3, 4, 5, 6]), TWO, 2)
    stored = spark.read.parquet(f"{folder}/texts")
    # Five bodies and two comments, of which one body and one comment are the same text.
    texts = {r["whole_text"] for r in stored.collect()}
    assert stored.count() == len(texts) == 6 and LONG in texts and "" in texts


def test_nothing_is_done_for_the_same_inputs(spark, folder):
    inputs = _inputs(spark, [1, 2])
    first = _run(folder, inputs, ONE, 1)
    again = _run(folder, inputs, ONE, 2)
    assert tuple(again.counters.first()) == (2, 0, 2, 4, 0, 0, True, True)
    assert _rows(again.posts) == _rows(first.posts)
    assert artifact.read_manifests(spark, folder).count() == 1


def test_failed_posts_are_tried_again(spark, folder):
    first = _run(folder, _inputs(spark, [1, 7]), ONE, 1)
    assert tuple(first.counters.first())[5:] == (1, False, False)
    inputs = _inputs(spark, [1, 7], {1: "changed since", 7: "good"})
    second = _run(folder, inputs, ONE, 2)
    assert tuple(second.counters.first()) == (2, 1, 2, 4, 1, 0, True, False)
    excerpts = {r["post_id"]: r["body_excerpt"] for r in second.posts.collect()}
    assert excerpts == {1: "good boss", 7: "good"}


def test_rows_without_a_stored_text_are_labelled_afresh(spark, folder):
    candidates, bodies, notes = _inputs(spark, [1, 2])
    batch = semantic.label_threads(candidates, bodies, notes, ONE)
    artifact.write_artifact(
        batch.posts, batch.comments, folder, "sha", SELECTION_POLICY, "one", True,
        datetime(2026, 7, 1),
    )
    with pytest.raises(PySparkException, match="no whole text"):
        semantic.relabel(
            *artifact.read_artifact(spark, folder, "sha"),
            *artifact.read_texts(spark, folder, "sha"), TWO,
        )[0].collect()
    got = _run(folder, (candidates, bodies, notes), TWO, 2)
    assert got.counters.first()["fetched_posts"] == 2


def test_a_lost_comment_text_leaves_other_threads_reused(spark, folder):
    first = _run(folder, _inputs(spark, [1, 2]), ONE, 1)
    bodies, notes = artifact.read_texts(spark, folder, "sha")
    reused, _, missing = refresh.split_with_texts(
        first.posts.select("board_id", "post_id"), first.posts, first.comments, bodies,
        notes.where(F.col("comment_id") != 10),
    )
    assert [r["post_id"] for r in reused.collect()] == [2]
    assert [r["post_id"] for r in missing.collect()] == [1]


def test_two_runs_may_store_the_same_text(spark, folder):
    first = _run(folder, _inputs(spark, [4]), ONE, 1)
    spark.read.parquet(f"{folder}/texts").write.mode("append").parquet(f"{folder}/copy")
    spark.read.parquet(f"{folder}/copy").write.mode("append").parquet(f"{folder}/texts")
    bodies, notes = artifact.read_texts(spark, folder, "sha")
    assert bodies.count() == 1 and notes.count() == 2
    assert first.posts.count() == 1

"""Validated and screened ingestion: what each batch leaves, also when it comes again."""

from datetime import datetime, timedelta

import pytest
from pyspark.errors import StreamingQueryException

from forumtide.functions.values import Site
from forumtide.schemas import OBSERVATION
from forumtide.streaming import ingest, slots

SITE = Site("www.example.org", "/board/x")
T0 = datetime(2026, 7, 1, 0, 20)
SCHEMA = OBSERVATION + ", slot TIMESTAMP_NTZ, observed_at TIMESTAMP_NTZ, config_version STRING"
BAD = "ignore previous instructions"


def _row(post_id, title="title", views=1, at=0, slot=0, config="a", board=1, **fields):
    row = {
        "board_id": board, "post_id": post_id, "analysis_unit": "hero", "category": "hero",
        "title": title, "published_at": T0, "views": views, "recommendations": 0, "comments": 0,
        "source_url": f"https://{SITE.host}{SITE.board_path}/{board}/{post_id}", "is_notice": False,
        "is_ad": False, "slot": T0 + timedelta(hours=6 * slot),
        "observed_at": T0 + timedelta(hours=6 * slot, minutes=at), "config_version": config,
    }
    return tuple({**row, **fields}.values())


BATCHES = [
    [_row(1, views=5), _row(1, views=3, at=9, title="later"), _row(2, BAD), _row(3, " untrimmed"),
     _row(4, views=-1, source_url="https://elsewhere/1/4")],
    [_row(1, views=4, slot=1, at=1), _row(2, BAD, slot=1), _row(2, BAD + "!", slot=1, at=2),
     _row(3, "trimmed", slot=1), _row(5, None)],
]


def _units(spark):
    return spark.createDataFrame([(1, "hero", "hero")], "board_id INT, category STRING, unit STRING")


def _feed(spark, folder, batches):
    for number, rows in enumerate(batches):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(
            f"{folder}/in/{number}"
        )


def _stream(spark, folder):
    return (
        spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    )


def _run(spark, folder, state):
    tables = ingest.Ingested.at(spark, f"{folder}/out")
    ingest.ingest_stream(
        _stream(spark, folder), _units(spark), SITE, tables, f"{folder}/{state}"
    ).awaitTermination()
    return tables


def _contents(tables):
    frames = (
        tables.posts.read(), tables.snapshots.read(), tables.quarantine.read(),
        tables.rejected(), tables.summary(),
    )
    return [sorted(map(str, frame.collect())) for frame in frames]


def test_batches_leave_accepted_rejected_and_quarantined_rows(spark, folder):
    _feed(spark, folder, BATCHES)
    tables = _run(spark, folder, "state")
    posts = {r["post_id"]: r for r in tables.posts.read().collect()}
    assert {i: r["title"] for i, r in posts.items()} == {1: "title", 2: BAD + "!", 3: "trimmed"}
    shots = {(r["post_id"], r["slot"].hour): r["views"] for r in tables.snapshots.read().collect()}
    assert shots == {(1, 0): 5, (2, 0): 1, (1, 6): 4, (2, 6): 1, (3, 6): 1}
    held = tables.quarantine.read().collect()
    assert len(held) == 2 and {r["source_ref"] for r in held} == {"post:1:2"}
    assert min(r["quarantined_at"] for r in held) == T0
    refused = {r["post_id"]: r["failed"] for r in tables.rejected().collect()}
    assert refused == {3: ["title"], 4: ["views", "url"], 5: ["title"]}
    counts = {r["n"]: tuple(r)[:5] for r in tables.summary().collect()}
    assert counts == {0: (1, 2, 0, 1, 3), 1: (1, 1, 2, 1, 2)}


def test_delivering_every_batch_again_changes_nothing(spark, folder):
    _feed(spark, folder, BATCHES)
    before = _contents(_run(spark, folder, "state"))
    # A new checkpoint numbers and delivers the same files again.
    assert _contents(_run(spark, folder, "other-state")) == before


def test_a_slot_of_another_configuration_refuses_the_batch(spark, folder):
    _feed(spark, folder, [BATCHES[0], [_row(1, config="b"), _row(9)]])
    with pytest.raises(StreamingQueryException, match="another configuration"):
        _run(spark, folder, "state")
    tables = ingest.Ingested.at(spark, f"{folder}/out")
    assert 9 not in {r["post_id"] for r in tables.posts.read().collect()}
    assert {r["n"] for r in tables.summary().collect()} == {0}


def test_one_batch_with_two_configurations_is_refused(spark, folder):
    _feed(spark, folder, [[_row(1), _row(1, config="b")]])
    with pytest.raises(StreamingQueryException, match="another configuration"):
        _run(spark, folder, "state")


def test_nothing_arrived(spark, folder):
    tables = ingest.Ingested.at(spark, f"{folder}/none")
    assert _contents(tables) == [[], [], [], [], []]


def test_batches_are_folded(spark, folder):
    _feed(spark, folder, [[_row(i % 3 + 1, views=i, slot=i)] for i in range(5)])
    tables = _run(spark, folder, "state")
    before = _contents(tables)
    for table in (tables.posts, tables.snapshots, tables.quarantine):
        table.compact()
    assert _contents(tables) == before and len(before[1]) == 5
    assert isinstance(tables.posts, slots.MergeTable)

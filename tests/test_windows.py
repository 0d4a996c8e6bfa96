from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from forumtide.operators import derived, ledger, metrics, ordering, rising, windows
from forumtide.params import RisingSpec, WindowSpec, settings_version
from forumtide.registry import SelectionPolicy, job_label_frame

END = datetime(2026, 7, 15, 3, 20)
POSTS = ("board_id INT, post_id BIGINT, analysis_unit STRING, title STRING, published_at TIMESTAMP_NTZ, "
         "source_url STRING, views BIGINT, recommendations BIGINT, comments BIGINT, slot TIMESTAMP_NTZ")


def posts(spark, rows):
    return spark.createDataFrame(
        [(1, i, unit, f"t{i}", END - timedelta(hours=h), "u", v, r, c, END)
         for i, (unit, h, v, r, c) in enumerate(rows)], POSTS)


@pytest.fixture(scope="module")
def sample(spark):
    rows = [("hero", 1, 10, 1, 2), ("hero", 168, 20, 2, 4)]
    rows += [("hero", 200 + i, 1, 1, 1) for i in range(4)]
    rows += [("hero", 721, 5, 5, 5), ("zero", 800, 7, 7, 7), ("free", 1, 9, 9, 9), ("thief_other", 1, 9, 9, 9)]
    rows += [("bishop", i, 100, 10, 0) for i in range(5)] + [("hero", -5, 0, 0, 0)]
    return posts(spark, rows)


def test_sparse_unit_takes_the_longer_window(sample):
    spec = WindowSpec(168, 720, 5)
    rows = windows.select_windows(sample, spec, "hero").collect()
    # Both bounds are closed at the start, and there is none at the end.
    assert len(rows) == 7 and {r["effective_hours"] for r in rows} == {720}
    assert {r["fallback_reason"] for r in rows} == {"7일 표본 부족"}
    assert {r["window_start"] for r in rows} == {END - timedelta(hours=720)}
    full = windows.select_windows(sample, spec, "bishop").collect()
    assert len(full) == 5 and {(r["effective_hours"], r["fallback_reason"]) for r in full} == {(168, None)}
    assert windows.select_windows(sample, WindowSpec(24), "hero").count() == 2
    with pytest.raises(ValueError):
        WindowSpec(168, 24)


def test_unit_comparison(spark, sample):
    got = {r["analysis_unit"]: r for r in metrics.unit_comparison(
        sample, WindowSpec(168, 720, 5), job_label_frame(spark)).collect()}
    assert set(got) == {"hero", "zero", "bishop"}
    hero, zero = got["hero"], got["zero"]
    assert (hero["job"], hero["sample_size"], hero["total_comments"], hero["effective_hours"]) == ("히어로", 7, 10, 720)
    assert hero["comments_per_post"] == 10 / 7
    assert (zero["sample_size"], zero["views_per_post"], zero["total_views"]) == (0, 0.0, 0)
    assert got["bishop"]["analysis_period"] == "2026.07.08–2026.07.15"


def test_top_lists(spark, sample):
    top = windows.rank_posts(sample, "comments", 3).collect()
    assert [r["title"] for r in top] == ["t9", "t8", "t7"]
    zero = windows.unanswered(sample).collect()
    assert [r["title"] for r in zero] == ["t15", "t10", "t11", "t12", "t13", "t14"]
    assert windows.rank_posts(sample.limit(0), "views").columns == list(windows.POST_VIEW)
    with pytest.raises(ValueError):
        windows.rank_posts(sample, "likes")


def test_candidates_keep_the_first_reason(spark):
    rows = [("hero", i, i, 10 - i, 0) for i in range(10)] + [("free", i, i, 0, 0) for i in range(10)]
    rows += [("hero", 24 * 91, 999, 999, 999), (None, 1, 5, 5, 5)]
    got = windows.detail_candidates(posts(spark, rows), SelectionPolicy("p", 90, 2, 4)).collect()
    reasons = {(r["analysis_unit"], r["post_id"]): r["selection_reason"] for r in got}
    hero = {k[1]: v for k, v in reasons.items() if k[0] == "hero"}
    # Comments tie at zero, so the newest are taken; they also lead recommendations.
    assert hero == {0: "comments", 1: "comments", 8: "views", 9: "views"}
    assert sorted(k[1] for k in reasons if k[0] == "free") == [10, 11, 12, 13, 16, 17, 18, 19]


def test_totals_and_shares_on_empty(spark, sample):
    none = sample.limit(0)
    assert tuple(metrics.engagement_totals(none).first()) == (0, 0, 0, 0)
    assert metrics.negative_share(none, "title").first()["share"] == 0.0
    assert metrics.distribution(none, "title").count() == 0
    shares = metrics.distribution(sample, "analysis_unit").collect()
    assert abs(sum(r["share"] for r in shares) - 1) < 1e-12


def big(spark, values, group="g"):
    return spark.createDataFrame([(group if i % 3 else "other", v) for i, v in enumerate(values)], "g STRING, v BIGINT")


def test_ranks_and_quantiles_equal_pandas(spark):
    rng = np.random.default_rng(4)
    values = [int(v) for v in np.concatenate([
        np.zeros(400), rng.integers(0, 50, 300), rng.integers(0, 2**20, 200), rng.integers(0, 2**44, 100)])]
    frame = big(spark, values)
    got = ordering.ranked_values(frame, ["g"], "v", ordering.integer_bucket(F.col("v"))).withColumn(
        "p", ordering.average_percentile()).toPandas().set_index(["g", "v"])["p"]
    plain = frame.toPandas()
    plain["p"] = plain.groupby("g")["v"].rank(method="average", pct=True)
    for g, v, p in plain.itertuples(index=False):
        assert got[(g, v)] == pytest.approx(p, abs=1e-15)
    for q in (0.0, 0.5, 0.9, 1.0):
        found = ordering.exact_quantile(frame, ["g"], "v", ordering.integer_bucket(F.col("v")), q, "q").toPandas()
        for g, value in found.itertuples(index=False):
            assert value == pytest.approx(np.quantile(plain[plain.g == g].v, q), rel=1e-12)


def test_unit_ranks_equal_pandas(spark):
    rng = np.random.default_rng(9)
    values = np.concatenate([np.zeros(100), rng.random(500), rng.random(200) * 2.0**-33, [1.0, 0.5, 0.5]])
    frame = spark.createDataFrame([("g", float(v)) for v in values], "g STRING, v DOUBLE")
    got = ordering.ranked_values(frame, ["g"], "v", ordering.unit_bucket(F.col("v"))).withColumn(
        "p", ordering.average_percentile()).toPandas().set_index("v")["p"]
    expected = pd.Series(values).rank(method="average", pct=True)
    assert all(got[v] == pytest.approx(p, abs=1e-15) for v, p in zip(values, expected))


SHOT = ("board_id INT, post_id BIGINT, slot TIMESTAMP_NTZ, views BIGINT, recommendations BIGINT, "
        "comments BIGINT, analysis_unit STRING")


def test_deltas_choose_the_nearest_boundary(spark):
    def shot(post, hours, views):
        return (1, post, END - timedelta(hours=hours), views, views, views, "u")

    rows = [shot(1, 0, 100), shot(1, 22, 80), shot(1, 26, 60), shot(1, 48, 10),
            shot(2, 0, 100), shot(2, 27.01, 5), shot(3, 0, 50), shot(3, 24, 70), shot(3, 51, 90)]
    got = {r["post_id"]: r for r in rising.post_deltas(
        spark.createDataFrame(rows, SHOT), RisingSpec(windows_hours=(24,))).collect()}
    # Equal distances: the earlier snapshot is the boundary.
    assert (got[1]["views_delta"], got[1]["prior_views_delta"], got[1]["sample_state"]) == (40, 50, "valid")
    assert got[1]["source_start_slot"] == END - timedelta(hours=26)
    assert (got[2]["views_delta"], got[2]["sample_state"]) == (None, "insufficient_history")
    assert (got[3]["views_delta"], got[3]["prior_views_delta"]) == (0, 0)


def test_scores_equal_pandas(spark):
    rng = np.random.default_rng(2)
    columns = [f"{p}{m}_delta" for p in ("", "prior_") for m in rising.RISING_METRICS]
    data = pd.DataFrame(rng.integers(0, 30, (200, 6)), columns=columns)
    data.insert(0, "board_id", 1)
    data.insert(1, "post_id", range(200))
    data["analysis_unit"] = rng.choice(["a", "b"], 200)
    data["window_hours"], data["as_of_slot"], data["sample_state"] = 24, END, "valid"
    data.loc[:9, "sample_state"] = "insufficient_history"
    spec = RisingSpec()
    scored = rising.rising_scores(spark.createDataFrame(data), spec).toPandas().set_index("post_id")
    valid = data[data.sample_state == "valid"].copy()
    w = spec.weights
    for prefix in ("", "prior_"):
        parts = [w[m] * np.log1p(valid[f"{prefix}{m}_delta"]).groupby(valid.analysis_unit).rank(pct=True)
                 for m in rising.RISING_METRICS]
        valid[f"{prefix}i"] = parts[0] + parts[1] + parts[2]
    pace = (valid.i - valid.prior_i).clip(lower=0).groupby(valid.analysis_unit).rank(pct=True)
    valid["score"] = 0.7 * valid.i + 0.3 * pace
    assert len(scored) == 190
    assert np.allclose(scored.loc[valid.post_id, "rising_score"], valid.score)
    got = rising.category_scores(
        spark.createDataFrame(scored.reset_index()), "analysis_unit", spec).toPandas().set_index("analysis_unit")
    threshold = valid.score.quantile(0.9)
    for unit, group in valid.groupby("analysis_unit"):
        expected = 0.7 * group.score.nlargest(5).mean() + 0.3 * group.score.ge(threshold).mean()
        assert got.loc[unit, "rising_score"] == pytest.approx(expected)


def test_weights_do_not_overflow():
    assert RisingSpec().weights == {"recommendations": 0.5, "comments": 0.35, "views": 0.15}
    huge = RisingSpec(recommendation_weight=1e308, comment_weight=1e308, view_weight=0).weights
    assert huge == {"recommendations": 0.5, "comments": 0.5, "views": 0.0}
    assert settings_version({"b": 1, "a": "가"}) == settings_version({"a": "가", "b": 1})


RUNS = ("id STRING, job_type STRING, slot TIMESTAMP_NTZ, status STRING, finished_at TIMESTAMP_NTZ, "
        "diagnostics STRING, started_at TIMESTAMP_NTZ")


def run(i, status, diagnostics="{}", job="metadata:hero", finished=END):
    return (f"r{i}", job, END + timedelta(hours=6 * i), status, finished, diagnostics, END)


def test_health_counts_partial_apart(spark, sample):
    runs = spark.createDataFrame([run(0, "succeeded"), run(1, "partial"), run(2, "failed"), run(3, "running")], RUNS)
    got = ledger.run_health(runs, sample).first()
    assert tuple(got) == (4, 1, 1, 1, 0.25, END)
    assert [r["id"] for r in ledger.failed_runs(runs).orderBy(F.desc("slot")).collect()] == ["r2", "r1"]
    assert ledger.run_health(runs.limit(0), sample.limit(0)).first()["success_rate"] == 0.0


def test_diagnostics_are_read_strictly(spark):
    texts = ['{"attempts": 3}', '{"attempts": -1}', '{"attempts": true}', '{"attempts": "3"}',
             '{"attempts": 3.0}', '{"attempts": null}', "[1]", "broken", None, '{"x": {"attempts": 4}}']
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i INT, d STRING")
    got = [r[0] for r in frame.orderBy("i").select(ledger.diagnostic_count(F.col("d"), "attempts")).collect()]
    assert got == [3, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    names = spark.createDataFrame([('{"failed_sources": ["a", 1, "", null, "b"]}',), ('{"failed_sources": "a"}',)], "d STRING")
    assert [r[0] for r in names.select(ledger.diagnostic_sources(F.col("d"))).collect()] == [["a", "b"], []]


def test_claims(spark):
    runs = spark.createDataFrame([
        run(0, "succeeded", '{"attempts": 2, "pages_consumed": 7, "accepted": 5, "failed_sources": ["x"]}'),
        run(1, "failed", '{"attempts": 2, "pages_consumed": 3}')], RUNS)
    requests = spark.createDataFrame(
        [("metadata:hero", END + timedelta(hours=6 * i)) for i in range(3)], "job_type STRING, slot TIMESTAMP_NTZ")
    got = [tuple(r)[2:] for r in ledger.claim_slots(requests, runs).orderBy("slot").collect()]
    assert got == [("r0", "already_succeeded", 2, 0, 7, 5, ["x"]), ("r1", "acquired", 3, 0, 3, 0, []),
                   (None, "acquired", 1, 0, 0, 0, [])]
    left = ledger.run_accounting(runs.withColumn("status", F.lit("running")), 5).orderBy("id").collect()
    assert [(r["pages_left"], r["may_reserve"]) for r in left] == [(0, False), (2, True)]


def test_cycle_and_freshness(spark):
    from datetime import timezone

    rows = [(1, "succeeded", False), (1, "already_succeeded", False), (2, "succeeded", True), (3, "busy", False),
            (3, "failed", False), (4, "succeeded", False), (4, "partial", False)]
    frame = spark.createDataFrame(rows, "slot INT, status STRING, backfill_failed BOOLEAN")
    got = {r["slot"]: r["cycle_status"] for r in ledger.cycle_status(frame, "slot").collect()}
    assert got == {1: "succeeded", 2: "partial", 3: "failed", 4: "partial"}
    runs = spark.createDataFrame([run(0, "succeeded"), run(1, "succeeded", job="backfill", finished=END + timedelta(days=9))], RUNS)
    at = END.replace(tzinfo=timezone.utc)
    assert ledger.is_fresh(runs, at + timedelta(hours=13), 13).first()[0] is True
    assert ledger.is_fresh(runs, at + timedelta(hours=13, seconds=1), 13).first()[0] is False
    assert ledger.is_fresh(runs.limit(0), at, 13).first()[0] is False
    with pytest.raises(ValueError):
        ledger.is_fresh(runs, at, 169)


def test_retention_and_review_edges(spark):
    from datetime import timezone

    now = END.replace(tzinfo=timezone.utc)
    rows = [("raw", 29, True), ("raw", 31, True), ("text", 89, True), ("text", 91, True), ("text", 91, False),
            ("text", 61, False), ("text", 76, False), ("text", 86, False), ("text", 59, False)]
    frame = spark.createDataFrame([(k, END - timedelta(days=d), p) for k, d, p in rows],
                                  "kind STRING, stored_at TIMESTAMP_NTZ, processed BOOLEAN")
    assert [r["action"] for r in derived.retention_plan(frame, now).collect()] == [
        "keep", "delete_raw", "keep", "delete_text", "expire_unprocessed", "warn_60", "warn_75", "warn_85", "keep"]
    texts = [(1, "h1", "x" * 30, 0.9, 1), (2, "h2", "y" * 30, 0.4, 5), (3, "h3", "가" * 10, 0.4, 9),
             (4, "h3", "가" * 10, 0.3, 1), (5, "h5", "z", 0.1, 1)]
    candidates = spark.createDataFrame(texts, "record_id BIGINT, content_hash STRING, text STRING, confidence DOUBLE, engagement BIGINT")
    seen = spark.createDataFrame([("h5",)], "content_hash STRING")
    got = derived.review_batch(candidates, seen, 10, 20).orderBy("position").collect()
    assert [(r["record_id"], r["tokens"]) for r in got] == [(4, 10), (2, 10)]
    assert derived.review_batch(candidates, seen, 1, 1000).count() == 1

"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import json
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from forumtide.llm import (
    bpe,
    jaccard_tree,
    line_dedup,
    mixing,
    quality_model,
    quality_rules,
    sharding,
    substring_dedup,
    topk,
    warc,
)
from tests.llm import helpers


@pytest.fixture(scope="module")
def docs(spark):
    return helpers.frame(spark, helpers.awkward())


@pytest.fixture(scope="module")
def empty(spark):
    return helpers.frame(spark, []).limit(0)


def _ids(frame):
    return Counter(r["doc_id"] for r in frame.select("doc_id").collect())


# ---- 10: quality rules ----

def test_rules_on_awkward_rows(docs, empty):
    ledger = quality_rules.judged(quality_rules.record(quality_rules.measure(docs)))
    rows = ledger.collect()
    assert Counter(r["doc_id"] for r in rows) == _ids(docs)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["n_words"] == 0 and by_id[1]["base_failed"] and not by_id[1]["kept"]
    assert by_id[12]["n_repeat_words"] == 400 and not by_id[12]["kept"]
    assert by_id[4]["kept"] and by_id[13]["n_words"] == 4000
    assert quality_rules.measure(empty).count() == 0
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    assert _ids(kept)[5] == 2 and 2 not in _ids(kept)


def test_ablation_counts_what_one_rule_alone_rejects(docs, empty):
    ledger = quality_rules.record(quality_rules.measure(docs))
    bits = [r["failures"] for r in ledger.collect()]
    for policy in quality_rules.POLICIES.values():
        rows = {r["rule"]: r for r in quality_rules.ablation(ledger, policy).collect()}
        assert set(rows) == set(policy.rejects)
        for name, row in rows.items():
            place = quality_rules.RULE_NAMES.index(name)
            assert row["failing"] == sum(b >> place & 1 for b in bits)
            assert row["recovered"] == sum(b & policy.mask == 1 << place for b in bits)
    none = quality_rules.ablation(quality_rules.record(quality_rules.measure(empty))).collect()
    assert {r["failing"] for r in none} == {0}


def test_policy_versions_differ_on_long_texts_and_so_does_their_sql(spark, folder):
    """Text of 1,500 words that repeats late: the whole text is poor, its windows are not."""
    from forumtide.llm.queries import _RULES_SQL
    from tests.compare import difference
    import duckdb
    import random

    rng = random.Random(3)
    some = [f"word{i}" for i in range(290)]
    long = " ".join(w for _ in range(6) for w in rng.sample(some, 290))
    rows = [(1, long), (2, " ".join(some)), (3, None), (4, " ".join(some[:150] * 4))]
    docs = helpers.frame(spark, rows)
    docs.select("doc_id", "text").write.parquet(f"{folder}/docs")
    ledger = quality_rules.record(quality_rules.measure(docs))
    kept = {
        version: {r["doc_id"] for r in quality_rules.judged(ledger, policy).where("kept").collect()}
        for version, policy in quality_rules.POLICIES.items()
    }
    assert kept["2"] == {2} and kept["3"] == {1, 2} and kept["base"] == {1, 2}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/docs/*.parquet'")
    shown = quality_rules.judged(ledger).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )
    assert difference(shown.toPandas(), con.execute(_RULES_SQL).df()) is None


def test_clean_text_of_any_length_is_kept(spark):
    """Clean documents one after another stay clean; few words repeated stay rejected."""
    import random

    clean = [
        r["text"] for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
        .join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id")
        .where("quality = 1 AND lang = 'en'").orderBy("doc_id").select("text").collect()
    ]
    text = "\n".join(dict.fromkeys(clean))
    words = text.split()
    assert len(words) > 250_000 and 5 * len(set(words)) < len(words)
    rng = random.Random(6)
    poor = " ".join(rng.choice(words[:150]) for _ in range(50_000))
    rows = [(1, text), (2, poor), (3, " ".join(words[:900])), (4, " ".join(words[:1001])), (5, "")]
    ledger = quality_rules.record(quality_rules.measure(helpers.frame(spark, rows)))
    bit = 1 << quality_rules.RULE_NAMES.index("few_distinct_in_windows")
    got = {r["doc_id"]: r for r in ledger.collect()}
    for doc_id, own in rows:
        w = own.split()
        assert got[doc_id]["n_window_distinct_words"] == sum(
            len(set(w[i:i + 1000])) for i in range(0, len(w), 1000)
        )
    assert [bool(got[i]["failures"] & bit) for i in range(1, 6)] == [False, True, False, False, False]
    assert {1, 3, 4} <= set(_ids(quality_rules.filter_documents(helpers.frame(spark, rows))))


# ---- 5: line dedup ----

def test_line_dedup_on_awkward_rows(docs, empty):
    out = line_dedup.deduplicated_lines(docs)
    assert [c for c in out.columns if c not in docs.columns] == []
    rows = out.select("doc_id", "text", "n_lines", "n_dropped").collect()
    assert Counter(r["doc_id"] for r in rows) == _ids(docs)
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[1]["text"] == "" and by_id[1]["n_lines"] == 1
    assert by_id[8]["text"] == "second" and by_id[8]["n_dropped"] == 2
    assert by_id[11]["n_dropped"] == 0
    assert line_dedup.deduplicated_lines(empty).count() == 0


def test_deleting_documents_undoes_their_insertion(spark, docs):
    store = line_dedup.LineStore.create(spark).insert(docs)
    before = sorted(map(tuple, store.counts(spark).collect()))
    held = store.shared_keys(store.refs(spark)).count()
    rows = [(100 + i, f"This line is shared by many documents.\nanother shared line of text {i % 2}")
            for i in range(8)]
    more = helpers.frame(spark, rows)
    grown = store.insert(more)
    assert grown.shared_keys(grown.refs(spark)).count() == held + 2
    again = grown.insert(more)
    assert again.refs(spark).count() == grown.refs(spark).count()
    back = grown.delete(more.select("doc_id"))
    assert sorted(map(tuple, back.counts(spark).collect())) == before
    assert back.shared_keys(back.refs(spark)).count() == held
    left = back.rewrite(docs).select("doc_id", "text").collect()
    direct = line_dedup.deduplicated_lines(docs).select("doc_id", "text").collect()
    assert sorted(map(str, left)) == sorted(map(str, direct))


def test_cuckoo_filter_forgets_only_what_is_deleted():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(5000)]
    made = line_dedup.CuckooFilter.build(keys)
    for key in keys[:2500]:
        made.discard(key)
    made = line_dedup.CuckooFilter.load(made.dump())
    assert made.may_hold(keys[2500:]).all() and all(k in made for k in keys[2500:2600])
    assert made.may_hold(keys[:2500]).mean() < 0.02


# ---- 2: mixing ----

def test_mixing_on_awkward_rows(spark, docs, empty):
    rows = [(d, t, None if d == 4 else "b" if d and d > 8 else "a") for d, t in helpers.awkward()]
    mix = mixing.poisson_mix(helpers.frame(spark, rows), explain=True)
    got = mix.collect()
    assert {r["doc_id"] for r in got} <= {d for d, _ in helpers.awkward()}
    per = Counter((r["doc_id"], r["text"]) for r in got)
    for r in got:
        assert per[(r["doc_id"], r["text"])] % r["n_copies"] == 0 and r["copy"] <= r["n_copies"]
    assert mixing.poisson_mix(empty).count() == 0


def test_mixing_meets_its_weights(spark):
    rows = [(i, "x" * 50, "big" if i % 10 else "small") for i in range(6000)]
    weights = spark.createDataFrame([("big", 1.0), ("small", 3.0)], "source string, weight double")
    mix = mixing.poisson_mix(helpers.frame(spark, rows), weights)
    share = Counter(r["source"] for r in mix.collect())
    assert abs(share["small"] / sum(share.values()) - 0.75) < 0.02
    assert abs(sum(share.values()) - 6000) < 300


def test_large_rates_do_not_underflow(spark):
    rows = [(i, "x", "a") for i in range(5)]
    mix = mixing.poisson_mix(helpers.frame(spark, rows), total=2 * 5 * 2000.0)
    counts = Counter(r["doc_id"] for r in mix.select("doc_id").collect())
    assert len(counts) == 5 and all(1700 < n < 2300 for n in counts.values())


def test_any_rate_is_drawn_with_a_short_table(spark):
    """One small document beside a large source; its rate is a million."""
    rows = [(1, "x", "small"), (2, "y" * 3_999_998, "large")]
    frame = helpers.frame(spark, rows)
    table = {r["source"]: r for r in mixing.source_rates(frame).collect()}
    assert table["small"]["rate"] > 1e6 and len(table["small"]["_ft_cdf"]) < 300
    mix = mixing.poisson_mix(frame.where("source = 'small'"), total=2e6, explain=True)
    counts = mix.groupBy("doc_id", "n_copies").agg(
        F.count_distinct("copy").alias("n"), F.max("copy").alias("last")
    ).collect()
    assert len(counts) == 1 and counts[0]["n"] == counts[0]["n_copies"] == counts[0]["last"]
    assert abs(counts[0]["n"] - 1_000_000) < 6000


def test_parts_of_a_rate_add_up(spark):
    rows = [(i, "x", "a") for i in range(400)]
    mix = mixing.poisson_mix(helpers.frame(spark, rows), total=2 * 400 * 200.0, explain=True)
    counts = [r["n_copies"] for r in mix.select("doc_id", "n_copies").distinct().collect()]
    mean = sum(counts) / 400
    assert abs(mean - 200) < 3 and 150 < sum((n - mean) ** 2 for n in counts) / 400 < 260


def test_null_ids_draw_by_their_text(spark):
    rows = [(None, f"text {i}", "a") for i in range(500)]
    mix = mixing.poisson_mix(helpers.frame(spark, rows), explain=True)
    got = mix.select("text", "n_copies", "shuffle_key").collect()
    assert len({r["shuffle_key"] for r in got}) == len(got)
    assert len({r["n_copies"] for r in got}) > 3


# ---- 4: sharding ----

def test_sharding_on_awkward_rows(docs, empty):
    out = sharding.interleaved(sharding.described(docs), shards=4).collect()
    assert Counter(r["doc_id"] for r in out) == _ids(docs)
    counts = Counter(r["shard"] for r in out)
    assert max(counts.values()) - min(counts.values()) <= 1
    for shard, n in counts.items():
        assert sorted(r["slot"] for r in out if r["shard"] == shard) == list(range(n))
    assert sharding.interleaved(sharding.described(empty)).count() == 0
    few = sharding.interleaved(sharding.described(docs.limit(3)), shards=8).collect()
    assert len({r["shard"] for r in few}) == 3


# ---- 6: byte-level BPE ----

def test_tokens_on_awkward_rows(spark, docs, empty):
    tokenizer = bpe.public_tokenizer(spark)
    out = bpe.decoded(bpe.encoded(docs, tokenizer), tokenizer)
    assert out.count() == docs.count()
    for r in out.select("text", "token_ids", "decoded").collect():
        assert bytes(r["decoded"]).decode() == (r["text"] or "")
    assert bpe.round_trip(empty, tokenizer).count() == 0
    assert _ids(bpe.round_trip(docs, tokenizer)) == _ids(docs)


def test_queue_equals_the_library_on_random_and_long_pieces(spark):
    import random

    import public_tokenizers as public
    import tiktoken

    encoder = bpe.public_tokenizer(spark).encoder()
    known = tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={}
    )
    rng = random.Random(3)
    letters = list("ab Ac'st \n\t  é中  \x1c\x85!#1२Ⅷ'll're😀​_")
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, "ab" * 30_000, "".join(rng.choices("abcde", k=20_000)), " " * 3000]
    for text in texts:
        ids = np.frombuffer(encoder.encode(text), dtype="<u4").tolist()
        assert ids == known.encode_ordinary(text), repr(text[:60])


# ---- 3: quality classifier ----

def test_classifier_on_awkward_rows(spark, docs, empty):
    labels = spark.createDataFrame(
        [(4, 1, 0), (5, 1, 0), (5, 0, 0), (12, 0, 0), (None, 1, 0), (13, None, 0), (10, 1, 0)],
        "doc_id bigint, quality int, toxic int",
    )
    out = quality_model.scored(docs, quality_model.fitted(docs, labels))
    assert _ids(out) == _ids(docs)
    for r in out.collect():
        assert 0 <= r["score"] <= 1
        want = r["doc_id"] is not None and helpers.crc(str(r["doc_id"])) % 5 == 0
        assert r["held_out"] == want
    unlabelled = quality_model.fitted(docs, labels.limit(0))
    assert {r["score"] for r in quality_model.scored(docs, unlabelled).collect()} == {0.5}
    assert quality_model.scored(empty, unlabelled).count() == 0


def test_flat_trees_walk_like_plain_trees():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    trees = quality_model.fit(x, y, trees=20)
    inner = trees.feature.shape[1]
    plain = []
    for row in x[:200]:
        total = trees.start
        for feature, cut, leaf in zip(trees.feature, trees.cut, trees.leaf):
            node = 0
            while node < inner:
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += leaf[node - inner]
        plain.append(1 / (1 + np.exp(-total)))
    score = trees.score(x)
    assert np.allclose(score[:200], plain) and ((score > 0.5) == y).mean() > 0.97


# ---- 7: Jaccard join ----

@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (2, 60)])
def test_components_on_awkward_rows(docs, words, percent):
    rows = [(d, t) for d, t in helpers.awkward()]
    out = jaccard_tree.components(docs, words, percent)
    got = out.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(
        map(str, helpers.jaccard_components(rows, words, percent))
    )


def test_large_groups_and_chains_lose_no_link(spark):
    """Hundreds of near copies (several trees), and chains linked only step by step."""
    import random

    rng = random.Random(5)
    base = helpers.sentences(9, 150).split()
    rows = []
    for i in range(700):
        words = list(base)
        for _ in range(rng.randint(1, 3)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    chain = helpers.sentences(10, 60).split()
    for i in range(120):
        chain = chain[1:] + [f"step{i}"]
        rows.append((1000 + i, " ".join(chain)))
    rows += [(2000 + i, " ".join(helpers.sentences(11, 9).split()[: 5 + i % 4])) for i in range(20)]
    rng.shuffle(rows)
    out = jaccard_tree.components(helpers.frame(spark, rows), 4, 85)
    got = out.select("doc_id", "n_shingles", "component_id").collect()
    assert sorted(map(tuple, got)) == sorted(helpers.jaccard_components(rows, 4, 85))


@pytest.mark.parametrize("most_parts", [1, 64])
def test_small_parts_meet_across_and_lose_no_link(spark, monkeypatch, most_parts):
    """Near copies with outliers, and unrelated texts around one passage, in trees of few rows.

    The passage makes buckets of many parts whose sets mostly do not link: they meet in pairs
    of parts, through the hub's group, or in buckets of two groups.
    """
    import random

    monkeypatch.setattr(jaccard_tree, "TREE_ROWS", {"hashes": 4, "point": 6})
    monkeypatch.setattr(jaccard_tree, "MOST_PARTS", most_parts)
    rng = random.Random(12)
    base = helpers.sentences(50, 90).split()
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.choice([1, 1, 2, 3, 4, 6])):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    passage = helpers.sentences(51, 40)
    for i in range(120):
        own = helpers.sentences(1000 + i // 3, 40 + i % 7).split()
        if i % 3:
            own[rng.randrange(len(own))] = f"other{i}"
        rows.append((500 + i, passage + " " + " ".join(own)))
    rng.shuffle(rows)
    out = jaccard_tree.components(helpers.frame(spark, rows), 4, 85)
    got = sorted(map(tuple, out.select("doc_id", "n_shingles", "component_id").collect()))
    expected = sorted(helpers.jaccard_components(rows, 4, 85))
    assert got == expected
    assert 40 < len({c for _, _, c in expected}) < 200


def test_two_groups_agree_in_linked_sets():
    """So that buckets of two groups lose no link either."""
    rng = np.random.default_rng(8)
    family = np.uint64((1 << jaccard_tree.FAMILY_BITS) - 1)
    for size in (2, 5, 9, 14, 30, 77, 160, 400):
        for _ in range(15):
            values = rng.integers(0, 2**63, size + size, dtype=np.uint64)
            a = np.unique(values[:size])
            cut = size * 15 // 185
            b = np.unique(np.r_[a[cut:], values[size:size + cut]])
            if not jaccard_tree._linked(a, b, 85) or (a.shape == b.shape and (a == b).all()):
                continue
            shared = np.intersect1d(
                jaccard_tree.signatures(a, 85), jaccard_tree.signatures(b, 85)
            )
            assert np.unique(shared & family, return_counts=True)[1].max() >= 2


def _units(sets, percent, visits=None):
    """One unit of the sets as a batch of points; with ``visits``, who visits it."""
    points = [jaccard_tree.count_vector(s, jaccard_tree.dimensions(len(s))).tobytes() for s in sets]
    n = len(sets)
    columns = {
        "unit": [1] * n, "root": list(range(n)), "side": list(range(n)),
        "size": [len(s) for s in sets], "point": points,
    }
    run = jaccard_tree._unit_links(percent, "point")
    if visits is not None:
        columns["visits"], run = visits, jaccard_tree._visits(percent, "point")
    return [
        (r["a"], r["b"]) for out in run(iter([pa.RecordBatch.from_pydict(columns)]))
        for r in out.to_pylist()
    ]


def test_long_sets_that_share_nothing_are_told_apart_by_their_points():
    """Else every two long texts of a bucket are plausible and their sets meet in pairs."""
    rng = np.random.default_rng(3)
    for size in (900, 4000, 6000, 20_000, 30_000):
        sets = [np.sort(rng.integers(0, 2**64, size, dtype=np.uint64)) for _ in range(12)]
        assert _units(sets, 80) == []
        assert _units(sets, 80, [i >= 6 for i in range(12)]) == []


def test_linked_sets_of_unequal_points_are_plausible():
    """Sizes on both sides of a step in the number of groups."""
    rng = np.random.default_rng(4)
    for large in (1025, 1200, 2049, 2500, 9000, 33_000, 40_000):
        b = np.unique(rng.integers(0, 2**64, large, dtype=np.uint64))
        a = np.sort(rng.choice(b, -(-large * 8 // 10), replace=False))
        assert jaccard_tree._linked(a, b, 80)
        for one, two in ((a, b), (b, a)):
            assert _units([one, two], 80) == [(0, 1)]
            assert _units([one, two], 80, [False, True]) == [(1, 0)]
            assert len(_units([one, one, two, one], 80, [False, False, True, True])) == 4
    assert jaccard_tree.dimensions(1) == jaccard_tree.dimensions(1024) == 128
    assert jaccard_tree.dimensions(1025) == 256 and jaccard_tree.dimensions(10**6) == 4096


@pytest.mark.parametrize("step", [1, 2, 3, 5, 100])
def test_each_set_of_a_bucket_is_sent_once(step):
    rows = sorted(
        [(s, k) for s in range(4) for k in range(s, 5) for _ in range(1 + (s * k) % 4)]
        + [(9, 1)] * 4 + [(10, 1), (10, 2), (10, 2), (11, 1), (11, 3), (11, 3)]
    )
    batches = [
        pa.RecordBatch.from_pylist(
            [{"signature": s, "set_key": k} for s, k in rows[i:i + step]]
        ) for i in range(0, len(rows), step)
    ]
    sent = [
        (r["signature"], r["hub"], r["set_key"])
        for out in jaccard_tree._shared(iter(batches)) for r in out.to_pylist()
    ]
    keys = {s: {k for t, k in rows if t == s} for s, _ in rows}
    assert sorted(sent) == [
        (s, min(ks), k) for s, ks in sorted(keys.items()) if len(ks) > 1 for k in sorted(ks)
    ]


@pytest.mark.parametrize("percent, small, large", [(72, 198, 275), (70, 38, 54), (60, 6, 10)])
def test_linked_sets_of_distant_classes_share_a_bucket(percent, small, large):
    for seed in range(20):
        values = np.random.default_rng(seed).integers(0, 2**63, large, dtype=np.uint64)
        a, b = np.sort(values[:small]), np.sort(values)
        assert jaccard_tree._linked(a, b, percent)
        shared = np.intersect1d(
            jaccard_tree.signatures(a, percent), jaccard_tree.signatures(b, percent)
        )
        assert len(shared)


def test_one_document_of_each_group_stays(docs, empty):
    out = jaccard_tree.one_per_component(docs, 4, 85)
    assert out.columns == docs.columns
    heads = Counter(
        d for d, _, head in helpers.jaccard_components(helpers.awkward(), 4, 85) if d == head
    )
    assert _ids(out) == heads
    assert jaccard_tree.one_per_component(empty).count() == 0
    assert jaccard_tree.components(empty).count() == 0


# ---- 9: substring dedup ----

def _plain_removed(rows):
    first = {}
    for doc_id, text in rows:
        words = helpers.words_of(text)
        for i in range(len(words) - 49):
            key = tuple(words[i:i + 50])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = helpers.words_of(text)
        gone = set()
        for i in range(len(words) - 49):
            if doc_id is not None and first[tuple(words[i:i + 50])] < doc_id:
                gone.update(range(i, i + 50))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((doc_id, len(words), len(gone), helpers.sha(kept)))
    return sorted(map(str, out))


def test_substrings_on_awkward_rows(docs, empty):
    got = [str(tuple(r)) for r in substring_dedup.deduplicated(docs).collect()]
    assert sorted(got) == _plain_removed(helpers.awkward())
    assert substring_dedup.deduplicated(empty).count() == 0


def test_substrings_across_factor_boundaries(spark):
    """Passages that overlap, repeat inside a document, or come from several documents."""
    import random

    rng = random.Random(8)
    pool = [helpers.sentences(20 + i, 70).split() for i in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randint(1, 5)):
            piece = rng.choice(pool)
            a = rng.randint(0, 25)
            words += piece[a:a + rng.randint(48, 70)] + helpers.sentences(rng.random(), rng.randint(0, 9)).split()
        rows.append((i, " ".join(words)))
    rows += [(100, "same " * 200), (101, "same " * 130), (102, "x " + "same " * 60)]
    rng.shuffle(rows)
    got = [str(tuple(r)) for r in substring_dedup.deduplicated(helpers.frame(spark, rows)).collect()]
    assert sorted(got) == _plain_removed(rows)


def test_rows_that_repeat_are_gathered_once(spark):
    """What is joined back to a row must not grow with the number of its copies."""
    text = helpers.sentences(40, 300)
    other = helpers.sentences(41, 20) + " " + text
    rows = [(7, text)] * 3000 + [(3, other), (9, other)]
    got = substring_dedup.deduplicated(helpers.frame(spark, rows)).collect()
    expected = _plain_removed([(7, text), (3, other), (9, other)])
    assert len(got) == len(rows) and sorted({str(tuple(r)) for r in got}) == expected
    spans, traced = substring_dedup.duplicate_spans(*_scanned(spark, rows))
    copies = traced.where("doc_id = 7").select(F.size("anchors").alias("n"))
    assert copies.distinct().count() == 1 and copies.first()["n"] < 40
    assert spans.where("doc_id = 7").distinct().count() < 40


def _scanned(spark, rows):
    texts = helpers.frame(spark, rows).select(
        "doc_id", F.col("text").cast("binary").alias("text"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    return texts, texts.mapInArrow(substring_dedup._scan, substring_dedup._SCANNED)


def test_factors_are_greedy_and_cover_all_found_windows():
    assert list(substring_dedup.factors([1, 2, 3, 9, 2, 3], [[2, 3], [1, 2, 4]])) == [
        (0, 2), (2, 1), (4, 2)
    ]


# ---- 8: top-k ----

def test_topk_on_awkward_rows(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, rows[7][1]) for i in range(300, 360)]  # ties
    rows += [(400, None), (450, [None] * 6), (500, [float("nan")] * 6), (550, [float("inf")] * 6),
             (None, rows[3][1]), (600, [1.0, -2.0]), (650, []), (700, [9.0] * 6)]
    frame = spark.createDataFrame(
        [(a, b, 1, "s") for a, b in rows],
        "vec_id bigint, embedding array<float>, label int, score string",
    )
    good = {
        i: np.pad(np.floor(256 * np.array(v, dtype=np.float64)), (0, 6 - len(v))).astype(np.int64)
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    expected = []
    for q in (i for i in good if i % 50 == 0):
        ranked = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(ranked)]
    found = topk.search(frame, F.col("vec_id") % 50 == 0, k=5)
    assert sorted(map(tuple, found.collect())) == sorted(expected)
    assert topk.search(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert topk.search(frame.where("vec_id = 50"), F.col("vec_id") % 50 == 0).count() == 0


# ---- 1: WARC ----

def _pages(spark, rows):
    return spark.createDataFrame(
        [(*r, "x", "y", "z") for r in rows],
        "page_id bigint, url string, html string, value string, archive string, payload string",
    )


def test_archives_on_awkward_rows(spark):
    big = "<p>é" * 60
    rows = [
        (3, "http://www.Example.com/a?q=1", big), (1, "https://example.com:80/a", big),
        (2, None, None), (5, "x\r\ny z", ""), (6, "http://b.org", "short"), (7, "http://b.org", "short"),
        (8, "http://c.org/", "WARC/1.1\r\nWARC-Type: fake\r\n\r\nWARC/1.1\r\n" * 9),
        (9, "http://d.org/", "\r\n\r\n" * 50), (None, "http://e.org/", big), (1, "again", big),
        (10, "http://f.org", "WARC/1.1\r" * 30_000 + "WARC/1.1\r\n"), (11, "", "x" * 200_000),
    ]
    got = warc.archived(_pages(spark, rows)).collect()
    assert len(got) == len(rows)
    for page_id, _, html in rows:
        raw = (html or "").encode()
        match = [r for r in got if r["page_id"] == page_id
                 and r["payload_digest"] == hashlib.sha256(raw).hexdigest()]
        assert match and all(r["payload_bytes"] == len(raw) for r in match)
        revisit = html == big and page_id != 1
        assert {r["record_type"] for r in match} == {"revisit" if revisit else "response"}
        assert {r["refers_to"] for r in match} == {1 if revisit else None}
    keys = [(r["url_key"], r["captured_at"], r["page_id"] is not None, r["page_id"] or 0) for r in got]
    assert keys == sorted(keys)
    assert any(r["url_key"] == "com,example)/a?q=1" for r in got)
    assert warc.archived(_pages(spark, []).limit(0)).count() == 0


def test_damaged_archives_are_refused(spark, folder):
    import glob
    import gzip

    path = f"{folder}/arc"
    warc.write_archives(_pages(spark, [(1, "http://a.org", "p" * 300)]).coalesce(1), path)
    for name in glob.glob(f"{path}/*.gz"):
        with gzip.open(name) as file:
            content = file.read()
        with gzip.open(name, "wb") as file:
            file.write(content.replace(b"ppp", b"qqq", 1))
    for name in glob.glob(f"{path}/.*.crc"):
        open(name, "wb").close()
    with pytest.raises(Exception, match="damaged|hecksum"):
        warc.read_archives(spark, path).collect()


def test_loser_tree_merges_any_number_of_runs():
    import random

    rng = random.Random(2)
    for k in (0, 1, 2, 3, 7, 16, 33):
        runs = [sorted(rng.choices(range(50), k=rng.randint(0, 20))) for _ in range(k)]
        merged = list(warc.merge_runs([iter(r) for r in runs], lambda x: x))
        assert merged == sorted(x for r in runs for x in r)


# ---- pipeline ----

def test_pipeline_stages_on_awkward_rows(spark, docs, empty):
    for frame in (docs, empty):
        current = frame
        for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, current, helpers.SF)
            last = place == len(corpus_pipeline.STAGES) - 1
            assert last or tuple(out.columns) == corpus_pipeline.COLUMNS
            current = spark.createDataFrame(out.collect(), out.schema)
    assert json.dumps(sorted(dict(empty.dtypes)))

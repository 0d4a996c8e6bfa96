"""Registered queries against their check SQL, or against plain versions."""

import pytest

from forumtide.llm.queries import load_llm
from forumtide.llm.quality_model import THRESHOLD
from tests.compare import check, connect
from tests.llm import helpers

QUERIES = load_llm()


@pytest.fixture(scope="module")
def con():
    return connect(helpers.SF)


def test_all_operators_are_registered():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14))
    assert "pipeline" in QUERIES


@pytest.mark.parametrize("name", sorted(n for n, q in QUERIES.items() if q.sql))
def test_query_matches_its_sql(spark, con, name):
    assert check(spark, con, helpers.SF, QUERIES[name])[0] == "ok"


def _documents(con):
    return con.execute("SELECT doc_id, text, source FROM documents ORDER BY doc_id").fetchall()


def test_shards_hold_the_rows_law(spark, con):
    got = QUERIES["op4_stratified_shards"].run(spark, helpers.SF).toPandas()
    docs = {d: (t, s) for d, t, s in _documents(con)}
    assert sorted(got["doc_id"]) == sorted(docs)
    counts = got.groupby("shard").size()
    assert sorted(counts.index) == list(range(8)) and counts.max() - counts.min() <= 1
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    for row in got.itertuples():
        text = docs[row.doc_id][0] or ""
        assert row.size == len(text.encode()) + 1 and row.text_crc32 == helpers.crc(text)
    # Contiguous cuts of evenly spread sources: every shard has each source's share, give or
    # take one row at either end.
    got["source"] = [docs[d][1] for d in got["doc_id"]]
    for source, part in got.groupby("source"):
        per = part.groupby("shard").size().reindex(range(8), fill_value=0)
        assert (abs(per - len(part) / 8) <= 2).all(), source


def test_tokens_match_the_tokenizer_library(spark, con):
    import base64
    import hashlib

    import numpy as np
    import public_tokenizers as public
    import tiktoken

    with open(public.path("byte_bpe_multi_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    known = tiktoken.Encoding(
        "own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    got = {r["doc_id"]: r for r in QUERIES["op6_byte_bpe"].run(spark, helpers.SF).collect()}
    for doc_id, text, _ in _documents(con):
        ids = known.encode_ordinary(text or "")
        packed = np.array(ids, dtype="<u4").tobytes()
        row = got[doc_id]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        assert row["decoded_sha256"] == helpers.sha(text or "")


def test_components_match_brute_force(spark, con):
    rows = [(d, t) for d, t, _ in _documents(con)]
    got = QUERIES["op7_jaccard_tree"].run(spark, helpers.SF).collect()
    assert sorted(map(tuple, got)) == sorted(helpers.jaccard_components(rows, 4, 85))


def test_scores_separate_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    got = QUERIES["op3_quality_trees"].run(spark, folder).toPandas()
    labels = connect(folder).execute("SELECT doc_id, quality FROM labels").df()
    assert len(got) == 10_000 and got["score"].between(0, 1).all()
    assert (got["predicted"] == (got["score"] >= THRESHOLD)).all()
    held = labels.merge(got, on="doc_id").query("held_out")
    assert len(held) > 500
    assert (held["predicted"] == held["quality"]).mean() > 0.98


def test_pipeline_matches_plain_stages(spark, con):
    """The whole pipeline by plain Python over the same documents."""
    import hashlib
    import math
    from collections import Counter, defaultdict

    docs = _documents(con)

    def kept(text):
        words = helpers.words_of(text)
        n = len(words)
        windows = [tuple(words[i:i + 8]) for i in range(n - 7)]
        often = Counter(windows)
        repeat = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(8)}
        lines = [x for x in (text or "").split("\n") if x.encode().split()]
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        return not (
            n < 20 or 100 * len(repeat) > 30 * n or 100 * symbols > 10 * n
            or 100 * (len(lines) - len(set(lines))) > 40 * len(lines)
            or sum(map(len, words)) > 25 * n
            or 100 * sum(len(set(words[i:i + 1000])) for i in range(0, n, 1000)) < 20 * n
        )

    docs = [d for d in docs if kept(d[1])]

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(
            {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
        )

    holders = defaultdict(set)
    for doc_id, text, _ in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(doc_id)
    shared = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    docs = [
        (d, "\n".join(x for x in (t or "").split("\n") if shared.get(key(x), d) == d), s)
        for d, t, s in docs
    ]
    heads = helpers.jaccard_components([(d, t) for d, t, _ in docs], 5, 80)
    docs = [doc for doc, (d, _, head) in zip(docs, heads) if d == head]

    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(text.encode()) + 1
    total, expected = sum(sizes.values()), Counter()
    for doc_id, text, source in docs:
        rate = total / len(sizes) / sizes[source]
        u = int(hashlib.md5(f"mix-1:{doc_id}".encode()).hexdigest()[:13], 16) / 2**52
        below = term = math.exp(-rate)
        n = 0
        while below <= u:
            n += 1
            term *= rate / n
            below += term
        if n:
            expected[(doc_id, helpers.sha(text))] = n
    got = Counter(
        (r["doc_id"], r["decoded_sha256"])
        for r in QUERIES["pipeline"].run(spark, helpers.SF).collect()
    )
    assert got == expected and len(expected) > 20


def test_shards_match_brute_force(spark, con):
    """Shards and slots again by plain Python, with the same seeded hash."""
    import struct
    from collections import defaultdict

    import xxhash

    from forumtide.llm.sharding import SEED

    def mixed(doc_id, text_crc, size):
        h = xxhash.xxh64_intdigest(struct.pack("<i", SEED), seed=42)
        for value in (doc_id, text_crc, size):
            h = xxhash.xxh64_intdigest(struct.pack("<q", value), seed=h)
        return h

    groups = defaultdict(list)
    for doc_id, text, source in _documents(con):
        crc, size = helpers.crc(text), len((text or "").encode()) + 1
        unit = (mixed(doc_id, crc, size) >> 12) / float(1 << 52)
        groups["n" if source is None else "s" + source].append((unit, doc_id, crc, size))
    order = []
    for source, rows in groups.items():
        for rank, row in enumerate(sorted(rows)):
            order.append(((rank + 0.5) / len(rows), source, rank, row[1]))
    order.sort()
    n = len(order)
    cuts = [shard * n // 8 for shard in range(9)]
    expected = {}
    for place, (_, _, _, doc_id) in enumerate(order):
        shard = max(k for k in range(8) if cuts[k] <= place)
        expected[doc_id] = (shard, place - cuts[shard])
    got = QUERIES["op4_stratified_shards"].run(spark, helpers.SF).collect()
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == expected

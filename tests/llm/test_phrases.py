"""Phrase mining against a plain version, and the index of one shard."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from forumtide.llm import phrases
from tests.llm import helpers

LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
SCHEMA = "doc_id bigint, lang string, text string, words string, total string, id string, rank int"


def _frame(spark, rows):
    return spark.createDataFrame([(i, *row, "x", "y", "z", 1) for i, row in enumerate(rows)], SCHEMA)


def _pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x20\x09]+", piece)
        if words:
            yield words


def _plain(rows, max_words, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in _pieces(text):
            n[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    found = [(lang, p) for (lang, p), c in f.items() if len(p) > 1 and c >= least]
    longest = Counter()
    for lang, p in found:
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    longest[lang, p[i:j]] = max(longest[lang, p[i:j]], f[lang, p])
    out = {}
    for lang, p in found:
        a = f[lang, p]
        if 100 * longest[lang, p] >= 50 * a:
            continue
        score, k = min(
            (10**6 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))
        )
        out.setdefault(lang, []).append(
            (-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]])
        )
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -score)
        for lang, held in out.items()
        for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1)
    )


def _check(spark, rows, max_words=3, least=2, top=2000, **sizes):
    got = phrases.collocations(_frame(spark, rows), max_words, least, top, **sizes).collect()
    expected = _plain(rows, max_words, least, top)
    assert sorted(map(tuple, got)) == expected
    return expected


def _texts(seed, n, vocabulary=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "中文", "A", "a"]
    return [
        "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", ". ", ",", "\n", "  "])
                for _ in range(rng.randint(0, 60)))
        for _ in range(n)
    ]


@pytest.mark.parametrize("max_words", [2, 3, 5])
def test_awkward_texts_in_small_shards(spark, max_words):
    rows = [("en", text) for text in _texts(1, 80)] + [(None, t) for t in _texts(2, 20)]
    rows += [("und", t) for t in _texts(3, 9)] + [("de", None), ("de", ""), ("fr", "., \n;")]
    rows += [("en", "x y x y x y x y"), ("es", "w " * 3000), ("es", "solo")] * 2
    assert len(_check(spark, rows, max_words, shard_words=300, bucket_words=500)) > 50


def test_limits_and_whole_default_sizes(spark):
    rows = [("en", text) for text in _texts(5, 300)]
    assert len(_check(spark, rows, least=10, top=7)) == 7
    assert _check(spark, rows[:1], least=50) == []
    assert phrases.collocations(_frame(spark, []).limit(0)).count() == 0


def test_a_phrase_inside_half_as_frequent_ones_is_dropped(spark):
    rows = [("en", "new york city. " * 4 + "new york. " * 4 + "old york city, " * 3)]
    kept = {row[2] for row in _check(spark, rows)}
    assert "new york" not in kept and "new york city" in kept and "york city" not in kept


def test_one_long_piece_is_not_cut(spark):
    text = " ".join(_texts(7, 4, 30)).replace(".", "").replace(",", "").replace("\n", " ")
    _check(spark, [("en", text * 40), ("en", "a b\n" * 500)], shard_words=200)


def test_long_texts_are_tokenised_in_chunks(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK", 32)
    for text in [*_texts(9, 60), "x" * 100 + " y", "", "a\n\n\nB", "é" * 50 + ". b"]:
        tokens = [t for part in phrases.chunks_of_tokens(text.encode()) for t in part]
        lines = b" ".join(tokens).decode().split("\n")
        assert [w.split(" ") for w in (x.strip(" ") for x in lines) if w] == list(_pieces(text))


def test_index_extends_on_both_sides():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 5, 2000).astype(np.int32)
    ids[-1] = 0
    pieces = [[int(x) for x in p.split()] for p in " ".join(map(str, ids)).split("0")]
    index = phrases.PhraseIndex(phrases.transform(ids))

    def count(phrase):
        k = len(phrase)
        return sum(p[i:i + k] == phrase for p in pieces for i in range(len(p) - k + 1))

    for phrase in ([1], [1, 2], [3, 3, 1], [4, 2, 1, 1], [1, 2, 3, 4, 1]):
        right = index.interval(phrase[0])
        for at, word in enumerate(phrase[1:], 1):
            right = index.extend_right(*right, at, word)
        left = index.interval(phrase[-1])
        for word in reversed(phrase[:-1]):
            left = index.extend_left(*left, word)
        assert right[1] == left[1] == count(phrase)
        assert not right[1] or right == left
    starts, sizes = map(np.array, zip(*[index.interval(w) for w in (1, 2, 3, 4)]))
    for _, size, head, tail in zip(*index.longer(starts, sizes, 1)):
        assert size == count([int(head) + 1, int(tail) + 1])


def test_suffixes_of_equal_pieces_keep_their_order():
    ids = np.array([1, 2, 0, 1, 2, 0, 2, 2, 2, 2, 0], dtype=np.int32)
    order = phrases.suffix_order(ids)
    # Each suffix up to its end; ends differ, the earlier one is less.
    texts = [
        tuple((x, 0) if x else (0, at) for at, x in enumerate(ids[i:i + list(ids[i:]).index(0) + 1], i))
        for i in range(len(ids))
    ]
    assert sorted(range(len(ids)), key=texts.__getitem__) == list(order)


def test_packing_round_trip():
    values = np.array([0, 1, 255, 256, 2**31 - 1], dtype=np.int64)
    for kind in ("<i4", "<i8"):
        assert (phrases.unpack(phrases.pack(values, kind), kind) == values).all()
    assert len(phrases.unpack(b"", "<i8")) == 0


def test_shared_helpers_are_used_on_repeated_rows(spark):
    rows = [("en", t) for _, t in helpers.awkward()] * 3
    _check(spark, rows, shard_words=500)

"""Small tables with awkward rows, and plain versions of the operators."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

SF = "/root/testdata/sf0.001"
# Extra columns whose names clash with what operators add or use.
CLASHING = (
    "n_words bigint, slot string, shard string, copy string, rate string, n_lines string, "
    "n_dropped string, key string, anchor string, at string, score string, token_ids string, "
    "value string, set_key string, root string, label string"
)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + CLASHING


def frame(spark, rows):
    """Documents from (doc_id, text[, source]) with all clashing extra columns."""
    full = []
    for doc_id, text, *rest in rows:
        source = rest[0] if rest else "src"
        n = None if text is None else len(text)
        full.append((doc_id, text, "en", source, n, 7, *["x"] * 15))
    return spark.createDataFrame(full, SCHEMA)


def sentences(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(n))


def awkward():
    base = sentences(1, 120)
    line = "This line is shared by MANY documents."
    return [
        (1, None), (2, ""), (3, "   \n\t \x0b\n"), (4, base), (5, base), (5, base),
        (None, base), (None, None), (6, base + " " + sentences(2, 4)), (7, sentences(3, 2)),
        (8, f"{line}\nsecond\n  {line.upper()}\t"), (9, f"x\n{line}"), (10, f"{line}\ny"),
        (11, f"{line.lower()} \nz"), (12, "w " * 400), (13, sentences(4, 4000)),
        (14, sentences(5, 60) + " " + base), (15, "naïve café Ünïcode 中文 字 😀 " * 9),
        (-3, base), (16, "a"), (17, "A"),
    ]


def words_of(text):
    return [w.decode() for w in (text or "").encode().split()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(text):
    return zlib.crc32((text or "").encode())


def shingle_set(text, words):
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return frozenset()
    n = min(words, len(tokens))
    return frozenset(tuple(tokens[i:i + n]) for i in range(len(tokens) - n + 1))


def jaccard_components(rows, words, percent):
    """Per row: set size and the smallest id reachable by links."""
    sets = [shingle_set(text, words) for _, text in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    groups = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        groups[find(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [d for d in groups[find(i)] if d is not None]
        first = (min(ids) if ids else None) if sets[i] else doc_id
        out.append((doc_id, len(sets[i]), first))
    return out

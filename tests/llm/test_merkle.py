"""Merkle manifests against plain trees, and the layout of their blocks."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from forumtide.llm import merkle
from tests.llm import helpers

COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def _h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(values):
    return _h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([_h(*last[i:i + 3]) for i in range(0, len(last), 3)])
    return levels


def _way(levels, at):
    way = []
    for level in levels[:-1]:
        first = at - at % 3
        run = level[first:first + 3]
        way.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
        at //= 3
    return way


def _plain(rows):
    """(doc_id, source, text) to the expected rows."""
    groups = {}
    for doc_id, source, text in rows:
        n = None if text is None else len(text)
        other = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0:
            other = text.replace("\n", "")
        own = _leaf([doc_id, source, "en", n, text])
        groups.setdefault(source, []).append(
            ((doc_id is not None, doc_id or 0, own), own, _leaf([doc_id, source, "en", n, other]))
        )
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort()
        trees[name] = _tree([own for _, own, _ in groups[name]])
    top = _tree([trees[name][-1][0] for name in names])
    out = []
    for place, name in enumerate(names):
        for at, ((known, doc_id, _), own, probe) in enumerate(groups[name]):
            way = _way(trees[name], at) + _way(top, place)
            folded = probe
            for left, right in way:
                folded = _h(left, folded, right)
            out.append((
                doc_id if known else None, own, trees[name][-1][0], top[-1][0],
                _h(*[left + right for left, right in way]), folded, folded == top[-1][0],
            ))
    return out


def _got(frame, height=merkle.HEIGHT):
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    text = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle.verified(frame, COLUMNS, "doc_id", "source", {"text": text}, height).collect()


def _equal(spark, rows, height=merkle.HEIGHT):
    frame = helpers.frame(spark, [(d, t, s) for d, s, t in rows])
    got = sorted(map(repr, map(tuple, _got(frame, height))))
    assert got == sorted(map(repr, _plain(rows)))


@pytest.mark.parametrize("height", range(8))
def test_layout_has_every_node_once(height):
    places = np.concatenate([
        merkle.address(height, level, np.arange(3 ** (height - level)))
        for level in range(height + 1)
    ])
    assert sorted(places) == list(range(merkle.tree_size(height)))
    assert merkle.address(height, height, np.array([0]))[0] == 0


def test_layout_keeps_bottom_parts_together():
    """Height 6 is cut into a top of height 2 and 27 bottoms of height 3: 40 nodes in a row."""
    bottoms = [
        np.concatenate([
            merkle.address(6, level, np.arange(27 // 3 ** level) + at * (27 // 3 ** level))
            for level in range(4)
        ]) for at in range(27)
    ]
    for at, places in enumerate(bottoms):
        assert sorted(places) == list(range(13 + 40 * at, 53 + 40 * at))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28, 81, 200, 729])
def test_block_equals_a_plain_tree(n):
    leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(n)]
    height = merkle.block_height(n)
    block = merkle.Block(n, height, merkle.lay_out(leaves, height))
    levels = _tree([leaf.hex() for leaf in leaves])
    assert block.root().hex() == levels[-1][0]
    siblings = block.siblings()
    for at in {0, n // 2, n - 1}:
        way = [level[at // 3 ** k] for k, level in enumerate(siblings)]
        assert [(a.decode(), b.decode()) for a, b in way] == _way(levels, at)
        assert merkle.climb(leaves[at], way) == block.root()


def test_awkward_rows(spark):
    rows = [(d, None if i % 5 == 0 else f"s{i % 3}", t)
            for i, (d, t) in enumerate(helpers.awkward())]
    _equal(spark, rows, height=1)
    assert _got(helpers.frame(spark, []).limit(0)) == []


def test_many_groups_and_a_large_one(spark):
    rows = [(i, "big", f"text {i}\n{i % 7}\n") for i in range(900)]
    rows += [(10_000 + i, f"small {i % 40} é", f"t{i}\nx") for i in range(120)]
    rows += [(i % 3, "copies", "same\n") for i in range(300)]
    rows += [(5, "", "one of the empty name"), (6, "lone", "a\nb")]
    _equal(spark, rows, height=2)  # small blocks: several tiers


def test_one_row(spark):
    _equal(spark, [(1, None, "lone\nleaf")])


def test_tampering_is_seen_only_where_bytes_change(spark):
    rows = [(i, "s", "line\nline" if i % 2 else "line") for i in range(50)]
    got = {r["doc_id"]: r for r in _got(helpers.frame(spark, [(d, t, s) for d, s, t in rows]))}
    for doc_id, _, text in rows:
        changed = "\n" in text and zlib.crc32(str(doc_id).encode()) % 2 == 0
        assert got[doc_id]["verified"] == (not changed)

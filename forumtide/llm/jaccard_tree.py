"""N-gram Jaccard join with a count-vector R-tree.

A document is the set of its hashed word shingles. Its point in the tree counts the shingles
per hash group; the sum of coordinate minima of two points bounds their overlap from above,
and the same sum against a node's largest coordinates bounds all overlaps below the node.
Pairs whose bound reaches the needed overlap are verified on the sets. A long set is counted
in more groups: with many shingles in each, all long sets would look alike. Points of unequal
length meet in the groups of the shorter one.

Which documents meet in one tree is decided by exact signatures. Two sets that link differ in
at most d shingles, so of d + 2 or more hash groups two hold the same shingles in both: the
contents of every group are hashed, and linked sets share such a bucket. Sets are grouped in
size classes, each indexed in its own class and in every later one where a partner may be.
Groups without shingles say nothing; a set with more of them than its class allows for is
grouped again by another hash, and the last round keeps even those.

A first pass builds trees of points per bucket and joins sets whose bound allows a link to
plausible clusters; texts that merely share a passage part here. A second pass verifies: a
cluster is one tree of sets, or several parts if it is large. Sets already connected are not
compared again. The first pass needs no text, and only the texts of clusters are read for the
second. Of a large cluster, representatives of its connected groups meet next. Then
the buckets that still hold unconnected sets are looked at: the sets outside a bucket's largest
connected group visit all parts of that group, or, if they are many, parts meet in pairs. A
bucket of so many parts that pairs would cost more is split first: linked sets agree in two
groups, so those that agree in a second one meet in a bucket of the two. No link is lost. Only
sets found in some bucket are moved at all.

Defined results: a null or empty text has no shingles and is linked with nothing. Texts with
fewer words than a shingle are one shingle. Rows with equal sets are linked. Rows with a null
doc_id take part, but name a component only if no other id can (the component is then null).
Repeated rows give repeated results. An empty table gives no rows. Only doc_id and text are
read. Sets are told apart by 64-bit hashes of their shingles.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumtide.llm.components import connected_components
from forumtide.llm.grams import mixed, run_hashes, text_chunks, word_hashes
from forumtide.session import discard, materialize

CLASS_RATIO = 1.38
ROUNDS = 12
# Groups of a point, by the size of the set: powers of two, at most PER_GROUP shingles in each.
LEAST_DIMENSIONS, MOST_DIMENSIONS, PER_GROUP = 128, 4096, 8
FAN_OUT = 16
TREE_ROWS = {"hashes": 64, "point": 1024}  # points are small, sets are not
# Parts of one bucket that meet in pairs. Beyond, a row per set and other group is cheaper.
MOST_PARTS = 64
# Low bits of a signature name its size class and round.
TURN_BITS, FAMILY_BITS = 4, 11
SEEN_SETS = 50_000

_SCANNED = (
    "doc_id bigint, text_hash bigint, set_key bigint, n_shingles bigint, point binary, "
    "signatures array<bigint>"
)
_BUCKETS = "signature bigint, hub bigint, set_key bigint"
_SETS = "set_key bigint, cluster bigint, part int, size bigint, hashes binary"
_LINKS = "a bigint, b bigint"


def shingles(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles."""
    hashes = word_hashes(text.lower().split())
    if not len(hashes):
        return hashes
    return np.unique(run_hashes(hashes, min(words, len(hashes))))


def set_key(hashes: np.ndarray) -> int:
    """64-bit name of a set of shingles."""
    with np.errstate(over="ignore"):
        total = mixed(hashes, hashes).sum(dtype=np.uint64) + np.uint64(len(hashes))
    return int(np.uint64(total).view(np.int64))


@cache
def class_floors() -> np.ndarray:
    floors = [1]
    while floors[-1] < 1 << 40:
        floors.append(max(floors[-1] + 1, int(floors[-1] * CLASS_RATIO) + 1))
    return np.array(floors, dtype=np.int64)


@cache
def class_groups(size_class: int, percent: int) -> tuple[int, int]:
    """Groups of a size class, and how many of them may be empty in one of two linked sets.

    Sets of a and b shingles that link differ in (a + b)(100 - p) / (100 + p) at most. Zero
    groups mean that only equal sets link. The allowance only sets how often a set needs
    another round: the least one that most sets keep to.
    """
    floors = class_floors()
    most = int(floors[size_class + 1]) - 1
    differing = 2 * most * (100 - percent) // (100 + percent)
    if differing < 1:
        return 0, 0
    least = percent * int(floors[size_class]) / 100
    allowed = 0
    while allowed < 8 + differing // 4:
        groups = differing + 2 + allowed
        mean = groups * exp(-least / groups)
        term = below = exp(-mean)
        for k in range(1, allowed + 1):
            term *= mean / k
            below += term
        if below > 0.8:
            break
        allowed += 1
    return differing + 2 + allowed, allowed


@cache
def _group_bounds(groups: int) -> np.ndarray:
    return np.array([(k << 64) // groups for k in range(1, groups)], dtype=np.uint64)


def _class_signatures(hashes: np.ndarray, size_class: int, percent: int) -> list[np.ndarray]:
    groups, allowed = class_groups(size_class, percent)
    if not groups:
        return []
    out = []
    for turn in range(ROUNDS):
        # Groups are ranges of the hash, so a sorted set is cut, not sorted again.
        turned = hashes if not turn else np.sort(mixed(hashes, np.full_like(hashes, turn)))
        cuts = np.r_[0, np.searchsorted(turned, _group_bounds(groups)), len(turned)]
        sums = np.r_[np.uint64(0), np.cumsum(mixed(turned, turned), dtype=np.uint64)]
        held = np.diff(cuts)
        content = sums[cuts[1:]] - sums[cuts[:-1]]
        place = np.arange(groups, dtype=np.uint64) + np.uint64(
            (size_class << 44) + (turn << 36)
        )
        signature = mixed(content, mixed(place, held.astype(np.uint64)))
        family = np.uint64((size_class << TURN_BITS) + turn)
        signature = (signature >> np.uint64(FAMILY_BITS) << np.uint64(FAMILY_BITS)) | family
        if turn == ROUNDS - 1:
            return [*out, signature]
        out.append(signature[held > 0])
        if groups - np.count_nonzero(held) <= allowed:
            break
    return out


def signatures(hashes: np.ndarray, percent: int) -> np.ndarray:
    floors = class_floors()
    own = int(np.searchsorted(floors, len(hashes), side="right")) - 1
    found = _class_signatures(hashes, own, percent)
    later = own + 1
    while 100 * len(hashes) >= percent * int(floors[later]):
        found += _class_signatures(hashes, later, percent)
        later += 1
    return np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)


class CountTree:
    """R-tree over count vectors, packed by size and then by coordinates.

    A node knows the largest coordinates and the sizes below it. ``search`` gives the items
    whose overlap with a point may reach what a link needs.
    """

    def __init__(self, sizes: np.ndarray, points: np.ndarray, percent: int):
        self.percent = percent
        self.order = np.lexsort((points[:, 1], points[:, 0], sizes))
        self.sizes, self.points = sizes[self.order], points[self.order]
        self.levels = []
        low = high = self.sizes
        top = self.points
        while len(top) > FAN_OUT:
            starts = np.arange(0, len(top), FAN_OUT)
            low = np.minimum.reduceat(low, starts)
            high = np.maximum.reduceat(high, starts)
            top = np.maximum.reduceat(top, starts, axis=0)
            self.levels.append((low, high, top))

    def _may_link(self, size: int, point: np.ndarray, low, high, top) -> np.ndarray:
        """Sizes within the ratio, and the coordinate minima reach the least overlap needed."""
        p = self.percent
        fits = (100 * high >= p * size) & (p * low <= 100 * size)
        nearest = np.maximum(low, -(-p * size // 100))
        bound = np.minimum(point, top).sum(axis=1)
        return fits & ((100 + p) * bound >= p * (size + nearest))

    def search(self, size: int, point: np.ndarray) -> np.ndarray:
        nodes = None
        for low, high, top in reversed(self.levels):
            if nodes is None:
                nodes = np.arange(len(low))
            nodes = nodes[nodes < len(low)]
            near = nodes[self._may_link(size, point, low[nodes], high[nodes], top[nodes])]
            nodes = (near[:, None] * FAN_OUT + np.arange(FAN_OUT)).ravel()
        if nodes is None:
            nodes = np.arange(len(self.sizes))
        nodes = nodes[nodes < len(self.sizes)]
        near = self._may_link(
            size, point, self.sizes[nodes], self.sizes[nodes], self.points[nodes]
        )
        return self.order[nodes[near]]


def dimensions(size: int) -> int:
    least = 1 << (max(size - 1, 0) // PER_GROUP).bit_length()
    return min(max(least, LEAST_DIMENSIONS), MOST_DIMENSIONS)


def count_vector(hashes: np.ndarray, groups: int) -> np.ndarray:
    shift = np.uint64(64 - groups.bit_length() + 1)
    return np.bincount((hashes >> shift).astype(np.int64), minlength=groups).astype(np.int32)


def folded(point: np.ndarray, groups: int) -> np.ndarray:
    """The same counts in fewer groups: a group is a range of hashes, so neighbours add up."""
    return point.reshape(groups, -1).sum(axis=1, dtype=np.int32)


def _points(blobs: list[bytes], exact: bool) -> list[np.ndarray]:
    """Points of equal length, of sets (``exact``) or of points as stored."""
    if exact:
        sets = [np.frombuffer(blob, dtype=np.uint64) for blob in blobs]
        groups = dimensions(max(map(len, sets)))
        return [count_vector(s, groups) for s in sets]
    points = [np.frombuffer(blob, dtype=np.int32) for blob in blobs]
    groups = min(map(len, points))
    return [folded(p, groups) for p in points]


def _linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact test of the shared shingles of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    shared = int(np.count_nonzero(b[at] == a))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def tree_links(
    roots: list[int], sides: list[int], sizes: list[int], points: list[np.ndarray],
    percent: int, accept=None,
) -> list[tuple[int, int]]:
    """Links that connect different roots: enough of them to connect all that are linked.

    Every pair of different sides that the tree lets through is a link if ``accept`` says so
    (without it the bound alone decides), unless the two are already connected.
    """
    root, side = np.array(roots, dtype=np.int64), np.array(sides, dtype=np.int64)
    if len(root) < 2 or (root == root[0]).all():
        return []
    tree = CountTree(np.array(sizes, dtype=np.int64), np.array(points), percent)
    links = []
    for i in range(len(root)):
        near = tree.search(sizes[i], points[i])
        near = near[(near > i) & (root[near] != root[i]) & (side[near] != side[i])]
        while len(near):
            j, near = near[0], near[1:]
            if accept is None or accept(i, j):
                links.append((int(root[i]), int(root[j])))
                root[root == root[j]] = root[i]
                near = near[root[near] != root[i]]
    return links


def _scan(words: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Copies met again by the same task send no point and no signatures: they combine before
        # the shuffle.
        seen: set[int] = set()
        for batch in batches:
            for part, texts in text_chunks(batch, "text"):
                keys, sizes, points, lists = [], [], [], []
                for text in texts:
                    hashes = shingles(text, words)
                    key = set_key(hashes)
                    keys.append(key)
                    sizes.append(len(hashes))
                    if key in seen or not len(hashes):
                        points.append(None)
                        lists.append(np.zeros(0, dtype=np.uint64))
                        continue
                    if len(seen) >= SEEN_SETS:
                        seen.clear()
                    seen.add(key)
                    points.append(count_vector(hashes, dimensions(len(hashes))).tobytes())
                    lists.append(signatures(hashes, percent))
                offsets = np.cumsum([0, *map(len, lists)])
                flat = np.concatenate(lists) if lists else np.zeros(0, np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array(keys, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(points, pa.binary()),
                     pa.ListArray.from_arrays(
                         pa.array(offsets, pa.int32()), pa.array(flat.view(np.int64))
                     )],
                    names=["doc_id", "text_hash", "set_key", "n_shingles", "point", "signatures"],
                )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by signature and set; runs of one set only are dropped on the way.

    Of a bucket only its first set (the hub), whether it was sent and the last set are
    remembered. Each set of a bucket is sent once, whatever the batches.
    """
    signature, hub, sent, last = None, 0, True, 0
    for batch in batches:
        sig = batch.column("signature").to_numpy(zero_copy_only=False)
        key = batch.column("set_key").to_numpy(zero_copy_only=False)
        if not len(sig):
            continue
        # Equal sets from different tasks stand next to each other.
        again = np.r_[
            signature is not None and sig[0] == signature and key[0] == last,
            (sig[1:] == sig[:-1]) & (key[1:] == key[:-1]),
        ]
        sig, key = sig[~again], key[~again]
        if not len(sig):
            continue
        first = np.r_[True, sig[1:] != sig[:-1]]
        if signature is not None and sig[0] == signature:
            first[0] = False
        starts = np.flatnonzero(first)
        run = np.cumsum(first) - 1  # -1: goes on from the batch before
        hubs = np.r_[key[starts], np.int64(hub)][run]
        other = key != hubs
        shared_run = np.zeros(len(starts) + 1, dtype=bool)
        shared_run[run[other]] = True
        out_sig, out_hub, out_key = sig[other], hubs[other], key[other]
        heads = starts[shared_run[:-1]]
        out_sig = np.r_[out_sig, sig[heads]]
        out_hub = np.r_[out_hub, key[heads]]
        out_key = np.r_[out_key, key[heads]]
        if shared_run[-1] and not sent:
            out_sig = np.r_[out_sig, np.int64(signature)]
            out_hub = np.r_[out_hub, np.int64(hub)]
            out_key = np.r_[out_key, np.int64(hub)]
            sent = True
        if len(starts):
            hub, sent = int(key[starts[-1]]), bool(shared_run[len(starts) - 1])
        signature, last = sig[-1], key[-1]
        if len(out_sig):
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (out_sig, out_hub, out_key)],
                names=["signature", "hub", "set_key"],
            )


def _set_rows(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch, "text"):
                sets = [shingles(text, words) for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("set_key", "cluster", "part")),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["set_key", "cluster", "part", "size", "hashes"],
                )

    return run


def _unit_links(percent: int, content: str):
    """Links of each unit by ``content``: its sets (``hashes``) or only its points."""
    exact = content == "hashes"

    def links(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if len(rows) < 2:
            return
        roots, sides, sizes, blobs = zip(*rows)
        points = _points(blobs, exact)
        if exact:
            sets = [np.frombuffer(blob, dtype=np.uint64) for blob in blobs]
            found = tree_links(
                roots, sides, sizes, points, percent,
                lambda i, j: _linked(sets[i], sets[j], percent),
            )
        else:
            found = tree_links(roots, sides, sizes, points, percent)
        if found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by unit; one unit is held at a time."""
        unit, rows = None, []
        for batch in batches:
            names = ("unit", "root", "side", "size", content)
            for u, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if u != unit:
                    yield from links(rows)
                    unit, rows = u, []
                rows.append(tuple(row))
        yield from links(rows)

    return run


def _visits(percent: int, content: str):
    """Links between the sets at home in a unit and those that visit it.

    Rows come sorted by unit, sets at home first. Those are held as one tree (a part, so few);
    visitors pass one at a time, however many there are, and are not compared with each other.
    """
    exact = content == "hashes"

    def point_of(blob: bytes, groups: int) -> np.ndarray:
        if exact:
            return count_vector(np.frombuffer(blob, np.uint64), groups)
        return folded(np.frombuffer(blob, np.int32), groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, home, points, trees, joined = None, [], [], {}, set()
        for batch in batches:
            found: list[tuple[int, int]] = []
            names = ("unit", "visits", "root", "side", "size", content)
            for u, visits, *row in zip(*(batch.column(c).to_pylist() for c in names)):
                if u != unit:
                    unit, home, points, trees, joined = u, [], [], {}, set()
                if not visits:
                    home.append(row)
                    continue
                if not home:
                    continue
                if not points:
                    points = _points([h[3] for h in home], exact)
                own, side, size, blob = row
                groups = len(points[0])
                if not exact:
                    groups = min(groups, dimensions(size))
                if groups not in trees:
                    trees[groups] = CountTree(
                        np.array([h[2] for h in home], dtype=np.int64),
                        np.array([folded(p, groups) for p in points]), percent,
                    )
                for i in trees[groups].search(size, point_of(blob, groups)):
                    root, its_side, _, its_blob = home[i]
                    if root == own or side == its_side or (own, root) in joined:
                        continue
                    if not exact or _linked(
                        np.frombuffer(blob, np.uint64), np.frombuffer(its_blob, np.uint64), percent
                    ):
                        joined.add((own, root))
                        found.append((own, root))
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"]
                )

    return run


def _parts(rows: DataFrame, key: str, content: str) -> DataFrame:
    """Adds ``part``: a key's rows are dealt over as many trees as they need."""
    most = TREE_ROWS[content]
    sizes = materialize(
        rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
        .select(F.col(key).alias("_key"), F.ceil(F.col("_n") / most).cast("int").alias("_k")),
        "large-keys",
    )
    # Other keys deal the same sets out differently, so their trees connect across parts.
    place = F.pmod(F.xxhash64("set_key", key), F.coalesce("_k", F.lit(1))).cast("int")
    return rows.join(sizes, F.col(key) == F.col("_key"), "left").withColumn(
        "part", place
    ).drop("_key", "_k")


def _links(units: DataFrame, percent: int, content: str) -> DataFrame:
    """Links found in the trees of the units (unit, root, side, size and the content)."""
    return materialize(
        units.select("unit", "root", "side", "size", content)
        .repartition("unit").sortWithinPartitions("unit")
        .mapInArrow(_unit_links(percent, content), _LINKS),
        "links",
    )


def _merged(roots: DataFrame, found: DataFrame) -> DataFrame:
    """Roots after links between roots; a set without a row is its own root."""
    more = connected_components(found).select(
        F.col("node").alias("_node"), F.col("root").alias("_up")
    )
    return materialize(
        roots.join(more, F.col("root") == F.col("_node"), "full").select(
            F.coalesce("node", "_node").alias("node"), F.coalesce("_up", "root").alias("root")
        ), "roots",
    )


def _rooted(rows: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.select(F.col("node").alias("set_key"), "root")
    return rows.join(named, "set_key", "left").withColumn("root", F.coalesce("root", "set_key"))


def _open(rows: DataFrame, key: str) -> DataFrame:
    """Rows of the buckets that hold different roots in different parts of one ``key``.

    ``rows`` are (signature, set_key, root, part) and ``key``, the column whose parts they are.
    Adds the root with most of the bucket's sets (``hub``), the number of sets outside it
    (``others``), and the number of ``parts``.
    """
    names = ["signature", key] if key != "signature" else ["signature"]
    held = rows.groupBy(*names, "root").agg(
        F.count(F.lit(1)).alias("_n"), F.min("part").alias("_p"), F.max("part").alias("_q")
    )
    still = materialize(
        held.groupBy(*names).agg(
            F.max_by("root", F.struct("_n", "root")).alias("hub"),
            (F.sum("_n") - F.max("_n")).alias("others"), F.count(F.lit(1)).alias("_roots"),
            F.min("_p").alias("_p"), F.max("_q").alias("_q"),
        ).where("_roots > 1 AND _p < _q")
        .select(*names, "hub", "others", (F.col("_q") + 1).alias("parts")),
        "open",
    )
    return materialize(rows.join(still, names), "open-rows")


def _crossing(
    open_: DataFrame, key: str, contents: DataFrame, percent: int, content: str
) -> DataFrame:
    """Links between the sets of open buckets across parts.

    Few sets outside the hub's group visit every part that has sets of it, and meet each other
    in a unit of the bucket; if they are many, every two parts meet. Sets of one part have been
    compared, which ``side`` says. However many buckets two sets share, each is sent to a unit
    once, and no unit holds more than two parts of sets at a time.
    """
    names = ["signature", key] if key != "signature" else ["signature"]
    few = F.col("others") <= TREE_ROWS[content]
    at_home = F.col("root") == F.col("hub")
    sent = ["unit", "set_key", "root", F.col("part").cast("bigint").alias("side")]

    def parts_of(rows: DataFrame) -> DataFrame:
        return materialize(
            rows.select(*names, F.col("part").alias("_other")).distinct(), "open-parts"
        )

    def visiting(rows: DataFrame, part: str, visits: bool) -> DataFrame:
        unit = F.xxhash64(key, F.lit(-1), part)
        return rows.withColumn("unit", unit).select(*sent, F.lit(visits).alias("visits"))

    home, guests = open_.where(few & at_home), open_.where(few & ~at_home)
    away = guests.join(parts_of(home), names)
    visits = visiting(home, "part", False).unionByName(visiting(away, "_other", True)).distinct()
    met = materialize(
        visits.join(contents, "set_key")
        .select("unit", "visits", "root", "side", "size", content)
        .repartition("unit").sortWithinPartitions("unit", "visits")
        .mapInArrow(_visits(percent, content), _LINKS),
        "visits",
    )
    crowded = open_.where(~few)
    pairs = crowded.join(parts_of(crowded), names).where(F.col("part") != F.col("_other"))
    one, two = F.least("part", "_other"), F.greatest("part", "_other")
    units = (
        guests.withColumn("unit", F.xxhash64(*names, F.lit(-2))).select(*sent)
        .unionByName(pairs.withColumn("unit", F.xxhash64(key, one, two)).select(*sent))
        .distinct()
    )
    return met.unionByName(_links(units.join(contents, "set_key"), percent, content))


def _second_groups(wide: DataFrame, shared: DataFrame) -> DataFrame:
    """Buckets of two agreeing groups for the sets of wide buckets: (signature, set_key).

    ``shared`` has all groups that sets share with another. Pairs that only connected sets
    agree in are left out.
    """
    family = (1 << FAMILY_BITS) - 1
    second = shared.select("set_key", F.col("signature").alias("_second"))
    pairs = wide.select("signature", "set_key", "root").distinct().join(second, "set_key").where(
        (F.col("signature") != F.col("_second"))
        & (F.col("signature").bitwiseAND(F.lit(family))
           == F.col("_second").bitwiseAND(F.lit(family)))
    )
    both = F.xxhash64(F.least("signature", "_second"), F.greatest("signature", "_second"))
    members = materialize(
        pairs.select(both.alias("signature"), "set_key", "root").distinct(), "second-groups"
    )
    open_ = members.groupBy("signature").agg(
        F.min("root").alias("_r"), F.max("root").alias("_s")
    ).where("_r < _s").select("signature")
    return members.join(open_, "signature", "left_semi").select("signature", "set_key")


def _rest(
    rows: DataFrame, key: str, contents: DataFrame, shared: DataFrame | None,
    roots: DataFrame, percent: int, content: str,
) -> DataFrame:
    """Roots after the sets of open buckets have met across parts."""
    open_ = _open(rows, key)
    if shared is not None:
        wide = open_.where((F.col("parts") > MOST_PARTS) & (F.col("others") > TREE_ROWS[content]))
        if not wide.isEmpty():
            pairs = materialize(_second_groups(wide, shared), "second-buckets")
            roots = _joined(pairs, contents, None, roots, percent, content)
            names = ["signature", key] if key != "signature" else ["signature"]
            narrow = rows.drop("root").join(wide.select(*names).distinct(), names, "left_anti")
            open_ = _open(materialize(_rooted(narrow, roots), "narrow-rows"), key)
    found = _crossing(open_, key, contents, percent, content)
    return roots if found.isEmpty() else _merged(roots, found)


def _by_representatives(
    rows: DataFrame, key: str, contents: DataFrame, roots: DataFrame, percent: int, content: str
) -> DataFrame:
    """Roots after one set of every connected group of a large key has met the others' sets."""
    for _ in range(2):
        groups = _rooted(rows.select("set_key", key), roots).groupBy(key, "root").agg(
            F.min("set_key").alias("set_key"), F.count(F.lit(1)).alias("_n")
        )
        chosen = materialize(groups.where("_n > 1").drop("_n"), "representatives")
        found = _links(
            _parts(chosen, key, content).join(contents, "set_key").withColumns({
                "unit": F.xxhash64(key, "part"), "side": F.col("set_key"),
            }), percent, content,
        )
        if found.isEmpty():
            break
        roots = _merged(roots, found)
    return roots


def _joined(
    members: DataFrame, contents: DataFrame, shared: DataFrame | None,
    roots: DataFrame | None, percent: int, content: str,
) -> DataFrame:
    """Sets joined by pairs of one bucket of ``members`` (signature, set_key).

    Without ``roots`` every set is its own. Parts of buckets first, then representatives of
    connected groups of large ones, then what is still open across parts.
    """
    placed = materialize(_parts(members, "signature", content), "placed")
    own = placed.withColumn("root", F.col("set_key")) if roots is None else _rooted(placed, roots)
    found = _links(
        own.join(contents, "set_key").withColumns({
            "unit": F.xxhash64("signature", "part"), "side": F.col("set_key"),
        }), percent, content,
    )
    roots = connected_components(found) if roots is None else _merged(roots, found)
    large = placed.where("part > 0").select("signature").distinct()
    within = materialize(placed.join(large, "signature", "left_semi"), "large-buckets")
    roots = _by_representatives(within, "signature", contents, roots, percent, content)
    rows = materialize(_rooted(within, roots), "large-rows")
    return _rest(rows, "signature", contents, shared, roots, percent, content)


def _placed_sets(
    placed: DataFrame, documents: DataFrame, texts: DataFrame, words: int
) -> DataFrame:
    """Rows of ``placed`` (set_key, cluster, part) with the size and the hashes of the set.

    Every set is read from one text that has it.
    """
    keys = ["set_key", "cluster", "part"]
    one = F.min_by(F.struct("doc_id", "text_hash"), F.coalesce("doc_id", F.lit(0)))
    holders = materialize(
        documents.where("n_shingles > 0").join(placed, "set_key").groupBy(*keys)
        .agg(one.alias("_h"))
        .select(*keys, F.col("_h.doc_id").alias("_d"), F.col("_h.text_hash").alias("_t")),
        "set-holders",
    )
    # One plan at every size: the wanted texts are found by a shuffle, never by a broadcast.
    found = texts.join(
        holders.hint("merge"),
        (F.col("text_hash") == F.col("_t")) & F.col("doc_id").eqNullSafe(F.col("_d")),
    ).select(*keys, "text").dropDuplicates(["set_key"])
    return materialize(found.mapInArrow(_set_rows(words), _SETS), "placed-sets")


def _roots_of_sets(
    buckets: DataFrame, shared: DataFrame, points: DataFrame, documents: DataFrame,
    texts: DataFrame, words: int, percent: int,
) -> DataFrame:
    """Connected sets: parts of plausible clusters, representatives of large ones, the rest.

    Clusters hold the sets that their count vectors do not tell apart.
    """
    members = buckets.select("signature", "set_key")
    clusters = _joined(members, points, shared, None, percent, "point").select(
        F.col("node").alias("set_key"), F.col("root").alias("cluster")
    )
    placed = _placed_sets(_parts(clusters, "cluster", "hashes"), documents, texts, words)
    roots = connected_components(_links(
        placed.withColumns({
            "unit": F.xxhash64("cluster", "part"), "root": F.col("set_key"),
            "side": F.col("set_key"),
        }), percent, "hashes",
    ))
    large = placed.where("part > 0").select("cluster").distinct()
    within = materialize(placed.join(large, "cluster", "left_semi"), "large-placed")
    keys = within.select("set_key", "cluster", "part")
    content = within.select("set_key", "size", "hashes")
    roots = _by_representatives(keys, "cluster", content, roots, percent, "hashes")
    rows = materialize(members.join(_rooted(keys, roots), "set_key"), "bucket-rows")
    return _rest(rows, "cluster", content, shared, roots, percent, "hashes")


def scanned_sets(docs: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    texts = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("text"),
        F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"),
    )
    return texts, materialize(texts.mapInArrow(_scan(words, percent), _SCANNED), "scanned-sets")


def components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles and component_id of every document. Runs jobs."""
    if not 0 < percent <= 100:
        raise ValueError("percent must be above 0 and at most 100")
    texts, scanned = scanned_sets(docs, words, percent)
    buckets = materialize(
        scanned.select(F.explode("signatures").alias("signature"), "set_key")
        .repartition("signature").sortWithinPartitions("signature", "set_key")
        .mapInArrow(_shared, _BUCKETS),
        "buckets",
    )
    # Near copies share most of their buckets: of buckets with the same sets one is kept.
    distinct = materialize(
        buckets.groupBy("signature").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("set_key")).alias("x"),
            F.bit_xor(F.xxhash64("set_key", F.lit(1))).alias("y"),
        ).groupBy("n", "x", "y").agg(F.min("signature").alias("signature")).select("signature"),
        "distinct-buckets",
    )
    kept = materialize(buckets.join(distinct, "signature", "left_semi"), "kept-buckets")
    # The wide columns have been used: the rest of the work reads the narrow ones.
    documents = materialize(scanned.drop("point", "signatures"), "scanned-documents")
    points = materialize(
        scanned.where("point IS NOT NULL").join(
            kept.select("set_key").distinct(), "set_key", "left_semi"
        ).select("set_key", F.col("n_shingles").alias("size"), "point").dropDuplicates(["set_key"]),
        "points",
    )
    discard(scanned)
    roots = _roots_of_sets(
        kept, buckets.select("signature", "set_key"), points, documents, texts, words, percent
    )
    firsts = documents.where("n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("_first")
    )
    labelled = materialize(
        firsts.join(roots.withColumnRenamed("node", "set_key"), "set_key", "left")
        .select("set_key", "_first", F.coalesce("root", "set_key").alias("_root")),
        "labelled-sets",
    )
    heads = labelled.groupBy("_root").agg(F.min("_first").alias("component_id"))
    named = materialize(
        labelled.join(heads, "_root").select(F.col("set_key").alias("_key"), "component_id"),
        "component-ids",
    )
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return documents.join(
        named, (F.col("set_key") == F.col("_key")) & (F.col("n_shingles") > 0), "left"
    ).select("doc_id", "text_hash", "n_shingles", own.alias("component_id"))


def one_per_component(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The input rows of the smallest doc_id of each component, columns unchanged.

    Rows with a null doc_id stay where their component has no id at all.
    """
    heads = components(docs, words, percent).where(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    ).select(F.col("doc_id").alias("_ft_id"), F.col("text_hash").alias("_ft_th")).distinct()
    return docs.join(
        heads,
        (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == F.col("_ft_th"))
        & docs["doc_id"].eqNullSafe(F.col("_ft_id")),
        "left_semi",
    )

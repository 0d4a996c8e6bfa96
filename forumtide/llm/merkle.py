"""Merkle manifests of a dataset, their nodes stored in van Emde Boas layout.

Every row is a leaf. The leaves of a group (a source) form a ternary tree, and the group roots,
in group order, form one more tree whose root stands for the dataset. A node is the SHA-256 of
its children's digests, written as lower-case hex and put together.

Trees are stored as blocks: aligned subtrees of at most 3**height leaves, one row each, whose
nodes lie in van Emde Boas order: a tree is split at half its height, the top part comes first
and the bottom parts follow, each laid out the same way. ``address`` gives the place of a node
by arithmetic alone; building a block and finding siblings both use it. Block roots are the
leaves of the next tier of blocks, until a group has one block. No task ever sees more than the
rows of a few blocks, and a tier has 3**height times fewer rows than the one below.

Defined results: a null value counts as ``-``. Leaves ascend by the order column, null first;
rows that tie are ordered by their leaf and, if that ties too, are one another's copies. A null
group is a group of its own before all others. Repeated rows are leaves of their own. An empty
table has no manifest and no rows. Input columns that are not named are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forumtide.session import materialize

ARITY = 3
HEIGHT = 6
DIGEST = 32
# Sort keys of groups: a null group comes first.
NULL_GROUP, GROUP_PREFIX = "n", "s"
TOP = "dataset"


def tree_size(height: int) -> int:
    """Nodes of a full tree of this height (a lone leaf has height 0)."""
    return (ARITY ** (height + 1) - 1) // (ARITY - 1)


def address(height: int, level: int, position: np.ndarray) -> np.ndarray:
    """Places, in van Emde Boas order, of nodes of a full tree.

    ``level`` counts from the leaves, ``position`` from the left within the level. The tree of
    ``height`` is cut above the leaves of its top part: the top part has half the height, and
    each node below the cut is the root of a bottom part.
    """
    position = np.asarray(position, dtype=np.int64)
    if height == 0:
        return np.zeros_like(position)
    bottom = (height - 1) - (height - 1) // 2  # height of a bottom part
    top = height - bottom - 1
    if level > bottom:
        return address(top, level - bottom - 1, position)
    below = ARITY ** (bottom - level)  # nodes of this level in one bottom part
    part, inside = position // below, position % below
    return tree_size(top) + part * tree_size(bottom) + address(bottom, level, inside)


@lru_cache(maxsize=64)
def _addresses(height: int) -> list[np.ndarray]:
    """Places of all nodes of a full tree, by level."""
    return [
        address(height, level, np.arange(ARITY ** (height - level)))
        for level in range(height + 1)
    ]


def block_height(n: int) -> int:
    """Height of the tree over n leaves."""
    height = 0
    while ARITY ** height < n:
        height += 1
    return height


def digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(part.hex().encode() for part in parts)).digest()


def lay_out(leaves: Sequence[bytes], height: int) -> bytes:
    """The nodes of a block in van Emde Boas order; places without a node stay zero."""
    nodes = np.zeros((tree_size(height), DIGEST), dtype=np.uint8)
    places = _addresses(height)
    below = list(leaves)
    nodes[places[0][:len(below)]] = np.frombuffer(b"".join(below), np.uint8).reshape(-1, DIGEST)
    for level in range(1, height + 1):
        below = [digest(*below[i:i + ARITY]) for i in range(0, len(below), ARITY)]
        nodes[places[level][:len(below)]] = np.frombuffer(
            b"".join(below), np.uint8
        ).reshape(-1, DIGEST)
    return nodes.tobytes()


class Block:
    """A stored block: digests by level and position."""

    def __init__(self, n: int, height: int, nodes: bytes) -> None:
        self.n, self.height, self.nodes = n, height, nodes

    def node(self, level: int, position: int) -> bytes:
        start = int(_addresses(self.height)[level][position]) * DIGEST
        return self.nodes[start:start + DIGEST]

    def root(self) -> bytes:
        return self.node(self.height, 0)

    def siblings(self) -> list[list[tuple[bytes, bytes]]]:
        """Per level below the root and position: hex digests left and right in its run."""
        levels, width = [], self.n
        for level in range(self.height):
            hexed = [self.node(level, p).hex().encode() for p in range(width)]
            levels.append([
                (b"".join(hexed[p - p % ARITY:p]), b"".join(hexed[p + 1:p - p % ARITY + ARITY]))
                for p in range(width)
            ])
            width = -(-width // ARITY)
        return levels


def climb(leaf: bytes, path: Sequence[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf gives with the siblings left and right on its way up."""
    for left, right in path:
        leaf = hashlib.sha256(left + leaf.hex().encode() + right).digest()
    return leaf


_BLOCKS_DDL = (
    "grp string, block bigint, whole boolean, n int, height int, nodes binary, root binary, "
    "probes array<binary>, ids array<bigint>"
)
_PATHS_DDL = "grp string, block bigint, lefts array<binary>, rights array<binary>"
_PROOFS_DDL = "id bigint, leaf binary, subroot binary, proof_sha256 string, folded_root binary"
_KINDS = {
    "string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(),
    "boolean": pa.bool_(), "array<binary>": pa.list_(pa.binary()),
    "array<bigint>": pa.list_(pa.int64()),
}


def _batch(rows: Sequence[tuple], ddl: str) -> pa.RecordBatch:
    fields = [field.split() for field in ddl.split(", ")]
    schema = pa.schema([(name, _KINDS[kind]) for name, kind in fields])
    columns = [pa.array(list(c), t) for c, t in zip(zip(*rows), schema.types)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


# ---- leaves ----

def field(value: Column) -> Column:
    """A value as its UTF-8 byte count, a colon and the value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")
    )


def leaf_digest(values: Sequence[Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(value) for value in values]), 256))


def leaves(
    docs: DataFrame, columns: Sequence[str], order: str, group: str,
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """Rows to be placed: ``grp, id, digest, probe``, stored once. This runs a job.

    ``probe`` is the leaf that a row would have with the ``changed`` columns, null where that
    is the leaf itself.
    """
    own = leaf_digest([F.col(f"`{c}`") for c in columns])
    other = leaf_digest([(changed or {}).get(c, F.col(f"`{c}`")) for c in columns])
    made = docs.select(
        F.coalesce(
            F.concat(F.lit(GROUP_PREFIX), F.col(f"`{group}`").cast("string")), F.lit(NULL_GROUP)
        ).alias("grp"),
        F.col(f"`{order}`").cast("bigint").alias("id"),
        own.alias("digest"),
        (F.nullif(other, own) if changed else F.lit(None).cast("binary")).alias("probe"),
        # Copies of one row tie in everything else; this lets their ranges be cut.
        F.monotonically_increasing_id().alias("salt"),
    )
    return materialize(made, "merkle-leaves")


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``idx``, the exact place of a row within its ``grp`` along ``order``.

    Rows are cut into ranges of the whole order, so a group that holds most rows spans many
    tasks; a range then needs only the number of rows before it. ``rows`` is read twice and
    should be stored. This runs jobs.
    """
    numbered = materialize(
        rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
        .withColumn("_ft_at", F.monotonically_increasing_id())
        .withColumn("_ft_part", F.shiftright("_ft_at", 33)),
        "merkle-ranges",
    )
    earlier = Window.partitionBy("grp").orderBy("_ft_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = F.coalesce(F.sum("_ft_n").over(earlier), F.lit(0))
    starts = materialize(
        numbered.groupBy("grp", "_ft_part")
        .agg(F.count(F.lit(1)).alias("_ft_n"), F.min("_ft_at").alias("_ft_first"))
        .select("grp", "_ft_part", (before - F.col("_ft_first")).alias("_ft_shift")),
        "merkle-starts",
    )
    return numbered.join(starts, ["grp", "_ft_part"]).withColumn(
        "idx", F.col("_ft_at") + F.col("_ft_shift")
    ).drop("_ft_part", "_ft_at", "_ft_shift")


# ---- trees ----

@dataclass(frozen=True)
class Forest:
    """The trees of many groups: tiers of blocks, tier 0 over the leaves, and group roots.

    ``height`` is that of the blocks of a group which has several of them.
    """

    height: int
    tiers: tuple[DataFrame, ...]
    roots: DataFrame


def _build(
    batches: Iterator[pa.RecordBatch], block_of_many: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for grp, block, whole, members in zip(*batch.columns):
            digests, probes, ids = (
                members.values.field(name) for name in ("digest", "probe", "id")
            )
            n = len(digests)
            height = block_height(n) if whole.as_py() else block_of_many
            nodes = lay_out(digests.to_pylist(), height)
            yield _batch([(
                grp.as_py(), block.as_py(), whole.as_py(), n, height, nodes,
                Block(n, height, nodes).root(), probes.to_pylist(), ids.to_pylist(),
            )], _BLOCKS_DDL)


def build(rows: DataFrame, height: int = HEIGHT) -> Forest:
    """The trees over placed leaves: ``grp, idx, digest, probe, id``. This runs jobs.

    Each tier groups rows by block, at most 3**height of them, however large a group is.
    """
    size = ARITY ** height
    tiers: list[DataFrame] = []
    while True:
        groups = materialize(
            rows.groupBy("grp").agg((F.max("idx") < size).alias("whole")), "merkle-groups"
        )
        members = F.array_sort(F.collect_list(F.struct("idx", "digest", "probe", "id")))
        gathered = rows.groupBy("grp", F.expr(f"idx div {size}").alias("block")).agg(
            members.alias("members")
        )
        blocks = materialize(
            gathered.join(groups, "grp").select("grp", "block", "whole", "members")
            .mapInArrow(partial(_build, block_of_many=height), _BLOCKS_DDL),
            "merkle-blocks",
        )
        tiers.append(blocks)
        if groups.where("NOT whole").isEmpty():
            break
        rows = blocks.where("NOT whole").select(
            "grp", F.col("block").alias("idx"), F.col("root").alias("digest"),
            F.lit(None).cast("binary").alias("probe"), F.lit(None).cast("bigint").alias("id"),
        )
    roots = [tier.where("whole").select("grp", "root") for tier in tiers]
    for more in roots[1:]:
        roots[0] = roots[0].unionByName(more)
    return Forest(height, tuple(tiers), materialize(roots[0], "merkle-roots"))


def _walk(batch: pa.RecordBatch) -> Iterator[tuple[dict, Block, list]]:
    """Blocks of a batch with the siblings of each of their leaves, block root included."""
    for row in batch.to_pylist():
        block = Block(row["n"], row["height"], row["nodes"])
        above = list(zip(row["lefts"], row["rights"]))
        levels = block.siblings()
        paths = []
        for position in range(block.n):
            path = []
            for level in levels:
                path.append(level[position])
                position //= ARITY
            paths.append(path + above)
        yield row, block, paths


def _descend(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, block, paths in _walk(batch):
            first = row["block"] * size
            yield _batch([
                (row["grp"], first + at, [p[0] for p in path], [p[1] for p in path])
                for at, path in enumerate(paths)
            ], _PATHS_DDL)


def _with_paths(blocks: DataFrame, groups: DataFrame, above: DataFrame | None) -> DataFrame:
    """Blocks with the way from their root upwards: their group's, or the next tier's."""
    found = blocks.where("whole").join(groups, "grp")
    if above is None:
        return found
    return found.unionByName(blocks.where("NOT whole").join(above, ["grp", "block"]))


def _descended(blocks: DataFrame, forest: Forest) -> DataFrame:
    below = partial(_descend, size=ARITY ** forest.height)
    return materialize(blocks.drop("probes", "ids").mapInArrow(below, _PATHS_DDL), "merkle-ways")


def ways_up(forest: Forest, groups: DataFrame) -> DataFrame:
    """Tier 0 with the siblings on the way from each block's root to the dataset's.

    ``groups`` (grp, lefts, rights) has those of the group roots. Tiers are read from the
    highest down; each has as many ways as the tier below has blocks.
    """
    above = None
    for blocks in reversed(forest.tiers[1:]):
        above = _descended(_with_paths(blocks, groups, above), forest)
    return _with_paths(forest.tiers[0], groups, above)


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, block, ways in _walk(batch):
            out = []
            for at, path in enumerate(ways):
                leaf = block.node(0, at)
                proof = hashlib.sha256(b"".join(part for pair in path for part in pair))
                probe = row["probes"][at] or leaf
                out.append((
                    row["ids"][at], leaf, row["subroot"], proof.hexdigest(), climb(probe, path)
                ))
            yield _batch(out, _PROOFS_DDL)


@dataclass(frozen=True)
class Manifest:
    """A dataset's trees: one per group, and one over the group roots.

    ``places`` names the leaf of each group in the tree over the roots.
    """

    groups: Forest
    dataset: Forest
    places: DataFrame

    def root(self) -> bytes | None:
        """The digest that stands for the dataset; None if it is empty."""
        row = self.dataset.roots.first()
        return None if row is None else bytes(row["root"])


def manifest(rows: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest over :func:`leaves`. This runs jobs."""
    groups = build(placed(rows, ["id", "digest", "salt"]), height)
    tops = groups.roots.select(
        F.lit(TOP).alias("grp"), F.col("grp").alias("name"), F.col("root").alias("digest"),
        F.lit(None).cast("binary").alias("probe"), F.lit(None).cast("bigint").alias("id"),
    )
    places = materialize(placed(tops, ["name"]), "merkle-places")
    return Manifest(groups, build(places, height), places.select("idx", "name"))


def proofs(made: Manifest) -> DataFrame:
    """Per leaf its siblings' digest and the root that its probe folds to. This runs jobs."""
    none = F.array().cast("array<binary>")
    tops = made.dataset.roots.select("grp", none.alias("lefts"), none.alias("rights"))
    ways = _descended(ways_up(made.dataset, tops), made.dataset)
    groups = ways.join(made.places, ways["block"] == made.places["idx"]).select(
        F.col("name").alias("grp"), "lefts", "rights"
    )
    roots = made.groups.roots.withColumnRenamed("root", "subroot")
    blocks = ways_up(made.groups, groups).join(roots, "grp")
    return blocks.mapInArrow(_prove, _PROOFS_DDL)


def verified(
    docs: DataFrame, columns: Sequence[str], order: str, group: str,
    changed: dict[str, Column] | None = None, height: int = HEIGHT,
) -> DataFrame:
    """A manifest of the rows, and whether each row, with ``changed`` columns, still fits it.

    Returns the order column with leaf, subroot, root, proof_sha256, folded_root and verified,
    digests as lower-case hex. This runs jobs.
    """
    made = manifest(leaves(docs, columns, order, group, changed), height)
    root = F.lit(made.root() or b"")

    def text(digest: Column) -> Column:
        return F.lower(F.hex(digest))

    return proofs(made).select(
        F.col("id").alias(order), text(F.col("leaf")).alias("leaf"),
        text(F.col("subroot")).alias("subroot"), text(root).alias("root"), "proof_sha256",
        text(F.col("folded_root")).alias("folded_root"),
        (F.col("folded_root") == root).alias("verified"),
    )

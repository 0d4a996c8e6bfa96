"""Exact top-k inner products: norm-sorted blocks with SVD-rotated partial sums.

Vectors are rotated by the right singular vectors of a bounded sample, which gathers most of
every product in the leading dimensions. Candidates are sorted by descending length and
packed into blocks. A query block skips a candidate block when the product of lengths cannot
reach the k-th best score known so far; within a block the partial sum over the leading
dimensions plus the Cauchy-Schwarz bound of the rest rules out most candidates, and only
survivors get exact integer scores. The sample changes the pruning, never the result.

Defined results: components become floor(scale * x). Rows whose id is null, or whose vector
is null or holds a null or non-finite component, take no part. Shorter vectors count as
padded with zeros. All rows with the query's id are its own and no candidates; repeated query
rows are answered each. Equal scores go to the smaller id, repeated ids to any of them. Empty
tables give no rows. Input columns other than id and vector are not read. Products must stay
within 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from forumtide.session import materialize

SCALE = 256
BLOCK_ROWS = 1024
RUN_BLOCKS = 4
HEAD_ROWS = 2048
SAMPLE_ROWS = 10_000
LEADING = 16
EXACT_FLOAT = 2.0**52
NOTHING = np.iinfo(np.int64).min


def usable(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, integer components and squared length of the rows that take part."""
    whole = F.transform("embedding", lambda x: F.floor(F.lit(scale) * x.cast("double")))
    fit = F.forall(
        "embedding",
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))),
    )
    return (
        vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit)
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), whole.alias("v"))
        .withColumn("length2", F.aggregate(
            "v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")
        ))
    )


def _dense(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, row in enumerate(rows):
        out[i, :len(row)] = row
    return out


def _rotation(sample: np.ndarray) -> np.ndarray:
    """Right singular vectors, most telling first."""
    width = sample.shape[1]
    if not width:
        return np.zeros((0, 0))
    _, axes = np.linalg.eigh(sample.T @ sample)
    return np.ascontiguousarray(axes[:, ::-1])


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products; in floating point where every sum is below 2**52."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = np.sqrt((a.astype(float) ** 2).sum(1).max() * (b.astype(float) ** 2).sum(1).max())
    if most < EXACT_FLOAT:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a @ b.T


def _best(query: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best: by score, ties to the smaller id."""
    order = np.lexsort((ids, -scores, query))
    ordered = query[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    start = np.maximum.accumulate(np.where(first, np.arange(len(ordered)), 0))
    return order[np.arange(len(ordered)) - start < k]


class _Search:
    """One query block against candidate blocks, longest vectors first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: np.ndarray,
                 rotation: np.ndarray, k: int):
        self.ids, self.vectors, self.floor, self.k = ids, vectors, floor.copy(), k
        self.rotation = rotation
        turned = vectors @ rotation
        self.lead = np.ascontiguousarray(turned[:, :LEADING])
        self.rest = np.sqrt((turned[:, LEADING:] ** 2).sum(1))
        self.length = np.sqrt((vectors.astype(float) ** 2).sum(1))
        self.kept = [np.zeros(0, np.int64)] * 3

    def block(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        longest = np.sqrt((vectors[:1].astype(float) ** 2).sum())
        live = np.flatnonzero(self.length * longest * (1 + 1e-9) + 1e-6 >= self.floor)
        if not len(live):
            return
        turned = vectors @ self.rotation
        rest = np.sqrt((turned[:, LEADING:] ** 2).sum(1))
        bound = self.lead[live] @ turned[:, :LEADING].T
        bound += np.outer(self.rest[live], rest)
        slack = 1e-9 * np.outer(self.length[live], np.full(len(ids), longest)) + 1e-6
        near = (bound + slack >= self.floor[live][:, None]) & (
            ids[None, :] != self.ids[live][:, None]
        )
        if not near.any():
            return
        if near.mean() > 0.05:
            q, c = np.nonzero(near)
            scores = _products(self.vectors[live], vectors)[q, c]
        else:
            q, c = np.nonzero(near)
            scores = np.einsum("ij,ij->i", self.vectors[live][q], vectors[c])
        q = live[q]
        enough = scores >= self.floor[q]
        found = (q[enough], ids[c[enough]], scores[enough])
        merged = [np.concatenate(pair) for pair in zip(self.kept, found)]
        keep = _best(*merged, self.k)
        self.kept = [part[keep] for part in merged]
        counts = np.bincount(self.kept[0], minlength=len(self.ids))
        lowest = np.full(len(self.ids), np.iinfo(np.int64).max)
        np.minimum.at(lowest, self.kept[0], self.kept[2])
        full = counts >= self.k
        self.floor[full] = np.maximum(self.floor[full], lowest[full])


def _unpack(blob: bytes, width: int) -> np.ndarray:
    return np.frombuffer(blob, dtype="<i8").reshape(-1, width)


def _pack(rows: pd.DataFrame, block: int, width: int, floor: np.ndarray | None = None) -> dict:
    vectors = _dense(rows["v"], width)
    packed = {
        "block": block, "longest": float(np.sqrt(rows["length2"].max())),
        "ids": rows["vec_id"].to_numpy(dtype="<i8").tobytes(),
        "vectors": vectors.astype("<i8").tobytes(),
    }
    if floor is not None:
        packed |= {"floor": floor.astype("<i8").tobytes(), "least": float(floor.min())}
    return packed


def _in_blocks(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Cuts a partition into frames of ``BLOCK_ROWS`` rows."""
    held = None
    for frame in rows:
        held = frame if held is None else pd.concat([held, frame], ignore_index=True)
        while len(held) >= BLOCK_ROWS:
            yield held.iloc[:BLOCK_ROWS]
            held = held.iloc[BLOCK_ROWS:].reset_index(drop=True)
    if held is not None and len(held):
        yield held


def search(vectors: DataFrame, is_query, k: int = 5, scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best. This runs jobs.

    ``is_query`` is a condition on vec_id. Only the sample for the rotation and the
    ``HEAD_ROWS`` longest vectors, which give every query its first floor, reach the driver.
    """
    rows = materialize(usable(vectors, scale), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0] or 0
    n = rows.count()
    share = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < max(1, (1 << 20) * SAMPLE_ROWS // max(n, 1))
    sample = _dense(rows.where(share).limit(2 * SAMPLE_ROWS).toPandas()["v"], width)
    rotation = _rotation(sample.astype(np.float64))
    top = rows.orderBy(F.desc("length2"), "vec_id").limit(HEAD_ROWS).toPandas()
    head_ids, head = top["vec_id"].to_numpy(dtype=np.int64), _dense(top["v"], width)

    def first_floor(ids: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """The k-th best score among the longest vectors."""
        scores = _products(queries, head)
        scores[head_ids[None, :] == ids[:, None]] = NOTHING
        if scores.shape[1] < k:
            return np.full(len(ids), NOTHING)
        return np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]

    def query_blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _in_blocks(parts):
            frame = frame.reset_index(drop=True)
            floor = first_floor(frame["vec_id"].to_numpy(), _dense(frame["v"], width))
            # Equal or near floors together, so that a block skips as a whole.
            frame = frame.iloc[np.argsort(floor, kind="stable")]
            yield pd.DataFrame([_pack(frame, 0, width, np.sort(floor, kind="stable"))])

    def candidate_blocks(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _in_blocks(parts):
            yield pd.DataFrame([_pack(frame, 0, width)])

    packed = "block bigint, longest double, ids binary, vectors binary"
    # Blocks of one partition keep their order: the number grows along the partition.
    numbered = F.monotonically_increasing_id()
    queries = materialize(
        rows.where(is_query).mapInPandas(query_blocks, packed + ", floor binary, least double")
        .withColumn("block", numbered), "query-blocks",
    )
    candidates = materialize(
        rows.repartitionByRange(F.desc("length2"), "vec_id")
        .sortWithinPartitions(F.desc("length2"), "vec_id")
        .mapInPandas(candidate_blocks, packed).withColumn("block", numbered),
        "candidate-blocks",
    )
    # A stated query set in blocks against blocks of all rows: only block facts are paired, and
    # pairs whose lengths cannot reach the floor are gone before any vector moves.
    pairs = queries.select(F.col("block").alias("q"), F.col("longest").alias("ql"), "least").join(
        candidates.select(F.col("block").alias("c"), F.col("longest").alias("cl")),
        F.col("ql") * F.col("cl") * (1 + 1e-9) + 1e-6 >= F.col("least"),
    ).select("q", "c", F.expr(f"c div {RUN_BLOCKS}").alias("run"))
    pairs = materialize(pairs, "block-pairs")
    # The columns get other names on this side: both come from one table of pairs.
    asked = pairs.select("q", "run").distinct().join(queries, F.col("q") == F.col("block"))
    offered = pairs.join(candidates, F.col("c") == F.col("block")).select(
        F.col("q").alias("q_"), F.col("run").alias("run_"), "c", "ids", "vectors"
    )

    def answer(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        block = left.iloc[0]
        ids = np.frombuffer(block["ids"], dtype="<i8")
        found = _Search(
            ids, _unpack(block["vectors"], width), np.frombuffer(block["floor"], dtype="<i8"),
            rotation, k,
        )
        for _, row in right.sort_values("c").iterrows():
            found.block(np.frombuffer(row["ids"], dtype="<i8"), _unpack(row["vectors"], width))
        place, vec, score = found.kept
        return pd.DataFrame({
            "q": block["q"], "place": place, "query_id": ids[place], "vec_id": vec, "score": score
        })

    hits = asked.select("q", "run", "ids", "vectors", "floor").groupBy("q", "run").cogroup(
        offered.groupBy("q_", "run_")
    ).applyInPandas(answer, "q bigint, place bigint, query_id bigint, vec_id bigint, score bigint")
    best = Window.partitionBy("q", "place").orderBy(F.desc("score"), "vec_id")
    return (
        hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

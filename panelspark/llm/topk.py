"""Exact top-k inner products with block-at-a-time pruning.

Vectors lie in blocks of similar direction: they are ordered by the nearest of a bounded sample of vectors
(the pivots), then by id, and cut into blocks. A block has the largest and the least value of each
component, which bound the score of any of its vectors for a query. A query visits the blocks in
the order of their bounds, scores a whole block at once from its forward index (the block's matrix),
and stops when the next bound is below its k-th score. Queries and blocks meet in tasks of a bounded
size: one group of queries with one run of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.llm.common import stored

BLOCK_ROWS = 512
#: Blocks of one task, and queries of one task.
RUN_BLOCKS = 16
GROUP_QUERIES = 1024
#: Sample of vectors that the order of the blocks goes by.
PIVOTS = 256
#: Largest LONG, and the largest component kept in four bytes.
MOST, NARROW = (1 << 63) - 1, (1 << 31) - 2


def scaled(vector: Column, scale: int) -> Column:
    """Each component x as floor(scale * x), x as DOUBLE; NULL if the vector takes no part.

    Vectors that are NULL, empty, hold a NULL or a value that is not finite take no part. A component
    beyond the range of a LONG is its end.
    """

    def whole(x: Column) -> Column:
        wide = F.floor(x.cast("double") * F.lit(float(scale)))
        inside = F.abs(x.cast("double") * F.lit(float(scale))) < F.lit(9.2e18)
        return F.when(inside, wide).when(x > 0, F.lit(MOST)).otherwise(F.lit(-MOST))

    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    return F.when(vector.isNotNull() & (F.size(vector) > 0) & finite, F.transform(vector, whole))


def _blocks(rows: DataFrame, per: int) -> DataFrame:
    """Sorted rows ``(id, q, v)`` of a partition as blocks of ``per`` vectors of one dimension."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, number = TaskContext.get().partitionId(), 0
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("id", "q", "v")), strict=True):
                if held and (len(held) == per or len(held[0][2]) != len(row[2])):
                    yield block(run, number, held)
                    held, number = [], number + 1
                held.append(row)
        if held:
            yield block(run, number, held)

    def block(run: int, number: int, held: list[tuple]) -> pa.RecordBatch:
        matrix = np.array([v for _, _, v in held], dtype="<i8")
        if matrix.max() <= NARROW and matrix.min() >= -NARROW:
            matrix = matrix.astype("<i4")
        return pa.RecordBatch.from_pydict(
            {
                "run": pa.array([run], pa.int32()),
                "block": pa.array([number], pa.int32()),
                "dim": pa.array([matrix.shape[1]], pa.int32()),
                "width": pa.array([matrix.itemsize], pa.int32()),
                "ids": [np.array([i for i, _, _ in held], "<i8").tobytes()],
                "rows": [np.array([q for _, q, _ in held], "<i8").tobytes()],
                "matrix": [matrix.tobytes()],
            }
        )

    return rows.mapInArrow(
        cut, "run int, block int, dim int, width int, ids binary, rows binary, matrix binary"
    )


def chained(pivots: np.ndarray) -> np.ndarray:
    """The pivots in an order in which each is followed by the nearest that is left, so that neighbours
    in the order of the blocks have similar directions."""
    lengths = np.maximum(np.linalg.norm(pivots, axis=1), 1e-9)
    cosines = (pivots / lengths[:, None]) @ (pivots / lengths[:, None]).T
    order = [0]
    cosines[:, 0] = -2.0
    while len(order) < len(pivots):
        order.append(int(cosines[order[-1]].argmax()))
        cosines[:, order[-1]] = -2.0
    return pivots[order]


def nearest(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot with the greatest cosine for each vector; the first of equals."""
    if not len(pivots):
        return np.zeros(len(vectors), np.int64)
    lengths = np.maximum(np.linalg.norm(pivots, axis=1), 1e-9)
    return (vectors @ (pivots / lengths[:, None]).T).argmax(axis=1)


def nearest_pivot(vector: Column, pivots: dict[int, np.ndarray]) -> Column:
    """The number of the nearest pivot among those of the vector's dimension; 0 if there are none."""

    def find(vectors: pa.Array) -> pa.Array:
        out = np.zeros(len(vectors), np.int64)
        sizes = np.diff(vectors.offsets.to_numpy())
        flat = vectors.flatten().to_numpy().astype(np.float64)
        ends = np.cumsum(sizes)
        for size in np.unique(sizes):
            here = np.flatnonzero(sizes == size)
            if len(own := pivots.get(int(size), ())):
                places = (ends[here] - size)[:, None] + np.arange(size)
                out[here] = nearest(flat[places], own)
        return pa.array(out)

    find.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(find, "long")(vector)


def best_of_run(queries: list[tuple], blocks: list[tuple], k: int) -> tuple[list[tuple], int]:
    """``(query row, query id, id, score)`` of the k best of the blocks for each query, and how many
    pairs of a query and a block were scored.

    ``queries`` and ``blocks`` hold ``(ids, rows, matrix)``; a query's own id is no candidate. Ties go to the
    smaller id.
    """
    ids = np.concatenate([q[0] for q in queries])
    rows = np.concatenate([q[1] for q in queries])
    asked = np.concatenate([q[2] for q in queries])
    # Products of doubles are exact below 2 ** 53 and far faster than those of integers; scores that
    # could leave the range of a LONG are computed in Python's integers.
    peak = float(np.abs(asked).max(initial=0)) * max(float(np.abs(b[2]).max()) for b in blocks)
    peak *= asked.shape[1]
    kind = np.float64 if peak < 2**53 else np.int64 if peak < 2**62 else object
    exact = object if kind is object else np.int64
    asked = asked.astype(exact)
    most = np.stack([b[2].max(axis=0) for b in blocks]).astype(exact)
    least = np.stack([b[2].min(axis=0) for b in blocks]).astype(exact)
    bounds = np.maximum(asked, 0) @ most.T + np.minimum(asked, 0) @ least.T
    order = np.argsort(-bounds, axis=1, kind="stable")
    below = np.maximum(asked, 0) @ least.T + np.minimum(asked, 0) @ most.T
    asked, matrices = asked.astype(kind), [b[2].astype(kind) for b in blocks]
    best: list[list[tuple[int, int]]] = [[] for _ in ids]
    floor = np.full(len(ids), below.min(initial=0) - 1, exact)  # under any score
    scored = 0
    for turn in range(len(blocks)):
        visit = order[:, turn]
        bound = np.take_along_axis(bounds, visit[:, None], axis=1)[:, 0]
        active = bound >= floor
        if not active.any():
            break
        for block in np.unique(visit[active]):
            who = np.flatnonzero(active & (visit == block))
            scored += len(who)
            scores = (asked[who] @ matrices[block].T).astype(exact)
            others = blocks[block][0]
            for line, query in zip(scores, who, strict=True):
                hit = np.flatnonzero((line >= floor[query]) & (others != ids[query]))
                found = [(-int(line[j]), int(others[j])) for j in hit]
                if len(found) > 4 * k:
                    cut = np.partition(line[hit], len(hit) - k)[len(hit) - k]
                    found = [f for f in found if -f[0] >= cut]
                best[query] = sorted(best[query] + found)[:k]
                if len(best[query]) == k:
                    floor[query] = -best[query][-1][0]
    found = [
        (int(rows[i]), int(ids[i]), other, max(min(-negative, MOST), -MOST))
        for i, hits in enumerate(best)
        for negative, other in hits
    ]
    return found, scored


def top_k(
    vectors: DataFrame,
    queries: Column,
    k: int = 10,
    scale: int = 1024,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best vectors for each row that ``queries`` selects.

    The score is the inner product of the scaled vectors (see ``scaled``). Candidates are all rows with
    another id than the query's; ties go to the smaller id. Vectors of different dimensions do not
    meet. Rows without a key take no part. A repeated query row has its own result; a repeated
    candidate row counts as often as it occurs. A score beyond the range of a LONG is its end; within a
    run of blocks such scores are still compared exactly. An empty table gives an empty result.
    """
    rows = stored(
        vectors.where(F.col(key).isNotNull())
        .select(
            F.col(key).cast("long").alias("id"),
            F.coalesce(queries, F.lit(False)).alias("asks"),
            scaled(F.col(vector), scale).alias("v"),
        )
        .where(F.col("v").isNotNull())
    )
    count, asking = rows.agg(F.count("*"), F.coalesce(F.sum(F.col("asks").cast("long")), F.lit(0))).first()
    runs = max(1, -(-count // (BLOCK_ROWS * RUN_BLOCKS)))
    groups = max(1, -(-asking // GROUP_QUERIES))

    # Different vectors chosen by hash: about PIVOTS of them, whatever the size of the table.
    choice = F.xxhash64("v") % (1 << 20)
    sample = rows.where(F.abs(choice) < F.lit(max(1.0, PIVOTS / max(count, 1) * (1 << 20)))).select("v")
    pivots: dict[int, list] = {}
    for row in sample.distinct().orderBy("v").limit(2 * PIVOTS).collect():
        pivots.setdefault(len(row["v"]), []).append(row["v"])
    pivots = {size: chained(np.array(found, np.float64)) for size, found in pivots.items()}

    def laid(part: DataFrame, pieces: int, per: int) -> DataFrame:
        dim = F.size("v").alias("dim")
        near = nearest_pivot(F.col("v"), pivots).alias("near")
        ordered = part.select("id", F.monotonically_increasing_id().alias("q"), "v", dim, near)
        order = ["dim", "near", "id"]
        spread = ordered.repartitionByRange(pieces, *order).sortWithinPartitions(*order)
        return stored(_blocks(spread.drop("dim", "near"), per))

    blocks = laid(rows.drop("asks"), runs, BLOCK_ROWS)
    asked = laid(rows.where("asks").drop("asks"), groups, GROUP_QUERIES)
    # Every group of queries meets every run of blocks once; both lists of numbers are short.
    run_numbers = [r[0] for r in blocks.select("run").distinct().collect()]
    group_numbers = [r[0] for r in asked.select("run").distinct().collect()]
    if not run_numbers or not group_numbers:
        return vectors.sparkSession.createDataFrame(
            [], "query_id long, rank int, vec_id long, score long"
        )

    def repeated(side: DataFrame, own: str, other: str, numbers: list[int]) -> DataFrame:
        each = F.explode(F.array(*[F.lit(n) for n in sorted(numbers)])).alias(other)
        return side.select("*", F.col("run").alias(own), each)

    left = repeated(asked, "g", "r", run_numbers).groupBy("g", "r", "dim")
    right = repeated(blocks, "r", "g", group_numbers).groupBy("g", "r", "dim")

    def unpack(frame: pd.DataFrame) -> list[tuple]:
        return [
            (np.frombuffer(i, "<i8"), np.frombuffer(q, "<i8"), np.frombuffer(m, f"<i{w}").reshape(-1, d))
            for i, q, m, d, w in zip(
                frame["ids"], frame["rows"], frame["matrix"], frame["dim"], frame["width"], strict=True
            )
        ]

    def meet(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        names = ["q", "query_id", "vec_id", "score"]
        if a.empty or b.empty:
            return pd.DataFrame(columns=names).astype("int64")
        found, _ = best_of_run(unpack(a), unpack(b.sort_values("block")), k)
        return pd.DataFrame(found, columns=names, dtype="int64")

    met = left.cogroup(right).applyInPandas(meet, "q long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    return (
        met.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

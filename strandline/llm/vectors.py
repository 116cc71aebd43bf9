"""Exact top-k search by columnar branch-and-bound.

Vectors are packed into blocks in vertical layout: one row of a block's matrix is one dimension of all its vectors.  A
block of queries meets every block of candidates once.  Queries of ``QUERY_BYTES`` or less are broadcast, so that
candidates stay where they are, and the k-th best of each query in one block is a floor for all other blocks; more
queries are sent to the blocks by an equi-join on block numbers.  Inside a pair of blocks, inner products grow a group of dimensions at a time, the heaviest dimensions
first.  What the remaining dimensions can still add is bounded by the product of the remaining lengths of query and
candidate; candidates whose upper bound is below the k-th best lower bound are dropped, and the rest are compacted
before the next group.  Each pair of blocks gives at most k rows for a query, and a window keeps the k best of them.

Rows: vectors that are null, hold null or non-finite components, or have a null id take no part; vectors are compared
with those of the same length only; an empty vector has score 0 with any other empty one; every row is a row of its
own, so that rows which share an id each ask, and each is a candidate for all rows but itself; ties go to the smaller
id; an empty table gives no rows; extra columns, also of the names used here, are not looked at.  Scores are exact for integers: products
that could leave the exact range of doubles are summed as Python integers, and a score beyond a long is set to the
nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strandline.llm._tables import ship_package, stored

#: Vectors in a block, on average.
BLOCK = 4096
QUERY_BLOCK = 512
#: Bytes of packed queries up to which they are broadcast.
QUERY_BYTES = 64_000_000
#: Dimensions that are added before candidates are dropped.
GROUP = 16
LONG = 2**63 - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component, as doubles."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def usable(vector: Column) -> Column:
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, bad), F.lit(False))


def _packed(vectors: DataFrame, size: int, n: int) -> DataFrame:
    """Rows (dim, block, ids, rows, matrix) from id, row, vector: column-wise float64 matrices of about ``size`` vectors.

    A vector's block comes from a hash of its row number, so that blocks are even whatever the ids and vectors are.
    """
    blocks = max(1, -(-n // size))
    tasks = min(blocks, max(4 * vectors.sparkSession.sparkContext.defaultParallelism, -(-blocks // 16)))
    dealt = vectors.withColumn("dim", F.size("vector")).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    sorted_rows = dealt.repartition(tasks, "dim", "block").sortWithinPartitions("dim", "block", "id", "row").select("dim", "block", "id", "row", "vector")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids, own, rows = None, [], [], []

        def block() -> pa.RecordBatch:
            matrix = np.concatenate(rows).reshape(-1, key[0]) if key[0] else np.zeros((sum(map(len, ids)), 0))
            columns = ([key[0]], [key[1]], [np.concatenate(ids).tobytes()], [np.concatenate(own).tobytes()], [np.ascontiguousarray(matrix.T).tobytes()])
            kinds = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["dim", "block", "ids", "rows", "matrix"])

        for batch in batches:
            if not batch.num_rows:
                continue
            dims, numbers, names, places = (batch.column(k).to_numpy() for k in range(4))
            values = batch.column(4).flatten().to_numpy()
            ends = np.cumsum(dims.astype(np.int64))
            starts = np.flatnonzero(np.concatenate([[True], (dims[1:] != dims[:-1]) | (numbers[1:] != numbers[:-1])]))
            for a, b in zip(starts, np.append(starts[1:], len(dims))):
                this = int(dims[a]), int(numbers[a])
                if key is not None and this != key:
                    yield block()
                    ids, own, rows = [], [], []
                key = this
                ids.append(names[a:b].astype(np.int64))
                own.append(places[a:b].astype(np.int64))
                rows.append(values[ends[a] - dims[a] : ends[b - 1]].astype(np.float64))
        if key is not None:
            yield block()

    return sorted_rows.mapInArrow(run, "dim int, block int, ids binary, rows binary, matrix binary")


def best_in_block(
    queries: np.ndarray, query_rows: np.ndarray, candidates: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int, floors: np.ndarray | None = None
) -> list[tuple[int, int, int]]:
    """(place of the query, id, score) of the k best candidates for each query; both matrices are dimensions by vectors.

    ``floors``: a score for each query below which nothing is asked for.
    """
    floors = np.full(len(query_rows), -np.inf) if floors is None else floors
    dims = len(candidates)
    largest = float(np.abs(queries).max(initial=0.0) * np.abs(candidates).max(initial=0.0)) * max(dims, 1)
    if largest >= 2.0**52:
        return _best_exact(queries, query_rows, candidates, ids, rows, k)
    order = np.argsort(-np.square(candidates).sum(axis=1), kind="stable")
    queries, candidates = np.ascontiguousarray(queries[order]), np.ascontiguousarray(candidates[order])
    edges = [*range(0, dims, GROUP), dims]

    def remaining(x: np.ndarray) -> np.ndarray:
        """Lengths of what is left from each edge on, a little too long rather than too short."""
        return np.array([np.sqrt(np.square(x[e:]).sum(axis=0)) for e in edges]) * (1 + 1e-9)

    left_q, left_c = remaining(queries), remaining(candidates)
    first = queries[: edges[1]].T @ candidates[: edges[1]] if dims else np.zeros((queries.shape[1], len(ids)))
    out: list[tuple[int, int, int]] = []
    for q in range(queries.shape[1]):
        alive = np.flatnonzero(rows != query_rows[q])
        score = first[q, alive]
        for g in range(1, len(edges)):
            if g > 1:
                score = score + queries[edges[g - 1] : edges[g], q] @ candidates[edges[g - 1] : edges[g], alive]
            if g < len(edges) - 1 and len(alive):
                slack = left_q[g, q] * left_c[g, alive]
                floor = floors[q]
                if len(alive) > k:
                    floor = max(floor, np.partition(score - slack, len(alive) - k)[len(alive) - k])
                stay = score + slack >= floor
                if not stay.all():
                    alive, score = alive[stay], score[stay]
        if len(alive) > k:
            edge = np.partition(score, len(alive) - k)[len(alive) - k]
            stay = score >= edge
            alive, score = alive[stay], score[stay]
        best = np.lexsort((ids[alive], -score))[:k]
        out += [(q, int(ids[alive[b]]), int(score[b])) for b in best]
    return out


def _best_exact(queries: np.ndarray, query_rows: np.ndarray, candidates: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The same for components so large that doubles aren't exact."""
    whole = [[int(x) for x in column] for column in candidates.T]
    out = []
    for q, query in enumerate(queries.T):
        own = [int(x) for x in query]
        scores = [(max(-LONG - 1, min(LONG, sum(a * b for a, b in zip(own, c)))), int(i)) for c, i, r in zip(whole, ids, rows) if r != query_rows[q]]
        out += [(q, i, s) for s, i in sorted(scores, key=lambda x: (-x[0], x[1]))[:k]]
    return out


def _best(pairs: DataFrame, k: int, floors: dict[int, int] | None = None) -> DataFrame:
    """query_row, query_id, vec_id, score: the best of each pair of blocks (dim, query_ids, query_rows, query_matrix, ids, rows, matrix)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, *numbers, q_matrix, c_matrix in zip(*(batch.column(c) for c in range(7))):
                dim = dim.as_py()
                query_ids, query_rows, ids, rows = (np.frombuffer(x.as_py(), np.int64) for x in numbers)
                q, c = (np.frombuffer(x.as_py(), np.float64).reshape(dim, -1) if dim else np.zeros((0, len(i))) for x, i in ((q_matrix, query_ids), (c_matrix, ids)))
                least = np.array([floors.get(r, -np.inf) for r in query_rows.tolist()]) if floors else None
                found = best_in_block(q, query_rows, c, ids, rows, k, least)
                places, names, scores = (np.array(x, np.int64) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (query_rows[places], query_ids[places], names, scores)], ["query_row", "query_id", "vec_id", "score"])

    columns = pairs.select("dim", "query_ids", "query_rows", "ids", "rows", "query_matrix", "matrix")
    return columns.mapInArrow(run, "query_row bigint, query_id bigint, vec_id bigint, score bigint")


def top_k(df: DataFrame, is_query: Column, *, key: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` other rows with the largest inner products for each row where ``is_query``."""
    ship_package(df.sparkSession)
    rows = df.select(df[key].cast("bigint").alias("id"), df[vector].alias("vector"), is_query.alias("asks")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    # written once, so that a row keeps its number
    rows = stored(rows.withColumn("vector", quantised(F.col("vector"), scale)).withColumn("row", F.monotonically_increasing_id()))
    n, asking, query_bytes = rows.agg(F.count(F.lit(1)), F.count_if("asks"), F.coalesce(F.sum(F.when(F.col("asks"), 8 * F.size("vector") + 16)), F.lit(0))).first()
    candidates = stored(_packed(rows.drop("asks"), BLOCK, n))
    asked = stored(_packed(rows.where("asks").drop("asks"), QUERY_BLOCK, asking)).select("dim", F.col("ids").alias("query_ids"), F.col("rows").alias("query_rows"), F.col("matrix").alias("query_matrix"))
    if query_bytes <= QUERY_BYTES:
        few = F.broadcast(asked)
        seen = _best(candidates.where("block = 0").join(few, "dim"), k).groupBy("query_row").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("floor"))
        floors = {r["query_row"]: r["floor"] for r in seen.where(F.col("n") >= k).collect()}  # a row a query, and these are few
        best = _best(candidates.join(few, "dim"), k, floors)
    else:
        grid = candidates.select("dim", "block").distinct()  # a row for BLOCK vectors
        grid = F.broadcast(grid) if n <= BLOCK * 1_000_000 else grid
        best = _best(asked.join(grid, "dim").join(candidates, ["dim", "block"]), k)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

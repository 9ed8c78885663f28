"""Exact top-k by integer inner product over an impact-ordered index, score at a time.

Index: vectors are dealt into blocks; in a block, the components of each dimension form postings
(row, impact), cut into segments by quantised impact: the bit length of the component's size. Search: a
batch of queries meets a block and adds up segments, largest impacts first. What is still missing from
a row's score is at most the sum over all dimensions of |query weight| times the largest impact left. A
row whose score cannot reach the k-th best lower bound is out, which is a proof, not a guess. Once few
rows are left, or no segment is, the rows left are scored exactly from their whole vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barlake.llm.common import Scratch, ship

#: Rows of an index block and of a query batch, on average: what one task holds at a time.
BLOCK, BATCH = 8192, 1024

#: Tasks of a search at most: beyond, a task has several blocks.
MOST_TASKS = 10_000

_PACKED = "ids binary, matrix binary, dims int"


def scaled(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component; null for vectors that are null or hold null or non-finite
    components. Sizes beyond a long are cut to its range."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(False)), F.transform(wide, lambda x: F.floor(x * scale).cast("bigint")))


def _pack(key: str):
    """Rows of a group as one pair of arrays: ids, and a matrix whose short vectors end in zeros."""

    def work(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        ids = np.array(table["id"].to_pylist(), dtype=np.int64)
        vectors = table["v"].combine_chunks()
        vectors = vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors
        ends = vectors.offsets.to_numpy()
        sizes = np.diff(ends)
        matrix = np.zeros((len(ids), int(sizes.max(initial=0))), np.int64)
        rows = np.repeat(np.arange(len(ids)), sizes)
        flat = vectors.values.to_numpy(zero_copy_only=False)[ends[0]:ends[-1]]
        matrix[rows, np.arange(len(flat)) - np.repeat(ends[:-1] - ends[0], sizes)] = flat
        order = np.argsort(ids, kind="stable")
        yield pa.RecordBatch.from_pydict({
            key: pa.array([group[0].as_py()], pa.int32()), "ids": [ids[order].tobytes()], "matrix": [matrix[order].tobytes()],
            "dims": pa.array([matrix.shape[1]], pa.int32()),
        })

    return work


def _packed(rows: DataFrame, key: str, groups: int) -> DataFrame:
    dealt = rows.withColumn(key, F.pmod(F.xxhash64("id", "v"), F.lit(groups)).cast("int"))
    return dealt.groupBy(key).applyInArrow(_pack(key), f"{key} int, {_PACKED}")


class Segments:
    """Impact-ordered postings of a block: for each quantised impact, from the largest down, the
    postings of all dimensions."""

    def __init__(self, matrix: np.ndarray):
        self.rows, self.dims = matrix.shape
        size = np.abs(matrix)
        # Bit length of the size: 0 for 0, else floor(log2) + 1. Exact on integers.
        self.impact = np.zeros(matrix.shape, np.uint8)
        rest = size.copy()
        while rest.any():
            self.impact[rest > 0] += 1
            rest >>= 1
        self.levels = []
        for impact in np.unique(self.impact[self.impact > 0])[::-1]:
            dims, rows = np.nonzero((self.impact == impact).T)  # ordered by dimension
            self.levels.append((rows, dims, matrix[rows, dims]))
        # After a level, a dimension's largest impact left.
        tops = [size.max(axis=0, initial=0)]
        left = size.copy()
        for rows, dims, _ in self.levels:
            left[rows, dims] = 0
            tops.append(left.max(axis=0, initial=0))
        self.left = tops[1:]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, matrix: np.ndarray, ids: np.ndarray, segments: Segments,
    k: int, few: int = 64,
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query row, candidate ids, scores)``: for each query the best ``k`` of a block, ties included."""
    dims = max(queries.shape[1], matrix.shape[1])
    queries = np.pad(queries, ((0, 0), (0, dims - queries.shape[1])))
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(matrix).max(initial=0)) * max(dims, 1)
    kind = np.float32 if largest < 2**24 else np.float64 if largest < 2**53 else np.int64  # all exact
    weights = queries[:, :segments.dims].astype(kind)
    sizes = np.abs(queries[:, :segments.dims]).astype(np.float64)
    own = np.searchsorted(ids, query_ids, "left"), np.searchsorted(ids, query_ids, "right")
    live = np.arange(len(queries))
    scores = np.zeros((len(queries), segments.rows), kind)

    def best(rows: np.ndarray, query: int) -> tuple[int, np.ndarray, np.ndarray]:
        exact = matrix[rows].astype(kind) @ queries[query, :matrix.shape[1]].astype(kind)
        if len(rows) > k:
            keep = exact >= np.partition(exact, -k)[-k]
            rows, exact = rows[keep], exact[keep]
        return query, ids[rows], exact.astype(np.int64)

    def members(line: np.ndarray, query: int, missing: float) -> np.ndarray:
        """Rows that may be among the best: their upper bound reaches the k-th lower bound."""
        line = line.copy()
        mine = slice(own[0][query], own[1][query])
        if kind is np.int64:
            others = np.delete(np.arange(len(line)), mine)
            if len(others) <= k:
                return others
            kth = np.partition(line[others], -k)[-k]
            return others[line[others].astype(np.float64) + 2 * missing * (1 + 1e-9) + 1e-3 * abs(float(kth)) >= float(kth)]
        line[mine] = -np.inf
        if len(line) > k:
            kth = np.partition(line, -k)[-k]
            return np.flatnonzero((line >= kth - 2 * missing) & (line > -np.inf))
        return np.flatnonzero(line > -np.inf)

    for (rows, at, impacts), left in zip(segments.levels, segments.left):
        if not len(live):
            return
        # All segments of one impact: scattered over (row, dimension), one product adds them for all queries.
        postings = np.zeros((segments.rows, segments.dims), kind)
        postings[rows, at] = impacts
        scores += weights[live] @ postings.T
        missing = sizes[live] @ left.astype(np.float64)
        staying = []
        for i, query in enumerate(live):
            possible = members(scores[i], query, missing[i])
            if len(possible) <= max(few, 4 * k) or missing[i] == 0:
                yield best(possible, query)
            else:
                staying.append(i)
        live, scores = live[staying], scores[staying]
    for i, query in enumerate(live):  # blocks of nothing but zeros
        yield best(members(scores[i], query, 0.0), query)


def _search(k: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: tuple = (None, None, None, None)
        for batch in batches:
            for row in batch.to_pylist():
                if known[0] != row["block"]:
                    matrix = np.frombuffer(row["matrix"], np.int64).reshape(-1, row["dims"])
                    ids = np.frombuffer(row["ids"], np.int64)
                    known = (row["block"], matrix, ids, Segments(matrix))
                _, matrix, ids, segments = known
                queries = np.frombuffer(row["q_matrix"], np.int64).reshape(-1, row["q_dims"])
                query_ids = np.frombuffer(row["q_ids"], np.int64)
                found: tuple[list, list, list] = ([], [], [])
                for query, rows, scores in search_block(queries, query_ids, matrix, ids, segments, k):
                    keep = np.lexsort((rows, -scores))[:k]
                    for out, part in zip(found, (np.full(len(keep), query_ids[query]), rows[keep], scores[keep])):
                        out.append(part)
                if found[0]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x)) for x in found], ["query_id", "vec_id", "score"]
                    )

    return work


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, batch: int = BATCH,
    scale: float = 256.0,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of every query, ties to smaller ids.

    Both inputs have ``vec_id`` and ``embedding``. A query's candidates are all vectors of another id,
    all of them if fewer than ``k``. Rows with a null id or a vector that is null or holds null or
    non-finite components take no part. Of vectors with different lengths the shorter ends in zeros.
    Repeated candidates count each; a query repeated with the same vector is asked once.

    Every block meets every batch in a task that holds one of each, so memory does not grow with the
    input, neither a task's nor the driver's; the result of a pair is ``k`` rows per query, and the best
    of all are ranked by Spark.
    """
    spark = vectors.sparkSession
    ship(spark)
    scratch = Scratch(spark, "topk")

    def usable(frame: DataFrame) -> DataFrame:
        rows = frame.select(F.col("vec_id").cast("bigint").alias("id"), scaled(F.col("embedding"), scale).alias("v"))
        return rows.where("id IS NOT NULL AND v IS NOT NULL")

    candidates, asked = usable(vectors), usable(queries).distinct()
    blocks = max(1, -(-candidates.count() // block))
    groups = max(1, -(-asked.count() // batch))
    index = scratch.save(_packed(candidates, "block", blocks), "index")
    batches = _packed(asked, "batch", groups).select(
        F.col("ids").alias("q_ids"), F.col("matrix").alias("q_matrix"), F.col("dims").alias("q_dims"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
    )
    # Copies of batches are many times as large as Spark estimates from the rows they are packed from, so they are
    # never broadcast. A task has a block on average: by shuffled bytes it would have the work of many. A row is a
    # block and a batch of up to some MB: pairs are handed over one at a time, and the join holds one block.
    tasks = min(blocks, MOST_TASKS)
    laid = batches.repartition(tasks, "block").join(index.repartition(tasks, "block").hint("merge"), "block")
    pairs = laid.select("block", "ids", "matrix", "dims", "q_ids", "q_matrix", "q_dims")
    found = pairs.mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    best = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

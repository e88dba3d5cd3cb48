"""Exact top-k search by inner product, pruned by segment statistics of growing resolution.

A vector is cut into segments; each keeps its mean and its deviation. For two segments of m
components the squared distance is at least m * ((mean - mean')**2 + (dev - dev')**2), so a sum
over segments bounds the distance of the vectors from below, and with their lengths the inner
product from above: (|q|**2 + |x|**2 - distance**2) / 2. One segment gives a coarse bound, more
segments finer ones. Candidates fall out as soon as a bound shows that they cannot reach the k-th
best score; the survivors get the exact inner product.

Queries and candidates meet in a grid of blocks of bounded size. A cell returns its k best per
query, and the best of those follow from a shuffle of k rows per query and cell. Work grows with
queries times rows, as an exact search over a query set that grows with the table must.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from blotterline.llm.common import blocks_for, materialize, parallelism

#: Largest blocks of the grid, and segments per level.
CANDIDATE_BLOCK = 65_536
QUERY_BLOCK = 8_192
LEVELS = (1, 4, 16)
#: Queries whose coarse bounds are held at once.
AT_ONCE = 64


def quantised(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and ``floor(256 * x)`` of each component x, as whole numbers.

    Leaves out vectors that are null or hold a null or a value that is not finite.
    """
    values = F.transform(F.col(embedding), lambda x: x.cast("double"))
    finite = F.forall(values, lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    return (
        vectors.select(F.col(vec_id).cast("long").alias("vec_id"), values.alias("_values"))
        .where(F.col("_values").isNotNull() & finite)
        .select("vec_id", F.transform("_values", lambda x: F.floor(x * 256)).alias("vector"))
    )


def matrix(column: pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if rows else pa.array([], pa.int64())
    return flat.to_numpy(zero_copy_only=False).reshape(rows, -1).astype(np.int64)


def segment_statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each row's segments, scaled so that inner products of these
    rows bound those of ``x`` from above."""
    parts = np.array_split(x, min(segments, max(1, x.shape[1])), axis=1)
    scaled = [(np.sqrt(p.shape[1]), p) for p in parts if p.shape[1]]
    means = [root * p.mean(axis=1) for root, p in scaled]
    deviations = [root * p.std(axis=1) for root, p in scaled]
    return np.stack([*means, *deviations], axis=1) if scaled else np.zeros((len(x), 1))


def best_of(scores: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int) -> np.ndarray:
    """Places of the best rows, ties to smaller ids, until they hold ``k`` rows with copies."""
    order = np.lexsort((ids, -scores))[:k]
    held = np.cumsum(copies[order]) - copies[order]
    return order[held < k]


def search_block(
    queries: np.ndarray, query_ids: np.ndarray, x: np.ndarray, ids: np.ndarray, copies: np.ndarray, k: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per query the places of its best rows in ``x`` and their exact scores."""
    if not len(queries) or not len(x):
        return [(np.zeros(0, int), np.zeros(0, int))] * len(queries)
    dims = x.shape[1]
    most = int(np.abs(queries).max(initial=0)) * int(np.abs(x).max(initial=0)) * max(dims, 1)
    # Whole numbers below 2**53 are exact as doubles; larger ones are added up as Python's.
    kind = np.float64 if most < 2**53 else object
    exact_q, exact_x = queries.astype(kind), x.astype(kind)
    q, y = queries.astype(np.float64), x.astype(np.float64)
    levels = [(segment_statistics(q, n), segment_statistics(y, n)) for n in LEVELS]
    longest = float(np.sqrt((y * y).sum(axis=1)).max())
    slack = 1e-9 * (np.sqrt((q * q).sum(axis=1)) * longest + 1)  # rounding of the bounds
    found = []
    for start in range(0, len(q), AT_ONCE):
        coarse = levels[0][0][start : start + AT_ONCE] @ levels[0][1].T
        for row, bound in enumerate(coarse, start):
            other = ids != query_ids[row]
            # The likeliest rows first: their k-th score is what others have to reach.
            likely = np.argpartition(-bound, min(8 * k, len(bound) - 1))[: 8 * k + 1]
            likely = likely[other[likely]]
            tried = exact_x[likely] @ exact_q[row]
            held = np.sort(np.repeat(tried, np.minimum(copies[likely], k)))[::-1]
            floor = float(held[k - 1]) - slack[row] if len(held) >= k else -np.inf
            left = np.flatnonzero(other & (bound >= floor))
            for of_query, of_rows in levels[1:]:
                left = left[of_rows[left] @ of_query[row] >= floor]
            scores = exact_x[left] @ exact_q[row]
            top = best_of(scores, ids[left], copies[left], k)
            found.append((left[top], scores[top]))
    return found


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` best rows of ``vectors`` for each query: query_id, rank, vec_id, score.

    Both frames are ``quantised``. The score is the integer inner product; ties go to the smaller
    vec_id. Rows with the query's vec_id are the query itself and not its candidates; only
    vectors of the same length are compared. A row that occurs more than once (same vec_id and
    vector) is a candidate as often as it occurs and a query once. Fewer than ``k`` candidates:
    all. No queries or no candidates: no rows. Rows whose vec_id is null take no part. A score that
    does not fit a long is an error.
    """
    spark = vectors.sparkSession
    vectors, queries = (df.where(F.col("vec_id").isNotNull()) for df in (vectors, queries))
    # Copies collapse before anything is shuffled, so a hot row is one row with a count.
    x = materialize(
        vectors.groupBy("vec_id", "vector").agg(F.count(F.lit(1)).alias("copies")), "vectors"
    )
    q = materialize(queries.select("vec_id", "vector").distinct(), "queries")
    rows, asked, tasks = x.count(), q.count(), parallelism(spark)
    blocks = blocks_for(rows, CANDIDATE_BLOCK, tasks)
    query_blocks = blocks_for(asked, QUERY_BLOCK, 1)

    def dealt(df: DataFrame, own: int, across: int, names: tuple[str, str]) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id", "vector"), F.lit(own)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.lit(across - 1)))
        return df.select("*", block.alias(names[0]), F.size("vector").alias("length")).withColumn(names[1], every)

    left = dealt(q.withColumn("query_row", F.xxhash64("vector")), query_blocks, blocks, ("_q", "_x"))
    right = dealt(x, blocks, query_blocks, ("_x", "_q"))
    schema = pa.schema(
        [("query_id", pa.int64()), ("query_row", pa.int64()), ("vec_id", pa.int64()), ("copies", pa.int64()), ("score", pa.int64())]
    )

    def cell(a: pa.Table, b: pa.Table) -> pa.Table:
        query_ids, ids = a["vec_id"].to_numpy(), b["vec_id"].to_numpy()
        copies = b["copies"].to_numpy()
        if not len(query_ids) or not len(ids):
            return schema.empty_table()
        found = search_block(
            matrix(a["vector"], len(query_ids)), query_ids, matrix(b["vector"], len(ids)), ids, copies, k
        )
        counts = [len(places) for places, _ in found]
        places = np.concatenate([p for p, _ in found]).astype(int)
        scores = np.concatenate([np.asarray(s, dtype=object) for _, s in found])
        return pa.table(
            [
                np.repeat(query_ids, counts),
                np.repeat(a["query_row"].to_numpy(), counts),
                ids[places],
                np.minimum(copies[places], k),
                pa.array([int(s) for s in scores], pa.int64()),
            ],
            schema=schema,
        )

    keys = ["_x", "_q", "length"]
    partial = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(cell, "query_id long, query_row long, vec_id long, copies long, score long")
    )
    each = partial.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    order = Window.partitionBy("query_id", "query_row").orderBy(F.desc("score"), "vec_id", "_copy")
    return (
        each.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )

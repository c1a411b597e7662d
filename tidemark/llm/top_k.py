"""Exact top-k inner products by multi-resolution segment statistics.

A vector is cut into equal segments; of each segment the mean and the deviation are kept. For two vectors the sums of
mean products and deviation products bound the inner product from above (the distance from below), the tighter the
finer the segments. Queries meet rows in bounded blocks: the coarse bounds of a block are one matrix product, the best of
them give a first k-th score by exact products, and only rows whose coarse and then finer bounds reach that score are
scored exactly. Nothing is approximate: a row is left out only where its bound is below k scores that are there.

Every row is dealt to one chunk by hash and every query to one block; a task holds one chunk and one block, and hands on
k rows per query. Chunks and blocks follow the number of rows, so tasks stay of one size.

Defined cases: vectors that are null or hold a null or non-finite component take no part; a shorter vector counts as
filled up with zeros, an empty one as zeros; rows without an id take no part; rows that repeat an id with the same
quantised vector count once, with different ones each, as candidates and as queries (their results stand under one query_id);
a row is no candidate for itself alone; fewer candidates than k give fewer rows; an empty table gives none. Components and
scores beyond 64 bits stop at the limits of 64 bits.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from tidemark.llm.storage import saved

#: Rows of a chunk and queries of a block, on average.
CHUNK_ROWS = 16_384
BLOCK_QUERIES = 512
#: Segments per level, coarse to fine.
LEVELS = (4, 16)
_SLACK = 1e-9


def quantised(vectors: DataFrame, id_column: str, vector: str, factor: int) -> DataFrame:
    """(vec_id, q): floor(factor * x) of every component, equal rows once."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull()).filter(~odd)
    q = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), q.alias("q")).distinct()


def matrix(values: pd.Series, width: int) -> np.ndarray:
    """Rows of integers, filled up with zeros."""
    out = np.zeros((len(values), width), np.int64)
    for i, row in enumerate(values):
        out[i, : len(row)] = row
    return out


def statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(length) * mean and the root of the summed squared deviations: products of these bound products."""
    parts = [part for part in np.array_split(x, min(segments, max(1, x.shape[1])), axis=1) if part.shape[1]]
    if not parts:
        return np.zeros((len(x), 1))
    means = [part.mean(1) for part in parts]
    deviations = [np.sqrt(((part - m[:, None]) ** 2).sum(1)) for part, m in zip(parts, means, strict=True)]
    scaled = [m * np.sqrt(part.shape[1]) for part, m in zip(parts, means, strict=True)]
    return np.stack(scaled + deviations, axis=1)


def _products(rows: np.ndarray, query: np.ndarray, small: bool) -> np.ndarray:
    if small:  # every partial sum is a whole number below 2**53
        return (rows @ query).astype(np.int64)
    limits = np.iinfo(np.int64)
    return np.array([min(max(int(v), limits.min), limits.max) for v in rows.astype(object) @ query.astype(object)], np.int64)


def search(
    ids: np.ndarray, rows: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int,
    numbers: np.ndarray | None = None, query_numbers: np.ndarray | None = None,
) -> list[tuple[int, int, int]]:
    """(query, id, score) of the k best rows of each query, ties to the smaller id.

    A row is left out for the query of its own number, which is its id where no numbers are given; queries are
    named by their numbers then.
    """
    numbers = ids if numbers is None else numbers
    query_numbers = query_ids if query_numbers is None else query_numbers
    largest = max(float(np.abs(rows).max(initial=0)), float(np.abs(queries).max(initial=0)))
    small = largest * largest * max(1, rows.shape[1]) < 2.0**53
    x, y = rows.astype(np.float64), queries.astype(np.float64)
    coarse_x, coarse_y = statistics(x, LEVELS[0]), statistics(y, LEVELS[0])
    finer = [(statistics(x, s), statistics(y, s)) for s in LEVELS[1:]]
    slack = _SLACK * np.linalg.norm(y, axis=1) * np.linalg.norm(x, axis=1).max(initial=0) + 1e-6
    exact_x, exact_y = (x, y) if small else (rows, queries)
    found = []
    for low in range(0, len(queries), 64):
        bounds = coarse_x @ coarse_y[low : low + 64].T
        for j in range(low, min(low + 64, len(queries))):
            bound = bounds[:, j - low]
            others = np.flatnonzero(numbers != query_numbers[j])
            if not len(others):
                continue
            if len(others) > 4 * k:
                tops = others[np.argpartition(-bound[others], 4 * k - 1)[: 4 * k]]
                kth = np.sort(_products(exact_x[tops], exact_y[j], small))[-k]
                others = others[bound[others] + slack[j] >= kth]
                for fine_x, fine_y in finer:
                    others = others[fine_x[others] @ fine_y[j] + slack[j] >= kth]
            scores = _products(exact_x[others], exact_y[j], small)
            best = np.lexsort((ids[others], -scores.astype(object) if not small else -scores))[:k]
            found += [(int(query_numbers[j]), int(ids[others[b]]), int(scores[b])) for b in best]
    return found


def _numbers(count: int):
    return F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long"))


def top_k(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", every: int = 100, k: int = 10, factor: int = 1024
) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows of each row whose id is divisible by ``every``."""
    numbered = quantised(vectors, id_column, vector, factor).withColumn("row", F.monotonically_increasing_id())
    rows = saved(numbered, "top-k-rows")  # the numbers of rows stay as they are written
    is_query = F.col("vec_id") % every == 0
    about = rows.agg(F.count("*"), F.sum(F.when(is_query, 1)), F.max(F.size("q"))).head()
    width = about[2] or 0
    chunks, blocks = max(1, -(-about[0] // CHUNK_ROWS)), max(1, -(-(about[1] or 0) // BLOCK_QUERIES))
    chunk = F.pmod(F.xxhash64("row"), F.lit(chunks)).alias("chunk")
    block = F.pmod(F.xxhash64("row", F.lit("query")), F.lit(blocks)).alias("block")
    # A task is one block of queries against one chunk of rows; each side goes to the tasks it takes part in.
    candidates = rows.select("vec_id", "row", "q", chunk, F.explode(_numbers(blocks)).alias("block"))
    queries = rows.filter(is_query).select(
        "vec_id", "row", "q", block, F.explode(_numbers(chunks)).alias("chunk")
    )

    def meet(one: pd.DataFrame, other: pd.DataFrame) -> pd.DataFrame:
        names = ["query_row", "vec_id", "score"]
        if one.empty or other.empty:
            return pd.DataFrame({name: pd.Series([], dtype="int64") for name in names})
        best = search(
            one["vec_id"].to_numpy(), matrix(one["q"], width), other["vec_id"].to_numpy(), matrix(other["q"], width), k,
            one["row"].to_numpy(), other["row"].to_numpy(),
        )
        return pd.DataFrame(best, columns=names).astype("int64")

    keys = "chunk", "block"
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInPandas(
        meet, "query_row long, vec_id long, score long"
    )
    asked = rows.filter(is_query).select(F.col("row").alias("query_row"), F.col("vec_id").alias("query_id"))
    order = Win.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .join(asked, "query_row")
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )

"""Exact top-k search by inner product, term at a time.

Candidates are inverted: each dimension holds the postings (place, weight) of
the vectors in which it is not zero. A query walks its own non-zero dimensions
and scatters weight products into a dense array of scores; a partition step
selects the best, and the best of all tiles are merged.

Both sides are dealt into tiles of bounded size by a hash of their rows, and
every query tile meets every candidate tile once: a stated query set against all
rows, in blocks. A task holds one tile of each side.

Keys that are null and vectors that are null or hold null or non-finite
components take no part. Identical repeated rows count once; an id with several
vectors is one candidate for each of them, and as a query the smallest one.
Missing dimensions count as zero, an empty vector scores 0 everywhere. Ties go
to the smaller id. An empty side gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def whole_weights(vector: Column, scale: float = 1024.0) -> Column:
    """Components as whole numbers: floor(scale * x); null where the vector takes no part."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(ok, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")))


def _matrix(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, dimension and weight of all components that are not zero."""
    lists = column.combine_chunks()
    sizes = np.asarray(lists.value_lengths().to_numpy(zero_copy_only=False), np.int64)
    values = lists.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(sizes)), sizes)
    term = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    some = values != 0
    return row[some], term[some], values[some]


def _distinct(table: pa.Table) -> pa.Table:
    """Rows in the order of their ids, identical ones once."""
    seen, keep = set(), []
    for i in np.argsort(table["id"].to_numpy(), kind="stable").tolist():
        row = table["id"][i].as_py(), tuple(table["w"][i].as_py())
        if row not in seen:
            seen.add(row)
            keep.append(i)
    return table.take(pa.array(keep, pa.int64()))


def _search(k: int):
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if left.num_rows and right.num_rows:
            candidates = _distinct(left)
            ids = candidates["id"].to_numpy()
            row, term, weight = _matrix(candidates["w"])
            order = np.argsort(term, kind="stable")
            row, term, weight = row[order], term[order], weight[order]
            q_row, q_term, q_weight = _matrix(right["w"])
            size = 1 + max(term.max(initial=-1), q_term.max(initial=-1))
            postings = np.searchsorted(term, np.arange(size + 1))
            bounds = np.searchsorted(q_row, np.arange(right.num_rows + 1))
            for q, own in enumerate(right["id"].to_pylist()):
                scores = np.zeros(len(ids), np.int64)
                for at in range(bounds[q], bounds[q + 1]):
                    a, b = postings[q_term[at]], postings[q_term[at] + 1]
                    scores[row[a:b]] += weight[a:b] * q_weight[at]
                free = np.flatnonzero(ids != own)
                mine = scores[free]
                if len(mine) > k:
                    least = np.partition(mine, len(mine) - k)[len(mine) - k]
                    above = np.flatnonzero(mine > least)
                    # ids ascend, so the first ties are those of the smaller ids
                    best = np.concatenate([above, np.flatnonzero(mine == least)[: k - len(above)]])
                else:
                    best = np.arange(len(mine))
                out["query_id"].append(np.full(len(best), own))
                out["vec_id"].append(ids[free[best]])
                out["score"].append(mine[best])
        return pa.table({n: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for n, v in out.items()})

    return search


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", weights: str = "weights",
    tile: int = 8192, query_tile: int = 1024,
) -> DataFrame:
    """query_id, rank, vec_id and score of each query's ``k`` best candidates but its own id.

    ``weights`` is an array of whole numbers in both tables.
    """
    rows = lambda df: df.select(F.col(key).cast("long").alias("id"), F.col(weights).alias("w")).dropna()
    left = rows(candidates)
    right = rows(queries).groupBy("id").agg(F.min("w").alias("w"))
    n_left, n_right = (max(1, -(-df.count() // size)) for df, size in ((left, tile), (right, query_tile)))
    deal = lambda n: F.pmod(F.xxhash64("id", "w"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.select(deal(n_left).alias("a"), every(n_right).alias("b"), "id", "w")
    right = right.select(every(n_left).alias("a"), deal(n_right).alias("b"), "id", "w")
    found = left.groupBy("a", "b").cogroup(right.groupBy("a", "b")).applyInArrow(
        _search(k), "query_id long, vec_id long, score long"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )

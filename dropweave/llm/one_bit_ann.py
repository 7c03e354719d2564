"""Nearest neighbours by randomly rotated one-bit codes.

A vector less the centre of the data is rotated at random and kept as one bit per axis with two numbers: its length and the
inner product of its direction with its own code.  From these the inner product with a query is estimated
without bias, with an error that stays under ``error_width`` / sqrt(bits - 1) times known lengths but for a chance that
falls off like a normal tail.  Only vectors whose upper bound reaches the query's present k-th best are looked up and scored exactly.
Codes may have more bits than the vector has axes (``BITS_PER_AXIS``), as a rotation in a larger space.

Queries meet all rows in tiles: rows and queries are dealt by the hash of their id to blocks of about ``ROWS`` and
``QUERIES``, a tile is a pair of blocks, and a task holds one tile.  A tile returns its k best per query; the k best of all tiles
are the result.  More rows mean more tiles, not larger ones.

The centre is the mean of all vectors, added up by axis.  Scores are exact: products and sums in double precision, axis by axis.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dropweave.session import stage

BITS_PER_AXIS = 4
ERROR_WIDTH = 3.5
ROWS = 3072
QUERIES = 4096
STEP = 512


def usable(vector: str) -> Column:
    """Not null, with a component that is not zero and none that is null or not finite."""
    v = F.col(vector)
    return (v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
            & F.exists(v, lambda x: x != 0))


def prepare(rows: DataFrame, id_column: str, vector: str) -> DataFrame:
    """``(vec_id, row, vector)`` staged: all usable vectors with an id.  ``row`` tells rows apart that share an id.

    Rows with a null id take no part.
    """
    rows = rows.filter(F.col(id_column).isNotNull() & usable(vector)).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")


class Coder:
    """The rotation and the centre; as large as a few hundred vectors, whatever the table."""

    def __init__(self, centre: np.ndarray, bits_per_axis: int = BITS_PER_AXIS, seed: int = 20_240) -> None:
        self.centre = centre
        self.bits = 64 * ceil(bits_per_axis * len(centre) / 64)
        gauss = np.random.default_rng(seed).standard_normal((self.bits, len(centre)))
        self.rotation = np.linalg.qr(gauss)[0]  # columns of a random rotation: axes of the vectors in the larger space

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Packed bits, length of the rest and inner product of its direction with its code."""
        rest = vectors - self.centre
        length = np.linalg.norm(rest, axis=1)
        turned = rest @ self.rotation.T
        with np.errstate(invalid="ignore", divide="ignore"):
            own = np.abs(turned).sum(1) / (length * np.sqrt(self.bits))
        return np.packbits(turned > 0, axis=1), length, np.where(length > 0, own, 1.0)

    def sides(self, queries: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray, width: float,
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Two matrices and what to add to a row of their product: with the last column the product is the upper bound of
        the inner products (a row per query, a column per code), without it their estimate."""
        signs = np.unpackbits(codes, axis=1).astype(np.float32)
        signs *= 2
        signs -= 1
        norm = np.linalg.norm(queries, axis=1)
        scale = length / (own * np.sqrt(self.bits))
        error = length * np.sqrt(np.maximum(1 / own**2 - 1, 0)) * width / np.sqrt(self.bits - 1) + 1e-4 * length  # the last: rounding
        left = np.hstack([queries @ self.rotation.T, norm[:, None]]).astype(np.float32)
        right = np.hstack([signs * scale[:, None], error[:, None]]).astype(np.float32)
        slack = 1e-4 * norm * (np.linalg.norm(self.centre) + 1)
        return left, right, queries @ self.centre + slack

    def bounds(self, queries: np.ndarray, codes: np.ndarray, length: np.ndarray, own: np.ndarray,
               width: float) -> tuple[np.ndarray, np.ndarray]:
        """Estimates and upper bounds of the inner products."""
        left, right, rest = self.sides(queries, codes, length, own, width)
        return left[:, :-1] @ right[:, :-1].T + rest[:, None], left @ right.T + rest[:, None]


def exact(queries: np.ndarray, vectors: np.ndarray, row: np.ndarray, column: np.ndarray) -> np.ndarray:
    """Inner products of pairs, one axis after the other, so equal vectors get equal scores.

    Both tables hold an axis in a row, so that the values of an axis stay in the cache.
    """
    total = np.zeros(len(row))
    for a, b in zip(queries, vectors):
        total += a[row] * b[column]
    return total


def best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best rows of each query, by score, then the smaller id."""
    order = np.lexsort((ids, -score, query))
    place = np.arange(len(order)) - np.searchsorted(query[order], query[order], "left")
    return order[place < k]


def search_tile(coder: Coder, query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray,
                codes: np.ndarray, length: np.ndarray, own: np.ndarray, k: int, width: float,
                ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(query place, vec_id, score)`` of each query's k best rows of a tile."""
    q, found, score = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    reach = np.full(len(queries), -np.inf)
    by_axis = np.ascontiguousarray(queries.T)
    for begin in range(0, len(ids), STEP):
        part = slice(begin, begin + STEP)
        here, axes = ids[part], np.ascontiguousarray(vectors[part].T)
        # A query's own rows: ids ascend, and several rows may share one.
        low, high = np.searchsorted(here, query_ids), np.searchsorted(here, query_ids, "right")
        own_row = np.repeat(np.arange(len(query_ids)), high - low)
        own_place = np.arange(len(own_row)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + np.repeat(low, high - low)
        with np.errstate(invalid="ignore", over="ignore"):
            left, right, rest = coder.sides(queries, codes[part], length[part], own[part], width)
            upper = left @ right.T
        upper[own_row, own_place] = -np.inf
        if begin == 0 and len(here) > k + 1:
            # A first k-th best: score the rows with the k best estimates among the first rows.
            estimate = left[:, :-1] @ right[:, :-1].T
            estimate[own_row, own_place] = -np.inf
            top = np.argpartition(-estimate, k, axis=1)[:, :k]
            scores = exact(by_axis, axes, np.repeat(np.arange(len(queries)), k), top.ravel()).reshape(-1, k)
            scores[here[top] == query_ids[:, None]] = -np.inf
            reach = scores.min(1)
        # What is not a number cannot be ruled out; reach loses what rounding to single precision may add.
        limit = (reach - rest - 1e-6 * np.abs(np.where(np.isfinite(reach), reach, 0))).astype(np.float32)
        wanted = ~(upper < limit[:, None])
        wanted[own_row, own_place] = False
        row, column = np.nonzero(wanted)
        scores = np.concatenate([exact(by_axis, axes, row[i:i + 65536], column[i:i + 65536])
                                 for i in range(0, len(row), 65536)] or [np.zeros(0)])
        passing = scores >= reach[row]
        q = np.concatenate([q, row[passing]])
        found = np.concatenate([found, here[column[passing]]])
        score = np.concatenate([score, scores[passing]])
        kept = best(q, found, score, k)
        q, found, score = q[kept], found[kept], score[kept]
        full = np.bincount(q, minlength=len(queries)) >= k
        lowest = np.full(len(queries), np.inf)
        np.minimum.at(lowest, q, score)
        reach = np.where(full, np.maximum(reach, lowest), reach)
    return q, found, score


def search(vectors: DataFrame, queries: DataFrame, k: int, width: float = ERROR_WIDTH, rows: int = ROWS,
           query_rows: int = QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query row the k rows found with the largest inner product, but none with its own id.

    Both tables are as ``prepare`` gives them.  Vectors of each length are searched apart, as there is no product of two lengths.  Rows that
    share an id are candidates of their own, and queries of their own.  Empty tables give no rows.
    """
    lengths = [r.axes for r in vectors.groupBy(F.size("vector").alias("axes")).count().orderBy("axes").collect()]  # a handful of models
    if "row" not in vectors.columns:
        vectors, queries = (t.withColumn("row", F.col("vec_id")) for t in (vectors, queries))
    parts = [_search(*(t.filter(F.size("vector") == axes) for t in (vectors, queries)), k, width, rows, query_rows) for axes in lengths or [1]]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return reduce(DataFrame.union, parts).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(vectors: DataFrame, queries: DataFrame, k: int, width: float, rows: int, query_rows: int) -> DataFrame:
    """``(query_id, vec_id, score)`` of the k best rows of every query row in every tile, for vectors of one length."""
    spark = vectors.sparkSession
    n_rows, n_queries = vectors.count(), queries.count()
    sums = (vectors.select(F.posexplode("vector").alias("axis", "x")).groupBy("axis").agg(F.avg("x").alias("mean"))
            .orderBy("axis").collect())  # a row per axis
    coder = Coder(np.array([s.mean for s in sums] or [0.0]))
    sent = spark.sparkContext.broadcast(coder)
    row_blocks, query_blocks = max(1, ceil(n_rows / rows)), max(1, ceil(n_queries / query_rows))

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            codes, length, own = sent.value.encode(np.stack(batch["vector"].to_numpy())) if len(batch) else ([], [], [])
            yield batch.assign(code=[c.tobytes() for c in codes], length=length, own=own)

    coded = vectors.select("vec_id", "vector", "row").mapInPandas(
        encode, "vec_id long, vector array<double>, row long, code binary, length double, own double")
    tiled_rows = coded.withColumn("row_block", F.pmod(F.xxhash64("row"), F.lit(row_blocks)).cast("int")).withColumn(
        "query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    tiled_queries = queries.withColumn("query_block", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")).withColumn(
        "row_block", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))

    def tile(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or held.empty:
            return pd.DataFrame({"query_id": np.zeros(0, np.int64), "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        held = held.sort_values("vec_id")
        ids = asked["vec_id"].to_numpy()
        q, found, score = search_tile(
            sent.value, ids, np.stack(asked["vector"].to_numpy()), held["vec_id"].to_numpy(), np.stack(held["vector"].to_numpy()),
            np.stack([np.frombuffer(c, np.uint8) for c in held["code"]]), held["length"].to_numpy(), held["own"].to_numpy(), k, width)
        return pd.DataFrame({"query_id": ids[q], "vec_id": found, "score": score})

    return tiled_queries.groupBy("row_block", "query_block").cogroup(tiled_rows.groupBy("row_block", "query_block")).applyInPandas(
        tile, "query_id long, vec_id long, score double")

"""Approximate nearest neighbours by collision counting over single projections.

Vectors are dealt into blocks. A block keeps, for each random direction, the projections of its
vectors in sorted order. A query opens a window around its own projection in each array and
widens all of them together (virtual rehashing); a vector inside enough windows is verified by its
true distance. A query is done with a block once its ``k``-th best verified distance is within the
current radius, or every vector of the block has been verified. Blocks give their ``k`` best.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from urbanflux.llm.common import ship_package

PROJECTIONS = 64
#: Window width in units of the radius, and the share of windows a vector must be in.
WIDTH, SHARE = 2.719, 0.66
GROWTH = 1.25
BLOCK_ROWS, BLOCK_QUERIES = 8_192, 512


@lru_cache(maxsize=8)
def directions(dimension: int, count: int) -> np.ndarray:
    """The same random directions in every task."""
    return np.random.default_rng(20_240_229 + dimension).standard_normal((dimension, count))


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; where squares leave its range, of vectors brought into it first."""
    with np.errstate(over="ignore"):
        found = np.sqrt(np.square(vectors - query).sum(axis=1))
    beyond = np.flatnonzero(~np.isfinite(found) | (found < 1e-140))
    if len(beyond):
        scale = np.maximum(np.abs(vectors[beyond]).max(axis=1), np.abs(query).max())
        apart = vectors[beyond] / scale[:, None] - query / scale[:, None]
        unit = np.abs(apart).max(axis=1)
        share = apart / np.where(unit > 0, unit, 1)[:, None]
        with np.errstate(over="ignore"):
            found[beyond] = np.sqrt(np.square(share).sum(axis=1)) * unit * scale
    return found


class Block:
    """Sorted projections of some vectors of equal dimension, in units of their largest component."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, projections: int = PROJECTIONS):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        self.axes = directions(vectors.shape[1], projections)
        self.scale = float(np.abs(vectors).max())
        values = (self.vectors / self.scale) @ self.axes
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values.T, self.order, axis=1)
        spread = values.std(axis=0).mean() if len(ids) > 1 else 0.0
        self.radius = max(spread * 0.2, 1e-6)

    def nearest(self, own: int, query: np.ndarray, k: int) -> list[tuple[float, int]]:
        """The ``k`` best found: distance and id, nearest first, ties by id; not the query's own."""
        n, m = len(self.ids), len(self.order)
        counts = np.zeros(n, np.int32)
        checked = self.ids == own
        left = checked.sum()
        with np.errstate(over="ignore", invalid="ignore"):
            at = (query / self.scale) @ self.axes
        if not np.isfinite(at).all():  # so far off that no window can be opened around it
            return self._verified(np.flatnonzero(~checked), query, k, [])
        low = np.array([np.searchsorted(row, x) for row, x in zip(self.sorted, at, strict=True)])
        high = low.copy()
        best: list[tuple[float, int]] = []
        radius, needed = self.radius, math.ceil(SHARE * m)
        while left < n:
            half = radius * WIDTH / 2
            if not math.isfinite(half):
                return self._verified(np.flatnonzero(~checked), query, k, best)
            met = []
            for i in range(m):
                a = np.searchsorted(self.sorted[i], at[i] - half, "left")
                b = np.searchsorted(self.sorted[i], at[i] + half, "right")
                if a < low[i]:
                    met.append(self.order[i, a : low[i]])
                    low[i] = a
                if b > high[i]:
                    met.append(self.order[i, high[i] : b])
                    high[i] = b
            if met:
                counts += np.bincount(np.concatenate(met), minlength=n).astype(np.int32)
                new = np.flatnonzero((counts >= needed) & ~checked)
                if len(new):
                    checked[new] = True
                    left += len(new)
                    best = self._verified(new, query, k, best)
            if len(best) == k and best[-1][0] / self.scale <= radius:
                break
            radius *= GROWTH
        return best

    def _verified(self, new: np.ndarray, query: np.ndarray, k: int, best: list[tuple[float, int]]) -> list[tuple[float, int]]:
        """The ``k`` best of those so far and of more vectors, by true distance."""
        distance = distances(self.vectors[new], query)
        if len(new) > k:
            chosen = np.lexsort((self.ids[new], distance))[:k]
            new, distance = new[chosen], distance[chosen]
        return sorted(best + list(zip(distance.tolist(), self.ids[new].tolist(), strict=True)))[:k]


def search_block(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Queries (left) against the vectors of one block (right); only equal dimensions are compared."""
    found = []
    if len(left) and len(right):
        left_size, right_size = left["vec"].map(len), right["vec"].map(len)
        for dimension in sorted(set(left_size) & set(right_size)):
            rows = right[right_size == dimension].drop_duplicates("id")
            block = Block(rows["id"].to_numpy(), np.stack(rows["vec"].to_list()).astype(np.float64))
            own = left[left_size == dimension].drop_duplicates("id")
            for number, vector in zip(own["id"], own["vec"], strict=True):
                best = block.nearest(number, np.asarray(vector, np.float64), k)
                found += [(number, other, distance) for distance, other in best]
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])


def usable(vector: Column) -> Column:
    """Neither null nor zero nor holding null or non-finite components."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest_neighbours(
    df: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for rows with ``is_query`` the ``k`` nearest others found.

    Distances are Euclidean in double precision on the vectors as given, also where squares would leave its
    range; ties go to the smaller id.
    Null ids and vectors that are null, empty, zero or hold null or non-finite components take
    no part; vectors of another dimension than the query are no candidates. Of repeated ids
    in a block one row counts (the one with the smallest vector). Fewer candidates than ``k`` give all of them.
    """
    ship_package(df.sparkSession)
    rows = df.where(F.col(key).isNotNull() & usable(F.col(vector))).select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"), is_query.alias("asks")
    )
    rows = rows.groupBy("id").agg(F.min("vec").alias("vec"), F.max("asks").alias("asks"))
    size = df.agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, asking = max(1, math.ceil(size["n"] / BLOCK_ROWS)), max(1, math.ceil(size["q"] / BLOCK_QUERIES))
    place = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    stored = rows.select("id", "vec", place(blocks, 1).alias("block"), every(asking).alias("part"))
    asked = rows.where("asks").select("id", "vec", place(asking, 2).alias("part"), every(blocks).alias("block"))
    found = asked.groupBy("block", "part").cogroup(stored.groupBy("block", "part"))
    found = found.applyInPandas(lambda a, b: search_block(a, b, k), "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")

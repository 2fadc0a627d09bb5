"""Approximate nearest neighbours by counting collisions of one-line projections."""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larchfield.llm.common import materialise

PROJECTIONS = 96
COLLISION_SHARE = 0.6
VERIFIED_SHARE = 0.2
FIRST_WINDOW = 0.9
RATIO = 1.12
BLOCK = 8192
QUERY_BLOCK = 4096


class CollisionIndex:
    """Projections of one block of vectors, each sorted on its own.

    ``place`` holds every vector's place in each sorted array. A query's window
    on every line begins narrow, centred on the query, and widens by a constant
    ratio (virtual rehashing). A window is a range of places, found by binary
    search. A vector whose places lie in the windows of at least
    ``COLLISION_SHARE`` of the lines is a candidate. Widening ends when ``want`` plus ``VERIFIED_SHARE`` of
    the block are candidates, or the windows hold the whole block.
    """

    def __init__(self, projected: np.ndarray) -> None:
        self.size, self.lines = projected.shape
        order = np.argsort(projected, axis=0, kind="stable")
        self.sorted = np.take_along_axis(projected, order, axis=0).T.copy()
        self.place = np.empty((self.lines, self.size), np.uint16)
        np.put_along_axis(self.place, order.T, np.arange(self.size, dtype=np.uint16)[None], axis=1)
        spread = float(np.median(projected.std(axis=0)))
        self.first = FIRST_WINDOW * max(spread, 1e-12)

    def windows(self, points: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last place in each line's window, for all queries at a level."""
        half = self.first * RATIO**level
        low = [np.searchsorted(s, p - half, "left") for s, p in zip(self.sorted, points.T, strict=True)]
        high = [np.searchsorted(s, p + half, "right") for s, p in zip(self.sorted, points.T, strict=True)]
        return np.array(low).T, np.array(high).T

    def candidates(self, points: np.ndarray, want: int) -> Iterator[np.ndarray]:
        """For each query the vectors that collide often enough."""
        need = max(1, int(np.ceil(COLLISION_SHARE * self.lines)))
        enough = min(self.size, want + int(VERIFIED_SHARE * self.size))
        offset, inside = np.empty_like(self.place), np.empty(self.place.shape, bool)
        for begin in range(0, len(points), 512):
            part = points[begin : begin + 512]
            levels: list[tuple[np.ndarray, np.ndarray]] = []
            for row in range(len(part)):
                level, found = 0, None
                while found is None:
                    if level == len(levels):
                        levels.append(self.windows(part, level))
                    left, right = levels[level][0][row], levels[level][1][row]
                    # Places before the window wrap round to large numbers.
                    np.subtract(self.place, left[:, None].astype(np.uint16), out=offset)
                    np.less(offset, (right - left)[:, None].astype(np.uint16), out=inside)
                    counts = np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8)
                    hit = np.flatnonzero(counts >= need)
                    if len(hit) >= enough or (not left.any() and (right == self.size).all()):
                        found = hit
                    level += 1
                yield found


def usable(vectors: DataFrame) -> DataFrame:
    """Vectors that take part: id, components as doubles, and squared length.

    Left out are null ids, vectors that are null, empty, zero or hold a null or
    non-finite component, and those of another dimension than most vectors have.
    Of rows with one id the least vector stays.
    """
    value = F.col("embedding").cast("array<double>")
    good = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), value.alias("v"), good.alias("good"))
        .where("vec_id is not null and good")
        .withColumn("sq", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
        .where("sq > 0")
        .groupBy("vec_id")
        .agg(F.min_by(F.struct("v", "sq"), F.col("v")).alias("x"))
        .select("vec_id", "x.v", "x.sq")
    )
    rows = materialise(rows, "vectors")
    common = (
        rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    )
    return rows.where(F.size("v") == (common["dim"] if common else 0))


def search(vectors: DataFrame, every: int = 20, k: int = 20, seed: int = 11) -> DataFrame:
    """The ``k`` candidates of largest inner product for each query row.

    Queries are the rows whose vec_id is divisible by ``every``; candidates are
    all other rows. Vectors get one more component that makes all lengths equal,
    so that the largest inner product is the least distance. Queries and vectors
    meet in a grid of blocks: each cell indexes its vectors, verifies candidates
    by exact inner products in double precision and returns ``k`` rows a query;
    the best of all cells stay. Ties go to the smaller vec_id.

    Returns query_id, rank (from 1), vec_id, score. Which vectors take part is
    said in ``usable``. With fewer than ``k`` candidates all are returned; an
    empty table gives no rows; other columns are ignored.
    """
    rows = usable(vectors)
    facts = rows.agg(F.count("*").alias("n"), F.max("sq").alias("top"), F.max(F.size("v")).alias("d")).first()
    count, top, dim = facts["n"] or 0, facts["top"] or 1.0, facts["d"] or 1
    lines = np.random.default_rng(seed).standard_normal((dim + 1, PROJECTIONS))
    blocks = max(1, -(-count // BLOCK))
    query_blocks = max(1, -(-(count // every + 1) // QUERY_BLOCK))
    cell_of = lambda salt, n: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    across = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    candidates = rows.select("vec_id", "v", "sq", cell_of(1, blocks).alias("vb"), across(query_blocks).alias("qb"))
    queries = rows.where(F.col("vec_id") % every == 0).select(
        "vec_id", "v", "sq", cell_of(2, query_blocks).alias("qb"), across(blocks).alias("vb")
    )

    def cell(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )
        if not len(left) or not len(right):
            return empty
        order = np.argsort(left["vec_id"].to_numpy(), kind="stable")
        ids = left["vec_id"].to_numpy()[order]
        data = np.stack(left["v"].to_numpy()[order])
        rest = np.sqrt(np.maximum(top - left["sq"].to_numpy()[order], 0.0))
        index = CollisionIndex(data @ lines[:-1] + rest[:, None] * lines[-1])
        asked, points = right["vec_id"].to_numpy(), np.stack(right["v"].to_numpy())
        # A query is as long as the vectors, so that scale does not matter.
        scaled = points * np.sqrt(top / right["sq"].to_numpy())[:, None]
        projected = scaled @ lines[:-1]
        out = []
        for q, point, found in zip(asked, points, index.candidates(projected, k + 1), strict=True):
            found = found[ids[found] != q]
            scores = data[found] @ point
            best = np.lexsort((ids[found], -scores))[:k]
            out.append(pd.DataFrame({"query_id": q, "vec_id": ids[found][best], "score": scores[best]}))
        return pd.concat(out, ignore_index=True)

    near = (
        candidates.groupBy("vb", "qb")
        .cogroup(queries.groupBy("vb", "qb"))
        .applyInPandas(cell, "query_id long, vec_id long, score double")
    )
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )



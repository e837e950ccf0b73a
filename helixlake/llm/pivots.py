"""Exact top-k inner products by pivot-table elimination.

Components are scaled and floored to whole numbers (within the range of long). The distances of every vector to the pivots are computed
once; by the triangle inequality each gives a lower bound of the distance between a query and a vector, their maximum the best one, and
with the norms an upper bound of the inner product. Vectors are evaluated in the order of their bounds until the next
bound is below the k-th score so far, so the result is exact.

Three stages eliminate. A query's k-th score among the pivots' sample is a floor that what it is looking for must reach; cells (vectors
by their nearest pivot) whose range of pivot distances excludes that aren't visited; within a block of a cell, bounds by a few pivots
after another leave ever fewer vectors, of which those of the best bound are evaluated first.

Vectors that are null or hold null or non-finite components take no part. A query meets vectors of its own length only (all inner products of
vectors without components are 0). Rows that repeat a vec_id are candidates each, and one query (the least vector); a query's own rows
are told by their id. Of equal vectors no more than k + 1 ids are kept, and no more than k + 1 rows of an id and a vector: none
further can be among k nearest. Scores beyond the range of long are its end. Fewer candidates than asked for are all returned. An
empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_sample, by_block, materialise, small

#: Pivots; vectors that they and a query's first floor are chosen from, and most components of these together.
PIVOTS, SAMPLE, SAMPLE_VALUES = 64, 4_000, 4_000_000
#: Cells that vectors are dealt to, by the nearest of the first pivots. Vectors of a block of a cell: what one task holds at a time.
CELLS, BLOCK = 16, 50_000
#: Queries whose bounds are taken together.
STEP = 32
K, EVERY, SCALE = 5, 50, 256
_LONG = 2**63 - 1


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id long, ints array<long>: the rows that take part, scaled and floored."""
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    sound = rows.where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return sound.select("vec_id", F.transform("e", lambda x: F.floor(x * F.lit(float(scale)))).alias("ints"))


def distinct_vectors(rows: DataFrame, k: int = K) -> DataFrame:
    """ints, ids array<struct(vec_id, copies)>: of each distinct vector the k + 1 smallest ids, copies no more than k + 1.

    Ids are ranked where they are before they meet (a limit by group), so a vector that many rows repeat is a few rows a task.
    """
    rows = rows.groupBy("ints", "vec_id").agg(F.least(F.count(F.lit(1)), F.lit(k + 1)).cast("int").alias("copies"))
    rows = rows.withColumn("place", F.row_number().over(W.partitionBy("ints").orderBy("vec_id"))).where(F.col("place") <= k + 1)
    return rows.groupBy("ints").agg(F.sort_array(F.collect_list(F.struct("vec_id", "copies"))).alias("ids"))


# --- bounds --------------------------------------------------------------------------------------------------------------------


def resized(points: np.ndarray, size: int) -> np.ndarray:
    """Points cut or filled up with zeros to `size` components: for vectors of another length the pivots are other points, and pivots all the same."""
    return points[:, :size] if points.shape[1] >= size else np.pad(points, ((0, 0), (0, size - points.shape[1])))


def choose(sample: np.ndarray, most: int = PIVOTS) -> np.ndarray:
    """Pivots far from one another: each is the vector of the sample whose nearest pivot so far is furthest.

    Of vectors within four times the median norm: distances to a pivot far off all would be coarse, and all alike.
    """
    norms = np.linalg.norm(sample, axis=1)
    sample = sample[norms <= 4 * np.median(norms)]
    at, near, chosen = 0, np.full(len(sample), np.inf), []
    while len(chosen) < min(most, len(sample)):
        chosen.append(at)
        near = np.minimum(near, np.linalg.norm(sample - sample[at], axis=1))
        at = int(near.argmax())
    return sample[chosen]


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    p = resized(pivots, x.shape[1])
    return np.stack([np.linalg.norm(x - row, axis=1) for row in p], axis=1).astype(np.float32)


def ceiling(lower: np.ndarray, own: np.ndarray, norms: np.ndarray, reach: float) -> np.ndarray:
    """Upper bounds of inner products from lower bounds of distances and the norms.

    reach: the largest norm of a pivot. Pivot distances are of single precision, so a lower bound may be too large by a few
    ten-millionths of both vectors' norms and the pivots'; that is taken off.
    """
    scale = own + norms + 2 * reach
    lower = np.maximum(lower - 4e-7 * scale, 0)
    return (own * own + norms * norms - lower * lower) / 2 + 1e-9 * scale * scale


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in Python's whole numbers, kept within long: for those that floating point doesn't have exactly."""
    one = [int(v) for v in q]
    return np.array([max(-_LONG - 1, min(_LONG, sum(int(a) * b for a, b in zip(row, one, strict=True)))) for row in x], dtype=object)


class Block:
    """Vectors of one length with their pivot table."""

    def __init__(self, ints: np.ndarray, table: np.ndarray, ids: list, reach: float):
        self.ints, self.ids, self.reach = ints, ids, reach
        self.columns = np.ascontiguousarray(table.T)
        self.x = ints.astype(float)
        self.norms = np.linalg.norm(self.x, axis=1)
        self.most = float(np.abs(self.x).max(initial=0))
        self.rows: dict[int, list[int]] = {}
        for i, own in enumerate(ids):
            for one in own:
                self.rows.setdefault(one["vec_id"], []).append(i)

    def bounds(self, q: np.ndarray, t: np.ndarray) -> np.ndarray:
        """Of each query with each vector: from the greatest lower bound that any pivot gives of their distance."""
        lower = np.zeros((len(q), len(self.x)), np.float32)
        apart = np.empty_like(lower)
        for column, own in zip(self.columns, t.T, strict=True):
            np.subtract(column[None, :], own[:, None], out=apart)
            np.maximum(lower, np.abs(apart, out=apart), out=lower)
        return ceiling(lower, np.linalg.norm(q.astype(float), axis=1)[:, None], self.norms[None, :], self.reach)

    def best(self, ids: list[int], q: np.ndarray, t: np.ndarray, least: np.ndarray, k: int) -> Iterator[tuple[int, list[tuple[int, int]], int]]:
        """Of each query its id, (score, vec_id) of the k best that reach its `least`, and how many vectors were evaluated."""
        for i in range(0, len(q), STEP):
            part = slice(i, i + STEP)
            for query, row, bound, floor in zip(ids[part], q[part], self.bounds(q[part], t[part]), least[part], strict=True):
                yield query, *self._evaluated(query, row, bound, floor, k)

    def _evaluated(self, query: int, q: np.ndarray, bound: np.ndarray, least: float, k: int) -> tuple[list[tuple[int, int]], int]:
        alive = np.flatnonzero(bound >= least)
        alive = alive[np.argsort(-bound[alive], kind="stable")]
        best: list[tuple[int, int]] = []
        own, at, step = q.astype(float), 0, 64
        exact = self.most * float(np.abs(own).max(initial=0)) * max(1, len(q)) < 2**53
        while at < len(alive) and bound[alive[at]] >= least:
            rows = alive[at : at + step]
            scores = self.x[rows] @ own if exact else products(self.ints[rows], q)
            enough = np.flatnonzero(scores >= least)
            if exact and len(enough) > 8 * k:  # those of the k largest scores, with all ties; vectors that have the query's id too are looked at besides
                owned = np.isin(rows[enough], self.rows.get(query, []))
                others = scores[enough[~owned]]
                enough = enough[owned | (scores[enough] >= (np.partition(others, -k)[-k] if len(others) >= k else -np.inf))]
            for score, row in zip(scores[enough].tolist(), rows[enough].tolist(), strict=True):
                best += [(int(score), one["vec_id"]) for one in self.ids[row] if one["vec_id"] != query for _ in range(min(k, one["copies"]))]
            if len(enough):
                best = sorted(best, key=lambda b: (-b[0], b[1]))[:k]
                if len(best) == k:
                    least = max(least, best[-1][0])
            at, step = at + step, step * 2
        return best, min(at, len(alive))


# --- the search ----------------------------------------------------------------------------------------------------------------


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.int64) for v in column])


def _by_size(frame: pd.DataFrame) -> Iterator[tuple[pd.DataFrame, np.ndarray]]:
    for _, part in frame.groupby(frame["ints"].map(len), sort=False):
        yield part, _matrix(part["ints"])


def _floors(ids: np.ndarray, q: np.ndarray, model: dict, k: int) -> np.ndarray:
    """What each query's k-th score is at least: that among the sample's vectors without the query's id, each counted once."""
    scores = q.astype(float) @ model["sample"].T
    for i, query in enumerate(ids):
        scores[i, model["rows"].get(query, [])] = -np.inf
    if scores.shape[1] < k:
        return np.full(len(q), -np.inf)
    floors = np.partition(scores, -k, axis=1)[:, -k]
    # Sums that floating point doesn't have exactly may be too large by their rounding.
    most = float(np.abs(model["sample"]).max(initial=0)) * np.abs(q.astype(float)).max(axis=1, initial=0) * max(1, q.shape[1])
    return floors - np.where(most < 2**53, 0, 1e-12 * most * max(1, q.shape[1]))


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of every row whose vec_id is divisible by `every`.

    A block is held once a round, and queries pass by it as a stream. In the first round a query visits one block of the cell
    of its best bound, in the second all other blocks of the cells whose bound reaches its k-th score so far.
    """
    spark = vectors.sparkSession
    rows = materialise(whole(vectors), "pivot-whole")
    points = materialise(distinct_vectors(rows, k), "pivot-vectors")
    size = points.groupBy(F.size("ints").alias("size")).count().orderBy(F.col("count").desc(), "size").first()
    out = "query_id long, rank int, vec_id long, score long"
    if size is None:
        return spark.createDataFrame([], out)
    size = size["size"]
    usual = points.where(F.size("ints") == size).select("ints", "ids", F.col("ids")[0]["vec_id"].alias("id"))
    sample = bounded_sample(usual, "id", max(1, min(SAMPLE, SAMPLE_VALUES // max(1, size)))).toPandas()
    model = {"sample": _matrix(sample["ints"]).astype(float), "size": size, "rows": {}}
    for i, ids in enumerate(sample["ids"]):
        for one in ids:
            model["rows"].setdefault(one["vec_id"], []).append(i)
    model["pivots"] = choose(model["sample"], PIVOTS)
    model["reach"] = float(np.linalg.norm(model["pivots"], axis=1).max())
    shared, n_pivots, n_cells = spark.sparkContext.broadcast(model), len(model["pivots"]), min(CELLS, len(model["pivots"]))

    def prepare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part, ints in _by_size(batch):
                table = distances(ints.astype(float), shared.value["pivots"])
                yield pd.DataFrame({"ints": part["ints"], "ids": part["ids"], "size": ints.shape[1], "cell": table[:, :n_cells].argmin(axis=1), "norm": np.linalg.norm(ints.astype(float), axis=1), "pivots": list(table)})

    index = points.mapInPandas(prepare, "ints array<long>, ids array<struct<vec_id: long, copies: int>>, size int, cell int, norm double, pivots array<float>")
    index = materialise(index, "pivot-table")
    counts = index.groupBy("size", "cell").agg(F.count(F.lit(1)).alias("n"))
    counts = materialise(counts.select("size", "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts")), "pivot-cells")
    # Ranges of the usual length's cells: a row a cell.
    ranges = [f(F.get("pivots", F.lit(i))).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(n_pivots)]
    cells = index.where(F.col("size") == size).groupBy("cell").agg(F.max("norm").alias("norm"), *ranges).toPandas().sort_values("cell")
    low, high = (cells[[f"{name}{i}" for i in range(n_pivots)]].to_numpy(float) for name in ("low", "high"))
    grid = spark.sparkContext.broadcast({"cell": cells["cell"].to_numpy(), "norm": cells["norm"].to_numpy(float), "low": low, "high": high})

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each query its cells in the order of their bounds, the best first, with the bounds."""
        m, g = shared.value, grid.value
        for batch in batches:
            for part, ints in _by_size(batch):
                table, least = distances(ints.astype(float), m["pivots"]), np.full(len(part), -np.inf)
                visits, bounds = [list(range(n_cells))] * len(part), [[np.inf] * n_cells] * len(part)
                if ints.shape[1] == m["size"]:
                    least = _floors(part["query_id"].to_numpy(), ints, m, k)
                    far = np.stack([np.maximum(0, np.maximum(g["low"] - t, t - g["high"])).max(axis=1) for t in table])
                    best = ceiling(far, np.linalg.norm(ints.astype(float), axis=1)[:, None], g["norm"][None, :], m["reach"])
                    order = np.argsort(-best, axis=1, kind="stable")
                    visits, bounds = g["cell"][order].tolist(), np.take_along_axis(best, order, axis=1).tolist()
                yield pd.DataFrame({"query_id": part["query_id"], "ints": part["ints"], "size": ints.shape[1], "pivots": list(table), "least": least, "cells": visits, "bounds": bounds})

    asked = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("ints").alias("ints")).select(F.col("vec_id").alias("query_id"), "ints")
    asked = asked.repartition(max(spark.sparkContext.defaultParallelism, ceil(points.count() / every / BLOCK)))
    asked = materialise(asked.mapInPandas(ask, "query_id long, ints array<long>, size int, pivots array<float>, least double, cells array<int>, bounds array<double>"), "pivot-queries")
    block = F.concat_ws(":", "size", "cell", "part").alias("block")
    held = index.join(small(counts), ["size", "cell"]).withColumn("part", F.pmod(F.xxhash64("ints"), F.col("parts")).cast("int")).select(block, "ints", "ids", "pivots")
    held = materialise(held, "pivot-blocks")

    def load(part: pd.DataFrame) -> Block:
        return Block(_matrix(part["ints"]), np.stack(part["pivots"].to_numpy()), part["ids"].tolist(), shared.value["reach"])

    def search(there: Block, queries: pd.DataFrame) -> pd.DataFrame:
        args = queries["query_id"].tolist(), _matrix(queries["ints"]), np.stack(queries["pivots"].to_numpy()), queries["least"].to_numpy()
        found = [(query, vec_id, score) for query, best, _ in there.best(*args, k) for score, vec_id in best]
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")

    def visit(visits: DataFrame) -> DataFrame:
        found = by_block(held, visits.select(block, "query_id", "ints", "pivots", "least"), load, search, "query_id long, vec_id long, score long")
        return materialise(found, "pivot-found")

    places = asked.select("*", F.posexplode(F.arrays_zip("cells", "bounds")).alias("nth", "c")).drop("cells", "bounds").select("*", "c.cells", "c.bounds").withColumnRenamed("cells", "cell").drop("c")
    places = places.join(small(counts), ["size", "cell"]).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    begins = (F.col("nth") == 0) & (F.col("part") == F.pmod(F.xxhash64("query_id"), F.col("parts")))
    first = visit(places.where(begins))
    kth = first.groupBy("query_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    places = places.where(~begins).join(kth, "query_id", "left").withColumn("least", F.when(F.col("n") == k, F.greatest("least", "kth")).otherwise(F.col("least")))
    found = first.unionByName(visit(places.where(F.col("bounds") >= F.col("least"))))
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    ranked = found.withColumn("rank", place).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
w AS (SELECT vec_id, list_transform(e, lambda x: floor(x * {SCALE})) AS e FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS (SELECT vec_id AS query_id, min(e) AS e FROM w WHERE vec_id % {EVERY} = 0 GROUP BY vec_id),
s AS (SELECT query_id, vec_id, CAST(list_inner_product(q.e, w.e) AS BIGINT) AS score FROM q JOIN w ON w.vec_id <> q.query_id AND len(w.e) = len(q.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= {K}
"""

"""Approximate nearest neighbours by multi-index hashing of learned rotated binary codes.

Vectors that are null, zero, of another length than most of the sample, or that hold null or non-finite components take
no part. Rows that repeat a vec_id are candidates each, and one query (the least vector); a query's own rows are told by
their id. Fewer candidates than asked for are all returned. An empty table gives an empty result. Only the columns
named are read. Vectors are scaled by powers of two, which leaves cosines as they are, so that no square over- or underflows.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_sample, by_block, materialise

#: Vectors that the codes are learnt on, rotations learnt (each gives as many bits as vectors have components), steps.
SAMPLE, ROTATIONS, STEPS = 10_000, 4, 12
#: Bits of a substring; share of the sample's true neighbours that the Hamming radius must take in.
SUBSTRING, TAKEN = 16, 0.985
#: Rows of a block of the index: what one task holds at a time.
BLOCK = 60_000
K, EVERY = 5, 50


def learn(sample: np.ndarray, rotations: int = ROTATIONS, k: int = K) -> dict:
    """Centre, rotations (components x bits) and Hamming radius, from a sample of unit vectors.

    Iterative quantisation: a rotation is turned, step by step, to where the signs of the rotated vectors are nearest to
    the rotated vectors themselves; several, begun apart, give more bits than components. The radius is the smallest
    that takes in TAKEN of the sample's k nearest pairs. In the whole table neighbours are nearer than in a sample, so
    the share found there is larger.
    """
    rng = np.random.default_rng(42)
    sample = scaled(sample)
    x = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    parts = []
    for _ in range(rotations):
        r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
        for _ in range(STEPS):
            u, _, vt = np.linalg.svd(x.T @ np.sign(x @ r))
            r = u @ vt
        parts.append(r)
    planes = np.hstack(parts)
    codes = encode(x, planes)
    asked = slice(0, min(len(x), 1000))
    near = x[asked] @ x.T
    near[np.arange(near.shape[0]), np.arange(near.shape[0])] = -2
    best = np.argsort(-near, axis=1)[:, : min(k, max(0, len(x) - 1))]
    far = [hamming(codes[i][None], codes[row])[0] for i, row in enumerate(best)] if best.size else []
    radius = int(np.quantile(np.concatenate(far), TAKEN)) if len(far) else planes.shape[1]
    return {"planes": planes, "radius": radius}


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times the power of two that brings their largest component to between 0.5 and 1."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1))[1][:, None])


def encode(x: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Sign bits of the rotated vectors, packed to 64-bit words; the last word is filled up with zeros."""
    bits = np.packbits((x @ planes) > 0, axis=1)
    pad = -bits.shape[1] % 8
    return np.ascontiguousarray(np.pad(bits, ((0, 0), (0, pad)))).view(np.uint64)


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of each code of a to each of b."""
    out = np.zeros((len(a), len(b)), np.int32)
    for w in range(a.shape[1]):
        out += np.bitwise_count(a[:, w, None] ^ b[None, :, w])
    return out


class SubstringIndex:
    """Rows by the value of each substring of their codes."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.parts = codes.view(np.uint16)
        self.tables = []
        for s in range(self.parts.shape[1]):
            order = np.argsort(self.parts[:, s], kind="stable")
            values, first = np.unique(self.parts[order, s], return_index=True)
            self.tables.append((values, np.append(first, len(order)), order))

    def within(self, code: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows of a Hamming distance of at most radius, and their distances: every one, by the pigeonhole principle.

        If two codes differ in at most r bits, then in some one of m substrings they differ in at most r // m. So the
        values within that distance are probed in each substring's table, and the rows found are held against r whole.
        """
        part, each = code.view(np.uint16), radius // self.parts.shape[1]
        hit = np.zeros(len(self.codes), bool)
        for s, (values, first, order) in enumerate(self.tables):
            probed = np.bitwise_count(values ^ part[s]) <= each
            hit[order[np.repeat(probed, np.diff(first))]] = True
            if hit.all():
                break
        rows = np.flatnonzero(hit)
        distance = hamming(code[None], self.codes[rows])[0]
        return rows[distance <= radius], distance[distance <= radius]


class Block:
    """Rows of the index: their vectors and the substring tables of their codes."""

    def __init__(self, rows: pd.DataFrame, model: dict):
        self.model, self.ids = model, rows["vec_id"].to_numpy()
        self.x = scaled(np.stack(rows["embedding"].to_numpy()).astype(float))
        self.norms = np.linalg.norm(self.x, axis=1)
        self.table = SubstringIndex(encode(self.x / self.norms[:, None], model["planes"]))


def _search(block: Block, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest of a block of the index for each query."""
    x, ids, norms, model, table = block.x, block.ids, block.norms, block.model, block.table
    q = scaled(np.stack(queries["embedding"].to_numpy()).astype(float))
    bits, out = model["planes"].shape[1], []
    for qid, v, code in zip(queries["query_id"].to_numpy(), q, encode(q / np.linalg.norm(q, axis=1)[:, None], model["planes"]), strict=True):
        radius = model["radius"]
        while True:
            rows, _ = table.within(code, radius)
            rows = rows[ids[rows] != qid]
            if len(rows) >= k or radius >= bits:
                break
            radius = min(bits, radius + max(4, bits // 16))  # too few within: look further
        score = (x[rows] @ v) / (norms[rows] * np.linalg.norm(v))
        if len(rows) > 4 * k:
            rows = rows[score >= np.partition(score, -k)[-k] - 1e-12]  # with all ties; scored once more below
        out.append(pd.DataFrame({"query_id": qid, "vec_id": ids[rows], "score": _cosine(x[rows], v)}).sort_values(["score", "vec_id"], ascending=[False, True]).head(k))
    return pd.concat(out)


def _cosine(x: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Cosines in double precision, each summed in the same order whatever block its row is in."""
    return (x * v).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((v * v).sum()))


def sound(vectors: DataFrame) -> DataFrame:
    """Rows that take part: vec_id long, embedding array<double>."""
    rows = vectors.where("vec_id is not null and embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return rows.where(~bad & F.exists("embedding", lambda x: x != 0))


def nearest(vectors: DataFrame, every: int = EVERY, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose vec_id is divisible by `every`.

    The index is dealt into blocks of about BLOCK rows, each of which goes to one task, once; the stated query set passes by it
    as a stream, and k rows a query come back. Every row is indexed.
    """
    rows = sound(vectors)
    sample = bounded_sample(rows, "vec_id", SAMPLE).toPandas()
    out = "query_id long, rank int, vec_id long, score double"
    spark = vectors.sparkSession
    if sample.empty:
        return spark.createDataFrame([], out)
    size = int(sample["embedding"].map(len).mode()[0])
    model = learn(np.stack([v for v in sample["embedding"] if len(v) == size]))
    shared = spark.sparkContext.broadcast(model)
    rows = rows.where(F.size("embedding") == size)
    n_blocks = max(6, ceil(rows.count() / BLOCK))
    index = rows.select("vec_id", "embedding", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n_blocks)).cast("int").alias("block"))
    asked = rows.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("query_id")).agg(F.min("embedding").alias("embedding"))
    queries = asked.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    found = by_block(index, queries, lambda part: Block(part, shared.value), lambda there, part: _search(there, part, k), "query_id long, vec_id long, score double")
    found = materialise(found, "ann")
    place = F.row_number().over(W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

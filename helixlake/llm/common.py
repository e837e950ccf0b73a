"""Helpers that several operators share: table access, shared-folder tables, guarded broadcasts."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.sinks import shared_folder

#: Words: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Largest number of rows, and of bytes of their JSON, of a table that is ever broadcast; larger ones are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64_000_000

#: A key is hot with more than one in HOT_SHARE of the rows, HOT_ROWS at least. Places of a key that are one group of running().
HOT_SHARE, HOT_ROWS, CHUNK = 10_000, 10_000, 4_096

_written: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: lineage is cut, any executor can be lost."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/helixlake/{tag}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many tables of this session materialise() has written and release() has not deleted."""
    return len(_written)


def release(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete the tables that materialise() has written in this session, from number `since` on but for the last `keep`. To be called
    when no result that is made of them is read any more."""
    gone = _written[since : len(_written) - keep]
    del _written[since : len(_written) - keep]
    for name in gone:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it is within `rows` and BROADCAST_BYTES, else unchanged (a shuffled join follows)."""
    return F.broadcast(df) if is_small(df, rows) else df


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    size = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(F.length(F.to_json(F.struct("*")))).alias("bytes")).first()
    return size["n"] <= rows and (size["bytes"] or 0) <= BROADCAST_BYTES


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable isn't inlined where it is used."""
    return F.transform(F.array(value), body)[0]


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character as it is."""
    return F.translate(col, UPPER, LOWER)


def chunks(batches: Iterable[pa.RecordBatch], size: int = 1_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of Arrow batches of about `size` bytes of text (a longer text stands alone), each with its texts as a list."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("text"))
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < len(ends):
            end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, "right")))
            yield batch.slice(at, end - at), column.slice(at, end - at).to_pylist()
            at = end


def bounded_sample(rows: DataFrame, key: str, most: int, seed: int = 42) -> DataFrame:
    """At most `most` rows by a seeded digest of their key.

    Rows are thinned by hash to about twice as many before the order is taken, so that neither a task's share of the
    order nor what the driver merges of it grows with the number of partitions.
    """
    n = rows.count()
    if n > 2 * most:
        rows = rows.where(F.pmod(F.xxhash64(F.lit(seed), key), F.lit(n)) < 2 * most)
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(most)


def ranked(rows: DataFrame, keys: list[str], order: list[str], tag: str) -> DataFrame:
    """rows, written, with `place`: where a row stands (from 0) among those of its keys by order, nulls first.

    A key may hold any share of the rows: they are sorted by ranges of keys and order together, each range numbers its own
    rows, and what is windowed by key is one row per range. Keys mustn't be null. Rows alike in all of order have places
    side by side, in no defined order.
    """
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    laid = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_range", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    laid = materialise(laid, tag)
    ranges = laid.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(*keys, "_range", (before - F.col("_first")).alias("_shift"))
    return laid.join(small(ranges), [*keys, "_range"]).withColumn("place", F.col("_at") + F.col("_shift")).drop("_range", "_at", "_shift")


def looked_up(rows: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """rows joined to known, which has one row a key; rows should be a written table, as it is read more than once.

    A key with more than one in HOT_SHARE of the rows (HOT_ROWS at least) has its rows where they are: there are less than
    HOT_SHARE such keys, whatever the size of the table, so what is broadcast for them has a bound. The rest is shuffled.
    """
    n = rows.count()
    most = max(HOT_ROWS, n // HOT_SHARE)
    if n <= most:
        return rows.join(known, on)
    hot = materialise(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(*on), "hot-keys")
    if not hot.limit(1).count():
        return rows.join(known, on)
    held = known.join(F.broadcast(hot), on, "left_semi")
    return rows.join(F.broadcast(hot), on, "left_anti").join(known, on).unionByName(rows.join(F.broadcast(held), on))


def running(rows: DataFrame, key: str, at: str, sums: dict[str, Column], most: int, descending: bool = False, xor: bool = False) -> DataFrame:
    """rows with running sums (or exclusive-ors) within key by `at`, the row's own included; no `at` of a key is above `most`.

    `at` counts the rows of a key, so CHUNK places of a key are a group of bounded size; with longer keys the chunks' totals,
    one row a CHUNK, are summed along each key and added.
    """
    total = F.bit_xor if xor else F.sum
    both = (lambda a, b: a.bitwiseXOR(b)) if xor else (lambda a, b: a + b)
    order = lambda c: F.col(c).desc() if descending else F.col(c).asc()
    rows = rows.withColumn("_chunk", F.floor(F.col(at) / CHUNK).cast("long"))
    within = W.partitionBy(key, "_chunk").orderBy(order(at)).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = rows.select("*", *[total(c).over(within).alias(name) for name, c in sums.items()])
    if most >= CHUNK:
        before = W.partitionBy(key).orderBy(order("_chunk")).rowsBetween(W.unboundedPreceding, -1)
        chunks = rows.groupBy(key, "_chunk").agg(*[total(c).alias(name) for name, c in sums.items()])
        carried = chunks.select(key, "_chunk", *[total(name).over(before).alias(f"_{name}") for name in sums]).where(F.col(f"_{next(iter(sums))}").isNotNull())
        out = out.join(carried, [key, "_chunk"], "left")
        out = out.select(*rows.columns, *[both(F.col(name), F.coalesce(f"_{name}", F.lit(0))).alias(name) for name in sums])
    return out.drop("_chunk")


def crc32(col: Column) -> Column:
    """Unsigned CRC-32 of a number's decimal text."""
    return F.crc32(col.cast("string").cast("binary"))


#: The same in DuckDB, bit by bit; {} is the number.
CRC32_SQL = """xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST({} AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda s, k: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295)"""


def by_block(held: DataFrame, asked: DataFrame, load: Callable, search: Callable, schema: str) -> DataFrame:
    """What search(load(a block's rows of held), some of its rows of asked) returns, over all blocks; both have `block`.

    A block's rows of held, which should be of bounded number, are together in one task, each once; those of asked pass by them as a
    stream, however many they are. load and search take and return pandas frames, load's result is search's to know.
    """
    tagged = lambda df, kind: df.select("block", F.lit(kind).alias("_kind"), *[F.col(c).alias(f"{c}{kind}") for c in df.columns if c != "block"])
    rows = tagged(held, 0).unionByName(tagged(asked, 1), allowMissingColumns=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, parts, there = None, [], None
        for batch in batches:
            runs = batch.groupby(["block", "_kind"], sort=True, dropna=False)  # the order they come in
            for (name, kind), part in runs:
                if name != block:
                    block, parts, there = name, [], None
                own = part[[c for c in part.columns if c not in ("block", "_kind") and c.endswith(str(kind))]]
                own.columns = [c[:-1] for c in own.columns]
                if kind == 0:
                    parts.append(own)
                elif there is not None or parts:
                    if there is None:
                        there, parts = load(pd.concat(parts)), []
                    yield search(there, own)

    return rows.repartition("block").sortWithinPartitions("block", "_kind").mapInPandas(run, schema)

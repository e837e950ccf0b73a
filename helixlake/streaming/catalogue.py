"""Streaming: the catalogue kept up to date from arriving calls, and windowed counts of events."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upserts import catalogue, catalogue_state, merge_catalogue, partial_catalogue
from ..sources.manifest import Catalogue, Conflict


def append_catalogue(calls: DataFrame, folder: str, checkpoint: str, profile: Callable[[DataFrame], DataFrame] = lambda x: x):
    """Start a query that writes the state of each micro-batch of calls beside those before it; `read_catalogue` puts them together.

    A batch costs what it holds, not what the catalogue holds. It writes query=<id>/batch=<number>: replayed, it writes the same
    again, and a query begun with another checkpoint has an id of its own, so it replaces nothing.
    """
    spark = calls.sparkSession

    def append(batch: DataFrame, number: int) -> None:
        query = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        catalogue_state(profile(batch)).write.mode("overwrite").parquet(f"{folder}/query={query}/batch={number}")

    return calls.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _batches(spark: SparkSession, folder: str) -> dict[str, list[int]]:
    """query -> numbers of the micro-batches that it has written to the end."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    top = hadoop.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[str, list[int]] = {}
    for query in fs.listStatus(top) if fs.exists(top) else ():
        if query.getPath().getName().startswith("query="):
            done = [b.getPath().getName() for b in fs.listStatus(query.getPath()) if fs.exists(hadoop.Path(b.getPath(), "_SUCCESS"))]
            found[query.getPath().getName()[6:]] = sorted(int(name[6:]) for name in done if name.startswith("batch="))
    return found


def _open(spark: SparkSession, folder: str, number: int | None = None) -> tuple[DataFrame | None, dict[str, int], list[str], str | None]:
    """The compacted state, up to which batch of each query it holds them, the folders of the batches that it doesn't hold, and its own."""
    entry = Catalogue(spark, f"{folder}/_compacted").manifest(number).get("state")
    upto = dict(entry["facts"]["upto"]) if entry else {}
    rest = [f"{folder}/query={q}/batch={n}" for q, numbers in sorted(_batches(spark, folder).items()) for n in numbers if n > upto.get(q, -1)]
    state = spark.read.schema(entry["facts"]["schema"]).parquet(entry["path"]) if entry else None
    return state, upto, rest, entry["path"] if entry else None


def read_catalogue(spark: SparkSession, folder: str) -> DataFrame:
    """The catalogue of everything that streams have written to a folder; what two of them or two batches hold counts once.

    It is made of the compacted state and of the batches that came after; compaction changes neither rows nor readers.
    """
    state, _, rest, _ = _open(spark, folder)
    parts = ([state] if state is not None else []) + ([spark.read.parquet(*rest)] if rest else [])
    return catalogue(*parts) if parts else catalogue(spark.read.parquet(folder).drop("query", "batch"))


def compact_catalogue(spark: SparkSession, folder: str, delete: bool = False) -> int | None:
    """Put the batches that have come into the compacted state and publish it; the manifest's number, or None if there was nothing to do.

    The new state is a table beside the old one, dealt by variant and genome to as many files as the session's shuffles have partitions, and
    becomes current by one rename, together with the number of the last batch of each query that it holds. A crash before that leaves the old
    state and all batches; one after it leaves batches that no one reads any more. A batch that is replayed later has a number that is held
    already, and isn't counted again. If another compaction was quicker, this one begins anew. Batches of a query come in order, so those up to a number
    are all there. delete: remove the folders of all batches that are held (readers that began before would miss them).
    """
    there = Catalogue(spark, f"{folder}/_compacted")
    while True:
        state, upto, rest, path = _open(spark, folder)
        if not rest:
            break
        fresh = spark.read.parquet(*rest)
        merged = (fresh if state is None else state.unionByName(fresh)).distinct()
        entry = there.write(merged, "state")
        entry["facts"]["upto"] = upto | {q: max(numbers) for q, numbers in _batches_of(rest).items()}
        try:
            number = there.publish({"state": entry}, {"state": path})
        except Conflict:
            continue
        if delete:
            for gone in [f"{folder}/query={q}/batch={n}" for q, numbers in _batches(spark, folder).items() for n in numbers if n <= entry["facts"]["upto"].get(q, -1)]:
                target = spark._jvm.org.apache.hadoop.fs.Path(gone)
                target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        return number
    return None


def _batches_of(folders: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for folder in folders:
        query, batch = folder.rsplit("/", 2)[-2:]
        out.setdefault(query[6:], []).append(int(batch[6:]))
    return out


def maintain_catalogue(calls: DataFrame, folder: str, checkpoint: str, profile: Callable[[DataFrame], DataFrame] = lambda x: x):
    """Start a query that merges each micro-batch of calls into the catalogue's newest version: for small catalogues, each batch rewrites it.

    A batch writes version=<batch> from the version before it; a replayed batch writes the same one again, and since
    merging is by sets of genomes, nothing is counted twice.
    """
    spark = calls.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        delta = partial_catalogue(profile(batch))
        if number > 0:
            delta = merge_catalogue(spark.read.parquet(f"{folder}/version={number - 1}"), delta)
        delta.write.mode("overwrite").parquet(f"{folder}/version={number}")

    return calls.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, size: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Counts and sums by tumbling window and type; events later than the watermark are dropped, and state with them."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    out = timed.groupBy(F.window("ts", size), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "total")

"""Sinks: partitioned views with atomic refresh, entity tables, per-sample documents."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_own: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. A temporary one where that is unset, and only if all tasks run in this process."""
    there = spark.conf.get("spark.checkpoint.dir", None)
    if there:
        return there.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    if not _own:
        _own.append("file://" + tempfile.mkdtemp(prefix="helixlake-"))
    return _own[0]


#: Whether an execution's shuffle files go as soon as it has ended, and not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write df in the shared folder and read it back: lineage is cut, any executor can be lost, and what was shuffled for it goes."""
    spark = df.sparkSession
    path, before = f"{shared_folder(spark)}/helixlake/{tag}-{uuid.uuid4().hex}", spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def materialised_view(df: DataFrame, name: str, partition: str, order: list[str], folder: str | None = None) -> DataFrame:
    """Write a view as Parquet by `partition`, each file sorted by the lookup key, and read it back.

    Queries name one species, so partition pruning reads one folder; within it, row-group statistics skip by the key.
    Every refresh writes a new version beside the old one; readers of the old one aren't disturbed.
    """
    path = f"{folder or shared_folder(df.sparkSession)}/views/{name}/version={uuid.uuid4().hex}"
    df.repartition(partition, *order[:1]).sortWithinPartitions(partition, *order).write.partitionBy(partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_all(views: list[tuple[str, Callable[[], DataFrame]]], partition: str, order: list[str], folder: str | None = None) -> dict[str, DataFrame]:
    """Refresh views in the order given and publish them together under the folder's manifest; if one fails, readers go on with what there was."""
    from .manifest import Catalogue

    spark = SparkSession.active()
    there = Catalogue(spark, folder or f"{shared_folder(spark)}/views-{uuid.uuid4().hex}")
    names = [name for name, _ in views]
    number = there.refresh([(name, lambda _, make=make: make()) for name, make in views], partition, tuple(order))
    return {name: there.read(name, number) for name in names}


def write_entities(tables: dict[str, DataFrame], folder: str) -> None:
    """One Parquet table per entity; an empty one has its full schema."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def sample_documents(rows: DataFrame, key: str) -> DataFrame:
    """One JSON document per key, of all rows that have it, in order of their JSON."""
    rest = [c for c in rows.columns if c != key]
    return rows.groupBy(key).agg(F.to_json(F.array_sort(F.collect_list(F.struct(*rest)))).alias("document"))


def split_by_sample(rows: DataFrame, known: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key is known, and the orphans."""
    return rows.join(known.select(key).distinct(), key, "left_semi"), rows.join(known.select(key).distinct(), key, "left_anti")

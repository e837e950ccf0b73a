"""Readers: catalogue tables, CSV and TSV, FASTA, per-sample JSON, Newick trees, landing records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..functions import scalars as S


def scoped(table: DataFrame, pathogen: str, species: str | None = None) -> DataFrame:
    """One pathogen's (and species') rows; on a partitioned table only those folders are read."""
    rows = table.where(F.col("pathogen_id") == pathogen)
    return rows if species is None else rows.where(F.col("species_id") == species)


def lineages(table: DataFrame, pathogen: str, species: str, lineage: str | None = None) -> DataFrame:
    """The row of one lineage, by its exact id; without an id (null or empty), all lineages of the species."""
    rows = scoped(table, pathogen, species)
    return rows.where(F.col("lineage_id") == lineage) if lineage else rows


def lineage_genomes(genomes: DataFrame, lineage: str, limit: int | None = None) -> DataFrame:
    rows = genomes.where(F.col("lineage_id") == lineage)
    return rows.orderBy(F.col("collection_date").desc_nulls_last(), "genome_accession").limit(limit) if limit else rows


def query(spark: SparkSession, sql: str, tables: dict[str, DataFrame] | None = None, **parameters) -> DataFrame:
    """A statement with named parameters, over tables put in by {name}. Errors are raised, not turned into empty results."""
    return spark.sql(sql, args=parameters, **(tables or {}))


def dict_rows(rows: DataFrame) -> DataFrame:
    """Every row as one JSON object of its columns, nulls included."""
    return rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("row"))


def first_non_empty(*sources: Callable[[], DataFrame]) -> DataFrame:
    """The first source that has a row, else the last one."""
    for make in sources[:-1]:
        df = make()
        if df.limit(1).count():
            return df
    return sources[-1]()


def csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A CSV or TSV file of a known schema; a missing file is an empty table of it."""
    try:
        return spark.read.schema(schema).option("header", True).option("sep", sep).option("quote", '"').option("escape", '"').csv(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], T._parse_datatype_string(schema) if isinstance(schema, str) else schema)


def catalogue_csv(spark: SparkSession, path: str, schema: str, arrays: list[str] = (), flags: list[str] = ()) -> DataFrame:
    """An export of the catalogue: arrays are {a,"b c"} text, booleans 't' or 'f', empty text is null."""
    rows = csv(spark, path, schema)
    fields = {f.name: F.nullif(F.col(f.name), F.lit("")) for f in rows.schema if isinstance(f.dataType, T.StringType)}
    fields |= {c: S.parse_array_literal(F.col(c)) for c in arrays} | {c: F.when(F.col(c) == "t", True).when(F.col(c) == "f", False) for c in flags}
    return rows.withColumns(fields)


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """id (header up to white space), sequence (lines joined). Records are split by Spark, so files may be of any size."""
    records = spark.read.option("lineSep", ">").text(path).where(F.length(F.trim("value")) > 0)
    lines = F.split("value", r"\r?\n", 2)
    return records.select(F.get(F.split(F.get(lines, F.lit(0)), r"\s"), F.lit(0)).alias("id"), F.regexp_replace(F.coalesce(F.get(lines, F.lit(1)), F.lit("")), r"\s", "").alias("sequence"))


def screening(spark: SparkSession, pattern: str, schema: str, name: str = r"([^/]+)\.[^./]+$") -> DataFrame:
    """Result tables of several datasets by one glob; the file's stem (the group of `name` in its path) names the dataset.
    Lines that don't parse are dropped."""
    rows = spark.read.schema(schema).option("header", True).option("sep", "\t").option("mode", "DROPMALFORMED").csv(pattern)
    path = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))  # it is given as a URI
    return rows.withColumn("dataset", F.regexp_extract(path, name, 1))


def sample_documents(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """One JSON document per sample; documents that don't parse are left out."""
    rows = spark.read.schema(schema + ", _corrupt string").option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(pattern)
    return rows.withColumn("path", F.col("_metadata.file_path")).where("_corrupt is null").drop("_corrupt")


def entity_views(spark: SparkSession, folder: str, names: list[str]) -> None:
    """Parquet tables as temporary views of their names."""
    for name in names:
        spark.read.parquet(f"{folder}/{name}").createOrReplaceTempView(name)


def parse_newick(text: str) -> list[tuple[int, int | None, str, float]]:
    """(node, parent, label, length) of a Newick tree, the root first; quoted labels and comments are understood."""
    nodes: list[list] = [[0, None, "", 0.0]]
    at, i = 0, 0
    while i < len(text):
        c = text[i]
        if c == "(" or c == ",":
            parent = at if c == "(" else nodes[at][1]
            nodes.append([len(nodes), parent, "", 0.0])
            at = len(nodes) - 1
        elif c == ")":
            at = nodes[at][1]
        elif c == "[":
            i = text.index("]", i)
        elif c == ":":
            j = i + 1
            while j < len(text) and text[j] not in ",();[":
                j += 1
            nodes[at][3] = float(text[i + 1 : j])
            i = j - 1
        elif c in "'\"":
            j = text.index(c, i + 1)
            while text[j + 1 : j + 2] == c:  # doubled: a quote within the label
                j = text.index(c, j + 2)
            nodes[at][2] = text[i + 1 : j].replace(c + c, c)
            i = j
        elif c == ";":
            break
        elif not c.isspace():
            j = i
            while j < len(text) and text[j] not in ",():;[":
                j += 1
            nodes[at][2] = text[i:j].strip()
            i = j - 1
        i += 1
    return [tuple(n) for n in nodes]


def newick_tips(trees: DataFrame) -> DataFrame:
    """(tree_id, newick) -> tree_id, tip, parent, root_distance. A tree is one text and is walked whole, trees apart."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for tree, text in zip(b["tree_id"], b["newick"], strict=True):
                nodes = parse_newick(text or "")
                far = {}
                for n, parent, _, length in nodes:
                    far[n] = (far[parent] if parent is not None else 0.0) + length
                inner = {p for _, p, _, _ in nodes}
                rows += [(tree, label, p, far[n]) for n, p, label, _ in nodes if n not in inner and label]
            yield pd.DataFrame(rows, columns=["tree_id", "tip", "parent", "root_distance"])

    return trees.select("tree_id", "newick").mapInPandas(run, "tree_id string, tip string, parent int, root_distance double")


def newick_nodes(trees: DataFrame) -> DataFrame:
    """(tree_id, newick) -> tree_id, node, parent, length, label, rooted: a row a node. A tree is rooted if its text says [&R]."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for tree, text in zip(b["tree_id"], b["newick"], strict=True):
                rows = [(tree, n, parent, length, label, "[&R]" in (text or "").upper()) for n, parent, label, length in parse_newick(text or "")]
                yield pd.DataFrame(rows, columns=["tree_id", "node", "parent", "length", "label", "rooted"]).astype({"parent": "Int32"})

    return trees.select("tree_id", "newick").mapInPandas(run, "tree_id string, node int, parent int, length double, label string, rooted boolean")


def annotations(landing: DataFrame) -> DataFrame:
    """Literature records (id, passages[text, annotations[text, type, identifier, offset]]) -> one row per annotation."""
    passages = landing.select("id", F.posexplode("passages").alias("passage", "p"))
    return passages.select("id", "passage", F.col("p.text").alias("passage_text"), F.explode("p.annotations").alias("a")).select("id", "passage", "passage_text", "a.*")


def provider_items(*landings: tuple[str, DataFrame, dict[str, str]]) -> DataFrame:
    """(provider, records, column -> expression) -> one table of items; columns that a provider lacks are null."""
    rows = [df.selectExpr(f"'{name}' as source", *[f"{e} as {c}" for c, e in fields.items()]) for name, df, fields in landings]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r, allowMissingColumns=True)
    return out

"""Sequence operators: alignment and variant calls, reading frames, residue checks. Inputs are split by Spark; a task walks one pair at a time."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import dealt

# The standard genetic code, codons in order of T, C, A, G.
AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {a + b + c: AMINO_ACIDS[16 * i + 4 * j + k] for i, a in enumerate("TCAG") for j, b in enumerate("TCAG") for k, c in enumerate("TCAG")}
#: Rows that a Python task walks, and pairs whose variants a worker remembers.
ROWS, REMEMBERED = 2_000, 512
OPEN, EXTEND, MATCH, MISMATCH = -10.0, -0.5, 1.0, 0.0
MIN_LENGTH, MAX_UNKNOWN = 10, 0.5


# What a cell's best score comes from, and whether the gaps that end in it begin in it, one bit each.
SUBSTITUTED, DELETED, DELETION_BEGINS, INSERTION_BEGINS = 1, 2, 4, 8


def align(ref: str, query: str) -> list[tuple[str, str]]:
    """Pairs of residues of a best global alignment with affine gaps ('-' for a gap); substitution preferred at ties.

    Scores are kept for one row of cells, as arrays; of all cells only a byte is kept, for the way back. Beginning a gap costs
    more than going on with one, so an insertion begins where the row has no insertion: a running maximum finds the best place.
    Scores are multiples of a half, and so exact.
    """
    n, m = len(ref), len(query)
    a, b = (np.array(list(x), "U1") for x in (ref, query))
    at = np.arange(m + 1)
    best = OPEN + EXTEND * (at - 1.0)
    best[0] = 0.0
    down = np.full(m + 1, -np.inf)
    ways = np.zeros((n + 1, m + 1), np.uint8)
    ways[0, 1:2] = INSERTION_BEGINS
    for i in range(1, n + 1):
        begun = best + OPEN
        down = np.maximum(begun, down + EXTEND)
        whole = np.full(m + 1, -np.inf)
        whole[1:] = best[:-1] + np.where(b == a[i - 1], MATCH, MISMATCH)
        best = np.maximum(whole, down)
        right = np.maximum.accumulate(best - EXTEND * at)[:-1] + OPEN + EXTEND * at[:-1]
        best[1:] = np.maximum(best[1:], right)
        ways[i] = SUBSTITUTED * (best == whole) | DELETED * (best == down) | DELETION_BEGINS * (down == begun)
        ways[i, 1:] |= (INSERTION_BEGINS * (right == best[:-1] + OPEN)).astype(np.uint8)
    out, i, j, gap = [], n, m, 0
    while i or j:
        way = ways[i, j]
        if not gap:
            if way & SUBSTITUTED:
                i, j = i - 1, j - 1
                out.append((ref[i], query[j]))
                continue
            gap = DELETION_BEGINS if way & DELETED else INSERTION_BEGINS
        if gap == DELETION_BEGINS:
            i -= 1
            out.append((ref[i], "-"))
        else:
            j -= 1
            out.append(("-", query[j]))
        gap = 0 if way & gap else gap
    return out[::-1]


def variants(ref: str, query: str) -> list[tuple[int, str, str, str]]:
    """(position in ref, ref, alt, type) of what differs; unknown residues (X) don't count. Proteins too short or too unknown have none."""
    if len(query) < MIN_LENGTH or query.count("X") > MAX_UNKNOWN * len(query):
        return []
    out, position = [], 0
    for a, b in align(ref, query):
        position += a != "-"
        if a != b and "X" not in (a, b):
            out.append((position, a, b, "insertion" if a == "-" else "deletion" if b == "-" else "stop" if b == "*" else "substitution"))
    return out


@lru_cache(REMEMBERED)
def known_variants(ref: str, query: str) -> tuple[tuple[int, str, str, str], ...]:
    """variants(); a pair is aligned once while a worker remembers it."""
    return tuple(variants(ref, query))


def call_variants(pairs: DataFrame) -> DataFrame:
    """(genome_accession, gene, ref, query) -> genome_accession, gene, position, ref_aa, alt_aa, variant_type.

    Pairs are dealt to tasks first, as a small file is one task whatever it costs to align what it holds.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(x.genome_accession, x.gene, *v) for x in b.itertuples() for v in known_variants(x.ref or "", x.query or "")]
            yield pd.DataFrame(rows, columns=["genome_accession", "gene", "position", "ref_aa", "alt_aa", "variant_type"])

    return dealt(pairs.select("genome_accession", "gene", "ref", "query"), ROWS).mapInPandas(run, "genome_accession string, gene string, position int, ref_aa string, alt_aa string, variant_type string")


def residue_differences(ref: Column, query: Column) -> Column:
    """array<struct(position, ref, alt)> of equal-length strings, without a Python worker."""
    pairs = F.transform(F.sequence(F.lit(1), F.length(ref)), lambda i: F.struct(i.alias("position"), F.substring(ref, i, F.lit(1)).alias("ref"), F.substring(query, i, F.lit(1)).alias("alt")))
    return F.when((F.length(ref) > 0) & (F.length(ref) == F.length(query)), F.filter(pairs, lambda p: p["ref"] != p["alt"])).otherwise(F.array().cast("array<struct<position: int, ref: string, alt: string>>"))


def translate(dna: str) -> str:
    return "".join(CODONS.get(dna[i : i + 3], "X") for i in range(0, len(dna) - 2, 3))


def reading_frames(dna: str, least: int = 150, unknown: float = 0.3) -> list[str]:
    """Proteins between stops in all six frames that are long and known enough."""
    dna = dna.upper().replace("U", "T")
    back = dna.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    found = [p for strand in (dna, back) for k in range(3) for p in translate(strand[k:]).split("*")]
    return [p for p in found if len(p) >= least and p.count("X") <= unknown * len(p)]


def identity(a: str, b: str, offsets: tuple[int, ...] = (-30, -10, -3, 0, 3, 10, 30)) -> float:
    """The best share of equal residues over a few offsets, of the shorter length."""
    best, u, v = 0.0, np.array(a, "U").reshape(1).view("U1"), np.array(b, "U").reshape(1).view("U1")
    for k in offsets:
        x, y = (u[k:], v) if k >= 0 else (u, v[-k:])
        n = min(len(x), len(y))
        if n and a and b:
            best = max(best, int((x[:n] == y[:n]).sum()) / min(len(a), len(b)))
    return best


def best_genes(genomes: DataFrame, proteins: DataFrame, least: float = 0.25, length: int = 150) -> DataFrame:
    """(genome_accession, species_id, dna) x (species_id, gene, protein) -> genome_accession, gene, protein, score: the best frame of each gene.

    Genomes are dealt to tasks of ROWS, and of a batch's pairs only the best of each gene go on to be sorted.
    """

    def frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame([(x.genome_accession, x.species_id, p) for x in b.itertuples() for p in reading_frames(x.dna or "", length)], columns=["genome_accession", "species_id", "frame"])

    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = b.assign(score=[identity(x, y) for x, y in zip(b["frame"], b["protein"], strict=True)])
            out = out[out["score"] > least].sort_values(["score", "frame"]).drop_duplicates(["genome_accession", "gene"], keep="last")
            yield out[["genome_accession", "gene", "frame", "score"]]

    found = dealt(genomes.select("genome_accession", "species_id", "dna"), ROWS).mapInPandas(frames, "genome_accession string, species_id string, frame string")
    pairs = found.join(proteins.select("species_id", "gene", "protein"), "species_id").select("genome_accession", "gene", "frame", "protein")
    out = pairs.mapInPandas(scored, "genome_accession string, gene string, frame string, score double")
    return out.groupBy("genome_accession", "gene").agg(F.max(F.struct("score", "frame")).alias("m")).select("genome_accession", "gene", F.col("m.frame").alias("protein"), F.col("m.score").alias("score"))


def reference_checked(candidates: DataFrame, proteins: DataFrame) -> DataFrame:
    """Candidates (species_id, gene, ref, position) with the proteins whose residue at the position is the one named."""
    return candidates.join(proteins.select("species_id", "gene", "protein"), ["species_id", "gene"]).where(F.substring(F.col("protein"), F.col("position"), F.lit(1)) == F.upper("ref"))


def coding_sequences(features: DataFrame, products: dict[str, str]) -> DataFrame:
    """(genome_accession, ordinal, gene, product, protein) -> genome_accession, gene, protein: the first of each gene, named by qualifier or product."""
    from .joins import first_per

    by_product = F.try_element_at(F.create_map(*[F.lit(x) for pair in products.items() for x in pair]), F.lower(F.trim("product")))
    rows = features.withColumn("gene", F.coalesce(F.nullif(F.trim("gene"), F.lit("")), by_product)).where("gene is not null and length(protein) > 0")
    return first_per(rows, ["genome_accession", "gene"], "ordinal").select("genome_accession", "gene", "protein")


def genome_metadata(records: DataFrame) -> DataFrame:
    """(accession, length, description, country, collected, host, isolate) -> metadata with dates, place, completeness."""
    from ..functions import scalars as S

    place, date = S.country_and_region(F.col("country")), S.record_date(F.col("collected"))
    year = F.coalesce(F.year(date), F.nullif(F.regexp_extract("isolate", r"(?:^|[^0-9])((?:19|20)\d{2})(?:[^0-9]|$)", 1), F.lit("")).try_cast("int"))
    code = F.nullif(F.regexp_extract("isolate", r"/([A-Z]{3})/", 1), F.lit(""))
    return records.select(
        F.col("accession").alias("genome_accession"), date.alias("collection_date"), year.alias("collection_year"), place["country"].alias("collection_country"), place["region"].alias("collection_region"),
        code.alias("collection_country_code"), F.nullif(F.trim("host"), F.lit("")).alias("host"), S.completeness(F.col("length"), F.col("description")).alias("completeness"),
    )

"""Explicit schemas and controlled vocabularies of the evidence model."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Columns that identify a mutation within a pathogen's species.
MUTATION = ["pathogen_id", "species_id", "gene", "position", "ref_aa", "alt_aa", "variant_type", "hgvs_p"]
#: Every query stays within one pathogen and one species: what tables are partitioned by.
SCOPE = ["pathogen_id", "species_id"]

GENOME = "pathogen_id string, species_id string, genome_accession string, collection_date date, collection_year int, collection_country string, collection_country_code string, collection_region string, lineage_id string, host string, completeness string"
VARIANT_CALL = "pathogen_id string, species_id string, genome_accession string, gene string, position int, ref_aa string, alt_aa string, variant_type string, hgvs_p string"
ASSOCIATION = "pathogen_id string, species_id string, association_id string, protein string, position int, ref_aa string, alt_aa string, lineage_id string, phenotype_category string, phenotype_specific string, evidence_strength string, effect_size string, genotype_description string, literature_refs array<string>, record_flagged boolean"
GENE_FUNCTION = "species_id string, gene string, protein_name string, protein_length_aa int, key_domains array<struct<type: string, description: string, start: int, end: int>>"
FINDING = "sample_id string, analysis string, finding_type string, assertion string, confidence string"

# Vocabularies in order of rank, lowest first.
RISK_TIERS = ("routine", "monitor", "investigate", "high_priority", "emergency")
EVIDENCE_STRENGTH = ("insufficient", "preliminary", "weak", "moderate", "strong")


def rank_of(value: Column, vocabulary: tuple[str, ...]) -> Column:
    """Place of a term in its vocabulary, from 0; null if it isn't one. Ordered vocabularies sort by this, not by text."""
    place = F.array_position(F.array(*map(F.lit, vocabulary)), value)
    return F.nullif(place, F.lit(0)) - 1

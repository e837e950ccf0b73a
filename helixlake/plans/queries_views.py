"""Queries over the views, on the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import views as V
from .domain import GF, GM, GP, PROFILE, PV, Domain

MK = "pathogen_id, species_id, gene, position, ref_aa, alt_aa, variant_type, hgvs_p"
CC = "collection_country, collection_country_code"
COUNTS = "count(DISTINCT genome_accession) AS genome_count, count(*) AS variant_observations"
LISTED = "array_to_string(list_sort(list_distinct(list({c}) FILTER ({c} IS NOT NULL))), ',') AS {a}"


def _profile(d: Domain):
    return V.variant_profile(d.calls, d.genomes, d.tasks)


def J01_variant_profile(spark, sf_dir):
    return _profile(Domain(spark, sf_dir)).select(*MK.split(", "), "genome_accession", "collection_date", "collection_country", "lineage_id", "completeness")


def A01_mutation_surveillance(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.mutation_surveillance(_profile(d), d.tasks)


def A02_mutation_geography(spark, sf_dir):
    out = V.mutation_geography(_profile(Domain(spark, sf_dir)))
    return out.withColumns({c: F.array_join(c, ",") for c in ("countries", "country_codes")})


def A03_mutation_trends(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.mutation_trends(_profile(d), d.tasks)


def A04_mutation_frequency(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.mutation_frequency(_profile(d), d.genomes, d.tasks)


def A05_species_summary(spark, sf_dir):
    return V.species_summary(Domain(spark, sf_dir).genomes)


def A06_lineage_breakdown(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.lineage_breakdown(_profile(d), d.tasks)


def A07_lineage_surveillance(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.lineage_surveillance(_profile(d), d.tasks)


def A08_position_variants(spark, sf_dir):
    return V.position_variants(_profile(Domain(spark, sf_dir))).withColumn("observed_alt_aas", F.array_join("observed_alt_aas", ","))


def A09_phenotype_inventory(spark, sf_dir):
    return V.phenotype_inventory(Domain(spark, sf_dir).associations)


def _asked(d: Domain, *more: str):
    """Associations with the columns that matching reads and those asked for."""
    return d.associations.select("pathogen_id", "species_id", "protein", "position", "alt_aa", "lineage_id", *more)


def J03_phenotype_or_join(spark, sf_dir):
    d = Domain(spark, sf_dir)
    calls = _profile(d).select("pathogen_id", "species_id", "genome_accession", "gene", "position", "alt_aa", "hgvs_p", "variant_type", "lineage_id")
    rows = V.with_phenotype(calls, _asked(d, "association_id", "evidence_strength"))
    return rows.select("genome_accession", "hgvs_p", "variant_type", "lineage_id", F.col("g_association_id").alias("association_id"), F.col("g_evidence_strength").alias("evidence_strength"))


def A10_phenotype_geo_temporal(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.phenotype_geo_temporal(_profile(d), d.associations)


def _catalogue(d: Domain):
    return V.catalogue(_profile(d), d.genomes, d.tasks)


def A11_variant_catalogue(spark, sf_dir):
    return _catalogue(Domain(spark, sf_dir)).withColumns({c: F.array_join(c, ",") for c in ("countries_seen", "lineage_ids")})


def J04_array_lineage_join(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.catalogue_with_phenotype(_catalogue(d), _asked(d, "association_id")).select(*MK.split(", "), "genome_count", F.col("g_association_id").alias("association_id"))


def J05_cooccurrence(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.co_occurrence(d.calls, d.genomes)


def J06_catalogue_function(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return V.catalogue_with_function(_catalogue(d).drop("countries_seen", "lineage_ids"), d.gene_function)


def J08_snapshot(spark, sf_dir):
    d = Domain(spark, sf_dir)
    calls = _profile(d).select("species_id", "gene", "position", "ref_aa", "alt_aa", "genome_accession", "hgvs_p", "variant_type")
    known = d.associations.select("species_id", "protein", "position", "ref_aa", "alt_aa", "association_id", "phenotype_category")
    return V.snapshot(calls, d.gene_function.select("species_id", "gene", "protein_name"), known).select("genome_accession", "hgvs_p", "variant_type", "protein_name", "association_id", "phenotype_category")


def W01_latest_observation(spark, sf_dir):
    return V.latest_observation(_profile(Domain(spark, sf_dir)))


def K12_partitioned_view(spark, sf_dir):
    """What the materialised frequency view holds for one species, read back through its partition."""
    from ..sources.sinks import materialised_view

    d = Domain(spark, sf_dir)
    view = materialised_view(V.mutation_trends(_profile(d), d.tasks), "mv_mutation_trends", partition="species_id", order=["gene", "position", "alt_aa"])
    return view.where("species_id = 'ASIA'")


WHERE = "{p}.pathogen_id = gp.pathogen_id AND {p}.species_id = gp.species_id AND (({p}.gene = gp.protein AND {p}.position = gp.position AND {p}.alt_aa = gp.alt_aa) OR {lineage} OR (gp.position IS NULL AND gp.protein = {p}.gene))"
CATALOGUE = f"""
tot AS (SELECT pathogen_id, species_id, count(*) AS species_total_genomes FROM gm GROUP BY 1, 2),
cat AS (SELECT {MK}, genome_count, first_seen_date, last_seen_date, countries, lineages, species_total_genomes, round(CAST(genome_count AS DOUBLE) / species_total_genomes, 4) AS global_frequency
  FROM (SELECT {MK}, count(DISTINCT genome_accession) AS genome_count, min(collection_date) AS first_seen_date, max(collection_date) AS last_seen_date,
        list_sort(list_distinct(list(collection_country) FILTER (collection_country IS NOT NULL))) AS countries, list_sort(list_distinct(list(lineage_id) FILTER (lineage_id IS NOT NULL))) AS lineages
        FROM profile GROUP BY {MK}) x JOIN tot USING (pathogen_id, species_id))"""

ORACLES = {
    "J01_variant_profile": f"WITH {PROFILE} SELECT {MK}, genome_accession, collection_date, collection_country, lineage_id, completeness FROM profile",
    "A01_mutation_surveillance": f"WITH {PROFILE} SELECT {MK}, collection_year, {CC}, {COUNTS} FROM profile GROUP BY {MK}, collection_year, {CC}",
    "A02_mutation_geography": f"WITH {PROFILE} SELECT {MK}, {COUNTS}, min(collection_date) AS first_seen_date, max(collection_date) AS last_seen_date, min(collection_year) AS first_seen_year, max(collection_year) AS last_seen_year, "
    f"coalesce({LISTED.format(c='collection_country', a='x').removesuffix(' AS x')}, '') AS countries, coalesce({LISTED.format(c='collection_country_code', a='x').removesuffix(' AS x')}, '') AS country_codes FROM profile GROUP BY {MK}",
    "A03_mutation_trends": f"WITH {PROFILE} SELECT {MK}, collection_year, {COUNTS} FROM profile GROUP BY {MK}, collection_year",
    "A04_mutation_frequency": f"""WITH {PROFILE},
st AS (SELECT pathogen_id, species_id, count(*) AS species_total_genomes FROM gm GROUP BY 1, 2),
ct AS (SELECT pathogen_id, species_id, {CC}, count(*) AS country_total_genomes FROM gm GROUP BY ALL),
mc AS (SELECT {MK}, {CC}, count(DISTINCT genome_accession) AS country_genome_count FROM profile GROUP BY {MK}, {CC}),
mg AS (SELECT {MK}, count(DISTINCT genome_accession) AS global_genome_count FROM profile GROUP BY {MK})
SELECT {MK}, {CC}, country_genome_count, country_total_genomes, round(CAST(country_genome_count AS DOUBLE) / country_total_genomes, 4) AS country_frequency, global_genome_count, species_total_genomes,
 round(CAST(global_genome_count AS DOUBLE) / species_total_genomes, 4) AS global_frequency FROM mc JOIN ct USING (pathogen_id, species_id, {CC}) JOIN mg USING ({MK}) JOIN st USING (pathogen_id, species_id)""",
    "A05_species_summary": f"WITH {GM} SELECT pathogen_id, species_id, collection_year, {CC}, count(*) AS total_genomes, min(collection_date) AS earliest_date, max(collection_date) AS latest_date FROM gm GROUP BY ALL",
    "A06_lineage_breakdown": f"WITH {PROFILE} SELECT {MK}, lineage_id, {COUNTS} FROM profile WHERE lineage_id IS NOT NULL GROUP BY {MK}, lineage_id",
    "A07_lineage_surveillance": f"WITH {PROFILE} SELECT {MK}, lineage_id, collection_year, {CC}, {COUNTS} FROM profile WHERE lineage_id IS NOT NULL GROUP BY {MK}, lineage_id, collection_year, {CC}",
    "A08_position_variants": f"WITH {PROFILE} SELECT pathogen_id, species_id, gene, position, ref_aa, count(DISTINCT alt_aa) AS distinct_alt_count, {LISTED.format(c='alt_aa', a='observed_alt_aas')}, CAST(sum(CASE WHEN alt_aa <> ref_aa THEN 1 ELSE 0 END) AS BIGINT) AS non_ref_variant_observations FROM profile GROUP BY 1, 2, 3, 4, 5",
    "A09_phenotype_inventory": f"WITH {GP} SELECT pathogen_id, species_id, phenotype_category, evidence_strength, coalesce(protein || ':' || ref_aa || CAST(position AS VARCHAR) || alt_aa, genotype_description) AS label, count(*) AS candidate_count FROM gp GROUP BY ALL",
    "J03_phenotype_or_join": f"WITH {PROFILE}, {GP} SELECT genome_accession, hgvs_p, variant_type, profile.lineage_id, association_id, evidence_strength FROM profile LEFT JOIN gp ON {WHERE.format(p='profile', lineage='gp.lineage_id = profile.lineage_id')}",
    "A10_phenotype_geo_temporal": f"WITH {PROFILE}, {GP} SELECT profile.pathogen_id, profile.species_id, association_id, gene, profile.lineage_id, collection_year, {CC}, max(collection_region) AS region, {COUNTS}, min(collection_date) AS first_seen, max(collection_date) AS last_seen FROM profile JOIN gp ON {WHERE.format(p='profile', lineage='gp.lineage_id = profile.lineage_id')} GROUP BY ALL",
    "A11_variant_catalogue": f"WITH {PROFILE}, {CATALOGUE} SELECT {MK}, genome_count, first_seen_date, last_seen_date, coalesce(array_to_string(countries, ','), '') AS countries_seen, coalesce(array_to_string(lineages, ','), '') AS lineage_ids, species_total_genomes, global_frequency FROM cat",
    "J04_array_lineage_join": f"WITH {PROFILE}, {CATALOGUE}, {GP} SELECT cat.pathogen_id, cat.species_id, gene, cat.position, cat.ref_aa, cat.alt_aa, variant_type, hgvs_p, genome_count, association_id FROM cat LEFT JOIN gp ON {WHERE.format(p='cat', lineage='list_contains(cat.lineages, gp.lineage_id)')}",
    "J05_cooccurrence": f"""WITH {PV} SELECT a.pathogen_id, a.species_id, a.genome_accession, a.gene AS gene_a, a.position AS position_a, a.alt_aa AS alt_aa_a, a.hgvs_p AS hgvs_p_a, b.gene AS gene_b, b.position AS position_b, b.alt_aa AS alt_aa_b, b.hgvs_p AS hgvs_p_b, collection_year, collection_country
FROM pv a JOIN pv b USING (pathogen_id, species_id, genome_accession) JOIN gm USING (pathogen_id, species_id, genome_accession) WHERE (a.gene, a.position, a.alt_aa) < (b.gene, b.position, b.alt_aa)""",
    "J06_catalogue_function": f"WITH {PROFILE}, {CATALOGUE}, {GF} SELECT {MK}, genome_count, first_seen_date, last_seen_date, species_total_genomes, global_frequency, protein_name, protein_length_aa FROM cat LEFT JOIN gf USING (species_id, gene)",
    "J08_snapshot": f"WITH {PROFILE}, {GP}, {GF} SELECT genome_accession, hgvs_p, variant_type, protein_name, association_id, phenotype_category FROM profile p LEFT JOIN gf USING (species_id, gene) LEFT JOIN gp ON p.species_id = gp.species_id AND p.gene = gp.protein AND p.position = gp.position AND p.ref_aa = gp.ref_aa AND p.alt_aa = gp.alt_aa",
    "W01_latest_observation": f"""WITH {PROFILE} SELECT pathogen_id, species_id, gene, position, ref_aa, alt_aa, variant_type, hgvs_p, genome_accession, collection_date, collection_year, collection_country FROM
(SELECT *, row_number() OVER (PARTITION BY pathogen_id, species_id, gene, position, ref_aa, alt_aa ORDER BY collection_date DESC NULLS FIRST, genome_accession, variant_type, hgvs_p) AS place FROM profile) WHERE place = 1""",
    "K12_partitioned_view": f"WITH {PROFILE} SELECT {MK}, collection_year, {COUNTS} FROM profile WHERE species_id = 'ASIA' GROUP BY {MK}, collection_year",
}
QUERIES = {name: globals()[name] for name in ORACLES}

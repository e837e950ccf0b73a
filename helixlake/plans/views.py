"""The analytical views, each a function from tables to a DataFrame. Those that meet associations count keys and write their calls first; no other triggers a job."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.joins import hashed, spread
from ..operators.upserts import seen_of
from ..schemas import MUTATION, SCOPE
from ..sources.sinks import stored

COUNTRY = ["collection_country", "collection_country_code"]
#: Rows of a key that an array holds where calls or variants meet associations.
CHUNK = 1_000


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole rounded half up, null for an empty whole."""
    return F.round(part / F.nullif(whole, F.lit(0)), digits)


def distinct_sorted(c: str) -> Column:
    """Distinct non-null values in order."""
    return F.array_sort(F.collect_set(c))


def distinct_sorted_with_null(c: str) -> Column:
    """Distinct values in order, null last if there is one."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.array(c)))))


def variant_profile(calls: DataFrame, genomes: DataFrame, tasks: int | None = None) -> DataFrame:
    """Calls with what is known of their genomes: one equi-join, both sides hashed on the genome (to so many tasks, if given)."""
    genome = [*SCOPE, "genome_accession"]
    return hashed(calls, tasks, *genome).join(hashed(genomes, tasks, *genome), genome)


def _counts() -> list[Column]:
    return [F.count_distinct("genome_accession").alias("genome_count"), F.count(F.lit(1)).alias("variant_observations")]


def _counted(profile: DataFrame, tasks: int | None, *more: str) -> DataFrame:
    """_counts() by mutation and more columns: calls are counted by genome where the genome is, then dealt by the mutation to so many tasks."""
    keys = [*MUTATION, *more]
    once = profile.groupBy(*keys, "genome_accession").agg(F.count(F.lit(1)).alias("_n"))
    return hashed(once, tasks, *keys).groupBy(*keys).agg(F.count("genome_accession").alias("genome_count"), F.sum("_n").alias("variant_observations"))


def mutation_surveillance(profile: DataFrame, tasks: int | None = None) -> DataFrame:
    return _counted(profile, tasks, "collection_year", *COUNTRY)


def mutation_geography(profile: DataFrame) -> DataFrame:
    return profile.groupBy(*MUTATION).agg(
        *_counts(), F.min("collection_date").alias("first_seen_date"), F.max("collection_date").alias("last_seen_date"),
        F.min("collection_year").alias("first_seen_year"), F.max("collection_year").alias("last_seen_year"),
        distinct_sorted("collection_country").alias("countries"), distinct_sorted("collection_country_code").alias("country_codes"),
    )


def mutation_trends(profile: DataFrame, tasks: int | None = None) -> DataFrame:
    return _counted(profile, tasks, "collection_year")


def mutation_frequency(profile: DataFrame, genomes: DataFrame, tasks: int | None = None) -> DataFrame:
    """A mutation's share of genomes by country and in the species. Rows without country drop out with the equi-join.

    Calls are reduced to distinct (mutation, country, genome) once; both numerators are counts over that.
    """
    once = hashed(profile.select(*MUTATION, *COUNTRY, "genome_accession").distinct(), tasks, *MUTATION)
    by_country = once.groupBy(*MUTATION, *COUNTRY).agg(F.count(F.lit(1)).alias("country_genome_count"))
    # A genome has one country, so the distinct genomes of the species are the sum over countries.
    whole = by_country.withColumn("global_genome_count", F.sum("country_genome_count").over(W.partitionBy(*MUTATION)))
    species = genomes.groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("species_total_genomes"))
    country = genomes.groupBy(*SCOPE, *COUNTRY).agg(F.count(F.lit(1)).alias("country_total_genomes"))
    out = whole.join(F.broadcast(country), [*SCOPE, *COUNTRY]).join(F.broadcast(species), SCOPE)  # as few rows as there are countries
    return out.withColumns({
        "country_frequency": ratio(F.col("country_genome_count"), F.col("country_total_genomes")),
        "global_frequency": ratio(F.col("global_genome_count"), F.col("species_total_genomes")),
    })


def species_summary(genomes: DataFrame) -> DataFrame:
    return genomes.groupBy(*SCOPE, "collection_year", *COUNTRY).agg(F.count(F.lit(1)).alias("total_genomes"), F.min("collection_date").alias("earliest_date"), F.max("collection_date").alias("latest_date"))


def lineage_breakdown(profile: DataFrame, tasks: int | None = None) -> DataFrame:
    return _counted(profile.where("lineage_id is not null"), tasks, "lineage_id")


def lineage_surveillance(profile: DataFrame, tasks: int | None = None) -> DataFrame:
    return _counted(profile.where("lineage_id is not null"), tasks, "lineage_id", "collection_year", *COUNTRY)


def position_variants(profile: DataFrame) -> DataFrame:
    return profile.groupBy(*SCOPE, "gene", "position", "ref_aa").agg(
        F.count_distinct("alt_aa").alias("distinct_alt_count"), distinct_sorted("alt_aa").alias("observed_alt_aas"),
        F.sum(F.when(F.col("alt_aa") != F.col("ref_aa"), 1).otherwise(0)).alias("non_ref_variant_observations"),
    )


def association_label() -> Column:
    """protein:refPOSalt, or the description where any part of that is missing."""
    return F.coalesce(F.concat("protein", F.lit(":"), "ref_aa", F.col("position").cast("string"), "alt_aa"), F.col("genotype_description"))


def phenotype_inventory(associations: DataFrame) -> DataFrame:
    keys = [*SCOPE, "phenotype_category", "evidence_strength"]
    return associations.groupBy(*keys, association_label().alias("label")).agg(F.count(F.lit(1)).alias("candidate_count"))


def _ways(rows: DataFrame, associations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The associations of exactly a row's mutation, and of its gene without a position, as pairs; the two sides of lineages.

    Each is an equi-join whose pairs are dealt to tasks of bounded work, however many associations a key has.
    """
    a = associations.select(*SCOPE, *[F.col(c).alias(f"g_{c}") for c in associations.columns if c not in SCOPE])
    exact = a.where("g_protein is not null and g_position is not null and g_alt_aa is not null").withColumns({"gene": F.col("g_protein"), "position": F.col("g_position"), "alt_aa": F.col("g_alt_aa")})
    gene = a.where("g_protein is not null and g_position is null").withColumn("gene", F.col("g_protein"))
    lineage = a.where("g_lineage_id is not null").withColumn("one", F.col("g_lineage_id"))
    return spread(rows, exact, [*SCOPE, "gene", "position", "alt_aa"], each=CHUNK), spread(rows, gene, [*SCOPE, "gene"], each=CHUNK), exact, lineage


def _is_exact() -> Column:
    return F.coalesce((F.col("g_position") == F.col("position")) & (F.col("g_protein") == F.col("gene")) & (F.col("g_alt_aa") == F.col("alt_aa")), F.lit(False))  # numbers first: it is asked for every pair


def _unmet(rows: DataFrame, exact: DataFrame, gene_keys: DataFrame, lineages: DataFrame, meets: Column) -> DataFrame:
    """Rows that no way has an association for: a way's rows are left out only for another way's, so its keys tell. Keys are met once each."""
    out = rows.join(exact.select(*SCOPE, "gene", "position", "alt_aa").distinct(), [*SCOPE, "gene", "position", "alt_aa"], "left_anti")
    out = out.join(gene_keys.select(*SCOPE, F.col("protein").alias("gene")).distinct(), [*SCOPE, "gene"], "left_anti")
    known = lineages.groupBy(*SCOPE).agg(F.collect_set("one").alias("_known"))  # of lineages
    return out.join(known, SCOPE, "left").where(~F.coalesce(meets, F.lit(False))).drop("_known")


def with_phenotype(profile: DataFrame, associations: DataFrame) -> DataFrame:
    """Calls left-joined to associations on exact mutation, lineage, or gene alone (association without position).

    Three equi-joins, one for each way, never comparing a call with an association of another key; an association that meets several ways is
    taken by the first of exact, lineage, gene. The profile is written once, as each way counts and reads it: it should hold no more columns
    than are asked for.
    """
    rows = stored(profile, "phenotype-calls")
    by_exact, by_gene, exact, lineage = _ways(rows, associations)
    same = F.coalesce(F.col("g_lineage_id") == F.col("lineage_id"), F.lit(False))
    by_lineage = spread(rows.where("lineage_id is not null").withColumn("one", F.col("lineage_id")), lineage, [*SCOPE, "one"], each=CHUNK).where(~_is_exact())
    alone = _unmet(rows, exact, associations.where("protein is not null and position is null"), lineage, F.array_contains("_known", F.col("lineage_id")))
    columns = [*profile.columns, *[f"g_{c}" for c in associations.columns if c not in SCOPE]]
    found = [x.select(*columns) for x in (by_exact, by_lineage, by_gene.where(~same))]
    return reduce(DataFrame.unionByName, found).unionByName(alone, allowMissingColumns=True)


def phenotype_geo_temporal(profile: DataFrame, associations: DataFrame) -> DataFrame:
    """What is seen of each association by gene, lineage, year and country, of the calls that with_phenotype() gives it.

    Calls are counted before they meet associations: all of a gene and lineage count for those of the lineage and for those
    of the gene without a position, all of one mutation for the others.
    """
    keys = [*SCOPE, "gene", "lineage_id", "collection_year", *COUNTRY]
    counted = lambda *more: profile.groupBy(*keys, *more).agg(F.max("collection_region").alias("region"), *_counts(), F.min("collection_date").alias("first_seen"), F.max("collection_date").alias("last_seen"))
    a = associations.where("association_id is not null").select(*SCOPE, "association_id", F.col("protein").alias("a_gene"), F.col("position").alias("a_position"), F.col("alt_aa").alias("a_alt"), F.col("lineage_id").alias("a_lineage"))
    other = ~F.coalesce(F.col("a_lineage") == F.col("lineage_id"), F.lit(False))
    whole, single = stored(counted(), "geo-genes"), stored(counted("position", "alt_aa"), "geo-mutations")
    of = lambda **keys: a.where(" and ".join(f"{c} is not null" for c in keys.values())).withColumns({k: F.col(c) for k, c in keys.items()})
    rows = [
        spread(whole, of(lineage_id="a_lineage"), [*SCOPE, "lineage_id"]),
        spread(whole, of(gene="a_gene").where("a_position is null"), [*SCOPE, "gene"]).where(other),
        spread(single, of(gene="a_gene", position="a_position", alt_aa="a_alt"), [*SCOPE, "gene", "position", "alt_aa"]).where(other),
    ]
    columns = [*SCOPE, "association_id", *[c for c in whole.columns if c not in SCOPE]]
    return reduce(DataFrame.unionByName, [r.select(*columns) for r in rows])


def catalogue(profile: DataFrame, genomes: DataFrame, tasks: int | None = None) -> DataFrame:
    """The aggregate grain: one row per distinct variant, with its genomes, dates, countries and lineages."""
    total = genomes.groupBy(*SCOPE).agg(F.count(F.lit(1)).alias("species_total_genomes"))
    rows = seen_of(profile, tasks).withColumnsRenamed({"first": "first_seen_date", "last": "last_seen_date", "countries": "countries_seen", "lineages": "lineage_ids"})
    return rows.join(F.broadcast(total), SCOPE).withColumn("global_frequency", ratio(F.col("genome_count"), F.col("species_total_genomes")))


def catalogue_with_function(rows: DataFrame, gene_function: DataFrame) -> DataFrame:
    return rows.join(gene_function, ["species_id", "gene"], "left")


def catalogue_with_phenotype(rows: DataFrame, associations: DataFrame) -> DataFrame:
    """As with_phenotype, on the aggregate grain: a lineage matches if it is among the variant's lineages, which are joined one by one."""
    kept = stored(rows, "phenotype-variants")
    by_exact, by_gene, exact, lineage = _ways(kept, associations)
    same = F.coalesce(F.array_contains("lineage_ids", F.col("g_lineage_id")), F.lit(False))
    by_lineage = spread(kept.withColumn("one", F.explode("lineage_ids")), lineage, [*SCOPE, "one"], each=CHUNK).where(~_is_exact())
    alone = _unmet(kept, exact, associations.where("protein is not null and position is null"), lineage, F.arrays_overlap("lineage_ids", "_known"))
    columns = [*rows.columns, *[f"g_{c}" for c in associations.columns if c not in SCOPE]]
    found = [x.select(*columns) for x in (by_exact, by_lineage, by_gene.where(~same))]
    return reduce(DataFrame.unionByName, found).unionByName(alone, allowMissingColumns=True)


#: Grains of a sample query: what each is grouped by, besides the scope.
GRAINS = {"mutation": ("hgvs_p", "variant_type"), "lineage": ("lineage_id",), "lineage_country": ("lineage_id", "collection_country"), "country": ("collection_country",), "year": ("collection_year",), "species": ()}


def layers(calls: DataFrame, genomes: DataFrame, tasks: int | None = None) -> DataFrame:
    """grain, scope, the keys of all grains (null where a grain hasn't one), genomes, first_seen, last_seen: distinct genomes at every grain.

    Calls meet their genome once. There the first row of each genome, and of each mutation in it, is marked, so that a distinct count at any
    grain is a sum, and all grains are sums over one set of rows, added up where they are before one shuffle.
    """
    genome = [*SCOPE, "genome_accession"]
    known = hashed(genomes.select(*genome, "lineage_id", "collection_country", "collection_year", "collection_date"), tasks, *genome)
    rows = known.join(hashed(calls.select(*genome, "hgvs_p", "variant_type"), tasks, *genome), genome, "left")
    first = lambda *more: (F.row_number().over(W.partitionBy(*genome).orderBy("hgvs_p", "variant_type")) == 1) if not more else (F.row_number().over(W.partitionBy(*genome, *more).orderBy("hgvs_p")) == 1)
    rows = rows.withColumn("_head", first().cast("long")).withColumn("_own", (first("hgvs_p", "variant_type") & F.col("hgvs_p").isNotNull()).cast("long"))
    keys = list(dict.fromkeys(k for g in GRAINS.values() for k in g))
    sets = [[*map(F.col, SCOPE), *map(F.col, g)] for g in GRAINS.values()]
    bit = {k: 1 << (len(keys) - 1 - i) for i, k in enumerate(keys)}
    code = {sum(bit[k] for k in keys if k not in g): name for name, g in GRAINS.items()}
    counted = rows.groupingSets(sets, *SCOPE, *keys).agg(F.grouping_id().alias("_g"), F.sum("_own").alias("_o"), F.sum("_head").alias("_h"), F.min("collection_date").alias("first_seen"), F.max("collection_date").alias("last_seen"))
    grain = F.try_element_at(F.create_map(*[F.lit(x) for p in code.items() for x in p]), F.col("_g").cast("int"))
    out = counted.select(grain.alias("grain"), *SCOPE, *keys, F.when(grain == "mutation", F.col("_o")).otherwise(F.col("_h")).alias("genomes"), "first_seen", "last_seen")
    return out.where((F.col("grain") != "mutation") | F.col("hgvs_p").isNotNull())


def co_occurrence(calls: DataFrame, genomes: DataFrame) -> DataFrame:
    """Unordered pairs of a genome's calls. Calls equal in (gene, position, alt) never pair.

    Pairs grow with the square of a genome's calls, which the genome's length bounds; nothing pairs across genomes.
    """
    key = [*SCOPE, "genome_accession"]
    side = lambda s: calls.select(*key, *[F.col(c).alias(f"{c}_{s}") for c in ("gene", "position", "alt_aa", "hgvs_p")])
    first, second = (F.struct(*[F.col(f"{c}_{s}") for c in ("gene", "position", "alt_aa")]) for s in "ab")
    pairs = side("a").join(side("b"), key).where(first < second)
    return pairs.join(genomes.select(*key, "collection_year", "collection_country"), key)


def latest_observation(profile: DataFrame) -> DataFrame:
    """The latest call of each variant; a call without date counts as latest. Ties go to the smallest accession, then type."""
    keys = [*SCOPE, "gene", "position", "ref_aa", "alt_aa"]
    order = W.partitionBy(*keys).orderBy(F.col("collection_date").desc_nulls_first(), "genome_accession", "variant_type", "hgvs_p")
    return profile.withColumn("_place", F.row_number().over(order)).where("_place = 1").select(*keys, "variant_type", "hgvs_p", "genome_accession", "collection_date", "collection_year", "collection_country")


def snapshot(profile: DataFrame, gene_function: DataFrame, associations: DataFrame) -> DataFrame:
    """Calls with gene function and the associations of exactly their mutation, reference residue included.

    The profile is written once, as it is counted and read: it and the other tables should hold no more columns than are asked for.
    """
    a = associations.withColumnRenamed("protein", "gene")
    named = stored(profile, "snapshot-calls").join(F.broadcast(gene_function), ["species_id", "gene"], "left")  # a row per species and gene
    return spread(named, a, ["species_id", "gene", "position", "ref_aa", "alt_aa"], "left")

"""Queries over joins, aggregates, rankings, set operations and upserts, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import evidence as E
from ..operators import joins as J
from ..operators import upserts as U
from ..schemas import MUTATION
from . import views as V
from .domain import GM, GP, PROFILE, PV, RP, Domain

MK = ", ".join(MUTATION)
ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _profile(d: Domain):
    return V.variant_profile(d.calls, d.genomes, d.tasks)


# --- lookups and predicates -------------------------------------------------------------------------------------------


@query(f"WITH {PROFILE}, s AS (SELECT DISTINCT gene, position, alt_aa FROM pv WHERE genome_accession IN ('1', '2', '3', '4', '5')) SELECT {MK}, genome_accession FROM profile JOIN s USING (gene, position, alt_aa)")
def P01_sample_lookup(spark, sf_dir):
    """Catalogue rows of the variants of several samples in one join instead of a query per variant."""
    d = Domain(spark, sf_dir)
    wanted = d.calls.where("genome_accession in ('1', '2', '3', '4', '5')").select("gene", "position", "alt_aa").distinct()
    return _profile(d).join(wanted, ["gene", "position", "alt_aa"]).select(*MUTATION, "genome_accession")


@query(f"WITH {PV}, s AS (SELECT gene, position, alt_aa FROM pv WHERE genome_accession = '7') SELECT {MK}, genome_accession FROM pv WHERE EXISTS (SELECT 1 FROM s WHERE s.gene = pv.gene AND s.position = pv.position AND s.alt_aa = pv.alt_aa)")
def P02_in_semi(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return d.calls.join(d.calls.where("genome_accession = '7'").select("gene", "position", "alt_aa"), ["gene", "position", "alt_aa"], "left_semi").select(*MUTATION, "genome_accession")


@query(f"WITH {GP} SELECT association_id, protein, position, phenotype_category FROM gp WHERE (protein = 'Brand#23' AND position = 10) OR (protein = 'Brand#23' AND position IS NULL) OR phenotype_category IN ('ECONOMY', 'PROMO')")
def P03_disjunctive(spark, sf_dir):
    a = Domain(spark, sf_dir).associations
    exact = (F.col("protein") == "Brand#23") & ((F.col("position") == 10) | F.col("position").isNull())
    return a.where(exact | F.col("phenotype_category").isin("ECONOMY", "PROMO")).select("association_id", "protein", "position", "phenotype_category")


CAT = f"cat AS (SELECT {MK}, count(DISTINCT genome_accession) AS genome_count, list_distinct(list(lineage_id) FILTER (lineage_id IS NOT NULL)) AS lineages FROM profile GROUP BY {MK})"


@query(f"WITH {PROFILE}, {CAT} SELECT {MK}, genome_count FROM cat WHERE list_contains(lineages, 'BUILDING')")
def P04_array_any(spark, sf_dir):
    rows = _profile(Domain(spark, sf_dir)).groupBy(*MUTATION).agg(F.count_distinct("genome_accession").alias("genome_count"), F.collect_set("lineage_id").alias("lineages"))
    return rows.where(F.array_contains("lineages", "BUILDING")).select(*MUTATION, "genome_count")


@query(f"WITH {PROFILE}, {CAT} SELECT {MK}, genome_count FROM cat WHERE list_has_any(lineages, ['BUILDING', 'MACHINERY'])")
def P06_overlap(spark, sf_dir):
    rows = _profile(Domain(spark, sf_dir)).groupBy(*MUTATION).agg(F.count_distinct("genome_accession").alias("genome_count"), F.collect_set("lineage_id").alias("lineages"))
    return rows.where(F.arrays_overlap("lineages", F.array(F.lit("BUILDING"), F.lit("MACHINERY")))).select(*MUTATION, "genome_count")


@query(f"WITH {PV}, dom AS (SELECT DISTINCT p_brand AS dgene, p_size - 2 AS s, p_size + 2 AS e FROM part) SELECT {MK}, genome_accession, s AS domain_start, e AS domain_end FROM pv JOIN dom ON dgene = gene AND position BETWEEN s AND e")
def P08_domain_contains(spark, sf_dir):
    """Calls with the domains of their gene that hold their position, by an interval join in blocks."""
    d = Domain(spark, sf_dir)
    domains = d.raw("part").select(F.col("p_brand").alias("gene"), (F.col("p_size") - 2).alias("start"), (F.col("p_size") + 2).alias("end")).distinct()
    out = J.in_interval(d.calls, domains, ["gene"])
    return out.select(*MUTATION, "genome_accession", F.col("start").alias("domain_start"), F.col("end").alias("domain_end"))


@query("SELECT page_id, url FROM pages WHERE list_has_any([1], [1]) AND (contains(lower(url), 'blog') OR contains(lower(url), 'spam') OR contains(lower(url), 'pills'))")
def P14_any_term(spark, sf_dir):
    url = F.lower("url")
    return Domain(spark, sf_dir).raw("pages").where(F.exists(F.array(F.lit("blog"), F.lit("spam"), F.lit("pills")), lambda t: F.contains(url, t))).select("page_id", "url")


@query("SELECT doc_id, lang FROM documents WHERE list_contains(string_split_regex(lower(text), '[^a-z]+'), 'idiot') AND list_contains(string_split_regex(lower(text), '[^a-z]+'), 'clown')")
def P07_full_text(spark, sf_dir):
    """Boolean full text: every query word is a word of the document."""
    words = F.split(F.lower("text"), "[^a-z]+")
    docs = Domain(spark, sf_dir).raw("documents")
    return docs.where(F.forall(F.array(F.lit("idiot"), F.lit("clown")), lambda q: F.array_contains(words, q))).select("doc_id", "lang")


# --- joins ------------------------------------------------------------------------------------------------------------


@query(f"WITH {GP} SELECT a.association_id, a.record_flagged, EXISTS (SELECT 1 FROM gp b WHERE NOT b.record_flagged AND b.protein = a.protein AND b.position = a.position AND b.alt_aa = a.alt_aa) AS corroborated FROM gp a")
def J10_semi_anti(spark, sf_dir):
    """Whether an unflagged association of the same mutation exists."""
    a = Domain(spark, sf_dir).associations
    return J.corroborated(a, a.where("not record_flagged"), ["protein", "position", "alt_aa"]).select("association_id", "record_flagged", "corroborated")


@query(f"WITH {PV}, {GP} SELECT {MK.replace('position', 'pv.position').replace('alt_aa', 'pv.alt_aa').replace('pathogen_id, species_id', 'pv.pathogen_id, pv.species_id').replace('ref_aa', 'pv.ref_aa')}, genome_accession, EXISTS (SELECT 1 FROM gp WHERE gp.protein = pv.gene AND gp.position = pv.position AND gp.alt_aa = pv.alt_aa) AS is_known FROM pv")
def J11_known_novel(spark, sf_dir):
    d = Domain(spark, sf_dir)
    known = d.associations.select(F.col("protein").alias("gene"), "position", "alt_aa")
    return J.known_novel(d.calls, known, ["gene", "position", "alt_aa"]).select(*MUTATION, "genome_accession", "is_known")


@query("""WITH l AS (SELECT DISTINCT c_mktsegment AS lineage_id FROM customer), k AS (SELECT lineage_id AS key, lineage_id, 0 AS p FROM l UNION ALL SELECT 'Clade ' || lineage_id, lineage_id, 1 FROM l
UNION ALL SELECT 'clade-' || lower(substr(lineage_id, 1, 4)), lineage_id, 2 FROM l), q AS (SELECT DISTINCT CASE o_orderkey % 4 WHEN 0 THEN c_mktsegment WHEN 1 THEN 'Clade ' || c_mktsegment WHEN 2 THEN ' CLADE_' || substr(c_mktsegment, 1, 4) ELSE 'none' END AS label FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT label, (SELECT lineage_id FROM k WHERE k.key = q.label OR (k.key = regexp_replace(regexp_replace(lower(trim(label)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) ORDER BY p, lineage_id LIMIT 1) AS resolved FROM q""")
def J15_alias_match(spark, sf_dir):
    d = Domain(spark, sf_dir)
    lineages = d.raw("customer").select(F.col("c_mktsegment").alias("lineage_id")).distinct()
    lineages = lineages.select("lineage_id", F.concat(F.lit("Clade "), "lineage_id").alias("name"), F.array(F.concat(F.lit("clade "), F.substring("lineage_id", 1, 4))).alias("aliases"))
    label = F.expr("case o_orderkey % 4 when 0 then c_mktsegment when 1 then concat('Clade ', c_mktsegment) when 2 then concat(' CLADE_', substr(c_mktsegment, 1, 4)) else 'none' end")
    rows = d.raw("orders").join(d.raw("customer"), F.expr("o_custkey = c_custkey")).select(label.alias("label")).distinct()
    return J.resolve_lineage(rows, "label", lineages)


@query(f"WITH {GM}, s AS (SELECT genome_accession AS sample, species_id, collection_country, collection_date FROM gm) SELECT sample, g.genome_accession, abs(date_diff('day', g.collection_date, s.collection_date)) AS gap FROM s JOIN gm g USING (species_id, collection_country) WHERE abs(date_diff('day', g.collection_date, s.collection_date)) <= 30 AND g.genome_accession <> sample")
def J20_window_neighbours(spark, sf_dir):
    """Genomes of the same country within 30 days of a sample, by a range join in windows. The pairs grow with the square of the table, the tasks with it."""
    d = Domain(spark, sf_dir)
    g = d.genomes
    s = g.select(F.col("genome_accession").alias("sample"), "species_id", "collection_country", F.col("collection_date").alias("r_date"))
    out = J.within_days(g.select("genome_accession", "species_id", "collection_country", "collection_date"), s, ["species_id", "collection_country"], "collection_date", 30, d.raw("orders").count())
    return out.where("genome_accession <> sample").select("sample", "genome_accession", F.abs(F.datediff("collection_date", "r_date")).cast("long").alias("gap"))


# --- aggregates -------------------------------------------------------------------------------------------------------


@query(f"WITH {PROFILE} SELECT count(DISTINCT genome_accession) AS genomes, min(collection_year) AS first_year, max(collection_year) AS last_year, array_to_string(list_sort(list_distinct(list(coalesce(host, '~')))), ',') AS hosts FROM profile WHERE lineage_id = 'BUILDING'")
def A12_lineage_summary(spark, sf_dir):
    """One row whether or not anything matches; a missing host would stay in the list, last."""
    rows = _profile(Domain(spark, sf_dir)).where("lineage_id = 'BUILDING'")
    hosts = F.array_join(V.distinct_sorted_with_null("host"), ",", "~")
    return rows.agg(F.count_distinct("genome_accession").alias("genomes"), F.min("collection_year").alias("first_year"), F.max("collection_year").alias("last_year"), hosts.alias("hosts"))


@query(f"WITH {GM} SELECT collection_year, count(*) AS genomes FROM gm WHERE lineage_id = 'BUILDING' AND collection_country = 'NATION_3' GROUP BY 1")
def A13_lineage_in_country(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.where("lineage_id = 'BUILDING' and collection_country = 'NATION_3'").groupBy("collection_year").agg(F.count(F.lit(1)).alias("genomes"))


@query(f"WITH {GM} SELECT lineage_id, count(*) AS genomes FROM gm WHERE collection_country = 'NATION_3' GROUP BY 1")
def A14_lineages_in_country(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.where("collection_country = 'NATION_3'").groupBy("lineage_id").agg(F.count(F.lit(1)).alias("genomes"))


@query(f"WITH {GM} SELECT collection_country, count(*) AS genomes FROM gm WHERE collection_country IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def A15_country_top20(spark, sf_dir):
    counts = Domain(spark, sf_dir).genomes.where("collection_country is not null").groupBy("collection_country").agg(F.count(F.lit(1)).alias("genomes"))
    return counts.orderBy(F.col("genomes").desc_nulls_last(), "collection_country").limit(20)


@query(f"WITH {PV} SELECT species_id, gene, count(*) AS variants, count(DISTINCT hgvs_p) AS distinct_variants FROM pv GROUP BY 1, 2")
def A16_variants_per_gene(spark, sf_dir):
    return Domain(spark, sf_dir).calls.groupBy("species_id", "gene").agg(F.count(F.lit(1)).alias("variants"), F.count_distinct("hgvs_p").alias("distinct_variants"))


@query(f"WITH {GM}, c AS (SELECT species_id, collection_country, count(*) AS genomes FROM gm WHERE collection_country IS NOT NULL GROUP BY 1, 2) SELECT *, round(100.0 * CAST(genomes AS DOUBLE) / sum(genomes) OVER (PARTITION BY species_id), 1) AS percent FROM c")
def A17_country_share(spark, sf_dir):
    counts = Domain(spark, sf_dir).genomes.where("collection_country is not null").groupBy("species_id", "collection_country").agg(F.count(F.lit(1)).alias("genomes"))
    return counts.withColumn("percent", F.round(100.0 * F.col("genomes") / F.sum("genomes").over(W.partitionBy("species_id")), 1))


@query(f"WITH {PROFILE} SELECT variant_type, count(DISTINCT collection_country) AS countries, count(DISTINCT lineage_id) AS lineages, count(DISTINCT host) AS hosts FROM profile GROUP BY 1")
def A18_distinct_sources(spark, sf_dir):
    return _profile(Domain(spark, sf_dir)).groupBy("variant_type").agg(*[F.count_distinct(c).alias(a) for c, a in (("collection_country", "countries"), ("lineage_id", "lineages"), ("host", "hosts"))])


@query("SELECT event_type, count(*) AS n, round(sum(value), 2) AS value FROM events WHERE event_type IN ('click', 'purchase') GROUP BY 1")
def A19_whitelist_counts(spark, sf_dir):
    return Domain(spark, sf_dir).raw("events").where(F.col("event_type").isin("click", "purchase")).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("value"))


@query("SELECT CAST(ts AS DATE) AS day, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY CAST(ts AS DATE)) AS BIGINT) AS total FROM events WHERE event_type = 'error' GROUP BY 1")
def W02_cumulative(spark, sf_dir):
    """Running total by day: the window sees one row a day."""
    days = Domain(spark, sf_dir).raw("events").where("event_type = 'error'").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return days.withColumn("total", F.sum("n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS cases, count(*) FILTER (event_type = 'error') AS deaths FROM events GROUP BY 1)
SELECT CAST(sum(cases) AS BIGINT) AS cases, CAST(sum(deaths) AS BIGINT) AS deaths, round(100 * CAST(sum(deaths) AS DOUBLE) / nullif(sum(cases), 0), 2) AS cfr_percent, median(cases) AS median_cases, max(cases) AS max_cases, round(CAST(sum(cases) AS DOUBLE) / nullif(date_diff('day', min(day), max(day)), 0), 4) AS daily_rate FROM d""")
def A24_epidemic_totals(spark, sf_dir):
    days = Domain(spark, sf_dir).raw("events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count_if(F.col("event_type") == "purchase").alias("cases"), F.count_if(F.col("event_type") == "error").alias("deaths"))
    length = F.nullif(F.datediff(F.max("day"), F.min("day")), F.lit(0))
    return days.agg(F.sum("cases").alias("cases"), F.sum("deaths").alias("deaths"), F.round(100 * F.sum("deaths") / F.nullif(F.sum("cases"), F.lit(0)), 2).alias("cfr_percent"), F.median("cases").alias("median_cases"), F.max("cases").alias("max_cases"), F.round(F.sum("cases") / length, 4).alias("daily_rate"))


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1), c AS (SELECT day, sum(n) OVER (ORDER BY day) AS total FROM d),
x AS (SELECT min(day) AS d0, max(day) AS d1, CAST(min_by(total, day) AS DOUBLE) AS t0, CAST(max_by(total, day) AS DOUBLE) AS t1 FROM c)
SELECT round(pow(t1 / t0, 1.0 / date_diff('day', d0, d1)) - 1, 6) AS growth_rate, round(0.693 / (pow(t1 / t0, 1.0 / date_diff('day', d0, d1)) - 1), 4) AS doubling_days FROM x""")
def A25_growth(spark, sf_dir):
    """Growth a day of the running total from first to last day, and the days it takes to double."""
    days = Domain(spark, sf_dir).raw("events").where("event_type = 'signup'").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    total = days.withColumn("total", F.sum("n").over(W.orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)))
    ends = total.agg(F.datediff(F.max("day"), F.min("day")).alias("days"), F.min_by("total", "day").alias("t0"), F.max_by("total", "day").alias("t1"))
    rate = F.pow(F.col("t1") / F.col("t0"), F.lit(1.0) / F.nullif(F.col("days"), F.lit(0))) - 1
    return ends.select(F.round(rate, 6).alias("growth_rate"), F.round(F.try_divide(F.lit(0.693), rate), 4).alias("doubling_days"))


@query(f"WITH {GM}, y AS (SELECT lineage_id, collection_year, count(*) AS n FROM gm WHERE lineage_id IS NOT NULL AND collection_year IS NOT NULL GROUP BY 1, 2) SELECT lineage_id, median(n) AS median_per_year, max(n) AS most, count(*) AS years FROM y GROUP BY 1")
def A26_genomes_per_year(spark, sf_dir):
    years = Domain(spark, sf_dir).genomes.where("lineage_id is not null and collection_year is not null").groupBy("lineage_id", "collection_year").agg(F.count(F.lit(1)).alias("n"))
    return years.groupBy("lineage_id").agg(F.median("n").alias("median_per_year"), F.max("n").alias("most"), F.count(F.lit(1)).alias("years"))


@query(f"WITH {GM}, f AS (SELECT lineage_id, collection_country, min(collection_year) AS y FROM gm WHERE lineage_id IS NOT NULL AND collection_country IS NOT NULL GROUP BY 1, 2) SELECT lineage_id, count(*) AS countries, min(y) AS first_year, max(y) AS last_year, round(count(*) / greatest(CAST(max(y) - min(y) AS DOUBLE), 0.5), 4) AS expansion_rate FROM f GROUP BY 1")
def A27_first_by_country(spark, sf_dir):
    first = Domain(spark, sf_dir).genomes.where("lineage_id is not null and collection_country is not null").groupBy("lineage_id", "collection_country").agg(F.min("collection_year").alias("y"))
    span = F.greatest((F.max("y") - F.min("y")).cast("double"), F.lit(0.5))
    return first.groupBy("lineage_id").agg(F.count(F.lit(1)).alias("countries"), F.min("y").alias("first_year"), F.max("y").alias("last_year"), F.round(F.count(F.lit(1)) / span, 4).alias("expansion_rate"))


@query(f"WITH {PROFILE} SELECT gene, position, alt_aa, CASE WHEN count(DISTINCT collection_year) >= 5 THEN 'continuous' WHEN max(collection_year) - min(collection_year) >= 5 THEN 'intermittent' ELSE 'limited' END AS persistence FROM profile GROUP BY 1, 2, 3")
def A28_persistence(spark, sf_dir):
    span = F.max("collection_year") - F.min("collection_year")
    kind = F.when(F.count_distinct("collection_year") >= 5, "continuous").when(span >= 5, "intermittent").otherwise("limited")
    return _profile(Domain(spark, sf_dir)).groupBy("gene", "position", "alt_aa").agg(kind.alias("persistence"))


@query(f"WITH {PV}, a AS (SELECT gene, count(DISTINCT position) AS p FROM pv WHERE CAST(genome_accession AS BIGINT) % 10 = 0 GROUP BY 1), b AS (SELECT gene, count(DISTINCT position) AS q FROM pv GROUP BY 1) SELECT gene, p AS sample_positions, q AS catalogue_positions, round(CAST(p AS DOUBLE) / q, 4) AS density FROM a JOIN b USING (gene)")
def A29_gene_density(spark, sf_dir):
    """Both counts in one pass over the calls."""
    mine = F.when(F.expr("cast(genome_accession as bigint) % 10 = 0"), F.col("position"))
    rows = Domain(spark, sf_dir).calls.groupBy("gene").agg(F.count_distinct(mine).alias("sample_positions"), F.count_distinct("position").alias("catalogue_positions"))
    return rows.where("sample_positions > 0").withColumn("density", F.round(F.col("sample_positions") / F.col("catalogue_positions"), 4))


@query(f"WITH {GP}, c AS (SELECT species_id, phenotype_category, count(*) AS n FROM gp GROUP BY 1, 2) SELECT species_id, CAST(sum(n) AS BIGINT) AS associations, arg_max(phenotype_category, (n, phenotype_category)) AS top_category FROM c GROUP BY 1")
def A30_phenotype_burden(spark, sf_dir):
    counts = Domain(spark, sf_dir).associations.groupBy("species_id", "phenotype_category").agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy("species_id").agg(F.sum("n").alias("associations"), F.max_by("phenotype_category", F.struct("n", "phenotype_category")).alias("top_category"))


@query(f"WITH {PV}, {GP}, k AS (SELECT genome_accession, EXISTS (SELECT 1 FROM gp WHERE gp.protein = pv.gene AND gp.position = pv.position AND gp.alt_aa = pv.alt_aa) AS known, position % 10 = 0 AS hot FROM pv) SELECT genome_accession, round(avg(CASE WHEN known THEN 0.0 ELSE 1.0 END), 4) AS novelty, round(avg(CASE WHEN hot THEN 1.0 ELSE 0.0 END), 4) AS hotspot_ratio FROM k GROUP BY 1")
def A31_novelty(spark, sf_dir):
    d = Domain(spark, sf_dir)
    rows = J.known_novel(d.calls, d.associations.select(F.col("protein").alias("gene"), "position", "alt_aa"), ["gene", "position", "alt_aa"])
    share = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 4)
    return rows.groupBy("genome_accession").agg(share(~F.col("is_known")).alias("novelty"), share(F.col("position") % 10 == 0).alias("hotspot_ratio"))


@query(f"WITH {GM}, c AS (SELECT species_id, collection_country, count(*) AS n FROM gm WHERE collection_country IS NOT NULL GROUP BY 1, 2) SELECT species_id, collection_country AS origin, round(CAST(n AS DOUBLE) / total, 4) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY species_id) AS total, row_number() OVER (PARTITION BY species_id ORDER BY n DESC, collection_country) AS r FROM c) WHERE r = 1")
def A33_common_country(spark, sf_dir):
    counts = Domain(spark, sf_dir).genomes.where("collection_country is not null").groupBy("species_id", "collection_country").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(W.partitionBy("species_id")), 4))
    return J.first_per(counts, ["species_id"], F.col("n").desc(), "collection_country").select("species_id", F.col("collection_country").alias("origin"), "share")


@query(f"""WITH {GM}, t AS (SELECT species_id, genome_accession, collection_country, row_number() OVER (PARTITION BY species_id ORDER BY collection_date, genome_accession) AS r FROM gm WHERE collection_country IS NOT NULL AND collection_date IS NOT NULL)
SELECT species_id, collection_country, CAST(count(*) AS DOUBLE) / 10 AS probability FROM t WHERE r <= 10 GROUP BY 1, 2""")
def A32_origin_probability(spark, sf_dir):
    """Share of each country among the ten tips that come first."""
    tips = Domain(spark, sf_dir).genomes.where("collection_country is not null and collection_date is not null")
    near = tips.withColumn("r", F.row_number().over(W.partitionBy("species_id").orderBy("collection_date", "genome_accession"))).where("r <= 10")
    shares = near.groupBy("species_id", "collection_country").agg(F.count(F.lit(1)).alias("n"))
    return shares.select("species_id", "collection_country", (F.col("n") / F.sum("n").over(W.partitionBy("species_id"))).alias("probability"))


@query("""WITH c AS (SELECT DISTINCT c_mktsegment AS lineage_id, CASE WHEN c_mktsegment < 'F' THEN 'curated ' || c_mktsegment END AS curated FROM customer), d AS (SELECT c_mktsegment AS lineage_id, count(*) AS n FROM customer GROUP BY 1) SELECT lineage_id, coalesce(curated, 'derived ' || CAST(n AS VARCHAR)) AS description FROM c JOIN d USING (lineage_id)""")
def A34_lineage_metadata(spark, sf_dir):
    """Curated text where there is one, else what the data say."""
    rows = Domain(spark, sf_dir).raw("customer").groupBy(F.col("c_mktsegment").alias("lineage_id")).agg(F.count(F.lit(1)).alias("n"))
    curated = F.when(F.col("lineage_id") < "F", F.concat(F.lit("curated "), "lineage_id"))
    return rows.select("lineage_id", F.coalesce(curated, F.concat(F.lit("derived "), F.col("n").cast("string"))).alias("description"))


@query("SELECT source, count(*) AS reports, array_to_string(list_sort(list_distinct(list(lang))), ',') AS langs, count(*) FILTER (doc_id >= 500) AS recent FROM documents GROUP BY 1")
def A35_source_counts(spark, sf_dir):
    return Domain(spark, sf_dir).raw("documents").groupBy("source").agg(F.count(F.lit(1)).alias("reports"), F.array_join(V.distinct_sorted("lang"), ",").alias("langs"), F.count_if(F.col("doc_id") >= 500).alias("recent"))


@query(f"WITH {GM} SELECT collection_country, min(collection_year) AS first_documented, arg_min(genome_accession, (collection_year, genome_accession)) AS source FROM gm WHERE collection_country IS NOT NULL AND collection_year IS NOT NULL GROUP BY 1")
def A36_earliest_year(spark, sf_dir):
    rows = Domain(spark, sf_dir).genomes.where("collection_country is not null and collection_year is not null")
    return rows.groupBy("collection_country").agg(F.min("collection_year").alias("first_documented"), F.min_by("genome_accession", F.struct("collection_year", "genome_accession")).alias("source"))


@query("SELECT l_orderkey AS sequence, arg_min('set' || CAST(l_suppkey % 5 AS VARCHAR), (coalesce(CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END, 999999999), l_suppkey % 5)) AS assigned FROM lineitem GROUP BY 1")
def A37_argmin_assign(spark, sf_dir):
    """Best dataset by score per sequence; no score counts as worst, ties go to the first dataset."""
    score = F.coalesce(F.nullif("l_tax", F.lit(0.0)), F.lit(999999999.0))
    name = F.concat(F.lit("set"), (F.col("l_suppkey") % 5).cast("string"))
    return Domain(spark, sf_dir).raw("lineitem").groupBy(F.col("l_orderkey").alias("sequence")).agg(F.min_by(name, F.struct(score.alias("s"), (F.col("l_suppkey") % 5).alias("d"))).alias("assigned"))


@query(f"WITH {GM} SELECT DISTINCT species_id FROM gm WHERE completeness = 'complete'")
def A38_unique_species(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.where("completeness = 'complete'").select("species_id").distinct()


@query(f"WITH {GM}, g AS (SELECT species_id, abs(date_diff('day', DATE '1998-01-01', collection_date)) AS gap FROM gm WHERE collection_date IS NOT NULL) SELECT species_id, CAST(min(gap) AS BIGINT) AS nearest_days, CAST(floor(median(gap)) AS BIGINT) AS median_days FROM g GROUP BY 1")
def A39_temporal_gap(spark, sf_dir):
    gap = F.abs(F.datediff("collection_date", F.lit("1998-01-01").cast("date")))
    return Domain(spark, sf_dir).genomes.where("collection_date is not null").groupBy("species_id").agg(F.min(gap).cast("long").alias("nearest_days"), F.floor(F.median(gap)).alias("median_days"))


@query("SELECT user_id, arg_max(value, event_id) AS last_value, arg_min(event_type, event_id) AS first_type FROM events GROUP BY 1")
def A40_fold_parameters(spark, sf_dir):
    """Rows folded into one: the last value wins, and the first route."""
    return Domain(spark, sf_dir).raw("events").groupBy("user_id").agg(F.max_by("value", "event_id").alias("last_value"), F.min_by("event_type", "event_id").alias("first_type"))


@query(f"WITH {GM} SELECT species_id, count(DISTINCT collection_country) AS countries, count(*) AS samples, count(*) FILTER (completeness = 'complete') AS completed FROM gm GROUP BY 1")
def A41_run_summary(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.groupBy("species_id").agg(F.count_distinct("collection_country").alias("countries"), F.count(F.lit(1)).alias("samples"), F.count_if(F.col("completeness") == "complete").alias("completed"))


@query(f"WITH {GM} SELECT collection_country, collection_year, count(*) AS n FROM gm GROUP BY 1, 2")
def A42_country_year(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.groupBy("collection_country", "collection_year").agg(F.count(F.lit(1)).alias("n"))


# --- rankings, windows, limits ----------------------------------------------------------------------------------------

ROUTES = f"""WITH {GM}, t AS (SELECT host, collection_date, genome_accession, collection_country AS c, lag(collection_country) OVER w AS p, row_number() OVER w AS r FROM gm WHERE collection_country IS NOT NULL AND collection_date IS NOT NULL WINDOW w AS (PARTITION BY host ORDER BY collection_date, genome_accession)),
u AS (SELECT host, p || ' -> ' || c AS route, min(r) AS r FROM t WHERE p <> c GROUP BY 1, 2) SELECT host, route FROM (SELECT *, row_number() OVER (PARTITION BY host ORDER BY r) AS k FROM u) WHERE k <= 5"""


@query(ROUTES)
def W03_routes(spark, sf_dir):
    """Changes of country between successive tips, each route once, the first five.

    Tips are put in order within a host and day; a day's first tip follows the last one of the day before that has any, and
    only those last ones (as many as there are days) are put in order by host.
    """
    g = Domain(spark, sf_dir).genomes.where("collection_country is not null and collection_date is not null")
    tips = g.select("host", F.col("collection_date").alias("day"), "genome_accession", F.col("collection_country").alias("c"))
    days = tips.groupBy("host", "day").agg(F.max_by("c", "genome_accession").alias("last"))
    before = days.select("host", "day", F.lag("last").over(W.partitionBy("host").orderBy("day")).alias("before"))
    steps = tips.withColumn("p", F.lag("c").over(W.partitionBy("host", "day").orderBy("genome_accession"))).join(before, ["host", "day"])
    steps = steps.withColumn("p", F.coalesce("p", "before")).where("p <> c")
    routes = steps.groupBy("host", F.concat("p", F.lit(" -> "), "c").alias("route")).agg(F.min(F.struct("day", "genome_accession")).alias("r"))
    return routes.withColumn("k", F.row_number().over(W.partitionBy("host").orderBy("r"))).where("k <= 5").select("host", "route")


@query("SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'tip' ELSE 'catalogue' END AS kind FROM customer")
def W04_preferred(spark, sf_dir):
    """Tips override the catalogue's row of the same id."""
    c = Domain(spark, sf_dir).raw("customer").select(F.col("c_custkey").alias("id"))
    rows = c.where("id % 3 = 0").withColumn("kind", F.lit("tip")).unionByName(c.withColumn("kind", F.lit("catalogue")))
    return J.first_per(rows, ["id"], F.when(F.col("kind") == "tip", 0).otherwise(1))


@query("SELECT event_type, arg_min(event_id, event_id) AS event_id FROM events GROUP BY 1")
def W05_first_by_key(spark, sf_dir):
    return Domain(spark, sf_dir).raw("events").groupBy("event_type").agg(F.min("event_id").alias("event_id"))


@query("SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS r FROM events) WHERE r = 1")
def W06_best_by_score(spark, sf_dir):
    rows = Domain(spark, sf_dir).raw("events").select("user_id", "event_id", "value")
    return J.best_per(rows, ["user_id"], F.col("value"), "event_id")


@query(f"WITH {GM}, r AS (SELECT species_id, collection_country, genome_accession, row_number() OVER (PARTITION BY species_id, collection_country ORDER BY md5('42' || genome_accession)) AS k FROM gm WHERE collection_country IS NOT NULL) SELECT species_id, genome_accession FROM (SELECT *, row_number() OVER (PARTITION BY species_id ORDER BY k, md5('42' || genome_accession)) AS j FROM r) WHERE j <= 8")
def W08_diverse_sample(spark, sf_dir):
    """Eight genomes a species, one per country before any second one, by a seeded digest."""
    g = Domain(spark, sf_dir).genomes.where("collection_country is not null").withColumn("h", F.md5(F.concat(F.lit("42"), "genome_accession")))
    g = g.withColumn("k", F.row_number().over(W.partitionBy("species_id", "collection_country").orderBy("h")))
    return g.withColumn("j", F.row_number().over(W.partitionBy("species_id").orderBy("k", "h"))).where("j <= 8").select("species_id", "genome_accession")


@query(f"WITH {PROFILE}, c AS (SELECT hgvs_p, variant_type, count(DISTINCT genome_accession) AS genomes FROM profile WHERE lineage_id = 'BUILDING' GROUP BY 1, 2) SELECT * FROM c ORDER BY genomes DESC, hgvs_p, variant_type LIMIT 20")
def T01_top_defining(spark, sf_dir):
    counts = _profile(Domain(spark, sf_dir)).where("lineage_id = 'BUILDING'").groupBy("hgvs_p", "variant_type").agg(F.count_distinct("genome_accession").alias("genomes"))
    return counts.orderBy(F.col("genomes").desc_nulls_last(), "hgvs_p", "variant_type").limit(20)


COMPARED = f"""WITH {GM}, {RP}, k AS (SELECT DISTINCT collection_country AS c, collection_year AS y FROM gm),
x AS (SELECT c, y, ordinal, (CASE WHEN c = country THEN 2.0 ELSE 0.0 END) + (CASE WHEN abs(y - year) <= 5 THEN 2.0 WHEN abs(y - year) <= 10 THEN 1.0 ELSE 0.0 END) + (CASE WHEN cases > 0 THEN 0.5 ELSE 0.0 END) AS score FROM k, rp),
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c, y ORDER BY score DESC, ordinal) AS r FROM x WHERE score > 0) WHERE r <= 5)
SELECT genome_accession AS sample, ordinal AS outbreak, score FROM gm JOIN b ON gm.collection_country IS NOT DISTINCT FROM b.c AND gm.collection_year IS NOT DISTINCT FROM b.y"""


@query(COMPARED)
def E22_comparative_outbreaks(spark, sf_dir):
    """The five most similar of all reported outbreaks for every genome, by country, year and cases."""
    d = Domain(spark, sf_dir)
    s = d.genomes.select(F.col("genome_accession").alias("sample"), F.col("collection_country").alias("country"), F.col("collection_year").alias("year"))
    return E.comparative_outbreaks(s, d.reports.select(F.col("ordinal").alias("outbreak"), "country", "year", "cases"))


@query(f"{COMPARED.replace('SELECT genome_accession AS sample, ordinal AS outbreak, score', 'SELECT genome_accession AS sample, r AS place, ordinal AS outbreak')}")
def T04_similar_outbreaks(spark, sf_dir):
    """The same five in order."""
    found = E22_comparative_outbreaks(spark, sf_dir)
    place = F.row_number().over(W.partitionBy("sample").orderBy(F.col("score").desc(), "outbreak"))
    return found.select("sample", place.alias("place"), "outbreak")


# --- sets and upserts -------------------------------------------------------------------------------------------------

SETS = f"WITH {GM}, r AS (SELECT species_id, list_distinct(list(collection_country) FILTER (collection_country IS NOT NULL)) AS reported, coalesce(list_distinct(list(collection_country) FILTER (collection_country IS NOT NULL AND collection_year >= 2001)), []) AS recent FROM gm GROUP BY 1)"


@query(f"{SETS} SELECT species_id, coalesce(array_to_string(list_sort(list_filter(reported, lambda x: NOT list_contains(recent, x) AND x <> 'NATION_3')), ','), '') AS missing FROM r")
def U02_coverage_gap(spark, sf_dir):
    rows = Domain(spark, sf_dir).genomes.groupBy("species_id").agg(F.collect_set("collection_country").alias("reported"), F.collect_set(F.when(F.col("collection_year") >= 2001, F.col("collection_country"))).alias("recent"))
    gap = F.array_except(F.array_except("reported", "recent"), F.array(F.lit("NATION_3")))
    return rows.select("species_id", F.array_join(F.array_sort(gap), ",").alias("missing"))


@query(f"{SETS} SELECT species_id, array_to_string(list_sort(list_distinct(list_concat(recent, ['NATION_3', 'NATION_99']))), ',') AS countries FROM r")
def U06_array_merge(spark, sf_dir):
    rows = Domain(spark, sf_dir).genomes.groupBy("species_id").agg(F.collect_set(F.when(F.col("collection_year") >= 2001, F.col("collection_country"))).alias("recent"))
    return rows.select("species_id", F.array_join(F.array_sort(F.array_union("recent", F.array(F.lit("NATION_3"), F.lit("NATION_99")))), ",").alias("countries"))


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 4 = 0 THEN 'O' ELSE o_orderstatus END AS status, o_orderpriority AS kept FROM orders UNION ALL SELECT -1, 'N', 'new'")
def K01_upsert_genome(spark, sf_dir):
    """A batch changes the status of every fourth genome and brings one more; other columns of known genomes stay."""
    o = Domain(spark, sf_dir).raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("kept"))
    batch = o.where("id % 4 = 0").select("id", F.lit("O").alias("status"), F.lit("changed").alias("kept")).unionByName(spark.createDataFrame([(-1, "N", "new")], "id long, status string, kept string"))
    return U.upsert(o, batch, ["id"], ["status"])


@query(f"WITH {PROFILE} SELECT {MK}, count(DISTINCT genome_accession) AS genome_count, min(collection_date) AS first_seen, max(collection_date) AS last_seen, coalesce(array_to_string(list_sort(list_distinct(list(lineage_id) FILTER (lineage_id IS NOT NULL))), ','), '') AS lineages FROM profile GROUP BY {MK}")
def K02_incremental_catalogue(spark, sf_dir):
    """Two batches merged, the second one twice: the same as one pass over all."""
    d = Domain(spark, sf_dir)
    p = _profile(d)
    odd = U.catalogue_state(p.where("cast(genome_accession as bigint) % 2 = 1"))
    even = U.catalogue_state(p.where("cast(genome_accession as bigint) % 2 = 0"))
    return U.catalogue(odd, even, even, tasks=d.tasks).select(*MUTATION, "genome_count", "first_seen", "last_seen", F.array_join("lineages", ",").alias("lineages"))


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 2 = 0 THEN 'old' ELSE 'new' END AS version FROM part")
def K04_insert_absent(spark, sf_dir):
    parts = Domain(spark, sf_dir).raw("part").select(F.col("p_partkey").alias("id"))
    return U.insert_absent(parts.where("id % 2 = 0").withColumn("version", F.lit("old")), parts.withColumn("version", F.lit("new")), ["id"])


@query("SELECT o_orderkey AS id, CASE WHEN o_orderkey % 10 = 0 THEN 'X' ELSE o_orderstatus END AS lineage_id FROM orders")
def K06_point_update(spark, sf_dir):
    o = Domain(spark, sf_dir).raw("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("lineage_id"))
    return U.point_update(o, o.where("id % 5 = 0").withColumn("lineage_id", F.when(F.col("id") % 10 == 0, "X")), "id", "lineage_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS r FROM events) WHERE r = 1")
def K07_latest_wins(spark, sf_dir):
    return U.latest_wins(Domain(spark, sf_dir).raw("events").select("user_id", "event_id", "event_type"), ["user_id"], "event_id")


@query(f"WITH {GP} SELECT association_id, CASE WHEN CAST(association_id AS BIGINT) % 9 = 0 THEN 'rejected' WHEN CAST(association_id AS BIGINT) % 2 = 0 THEN 'verified' ELSE 'unverified' END AS status FROM gp")
def K11_verification(spark, sf_dir):
    a = Domain(spark, sf_dir).associations
    known = a.where("cast(association_id as bigint) % 2 = 0 or cast(association_id as bigint) % 9 = 0").select(F.col("association_id").alias("pmid"), F.expr("cast(association_id as bigint) % 9 <> 0").alias("valid"))
    return U.verification_status(a, known)

"""Queries over candidates, features, genome records, assembled evidence and refreshed views, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import evidence as E
from ..operators import joins as J
from ..operators import mining as M
from ..operators import sequence as Q
from ..sources import sinks
from . import views as V
from .domain import GM, PROFILE, PV, RP, Domain

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("SELECT n_nationkey, upper(n_name) AS name FROM nation")
def S12_entity_views(spark, sf_dir):
    """Entity tables written, opened as views, and asked in SQL."""
    from ..sources import readers

    d = Domain(spark, sf_dir)
    folder = f"{sinks.shared_folder(spark)}/entities-{uuid.uuid4().hex}"
    sinks.write_entities({"nation_entity": d.raw("nation")}, folder)
    readers.entity_views(spark, folder, ["nation_entity"])
    return spark.sql("SELECT n_nationkey, upper(n_name) AS name FROM nation_entity")


@query(f"WITH {GM} SELECT species_id, collection_year, count(*) AS n FROM gm GROUP BY 1, 2")
def K13_refresh_all(spark, sf_dir):
    """Two views refreshed in order; the second one is read."""
    d = Domain(spark, sf_dir)
    trends = lambda: d.genomes.groupBy("species_id", "collection_year").agg(F.count(F.lit(1)).alias("n"))
    return sinks.refresh_all([("mv_species", lambda: V.species_summary(d.genomes).select("species_id", "collection_year", "total_genomes")), ("mv_years", trends)], "species_id", ["collection_year"])["mv_years"].select("species_id", "collection_year", "n")


@query(f"WITH {GM} SELECT genome_accession AS sample_id, unnest(['metric_year', 'metric_host']) AS metric, unnest([CAST(collection_year AS VARCHAR), host]) AS value FROM gm")
def K17_metrics_long(spark, sf_dir):
    """Metrics as a long table."""
    g = Domain(spark, sf_dir).genomes
    return g.select(F.col("genome_accession").alias("sample_id"), F.expr("stack(2, 'metric_year', cast(collection_year as string), 'metric_host', host) as (metric, value)"))


@query(f"WITH {PROFILE} SELECT DISTINCT id, kind FROM (SELECT hgvs_p AS id, 'variant' AS kind FROM profile UNION ALL SELECT variant_type, 'phenotype' FROM profile UNION ALL SELECT lineage_id, 'lineage' FROM profile UNION ALL SELECT collection_country, 'outbreak' FROM profile) WHERE id IS NOT NULL")
def K20_network_nodes(spark, sf_dir):
    d = Domain(spark, sf_dir)
    rows = V.variant_profile(d.calls, d.genomes, d.tasks).select(F.col("hgvs_p").alias("variant"), F.col("variant_type").alias("phenotype"), F.col("lineage_id").alias("lineage"), F.col("collection_country").alias("outbreak"))
    return E.network(rows)[0]


@query("SELECT n_regionkey, n_name, n_nationkey + 1.0 AS root_distance FROM (SELECT *, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey, n_name) AS r FROM nation) WHERE r <= 2")
def T03_nearest_to_root(spark, sf_dir):
    """The tips nearest to the root (not to the sample, which is another distance)."""
    tips = Domain(spark, sf_dir).raw("nation").select("n_regionkey", "n_name", (F.col("n_nationkey") + 1.0).alias("root_distance"))
    from pyspark.sql import Window as W

    return tips.withColumn("r", F.row_number().over(W.partitionBy("n_regionkey").orderBy("root_distance", "n_name"))).where("r <= 2").drop("r")


@query(f"WITH {PV} SELECT gene, count(*) AS n FROM pv GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def T08_top_bars(spark, sf_dir):
    return Domain(spark, sf_dir).calls.groupBy("gene").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "gene").limit(20)


@query("SELECT user_id, min(event_id) AS first FROM events GROUP BY 1")
def U07_ordered_dedup(spark, sf_dir):
    return J.first_per(Domain(spark, sf_dir).raw("events").select("user_id", F.col("event_id").alias("first")), ["user_id"], "first")


@query("SELECT o_orderkey AS sample_id, o_totalprice > 100000 AS recent, sum(l_quantity) AS cases FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def A23_cases_per_group(spark, sf_dir):
    d = Domain(spark, sf_dir)
    rows = d.raw("orders").join(d.raw("lineitem"), F.expr("l_orderkey = o_orderkey"))
    return rows.groupBy(F.col("o_orderkey").alias("sample_id"), (F.col("o_totalprice") > 100000).alias("recent")).agg(F.sum("l_quantity").alias("cases"))


@query(f"""WITH {PROFILE}, s AS (SELECT genome_accession, array_to_string(list_sort(list_distinct(list(hgvs_p))), ',') AS variants, array_to_string(list_sort(list_distinct(list('P:' || variant_type))), ',') AS phenotypes FROM profile GROUP BY 1), o AS (SELECT collection_country AS outbreak, lineage_id FROM gm WHERE lineage_id IS NOT NULL AND lineage_id <> 'BUILDING' AND collection_country IS NOT NULL), m AS (SELECT lineage_id, list_sort(list_distinct(list(outbreak))) AS l FROM o GROUP BY 1), e AS (SELECT list_sort(list_distinct(list(outbreak))) AS l FROM o)
SELECT genome_accession AS sample_id, gm.lineage_id, array_to_string(coalesce(m.l, e.l), ',') AS outbreaks, s.variants, s.phenotypes FROM gm JOIN s USING (genome_accession) LEFT JOIN m USING (lineage_id), e WHERE gm.lineage_id IS NOT NULL""")
def J19_harmonised(spark, sf_dir):
    """Evidence per sample; a lineage without outbreaks of its own gets all of them."""
    d = Domain(spark, sf_dir)
    v = V.variant_profile(d.calls, d.genomes, d.tasks).where("lineage_id is not null").select(F.col("genome_accession").alias("sample_id"), "lineage_id", "hgvs_p", F.col("variant_type").alias("phenotype_key"))
    p = v.select("phenotype_key").distinct().withColumn("phenotype", F.concat(F.lit("P:"), "phenotype_key"))
    o = d.genomes.where("lineage_id is not null and lineage_id <> 'BUILDING' and collection_country is not null").select(F.col("collection_country").alias("outbreak"), "lineage_id").distinct()
    samples, lists = E.harmonise(v, p, o)
    said = lists.groupBy("list_key").agg(F.array_join(F.array_sort(F.collect_list("outbreak")), ",").alias("outbreaks"))  # of countries, to be held against SQL
    joined = [F.array_join(c, ",").alias(c) for c in ("variants", "phenotypes")]
    return samples.join(F.broadcast(said), "list_key").select("sample_id", "lineage_id", "outbreaks", *joined)


@query(f"WITH {RP} SELECT ordinal AS id, w AS name FROM rp, (VALUES ('PCR'), ('ELISA'), ('funeral')) t(w) WHERE regexp_matches(lower(text), '(^|[^a-z0-9_])' || lower(w) || '($|[^a-z0-9_])')")
def X15_names(spark, sf_dir):
    return M.whole_names(Domain(spark, sf_dir).reports.select(F.col("ordinal").alias("id"), "text"), ["PCR", "ELISA", "funeral"])


# The categories that the driver's report texts meet, by what each kind of report says (ordinal % 6).
_CANDIDATES = f"""WITH {RP}, c(kind_of_report, category) AS (VALUES (0, 'disease_severity'), (0, 'vaccine_effectiveness'), (1, 'diagnostic_performance'), (2, 'drug_resistance'), (3, 'increased_transmission'), (3, 'decreased_transmission'), (3, 'immune_escape'), (4, 'reservoir_association'), (4, 'diagnostic_performance')),
n AS (SELECT ordinal, unnest(CASE WHEN ordinal % 2 = 1 THEN [('variant', 'A82V'), ('motif', 'mucin')] ELSE [('variant', 'A82V')] END) AS x FROM rp)
SELECT ordinal AS id, x[1] AS kind, x[2] AS name, category, 'gpa_' || substr(sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(CAST(ordinal AS VARCHAR) || '|' || x[1] || '|' || x[2] || '|' || category)), 1, 12) AS association_id FROM n JOIN c ON ordinal % 6 = kind_of_report"""


@query(_CANDIDATES)
def X16_candidates(spark, sf_dir):
    """Every report's variants, motifs and clades with every phenotype that it tells of."""
    r = Domain(spark, sf_dir).reports.select(F.col("ordinal").alias("id"), "text")
    named = lambda n, c="true": r.where(c).select("id", F.lit(n).alias("name"))
    out = M.candidates(named("A82V"), named("mucin", "id % 2 = 1"), named("none", "false"), M.phenotypes(r))
    return out.select("id", "kind", "name", "category", "association_id")


@query(f"WITH {RP} SELECT ordinal, ordinal % 7 < 4 AS antibody FROM rp")
def X17_antibody_context(spark, sf_dir):
    """Reports end in a residue's context: those of antibodies in four ways, and three that look alike."""
    endings = "array(' light-chain A82V', ' Heavy chain', ' A82V - VL', ' adi-15878', ' A82V of GP', ' chain of command', ' frameworks')"
    context = F.concat("text", F.expr(f"element_at({endings}, cast(ordinal % 7 + 1 as int))"))
    return Domain(spark, sf_dir).reports.select("ordinal", M.antibody_context(context).alias("antibody"))


@query("SELECT p_partkey AS entry, p_size AS position, CASE p_partkey % 4 WHEN 0 THEN 'immune_escape' WHEN 1 THEN 'disease_severity' ELSE 'unknown_significance' END AS category FROM part WHERE p_partkey % 4 <> 3")
def X18_feature_associations(spark, sf_dir):
    text = F.expr("case p_partkey % 4 when 0 then 'Escapes neutralizing sera' when 1 then 'Increased virulence' when 2 then 'Site' else 'No effect on binding' end")
    p = Domain(spark, sf_dir).raw("part").select(F.col("p_partkey").alias("entry"), F.col("p_size").alias("position"), F.lit("A").alias("ref"), F.lit("V").alias("alt"), text.alias("description"))
    return M.feature_associations(p).select("entry", "position", "category")


@query("""SELECT p_partkey AS id, 0 AS passage, p_name AS passage_text, 'Mutation' AS type, p_type AS identifier, p_size AS "offset" FROM part
UNION ALL SELECT p_partkey, 1, p_type, 'Gene', p_brand, p_size + 1 FROM part UNION ALL SELECT p_partkey, 1, p_type, 'Species', 'x' || CAST(p_partkey AS VARCHAR), 0 FROM part WHERE p_partkey % 3 = 0""")
def X21_annotations(spark, sf_dir):
    """Literature records, passages and annotations exploded."""
    from ..sources import readers

    noted = "named_struct('type', '{}', 'identifier', {}, 'offset', cast({} as bigint))"
    mutation, gene, species = noted.format("Mutation", "p_type", "p_size"), noted.format("Gene", "p_brand", "p_size + 1"), noted.format("Species", "concat('x', p_partkey)", "0")
    passages = f"array(named_struct('text', p_name, 'annotations', array({mutation})), named_struct('text', p_type, 'annotations', if(p_partkey % 3 = 0, array({gene}, {species}), array({gene}))))"
    return readers.annotations(Domain(spark, sf_dir).raw("part").selectExpr("p_partkey as id", f"{passages} as passages"))


@query("SELECT CAST(l_orderkey AS VARCHAR) AS genome_accession, 'G' || CAST(l_linenumber % 3 AS VARCHAR) AS gene FROM lineitem GROUP BY 1, 2")
def Q02_coding_sequences(spark, sf_dir):
    """The first coding sequence of each gene, by qualifier or by product."""
    f = Domain(spark, sf_dir).raw("lineitem").select(F.col("l_orderkey").cast("string").alias("genome_accession"), F.col("l_partkey").alias("ordinal"), F.when(F.col("l_linenumber") % 3 != 0, F.concat(F.lit("G"), (F.col("l_linenumber") % 3).cast("string"))).alias("gene"), F.lit(" Zero ").alias("product"), F.lit("MA").alias("protein"))
    return Q.coding_sequences(f, {"zero": "G0"}).select("genome_accession", "gene")


@query()
def Q03_best_frames(spark, sf_dir):
    """The best frame of each gene of the species in every genome (a part), which codes for a protein: every residue spelled by one of its codons.

    The smallest part of a species and brand gives the reference protein of that gene.
    """
    d = Domain(spark, sf_dir)
    protein = F.repeat(F.rpad(F.upper(F.regexp_replace("p_name", "[^ACDEFGHIKLMNPQRSTVWYacdefghiklmnpqrstvwy]", "")), 20, "ACDEFGHIKLMNPQRSTVWY"), 9)
    codon = {}
    for c, a in Q.CODONS.items():
        codon.setdefault(a, c)
    names = F.create_map(*[F.lit(x) for pair in codon.items() for x in pair])
    p = d.raw("part").join(F.broadcast(d.raw("region")), F.expr("r_regionkey = p_partkey % 5"))
    rows = p.select("p_partkey", F.col("p_partkey").cast("string").alias("genome_accession"), F.col("r_name").alias("species_id"), F.col("p_brand").alias("gene"), protein.alias("protein"))
    dna = F.array_join(F.transform(F.filter(F.split("protein", ""), lambda c: c != ""), lambda c: F.try_element_at(names, c)), "")
    proteins = rows.groupBy("species_id", "gene").agg(F.min_by("protein", "p_partkey").alias("protein"))  # species and brands are dimensions of fixed size
    return Q.best_genes(rows.withColumn("dna", dna), F.broadcast(proteins)).select("genome_accession", "gene", F.round("score", 4).alias("score"))


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS genome_accession, CASE WHEN o_orderkey % 9 <> 0 THEN CAST(o_orderdate AS DATE) END AS collection_date,
CASE WHEN o_orderkey % 9 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) WHEN o_orderkey % 2 = 0 THEN 2014 END AS collection_year, n_name AS collection_country, CASE WHEN o_orderkey % 3 <> 0 THEN c_mktsegment END AS collection_region,
CASE WHEN o_orderkey % 4 <> 1 THEN chr(65 + CAST(o_orderkey % 26 AS INTEGER)) || 'LI' END AS collection_country_code, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS host,
CASE WHEN o_orderkey % 2 = 0 THEN 'complete' ELSE 'partial' END AS completeness FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""")
def Q04_genome_metadata(spark, sf_dir):
    """Records with and without a date, a year in the isolate's name, a region, a country's code, a host."""
    d = Domain(spark, sf_dir)
    o = d.raw("orders").join(d.raw("customer"), F.expr("o_custkey = c_custkey")).join(F.broadcast(d.raw("nation")), F.expr("c_nationkey = n_nationkey"))
    records = o.selectExpr(
        "cast(o_orderkey as string) as accession", "if(o_orderkey % 2 = 0, 18900, 5000) as length", "'x' as description", "if(o_orderkey % 3 = 0, n_name, concat(n_name, ': ', c_mktsegment)) as country",
        "if(o_orderkey % 9 = 0, '', date_format(o_orderdate, 'd-MMM-yyyy')) as collected", "if(o_orderkey % 5 = 0, ' ', concat(' ', o_orderpriority)) as host",
        "concat('EBOV/H.sap/', if(o_orderkey % 4 = 1, '', concat(char(65 + o_orderkey % 26), 'LI/')), if(o_orderkey % 2 = 0, '2014', '14')) as isolate",
    )
    return Q.genome_metadata(records)


@query(f"WITH {PV} SELECT genome_accession AS sample_id, round(avg(CASE WHEN position % 3 = 0 THEN 0.0 ELSE 1.0 END), 4) AS novelty, round(avg(CASE WHEN position % 10 = 0 THEN 1.0 ELSE 0.0 END), 4) AS hotspot_ratio, CAST(count(*) AS DOUBLE) AS burden, avg(CASE WHEN position % 3 = 0 THEN 0.0 ELSE 1.0 END) > 0.3 AS novel_finding FROM pv GROUP BY 1")
def E16_genomic_signal(spark, sf_dir):
    v = Domain(spark, sf_dir).calls.selectExpr("genome_accession as sample_id", "position % 3 = 0 as is_known", "position % 10 = 0 as is_hotspot", "19000 as sample_length")
    return E.genomic_signal(v)


@query("""SELECT c_custkey AS sample_id, 'origin_travel' AS "check", CASE WHEN c_custkey % 3 = 0 THEN 'consistent' WHEN c_custkey % 3 = 1 THEN 'inconsistent' ELSE 'unknown' END AS state FROM customer
UNION ALL SELECT c_custkey, 'persistence_relatedness', CASE WHEN (c_custkey % 2 = 0) = (c_custkey % 400 <= 180) THEN 'consistent' ELSE 'inconsistent' END FROM customer UNION ALL SELECT c_custkey, 'known_novel', CASE WHEN c_custkey % 7 >= 3 THEN 'consistent' ELSE 'inconsistent' END FROM customer""")
def E20_consistency(spark, sf_dir):
    rows = Domain(spark, sf_dir).raw("customer").selectExpr("c_custkey as sample_id", "'DRC' as origin", "case c_custkey % 3 when 0 then 'Democratic Republic of the Congo' when 1 then 'Mali' end as travel", "c_custkey % 2 = 0 as persistent", "c_custkey % 400 as close_days", "c_custkey % 7 as known", "3 as novel")
    return E.consistency(rows)


@query(f"WITH {GM} SELECT genome_accession AS sample_id, concat_ws('; ', CASE WHEN collection_date IS NULL THEN 'when' END, CASE WHEN collection_country IS NULL THEN 'where' END) AS gaps FROM gm")
def E21_knowledge_gaps(spark, sf_dir):
    return E.knowledge_gaps(Domain(spark, sf_dir).genomes.withColumnRenamed("genome_accession", "sample_id"), {"collection_date": "when", "collection_country": "where"})


@query(f"""WITH {GM}, s AS (SELECT *, species_id || ' ' || CAST(collection_date AS VARCHAR) AS scope FROM gm),
r AS (SELECT CAST(l_orderkey AS VARCHAR) AS sample_id, l_linenumber AS analysis, l_suppkey AS place, 'flags ' || l_returnflag || l_linestatus AS gap FROM lineitem WHERE l_quantity >= 8),
u AS (SELECT sample_id, list(gap ORDER BY analysis, place, gap) AS told FROM (SELECT *, row_number() OVER (PARTITION BY sample_id, gap ORDER BY analysis, place) AS n FROM r) WHERE n = 1 GROUP BY 1),
g AS (SELECT genome_accession AS sample_id, list_concat(coalesce(told, []), list_filter([
  CASE WHEN collection_date IS NULL THEN 'Sample collection date is missing; temporal analyses are limited.' END,
  CASE WHEN collection_country IS NULL THEN 'Sample country is missing; geographic analyses are limited.' END,
  CASE WHEN host IN ('1-URGENT', '5-LOW') THEN 'Suspected exposure route is missing; transmission hypotheses cannot be refined.' END,
  CASE WHEN lineage_id IS NULL THEN 'Travel history is missing; importation risk is harder to assess.' END,
  CASE WHEN scope IS NULL OR scope NOT IN (SELECT scope FROM s WHERE scope IS NOT NULL AND completeness = 'complete') THEN 'No species outbreak records in epi output; epidemic dynamics are inferred from curated genomes only.' END,
  CASE WHEN scope IS NULL OR scope NOT IN (SELECT scope FROM s WHERE scope IS NOT NULL AND host = '2-HIGH') THEN 'No transmission parameters (R0, serial interval) in epi output; transmission potential cannot be quantified.' END,
  CASE WHEN completeness = 'partial' AND (host <> '3-MEDIUM' OR lineage_id IS NULL) THEN 'No phylogenetic tree or placement provided; molecular-clock and relatedness analyses rely on metadata.'
    WHEN completeness <> 'complete' THEN 'No time-scaled phylogeny available; molecular-clock dating is not possible.' END,
  CASE WHEN collection_year IS NULL OR collection_year % 2 = 1 OR lineage_id IS NULL THEN 'No closest reference genome information; assembly context is incomplete.' END], lambda x: x IS NOT NULL)) AS gaps
  FROM s LEFT JOIN u ON u.sample_id = s.genome_accession)
SELECT sample_id, array_to_string(gaps, ' | ') AS gaps, CAST(len(gaps) AS BIGINT) AS gap_count, 'Knowledge gaps: ' || len(gaps) || ' cross-cutting gaps identified.' AS summary FROM g""")
def E21_gap_report(spark, sf_dir):
    """Gaps that analyses reported (of every call's flags) once each, then those of the record, of reports by species and day, and of the tree."""
    d = Domain(spark, sf_dir)
    samples = d.genomes.selectExpr(
        "genome_accession as sample_id", "concat(species_id, ' ', collection_date) as scope", "collection_date", "collection_country as country", "case host when '1-URGENT' then null when '5-LOW' then ' ' else host end as suspected_exposure",
        "lineage_id as travel_history", "if(completeness = 'partial', '', completeness) as tree_file", "if(host = '3-MEDIUM', lineage_id, null) as placement", "if(completeness = 'complete', completeness, null) as time_scaled_tree",
        "if(collection_year % 2 = 0, lineage_id, null) as closest_reference", "completeness", "host")
    gap = "case when l_quantity >= 8 then concat('flags ', l_returnflag, l_linestatus) when l_quantity >= 4 then '' end as gap"
    reported = d.raw("lineitem").selectExpr("cast(l_orderkey as string) as sample_id", "l_linenumber as analysis", "l_suppkey as place", gap)
    found = E.gap_report(samples, reported, samples.where("completeness = 'complete'"), samples.where("host = '2-HIGH'"), by="scope")
    return found.withColumn("gaps", F.array_join("gaps", " | "))


@query(f"WITH {PROFILE}, c AS (SELECT species_id, hgvs_p, variant_type, count(DISTINCT genome_accession) AS genome_count, min(collection_date) AS first_seen FROM profile GROUP BY 1, 2, 3) SELECT genome_accession, species_id, hgvs_p, variant_type, genome_count, first_seen FROM profile JOIN c USING (species_id, hgvs_p, variant_type)")
def E26_enrichment(spark, sf_dir):
    d = Domain(spark, sf_dir)
    p = V.variant_profile(d.calls, d.genomes, d.tasks)
    keys = ["species_id", "hgvs_p", "variant_type"]
    p = J.hashed(p.select("genome_accession", *keys, "collection_date"), d.tasks, *keys)
    known = p.groupBy(*keys).agg(F.count_distinct("genome_accession").alias("genome_count"), F.min("collection_date").alias("first_seen"))
    return p.join(known, keys, "left").select("genome_accession", *keys, "genome_count", "first_seen")


@query("""SELECT c_custkey AS sample_id, CASE WHEN c_custkey % 5 = 0 THEN 'urgent' WHEN c_custkey % 5 < 4 THEN 'routine' END AS tier, CASE WHEN c_custkey % 5 < 4 THEN c_mktsegment END AS reasons,
'[{"analysis":"genetic_relatedness","finding_type":"' || CASE WHEN c_custkey % 7 = 0 THEN 'no_relatedness","confidence":"low' WHEN c_custkey % 12 <= 5 THEN 'close_genetic_match","confidence":"high' ELSE 'genetic_relatedness_summary","confidence":"medium' END || '"}]' AS findings FROM customer""")
def E29_intelligence_object(spark, sf_dir):
    """A document per sample, read back."""
    c = Domain(spark, sf_dir).raw("customer").selectExpr("c_custkey as sample_id", "case when c_custkey % 7 = 0 then null else c_custkey % 12 end as snps", "c_mktsegment as reasons")
    tiers = c.where("sample_id % 5 < 4").selectExpr("sample_id", "if(sample_id % 5 = 0, 'urgent', 'routine') as tier", "reasons")
    docs = E.intelligence_object(c, E.relatedness(c), tiers)
    return docs.select("sample_id", *[F.get_json_object("document", f"$.{k}").alias(k) for k in ("tier", "reasons", "findings")])


@query("""SELECT c_custkey, '# Summary' || chr(10) || c_name || chr(10) || CASE c_custkey % 6 WHEN 2 THEN '## Treatment of cases' || chr(10) || c_mktsegment || chr(10) WHEN 3 THEN '#### Treatment' || chr(10) || c_mktsegment || chr(10) WHEN 4 THEN 'Treatment' || chr(10) || c_mktsegment || chr(10) ELSE '' END
|| CASE WHEN c_custkey % 4 = 0 THEN '' ELSE '## Next' || chr(10) || 'kept' || chr(10) END AS text FROM customer""")
def E32_section_guard(spark, sf_dir):
    """Sections under forbidden headings go, up to the next heading or the end; headings that only look alike stay."""
    headings = "array('## Treatment', '### diagnosis ', '## Treatment of cases', '#### Treatment', 'Treatment', '# DIAGNOSIS')"
    section = F.concat(F.expr(f"element_at({headings}, cast(c_custkey % 6 + 1 as int))"), F.lit("\n"), "c_mktsegment", F.lit("\n"))
    text = F.concat(F.lit("# Summary\n"), "c_name", F.lit("\n"), section, F.when(F.col("c_custkey") % 4 == 0, "").otherwise("## Next\nkept\n"))
    return Domain(spark, sf_dir).raw("customer").select("c_custkey", E.without_sections(text, ("Treatment", "Diagnosis")).alias("text"))


@query(f"WITH {GM} SELECT genome_accession AS sample_id, 0 AS place, CASE WHEN collection_country IS NOT NULL THEN 'What is known of ' || collection_country || '?' ELSE 'Where was it taken?' END AS question FROM gm")
def E33_questions(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.withColumnRenamed("genome_accession", "sample_id")
    return E.questions(g, [("collection_country is not null", "concat('What is known of ', collection_country, '?')", "Where was it taken?")])


@query("SELECT p_partkey, 'A' AS ref, p_size AS position, 'V' AS alt FROM part")
def F03_piped_variant(spark, sf_dir):
    text = F.concat(F.lit("tmVar:p|SUB|A|"), F.col("p_size").cast("string"), F.lit("|V"))
    return Domain(spark, sf_dir).raw("part").select("p_partkey", S.parse_piped_variant(text).alias("m")).select("p_partkey", "m.*")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'democratic republic of the congo' WHEN 1 THEN 'mali' ELSE lower(p_brand) END AS country, 'K: ' || p_type || ' | Other key: ' || p_brand AS content,
'GIB-' || strftime(DATE '2024-01-02' + CAST(p_partkey % 300 AS INTEGER), '%Y%m%d') || '-' || CAST(p_partkey AS VARCHAR) AS run, lower(p_name) AS key, substr(p_name, greatest(p_partkey % 9 - 5, 0) + 1, p_partkey % 9 + 5 - greatest(p_partkey % 9 - 5, 0)) AS around FROM part""")
def F35_presentation(spark, sf_dir):
    """Country spelling, key-value text, run ids, title keys and contexts."""
    content = S.key_value_text(F.create_map(F.lit("other_key"), F.col("p_brand"), F.lit("k"), F.col("p_type")))
    run = S.run_id("GIB", F.expr("date_add(date '2024-01-02', cast(p_partkey % 300 as int))"), F.col("p_partkey").cast("string"))
    country = S.country_name(F.expr("case p_partkey % 3 when 0 then ' DRC' when 1 then 'Mali ' else p_brand end"))
    key = S.title_key(F.concat(F.lit("Update 2014: Ebola virus disease - "), "p_name"))
    p = Domain(spark, sf_dir).raw("part")
    return p.select("p_partkey", country.alias("country"), content.alias("content"), run.alias("run"), key.alias("key"), S.context(F.col("p_name"), (F.col("p_partkey") % 9).cast("int"), 5).alias("around"))


@query(f"WITH {GM} SELECT genome_accession, CAST(abs(date_diff('day', DATE '1998-01-01', collection_date)) AS INTEGER) AS days FROM gm WHERE collection_date IS NOT NULL")
def F16_days_between(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.where("collection_date is not null").select("genome_accession", F.abs(F.datediff("collection_date", F.lit("1998-01-01").cast("date"))).alias("days"))


@query("""WITH p AS (SELECT doc_id, string_split(chr(10) || repeat(coalesce(lang, '') || chr(10), CAST(doc_id % 2 AS INTEGER)) || '### ' || coalesce(source, '') || ' ' || chr(10) || coalesce(text, '') || repeat(chr(10) || '### B', CAST(doc_id % 3 AS INTEGER)), chr(10) || '### ')[2:] AS p FROM documents)
SELECT doc_id, len(p) AS n, trim(split_part(p[1], chr(10), 1)) AS first, substr(p[1], length(split_part(p[1], chr(10), 1)) + 2) AS body, p[-1] AS last FROM p""")
def F32_sections(spark, sf_dir):
    """Sections of every whole text under a heading of its own: with or without words before it, and up to two more headings."""
    none = lambda c: F.coalesce(c, F.lit(""))
    text = F.concat(F.expr("repeat(concat(coalesce(lang, ''), '\n'), cast(doc_id % 2 as int))"), F.lit("### "), none("source"), F.lit(" \n"), none("text"), F.expr("repeat('\n### B', cast(doc_id % 3 as int))"))
    s = S.sections(text)
    return Domain(spark, sf_dir).raw("documents").select("doc_id", F.size(s).alias("n"), F.get(s, F.lit(0))["title"].alias("first"), F.get(s, F.lit(0))["body"].alias("body"), F.element_at(s, -1).alias("z")).select("doc_id", "n", "first", "body", F.when(F.col("n") == 1, F.concat("first", F.lit(" \n"), "body")).otherwise(F.col("z.title")).alias("last"))


@query("SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN 'Africa' WHEN 1 THEN 'Asia' END AS region FROM nation")
def F09_regions(spark, sf_dir):
    name = F.expr("case n_nationkey % 3 when 0 then 'Mali' when 1 then 'Japan' else 'Atlantis' end")
    return Domain(spark, sf_dir).raw("nation").select("n_nationkey", S.region_of(name).alias("region"))


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def F13_report_dates(spark, sf_dir):
    """Feed and ISO dates of one day, read alike."""
    text = F.expr("case o_orderkey % 3 when 0 then date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") when 1 then date_format(o_orderdate, 'E, dd MMM yyyy HH:mm:ss') else date_format(o_orderdate, 'd MMM yyyy') end")
    return Domain(spark, sf_dir).raw("orders").select("o_orderkey", S.report_date(text).cast("date").alias("day"))

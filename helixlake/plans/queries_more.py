"""Further queries: predicates, joins by notation and distance, limits, sets, entities and assembled evidence."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import evidence as E
from ..operators import joins as J
from ..operators import mining as M
from ..operators import sequence as Q
from ..operators import upserts as U
from ..schemas import EVIDENCE_STRENGTH, MUTATION, rank_of
from ..sources import readers, sinks
from . import views as V
from .domain import GF, GM, GP, PROFILE, PV, RP, Domain

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


# --- sources and predicates -------------------------------------------------------------------------------------------


@query(f"WITH {PV} SELECT genome_accession, hgvs_p FROM pv WHERE species_id = 'ASIA'")
def S01_scoped_scan(spark, sf_dir):
    return readers.scoped(Domain(spark, sf_dir).calls, "tpch", "ASIA").select("genome_accession", "hgvs_p")


@query(f"WITH {GM} SELECT species_id, count(*) AS n FROM gm WHERE collection_year >= 1999 GROUP BY 1")
def S02_parameterised_sql(spark, sf_dir):
    Domain(spark, sf_dir).genomes.createOrReplaceTempView("genome_metadata")
    return readers.query(spark, "SELECT species_id, count(*) AS n FROM genome_metadata WHERE collection_year >= :year GROUP BY 1", year=1999)


@query("SELECT count(*) AS n FROM region")
def S04_fallback_chain(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return readers.first_non_empty(lambda: d.raw("region").where("r_regionkey < 0"), lambda: d.raw("region")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {GM} SELECT genome_accession FROM gm WHERE lineage_id = 'BUILDING' ORDER BY collection_date DESC NULLS LAST, genome_accession LIMIT 100")
def S23_lineage_genomes(spark, sf_dir):
    return readers.lineage_genomes(Domain(spark, sf_dir).genomes, "BUILDING", 100).select("genome_accession")


@query(f"WITH {RP} SELECT 'reports' AS source, CAST(ordinal AS VARCHAR) AS item, url, CAST(NULL AS VARCHAR) AS kind FROM rp UNION ALL SELECT 'events', CAST(event_id AS VARCHAR), NULL, event_type FROM events")
def S19_provider_items(spark, sf_dir):
    d = Domain(spark, sf_dir)
    out = readers.provider_items(("reports", d.reports, {"item": "cast(ordinal as string)", "url": "url"}), ("events", d.raw("events"), {"item": "cast(event_id as string)", "kind": "event_type"}))
    return out.select("source", "item", "url", "kind")


@query(f"WITH {PV} SELECT gene, count(*) AS n FROM pv WHERE gene IN ('Brand#3', 'Brand#7') GROUP BY 1")
def P05_gene_set(spark, sf_dir):
    return Domain(spark, sf_dir).calls.where(F.col("gene").isin("Brand#3", "Brand#7")).groupBy("gene").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {GP} SELECT association_id, coalesce(protein || ':' || ref_aa || CAST(position AS VARCHAR) || alt_aa, genotype_description) AS label FROM gp")
def P09_case_label(spark, sf_dir):
    return Domain(spark, sf_dir).associations.select("association_id", V.association_label().alias("label"))


@query(f"WITH {GP} SELECT association_id FROM gp WHERE upper(trim(protein)) = 'BRAND#3'")
def P11_loose_equality(spark, sf_dir):
    return Domain(spark, sf_dir).associations.where(F.upper(F.trim("protein")) == "BRAND#3").select("association_id")


@query(f"WITH {RP} SELECT ordinal FROM rp WHERE contains(lower(text), 'fruit bat') OR NOT (contains(lower(text), 'fruit bat') OR contains(lower(text), 'healthcare') OR contains(lower(text), 'funeral'))")
def P13_keep_species(spark, sf_dir):
    names = {"wanted": ("fruit bat",), "other": ("healthcare", "funeral")}
    return M.keep_species(Domain(spark, sf_dir).reports, names, "wanted").select("ordinal")


@query(f"WITH {GP} SELECT association_id FROM gp WHERE record_flagged AND evidence_strength IN ('strong', 'moderate')")
def P15_partial_predicate(spark, sf_dir):
    return Domain(spark, sf_dir).associations.where(F.col("record_flagged") & F.col("evidence_strength").isin("strong", "moderate")).select("association_id")


@query(f"WITH {PV} SELECT genome_accession, hgvs_p FROM pv WHERE ref_aa <> alt_aa")
def P16_drop_synonymous(spark, sf_dir):
    """Samples' mutations as arrays, exploded, those that change a residue."""
    calls = Domain(spark, sf_dir).calls.groupBy("genome_accession").agg(F.collect_list(F.struct("hgvs_p", "ref_aa", "alt_aa")).alias("mutations"))
    return calls.select("genome_accession", F.explode("mutations").alias("m")).where("m.ref_aa <> m.alt_aa").select("genome_accession", "m.hgvs_p")


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50")
def P18_filtered_documents(spark, sf_dir):
    """Documents as JSON text: parsed once, the array of entries filtered, then exploded."""
    rows = Domain(spark, sf_dir).raw("events").select("event_id", F.array(F.from_json("props", "k long")).alias("entries"))
    return rows.select("event_id", F.explode(F.filter("entries", lambda e: e["k"] >= 50)).alias("e")).select("event_id", "e.k")


@query(f"WITH {PV} SELECT genome_accession, position, alt_aa FROM pv WHERE species_id = 'EUROPE' AND gene = 'Brand#3'")
def P19_variant_view(spark, sf_dir):
    """A view per species and gene as one table function."""
    Domain(spark, sf_dir).calls.createOrReplaceTempView("variant_call")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION variant_view(s STRING, g STRING) RETURNS TABLE (genome_accession STRING, position INT, alt_aa STRING) RETURN SELECT genome_accession, position, alt_aa FROM variant_call WHERE species_id = s AND gene = g")
    return spark.sql("SELECT * FROM variant_view('EUROPE', 'Brand#3')")


# --- joins ------------------------------------------------------------------------------------------------------------


@query(f"WITH {GP}, {GF} SELECT p.p_partkey AS mutation_id, gp.association_id, gf.protein_name FROM part p LEFT JOIN gp ON gp.protein = p.p_brand AND gp.position = p.p_size LEFT JOIN gf ON gf.gene = p.p_brand AND gf.species_id = 'ASIA'")
def J07_two_left_joins(spark, sf_dir):
    d = Domain(spark, sf_dir)
    m = d.raw("part").select(F.col("p_partkey").alias("mutation_id"), F.col("p_brand").alias("gene"), F.col("p_size").alias("position"))
    a = d.associations.select(F.col("protein").alias("gene"), "position", "association_id")
    named = m.join(F.broadcast(d.gene_function.where("species_id = 'ASIA'").select("gene", "protein_name")), "gene", "left")  # a row a gene, met before rows multiply
    return J.spread(named, a, ["gene", "position"], "left").select("mutation_id", "association_id", "protein_name")


@query(f"WITH {PV}, {GP} SELECT genome_accession, hgvs_p, association_id FROM pv JOIN gp ON gp.protein = pv.gene AND gp.position = pv.position AND gp.alt_aa = pv.alt_aa")
def J12_exact_matches(spark, sf_dir):
    d = Domain(spark, sf_dir)
    a = d.associations.select(F.col("protein").alias("gene"), "position", "alt_aa", "association_id")
    calls = sinks.stored(d.calls.select("genome_accession", "hgvs_p", "gene", "position", "alt_aa"), "exact-calls")  # they are counted and read
    return J.spread(calls, a, ["gene", "position", "alt_aa"]).select("genome_accession", "hgvs_p", "association_id")


@query("""WITH m AS (SELECT p_partkey AS motif, p_brand AS gene, lower(split_part(p_name, ' ', 1)) AS word FROM part), v AS (SELECT p_partkey AS variant, p_brand AS gene, lower(p_name) AS domain FROM part)
SELECT motif, min(variant) AS variant FROM m JOIN v USING (gene) WHERE contains(domain, word) OR contains(word, domain) GROUP BY 1""")
def J13_motif_containment(spark, sf_dir):
    """The first variant of the gene whose domain holds the motif, or lies in it."""
    p = Domain(spark, sf_dir).raw("part")
    m = p.select(F.col("p_partkey").alias("motif"), F.col("p_brand").alias("gene"), F.lower(F.split_part("p_name", F.lit(" "), F.lit(1))).alias("word"))
    v = p.groupBy(F.col("p_brand").alias("gene"), F.lower("p_name").alias("domain")).agg(F.min("p_partkey").alias("variant"))
    words = m.select("gene", "word").distinct()  # each word of a gene is held against each domain once
    first = words.join(v, "gene").where(F.contains("domain", "word") | F.contains("word", "domain")).groupBy("gene", "word").agg(F.min("variant").alias("variant"))
    return m.join(first, ["gene", "word"]).select("motif", "variant")


@query("SELECT a.p_partkey AS a, b.p_partkey AS b FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_size = b.p_size WHERE a.p_partkey % 2 = 0 AND b.p_partkey % 2 = 1")
def J14_notation_bridge(spark, sf_dir):
    """p.A5V on one side, p.Ala5Val on the other: both are brought to (gene, ref, position, alt) once and joined on that."""
    p = Domain(spark, sf_dir).raw("part")
    side = lambda rest, text, name: p.where(f"p_partkey % 2 = {rest}").select(F.col("p_partkey").alias(name), F.col("p_brand").alias("gene"), S.parse_protein_change(F.expr(text)).alias("m")).select(name, "gene", "m.*")
    return J.spread(side(0, "concat('p.A', p_size, 'V')", "a"), side(1, "concat('p.Ala', p_size, 'Val')", "b"), ["gene", "ref", "position", "alt"]).select("a", "b")


@query("SELECT c_custkey, c_mktsegment AS lineage_id FROM customer WHERE c_custkey % 3 <> 2")
def J16_clade_dictionary(spark, sf_dir):
    c = Domain(spark, sf_dir).raw("customer")
    known = c.select(F.col("c_mktsegment").alias("lineage_id")).distinct().select("lineage_id", F.explode(F.array(F.lower("lineage_id"), F.lower(F.concat(F.lit("clade "), "lineage_id")))).alias("alias"))
    label = F.expr("case c_custkey % 3 when 0 then concat(' ', c_mktsegment) when 1 then concat('Clade ', c_mktsegment) else 'other' end")
    return c.select("c_custkey", F.lower(F.trim(label)).alias("alias")).join(known, "alias").select("c_custkey", "lineage_id")


@query(f"WITH {GM} SELECT genome_accession AS tip, collection_country FROM gm")
def J17_tip_metadata(spark, sf_dir):
    """Tips by accession, what is left by the accession within a longer label."""
    g = Domain(spark, sf_dir).genomes.select("genome_accession", "collection_country")
    tips = g.select(F.expr("case when cast(genome_accession as bigint) % 2 = 0 then genome_accession else concat('EBOV|', genome_accession, '|x') end").alias("label"))
    exact = tips.join(g, F.col("label") == F.col("genome_accession")).select("label", "genome_accession", "collection_country")
    left = tips.join(exact.select("label"), "label", "left_anti").withColumn("part", F.explode(F.array_distinct(F.split("label", "[^A-Za-z0-9]+"))))
    loose = left.join(g, F.col("part") == F.col("genome_accession")).select("label", "genome_accession", "collection_country")
    return exact.unionByName(loose).select(F.col("genome_accession").alias("tip"), "collection_country")


@query("SELECT p_partkey, p_size AS position FROM part WHERE p_size <= length(p_name) AND substr(upper(p_name), p_size, 1) = upper(substr(p_type, 1, 1))")
def J18_residue_check(spark, sf_dir):
    p = Domain(spark, sf_dir).raw("part")
    proteins = p.select(F.col("p_partkey").cast("string").alias("gene"), F.lit("s").alias("species_id"), F.upper("p_name").alias("protein"))
    candidates = p.select("p_partkey", F.col("p_partkey").cast("string").alias("gene"), F.lit("s").alias("species_id"), F.substring("p_type", 1, 1).alias("ref"), F.col("p_size").alias("position"))
    return Q.reference_checked(candidates, proteins).select("p_partkey", "position")


_MENTIONS = f"""WITH {RP}, m AS (SELECT ordinal, 'deaths' AS mention, strpos(lower(text), 'deaths') AS place FROM rp), a AS (SELECT ordinal, w AS alias, strpos(lower(text), w) AS a_at FROM rp, (VALUES ('cumulative'), ('cases'), ('confirmed')) t(w))
SELECT ordinal, mention, place AS "at", arg_min(alias, (abs(place - a_at), a_at, alias)) AS alias, min(abs(place - a_at)) AS distance FROM m JOIN a USING (ordinal) WHERE place > 0 AND a_at > 0 GROUP BY 1, 2, 3"""


@query(_MENTIONS)
def J21_nearest_mention(spark, sf_dir):
    r = Domain(spark, sf_dir).reports.select("ordinal", F.lower("text").alias("text"))
    at = lambda w: F.instr("text", w).cast("long")
    m = r.select("ordinal", F.lit("deaths").alias("mention"), at("deaths").alias("at")).where("at > 0")
    a = r.select("ordinal", F.explode(F.array(*[F.struct(F.lit(w).alias("alias"), at(w).alias("at")) for w in ("cumulative", "cases", "confirmed")])).alias("a")).select("ordinal", "a.*").where("at > 0")
    return J.nearest_mention(m, a, "ordinal")


@query("SELECT coalesce(c.c_custkey, s.s_suppkey) AS sample_id, c.c_custkey IS NOT NULL AS has_metadata, s.s_suppkey IS NOT NULL AS has_sequence FROM (SELECT * FROM customer) c FULL JOIN supplier s ON c.c_custkey = s.s_suppkey")
def J23_metadata_sequences(spark, sf_dir):
    """Samples with metadata, sequence, or both."""
    d = Domain(spark, sf_dir)
    c = d.raw("customer").select(F.col("c_custkey").alias("sample_id"), F.lit(True).alias("m"))
    s = d.raw("supplier").select(F.col("s_suppkey").alias("sample_id"), F.lit(True).alias("q"))
    return c.join(s, "sample_id", "full_outer").select("sample_id", F.col("m").isNotNull().alias("has_metadata"), F.col("q").isNotNull().alias("has_sequence"))


# --- limits and sets --------------------------------------------------------------------------------------------------


@query(f"WITH {RP} SELECT ordinal, cases FROM rp ORDER BY cases DESC, ordinal LIMIT 30")
def T05_credible_cap(spark, sf_dir):
    return Domain(spark, sf_dir).reports.select("ordinal", "cases").orderBy(F.col("cases").desc(), "ordinal").limit(30)


_ST = "list_position(['insufficient', 'preliminary', 'weak', 'moderate', 'strong'], evidence_strength)"


@query(f"WITH {GP} SELECT association_id, evidence_strength FROM gp ORDER BY {_ST} DESC, association_id LIMIT 40")
def T07_anchor_cap(spark, sf_dir):
    """Strength sorts by its rank in the vocabulary, not by its name."""
    a = Domain(spark, sf_dir).associations
    return a.orderBy(rank_of(F.col("evidence_strength"), EVIDENCE_STRENGTH).desc(), "association_id").limit(40).select("association_id", "evidence_strength")


@query(f"WITH {GP} SELECT association_id FROM gp WHERE CAST(association_id AS BIGINT) > 10 ORDER BY CAST(association_id AS BIGINT) LIMIT 50")
def T09_verification_batch(spark, sf_dir):
    a = Domain(spark, sf_dir).associations.withColumn("k", F.col("association_id").cast("long"))
    return a.where("k > 10").orderBy("k").limit(50).select("association_id")


@query(f"WITH {GM} SELECT species_id, genome_accession FROM (SELECT *, row_number() OVER (PARTITION BY species_id ORDER BY collection_date NULLS LAST, genome_accession) AS r FROM gm WHERE lineage_id = 'BUILDING') WHERE r <= 50")
def T11_surrogate_tips(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.where("lineage_id = 'BUILDING'")
    place = F.row_number().over(W.partitionBy("species_id").orderBy(F.col("collection_date").asc_nulls_last(), "genome_accession"))
    return g.withColumn("r", place).where("r <= 50").select("species_id", "genome_accession")


@query(f"WITH {GM}, x AS (SELECT lineage_id, list_distinct(list(collection_country) FILTER (collection_country IS NOT NULL)) AS c FROM gm WHERE lineage_id IS NOT NULL GROUP BY 1) SELECT lineage_id, array_to_string(list_sort(list_distinct(list_concat(c, ['CURATED']))), ',') AS countries FROM x")
def U01_curated_union(spark, sf_dir):
    rows = Domain(spark, sf_dir).genomes.where("lineage_id is not null").groupBy("lineage_id").agg(F.collect_set("collection_country").alias("c"))
    return rows.select("lineage_id", F.array_join(F.array_sort(F.array_union("c", F.array(F.lit("CURATED")))), ",").alias("countries"))


@query("SELECT doc_id, lang, 0 AS k FROM documents UNION ALL SELECT page_id, NULL, 1 FROM pages")
def U03_concatenation(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return d.raw("documents").select("doc_id", "lang", F.lit(0).alias("k")).unionByName(d.raw("pages").select(F.col("page_id").alias("doc_id"), F.lit(1).alias("k")), allowMissingColumns=True)


@query("SELECT user_id, CASE WHEN bool_or(value > 100) THEN 'a' ELSE 'b' END AS section FROM events GROUP BY 1")
def U04_preferred_section(spark, sf_dir):
    """Section a if any of its entries says something, else b."""
    a = F.collect_list(F.when(F.col("value") > 100, F.col("value")))
    return Domain(spark, sf_dir).raw("events").groupBy("user_id").agg(a.alias("a")).select("user_id", F.when(F.exists("a", lambda x: x.isNotNull()), "a").otherwise("b").alias("section"))


@query("SELECT user_id, array_to_string(list(event_type ORDER BY first), ',') AS gaps FROM (SELECT user_id, event_type, min(event_id) AS first FROM events GROUP BY 1, 2) GROUP BY 1")
def U05_ordered_union(spark, sf_dir):
    first = Domain(spark, sf_dir).raw("events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("first", "event_type"))), lambda x: x["event_type"])
    return first.groupBy("user_id").agg(F.array_join(ordered, ",").alias("gaps"))


# --- upserts and entities ---------------------------------------------------------------------------------------------


@query(f"WITH {GM} SELECT species_id, count(*) AS species_total_genomes FROM gm GROUP BY 1")
def K03_denominators(spark, sf_dir):
    return Domain(spark, sf_dir).genomes.groupBy("species_id").agg(F.count(F.lit(1)).alias("species_total_genomes"))


@query(f"WITH {RP} SELECT DISTINCT substr(sha1('tpch|' || country || '|' || CAST(year AS VARCHAR)), 1, 16) AS id FROM rp")
def K09_candidates(spark, sf_dir):
    """Candidates by content id: each id once, and only those not there yet."""
    r = Domain(spark, sf_dir).reports.select(S.outbreak_id(F.lit("tpch"), F.col("country"), F.col("year")).alias("id"), "year")
    there = r.where("year < 1997").select("id").distinct()
    return U.insert_absent(there, r.select("id").distinct(), ["id"])


@query("SELECT l_orderkey AS sample_id, CASE WHEN l_orderkey % 2 = 0 THEN 'known' ELSE 'orphan' END AS side, count(*) AS n FROM lineitem GROUP BY 1, 2")
def K18_split_samples(spark, sf_dir):
    d = Domain(spark, sf_dir)
    known, orphans = sinks.split_by_sample(d.raw("lineitem").withColumnRenamed("l_orderkey", "sample_id"), d.raw("orders").where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("sample_id")), "sample_id")
    rows = known.select("sample_id", F.lit("known").alias("side")).unionByName(orphans.select("sample_id", F.lit("orphan").alias("side")))
    return rows.groupBy("sample_id", "side").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_orderkey AS sample_id, CASE WHEN count(l_orderkey) > 0 THEN 'completed' ELSE 'failed' END AS status FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def K19_run_status(spark, sf_dir):
    d = Domain(spark, sf_dir)
    done = d.raw("lineitem").select(F.col("l_orderkey").alias("sample_id")).distinct().withColumn("done", F.lit(True))
    return d.raw("orders").select(F.col("o_orderkey").alias("sample_id")).join(done, "sample_id", "left").select("sample_id", F.when(F.col("done"), "completed").otherwise("failed").alias("status"))


# --- mining and evidence ----------------------------------------------------------------------------------------------


@query(f"WITH {RP} SELECT ordinal, CASE WHEN deaths > 0 THEN deaths > 0 END AS has_rate FROM rp")
def X02_cfr_text(spark, sf_dir):
    """Whether a rate can be given; its rounding (half to even) is held against Python in the tests."""
    cases, deaths = M.count_in_text(F.col("text"), M.CASES), M.count_in_text(F.col("text"), M.DEATHS)
    return Domain(spark, sf_dir).reports.select("ordinal", F.when(M.cfr_text(cases, deaths).isNotNull(), True).alias("has_rate"))


@query(f"WITH {RP} SELECT country, min(year) AS first_documented, arg_min(url, (year, ordinal)) AS source_url, bool_or(contains(lower(text), 'fruit bat')) AS bats FROM rp GROUP BY 1")
def X08_surveillance(spark, sf_dir):
    r = Domain(spark, sf_dir).reports
    return r.groupBy("country").agg(F.min("year").alias("first_documented"), F.min_by("url", F.struct("year", "ordinal")).alias("source_url"), F.bool_or(F.contains(F.lower("text"), F.lit("fruit bat"))).alias("bats"))


@query(f"WITH {RP} SELECT ordinal, coalesce(CASE WHEN ordinal % 2 = 0 THEN cases END, cases) AS cases FROM rp")
def X11_structured_else_text(spark, sf_dir):
    """The structured field where it is given, else what the text says."""
    given = F.when(F.col("ordinal") % 2 == 0, F.col("cases"))
    return Domain(spark, sf_dir).reports.select("ordinal", F.coalesce(given, M.count_in_text(F.col("text"), M.CASES)).alias("cases"))


@query(f"WITH {RP} SELECT ordinal, url, country FROM rp WHERE contains(lower(text), 'nation_3 ')")
def X12_lineage_mentions(spark, sf_dir):
    return Domain(spark, sf_dir).reports.where(F.contains(F.lower("text"), F.lit("nation_3 "))).select("ordinal", "url", "country")


@query(f"WITH {RP} SELECT ordinal, CASE WHEN ordinal % 4 <> 1 THEN cases END AS cases, CASE WHEN ordinal % 6 <> 1 THEN deaths END AS deaths, CASE WHEN ordinal % 4 <> 1 AND ordinal % 6 <> 1 AND cases <= 5000 AND deaths > 0 THEN 'kept' ELSE 'quarantine' END AS place FROM rp")
def X23_validation(spark, sf_dir):
    """Every row with its fields read as numbers, and where it goes: a field that is no number, or out of its range, sends it to quarantine."""
    told = Domain(spark, sf_dir).reports.selectExpr("ordinal", "if(ordinal % 4 = 1, concat(cases, ' cases'), concat(' ', cases)) as cases", "if(ordinal % 6 = 1, 'unknown', cast(deaths as string)) as deaths")
    read = told.select("ordinal", *[F.trim(c).try_cast("long").alias(c) for c in ("cases", "deaths")])
    valid = F.col("cases").between(1, 5000) & (F.col("deaths") > 0)
    return read.select("ordinal", "cases", "deaths", F.when(valid, "kept").otherwise("quarantine").alias("place"))


@query(f"""WITH {PV}, p AS (SELECT a.genome_accession AS sample_id, a.hgvs_p AS a, b.hgvs_p AS b FROM (SELECT DISTINCT genome_accession, hgvs_p FROM pv) a JOIN (SELECT DISTINCT genome_accession, hgvs_p FROM pv) b ON a.genome_accession = b.genome_accession AND a.hgvs_p < b.hgvs_p)
SELECT sample_id, a, b, count(*) OVER (PARTITION BY a, b) AS seen_together FROM p""")
def E01_cooccurrence_history(spark, sf_dir):
    """Pairs of a sample's mutations, with the number of samples that have both."""
    d = Domain(spark, sf_dir)
    once = d.calls.select(F.col("genome_accession").alias("sample_id"), "hgvs_p").distinct()
    pairs = once.withColumnRenamed("hgvs_p", "a").join(once.withColumnRenamed("hgvs_p", "b"), "sample_id").where("a < b")
    return J.hashed(pairs, d.tasks, "a", "b").withColumn("seen_together", F.count(F.lit(1)).over(W.partitionBy("a", "b")))


@query("SELECT c_custkey AS sample_id, 'genetic_relatedness' AS analysis, CASE WHEN c_custkey % 7 = 0 THEN 'no_relatedness' WHEN c_custkey % 12 <= 5 THEN 'close_genetic_match' ELSE 'genetic_relatedness_summary' END AS finding_type, CASE WHEN c_custkey % 7 = 0 THEN 'low' WHEN c_custkey % 12 <= 5 THEN 'high' ELSE 'medium' END AS confidence FROM customer")
def E12_relatedness(spark, sf_dir):
    return E.relatedness(Domain(spark, sf_dir).raw("customer").selectExpr("c_custkey as sample_id", "case when c_custkey % 7 = 0 then null else c_custkey % 12 end as snps"))


@query(f"WITH {GM} SELECT genome_accession AS sample_id, 'molecular_clock' AS analysis, 'reporting_delay' AS finding_type, 'medium' AS confidence FROM gm WHERE collection_date IS NOT NULL AND CAST(genome_accession AS BIGINT) % 90 > 30")
def E13_molecular_clock(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.where("collection_date is not null")
    return E.molecular_clock(g.select(F.col("genome_accession").alias("sample_id"), "collection_date", F.expr("date_sub(collection_date, cast(cast(genome_accession as bigint) % 90 as int))").alias("placement_date")))


@query(f"""WITH {GM}, l AS (SELECT lineage_id AS sample_id, max(collection_date) AS last FROM gm WHERE lineage_id IS NOT NULL AND collection_country = 'NATION_3' GROUP BY 1)
SELECT sample_id, 'surveillance_gaps' AS analysis, unnest(CASE WHEN date_diff('day', last, DATE '2003-06-01') > 730 THEN ['country_surveillance_gap', 'geographic_coverage_gap'] ELSE ['geographic_coverage_gap'] END) AS finding_type, 'medium' AS confidence FROM l""")
def E17_surveillance_gaps(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.where("lineage_id is not null and collection_country = 'NATION_3'")
    rows = g.groupBy(F.col("lineage_id").alias("sample_id")).agg(F.max("collection_date").alias("last_in_country"))
    return E.surveillance_gaps(rows.withColumn("as_of", F.lit("2003-06-01").cast("date")).withColumn("missing", F.array(F.lit("NATION_1"))))


@query("SELECT c_custkey AS sample_id, CAST((CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 0 END) + (CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) AS INTEGER) AS points FROM customer")
def E18_spillover(spark, sf_dir):
    c = Domain(spark, sf_dir).raw("customer")
    animal = lambda k, other: F.when(F.col("c_custkey") % k == 0, F.lit("bat")).otherwise(F.lit(other).cast("string"))
    return c.select(F.col("c_custkey").alias("sample_id"), E.spillover_points(animal(2, None), animal(3, " Human "), animal(5, "unknown")).alias("points"))


@query(f"""WITH {GM}, r AS (SELECT genome_accession AS sample_id, date_diff('day', collection_date, CAST(ship AS DATE)) AS delay, date_diff('day', prev, collection_date) AS gap,
  lines > 4 AS pathways, nations > 2 AS mismatch, parts <= 2 AS close FROM (SELECT *, lag(collection_date) OVER (PARTITION BY lineage_id, collection_country ORDER BY collection_date NULLS FIRST, CAST(genome_accession AS BIGINT)) AS prev FROM gm) gm JOIN (SELECT CAST(l_orderkey AS VARCHAR) AS genome_accession, max(l_shipdate) AS ship, count(*) AS lines, count(DISTINCT s_nationkey) AS nations, count(DISTINCT l_partkey) AS parts FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1) USING (genome_accession)),
n AS (SELECT *, CAST(floor(gap / 14) AS BIGINT) AS generations, CASE WHEN close AND gap <= 180 THEN 0.2 ELSE 0.7 END AS importation_probability, CASE WHEN pathways THEN 2 ELSE 0 END + CASE WHEN mismatch THEN 1 ELSE 0 END AS spread_score FROM r),
f AS (SELECT sample_id, unnest([CASE WHEN delay > 30 THEN 'reporting_delay' END, CASE WHEN generations > 2 THEN 'undetected_chain' END, CASE WHEN spread_score >= 3 THEN 'international_spread_risk' END]) AS finding_type FROM n)
SELECT n.sample_id, generations, CAST(importation_probability AS DOUBLE) AS importation_probability, spread_score, CASE WHEN f.finding_type IS NOT NULL THEN 'integrated_inference' END AS analysis, f.finding_type, CASE WHEN f.finding_type IS NOT NULL THEN 'medium' END AS confidence FROM n LEFT JOIN (SELECT * FROM f WHERE finding_type IS NOT NULL) f USING (sample_id)""")
def E19_integrated(spark, sf_dir):
    """Hidden generations, importation probability and spread score of every genome, from dates and places of its lines, with the findings they give."""
    d = Domain(spark, sf_dir)
    lines = d.raw("lineitem").join(d.raw("supplier"), F.expr("l_suppkey = s_suppkey")).groupBy(F.col("l_orderkey").cast("string").alias("genome_accession")).agg(F.max("l_shipdate").alias("ship"), F.count(F.lit(1)).alias("lines"), F.count_distinct("s_nationkey").alias("nations"), F.count_distinct("l_partkey").alias("parts"))
    before = F.lag("collection_date").over(W.partitionBy("lineage_id", "collection_country").orderBy("collection_date", F.col("genome_accession").cast("long")))
    rows = d.genomes.withColumn("before", before).join(lines, "genome_accession")
    return E.integrated_inference(rows.selectExpr("genome_accession as sample_id", "datediff(cast(ship as date), collection_date) as delay_days", "datediff(collection_date, before) as gap_days", "parts <= 2 as close_match", "lines > 4 as pathways", "nations > 2 as mismatch"))


@query(f"WITH {GM}, f AS (SELECT host AS analysis, genome_accession AS finding, row_number() OVER (PARTITION BY host ORDER BY CAST(genome_accession AS BIGINT)) AS r FROM gm) SELECT analysis, count(*) AS findings, array_to_string(list(finding ORDER BY r) FILTER (r <= 20), ',') AS shown FROM f GROUP BY 1")
def E31_compaction(spark, sf_dir):
    """The first twenty findings of each analysis, and how many there are."""
    g = Domain(spark, sf_dir).genomes.select(F.col("host").alias("analysis"), "genome_accession")
    first = g.withColumn("r", F.row_number().over(W.partitionBy("analysis").orderBy(F.col("genome_accession").cast("long")))).where("r <= 20")  # the limit is applied before the shuffle
    shown = F.transform(F.array_sort(F.collect_list(F.struct("r", "genome_accession"))), lambda x: x["genome_accession"])
    counts = g.groupBy("analysis").agg(F.count(F.lit(1)).alias("findings"))
    return counts.join(first.groupBy("analysis").agg(F.array_join(shown, ",").alias("shown")), "analysis").select("analysis", "findings", "shown")


@query("SELECT p_partkey, CASE WHEN p_size >= 36 THEN 'complete' WHEN p_size >= 24 THEN 'near-complete' ELSE 'partial' END AS completeness, lower(regexp_replace(regexp_replace(lower(trim(p_type)), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g')) AS label, 'S-' || p_type AS lineage FROM part")
def F06_labels(spark, sf_dir):
    p = Domain(spark, sf_dir).raw("part")
    clade = F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("S-"), "p_type")).otherwise(F.col("p_type"))
    return p.select("p_partkey", S.completeness(F.col("p_size") * 500, F.lit("x")).alias("completeness"), J.normalise_label(F.col("p_type")).alias("label"), S.lineage_id(F.lit("S"), clade).alias("lineage"))


@query(f"WITH {RP} SELECT ordinal, CASE WHEN ordinal % 2 = 0 THEN '2014-06-14' ELSE '14 June 2014' END AS date, country, 'x' AS region FROM rp")
def F10_text_fields(spark, sf_dir):
    """Dates out of running text, and country and region out of one field."""
    text = F.when(F.col("ordinal") % 2 == 0, F.concat(F.lit("On 2014-06-14 in "), "country")).otherwise(F.concat(F.lit("It was 14 June 2014 in "), "country"))
    place = S.country_and_region(F.concat("country", F.lit(": x ")))
    return Domain(spark, sf_dir).reports.select("ordinal", S.first_date_in_text(text).alias("date"), place["country"].alias("country"), place["region"].alias("region"))


@query("SELECT p_partkey, CAST(p_partkey AS BIGINT) * 1000 AS n, 'gpa' AS prefix, 16 AS length FROM part")
def F18_lenient_numbers(spark, sf_dir):
    text = F.concat(F.lit("about "), F.col("p_partkey").cast("string"), F.lit(",000 cases"))
    ident = S.association_id(F.col("p_name"))
    return Domain(spark, sf_dir).raw("part").select("p_partkey", S.lenient_int(text).alias("n"), F.substring(ident, 1, 3).alias("prefix"), F.length(ident).alias("length"))


@query(f"WITH {GP} SELECT association_id, association_id AS pmid FROM gp")
def F29_pmids(spark, sf_dir):
    a = Domain(spark, sf_dir).associations
    return a.select("association_id", F.explode(S.pmids(F.array_join("literature_refs", "; "))).alias("pmid"))

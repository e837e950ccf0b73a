"""Queries of what a report keeps and asks, of lineage rows and of rows as objects, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import reporting as R
from ..sources import readers
from .domain import GM, GP, Domain

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"name":' || CASE WHEN n_nationkey % 3 = 0 THEN 'null' ELSE '"' || n_name || '"' END || ',"n_regionkey":' || n_regionkey || '}' AS row FROM nation WHERE n_regionkey >= 2""")
def S03_dict_rows(spark, sf_dir):
    """Rows of a parameterised statement as objects; a wrong statement raises."""
    nations = Domain(spark, sf_dir).raw("nation")
    rows = readers.query(spark, "SELECT n_nationkey, if(n_nationkey % 3 = 0, null, n_name) AS name, n_regionkey FROM {nations} WHERE n_regionkey >= :least", least=2, tables={"nations": nations})
    return readers.dict_rows(rows)


@query(f"WITH {GM}, l AS (SELECT pathogen_id, species_id, lineage_id, count(*) AS n, min(collection_date) AS first_seen FROM gm GROUP BY 1, 2, 3) SELECT 'exact' AS scan, species_id, lineage_id, n, first_seen FROM l WHERE species_id = 'ASIA' AND lineage_id = 'BUILDING' UNION ALL SELECT 'species', species_id, lineage_id, n, first_seen FROM l WHERE species_id = 'EUROPE'")
def S22_lineage_rows(spark, sf_dir):
    """One lineage by its exact id, and all of a species where none is named."""
    table = Domain(spark, sf_dir).genomes.groupBy("pathogen_id", "species_id", "lineage_id").agg(F.count(F.lit(1)).alias("n"), F.min("collection_date").alias("first_seen"))
    scan = lambda name, *key: readers.lineages(table, "tpch", *key).select(F.lit(name).alias("scan"), "species_id", "lineage_id", "n", "first_seen")
    return scan("exact", "ASIA", "BUILDING").unionByName(scan("species", "EUROPE", ""))


@query("""WITH f AS (SELECT CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'evidence_weighted_threat' ELSE o_orderpriority || ' ' || year(o_orderdate) END AS analysis, o_custkey AS place, o_orderkey,
  '{' || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '"assertion":"order ' || o_orderkey || '",' END || '"source":"' || o_orderstatus || '"' || CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE ',"supporting_refs":["PMID:' || o_orderkey || '"]' END || ',"record_flagged":' || CASE WHEN o_orderkey % 5 = 0 THEN 'true' ELSE 'false' END || '}' AS finding FROM orders)
SELECT analysis, place, finding, findings FROM (SELECT *, row_number() OVER (PARTITION BY analysis ORDER BY place, finding) AS r, count(*) OVER (PARTITION BY analysis) AS findings FROM f WHERE analysis <> 'evidence_weighted_threat') WHERE r <= 20""")
def E31_findings(spark, sf_dir):
    """The first twenty findings of every analysis as objects without empty fields."""
    rows = Domain(spark, sf_dir).raw("orders").selectExpr(
        "if(o_orderpriority = '3-MEDIUM', 'evidence_weighted_threat', concat(o_orderpriority, ' ', year(o_orderdate))) as analysis", "o_custkey as place", "if(o_orderkey % 4 = 0, '', concat('order ', o_orderkey)) as assertion",
        "o_orderstatus as source", "if(o_orderkey % 3 = 0, array(), array(concat('PMID:', o_orderkey))) as supporting_refs", "o_orderkey % 5 = 0 as record_flagged")
    return R.compact_findings(rows)


@query("""WITH o AS (SELECT o_custkey AS customer, 'customer ' || o_custkey AS analysis, o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || '-' || substr(o_orderpriority, 1, 1) AS code FROM orders),
c AS (SELECT customer, analysis, code, count(*) AS n FROM o GROUP BY 1, 2, 3), r AS (SELECT *, row_number() OVER (PARTITION BY analysis ORDER BY code) AS r FROM c)
SELECT analysis, 'orders' AS metric, CAST(sum(n) AS VARCHAR) AS value FROM c GROUP BY 1
UNION ALL SELECT analysis, 'codes', '[' || string_agg('"' || code || '"', ',' ORDER BY code) || ']' FROM c GROUP BY 1 HAVING count(*) <= 5
UNION ALL SELECT analysis, 'by_code', '{' || string_agg('"' || code || '":' || n, ',' ORDER BY code) || '}' FROM r WHERE r <= 10 GROUP BY 1
UNION ALL SELECT analysis, 'trend', CASE WHEN customer % 2 = 0 THEN 'null' ELSE '"up"' END FROM (SELECT DISTINCT analysis, customer FROM c)""")
def E31_small_metrics(spark, sf_dir):
    """Counts, lists and tables of every customer's orders; long lists go, long tables are cut. Years and priorities bound them."""
    o = Domain(spark, sf_dir).raw("orders").select(F.col("o_custkey"), F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.substring("o_orderpriority", 1, 1)).alias("code"))
    counts = o.groupBy("o_custkey", "code").agg(F.count(F.lit(1)).alias("n"))
    per = counts.groupBy("o_custkey").agg(F.sum("n").alias("total"), F.array_sort(F.collect_list(F.struct("code", "n"))).alias("by"))
    metric = lambda name, value: F.struct(F.lit(name).alias("metric"), value.alias("value"))
    values = F.array(metric("orders", F.col("total").cast("string")), metric("codes", F.to_json(F.col("by.code"))), metric("by_code", F.to_json(F.map_from_entries("by"))), metric("trend", F.expr("if(o_custkey % 2 = 0, null, '\"up\"')")))
    return R.small_metrics(per.select(F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("analysis"), F.explode(values).alias("m")).select("analysis", "m.*"))


@query(f"""WITH {GP}, {GM}, x AS (SELECT lineage_id AS metric, CASE WHEN completeness = 'partial' THEN '' ELSE completeness END AS source, host AS title, row_number() OVER (PARTITION BY host ORDER BY CAST(genome_accession AS BIGINT)) AS r FROM gm),
k AS (SELECT DISTINCT 'analysis_names' AS kind, phenotype_category AS key FROM gp WHERE phenotype_category NOT LIKE 'STANDARD%'
UNION ALL SELECT 'source_fields', protein FROM gp UNION ALL SELECT 'source_fields', evidence_strength FROM gp UNION ALL SELECT 'literature_refs', 'PMID:' || association_id FROM gp WHERE record_flagged UNION ALL SELECT 'literature_refs', 'PMID:' || association_id FROM gp
UNION ALL SELECT 'cross_evidence_metric_names', metric FROM x WHERE r <= 20 UNION ALL SELECT 'source_fields', coalesce(nullif(source, ''), title) FROM x WHERE r <= 20)
SELECT kind, key, count(*) AS n FROM k WHERE key <> '' GROUP BY 1, 2""")
def E31_citations(spark, sf_dir):
    """Names that may be cited: analyses, sources, metrics of the cross analysis, references."""
    d = Domain(spark, sf_dir)
    a, g = d.associations, d.genomes
    analyses = a.select(F.expr("if(phenotype_category like 'STANDARD%', 'evidence_weighted_threat', phenotype_category)").alias("analysis"))
    found = a.selectExpr("protein as source", "evidence_strength as finding_type", "if(record_flagged, literature_refs, null) as supporting_refs")
    cross = g.selectExpr("host as block", "cast(genome_accession as bigint) as place", "lineage_id as metric", "if(completeness = 'partial', '', completeness) as source", "host as title")
    return R.citation_catalogue(analyses, found, cross, a.select("literature_refs"))


def _asked_sql() -> str:
    quoted = lambda t: "NULL" if t is None else "'" + t.replace("'", "''") + "'"
    filled = lambda t: "replace(" * 6 + quoted(t) + "".join(f", '{{{c}}}', {v})" for c, v in (("species_name", "species_name"), ("lineage_last_seen", "coalesce(CAST(lineage_last_seen AS VARCHAR), '')"), ("lineage", "coalesce(lineage, '')"), ("country", "coalesce(country, '')"), ("collection_date", "coalesce(CAST(collection_date AS VARCHAR), chr(0))"), ("pathogen_family", "pathogen_family")))
    each = (f"SELECT sample_id, '{name}' AS question_id, CASE WHEN {when or 'true'} THEN {filled(text)} ELSE {filled(other)} END AS question, '{fields}' AS fields FROM s" for name, when, text, other, fields in R.QUESTIONS)
    seen = f"WITH {GM}, l AS (SELECT species_id, lineage_id, max(collection_year) AS lineage_last_seen FROM gm GROUP BY 1, 2), s AS (SELECT genome_accession AS sample_id, CASE WHEN gm.species_id = 'EUROPE' THEN 'NOVEL' ELSE gm.species_id END AS species_id, lower(gm.species_id) AS species_name, gm.pathogen_id AS pathogen_family, CASE WHEN gm.lineage_id = 'MACHINERY' THEN 'unknown' ELSE gm.lineage_id END AS lineage, collection_country AS country, collection_date, lineage_last_seen FROM gm LEFT JOIN l ON l.species_id = gm.species_id AND l.lineage_id = gm.lineage_id)"
    return f"{seen} SELECT * FROM ({' UNION ALL '.join(each)}) WHERE question IS NOT NULL AND question NOT LIKE '%' || chr(0) || '%'"


@query(_asked_sql())
def E33_all_questions(spark, sf_dir):
    """The fourteen questions of every genome. A species has as many lineages as there are segments, so their years are a small table."""
    g = Domain(spark, sf_dir).genomes
    seen = g.groupBy("species_id", "lineage_id").agg(F.max("collection_year").alias("lineage_last_seen"))
    rows = g.join(F.broadcast(seen), ["species_id", "lineage_id"], "left")
    return R.conditional_questions(rows.selectExpr(
        "genome_accession as sample_id", "if(species_id = 'EUROPE', 'NOVEL', species_id) as species_id", "lower(species_id) as species_name", "pathogen_id as pathogen_family",
        "if(lineage_id = 'MACHINERY', 'unknown', lineage_id) as lineage", "collection_country as country", "collection_date", "lineage_last_seen"))

"""The driver's star schema seen as genomes, variant calls and associations, in Spark and in SQL."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import joins as J


@dataclass
class Domain:
    """Tables of the evidence model over one folder. Columns that a query doesn't use are pruned from the scans."""

    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def genomes(self) -> DataFrame:
        """One row per genome (an order). Nation and region are dimensions of fixed size."""
        places = F.broadcast(self.raw("nation").join(F.broadcast(self.raw("region")), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name"))
        people = self.raw("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_mktsegment", "n_name", "r_name")
        orders = self.raw("orders").join(people, F.col("o_custkey") == F.col("c_custkey"))
        dated = F.expr("o_orderkey % 17 <> 0")
        known = F.expr("o_orderkey % 13 <> 0")
        return orders.select(
            F.lit("tpch").alias("pathogen_id"), F.col("r_name").alias("species_id"), F.col("o_orderkey").cast("string").alias("genome_accession"),
            F.when(dated, F.col("o_orderdate").cast("date")).alias("collection_date"), F.when(dated, F.year("o_orderdate")).alias("collection_year"),
            F.when(known, F.col("n_name")).alias("collection_country"), F.when(known, F.upper(F.substring("n_name", 1, 3))).alias("collection_country_code"),
            F.col("r_name").alias("collection_region"), F.expr("case when o_orderstatus = 'P' then null else c_mktsegment end").alias("lineage_id"),
            F.col("o_orderpriority").alias("host"), F.expr("case when o_totalprice >= 200000 then 'complete' when o_totalprice >= 100000 then 'near-complete' else 'partial' end").alias("completeness"),
        )

    @cached_property
    def tasks(self) -> int:
        """Parts that calls are dealt to wherever they are hashed: they grow with the table, and not what a task holds."""
        return J.tasks_for(self.raw("lineitem"))

    @cached_property
    def calls(self) -> DataFrame:
        """One row per variant call (a line item), with the scope of its genome. Repeated calls are real."""
        parts = self.raw("part").select("p_partkey", "p_brand", "p_size", "p_type")
        lines = self.raw("lineitem").select("l_orderkey", "l_partkey", "l_linestatus", "l_returnflag")
        scope = J.hashed(self.genomes.select("pathogen_id", "species_id", "genome_accession"), self.tasks, "genome_accession")
        rows = J.met(lines, parts.withColumnRenamed("p_partkey", "l_partkey"), ["l_partkey"], self.tasks).withColumn("genome_accession", F.col("l_orderkey").cast("string"))
        rows = J.hashed(rows, self.tasks, "genome_accession").join(scope, "genome_accession")
        return rows.select(
            "pathogen_id", "species_id", "genome_accession", F.col("p_brand").alias("gene"), F.col("p_size").alias("position"), F.col("l_linestatus").alias("ref_aa"),
            F.col("l_returnflag").alias("alt_aa"), F.col("p_type").alias("variant_type"), F.concat("p_brand", F.lit(":"), "l_linestatus", F.col("p_size").cast("string"), "l_returnflag").alias("hgvs_p"),
        )

    @cached_property
    def associations(self) -> DataFrame:
        """One row per genotype-phenotype association (a part)."""
        parts = self.raw("part").join(F.broadcast(self.raw("region")), F.expr("r_regionkey = p_partkey % 5"))
        return parts.select(
            F.lit("tpch").alias("pathogen_id"), F.col("r_name").alias("species_id"), F.col("p_partkey").cast("string").alias("association_id"),
            F.expr("case when p_partkey % 11 = 0 then null else p_brand end").alias("protein"), F.expr("case when p_partkey % 5 = 0 then null else p_size end").alias("position"),
            F.lit("O").alias("ref_aa"), F.expr("case p_partkey % 3 when 0 then 'R' when 1 then 'A' else 'N' end").alias("alt_aa"),
            F.expr("case when p_partkey % 7 = 0 then 'BUILDING' end").alias("lineage_id"), F.col("p_type").alias("phenotype_category"), F.col("p_name").alias("phenotype_specific"),
            F.expr("element_at(array('strong', 'moderate', 'weak', 'preliminary', 'insufficient'), cast(p_partkey % 5 + 1 as int))").alias("evidence_strength"),
            F.expr("case when p_partkey % 4 = 0 then null else cast(p_size as string) end").alias("effect_size"), F.concat(F.lit("genotype "), "p_name").alias("genotype_description"),
            F.array(F.concat(F.lit("PMID:"), F.col("p_partkey").cast("string"))).alias("literature_refs"), F.expr("p_partkey % 6 = 0").alias("record_flagged"),
        )

    @cached_property
    def gene_function(self) -> DataFrame:
        """One row per species and gene (a brand); the smallest name and the largest size stand for name and length."""
        parts = self.raw("part").where("p_brand <> 'Brand#11'").join(F.broadcast(self.raw("region")), F.expr("r_regionkey = p_partkey % 5"))
        return parts.groupBy(F.col("r_name").alias("species_id"), F.col("p_brand").alias("gene")).agg(F.min("p_name").alias("protein_name"), F.max("p_size").alias("protein_length_aa"))

    @cached_property
    def reports(self) -> DataFrame:
        """One outbreak report per order: ordinal, url, country, year, cases, deaths, text."""
        places = F.broadcast(self.raw("nation").select("n_nationkey", "n_name"))
        orders = J.dealt(self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate"), J.TASK_ROWS, "o_orderkey")  # texts are long work for few bytes of files
        rows = orders.join(self.raw("customer"), F.expr("o_custkey = c_custkey")).join(places, F.expr("c_nationkey = n_nationkey"))
        return rows.selectExpr("o_orderkey as ordinal", f"{_URL} as url", "n_name as country", "year(o_orderdate) as year", "1000 + o_orderkey % 5000 as cases", "o_custkey % 400 as deaths", f"{_TEXT} as text")


_TEXT = """concat('In ', n_name, ' a cumulative total of ', cast(1000 + o_orderkey % 5000 as {s}), ' confirmed cases including ', cast(o_custkey % 400 as {s}), ' deaths. ',
  case o_orderkey % 6 when 0 then 'Ring vaccination and contact tracing began; severe bleeding was seen.' when 1 then 'RT-PCR and sequencing of blood samples; fever and headache among healthcare workers.'
  when 2 then 'Direct contact at a funeral. ELISA serology; remdesivir was used.' when 3 then 'Reduced transmission; immune escape of antibody resistance is unlikely.'
  when 4 then 'PCR only. Fruit bats are a reservoir; vomiting and fatigue.' else 'No further details.' end)""".replace("{s}", "string")
_URL = """concat('https://www.', case o_orderkey % 8 when 0 then 'who.int' when 1 then 'health.gov' when 2 then 'moh.go.ug' when 3 then 'en.wikipedia.org' when 4 then 'healthnews.example' when 5 then 'cdc.gov'
  when 6 then 'news.example' else 'data.gouv.sn' end, '/report/', cast(o_orderkey as string))"""
RP = f"""
rp AS (SELECT o_orderkey AS ordinal, {_URL} AS url, n_name AS country, CAST(year(o_orderdate) AS INTEGER) AS year, 1000 + o_orderkey % 5000 AS cases, o_custkey % 400 AS deaths, {_TEXT} AS text
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""
#: The same tables in SQL, to begin a WITH clause.
GM = """
gm AS (SELECT 'tpch' AS pathogen_id, r_name AS species_id, CAST(o_orderkey AS VARCHAR) AS genome_accession,
  CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderdate AS DATE) END AS collection_date, CASE WHEN o_orderkey % 17 <> 0 THEN CAST(year(o_orderdate) AS INTEGER) END AS collection_year,
  CASE WHEN o_orderkey % 13 <> 0 THEN n_name END AS collection_country, CASE WHEN o_orderkey % 13 <> 0 THEN upper(substr(n_name, 1, 3)) END AS collection_country_code,
  r_name AS collection_region, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE c_mktsegment END AS lineage_id, o_orderpriority AS host,
  CASE WHEN o_totalprice >= 200000 THEN 'complete' WHEN o_totalprice >= 100000 THEN 'near-complete' ELSE 'partial' END AS completeness
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
PV = GM + """,
pv AS (SELECT gm.pathogen_id, gm.species_id, gm.genome_accession, p_brand AS gene, p_size AS position, l_linestatus AS ref_aa, l_returnflag AS alt_aa, p_type AS variant_type,
  p_brand || ':' || l_linestatus || CAST(p_size AS VARCHAR) || l_returnflag AS hgvs_p
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN gm ON gm.genome_accession = CAST(l_orderkey AS VARCHAR))"""
PROFILE = PV + """,
profile AS (SELECT pv.*, gm.collection_date, gm.collection_year, gm.collection_country, gm.collection_country_code, gm.collection_region, gm.lineage_id, gm.host, gm.completeness
  FROM pv JOIN gm USING (pathogen_id, species_id, genome_accession))"""
GP = """
gp AS (SELECT 'tpch' AS pathogen_id, r_name AS species_id, CAST(p_partkey AS VARCHAR) AS association_id, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS protein,
  CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS position, 'O' AS ref_aa, CASE p_partkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'A' ELSE 'N' END AS alt_aa,
  CASE WHEN p_partkey % 7 = 0 THEN 'BUILDING' END AS lineage_id, p_type AS phenotype_category, p_name AS phenotype_specific,
  (['strong', 'moderate', 'weak', 'preliminary', 'insufficient'])[CAST(p_partkey % 5 + 1 AS BIGINT)] AS evidence_strength, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS effect_size,
  'genotype ' || p_name AS genotype_description, p_partkey % 6 = 0 AS record_flagged FROM part JOIN region ON r_regionkey = p_partkey % 5)"""
GF = """
gf AS (SELECT p_brand AS gene, r_name AS species_id, min(p_name) AS protein_name, max(p_size) AS protein_length_aa FROM part JOIN region ON r_regionkey = p_partkey % 5 WHERE p_brand <> 'Brand#11' GROUP BY 1, 2)"""

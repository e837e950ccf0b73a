"""What reports tell in detail, profiles, features, nested documents, lineage behaviour and origins. SQL states its values itself."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import extraction as X
from ..operators import mining as M
from ..operators.joins import hashed
from ..schemas import MUTATION
from ..sources import sinks
from ..sources.manifest import Catalogue
from . import views as V
from .domain import GM, PROFILE, RP, Domain
from .queries_views import CATALOGUE, MK

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


_NOTES = """case ordinal % 9 when 0 then ' The incubation period is about 2 to 21 days; serial interval of 15.3 days.' when 1 then ' Incubation period of up to 14 days. R0: 1.8 was estimated.'
  when 2 then ' A mosquito vector was seen; 12 men and 9 women fell ill.' when 3 then ' Children and pregnant women; seroprevalence of 12.5% among farmers.' when 4 then ' Natural host: bats. Needle sharing at a hospital setting.'
  when 5 then ' Incubation period of 8–10 days; travel history; Ervebo and ZMapp.' when 6 then ' Household contact, pigs and camels; elderly males.' when 7 then null else ' Sexual contact.' end"""
_PLACE = "case country when 'NATION_1' then 'Mali' when 'NATION_2' then 'Japan' when 'NATION_3' then null else country end"
#: Reports with further details, structured fields of some, and another spelling of some countries.
RQ = f"""{RP}, rq AS (SELECT ordinal, url, {_PLACE} AS country, CASE WHEN ordinal % 5 <> 0 THEN year END AS year, text || {_NOTES} AS text, lower(text || {_NOTES}) AS t,
  CASE ordinal % 11 WHEN 0 THEN '1.5-2.5' WHEN 1 THEN '' END AS r0_range, CASE ordinal % 13 WHEN 0 THEN 'sexual transmission' WHEN 1 THEN 'aerosol' END AS transmission,
  ordinal % 17 = 3 AS vaccine_coverage FROM rp)"""


def _reports(spark, sf_dir):
    r = Domain(spark, sf_dir).reports
    return r.selectExpr(
        "ordinal", "url", f"{_PLACE} as country", "case when ordinal % 5 <> 0 then year end as year", f"concat(text, {_NOTES}) as text", "case ordinal % 11 when 0 then '1.5-2.5' when 1 then '' end as r0_range",
        "case ordinal % 13 when 0 then 'sexual transmission' when 1 then 'aerosol' end as transmission", "ordinal % 17 = 3 as vaccine_coverage",
    )


def _first(rules: str, names: str) -> str:
    """rules: (rule, key, names) rows a report, as a UNION; of each key the first report's."""
    return f"WITH {RQ}, m AS ({rules}) SELECT {names}, url AS source_url FROM (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ordinal, rule) AS k FROM m) WHERE k = 1"


@query(_first(r"""
SELECT ordinal, url, 0 AS rule, r0_range AS key, 'R0' AS parameter, r0_range AS value, NULL AS unit FROM rq WHERE r0_range <> ''
UNION ALL SELECT ordinal, url, 1, 'route_' || transmission, 'main transmission route', transmission, NULL FROM rq WHERE transmission <> ''
UNION ALL SELECT ordinal, url, 2, 'i' || x, 'incubation period', replace(x, '–', '-'), 'days' FROM (SELECT *, regexp_extract(t, 'incubation period (?:is |of )?(?:about )?(\d+(?: to |–)\d+) days', 1) AS x FROM rq) WHERE x <> ''
UNION ALL SELECT ordinal, url, 3, 'u' || x, 'incubation period', 'up to ' || x, 'days' FROM (SELECT *, regexp_extract(t, 'incubation period of up to (\d+) days', 1) AS x FROM rq) WHERE x <> ''
UNION ALL SELECT ordinal, url, 4, 's' || x, 'serial interval', x, 'days' FROM (SELECT *, regexp_extract(t, 'serial interval of (\d+\.\d+) days', 1) AS x FROM rq) WHERE x <> ''
UNION ALL SELECT ordinal, url, 5, 'r' || x, 'R0', x, NULL FROM (SELECT *, regexp_extract(t, 'r0: (\d+\.\d+)', 1) AS x FROM rq) WHERE x <> ''
UNION ALL SELECT ordinal, url, 6, 'route_' || x, 'main transmission route', x, NULL FROM (SELECT ordinal, url, unnest([CASE WHEN contains(t, 'direct contact') THEN 'person-to-person via direct/close contact' END, CASE WHEN contains(t, 'sexual') THEN 'sexual transmission' END, CASE WHEN contains(t, 'needle') THEN 'needlestick / contaminated equipment' END]) AS x FROM rq) WHERE x IS NOT NULL
UNION ALL SELECT ordinal, url, 7, 'v', 'vector', 'mosquito', NULL FROM rq WHERE contains(t, 'mosquito vector')""", "parameter, value, unit"))
def X05_parameters(spark, sf_dir):
    """Reproduction numbers, incubation periods, serial intervals, routes and vectors, structured fields first."""
    return X.transmission_parameters(_reports(spark, sf_dir))


_NOBODY = "NULL AS age_group, NULL AS sex, NULL AS occupation, NULL AS population_affected, NULL AS risk_group, NULL AS exposure_history, NULL AS setting, NULL AS host_species, NULL AS risk_factor"


def _told(rule: int, test: str, notes: str, **given: str) -> str:
    columns = ", ".join(f"'{given[c]}' AS {c}" if (c := part.split(" AS ")[1]) in given else part for part in _NOBODY.split(", "))
    return f"SELECT ordinal, url, {rule} AS rule, '{rule}' AS key, {columns}, '{notes}' AS notes FROM rq WHERE {test}"


@query(_first(" UNION ALL ".join([
    _told(0, "contains(t, 'healthcare worker')", "healthcare workers mentioned in fetched source", occupation="healthcare worker", risk_group="healthcare workers", risk_factor="occupational exposure"),
    _told(1, "contains(t, 'child')", "children mentioned in fetched source", age_group="children", population_affected="children"), _told(2, "contains(t, 'pregnant')", "pregnant women mentioned in fetched source", sex="female"),
    _told(3, "contains(t, 'elderly')", "elderly mentioned in fetched source", age_group="elderly", population_affected="elderly"), _told(4, "contains(t, 'funeral')", "funeral/burial attendance reported in fetched source", exposure_history="funeral/burial attendance"),
    _told(5, "contains(t, 'travel history')", "travel reported in fetched source", exposure_history="travel"), _told(6, "contains(t, 'hospital setting')", "healthcare facility setting reported in fetched source", setting="healthcare facility"),
    _told(7, "contains(t, 'household contact')", "household setting reported in fetched source", setting="household"), _told(8, "contains(t, 'fruit bat')", "fruit bats reported as affected host species in fetched source", host_species="fruit bats"),
    _told(9, "contains(t, 'pig')", "pigs reported as affected host species in fetched source", host_species="pigs"), _told(10, "contains(t, 'camel')", "camels reported as affected host species in fetched source", host_species="camels"),
    _told(11, "regexp_matches(t, '\\bmales?\\b|\\bmen\\b')", "mentioned in fetched source", sex="male"), _told(12, "regexp_matches(t, '\\bfemales?\\b|\\bwomen\\b')", "mentioned in fetched source", sex="female"),
    _told(13, "contains(t, '12 men and 9 women')", "12 male, 9 female", sex="male/female"),
]), ", ".join(x.split(" AS ")[1] for x in _NOBODY.split(", ")) + ", notes"))
def X04_people(spark, sf_dir):
    """Who fell ill, where and by what exposure, each told once."""
    return X.people(_reports(spark, sf_dir))


@query(f"""WITH {RQ}, f AS (SELECT country, min(year) AS first_documented, arg_min(url, (year, ordinal)) FILTER (year IS NOT NULL) AS u FROM rq WHERE country IS NOT NULL GROUP BY 1),
s AS (SELECT country, 12.5 AS pct, min(ordinal) AS o FROM rq WHERE contains(t, 'seroprevalence of 12.5% among farmers') AND country IS NOT NULL GROUP BY 1),
b AS (SELECT arg_min(CASE WHEN contains(t, 'fruit bat') THEN 'fruit bats (Pteropodidae)' ELSE 'bats' END, ordinal) AS reservoir FROM rq WHERE contains(t, 'fruit bat') OR contains(t, 'natural host: bats'))
SELECT f.country, CASE f.country WHEN 'Mali' THEN 'Africa' WHEN 'Japan' THEN 'Asia' END AS region, first_documented, reservoir, CAST(pct AS DOUBLE) AS seroprevalence_pct, CASE WHEN pct IS NOT NULL THEN 'farmers' END AS seroprevalence_population, coalesce(u, rq.url) AS source_url
FROM b, f LEFT JOIN s USING (country) LEFT JOIN rq ON rq.ordinal = s.o""")
def X08_surveillance_rows(spark, sf_dir):
    """A row per country: region, first year and source, reservoir, seroprevalence."""
    return X.surveillance(_reports(spark, sf_dir))


@query(_first("""
SELECT ordinal, url, 0 AS rule, 'a' AS key, 'vaccine coverage available' AS product, 'vaccine' AS kind, 'used' AS status, NULL AS effectiveness, 'supported by species/strain profile' AS notes FROM rq WHERE vaccine_coverage
UNION ALL SELECT ordinal, url, 1, 'b', 'Ervebo (rVSV-ZEBOV)', 'vaccine', 'used', 'highly effective', 'mentioned in fetched source' FROM rq WHERE contains(t, 'ervebo')
UNION ALL SELECT ordinal, url, 2, 'c', 'ZMapp', 'therapeutic', 'used', 'effective', 'mentioned in fetched source' FROM rq WHERE contains(t, 'zmapp')
UNION ALL SELECT ordinal, url, 3, 'd', 'Remdesivir', 'therapeutic', 'used', 'limited efficacy', 'mentioned in fetched source' FROM rq WHERE contains(t, 'remdesivir')
UNION ALL SELECT ordinal, url, 4, 'e', 'vaccination (unspecified)', 'vaccine', 'used', NULL, 'mentioned in fetched source' FROM rq WHERE contains(t, 'vaccination')""", "product, kind, status, effectiveness, notes"))
def X10_products_flags(spark, sf_dir):
    """Products by name, and what structured flags say."""
    return X.products(_reports(spark, sf_dir))


@query("SELECT 'P' || CAST(p_size AS VARCHAR) AS pathogen, arg_min(p_name, p_partkey) AS species, CAST(arg_min(p_size + p_partkey % 10, p_partkey) AS INTEGER) AS discovered_year, 'u' || CAST(min(p_partkey) AS VARCHAR) AS source_url FROM part WHERE p_partkey % 3 <> 0 GROUP BY 1")
def X13_pathogen_profile(spark, sf_dir):
    p = Domain(spark, sf_dir).raw("part")
    items = p.selectExpr("p_partkey as ordinal", "concat('P', p_size) as pathogen", "case when p_partkey % 3 = 0 then 'outbreak' else 'strain_profile' end as item_type", "p_name as species", "cast(p_size + p_partkey % 10 as int) as discovered_year", "concat('u', p_partkey) as url")
    return X.pathogen_profile(items, ["species", "discovered_year"])


@query("""WITH p AS (SELECT p_partkey, p_size, 'PM' || CAST(p_partkey % 7 AS VARCHAR) AS a, 'PM' || CAST(p_size % 5 AS VARCHAR) AS b FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS accession, CASE WHEN p_size <= 40 THEN 'Domain:d:1:' || CAST(p_size AS VARCHAR) ELSE '' END AS domains, 'Site::3:' || CASE WHEN p_partkey % 4 = 0 THEN '' ELSE '5' END AS sites, CASE WHEN p_partkey % 2 = 0 THEN '1ABC' ELSE '' END AS pdb, CASE WHEN a < b THEN a || ',' || b WHEN b < a THEN b || ',' || a ELSE a END AS refs FROM p""")
def X20_protein_features(spark, sf_dir):
    """Domains and sites within the protein, structures, and what is cited, features left out included."""
    entries = Domain(spark, sf_dir).raw("part").selectExpr(
        "cast(p_partkey as string) as accession", "40 as max_length", "array(named_struct('database', 'PDB', 'id', if(p_partkey % 2 = 0, '1ABC', '')), named_struct('database', 'PDB', 'id', if(p_partkey % 2 = 0, '1ABC', null)), named_struct('database', 'EMBL', 'id', 'x')) as references",
        "array(concat('PM', p_partkey % 7), '') as citations",
        "array(named_struct('type', 'Domain', 'description', 'd', 'start', 1, 'end', p_size, 'pmids', array(concat('PM', p_size % 5))), named_struct('type', 'Site', 'description', cast(null as string), 'start', 3, 'end', if(p_partkey % 4 = 0, null, 5), 'pmids', cast(null as array<string>)), named_struct('type', 'Helix', 'description', 'h', 'start', 1, 'end', 2, 'pmids', array('')) ) as features",
    )
    out = X.protein_features(entries)
    shown = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(":", x["type"], x["description"], x["start"].cast("string"), F.coalesce(x["end"].cast("string"), F.lit("")))), ",")
    return out.select("accession", shown("key_domains").alias("domains"), shown("functional_sites").alias("sites"), F.array_join("pdb_ids", ",").alias("pdb"), F.array_join("literature_refs", ",").alias("refs"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 3 THEN 'G9' ELSE 'GP' END AS gene, CASE p_partkey % 4 WHEN 2 THEN 7 ELSE p_size END AS position, CASE p_partkey % 4 WHEN 2 THEN 'K' ELSE 'A' END AS ref_aa, CASE p_partkey % 4 WHEN 2 THEN 'R' ELSE 'V' END AS alt_aa FROM part WHERE p_partkey % 4 <> 1""")
def P17_stated_variants(spark, sf_dir):
    """By hgvs_p alone, by neither (left out), by fields alone, and by both, where the given gene counts."""
    rows = Domain(spark, sf_dir).raw("part").selectExpr(
        "p_partkey", "case p_partkey % 4 when 0 then concat('GP:A', p_size, 'V') when 1 then 'unreadable' when 2 then '' else concat('GP:A', p_size, 'V') end as hgvs_p",
        "case p_partkey % 4 when 1 then 'GP' when 2 then 'GP' when 3 then 'G9' end as gene", "case p_partkey % 4 when 1 then 5 when 2 then 7 end as position", "case p_partkey % 4 when 1 then '' when 2 then 'K' end as ref_aa", "case when p_partkey % 4 = 2 then 'R' end as alt_aa",
    )
    return X.stated_variants(rows).select("p_partkey", "gene", "position", "ref_aa", "alt_aa")


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN p_name WHEN 1 THEN p_name || ', x' WHEN 2 THEN NULL WHEN 3 THEN CAST(p_size AS VARCHAR) END AS value FROM part")
def F19_lenient_string(spark, sf_dir):
    """Strings, lists, empty lists, numbers and nulls as text."""
    p = Domain(spark, sf_dir).raw("part")
    name = F.to_json(F.struct(F.array("p_name").alias("v")))
    quoted = F.regexp_extract(name, r"^\{\"v\":\[(.*)\]\}$", 1)
    kind = F.col("p_partkey") % 5
    value = F.when(kind == 0, quoted).when(kind == 1, F.concat(F.lit("["), quoted, F.lit(',"x"]'))).when(kind == 2, F.lit("[]")).when(kind == 3, F.col("p_size").cast("string")).otherwise(F.lit("null"))
    return p.select("p_partkey", X.lenient_string(value).alias("value"))


@query("""SELECT p_partkey, unnest(['size', 'a.b.c', 'a.none', 'tags', 'rows']) AS metric, unnest([CAST(p_size AS VARCHAR), p_brand, '', 'x; ' || CAST(p_size AS VARCHAR), 'k=1, z=' || p_brand || '; k=2']) AS value FROM part""")
def F30_flat_metrics(spark, sf_dir):
    p = Domain(spark, sf_dir).raw("part")
    text = """concat('{"size":', p_size, ',"a":{"b":{"c":"', p_brand, '"},"none":null},"tags":["x",', p_size, '],"rows":[{"z":"', p_brand, '","k":1,"_hidden":5},{"k":2}]}')"""
    return X.flat_metrics(p.selectExpr("p_partkey", f"{text} as document"), "p_partkey")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '{"name":"' || p_brand || '","list":["x"]}' WHEN 1 THEN '{"in":{"size":' || CAST(p_size AS VARCHAR) || '}}' ELSE '{}' END AS document FROM part""")
def F31_without_empty(spark, sf_dir):
    """Documents less their empty texts, lists, objects and nulls, at all depths."""
    p = Domain(spark, sf_dir).raw("part")
    rows = p.selectExpr("p_partkey", "if(p_partkey % 3 = 0, p_brand, '') as name", "if(p_partkey % 3 = 0, array('x', '', null), array()) as list", "named_struct('size', if(p_partkey % 3 = 1, p_size, null), 'text', '') as `in`")
    fields = {f.name: f.dataType for f in rows.schema}
    return rows.select("p_partkey", F.to_json(F.struct(*[X.without_empty(F.col(c), fields[c]).alias(c) for c in ("name", "list", "in")])).alias("document"))


@query("""WITH i AS (SELECT o_custkey AS doc, o_orderkey % 3 AS list_no, row_number() OVER (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY o_orderkey) AS place, o_orderpriority AS item FROM orders),
g AS (SELECT *, sum(length(item) + 2) OVER (PARTITION BY doc) AS whole, coalesce(sum(length(item) + 2) OVER (PARTITION BY doc ORDER BY place DESC, list_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone FROM i)
SELECT doc, list_no, count(*) AS kept FROM g WHERE place = 1 OR whole - gone <= 60 GROUP BY 1, 2""")
def T10_within_budget(spark, sf_dir):
    """Lists of a document cut from the longest one's end until it fits; held against a plain loop in the tests."""
    from pyspark.sql import Window as W

    o = Domain(spark, sf_dir).raw("orders").select(F.col("o_custkey").alias("doc"), (F.col("o_orderkey") % 3).alias("list_no"), "o_orderkey", F.col("o_orderpriority").alias("item"))
    items = o.withColumn("place", F.row_number().over(W.partitionBy("doc", "list_no").orderBy("o_orderkey"))).drop("o_orderkey")
    return X.within_budget(items, 60).groupBy("doc", "list_no").agg(F.count(F.lit(1)).alias("kept"))


@query(f"WITH {PROFILE}, {CATALOGUE} SELECT {MK}, genome_count, first_seen_date, last_seen_date, coalesce(array_to_string(countries, ','), '') AS countries_seen, coalesce(array_to_string(lineages, ','), '') AS lineage_ids, species_total_genomes, global_frequency FROM cat")
def K22_rebuild(spark, sf_dir):
    """Calls per genome give way to the aggregate grain under the manifest: one rename switches readers, and those of the old grain keep it."""
    d = Domain(spark, sf_dir)
    there = Catalogue(spark, f"{sinks.shared_folder(spark)}/rebuilt-{uuid.uuid4().hex}")
    order = ("gene", "position", "alt_aa")
    there.refresh([("protein_variants", lambda _: V.variant_profile(d.calls, d.genomes, d.tasks))], "species_id", order)
    there.rebuild("protein_variants", lambda calls: V.catalogue(hashed(calls, d.tasks, *MUTATION), d.genomes), "species_id", order)
    return there.read("protein_variants").withColumns({c: F.array_join(c, ",") for c in ("countries_seen", "lineage_ids")})


@query(f"""WITH {GM}, p AS (SELECT lineage_id, count(*) AS genome_count, min(collection_date) AS first_detection, max(collection_date) AS last_detection, count(DISTINCT collection_year) AS active_years, max(collection_year) - min(collection_year) AS span,
  count(DISTINCT collection_country) FILTER (collection_year IS NOT NULL) AS n FROM gm WHERE lineage_id IS NOT NULL GROUP BY 1), y AS (SELECT *, round(date_diff('day', first_detection, last_detection) / 365.25, 2) AS years FROM p)
SELECT lineage_id, genome_count, first_detection, last_detection, years AS detection_span_years, active_years, CASE WHEN active_years >= 5 THEN 'continuous' WHEN span >= 5 THEN 'intermittent' ELSE 'limited' END AS persistence_index,
  CASE WHEN n >= 2 AND years > 0 THEN round(n / greatest(years, 0.5), 2) END AS countries_per_year, CASE lineage_id WHEN 'BUILDING' THEN 3 WHEN 'MACHINERY' THEN 1 ELSE 0 END AS spillover_risk_score FROM y""")
def E18_lineage_behaviour(spark, sf_dir):
    d = Domain(spark, sf_dir)
    lineages = d.raw("customer").select(F.col("c_mktsegment").alias("lineage_id")).distinct().selectExpr("lineage_id", "case lineage_id when 'BUILDING' then 'Fruit bats' when 'MACHINERY' then 'Unknown' end as reservoir", "case lineage_id when 'BUILDING' then 'bat' when 'MACHINERY' then 'pig' else 'Human' end as primary_host")
    return X.lineage_behaviour(d.genomes, lineages)


@query("""SELECT c_custkey AS sample_id, CASE c_custkey % 6 WHEN 0 THEN 'N' || CAST(c_nationkey AS VARCHAR) WHEN 1 THEN 'B' WHEN 2 THEN 'F' WHEN 3 THEN 'R' WHEN 4 THEN 'C' END AS origin,
CASE c_custkey % 6 WHEN 0 THEN 'high' WHEN 1 THEN 'medium' WHEN 2 THEN 'medium' WHEN 3 THEN 'low' WHEN 4 THEN 'low' END AS confidence, CASE c_custkey % 6 WHEN 0 THEN 'nearest_tips' WHEN 1 THEN 'nearest_tips' WHEN 2 THEN 'first_detected' WHEN 3 THEN 'reported' WHEN 4 THEN 'most_genomes' END AS "by" FROM customer""")
def E11_origin(spark, sf_dir):
    """Origins by the nearest tips and their four fallbacks."""
    c = Domain(spark, sf_dir).raw("customer")
    rows = c.selectExpr("c_custkey as sample_id", "case c_custkey % 6 when 0 then array(null, concat('N', c_nationkey), 'A', 'B') when 1 then array('', 'B', 'A') else array('') end as tip_countries", "if(c_custkey % 6 <= 2, 'F', '') as first_country", "if(c_custkey % 6 <= 3, array('R', 'S'), array()) as countries_reported", "if(c_custkey % 6 <= 4, 'C', null) as common_country")
    return X.origin(rows)


@query(f"WITH {RP} SELECT ordinal, CASE WHEN deaths > 0 THEN CAST(CAST(round_even(deaths * 100.0 / cases, 1) AS DECIMAL(9, 1)) AS VARCHAR) || '%' END AS cfr FROM rp")
def X02_cfr(spark, sf_dir):
    """The rate in text, half to the even digit."""
    cases, deaths = M.count_in_text(F.col("text"), M.CASES), M.count_in_text(F.col("text"), M.DEATHS)
    return Domain(spark, sf_dir).reports.select("ordinal", M.cfr_text(cases, deaths).alias("cfr"))

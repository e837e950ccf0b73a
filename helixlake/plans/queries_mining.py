"""Queries over column functions, text mining, evidence analyzers, statistics and sequences, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import evidence as E
from ..operators import mining as M
from ..operators import sequence as Q
from ..operators import stats
from ..sources import readers, sinks
from .domain import GM, GP, PROFILE, PV, RP, Domain
from .queries_operators import CAT

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _sql_any(terms, text="lower(text)"):
    return "(" + " OR ".join(f"contains({text}, '{t}')" for t in terms) + ")"


# --- functions --------------------------------------------------------------------------------------------------------


@query("""SELECT p_partkey, regexp_extract(n, '^([A-Za-z0-9_]+):([A-Z*])([0-9]+)([A-Z*])$', 1) AS gene, regexp_extract(n, '^([A-Za-z0-9_]+):([A-Z*])([0-9]+)([A-Z*])$', 2) AS ref,
CAST(regexp_extract(n, '^([A-Za-z0-9_]+):([A-Z*])([0-9]+)([A-Z*])$', 3) AS INTEGER) AS position FROM (SELECT p_partkey, 'G' || CAST(p_partkey % 7 AS VARCHAR) || CASE WHEN p_partkey % 10 = 0 THEN ';' ELSE ':' END || 'A' || CAST(p_size AS VARCHAR) || 'V' AS n FROM part) WHERE regexp_matches(n, '^([A-Za-z0-9_]+):([A-Z*])([0-9]+)([A-Z*])$')""")
def F01_hgvs(spark, sf_dir):
    text = F.expr("concat('G', cast(p_partkey % 7 as string), case when p_partkey % 10 = 0 then ';' else ':' end, 'A', cast(p_size as string), 'V')")
    rows = Domain(spark, sf_dir).raw("part").select("p_partkey", S.parse_gene_mutation(text).alias("m")).where("m is not null")
    return rows.select("p_partkey", "m.gene", "m.ref", "m.position")


@query("SELECT p_partkey, 'A' AS ref, p_size AS position, 'V' AS alt, 'p.Ala' || CAST(p_size AS VARCHAR) || 'Val' AS text FROM part")
def F02_protein_change(spark, sf_dir):
    """Both notations read, and written back."""
    text = F.expr("case when p_partkey % 2 = 0 then concat('p.Ala', p_size, 'Val') else concat('p.A', p_size, 'V') end")
    rows = Domain(spark, sf_dir).raw("part").select("p_partkey", S.parse_protein_change(text).alias("m"))
    return rows.select("p_partkey", "m.*").withColumn("text", S.protein_change(F.col("ref"), F.col("position"), F.col("alt")))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN CAST(o_orderdate AS DATE) WHEN 1 THEN CAST(o_orderdate AS DATE) WHEN 2 THEN make_date(year(o_orderdate), 1, 1) END AS date FROM orders")
def F12_dates(spark, sf_dir):
    text = F.expr("case o_orderkey % 4 when 0 then date_format(o_orderdate, 'yyyy-MM-dd') when 1 then date_format(o_orderdate, 'd-MMM-yyyy') when 2 then date_format(o_orderdate, 'yyyy') else date_format(o_orderdate, 'yyyy-MM') end")
    return Domain(spark, sf_dir).raw("orders").select("o_orderkey", S.record_date(text).alias("date"))


@query("SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN strftime(o_orderdate, '%Y-%m') WHEN 1 THEN strftime(o_orderdate, '%Y') ELSE 'unknown' END AS date FROM orders")
def F15_partial_dates(spark, sf_dir):
    text = F.expr("case o_orderkey % 3 when 0 then date_format(o_orderdate, 'yyyy-MM') when 1 then concat(date_format(o_orderdate, 'yyyy'), ' (year)') else 'unknown' end")
    return Domain(spark, sf_dir).raw("orders").select("o_orderkey", S.partial_date(text).alias("date"))


@query(f"WITH {RP} SELECT ordinal, round(CAST(deaths AS DOUBLE) * 100.0 / cases, 2) AS cfr FROM rp")
def F20_cfr(spark, sf_dir):
    return Domain(spark, sf_dir).reports.select("ordinal", S.cfr_percent(F.lit(None).cast("double"), F.col("cases"), F.col("deaths")).alias("cfr"))


@query(f"WITH {RP} SELECT ordinal, substr(sha1('tpch|' || country || '|' || CAST(year AS VARCHAR)), 1, 16) AS outbreak_id FROM rp")
def F21_outbreak_id(spark, sf_dir):
    return Domain(spark, sf_dir).reports.select("ordinal", S.outbreak_id(F.lit("tpch"), F.col("country"), F.col("year")).alias("outbreak_id"))


@query(f"WITH {PROFILE}, {CAT} SELECT hgvs_p, variant_type, pathogen_id, species_id, CAST(genome_count AS VARCHAR) || '/1000 (' || printf('%.1f', genome_count / 10.0) || '%)' AS text FROM cat")
def F23_frequency_text(spark, sf_dir):
    from . import views as V

    d = Domain(spark, sf_dir)
    rows = V.variant_profile(d.calls, d.genomes, d.tasks).groupBy("pathogen_id", "species_id", "gene", "position", "ref_aa", "alt_aa", "variant_type", "hgvs_p").agg(F.count_distinct("genome_accession").alias("n"))
    return rows.select("hgvs_p", "variant_type", "pathogen_id", "species_id", S.frequency_text(F.col("n"), F.lit(1000)).alias("text"))


_HTML = "html"
for _p, _by in ((r"(?is)<script[^>]*>.*?</script>", ""), (r"(?is)<style[^>]*>.*?</style>", ""), (r"(?i)</tr\s*>", "\n"), (r"(?i)<t[dh]\b[^>]*>", " | "), (r"(?i)</t[dh]\s*>", " "), (r"<[^>]+>", " ")):
    _HTML = f"regexp_replace({_HTML}, '{_p}', '{_by}', 'g')"
for _c, _plain in S.ENTITIES.items():
    _HTML = f"replace({_HTML}, '{_c.replace(chr(39), chr(39) * 2)}', '{_plain.replace(chr(39), chr(39) * 2)}')"
for _p, _by in ((r"\s+\|\s+", " | "), (r"\n\s*\n+", "\n"), (r"[ \t]+", " ")):
    _HTML = f"regexp_replace({_HTML}, '{_p}', '{_by}', 'g')"


@query(f"SELECT page_id, regexp_replace({_HTML}, '^\\s+|\\s+$', '', 'g') AS text FROM pages")
def F24_html_text(spark, sf_dir):
    return Domain(spark, sf_dir).raw("pages").select("page_id", S.html_text(F.col("html")).alias("text"))


@query("SELECT page_id, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), '^www\\.', '') AS host FROM pages")
def F26_url_host(spark, sf_dir):
    return Domain(spark, sf_dir).raw("pages").select("page_id", S.url_host(F.col("url")).alias("host"))


@query("SELECT c_custkey, '{' || c_mktsegment || ',\"' || 'b c' || '\"}' AS literal, c_mktsegment AS first, 'b c' AS second FROM customer")
def S06_array_literals(spark, sf_dir):
    """Arrays to literals and back."""
    rows = Domain(spark, sf_dir).raw("customer").select("c_custkey", S.array_literal(F.array("c_mktsegment", F.lit("b c"))).alias("literal"))
    back = S.parse_array_literal(F.col("literal"))
    return rows.select("c_custkey", "literal", F.get(back, F.lit(0)).alias("first"), F.get(back, F.lit(1)).alias("second"))


# --- text mining ------------------------------------------------------------------------------------------------------


def _sql_count(patterns):
    plain = "regexp_replace(lower(text), '[*_]+', ' ', 'g')"
    return "coalesce(" + ", ".join(f"TRY_CAST(replace(replace(regexp_extract({plain}, '{p}', 1), ',', ''), ' ', '') AS BIGINT)" for p in patterns) + ")"


@query(f"WITH {RP} SELECT ordinal, {_sql_count(M.CASES)} AS cases, {_sql_count(M.DEATHS)} AS deaths FROM rp")
def X01_counts(spark, sf_dir):
    return Domain(spark, sf_dir).reports.select("ordinal", M.count_in_text(F.col("text"), M.CASES).alias("cases"), M.count_in_text(F.col("text"), M.DEATHS).alias("deaths"))


@query(f"WITH {RP} SELECT ordinal, country FROM rp")
def X03_country(spark, sf_dir):
    """The country that stands first in a report. All names are taken: countries are a dimension of fixed size."""
    d = Domain(spark, sf_dir)
    names = [r["n_name"] for r in d.raw("nation").select("n_name").distinct().orderBy("n_name").collect()]
    return d.reports.select("ordinal", M.earliest_country(F.col("text"), names).alias("country"))


def _sql_mentions(rules, attributes):
    """rules: terms, label, attribute values."""
    rows = " UNION ALL ".join(f"SELECT {i} AS rule, '{label}' AS label, {', '.join(('NULL' if v is None else repr(v)) + ' AS ' + a for a, v in zip(attributes, values, strict=True)) or '1 AS one'}, ordinal, url FROM rp WHERE {_sql_any(terms)}" for i, (terms, label, values) in enumerate(rules))
    shown = "".join(f"{a}, " for a in attributes)
    return f"WITH {RP}, m AS ({rows}) SELECT label, {shown}url AS source_url FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY ordinal, rule) AS k FROM m) WHERE k = 1"


@query(_sql_mentions([((k,), label, (kind,)) for k, label, kind in M.INTERVENTIONS], ["kind"]))
def X06_interventions(spark, sf_dir):
    return M.interventions(Domain(spark, sf_dir).reports)


@query(_sql_mentions([((f,), f, (s,)) for f, s in M.FEATURES], ["severity"]))
def X07_keyword_rules(spark, sf_dir):
    return M.clinical_features(Domain(spark, sf_dir).reports)


@query(_sql_mentions([(t, label, (kind,)) for t, kind, label in M.DEMOGRAPHICS], ["kind"]))
def X04_demographics(spark, sf_dir):
    return M.demographics(Domain(spark, sf_dir).reports)


@query(_sql_mentions([(t, label, ()) for t, label in M.ROUTES], []))
def X05_routes(spark, sf_dir):
    return M.transmission_routes(Domain(spark, sf_dir).reports)


@query(_sql_mentions([(t, m, (k, target)) for t, m, k, target in M.DIAGNOSTICS if m != "PCR"], ["kind", "target"]))
def X09_diagnostics(spark, sf_dir):
    """The first PCR report is an RT-PCR one here, so plain PCR is suppressed."""
    return M.diagnostics(Domain(spark, sf_dir).reports)


@query(_sql_mentions([(t, p, (k, s, e)) for t, p, k, s, e in M.PRODUCTS], ["kind", "status", "effectiveness"]))
def X10_products(spark, sf_dir):
    return M.products(Domain(spark, sf_dir).reports)


def _sql_phenotypes():
    parts = []
    for category, patterns in M.PHENOTYPES:
        pick = " ".join(f"WHEN regexp_matches(lower(text), '{p}') THEN '{p}'" for p in patterns)
        parts.append(f"SELECT ordinal AS id, '{category}' AS category, CASE {pick} END AS pattern FROM rp")
    return f"WITH {RP}, m AS ({' UNION ALL '.join(parts)}) SELECT * FROM m WHERE pattern IS NOT NULL"


@query(_sql_phenotypes())
def X14_phenotype_detect(spark, sf_dir):
    return M.phenotypes(Domain(spark, sf_dir).reports.withColumnRenamed("ordinal", "id"))


def _sql_credibility():
    official = " ".join(f"WHEN contains(host, '{d}') THEN {s}" for d, s in M.OFFICIAL)
    ending = " OR ".join(f"ends_with(host, '{e}')" for e in M.ENDINGS)
    health = f"({_sql_any(M.HEALTH, 'host')} OR {_sql_any(M.HEALTH, 'path')})"
    bad = "".join(f" - CASE WHEN contains(host, '{b}') THEN 10 ELSE 0 END" for b in M.DISTRUSTED)
    named = "".join(f" + CASE WHEN {_sql_any(t, 'every')} THEN 1 ELSE 0 END" for t in (("who",), ("cdc",), ("unicef", "un ", "united nations")))
    return f"""WITH {RP}, u AS (SELECT ordinal, text, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)), '^www\\.', '') AS host, lower(regexp_extract(url, '^[a-z]+://[^/?#]+([^?#]*)', 1)) AS path FROM rp),
v AS (SELECT *, lower(host || ' ' || path || ' ' || text) AS every FROM u)
SELECT ordinal, host, CASE {official} ELSE CASE WHEN {ending} THEN CASE WHEN {health} THEN 8 ELSE 5 END WHEN {_sql_any(('ministry of health', 'ministère de la santé'), 'every')} THEN 2 WHEN {_sql_any(('health', 'sante'), 'host')} THEN 1 ELSE 0 END{named}{bad} END AS credibility FROM v"""


@query(_sql_credibility())
def X22_credibility(spark, sf_dir):
    host, path = S.url_host(F.col("url")), F.lower(F.try_parse_url("url", F.lit("PATH")))
    return Domain(spark, sf_dir).reports.select("ordinal", host.alias("host"), M.credibility(host, path, F.col("text")).alias("credibility"))


@query(_sql_credibility().replace("SELECT ordinal, host, CASE", "SELECT ordinal FROM (SELECT ordinal, CASE", 1) + ") WHERE credibility >= 5")
def P12_credible_sources(spark, sf_dir):
    return X22_credibility(spark, sf_dir).where("credibility >= 5").select("ordinal")


@query()
def W07_similar_outbreaks(spark, sf_dir):
    """Greedy, so it depends on the order: no SQL; held against a plain loop in the tests."""
    return M.similar_outbreaks(Domain(spark, sf_dir).reports.select("country", "year", "ordinal", "cases", "deaths"))


# --- evidence ---------------------------------------------------------------------------------------------------------

_SAMPLES = f"WITH {GM}, l AS (SELECT lineage_id, min(collection_date) AS first, max(collection_date) AS last FROM gm WHERE lineage_id IS NOT NULL AND collection_date BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' GROUP BY 1)"


def _samples(d: Domain):
    g = d.genomes
    known = g.where("lineage_id is not null and collection_date between date'1996-01-01' and date'1998-06-30'").groupBy("lineage_id").agg(F.min("collection_date").alias("first"), F.max("collection_date").alias("last"))
    return g.join(known, "lineage_id")


@query(f"""{_SAMPLES} SELECT genome_accession AS sample_id, CASE WHEN collection_country IN ('NATION_3', 'NATION_8', 'NATION_12') THEN CASE WHEN collection_date BETWEEN first AND last THEN 'continued_circulation' WHEN collection_date > last AND date_diff('day', last, collection_date) / 365.25 <= 2 THEN 'continued_circulation' WHEN collection_date > last THEN 're-emergence' WHEN collection_date < first THEN 'continued_circulation' ELSE 'uncertain' END
ELSE CASE WHEN collection_date BETWEEN first AND last THEN 'geographic_expansion' WHEN collection_date > last THEN 'new_introduction_or_expansion' ELSE 'uncertain' END END AS scenario FROM gm JOIN l USING (lineage_id)""")
def E10_scenario(spark, sf_dir):
    rows = _samples(Domain(spark, sf_dir))
    here = F.coalesce(F.col("collection_country").isin("NATION_3", "NATION_8", "NATION_12"), F.lit(False))
    s = E.circulation_scenario(F.col("collection_date"), F.col("first"), F.col("last"), here)
    return rows.select(F.col("genome_accession").alias("sample_id"), s["scenario"].alias("scenario"))


@query(f"WITH {PROFILE} SELECT gene, position, alt_aa, CAST(date_diff('day', min(collection_date), max(collection_date)) AS INTEGER) AS span_days FROM profile GROUP BY 1, 2, 3")
def E05_mutation_persistence(spark, sf_dir):
    from . import views as V

    d = Domain(spark, sf_dir)
    return V.variant_profile(d.calls, d.genomes, d.tasks).groupBy("gene", "position", "alt_aa").agg(F.datediff(F.max("collection_date"), F.min("collection_date")).alias("span_days"))


@query(f"""WITH {GP}, {PV}, s AS (SELECT gene, position, alt_aa, count(DISTINCT genome_accession) AS genomes FROM pv GROUP BY 1, 2, 3),
a AS (SELECT protein AS gene, position, alt_aa, count(DISTINCT association_id) AS sources, max(list_position(['insufficient', 'preliminary', 'weak', 'moderate', 'strong'], evidence_strength)) AS st, bool_or(record_flagged) AS flagged FROM gp WHERE position IS NOT NULL AND protein IS NOT NULL GROUP BY 1, 2, 3)
SELECT gene, position, alt_aa, round(greatest(least(least(sources / 3.0, 1.0) * 0.3 + CASE st WHEN 5 THEN 1.0 WHEN 4 THEN 0.6 WHEN 3 THEN 0.3 ELSE 0.0 END * 0.4 + least(genomes / 50.0, 1.0) * 0.2 + CASE WHEN position > 10 THEN 0.1 ELSE 0.0 END - CASE WHEN flagged THEN 0.1 ELSE 0.0 END, 1.0), 0.0), 3) AS confidence FROM s JOIN a USING (gene, position, alt_aa)""")
def E07_confidence(spark, sf_dir):
    from ..schemas import EVIDENCE_STRENGTH, rank_of

    d = Domain(spark, sf_dir)
    keys = ["gene", "position", "alt_aa"]
    seen = d.calls.groupBy(*keys).agg(F.count_distinct("genome_accession").alias("genomes"))
    strongest = F.max_by("evidence_strength", rank_of(F.col("evidence_strength"), EVIDENCE_STRENGTH))
    known = d.associations.where("position is not null and protein is not null").groupBy(F.col("protein").alias("gene"), "position", "alt_aa").agg(F.count_distinct("association_id").alias("sources"), strongest.alias("strongest"), F.bool_or("record_flagged").alias("flagged"))
    score = E.confidence_score(F.col("sources"), F.col("strongest"), F.col("genomes"), F.col("position") > 10, F.col("flagged"))
    return seen.join(known, keys).select(*keys, score.alias("confidence"))


_FOUND = "WITH f AS (SELECT DISTINCT o_custkey AS sample_id, (['close_genetic_match', 'country_previously_reported', 'continued_circulation', 're-emergence', 'dissemination_pathways', 'genetic_relatedness_summary', 'lineage_unassigned', 'known_phenotype', 'functional_hotspot', 'novel_geographic_detection'])[CAST(o_orderkey % 10 + 1 AS BIGINT)] AS finding_type FROM orders)"
_CRITERIA = ", ".join(f"('{c}', '{f}', {p})" for c, f, p in E.CRITERIA)
_SCORES = f"""{_FOUND}, c(criterion, finding_type, points) AS (VALUES {_CRITERIA}), g AS (SELECT * FROM f WHERE NOT (finding_type = 'genetic_relatedness_summary' AND EXISTS (SELECT 1 FROM f x WHERE x.sample_id = f.sample_id AND x.finding_type = 'close_genetic_match'))),
s AS (SELECT sample_id, criterion, CAST(least(sum(points), 5) AS INTEGER) AS score FROM g JOIN c USING (finding_type) GROUP BY 1, 2)"""


def _found(d: Domain):
    kinds = ["close_genetic_match", "country_previously_reported", "continued_circulation", "re-emergence", "dissemination_pathways", "genetic_relatedness_summary", "lineage_unassigned", "known_phenotype", "functional_hotspot", "novel_geographic_detection"]
    return d.raw("orders").select(F.col("o_custkey").alias("sample_id"), F.get(F.array(*map(F.lit, kinds)), (F.col("o_orderkey") % 10).cast("int")).alias("finding_type"))


@query(f"{_SCORES} SELECT * FROM s")
def E14_scores(spark, sf_dir):
    return E.criterion_scores(_found(Domain(spark, sf_dir)))


_RISK_ROWS = """SELECT {key} AS sample_id, CASE l_partkey % 6 WHEN 0 THEN 'vaccine_escape' WHEN 1 THEN 'immune_escape' WHEN 2 THEN 'host_range' WHEN 3 THEN 'virulence' WHEN 4 THEN 'other' END AS category, CASE l_suppkey % 3 WHEN 0 THEN 'strong' WHEN 1 THEN 'weak' ELSE 'insufficient' END AS strength,
  l_quantity > 48 AS hotspot, CASE l_partkey % 9 WHEN 0 THEN 6 WHEN 1 THEN 2 ELSE 0 END AS gap_years, l_partkey % 50 <> 0 AS seen_in_country, l_suppkey % 8 <> 0 AS lineage_listed, CASE WHEN l_suppkey % 35 = 1 THEN 'Yes' ELSE 'no' END AS history, CASE WHEN l_partkey % 2 = 0 THEN 'Freetown, Sierra Leone' ELSE 'Oslo' END AS places,
  CASE l_suppkey % 70 WHEN 0 THEN 'attended a Funeral' WHEN 2 THEN 'household contact' ELSE 'none known' END AS said FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""


def _risk_sql(key: str) -> str:
    """WITH clauses that end in (sample_id, t, reasons, confidence)."""
    counted = "strength IN ('strong', 'moderate', 'preliminary')"
    places = " OR ".join(f"contains(lower(places), '{p}')" for p in E.AFFECTED)
    return f"""r AS ({_RISK_ROWS.format(key=key)}), h AS (SELECT sample_id, 3 AS t, 'phenotype ' || category AS reason FROM r WHERE {counted} AND category IN ('vaccine_escape', 'drug_resistance', 'virulence')
UNION ALL SELECT sample_id, 2, 'phenotype ' || category FROM r WHERE {counted} AND category IN ('immune_escape', 'disease_severity', 'host_adaptation', 'vaccine_effectiveness') UNION ALL SELECT sample_id, 1, 'functional hotspot' FROM r WHERE hotspot
UNION ALL SELECT sample_id, CASE WHEN gap_years > 5 THEN 2 ELSE 1 END, CASE WHEN gap_years > 5 THEN 'unseen for over five years' ELSE 'seen after a gap' END FROM r WHERE gap_years > 0
UNION ALL SELECT sample_id, CASE WHEN NOT seen_in_country THEN 2 ELSE 1 END, CASE WHEN NOT seen_in_country THEN 'new in the country' ELSE 'not known of the lineage' END FROM r WHERE NOT seen_in_country OR NOT lineage_listed
UNION ALL SELECT sample_id, 2, 'travel to an affected region' FROM r WHERE lower(history) IN ('yes', 'true', '1') AND ({places}) UNION ALL SELECT sample_id, 2, 'exposure' FROM r WHERE contains(lower(said), 'funeral') OR contains(lower(said), 'contact')
UNION ALL SELECT sample_id, 0, 'no curated phenotype' FROM r GROUP BY 1 HAVING NOT bool_or(category IS NOT NULL) AND NOT bool_or(hotspot) UNION ALL SELECT sample_id, 0, NULL FROM r),
risk AS (SELECT sample_id, max(t) AS t, coalesce(string_agg(DISTINCT reason, '; ' ORDER BY reason), '') AS reasons FROM h GROUP BY 1), sure AS (SELECT sample_id, CASE WHEN NOT bool_or(category IS NOT NULL) AND NOT bool_or(hotspot) THEN 'low' WHEN bool_or(category IS NOT NULL) AND NOT coalesce(bool_or(category IS NOT NULL AND strength = 'strong'), false) THEN 'medium' ELSE 'high' END AS confidence FROM r GROUP BY 1)"""


def _risk(d: Domain, key: str):
    rows = d.spark.sql(_RISK_ROWS.format(key=key).replace("FROM lineitem JOIN orders", "FROM {lineitem} JOIN {orders}"), lineitem=d.raw("lineitem"), orders=d.raw("orders"))
    return E.risk_tiers(rows.withColumns({"travel": E.travelled(F.col("history"), F.col("places")), "exposure": E.exposed(F.col("said"))}))


_ORDER = "list_position([" + ", ".join(f"'{c}'" for c in dict.fromkeys(c for c, *_ in E.CRITERIA)) + "], criterion)"


@query(f"""{_SCORES}, {_risk_sql("o_custkey")}, p AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY score DESC, {_ORDER}) AS k FROM s WHERE score > 0), m AS (SELECT sample_id, max(score) AS most, count(*) FILTER (score >= 3) AS elevated, string_agg(criterion, ',' ORDER BY k) FILTER (k <= 3) AS top FROM p GROUP BY 1),
z AS (SELECT sample_id, coalesce(most, 0) AS most, coalesce(elevated, 0) AS elevated, coalesce(top, '') AS top, coalesce(t, 0) + 1 AS tier FROM m FULL JOIN risk USING (sample_id))
SELECT sample_id, CASE WHEN most >= 4 AND elevated >= 2 AND tier >= 4 THEN 'high_priority' WHEN most >= 4 OR (elevated >= 2 AND tier >= 3) THEN 'investigate' WHEN most >= 3 OR tier >= 2 THEN 'monitor' ELSE 'routine' END AS label, top FROM z""")
def E14_labels(spark, sf_dir):
    """Labels from the scores of the criteria and the risk tier of the same samples."""
    d = Domain(spark, sf_dir)
    return E.tier_of_scores(E.criterion_scores(_found(d)), _risk(d, "o_custkey"))


@query(f"WITH {_risk_sql('l_orderkey')} SELECT sample_id, (['routine', 'monitor', 'investigate', 'high_priority'])[t + 1] AS tier, reasons, confidence FROM risk JOIN sure USING (sample_id)")
def E23_risk(spark, sf_dir):
    return _risk(Domain(spark, sf_dir), "l_orderkey")


@query(f"WITH {GM} SELECT genome_accession AS sample_id, concat_ws('; ', CASE WHEN collection_date IS NULL THEN 'no collection date' END, CASE WHEN collection_country IS NULL THEN 'no country' END, CASE WHEN lineage_id IS NULL THEN 'lineage unassigned' END, CASE WHEN completeness = 'partial' THEN 'partial genome' END) AS warnings FROM gm")
def E24_warnings(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes
    return E.quality_warnings(g.select(F.col("genome_accession").alias("sample_id"), "collection_date", F.col("collection_country").alias("country"), "lineage_id", "completeness"))


_NET = f"WITH {PROFILE}, r AS (SELECT hgvs_p AS variant, variant_type AS phenotype, lineage_id AS lineage, collection_country AS outbreak FROM profile)"


@query(f"{_NET} SELECT DISTINCT least(variant, phenotype) AS a, greatest(variant, phenotype) AS b, 'has_phenotype' AS relation FROM r UNION SELECT DISTINCT least(variant, lineage), greatest(variant, lineage), 'in_lineage' FROM r WHERE lineage IS NOT NULL UNION SELECT DISTINCT least(lineage, outbreak), greatest(lineage, outbreak), 'seen_in' FROM r WHERE lineage IS NOT NULL AND outbreak IS NOT NULL")
def E28_network(spark, sf_dir):
    from . import views as V

    d = Domain(spark, sf_dir)
    rows = V.variant_profile(d.calls, d.genomes, d.tasks).select(F.col("hgvs_p").alias("variant"), F.col("variant_type").alias("phenotype"), F.col("lineage_id").alias("lineage"), F.col("collection_country").alias("outbreak"))
    return E.network(rows)[1]


@query(f"""WITH {PV}, {GP}, k AS (SELECT DISTINCT protein AS gene, position, alt_aa, phenotype_category FROM gp WHERE phenotype_category IN ('ECONOMY', 'PROMO') AND protein IS NOT NULL AND position IS NOT NULL),
o AS (SELECT DISTINCT genome_accession AS sample_id, gene, position, alt_aa FROM pv), t AS (SELECT phenotype_category, count(*) AS known FROM (SELECT DISTINCT protein, position, alt_aa, phenotype_category FROM gp WHERE phenotype_category IN ('ECONOMY', 'PROMO')) GROUP BY 1)
SELECT sample_id, phenotype_category, count(*) AS present, known - count(*) AS absent, array_to_string(list_sort(list(gene || ':' || CAST(position AS VARCHAR) || ':' || alt_aa))[1:5], ',') AS first FROM o JOIN k USING (gene, position, alt_aa) JOIN t USING (phenotype_category) GROUP BY 1, 2, known""")
def E09_intervention_findings(spark, sf_dir):
    d = Domain(spark, sf_dir)
    return E.intervention_findings(d.calls.withColumnRenamed("genome_accession", "sample_id"), d.associations, ("ECONOMY", "PROMO"), tasks=d.tasks)


_TABLE = f"WITH {GM} SELECT host AS category, count(*) FILTER (coalesce(lineage_id = 'BUILDING', false)) AS a, count(*) FILTER (NOT coalesce(lineage_id = 'BUILDING', false)) AS b FROM gm GROUP BY 1"


@query(f"SELECT category, a, b, CAST(sum(a) OVER () - a AS BIGINT) AS c, CAST(sum(b) OVER () - b AS BIGINT) AS d FROM ({_TABLE})")
def A20_contingency(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.withColumnRenamed("host", "category")
    return stats.contingency(g, "category", F.col("lineage_id") == "BUILDING")


@query()
def A21_association_test(spark, sf_dir):
    lineages = Domain(spark, sf_dir).genomes.agg(F.count_distinct("lineage_id")).first()[0]
    return stats.association_test(A20_contingency(spark, sf_dir), lineages)


@query()
def A22_poisson_trend(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.where("lineage_id is not null and collection_year is not null")
    return stats.poisson_trend(g.groupBy("lineage_id", F.col("collection_year").alias("year")).agg(F.count(F.lit(1)).alias("n")), "lineage_id")


# --- sequences, trees, documents --------------------------------------------------------------------------------------


@query()
def Q01_call_variants(spark, sf_dir):
    """Calls of a protein spelled by a part's whole name, filled up to 40 residues, against the same with its tenth residue changed and its thirtieth left out."""
    name = F.upper(F.regexp_replace("p_name", "[^A-Za-z]", ""))
    ref = F.when(F.length(name) < 40, F.rpad(name, 40, "ACDEFGHIKLMNPQRSTVWY")).otherwise(name)
    rows = Domain(spark, sf_dir).raw("part").select(F.col("p_partkey").cast("string").alias("genome_accession"), F.col("p_brand").alias("gene"), ref.alias("ref"))
    other = F.when(F.substring("ref", 10, 1) == "W", "A").otherwise("W")
    changed = F.concat(F.substring("ref", 1, 9), other, F.substring("ref", 11, 19), F.expr("substring(ref, 31)"))
    return Q.call_variants(rows.withColumn("query", changed))


@query("WITH p AS (SELECT p_partkey, rpad(upper(regexp_replace(p_name, '[^A-Za-z]', '', 'g')), 20, 'ACDEFGHIKLMNPQRSTVWY') AS r FROM part) SELECT p_partkey, 10 AS position, substr(r, 10, 1) AS ref, 'W' AS alt FROM p WHERE substr(r, 10, 1) <> 'W'")
def Q05_residue_differences(spark, sf_dir):
    ref = F.rpad(F.upper(F.regexp_replace("p_name", "[^A-Za-z]", "")), 20, "ACDEFGHIKLMNPQRSTVWY")
    rows = Domain(spark, sf_dir).raw("part").select("p_partkey", ref.alias("r"))
    diff = Q.residue_differences(F.col("r"), F.concat(F.substring("r", 1, 9), F.lit("W"), F.substring("r", 11, 20)))
    return rows.select("p_partkey", F.explode(diff).alias("x")).select("p_partkey", "x.*")


@query("SELECT CAST(n_regionkey AS VARCHAR) AS tree_id, n_name AS tip, 1.0 + n_nationkey AS root_distance FROM nation WHERE NOT contains(n_name, ' ') UNION ALL SELECT CAST(n_regionkey AS VARCHAR), n_name, 1.0 + n_nationkey FROM nation WHERE contains(n_name, ' ')")
def S13_newick_tips(spark, sf_dir):
    """A tree per region: ((tip:length, ...):1); and back to its tips."""
    tips = F.array_join(F.array_sort(F.collect_list(F.concat(F.lit("'"), "n_name", F.lit("':"), F.col("n_nationkey").cast("string")))), ",")
    trees = Domain(spark, sf_dir).raw("nation").groupBy(F.col("n_regionkey").cast("string").alias("tree_id")).agg(F.concat(F.lit("(("), tips, F.lit("):1);")).alias("newick"))
    return readers.newick_tips(trees).select("tree_id", "tip", "root_distance")


@query(f"WITH {GM} SELECT genome_accession AS sample_id, 1 AS documents, host, species_id, CAST(collection_date AS VARCHAR) AS day, collection_country AS country FROM gm")
def K16_sample_documents(spark, sf_dir):
    g = Domain(spark, sf_dir).genomes.withColumnRenamed("genome_accession", "sample_id")
    docs = sinks.sample_documents(g, "sample_id")
    field = lambda k: F.get_json_object("document", f"$[0].{k}")
    return docs.select("sample_id", F.json_array_length("document").alias("documents"), field("host").alias("host"), field("species_id").alias("species_id"), field("collection_date").alias("day"), field("collection_country").alias("country"))


@query("SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def Z01_windowed_counts(spark, sf_dir):
    """The windowed counts of the stream, run over the whole table as a batch."""
    from ..streaming.catalogue import windowed_counts

    out = windowed_counts(Domain(spark, sf_dir).raw("events"))
    return out.select(F.col("start").cast("date").alias("day"), "event_type", "n")

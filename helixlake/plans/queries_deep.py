"""Queries of the operators that need an algorithm or a stored structure of their own: trees, full text, greedy merging, manifests."""

from __future__ import annotations

import uuid

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.sql import register
from ..operators import evidence as E
from ..operators import extraction as X
from ..operators import fulltext, trees
from ..operators import joins as J
from ..sources import sinks
from ..sources.manifest import Catalogue
from . import views as V
from .domain import GF, GM, GP, PROFILE, PV, Domain

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


# --- trees ------------------------------------------------------------------------------------------------------------

# Of every region a tree: nations, groups of seven of their suppliers, suppliers; edges of different lengths at every level.
_TIPS = """t AS (SELECT CAST(n_regionkey AS VARCHAR) AS tree_id, s_name AS tip, s_suppkey AS id, n_nationkey AS nation, s_suppkey % 7 AS grp, s_suppkey % 17 + 0.25 AS own, (s_suppkey % 7) * 0.5 AS of_grp, n_nationkey % 5 + 1.0 AS of_nation
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
d AS (SELECT a.tree_id, a.tip, b.tip AS other, CAST(CASE WHEN a.id = b.id THEN 0 ELSE a.own + b.own + CASE WHEN a.nation = b.nation AND a.grp = b.grp THEN 0 ELSE a.of_grp + b.of_grp + CASE WHEN a.nation = b.nation THEN 0 ELSE a.of_nation + b.of_nation END END END AS DOUBLE) AS dist
  FROM t a JOIN t b ON a.tree_id = b.tree_id)"""


def _tree_nodes(d: Domain):
    rows = d.raw("supplier").join(F.broadcast(d.raw("nation")), F.expr("s_nationkey = n_nationkey"))
    rows = rows.selectExpr("cast(n_regionkey as string) as tree_id", "s_suppkey", "s_name", "cast(n_nationkey as int) as nation", "cast(s_suppkey % 7 as int) as grp")
    node = lambda n, parent, length, label="''": rows.selectExpr("tree_id", f"cast({n} as int) as node", f"cast({parent} as int) as parent", f"cast({length} as double) as length", f"{label} as label", "false as rooted")
    inner = [node("0", "null", "0"), node("1 + nation", "0", "nation % 5 + 1"), node("100 + nation * 10 + grp", "1 + nation", "grp * 0.5")]
    tips = node("10000 + s_suppkey", "100 + nation * 10 + grp", "s_suppkey % 17 + 0.25", "s_name")
    return tips.unionByName(inner[0].unionByName(inner[1]).unionByName(inner[2]).distinct())


@query(f"WITH {_TIPS} SELECT tree_id, tip, CAST(max(dist) - (SELECT max(dist) FROM d x WHERE x.tree_id = d.tree_id) / 2 AS DOUBLE) AS root_distance FROM d GROUP BY tree_id, tip HAVING count(*) > 1 UNION ALL SELECT tree_id, tip, CAST(own + of_grp + of_nation AS DOUBLE) FROM t WHERE (SELECT count(*) FROM t x WHERE x.tree_id = t.tree_id) = 1")
def S13_midpoint_root(spark, sf_dir):
    """Trees that aren't rooted, with the root on the middle of the longest path between two tips."""
    return trees.root_distances(_tree_nodes(Domain(spark, sf_dir)))


@query(f"WITH {_TIPS} SELECT tree_id, tip AS sample, CAST(place AS INTEGER) AS place, other AS tip, dist AS distance FROM (SELECT *, row_number() OVER (PARTITION BY tree_id, tip ORDER BY dist, other) AS place FROM d WHERE tip <> other) WHERE place <= 10")
def T03_nearest_tips(spark, sf_dir):
    """Of every tip the ten others nearest by the length of the path between them."""
    nodes = sinks.stored(_tree_nodes(Domain(spark, sf_dir)), "tree-input")
    return trees.nearest_tips(nodes, nodes.where("label <> ''").select("tree_id", "label"))


# --- origins ----------------------------------------------------------------------------------------------------------

# A customer is a sample of its nation; the suppliers of its first ten line items by date stand for its nearest tips.
_ORIGIN = """WITH x AS (SELECT o_custkey AS sample_id, CASE WHEN s_suppkey % 9 <> 0 THEN n_name END AS country, CASE WHEN l_partkey % 11 <> 0 THEN CAST(l_shipdate AS DATE) END AS date,
  row_number() OVER (PARTITION BY o_custkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_partkey) AS place FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey WHERE o_custkey % 5 <> 0),
s AS (SELECT c_custkey AS sample_id, CASE WHEN c_custkey % 23 <> 0 THEN n_name ELSE '' END AS country, CASE WHEN c_custkey % 19 <> 0 THEN CAST(first AS DATE) + CAST(c_custkey % 900 AS INTEGER) END AS date, c_mktsegment AS lineage_id
  FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first FROM orders GROUP BY 1) ON o_custkey = c_custkey),
t AS (SELECT * FROM x WHERE place <= 10 AND country IS NOT NULL),
u AS (SELECT sample_id, country, count(*) AS n, min(place) AS p FROM t GROUP BY 1, 2),
v AS (SELECT sample_id, string_agg(country || ':' || printf('%.3f', round(n / total, 3)), ',' ORDER BY n DESC, p) AS support, min_by(country, p) AS origin, CAST(any_value(total) AS BIGINT) AS total FROM (SELECT *, sum(n) OVER (PARTITION BY sample_id) AS total FROM u) GROUP BY 1),
r AS (SELECT sample_id, prev || ' -> ' || country AS route, min(k) AS k FROM (SELECT sample_id, country, lag(country) OVER w AS prev, row_number() OVER w AS k FROM t WHERE date IS NOT NULL WINDOW w AS (PARTITION BY sample_id ORDER BY date, place)) WHERE prev <> country GROUP BY 1, 2),
q AS (SELECT sample_id, string_agg(route, '; ' ORDER BY k) AS routes FROM (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY k) AS i FROM r) WHERE i <= 5 GROUP BY 1),
l AS (SELECT sample_id, max(date) AS latest FROM t GROUP BY 1),
g AS (SELECT c_mktsegment AS lineage_id, n_name AS country, count(*) AS n FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2),
h AS (SELECT lineage_id, string_agg(country || ':' || printf('%.3f', round(n / total, 3)), ',' ORDER BY n DESC, country) AS support, first(country ORDER BY n DESC, country) AS common FROM (SELECT *, sum(n) OVER (PARTITION BY lineage_id) AS total FROM g) GROUP BY 1),
c AS (SELECT lineage_id, CASE WHEN lineage_id = 'BUILDING' THEN min(country) END AS first_country, CASE WHEN lineage_id = 'MACHINERY' THEN list_sort(list_distinct(list(country))) ELSE [] END AS countries FROM g GROUP BY 1),
e AS (SELECT s.sample_id, s.country, CASE WHEN v.origin IS NOT NULL THEN 1 WHEN c.first_country IS NOT NULL THEN 2 WHEN len(c.countries) > 0 THEN 3 WHEN h.common IS NOT NULL THEN 4 ELSE 5 END AS way, v.origin, v.support, v.total, q.routes, c.first_country, c.countries, h.common, h.support AS common_support, CAST(date_diff('day', l.latest, s.date) AS INTEGER) AS gap_days
  FROM s LEFT JOIN v USING (sample_id) LEFT JOIN q USING (sample_id) LEFT JOIN l USING (sample_id) LEFT JOIN c USING (lineage_id) LEFT JOIN h USING (lineage_id)),
o AS (SELECT sample_id, country, CASE way WHEN 1 THEN origin WHEN 2 THEN first_country WHEN 3 THEN countries[1] WHEN 4 THEN common ELSE '' END AS origin, CASE way WHEN 1 THEN CASE WHEN total >= 3 THEN 'high' ELSE 'medium' END WHEN 2 THEN 'medium' ELSE 'low' END AS confidence,
  (['nearest_tree_tips', 'first_country_detected_curated', 'countries_reported_list', 'most_common_collection_country', ''])[way] AS method, CASE way WHEN 1 THEN support WHEN 2 THEN first_country WHEN 3 THEN array_to_string(countries, ',') WHEN 4 THEN common_support ELSE '' END AS support,
  CASE way WHEN 1 THEN coalesce(routes, '') ELSE '' END AS routes, gap_days FROM e)"""


def _origins(d: Domain):
    nations = F.broadcast(d.raw("nation").select("n_nationkey", "n_name"))
    first = d.raw("orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"))
    samples = d.raw("customer").join(nations, F.expr("c_nationkey = n_nationkey")).join(first, F.expr("o_custkey = c_custkey"), "left")
    samples = samples.selectExpr("c_custkey as sample_id", "if(c_custkey % 23 <> 0, n_name, '') as country", "if(c_custkey % 19 <> 0, date_add(cast(first as date), cast(c_custkey % 900 as int)), null) as date", "c_mktsegment as lineage_id")
    places = d.raw("supplier").join(nations, F.expr("s_nationkey = n_nationkey")).select("s_suppkey", "n_name")
    lines = d.raw("lineitem").join(d.raw("orders").where("o_custkey % 5 <> 0").select("o_orderkey", "o_custkey"), F.expr("l_orderkey = o_orderkey")).join(places, F.expr("l_suppkey = s_suppkey"))
    place = F.row_number().over(W.partitionBy("o_custkey").orderBy("l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey"))
    tips = lines.withColumn("place", place).where("place <= 10").selectExpr("o_custkey as sample_id", "place", "if(s_suppkey % 9 <> 0, n_name, null) as country", "if(l_partkey % 11 <> 0, cast(l_shipdate as date), null) as date")
    genomes = d.raw("orders").join(d.raw("customer"), F.expr("o_custkey = c_custkey")).join(nations, F.expr("c_nationkey = n_nationkey")).selectExpr("c_mktsegment as lineage_id", "n_name as country")
    lineages = genomes.groupBy("lineage_id").agg(F.array_sort(F.collect_set("country")).alias("all")).selectExpr("lineage_id", "if(lineage_id = 'BUILDING', all[0], null) as first_country", "if(lineage_id = 'MACHINERY', all, cast(array() as array<string>)) as countries_reported")
    return E.origin_evidence(samples, tips, lineages, genomes)


@query(f"{_ORIGIN} SELECT * FROM o")
def E11_origin_evidence(spark, sf_dir):
    """Origin, confidence, support and dissemination routes of every sample, by its nearest tips or what else is known of its lineage."""
    return _origins(Domain(spark, sf_dir))


@query(f"""{_ORIGIN}, n AS (SELECT * FROM o WHERE origin <> '' AND country <> ''), p AS (SELECT sample_id, 'new_introduction' AS scenario, 3 AS points FROM n WHERE lower(origin) <> lower(country) UNION ALL SELECT sample_id, 're_emergence', 3 FROM n WHERE gap_days > 365
UNION ALL SELECT sample_id, 'local_persistence', 1 FROM n WHERE gap_days <= 365 UNION ALL SELECT sample_id, 'local_persistence', 2 FROM n WHERE lower(origin) = lower(country)) SELECT sample_id, scenario, CAST(sum(points) AS INTEGER) AS points FROM p GROUP BY 1, 2""")
def E11_spread_scenarios(spark, sf_dir):
    """Scores of the scenarios by which a sample may have come to its country."""
    return E.spread_scenarios(_origins(Domain(spark, sf_dir)).withColumnRenamed("origin", "origin_country"))


# --- full text --------------------------------------------------------------------------------------------------------

_STEM = f"""m AS (SELECT w, CASE WHEN ends_with(w, 'sses') THEN regexp_replace(w, 'es$', '') WHEN ends_with(w, 'ies') THEN CASE WHEN length(w) > 4 THEN regexp_replace(w, 'ies$', 'i') ELSE regexp_replace(w, 'ies$', 'ie') END
  WHEN regexp_matches(w, '(us|ss)$') THEN w WHEN regexp_matches(w, '[aeiouy].+s$') THEN regexp_replace(w, 's$', '') ELSE w END AS p FROM (SELECT DISTINCT w FROM a)),
b AS (SELECT w, p, regexp_replace(p, '(ed|ing)$', '') AS bare FROM m),
k AS (SELECT w, CASE WHEN regexp_matches(p, '[aeiouy][^aeiouy].*eed$') THEN regexp_replace(p, 'eed$', 'ee') WHEN ends_with(p, 'eed') THEN p WHEN regexp_matches(p, '[aeiouy].*(ed|ing)$') THEN
  CASE WHEN regexp_matches(bare, '(at|bl|iz)$') THEN bare || 'e' WHEN regexp_matches(bare, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN left(bare, length(bare) - 1) WHEN regexp_matches(bare, '^([^aeiouy]*[aeiouy][^aeiouywx]|[aeiouy][^aeiouy])$') THEN bare || 'e' ELSE bare END ELSE p END AS s FROM b),
stems AS (SELECT w, CASE WHEN length(w) <= 2 THEN w ELSE regexp_replace(s, '(.[^aeiouy])y$', '\\1i') END AS term FROM k)"""
_SAID = f"WITH a AS (SELECT DISTINCT doc_id, w FROM (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '[a-z0-9]+')) AS w FROM documents WHERE doc_id IS NOT NULL) WHERE w NOT IN ({', '.join(repr(w) for w in fulltext.STOP_WORDS)})), {_STEM}"


@query(f"{_SAID} SELECT term, count(DISTINCT doc_id) AS documents FROM a JOIN stems USING (w) GROUP BY term")
def P07_terms(spark, sf_dir):
    """The terms of the inverted index of all documents, with the number of documents of each."""
    return fulltext.build(Domain(spark, sf_dir).raw("documents"), "doc_id", "text").terms


@query(f"{_SAID}, q(i, term) AS (VALUES (1, 'report'), (1, 'case'), (2, 'clown'), (2, 'idiot'), (3, 'thing')) SELECT i AS asked, doc_id FROM (SELECT DISTINCT i, doc_id, term FROM a JOIN stems USING (w) JOIN q USING (term)) JOIN (SELECT i, count(*) AS n FROM q GROUP BY 1) USING (i) GROUP BY i, doc_id HAVING count(*) = any_value(n)")
def P07_stemmed_search(spark, sf_dir):
    """Documents that have all terms of a query, for four queries (one of stop words only), by the index."""
    index = fulltext.build(Domain(spark, sf_dir).raw("documents"), "doc_id", "text")
    asked = ["The reporting of a case", "clowns and an idiot", "things", "of the and to"]
    out = [index.search(q).select(F.lit(i).alias("asked"), F.col("id").alias("doc_id")) for i, q in enumerate(asked, 1)]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


# --- manifests --------------------------------------------------------------------------------------------------------


@query(f"WITH {GM}, y AS (SELECT species_id, collection_year, count(*) AS n FROM gm GROUP BY 1, 2), s AS (SELECT species_id, sum(n) AS total FROM y GROUP BY 1) SELECT 1 AS manifest, species_id, collection_year, n, CAST(total AS BIGINT) AS total FROM y JOIN s USING (species_id) UNION ALL SELECT 2, species_id, collection_year, n + 1, CAST(total AS BIGINT) FROM y JOIN s USING (species_id)")
def K14_manifest_refresh(spark, sf_dir):
    """Two views refreshed together, one of them again, and both manifests read: what a reader holds stays what it was."""
    d = Domain(spark, sf_dir)
    there = Catalogue(spark, f"{sinks.shared_folder(spark)}/manifest-{uuid.uuid4().hex}")
    years = lambda c, more=0: d.genomes.groupBy("species_id", "collection_year").agg((F.count(F.lit(1)) + more).alias("n"))
    totals = lambda c: c.pending("years").groupBy("species_id").agg(F.sum("n").alias("total"))  # noqa: E731  made from the view before it
    first = there.refresh([("years", years), ("totals", totals)], "species_id")
    second = there.refresh([("years", lambda c: years(c, 1))], "species_id", ("collection_year",))
    of = lambda n: there.read("years", n).join(there.read("totals", n), "species_id").select(F.lit(n).alias("manifest"), "species_id", "collection_year", "n", "total")
    return of(first).unionByName(of(second))


# --- layers, matching, significance -----------------------------------------------------------------------------------


@query(f"""WITH {PROFILE}, {GF}, m AS (SELECT species_id, hgvs_p, variant_type, count(DISTINCT genome_accession) AS genomes, min(collection_date) AS first_seen, max(collection_date) AS last_seen FROM profile GROUP BY 1, 2, 3),
l AS (SELECT species_id, lineage_id, count(*) AS lineage_genomes FROM gm GROUP BY 1, 2), lc AS (SELECT species_id, lineage_id, collection_country, count(*) AS lineage_in_country FROM gm GROUP BY 1, 2, 3), c AS (SELECT species_id, collection_country, count(*) AS country_genomes FROM gm GROUP BY 1, 2),
y AS (SELECT species_id, collection_year, count(*) AS year_genomes FROM gm GROUP BY 1, 2), t AS (SELECT species_id, count(*) AS species_genomes FROM gm GROUP BY 1), s AS (SELECT DISTINCT genome_accession AS sample_id, species_id, lineage_id, collection_country, collection_year, gene, hgvs_p, variant_type FROM profile)
SELECT sample_id, s.hgvs_p, s.variant_type, genomes, first_seen, last_seen, lineage_genomes, lineage_in_country, country_genomes, year_genomes, species_genomes, protein_name FROM s JOIN m USING (species_id, hgvs_p, variant_type) JOIN t USING (species_id) LEFT JOIN l ON l.species_id = s.species_id AND l.lineage_id = s.lineage_id
LEFT JOIN lc ON lc.species_id = s.species_id AND lc.lineage_id = s.lineage_id AND lc.collection_country = s.collection_country LEFT JOIN c ON c.species_id = s.species_id AND c.collection_country = s.collection_country LEFT JOIN y ON y.species_id = s.species_id AND y.collection_year = s.collection_year LEFT JOIN gf ON gf.species_id = s.species_id AND gf.gene = s.gene""")
def E30_layered_lookup(spark, sf_dir):
    """All layers of a sample query for all samples: the mutation, its lineage, lineage and country, country, year, species and gene, counted in one pass."""
    d = Domain(spark, sf_dir)
    grains = sinks.stored(V.layers(d.calls, d.genomes, d.tasks), "layers")
    of = lambda grain, name, *more: grains.where(F.col("grain") == grain).select("species_id", *V.GRAINS[grain], F.col("genomes").alias(name), *more)
    s = V.variant_profile(d.calls, d.genomes, d.tasks).select(F.col("genome_accession").alias("sample_id"), "species_id", "lineage_id", "collection_country", "collection_year", "gene", "hgvs_p", "variant_type").distinct()
    out = s.join(of("mutation", "genomes", "first_seen", "last_seen"), ["species_id", "hgvs_p", "variant_type"]).join(of("species", "species_genomes"), "species_id")
    for grain, name in (("lineage", "lineage_genomes"), ("lineage_country", "lineage_in_country"), ("country", "country_genomes"), ("year", "year_genomes")):
        out = out.join(of(grain, name), ["species_id", *V.GRAINS[grain]], "left")  # a grain has as many rows as it has keys, few against the calls
    out = out.join(d.gene_function, ["species_id", "gene"], "left")
    return out.select("sample_id", "hgvs_p", "variant_type", "genomes", "first_seen", "last_seen", "lineage_genomes", "lineage_in_country", "country_genomes", "year_genomes", "species_genomes", "protein_name")


# An association of a part: some by motif (the first word of its name), some in three-letter notation; a call's domain is the least name of its gene and place.
_MATCHED = """v AS (SELECT DISTINCT genome_accession AS sample_id, species_id, upper(gene) AS gene, position, ref_aa, alt_aa, domain FROM pv LEFT JOIN (SELECT p_brand AS gene, p_size AS position, lower(min(p_name)) AS domain FROM part GROUP BY 1, 2) USING (gene, position)),
a AS (SELECT association_id, species_id, upper(protein) AS gene, position, alt_aa, CASE WHEN CAST(association_id AS BIGINT) % 3 = 0 THEN lower(split_part(phenotype_specific, ' ', 1)) END AS word, CAST(association_id AS BIGINT) % 4 = 1 AS noted, p_size FROM gp JOIN part ON CAST(p_partkey AS VARCHAR) = association_id),
w AS (SELECT sample_id, association_id, 0 AS i FROM v JOIN a USING (species_id, gene, position, alt_aa) UNION ALL SELECT sample_id, association_id, 1 FROM v JOIN a USING (species_id, gene) WHERE a.position IS NULL AND (contains(domain, word) OR contains(word, domain))
UNION ALL SELECT sample_id, association_id, 2 FROM v JOIN a USING (species_id, gene) WHERE noted AND v.ref_aa = 'F' AND v.position = p_size AND v.alt_aa = a.alt_aa UNION ALL SELECT sample_id, association_id, 3 FROM v JOIN a USING (species_id, gene) WHERE a.position IS NULL)"""


@query(f"WITH {PV}, {GP}, {_MATCHED} SELECT sample_id, association_id, (['exact', 'motif', 'notation', 'gene'])[min(i) + 1] AS way FROM w GROUP BY 1, 2")
def E25_phenotype_matching(spark, sf_dir):
    """Associations of every sample by exact change, motif, notation and gene; each once, by the first of these."""
    d = Domain(spark, sf_dir)
    parts = d.raw("part")
    domains = parts.groupBy(F.col("p_brand").alias("gene"), F.col("p_size").alias("position")).agg(F.min("p_name").alias("domain"))
    v = d.calls.withColumnRenamed("genome_accession", "sample_id").join(domains, ["gene", "position"], "left")
    known = d.associations.join(parts.select(F.col("p_partkey").cast("string").alias("association_id"), "p_size"), "association_id")
    rows = known.selectExpr(
        "association_id", "species_id", "protein", "position", "alt_aa", "if(cast(association_id as bigint) % 3 = 0, concat('Motif: ', split_part(phenotype_specific, ' ', 1), ', near the end'), 'none known') as description",
        "if(cast(association_id as bigint) % 4 = 1, concat('p.Phe', p_size, case alt_aa when 'R' then 'Arg' when 'A' then 'Ala' else 'Asn' end), null) as notation",
    )
    return E.match_phenotypes(v, rows)


_PLACED = f"""WITH {PROFILE}, k AS (SELECT gene, position, alt_aa, list_distinct(list(lineage_id) FILTER (lineage_id IS NOT NULL)) AS lineages FROM profile WHERE CAST(genome_accession AS BIGINT) % 3 = 0 GROUP BY 1, 2, 3),
g AS (SELECT protein AS gene, position, alt_aa, count(*) AS n FROM ({{}}) WHERE position IS NOT NULL AND protein IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT DISTINCT genome_accession AS sample_id, lineage_id, hgvs_p, variant_type, gene, position, ref_aa, alt_aa FROM profile),
z AS (SELECT s.*, CASE WHEN ref_aa = alt_aa THEN 'synonymous' WHEN k.gene IS NULL THEN 'absent' WHEN list_contains(coalesce(lineages, []), lineage_id) THEN 'typical' ELSE 'atypical' END AS significance, position <= 3 AS hotspot, coalesce(n, 0) AS phenotypes
  FROM s LEFT JOIN k USING (gene, position, alt_aa) LEFT JOIN g USING (gene, position, alt_aa))""".format("SELECT CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_brand END AS protein, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS position, CASE p_partkey % 3 WHEN 0 THEN 'R' WHEN 1 THEN 'A' ELSE 'N' END AS alt_aa FROM part")


def _placed(d: Domain):
    """All calls against a catalogue of a third of the genomes."""
    p = V.variant_profile(d.calls, d.genomes, d.tasks)
    known = p.where("cast(genome_accession as bigint) % 3 = 0").groupBy("gene", "position", "alt_aa").agg(F.collect_set("lineage_id").alias("lineage_ids"))
    keys = ["gene", "position", "alt_aa"]
    matched = d.associations.where("position is not null and protein is not null").groupBy(F.col("protein").alias("gene"), "position", "alt_aa").agg(F.count(F.lit(1)).alias("phenotypes"))
    calls = p.select(F.col("genome_accession").alias("sample_id"), "lineage_id", "hgvs_p", "variant_type", *keys, "ref_aa").distinct().withColumn("hotspot", F.col("position") <= 3)
    return E.significance(calls.join(matched, keys, "left").fillna(0, ["phenotypes"]), known)


@query(f"{_PLACED} SELECT sample_id, hgvs_p, variant_type, significance, hotspot, phenotypes FROM z")
def E08_significance(spark, sf_dir):
    """Every call's place in the mutation profile, with its hotspot and phenotypes."""
    return _placed(Domain(spark, sf_dir)).select("sample_id", "hgvs_p", "variant_type", "significance", "hotspot", "phenotypes")


@query(f"""{_PLACED}, h AS (SELECT sample_id, bool_or(significance = 'typical') AS b1, bool_or(significance = 'atypical') AS b2, bool_or(significance = 'absent') AS b3, bool_or(significance = 'synonymous') AS b4, bool_or(hotspot) AS b5, bool_or(phenotypes > 0) AS b6 FROM z GROUP BY 1),
f AS (SELECT sample_id, unnest([CASE WHEN b1 THEN 'typical' END, CASE WHEN b2 THEN 'atypical' END, CASE WHEN b3 THEN 'uncharacterized' END, CASE WHEN b4 THEN 'synonymous' END, CASE WHEN b5 THEN 'functional_hotspot' END, CASE WHEN b6 THEN 'known_phenotype' ELSE 'no_known_phenotype' END]) AS finding_type FROM h)
SELECT sample_id, 'genomic_significance' AS analysis, finding_type, CASE WHEN finding_type IN ('typical', 'synonymous', 'functional_hotspot') THEN 'high' WHEN finding_type = 'no_known_phenotype' THEN 'low' ELSE 'medium' END AS confidence FROM f WHERE finding_type IS NOT NULL""")
def E08_profile_findings(spark, sf_dir):
    """The findings that each sample's mutation profile gives."""
    return E.significance_findings(_placed(Domain(spark, sf_dir)))


# --- documents and SQL ------------------------------------------------------------------------------------------------


@query()
def T10_trimmed_documents(spark, sf_dir):
    """A nested document of every customer's orders, within 900 characters; held against a plain loop in the tests."""
    o = Domain(spark, sf_dir).raw("orders")
    lines = F.struct("o_orderkey", F.array("o_orderstatus", "o_orderpriority").alias("tags"))
    docs = o.groupBy(F.col("o_custkey").alias("doc")).agg(F.sort_array(F.collect_list(lines)).alias("orders"), F.sort_array(F.collect_set(F.year("o_orderdate"))).alias("years"))  # a document is one row
    text = F.to_json(F.struct(F.col("doc").alias("id"), F.struct("orders", F.struct("years").alias("time")).alias("evidence")))
    return X.trimmed_documents(docs.select("doc", text.alias("document")), 900)


@query("""SELECT p_partkey, CASE WHEN p_size % 3 <> 0 THEN CASE WHEN p_size % 2 = 0 THEN 'A' ELSE 'V' END END AS ref, CASE WHEN p_size % 3 <> 0 THEN p_size END AS position, CASE WHEN p_size % 3 <> 0 THEN '*' END AS alt,
CASE WHEN p_size % 7 <= p_size % 11 AND p_size % 11 > 0 THEN round((p_size % 7) * 100.0 / (p_size % 11), 2) END AS rate, v.position AS at, 'K' AS ref_aa, 'W' AS alt_aa FROM part, (SELECT 40 AS position) v""")
def F38_sql_functions(spark, sf_dir):
    """parse_hgvs, cfr and the table function call_variants, asked in SQL."""
    register(spark)
    text = "concat('p.', if(p_size % 2 = 0, 'Ala', 'V'), p_size, if(p_size % 3 = 0, '?', 'Ter'))"
    return spark.sql(
        f"SELECT p_partkey, parse_hgvs({text}).ref AS ref, parse_hgvs({text}).position AS position, parse_hgvs({text}).alt AS alt, cfr(p_size % 11, p_size % 7) AS rate, v.position AS at, v.ref_aa, v.alt_aa "
        "FROM {part}, LATERAL call_variants(concat(repeat('ACDEFGHIKLMNPQRSTVY', 2), 'A', 'K', repeat('MNPQRS', 12)), concat(repeat('ACDEFGHIKLMNPQRSTVY', 2), 'A', 'W', repeat('MNPQRS', 12))) v",
        part=J.dealt(Domain(spark, sf_dir).raw("part").select("p_partkey", "p_size"), 10_000),  # a small file, but a Python call a row
    )

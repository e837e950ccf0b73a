"""Column functions, readers and sinks, each in a query of its own; SQL states its values itself."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import mining as M
from ..sources import readers, sinks
from .domain import GM, Domain

ORACLES: dict[str, str] = {}
QUERIES: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _parts(spark, sf_dir):
    return Domain(spark, sf_dir).raw("part")


def _folder(spark, name: str) -> str:
    """A new folder of its own for every run, so that runs side by side don't meet."""
    return f"{sinks.shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query("""WITH r(one, three) AS (VALUES ('A', 'Ala'), ('R', 'Arg'), ('N', 'Asn'), ('D', 'Asp'), ('C', 'Cys'), ('Q', 'Gln'), ('E', 'Glu'), ('G', 'Gly'), ('H', 'His'), ('I', 'Ile'), ('L', 'Leu'),
  ('K', 'Lys'), ('M', 'Met'), ('F', 'Phe'), ('P', 'Pro'), ('S', 'Ser'), ('T', 'Thr'), ('W', 'Trp'), ('Y', 'Tyr'), ('V', 'Val'), ('*', 'Ter')),
p AS (SELECT p_partkey, upper(substr(p_name, 1 + p_size % length(p_name), 1)) AS letter, lower(substr(p_name, 1 + p_size % length(p_name), 3)) AS code FROM part)
SELECT p_partkey, letter AS one, a.three AS three, a.one AS back, CASE WHEN length(code) = 1 THEN upper(code) ELSE b.one END AS found FROM p LEFT JOIN r a ON letter = a.one LEFT JOIN r b ON code = lower(b.three)""")
def F04_residues(spark, sf_dir):
    """Letters of every name as residues in one and in three letters, there and back, and what stands at its place as a code; in any case."""
    at = lambda n: F.expr(f"substr(p_name, 1 + p_size % length(p_name), {n})")
    rows = _parts(spark, sf_dir).select("p_partkey", "p_size", S.to_one_letter(at(1)).alias("one"), S.to_one_letter(F.initcap(at(3))).alias("found"))
    rows = rows.withColumn("three", S.to_three_letters(F.col("one")))
    return rows.select("p_partkey", "one", "three", S.to_one_letter(F.expr("if(p_size % 2 = 0, upper(three), three)")).alias("back"), "found")


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'p.Ala' || p_size || 'Val' WHEN 1 THEN 'p.Ala' || p_size || 'del' ELSE 'p.' || p_size || '_' || (p_size + 1) || 'insVal' END AS hgvs FROM part")
def F05_protein_change(spark, sf_dir):
    ref, alt = F.expr("if(p_partkey % 3 = 2, '-', 'A')"), F.expr("if(p_partkey % 3 = 1, '-', 'V')")
    return _parts(spark, sf_dir).select("p_partkey", S.protein_change(ref, F.col("p_size"), alt).alias("hgvs"))


@query("SELECT p_partkey, p_brand || '-L' || p_size AS lineage_id FROM part")
def F07_lineage_id(spark, sf_dir):
    """Clades with and without their species before them."""
    clade = F.expr("if(p_partkey % 2 = 0, concat('L', p_size), concat(p_brand, '-L', p_size))")
    return _parts(spark, sf_dir).select("p_partkey", S.lineage_id(F.col("p_brand"), clade).alias("lineage_id"))


#: Spellings that parts take by their size, so that every one occurs; the last stands for names that no spelling is kept of.
_SPELLED = "['DRC', 'Democratic Republic of the Congo', 'DR Congo', 'Congo-Kinshasa', 'Congo (DRC)', 'ROC', 'Congo', 'Congo-Brazzaville', 'Republic of the Congo', 'USA', 'United States', 'United States of America', 'us', 'UK', 'united kingdom', 'GREAT BRITAIN', 'Guinea']"


@query(f"""WITH s(said, name) AS (VALUES ('drc', 'democratic republic of the congo'), ('democratic republic of the congo', 'democratic republic of the congo'), ('dr congo', 'democratic republic of the congo'),
  ('congo-kinshasa', 'democratic republic of the congo'), ('congo (drc)', 'democratic republic of the congo'), ('roc', 'republic of the congo'), ('congo', 'republic of the congo'), ('congo-brazzaville', 'republic of the congo'),
  ('republic of the congo', 'republic of the congo'), ('usa', 'united states'), ('united states', 'united states'), ('united states of america', 'united states'), ('us', 'united states'), ('uk', 'united kingdom'),
  ('united kingdom', 'united kingdom'), ('great britain', 'united kingdom')),
p AS (SELECT p_partkey, lower(trim(CASE WHEN p_size > 34 THEN p_name ELSE ({_SPELLED})[1 + p_size % 17] END)) AS said FROM part)
SELECT p_partkey, coalesce(name, said) AS country FROM p LEFT JOIN s USING (said)""")
def F08_country_name(spark, sf_dir):
    """Every spelling, in any case and between blanks, and names that no spelling is kept of."""
    spelled = F.expr(f"concat(' ', if(p_size > 34, p_name, element_at(array({_SPELLED[1:-1]}), 1 + p_size % 17)), if(p_size % 2 = 0, '  ', ''))")
    return _parts(spark, sf_dir).select("p_partkey", S.country_name(spelled).alias("country"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 OR p_size >= 36 THEN 'complete' WHEN p_size >= 24 THEN 'near-complete' ELSE 'partial' END AS completeness FROM part")
def F11_completeness(spark, sf_dir):
    said = F.expr("if(p_partkey % 4 = 0, 'Isolate x, Complete Genome', p_name)")
    return _parts(spark, sf_dir).select("p_partkey", S.completeness(F.col("p_size") * 500, said).alias("completeness"))


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN 'May 3, ' || CAST(year(o_orderdate) AS VARCHAR) WHEN 2 THEN '14 june 2014' ELSE '' END AS found FROM orders")
def F14_first_date(spark, sf_dir):
    text = F.expr("case o_orderkey % 4 when 0 then concat('May 3, 2001 or ', date_format(o_orderdate, 'yyyy-MM-dd'), ' and 1999-01-01') when 1 then concat('On 1 June 2000, not May 3, ', year(o_orderdate), '.') when 2 then 'since 14 june 2014' else 'in June 2014' end")
    return Domain(spark, sf_dir).raw("orders").select("o_orderkey", S.first_date_in_text(text).alias("found"))


@query("SELECT p_partkey, 'gpa_' || substr(sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode(p_name || '|é')), 1, 12) AS association_id FROM part")
def F22_association_id(spark, sf_dir):
    return _parts(spark, sf_dir).select("p_partkey", S.association_id(F.concat("p_name", F.lit("|é"))).alias("association_id"))


@query("SELECT p_partkey, substr('a & b < ' || p_name || ' end', 1, 20) AS text FROM part")
def F25_plain_text(spark, sf_dir):
    html = F.concat(F.lit("<p>a &amp; b</p>\n&lt; <b class='x'>"), "p_name", F.lit("</b>&nbsp; end"))
    return _parts(spark, sf_dir).select("p_partkey", S.plain_text(html, 20).alias("text"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_brand || ' ' || p_name ELSE p_name END AS text FROM part")
def F27_joined_text(spark, sf_dir):
    return _parts(spark, sf_dir).select("p_partkey", S.joined_text(F.expr("if(p_partkey % 2 = 0, concat(' ', p_brand), ' ')"), F.lit(None).cast("string"), F.col("p_name")).alias("text"))


@query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand WHEN 1 THEN p_name ELSE 'none' END AS given FROM part")
def F28_first_given(spark, sf_dir):
    return _parts(spark, sf_dir).select("p_partkey", S.first_given(F.expr("case p_partkey % 3 when 0 then p_brand when 1 then '' end"), F.expr("if(p_partkey % 3 = 1, p_name, '')"), F.lit("none")).alias("given"))


@query("SELECT p_partkey, substr(p_name, greatest(p_size % 12 - 4, 0) + 1, p_size % 12 + 4 - greatest(p_size % 12 - 4, 0)) AS around FROM part")
def F33_context(spark, sf_dir):
    return _parts(spark, sf_dir).select("p_partkey", S.context(F.col("p_name"), F.col("p_size") % 12, 4).alias("around"))


@query(r"""WITH t AS (SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) || ': 2014 Update ' || page_id || ', Ebola virus-disease OUTBREAK en html!' AS title FROM pages)
SELECT page_id, trim(regexp_replace(trim(lower(regexp_replace(regexp_replace(regexp_replace(title, '[0-9]{4}', '', 'g'), '[^a-zA-Z\s]', ' ', 'g'), '\s+', ' ', 'g'))), '\b(update|en|ebola|virus|disease|outbreak|item|html|[0-9]+)\b', '', 'g')) AS key FROM t""")
def F34_title_key(spark, sf_dir):
    """The title of every page, with years, numbers and the words that all titles have."""
    title = F.concat(F.regexp_extract("html", "<title>([^<]*)</title>", 1), F.lit(": 2014 Update "), F.col("page_id").cast("string"), F.lit(", Ebola virus-disease OUTBREAK en html!"))
    return Domain(spark, sf_dir).raw("pages").select("page_id", S.title_key(title).alias("key"))


@query("SELECT o_orderkey, 'RUN-' || strftime(o_orderdate, '%Y%m%d') || '-' || CAST(o_custkey AS VARCHAR) AS run FROM orders")
def F37_run_id(spark, sf_dir):
    return Domain(spark, sf_dir).raw("orders").select("o_orderkey", S.run_id("RUN", F.col("o_orderdate").cast("date"), F.col("o_custkey").cast("string")).alias("run"))


#: Words of descriptions in the order of the ladder, of which every part takes two.
_LADDER = """(1, 'vaccine_effectiveness', 'vaccine'), (1, 'vaccine_effectiveness', 'vaccination'), (1, 'vaccine_effectiveness', 'immunization'), (2, 'immune_escape', 'antibody'), (2, 'immune_escape', 'neutraliz'), (2, 'immune_escape', 'immunoglobulin'),
 (2, 'immune_escape', 'escape'), (2, 'immune_escape', 'antagonize'), (2, 'immune_escape', 'antagonist'), (3, 'disease_severity', 'severity'), (3, 'disease_severity', 'severe'), (3, 'disease_severity', 'mortality'), (3, 'disease_severity', 'lethal'),
 (3, 'disease_severity', 'fatal'), (3, 'disease_severity', 'virulence'), (3, 'disease_severity', 'virulent'), (3, 'disease_severity', 'pathogenicity'), (3, 'disease_severity', 'pathogen'), (4, 'increased_transmission', 'transmission'),
 (4, 'increased_transmission', 'transmissible'), (5, 'drug_resistance', 'resistance'), (5, 'drug_resistance', 'resistant'), (6, 'drug_susceptibility', 'susceptib'), (6, 'drug_susceptibility', 'sensitive'), (6, 'drug_susceptibility', 'sensitivity'),
 (7, 'host_adaptation', 'host adaptation'), (7, 'host_adaptation', 'adapted to'), (7, 'host_adaptation', 'mouse-adapted'), (7, 'host_adaptation', 'guinea pig-adapted'), (7, 'host_adaptation', 'isolate'), (8, 'host_range', 'host range'),
 (8, 'host_range', 'host tropism'), (8, 'host_range', 'species specificity'), (9, 'virulence', 'replication'), (9, 'virulence', 'replicative'), (9, 'virulence', 'release'), (9, 'virulence', 'entry'), (9, 'virulence', 'enter'), (9, 'virulence', 'infectivity'),
 (9, 'virulence', 'oligomerization'), (9, 'virulence', 'trimerization'), (9, 'virulence', 'processing'), (9, 'virulence', 'localization'), (9, 'virulence', 'rna-binding'), (9, 'virulence', 'binding'), (9, 'virulence', 'fusion'), (9, 'virulence', 'synthesis'),
 (9, 'virulence', 'interaction'), (9, 'virulence', 'shedding'), (9, 'virulence', 'secretion'), (9, 'virulence', 'counteract'), (9, 'virulence', 'budding')"""
_TOLD = "['vaccine', 'vaccination', 'immunization', 'antibody', 'neutraliz', 'immunoglobulin', 'escape', 'antagonize', 'severity', 'mortality', 'fatal', 'virulent', 'pathogen', 'transmission', 'transmissible', 'resistance', 'resistant', 'susceptib', 'sensitivity', 'host adaptation', 'adapted to', 'guinea pig-adapted', 'isolate', 'host range', 'host tropism', 'species specificity', 'replication', 'release', 'entry', 'oligomerization', 'rna-binding', 'fusion', 'budding', 'IFN', 'colour', 'shape', 'weight', 'nothing', 'size', 'length']"


@query(f"""WITH l(step, category, word) AS (VALUES {_LADDER}),
p AS (SELECT p_partkey, lower('Seen on ' || p_name || ': ' || ({_TOLD})[1 + p_partkey * 7 % 40] || ' and ' || ({_TOLD})[1 + p_size % 40]) AS text FROM part)
SELECT p_partkey, coalesce((SELECT arg_min(category, step) FROM l WHERE contains(text, word)), 'unknown_significance') AS category FROM p""")
def X19_described_phenotype(spark, sf_dir):
    """The first step of the ladder that a description reaches, also where it holds words of later ones; each holds two words, in either case."""
    told = f"array({_TOLD[1:-1]})"
    text = F.expr(f"concat('Seen on ', p_name, ': ', upper(element_at({told}, cast(1 + p_partkey * 7 % 40 as int))), ' and ', element_at({told}, cast(1 + p_size % 40 as int)))")
    return _parts(spark, sf_dir).select("p_partkey", M.described_phenotype(text).alias("category"))


@query(f"WITH {GM} SELECT genome_accession, collection_country, collection_year FROM gm")
def S05_csv(spark, sf_dir):
    """A table by way of CSV: names with commas and quotes, nulls, and a file that isn't there."""
    folder = _folder(spark, "csv")
    rows = Domain(spark, sf_dir).genomes.select("genome_accession", F.concat(F.lit('a "b", '), "collection_country").alias("place"), "collection_year")
    rows.write.option("header", True).option("escape", '"').csv(folder)
    schema = "genome_accession string, place string, collection_year int"
    back = readers.csv(spark, folder, schema).unionByName(readers.csv(spark, folder + "-none", schema))
    return back.select("genome_accession", F.substring("place", 8, 100).alias("collection_country"), "collection_year")


@query("SELECT p_partkey, p_brand, p_size > 25 AS large, p_name || '|x, y' AS names FROM part")
def S07_catalogue_csv(spark, sf_dir):
    """An export with array texts, flags of one letter and empty texts."""
    folder = _folder(spark, "catalogue")
    p = _parts(spark, sf_dir).select("p_partkey", "p_brand", F.expr("if(p_size > 25, 't', 'f')").alias("large"), S.array_literal(F.array("p_name", F.lit("x, y"))).alias("names"))
    p.write.option("header", True).option("escape", '"').csv(folder)
    return readers.catalogue_csv(spark, folder, "p_partkey long, p_brand string, large string, names string", arrays=["names"], flags=["large"]).withColumn("names", F.array_join("names", "|"))


@query("SELECT CAST(p_partkey AS VARCHAR) AS id, upper(p_brand) || 'ACGT' AS sequence FROM part")
def S09_fasta(spark, sf_dir):
    """Records with headers and sequences over several lines."""
    folder = _folder(spark, "fasta")
    _parts(spark, sf_dir).select(F.concat(F.lit(">"), F.col("p_partkey").cast("string"), F.lit(" some text\n"), F.upper("p_brand"), F.lit("\nAC\nGT"))).write.text(folder)
    return readers.fasta(spark, folder)


@query("SELECT r_name AS dataset, count(*) AS n, sum(n_nationkey) AS keys FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def S11_screening(spark, sf_dir):
    """Result tables of several datasets by one glob, the file naming the dataset."""
    folder = _folder(spark, "screening")
    d = Domain(spark, sf_dir)
    for r in d.raw("region").select("r_regionkey", "r_name").collect():  # a dimension of fixed size
        d.raw("nation").where(f"n_regionkey = {r['r_regionkey']}").select("n_nationkey", "n_name").coalesce(1).write.option("header", True).option("sep", "\t").csv(f"{folder}/{r['r_name']}.d")
    rows = readers.screening(spark, f"{folder}/*.d", "n_nationkey long, n_name string", name=r"/([^/]+)\.d/")
    return rows.groupBy("dataset").agg(F.count(F.lit(1)).alias("n"), F.sum("n_nationkey").alias("keys"))


@query("SELECT CAST(n_nationkey AS BIGINT) AS sample_id, n_name AS lineage FROM nation")
def S08_sample_documents(spark, sf_dir):
    """A JSON document per sample, read by a glob."""
    folder = _folder(spark, "documents")
    n = Domain(spark, sf_dir).raw("nation").select(F.to_json(F.struct(F.col("n_nationkey").alias("sample_id"), F.col("n_name").alias("lineage"))).alias("document"), F.col("n_nationkey").alias("folder"))
    n.write.partitionBy("folder").text(folder)
    return readers.sample_documents(spark, f"{folder}/*/*.txt", "sample_id long, lineage string").select("sample_id", "lineage")


@query("SELECT 'region' AS entity, count(*) AS n FROM region UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'none', 0")
def K15_entities(spark, sf_dir):
    """One Parquet table per entity, read back; an empty one keeps its schema."""
    d, folder = Domain(spark, sf_dir), _folder(spark, "entities")
    tables = {"region": d.raw("region"), "nation": d.raw("nation"), "none": d.raw("nation").where("false")}
    sinks.write_entities(tables, folder)
    counts = [spark.read.schema(t.schema).parquet(f"{folder}/{name}").agg(F.lit(name).alias("entity"), F.count(F.lit(1)).alias("n")) for name, t in tables.items()]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query(f"WITH {GM} SELECT species_id, collection_year, count(*) AS n FROM gm GROUP BY 1, 2")
def K14_refreshed_views(spark, sf_dir):
    """Views that are refreshed one after another; the second is made from the first as it was written."""
    g = Domain(spark, sf_dir).genomes
    first = sinks.materialised_view(g.groupBy("species_id", "collection_country", "collection_year").agg(F.count(F.lit(1)).alias("n")), "mv_country_year", partition="species_id", order=["collection_year"])
    views = sinks.refresh_all([("mv_year", lambda: first.groupBy("species_id", "collection_year").agg(F.sum("n").alias("n")))], "species_id", ["collection_year"])
    return views["mv_year"].select("species_id", "collection_year", "n")

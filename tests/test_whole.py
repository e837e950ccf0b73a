"""Queries over whole tables, against plain Python where there is no SQL."""

import random
import re

import pytest
from pyspark.sql import functions as F

from helixlake.operators import evidence as E
from helixlake.operators import mining as M
from helixlake.operators import sequence as Q
from helixlake.plans import registry
from helixlake.plans.domain import Domain

SAMPLE = {"E30_layered_lookup": "sample_id", "E26_enrichment": "genome_accession", "E08_significance": "sample_id", "J17_tip_metadata": "tip", "K16_sample_documents": "sample_id"}


@pytest.mark.parametrize("name", sorted(SAMPLE))
def test_every_sample_takes_part(spark, sf_dir, name):
    d = Domain(spark, sf_dir)
    want = {r[0] for r in (d.genomes if name[0] in "JK" else d.calls).select("genome_accession").distinct().collect()}
    assert {r[0] for r in registry.QUERIES[name](spark, sf_dir).select(SAMPLE[name]).distinct().collect()} == want


def test_candidates_of_all_reports(spark, sf_dir):
    want = set()
    for r in Domain(spark, sf_dir).reports.select("ordinal", "text").collect():
        for category, patterns in M.PHENOTYPES:
            if any(re.search(p, r["text"].lower()) for p in patterns):
                want |= {(r["ordinal"], kind, category) for kind in ("variant", "motif") if kind == "variant" or r["ordinal"] % 2}
    got = [tuple(r) for r in registry.QUERIES["X16_candidates"](spark, sf_dir).select("id", "kind", "category").collect()]
    assert len(got) == len(set(got)) and set(got) == want


def plain_identity(a, b):
    best = 0.0
    for k in (-30, -10, -3, 0, 3, 10, 30):
        x, y = (a[k:], b) if k >= 0 else (a, b[-k:])
        if min(len(x), len(y)):
            best = max(best, sum(p == q for p, q in zip(x, y)) / min(len(a), len(b)))
    return best


@pytest.mark.parametrize(("a", "b"), [("", ""), ("A", ""), ("ACD", "ACD"), ("ACDEFGHIKLMNPQRSTVWY" * 3, "FGHIKLMNPQRSTVWY" * 3), ("A" * 40, "A" * 9)])
def test_identity_matches_plain_loop(a, b):
    assert Q.identity(a, b) == plain_identity(a, b)


def test_best_frames_of_every_part(spark, sf_dir):
    regions = {r["r_regionkey"]: r["r_name"] for r in spark.read.parquet(f"{sf_dir}/region.parquet").collect()}
    codon = {}
    for c, a in Q.CODONS.items():
        codon.setdefault(a, c)
    genomes, genes = [], {}
    for r in sorted(spark.read.parquet(f"{sf_dir}/part.parquet").collect(), key=lambda r: r["p_partkey"]):
        residues = re.sub("[^ACDEFGHIKLMNPQRSTVWY]", "", r["p_name"].upper())
        protein, species = (residues + "ACDEFGHIKLMNPQRSTVWY")[:20] * 9, regions[r["p_partkey"] % 5]
        genomes.append((str(r["p_partkey"]), species, "".join(codon[a] for a in protein)))
        genes.setdefault(species, {}).setdefault(r["p_brand"], protein)
    want = {}
    for accession, species, dna in genomes:
        for gene, protein in genes[species].items():
            best = max((plain_identity(f, protein) for f in Q.reading_frames(dna)), default=0.0)
            if best > 0.25:
                want[accession, gene] = pytest.approx(best, abs=1e-4)
    got = {(r["genome_accession"], r["gene"]): r["score"] for r in registry.QUERIES["Q03_best_frames"](spark, sf_dir).collect()}
    assert {a for a, _ in got} == {a for a, _, _ in genomes}
    assert len({g for _, g in got}) > 1
    assert got == want


def test_comparative_outbreaks_match_plain_loop(spark):
    rng = random.Random(3)
    places = ["Mali", "MALI", "Guinea", "Ghana", "", None]
    outbreaks = [(i, rng.choice(places), rng.choice([None, *range(1950, 2025)]), rng.choice([None, 0, 7])) for i in range(400)]
    samples = [(f"s{i}", rng.choice([*places, "Chad"]), rng.choice([None, 1900, *range(1945, 2040)])) for i in range(150)] + [("old", "Chad", 1900), ("none", None, None), ("mali", "Mali", 1900)]
    got = E.comparative_outbreaks(spark.createDataFrame(samples, "sample string, country string, year int"), spark.createDataFrame(outbreaks, "outbreak long, country string, year int, cases int"))
    found = {}
    for r in got.orderBy("sample", F.col("score").desc(), "outbreak").collect():
        found.setdefault(r["sample"], []).append((r["outbreak"], r["score"]))
    for sample, country, year in samples:
        scored = []
        for i, c, y, cases in outbreaks:
            score = 2.0 * bool(country and c and c.lower() == country.lower())
            if year is not None and y is not None:
                score += 2 if abs(year - y) <= 5 else 1 if abs(year - y) <= 10 else 0
            score += 0.5 * bool(cases)
            if score > 0:
                scored.append((i, score))
        assert found[sample] == sorted(scored, key=lambda x: (-x[1], x[0]))[:5]
    few = E.comparative_outbreaks(spark.createDataFrame([("x", "Chad", 1900)], "sample string, country string, year int"), spark.createDataFrame([(1, "Mali", 2000, 0), (2, "Mali", 1894, None), (3, "Mali", 1910, 0)], "outbreak long, country string, year int, cases int"))
    assert sorted(map(tuple, few.collect())) == [("x", 2, 1.0), ("x", 3, 1.0)]


def test_a_lineage_without_outbreaks_gets_all_of_them(spark):
    v = spark.createDataFrame([("s1", "a", "h1", "k"), ("s2", "b", "h2", "k"), ("s3", None, "h3", "x"), ("s4", "c", "h4", "k")], "sample_id string, lineage_id string, hgvs_p string, phenotype_key string")
    p = spark.createDataFrame([("k", "P")], "phenotype_key string, phenotype string")
    many = [(f"o{i:05}", "other") for i in range(2500)]
    own = [("o1", "a"), ("o1", "a"), (None, "c")]
    def listed(outbreaks):
        samples, lists = E.harmonise(v, p, outbreaks)
        held = {}
        for r in lists.collect():
            held.setdefault(r["list_key"], []).append(r["outbreak"])
        return {r["sample_id"]: (r, sorted(held.get(r["list_key"], []))) for r in samples.collect()}

    got = listed(spark.createDataFrame(many + own, "outbreak string, lineage_id string"))
    every = sorted({o for o, _ in many + own if o})
    assert {s: found for s, (_, found) in got.items()} == {"s1": ["o1"], "s2": every, "s3": every, "s4": every}
    assert got["s1"][0]["variants"] == ["h1"] and got["s1"][0]["phenotypes"] == ["P"] and got["s3"][0]["phenotypes"] == []
    none = listed(spark.createDataFrame([], "outbreak string, lineage_id string"))
    assert [found for _, found in none.values()] == [[]] * 4


def test_phenotype_join_matches_plain_loop(spark):
    """The three ways to an association, each pair once, with nulls in every key; on either grain."""
    from helixlake.plans import views as V

    rng = random.Random(8)
    pick = lambda *x: rng.choice([None, *x])
    calls = [("p", rng.choice("st"), f"g{i}", pick("G", "H"), pick(1, 2), pick("A", "V"), pick("L", "M")) for i in range(60)]
    known = [("p", rng.choice("st"), f"a{i}", pick("G", "H"), pick(1, 2), pick("A", "V"), pick("L", "M")) for i in range(25)]
    a = spark.createDataFrame(known, "pathogen_id string, species_id string, association_id string, protein string, position int, alt_aa string, lineage_id string")
    c = spark.createDataFrame(calls, "pathogen_id string, species_id string, genome string, gene string, position int, alt_aa string, lineage_id string")

    def meets(call, one, lineages):
        _, species, _, gene, position, alt, _ = call
        _, s, _, protein, at, residue, lineage = one
        exact = None not in (gene, position, alt) and (gene, position, alt) == (protein, at, residue)
        return species == s and (exact or (lineage is not None and lineage in lineages) or (at is None and protein is not None and protein == gene))

    def want(lineages):
        out = []
        for x in calls:
            hits = [y[2] for y in known if meets(x, y, lineages(x))]
            out += [(x[2], h) for h in hits] or [(x[2], None)]
        return sorted(out, key=str)

    got = V.with_phenotype(c, a).select("genome", "g_association_id").collect()
    assert sorted(map(tuple, got), key=str) == want(lambda x: [x[6]])
    several = {None: [], "L": ["L"], "M": ["L", "M"]}
    listed = c.withColumn("lineage_ids", F.expr("case lineage_id when 'L' then array('L') when 'M' then array('L', 'M') else cast(array() as array<string>) end"))
    got = V.catalogue_with_phenotype(listed.drop("lineage_id"), a).select("genome", "g_association_id").collect()
    assert sorted(map(tuple, got), key=str) == want(lambda x: several[x[6]])

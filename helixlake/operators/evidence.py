"""Evidence analyzers: findings, scores and tiers as rule tables over per-sample facts.

Every analyzer is a function from DataFrames to long rows (sample_id, analysis, finding_type, confidence, detail), so that
all samples are judged in one job and the rows of all analyzers can be put together with unionByName.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import parse_protein_change
from ..schemas import RISK_TIERS, rank_of
from ..sources.sinks import stored
from .joins import met, spread


@dataclass(frozen=True)
class Thresholds:
    """Constants of the rules, all of them parameters."""

    close_snps: int = 5
    clock_delay_days: int = 30
    surveillance_gap_days: int = 730
    recent_since: str = "2023-01-01"
    days_per_generation: int = 14
    recurrence_years: float = 2.0
    genome_length: int = 19_000
    burden_novelty: float = 0.3


DEFAULTS = Thresholds()
# Weight of the strongest evidence in the confidence score; others weigh nothing.
STRENGTH_WEIGHT = {"strong": 1.0, "moderate": 0.6, "weak": 0.3}
# Points by criterion and finding.
CRITERIA = (
    ("local_transmission", "close_genetic_match", 3), ("local_transmission", "country_previously_reported", 1), ("local_transmission", "continued_circulation", 1),
    ("local_transmission", "re-emergence", 1), ("local_transmission", "r0_estimate", 1), ("geographic_expansion", "novel_geographic_detection", 2),
    ("geographic_expansion", "geographic_mismatch", 1), ("geographic_expansion", "spillover_risk", 1), ("international_spread", "dissemination_pathways", 2),
    ("international_spread", "genetic_relatedness_summary", 1), ("international_spread", "international_spread_risk", 1), ("international_spread", "geographic_coverage_gap", 1),
    ("diagnostic", "known_phenotype", 1), ("vaccine", "known_phenotype", 1), ("vaccine", "functional_hotspot", 1), ("vaccine", "vaccine_escape", 1), ("therapeutic", "known_phenotype", 1),
    ("therapeutic", "functional_hotspot", 1), ("therapeutic", "drug_resistance", 1), ("surveillance_priority", "lineage_unassigned", 2), ("surveillance_priority", "atypical", 1),
    ("surveillance_priority", "uncharacterized", 1), ("surveillance_priority", "re-emergence", 2), ("surveillance_priority", "geographic_coverage_gap", 1),
    ("surveillance_priority", "undetected_chain", 1), ("surveillance_priority", "reporting_delay", 1),
)
# Phenotype categories that raise the tier to high_priority, and to investigate.
HIGH_PRIORITY = ("vaccine_escape", "drug_resistance", "virulence")
INVESTIGATE = ("immune_escape", "disease_severity", "host_adaptation", "vaccine_effectiveness")
COUNTED_STRENGTH = ("strong", "moderate", "preliminary")


def findings(rows: DataFrame, analysis: str, *rules: tuple[Column, Column | str, Column | str]) -> DataFrame:
    """rows x (condition, finding_type, confidence) -> the findings whose condition holds."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    found = F.array(*[F.when(c, F.struct(lit(t).alias("finding_type"), lit(k).alias("confidence"))) for c, t, k in rules])
    out = rows.select("sample_id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("f"))
    return out.select("sample_id", F.lit(analysis).alias("analysis"), "f.finding_type", "f.confidence")


def confidence_score(sources: Column, strongest: Column, genomes: Column, has_context: Column, flagged: Column) -> Column:
    """0.3 for three sources, 0.4 for strong evidence, 0.2 for fifty genomes, 0.1 for context, less 0.1 if flagged; in 0..1."""
    weight = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in STRENGTH_WEIGHT.items() for x in p]), strongest), F.lit(0.0))
    score = F.least(sources / 3, F.lit(1.0)) * 0.3 + weight * 0.4 + F.least(genomes / 50, F.lit(1.0)) * 0.2 + F.when(has_context, 0.1).otherwise(0.0) - F.when(flagged, 0.1).otherwise(0.0)
    return F.round(F.greatest(F.least(score, F.lit(1.0)), F.lit(0.0)), 3)


def circulation_scenario(date: Column, first: Column, last: Column, in_country: Column, t: Thresholds = DEFAULTS) -> Column:
    """struct(scenario, confidence) of a sample's date against the span in which its lineage is known."""
    gap = F.datediff(date, last) / 365.25
    of = lambda s, c: F.struct(F.lit(s).alias("scenario"), F.lit(c).alias("confidence"))
    inside = date.between(first, last)
    here = F.when(inside, of("continued_circulation", "high")).when((date > last) & (gap <= t.recurrence_years), of("continued_circulation", "medium")).when(date > last, of("re-emergence", "medium")).when(date < first, of("continued_circulation", "medium"))
    away = F.when(inside, of("geographic_expansion", "medium")).when(date > last, of("new_introduction_or_expansion", "medium"))
    return F.coalesce(F.when(in_country, here).otherwise(away), of("uncertain", "low"))


def spread_scenarios(rows: DataFrame) -> DataFrame:
    """Scores of new introduction, re-emergence and local persistence from the origin and the gap to the latest tip (gap_days).

    The rule of the countries and the rule of the gap stand apart, and the points of one scenario are summed: a sample from its country of
    origin within a year of the latest tip has 3 points for local persistence. Scenarios without points have no row; without a
    country or an origin (null or empty) there are none.
    """
    named = F.coalesce(F.col("origin_country") != "", F.lit(False)) & F.coalesce(F.col("country") != "", F.lit(False))
    same, late = F.lower("origin_country") == F.lower("country"), F.col("gap_days") > F.lit(365)
    near = F.when(late, 0).when(F.col("gap_days").isNotNull(), 1).otherwise(0)
    points = {"new_introduction": F.when(same, 0).otherwise(3), "re_emergence": F.when(late, 3).otherwise(0), "local_persistence": near + F.when(same, 2).otherwise(0)}
    pairs = F.array(*[F.struct(F.lit(name).alias("scenario"), p.cast("int").alias("points")) for name, p in points.items()])
    return rows.where(named).select("sample_id", F.explode(F.filter(pairs, lambda x: x["points"] > 0)).alias("s")).select("sample_id", "s.*")


def origin_evidence(samples: DataFrame, tips: DataFrame, lineages: DataFrame, genomes: DataFrame, most_routes: int = 5) -> DataFrame:
    """sample_id, origin, confidence, method, support, routes, gap_days of every sample (sample_id, country, date, lineage_id).

    tips (sample_id, place, country, date): the nearest tips of each sample, a handful, the nearest first. Those of known country give the
    origin (the nearest one's; high confidence from three on), how the origin's candidates share among them, the
    routes between consecutive countries by date, each once, and the days from the latest of them to the sample. Without any, the
    origin is where the lineage was first detected, else the first country it is reported from, else that of most of its genomes
    (ties to the least name), whose shares are the support. support: "country:share" by share, then by first appearance.
    """
    known = tips.where("country is not null and country <> ''")
    near = known.groupBy("sample_id").agg(F.sort_array(F.collect_list(F.struct("place", "country", "date"))).alias("t"))
    dated = F.array_sort(F.transform(F.filter("t", lambda x: x["date"].isNotNull()), lambda x: F.struct(x["date"].alias("date"), x["place"].alias("place"), x["country"].alias("country"))))
    names = F.transform("t", lambda x: x["country"])
    share = lambda n, total: F.format_number(F.round(n / total, 3), 3)
    counted = F.transform(F.array_distinct(names), lambda c, i: F.struct((-F.size(F.filter(names, lambda x: x == c))).alias("n"), i.alias("i"), c.alias("c")))
    support = F.array_join(F.transform(F.array_sort(counted), lambda x: F.concat_ws(":", x["c"], share(-x["n"], F.size("t")))), ",")
    near = near.select("sample_id", "t", dated.alias("d"), support.alias("support"))
    steps = F.filter(F.zip_with(F.slice("d", 1, F.greatest(F.size("d") - 1, F.lit(0))), F.slice("d", 2, F.greatest(F.size("d") - 1, F.lit(0))), lambda a, b: F.when(a["country"] != b["country"], F.concat(a["country"], F.lit(" -> "), b["country"]))), lambda x: x.isNotNull())
    near = near.select(
        "sample_id", F.get("t", F.lit(0))["country"].alias("tip_origin"), F.size("t").alias("n_tips"), F.col("support").alias("tip_support"),
        F.array_join(F.slice(F.array_distinct(steps), 1, most_routes), "; ").alias("tip_routes"), F.get("d", F.size("d") - 1)["date"].alias("latest"),
    )
    seen = genomes.where("lineage_id is not null and country is not null").groupBy(F.lower(F.trim("lineage_id")).alias("_l"), F.trim("country").alias("country")).agg(F.count(F.lit(1)).alias("n"))
    common = seen.groupBy("_l").agg(F.sum("n").alias("all"), F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "country"))).alias("c"))  # a row a country of a lineage
    common = common.select("_l", F.get("c", F.lit(0))["country"].alias("common"), F.array_join(F.transform("c", lambda x: F.concat_ws(":", x["country"], share(-x["n"], F.col("all")))), ",").alias("common_support"))
    curated = lineages.select(F.lower(F.trim("lineage_id")).alias("_l"), "first_country", "countries_reported").join(common, "_l", "full")
    rows = samples.withColumn("_l", F.lower(F.trim("lineage_id"))).join(near, "sample_id", "left").join(curated, "_l", "left")
    of = lambda c, confidence, method, why, routes="": F.when(F.coalesce(c, F.lit("")) != "", F.struct(c.alias("origin"), confidence.alias("confidence"), F.lit(method).alias("method"), why.alias("support"), (routes if isinstance(routes, Column) else F.lit(routes)).alias("routes")))
    first = F.get("countries_reported", F.lit(0))
    o = F.coalesce(
        of(F.col("tip_origin"), F.when(F.col("n_tips") >= 3, "high").otherwise("medium"), "nearest_tree_tips", F.col("tip_support"), F.col("tip_routes")), of(F.col("first_country"), F.lit("medium"), "first_country_detected_curated", F.col("first_country")),
        of(first, F.lit("low"), "countries_reported_list", F.array_join("countries_reported", ",")), of(F.col("common"), F.lit("low"), "most_common_collection_country", F.col("common_support")),
        F.struct(F.lit("").alias("origin"), F.lit("low").alias("confidence"), F.lit("").alias("method"), F.lit("").alias("support"), F.lit("").alias("routes")),
    )
    return rows.select("sample_id", "country", o.alias("o"), F.datediff("date", "latest").alias("gap_days")).select("sample_id", "country", "o.*", "gap_days")


def relatedness(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    close = F.col("snps") <= t.close_snps
    return findings(rows, "genetic_relatedness", (close, "close_genetic_match", "high"), (~close, "genetic_relatedness_summary", "medium"), (F.col("snps").isNull(), "no_relatedness", "low"))


def molecular_clock(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    return findings(rows, "molecular_clock", (F.datediff("collection_date", "placement_date") > t.clock_delay_days, "reporting_delay", "medium"))


def surveillance_gaps(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """rows: sample_id, last_in_country (date), as_of (date), missing (array of countries without recent genomes)."""
    stale = F.datediff("as_of", "last_in_country") > t.surveillance_gap_days
    return findings(rows, "surveillance_gaps", (stale, "country_surveillance_gap", "medium"), (F.col("last_in_country").isNull(), "no_country_genomes", "high"), (F.size("missing") > 0, "geographic_coverage_gap", "medium"))


def spillover_points(reservoir: Column, primary_host: Column, sample_host: Column) -> Column:
    """2 for an animal reservoir, 1 each for an animal primary and sample host."""
    animal = lambda c: F.coalesce(~F.lower(F.trim(c)).isin("human", "homo sapiens", "unknown", ""), F.lit(False))
    return F.when(animal(reservoir), 2).otherwise(0) + F.when(animal(primary_host), 1).otherwise(0) + F.when(animal(sample_host), 1).otherwise(0)


def integrated_inference(rows: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """rows: sample_id, delay_days, gap_days, close_match, pathways, mismatch -> findings, each with the generations, importation probability and spread score of its sample."""
    generations = F.floor(F.col("gap_days") / t.days_per_generation)
    spread = 2 * F.col("pathways").cast("int") + F.col("mismatch").cast("int")
    out = rows.withColumns({"generations": generations, "importation_probability": F.when(F.col("close_match") & (F.col("gap_days") <= 180), 0.2).otherwise(0.7), "spread_score": spread})
    numbers = out.select("sample_id", "generations", "importation_probability", "spread_score")
    found = findings(out, "integrated_inference", (F.col("delay_days") > t.clock_delay_days, "reporting_delay", "medium"), (F.col("generations") > 2, "undetected_chain", "medium"), (F.col("spread_score") >= 3, "international_spread_risk", "medium"))
    return numbers.join(found, "sample_id", "left")


#: Findings that are also taken from what assertions say.
SAID = (("continued_circulation", "continued circulation"), ("re-emergence", "re-emergence"))


def criterion_scores(found: DataFrame, cap: int = 5) -> DataFrame:
    """(sample_id, finding_type[, assertion]) -> sample_id, criterion, score: points of distinct findings, at most cap a criterion.

    A relatedness summary counts only where there is no close match. Where there are assertions, those that speak of continued circulation
    or re-emergence count as these findings.
    """
    rules = F.broadcast(found.sparkSession.createDataFrame(list(CRITERIA), "criterion string, finding_type string, points int"))
    kinds = F.col("finding_type")
    if "assertion" in found.columns:
        heard = [F.when(F.contains(F.lower("assertion"), F.lit(words)), name) for name, words in SAID]
        kinds = F.explode(F.filter(F.array(kinds, *heard), lambda x: x.isNotNull()))
    once = found.select("sample_id", kinds.alias("finding_type")).distinct()
    close = once.where("finding_type = 'close_genetic_match'").select("sample_id", F.lit("genetic_relatedness_summary").alias("finding_type"))
    rows = once.join(close, ["sample_id", "finding_type"], "left_anti").join(rules, "finding_type")
    return rows.groupBy("sample_id", "criterion").agg(F.least(F.sum("points"), F.lit(cap)).cast("int").alias("score"))


def tier_of_scores(scores: DataFrame, tiers: DataFrame) -> DataFrame:
    """scores and tiers (sample_id, tier) -> sample_id, label, top: high_priority, investigate, monitor or routine, and the three highest criteria.

    The label needs the tier too: high_priority two elevated criteria and a tier of that rank, investigate one score of 4 or two elevated
    criteria and that tier, monitor a score of 3 or any tier above routine. A sample without a tier is routine there, one
    without scores has none. Criteria of equal scores stand in the order of the rules; those without a score aren't among the top.
    """
    order = {c: i for i, c in enumerate(dict.fromkeys(c for c, *_ in CRITERIA))}
    rank = F.try_element_at(F.create_map(*[F.lit(x) for p in order.items() for x in p]), F.col("criterion"))
    rows = scores.where("score > 0").select("sample_id", "score", F.struct((-F.col("score")).alias("s"), rank.alias("r"), "criterion").alias("c"))
    per = rows.groupBy("sample_id").agg(F.max("score").alias("most"), F.count_if(F.col("score") >= 3).alias("elevated"), F.slice(F.sort_array(F.collect_list("c")), 1, 3).alias("first"))
    per = per.join(tiers.groupBy("sample_id").agg(F.max(rank_of(F.col("tier"), RISK_TIERS)).alias("rank")), "sample_id", "full")
    most, elevated, tier = (F.coalesce(c, F.lit(0)) for c in ("most", "elevated", "rank"))
    of = {t: i for i, t in enumerate(RISK_TIERS)}
    label = (
        F.when((most >= 4) & (elevated >= 2) & (tier >= of["high_priority"]), "high_priority").when((most >= 4) | ((elevated >= 2) & (tier >= of["investigate"])), "investigate")
        .when((most >= 3) | (tier >= of["monitor"]), "monitor").otherwise("routine")
    )
    return per.select("sample_id", label.alias("label"), F.coalesce(F.array_join(F.transform("first", lambda x: x["criterion"]), ","), F.lit("")).alias("top"))


# Places whose mention in a travel history counts, and exposures that do.
AFFECTED = ("drc", "congo", "democratic republic", "guinea", "sierra leone", "liberia")
EXPOSURES = ("funeral", "contact")


def travelled(history: Column, places: Column) -> Column:
    """Whether someone has been to an affected place: the history must say so, and the places name one."""
    named = F.lower(F.coalesce(places, F.lit("")))
    return F.lower(F.coalesce(history, F.lit(""))).isin("yes", "true", "1") & reduce(lambda a, b: a | b, [F.contains(named, F.lit(p)) for p in AFFECTED])


def exposed(text: Column) -> Column:
    said = F.lower(F.coalesce(text, F.lit("")))
    return reduce(lambda a, b: a | b, [F.contains(said, F.lit(w)) for w in EXPOSURES])


def risk_tiers(rows: DataFrame) -> DataFrame:
    """rows: sample_id, category, strength, hotspot, gap_years, seen_in_country, lineage_listed, travel, exposure -> sample_id, tier, reasons, confidence.

    One row per variant and association (category null: none); every rule names a tier, the highest wins. A variant that is new in
    the country isn't asked for its lineage too. Confidence is low without associations and hotspots, medium if no association is
    strong, else high.
    """
    counted = F.col("strength").isin(*COUNTED_STRENGTH)
    of = lambda c, tier, reason: F.when(c, F.struct(F.lit(tier).alias("tier"), (F.lit(reason) if isinstance(reason, str) else reason).alias("reason")))
    none = F.lit(None).cast("struct<tier: string, reason: string>")
    phenotype = F.concat(F.lit("phenotype "), "category")
    rules = F.array(
        of(counted & F.col("category").isin(*HIGH_PRIORITY), "high_priority", phenotype), of(counted & F.col("category").isin(*INVESTIGATE), "investigate", phenotype), of(F.col("hotspot"), "monitor", "functional hotspot"),
        F.coalesce(of(F.col("gap_years") > 5, "investigate", "unseen for over five years"), of(F.col("gap_years") > 0, "monitor", "seen after a gap"), none),
        F.coalesce(of(~F.col("seen_in_country"), "investigate", "new in the country"), of(~F.col("lineage_listed"), "monitor", "not known of the lineage"), none),
        of(F.col("travel"), "investigate", "travel to an affected region"), of(F.col("exposure"), "investigate", "exposure"),
    )
    said = lambda c: F.coalesce(F.bool_or(c), F.lit(False)).alias
    facts = rows.groupBy("sample_id").agg(said(F.col("category").isNotNull())("matched"), said(F.col("hotspot"))("spot"), said(F.col("category").isNotNull() & (F.col("strength") == "strong"))("strong"))
    bare = ~F.col("matched") & ~F.col("spot")
    confidence = F.when(bare, "low").when(F.col("matched") & ~F.col("strong"), "medium").otherwise("high")
    hits = rows.select("sample_id", F.explode_outer(F.filter(rules, lambda x: x.isNotNull())).alias("r"))
    rank = F.coalesce(F.max(rank_of(F.col("r.tier"), RISK_TIERS)), F.lit(0))
    per = hits.groupBy("sample_id").agg(F.element_at(F.array(*map(F.lit, RISK_TIERS)), (rank + 1).cast("int")).alias("tier"), F.collect_set("r.reason").alias("reasons")).join(facts, "sample_id")
    reasons = F.array_join(F.array_sort(F.when(bare, F.array_union("reasons", F.array(F.lit("no curated phenotype")))).otherwise(F.col("reasons"))), "; ")
    return per.select("sample_id", "tier", reasons.alias("reasons"), confidence.alias("confidence"))


def quality_warnings(rows: DataFrame) -> DataFrame:
    """rows: sample_id, collection_date, country, lineage_id, completeness -> sample_id, warnings."""
    rules = [(F.col("collection_date").isNull(), "no collection date"), (F.col("country").isNull(), "no country"), (F.col("lineage_id").isNull(), "lineage unassigned"), (F.col("completeness") == "partial", "partial genome")]
    return rows.select("sample_id", F.array_join(F.filter(F.array(*[F.when(c, w) for c, w in rules]), lambda x: x.isNotNull()), "; ").alias("warnings"))


def network(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows: variant, phenotype, lineage, outbreak -> nodes (id, kind) and edges (a, b, relation), each once; ends in order."""
    kinds = ("variant", "phenotype", "lineage", "outbreak")
    links = (("variant", "phenotype", "has_phenotype"), ("variant", "lineage", "in_lineage"), ("lineage", "outbreak", "seen_in"))
    nodes = reduce(DataFrame.unionByName, [rows.where(F.col(k).isNotNull()).select(F.col(k).alias("id"), F.lit(k).alias("kind")) for k in kinds]).distinct()
    edge = lambda a, b, r: rows.where(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"), F.lit(r).alias("relation"))
    return nodes, reduce(DataFrame.unionByName, [edge(*x) for x in links]).distinct()


def significance(calls: DataFrame, catalogue: DataFrame) -> DataFrame:
    """calls (sample_id, lineage_id, gene, position, ref_aa, alt_aa, ..., hotspot, phenotypes) -> each with its place in the mutation profile.

    catalogue: gene, position, alt_aa, lineage_ids. synonymous if the residue doesn't change; absent if the catalogue doesn't know it, typical if
    it is known of the sample's lineage, else atypical. Genes and residues are compared in upper case; a call without gene or
    position has no place. Of several rows of a mutation the first by its lineages counts.
    """
    up = lambda c: F.upper(F.trim(F.coalesce(c, F.lit(""))))
    known = catalogue.select(up(F.col("gene")).alias("_g"), F.col("position").alias("_p"), up(F.col("alt_aa")).alias("_a"), "lineage_ids").groupBy("_g", "_p", "_a").agg(F.min("lineage_ids").alias("_lineages"))
    rows = calls.where(F.col("position").isNotNull() & (F.trim(F.coalesce("gene", F.lit(""))) != ""))
    rows = rows.withColumns({"_g": up(F.col("gene")), "_p": F.col("position"), "_a": up(F.col("alt_aa"))}).join(known.withColumn("_hit", F.lit(True)), ["_g", "_p", "_a"], "left")
    place = F.when(up(F.col("ref_aa")) == F.col("_a"), "synonymous").when(F.col("_hit").isNull(), "absent").when(F.coalesce(F.array_contains("_lineages", F.col("lineage_id")), F.lit(False)), "typical").otherwise("atypical")
    return rows.select(*calls.columns, place.alias("significance"))


def significance_findings(placed: DataFrame) -> DataFrame:
    """(sample_id, significance, hotspot, phenotypes) -> the findings of each sample's profile, and its gap if no phenotype is known."""
    has = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    facts = placed.groupBy("sample_id").agg(*[has(F.col("significance") == k).alias(k) for k in ("typical", "atypical", "absent", "synonymous")], has(F.col("hotspot")).alias("spot"), has(F.col("phenotypes") > 0).alias("known"))
    of = lambda c: F.col(c)
    return findings(
        facts, "genomic_significance", (of("typical"), "typical", "high"), (of("atypical"), "atypical", "medium"), (of("absent"), "uncharacterized", "medium"), (of("synonymous"), "synonymous", "high"),
        (of("spot"), "functional_hotspot", "high"), (of("known"), "known_phenotype", "medium"), (~of("known"), "no_known_phenotype", "low"),
    )


def match_phenotypes(variants: DataFrame, associations: DataFrame) -> DataFrame:
    """variants (sample_id, species_id, gene, position, ref_aa, alt_aa, domain) x associations -> sample_id, association_id, way: each once, by its first way.

    associations: association_id, species_id, protein, position, alt_aa, description, notation. exact: gene, position and residue; motif, where
    there is no position or residue: a word after "motif:" or "domain:" in the description that holds the variant's domain or lies in it;
    notation: a change in one- or three-letter code, read once on either side; gene: an association without a position of the gene. Words of a
    gene are held against its domains once each, not for every sample.

    What a sample has in a gene is one row (its places, changes and the words that fit), so a pair's earlier ways are seen where it is made: pairs
    aren't grouped again, but where an id has several associations.
    """
    up = lambda c: F.upper(F.trim(c))
    scope = ["species_id", "gene"]
    v = variants.select("sample_id", "species_id", up(F.col("gene")).alias("gene"), "position", up(F.col("ref_aa")).alias("ref_aa"), up(F.col("alt_aa")).alias("alt_aa"), F.lower(F.trim("domain")).alias("domain")).where("species_id is not null and gene is not null")
    after = lambda w: F.trim(F.regexp_extract(F.lower("description"), rf"{w}:([^,]*)", 1))
    word = F.when(F.contains(F.lower("description"), F.lit("motif:")), after("motif")).otherwise(after("domain"))
    m, place, change = parse_protein_change(F.col("notation")), F.concat(F.col("position").cast("string"), F.lit("|"), "alt_aa"), F.concat("ref_aa", F.lit("|"), F.col("position").cast("string"), F.lit("|"), "alt_aa")
    a = associations.select("association_id", "species_id", up(F.col("protein")).alias("gene"), "position", up(F.col("alt_aa")).alias("alt_aa"), word.alias("word"), m.alias("m")).select(
        "association_id", *scope, F.col("position").isNull().alias("anywhere"), F.when(F.col("alt_aa") != "", place).alias("place"),
        F.when((F.col("word") != "") & (F.col("position").isNull() | F.col("alt_aa").isNull() | (F.col("alt_aa") == "")), F.col("word")).alias("word"),
        F.concat("m.ref", F.lit("|"), F.col("m.position").cast("string"), F.lit("|"), "m.alt").alias("change"),
    )
    domains = v.where("domain <> ''").select(*scope, "domain").distinct()
    fits = a.where("word is not null").select(*scope, "word").distinct().join(domains, scope).where(F.contains("domain", "word") | F.contains("word", "domain"))
    fits = fits.groupBy(*scope, "domain").agg(F.collect_set("word").alias("fit"))  # words of a gene that fit one domain
    rows = v.join(fits, [*scope, "domain"], "left").groupBy("sample_id", *scope)
    samples = stored(rows.agg(F.collect_set(F.when(F.col("alt_aa") != "", place)).alias("places"), F.collect_set(change).alias("changes"), F.array_distinct(F.flatten(F.collect_list("fit"))).alias("fit")), "matched-samples")
    has = lambda c, there: F.coalesce(F.array_contains(there, F.col(c)), F.lit(False))
    each = lambda there, name: samples.withColumn(name, F.explode(there))
    exact = spread(each("places", "place").select("sample_id", *scope, "place"), a.where("place is not null").select(*scope, "place", "association_id"), [*scope, "place"])
    motif = spread(each("fit", "word").select("sample_id", *scope, "word"), a.where("word is not null").select(*scope, "word", "association_id"), [*scope, "word"])
    notation = spread(each("changes", "change").select("sample_id", *scope, "change", "places", "fit"), a.where("change is not null").select(*scope, "change", "association_id", "place", "word"), [*scope, "change"])
    gene = spread(samples.select("sample_id", *scope, "changes", "fit"), a.where("anywhere").select(*scope, "association_id", "word", "change"), scope)
    notation, gene = notation.where(~has("place", "places") & ~has("word", "fit")), gene.where(~has("word", "fit") & ~has("change", "changes"))
    named = ("exact", "motif", "notation", "gene")
    ways = reduce(DataFrame.unionByName, [rows.select("sample_id", "association_id", F.lit(i).alias("i")) for i, rows in enumerate((exact, motif, notation, gene))])
    if a.groupBy("association_id").count().where("count > 1").limit(1).count():
        ways = ways.groupBy("sample_id", "association_id").agg(F.min("i").alias("i"))
    return ways.select("sample_id", "association_id", F.get(F.array(*map(F.lit, named)), F.col("i")).alias("way"))


def intervention_findings(observed: DataFrame, associations: DataFrame, categories: tuple[str, ...], most: int = 5, tasks: int | None = None) -> DataFrame:
    """Per sample and intervention category: how many associated variants it has and lacks, and the first ones it has. Samples stay where they are, if known variants can be broadcast."""
    keys = ["gene", "position", "alt_aa"]
    known = associations.where(F.col("phenotype_category").isin(*categories)).select(F.col("protein").alias("gene"), "position", "alt_aa", "phenotype_category").distinct()
    total = known.groupBy("phenotype_category").agg(F.count(F.lit(1)).alias("known"))
    hits = met(observed.select("sample_id", *keys).distinct(), known, keys, tasks)
    per = hits.groupBy("sample_id", "phenotype_category").agg(F.count(F.lit(1)).alias("present"), F.slice(F.array_sort(F.collect_set(F.concat_ws(":", *keys))), 1, most).alias("first"))
    return per.join(F.broadcast(total), "phenotype_category").select("sample_id", "phenotype_category", "present", (F.col("known") - F.col("present")).alias("absent"), F.array_join("first", ",").alias("first"))


def harmonise(variants: DataFrame, phenotypes: DataFrame, outbreaks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, lists): one evidence row per sample, with its variants, their phenotypes and the key of its list of outbreaks; and the lists' rows (list_key, outbreak).

    A sample has the outbreaks of its lineage, or all of them, if none is of it. Lists are stored once, a row an outbreak, under a key that
    is made of what they hold: lineages of the same outbreaks share one, and no list is copied into samples or put together in a task.
    The key adds up the digests of the list's rows, so it too is made where the rows are.
    """
    seen = variants.select("sample_id", "lineage_id", "hgvs_p", "phenotype_key").join(phenotypes, "phenotype_key", "left")
    per = seen.groupBy("sample_id", "lineage_id").agg(F.array_sort(F.collect_set("hgvs_p")).alias("variants"), F.array_sort(F.collect_set("phenotype")).alias("phenotypes"))
    known = outbreaks.where("outbreak is not null").select("lineage_id", "outbreak").distinct()
    half = lambda i: F.sum(F.conv(F.substring(F.sha2("outbreak", 256), i, 15), 16, 10).cast("decimal(20,0)"))
    key = F.sha2(F.concat_ws(":", F.count(F.lit(1)), half(1), half(16)), 256).alias("list_key")
    mine = known.where("lineage_id is not null").groupBy("lineage_id").agg(key)
    every = known.select("outbreak").distinct()
    whole = every.agg(key).first()["list_key"]  # one value
    samples = per.join(mine, "lineage_id", "left").withColumn("list_key", F.coalesce("list_key", F.lit(whole)))
    lists = mine.join(known, "lineage_id").select("list_key", "outbreak").distinct()
    lists = lists.unionByName(every.select(F.lit(whole).alias("list_key"), "outbreak")).distinct()
    return samples, lists


def comparative_outbreaks(samples: DataFrame, outbreaks: DataFrame, most: int = 5) -> DataFrame:
    """samples (sample, country, year) x outbreaks (outbreak, country, year, cases) -> sample, outbreak, score: the most similar ones.

    2 for the same country; 2 for years at most 5 apart, 1 for at most 10; 0.5 for known cases. Outbreaks without any score
    are left out; ties go to the least outbreak. Nulls and empty countries match nothing.

    All outbreaks of one country, year and state of cases score alike, so the least few of such a class are all that a sample
    can need of it; the same holds by year alone for those of other countries, and overall for those that score by cases
    only. Where a wider class's few hold outbreaks that score more, these come before what they leave out. Samples are judged
    once per country and year.
    """
    place = F.nullif(F.lower("country"), F.lit(""))
    score = lambda here, gap, cases: F.when(here, 2.0).otherwise(0.0) + F.when(gap <= 5, 2.0).when(gap <= 10, 1.0).otherwise(0.0) + F.when(cases, 0.5).otherwise(0.0)
    o = outbreaks.select("outbreak", place.alias("o_place"), F.col("year").alias("o_year"), F.coalesce(F.col("cases") > 0, F.lit(False)).alias("o_cases"))
    least = lambda rows, *keys: rows.withColumn("_r", F.row_number().over(W.partitionBy(*keys).orderBy("outbreak"))).where(F.col("_r") <= most).drop("_r")
    s = samples.select("sample", place.alias("place"), "year")
    kinds = s.select("place", "year").distinct()
    here = kinds.join(least(o.where("o_place is not null"), "o_place", "o_year", "o_cases"), F.col("place") == F.col("o_place"))
    near = kinds.withColumn("_y", F.explode(F.sequence(F.col("year") - 10, F.col("year") + 10))).join(least(o.where("o_year is not null"), "o_year", "o_cases"), F.col("_y") == F.col("o_year")).drop("_y")
    few = o.where("o_cases").orderBy("outbreak").limit(most).agg(F.collect_list(F.struct(*o.columns)).alias("few"))  # one row of `most` outbreaks, the same for all
    far = kinds.withColumn("_one", F.lit(1)).join(F.broadcast(few.withColumn("_one", F.lit(1))), "_one").select("place", "year", F.explode("few").alias("f")).select("place", "year", "f.*")
    pairs = here.unionByName(near).unionByName(far).distinct()
    scored = pairs.withColumn("score", score(F.col("place") == F.col("o_place"), F.abs(F.col("year") - F.col("o_year")), F.col("o_cases"))).where("score > 0")
    w = W.partitionBy("place", "year").orderBy(F.col("score").desc(), "outbreak")
    best = scored.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= most).select(F.col("place").alias("_place"), F.col("year").alias("_year"), "outbreak", "score")
    return s.join(best, F.col("place").eqNullSafe(F.col("_place")) & F.col("year").eqNullSafe(F.col("_year"))).select("sample", "outbreak", "score")


def genomic_signal(variants: DataFrame, t: Thresholds = DEFAULTS) -> DataFrame:
    """(sample_id, is_known, is_hotspot, sample_length) -> sample_id, novelty, hotspot_ratio, burden and whether novelty is a finding.

    burden: mutations against what a genome of mean length would have, by the share of its length.
    """
    share = lambda c: F.round(F.avg(F.when(c, 1.0).otherwise(0.0)), 4)
    out = variants.groupBy("sample_id").agg(share(~F.col("is_known")).alias("novelty"), share(F.col("is_hotspot")).alias("hotspot_ratio"), F.round(F.count(F.lit(1)) / (F.avg("sample_length") / t.genome_length), 4).alias("burden"))
    return out.withColumn("novel_finding", F.col("novelty") > t.burden_novelty)


def consistency(rows: DataFrame) -> DataFrame:
    """(sample_id, origin, travel, persistent, close_days, known, novel) -> sample_id, check, state: consistent, inconsistent or unknown."""
    from ..functions.scalars import country_name

    origin, travel = F.lower(country_name(F.col("origin"))), F.lower(country_name(F.col("travel")))
    state = lambda c: F.when(c, "consistent").when(~c, "inconsistent").otherwise("unknown")
    checks = F.array(
        F.struct(F.lit("origin_travel").alias("check"), state(F.contains(origin, travel) | F.contains(travel, origin)).alias("state")),
        F.struct(F.lit("persistence_relatedness").alias("check"), state(F.col("persistent") == (F.col("close_days") <= 180)).alias("state")),
        F.struct(F.lit("known_novel").alias("check"), state(F.col("known") >= F.col("novel")).alias("state")),
    )
    return rows.select("sample_id", F.explode(checks).alias("c")).select("sample_id", "c.*")


def knowledge_gaps(rows: DataFrame, names: dict[str, str]) -> DataFrame:
    """rows x (column -> gap) -> sample_id, gaps: what is missing, in the order given."""
    return rows.select("sample_id", F.array_join(F.filter(F.array(*[F.when(F.col(c).isNull(), g) for c, g in names.items()]), lambda x: x.isNotNull()), "; ").alias("gaps"))


# What a sample's record, its species' reports and its tree may lack, and the gap that each leaves.
RECORD_GAPS = (
    ("collection_date", "Sample collection date is missing; temporal analyses are limited."), ("country", "Sample country is missing; geographic analyses are limited."),
    ("suspected_exposure", "Suspected exposure route is missing; transmission hypotheses cannot be refined."), ("travel_history", "Travel history is missing; importation risk is harder to assess."),
)
NO_OUTBREAKS = "No species outbreak records in epi output; epidemic dynamics are inferred from curated genomes only."
NO_TRANSMISSION = "No transmission parameters (R0, serial interval) in epi output; transmission potential cannot be quantified."
NO_TREE = "No phylogenetic tree or placement provided; molecular-clock and relatedness analyses rely on metadata."
NO_TIMES = "No time-scaled phylogeny available; molecular-clock dating is not possible."
NO_REFERENCE = "No closest reference genome information; assembly context is incomplete."


def gap_report(samples: DataFrame, reported: DataFrame, outbreaks: DataFrame, transmission: DataFrame, by: str = "species_id") -> DataFrame:
    """sample_id, gaps (array), gap_count, summary: what every analysis found missing, each gap once and where it came first, then what
    the record, the reports of the sample's species (`by`) and the tree lack.

    samples: sample_id, `by`, collection_date, country, suspected_exposure, travel_history, tree_file, placement, time_scaled_tree,
    closest_reference. reported: sample_id, analysis (its order), place, gap. outbreaks, transmission: `by`, of which only the presence
    counts. A text of the record that is blank counts as missing; a null or empty gap is none. Gaps of the same order and place go
    by their text. Every row of samples has its row; a null sample_id has no reported gaps, a null `by` no reports. Gaps are made distinct before
    they are gathered, so that a sample's list is as long as it has different gaps, however often they are reported.
    """
    first = reported.where("sample_id is not null and gap is not null and gap <> ''").groupBy("sample_id", "gap").agg(F.min(F.struct("analysis", "place")).alias("first"))
    told = first.groupBy("sample_id").agg(F.array_sort(F.collect_list(F.struct("first", "gap"))).alias("_told"))
    known = lambda rows, name: rows.where(F.col(by).isNotNull()).select(by).distinct().withColumn(name, F.lit(True))
    rows = samples.join(told, "sample_id", "left").join(known(outbreaks, "_outbreaks"), by, "left").join(known(transmission, "_transmission"), by, "left")
    blank = lambda c: F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == ""
    none = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) == ""
    own = F.array(
        *[F.when(blank(c), gap) for c, gap in RECORD_GAPS], F.when(F.col("_outbreaks").isNull(), NO_OUTBREAKS), F.when(F.col("_transmission").isNull(), NO_TRANSMISSION),
        F.when(none("tree_file") & none("placement"), NO_TREE).when(none("time_scaled_tree"), NO_TIMES), F.when(none("closest_reference"), NO_REFERENCE),
    )
    gaps = F.concat(F.coalesce(F.transform("_told", lambda x: x["gap"]), F.array().cast("array<string>")), F.filter(own, lambda x: x.isNotNull()))
    count = F.size("gaps").cast("long")
    return rows.select("sample_id", gaps.alias("gaps")).select("sample_id", "gaps", count.alias("gap_count"), F.concat(F.lit("Knowledge gaps: "), count.cast("string"), F.lit(" cross-cutting gaps identified.")).alias("summary"))


def intelligence_object(samples: DataFrame, found: DataFrame, tiers: DataFrame) -> DataFrame:
    """One JSON document per sample: its tier, reasons and findings in order."""
    per = found.groupBy("sample_id").agg(F.array_sort(F.collect_set(F.struct("analysis", "finding_type", "confidence"))).alias("findings"))
    rows = samples.select("sample_id").join(per, "sample_id", "left").join(tiers, "sample_id", "left")
    return rows.select("sample_id", F.to_json(F.struct("sample_id", "tier", "reasons", "findings")).alias("document"))


def without_sections(text: Column, forbidden: tuple[str, ...]) -> Column:
    """Text less its sections under headings ('#' to '###') of the names given, up to the next heading."""
    names = "|".join(rf"\Q{n}\E" for n in forbidden)
    return F.regexp_replace(text, rf"(?ims)^#{{1,3}}[ \t]*(?:{names})[ \t]*$.*?(?=^#{{1,3}}[ \t]|\z)", "")


def questions(rows: DataFrame, templates: list[tuple[str, str, str]]) -> DataFrame:
    """rows x (condition, text expression, fallback) -> sample_id, question: the text where the condition holds, else the fallback."""
    asked = F.array(*[F.coalesce(F.when(F.expr(c), F.expr(t)), F.lit(f)) for c, t, f in templates])
    return rows.select("sample_id", F.posexplode(asked).alias("place", "question"))

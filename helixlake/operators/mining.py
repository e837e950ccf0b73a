"""Text mining by rule tables: documents x rules, the first mention by document order winning."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.sinks import stored
from .joins import first_per

# Patterns of case and death counts, in order of preference.
CASES = (
    r"cumulative\s+total\s+of\s+([\d, ]{1,11})\s+(?:clinical\s+|confirmed\s+|probable\s+)?cases",
    r"total\s+(?:number\s+)?of\s+([\d, ]{1,11})\s+(?:clinical\s+|confirmed\s+|probable\s+)?cases",
    r"total\s+of\s+([\d, ]{1,11})\s+(?:clinical\s+|confirmed\s+|probable\s+|new\s+|probable\s+and\s+confirmed\s+)?cases",
    r"([\d, ]{1,11})\s+(?:probable\s+and\s+confirmed\s+|confirmed\s+|probable\s+|suspect\s+|clinical\s+|new\s+)?cases",
    r"([\d, ]{1,11})\s+cases\s*\(",
    r"cases\s*[:\-]\s*([\d, ]{1,11})",
    r"case\s+count\s*[:\-]\s*([\d, ]{1,11})",
    r"\b([\d, ]{1,11})\s+confirmed\s+cases?\b",
)
DEATHS = (
    r"deaths\s*[:\-]\s*([\d, ]{1,11})",
    r"(?:including|and)\s+([\d, ]{1,11})\s*deaths",
    r"([\d, ]{1,11})\s*deaths",
    r"([\d, ]{1,11})\s*have\s*been\sfatal",
    r"([\d, ]{1,11})\s*fatal",
)
# Keyword, label, kind of an intervention.
INTERVENTIONS = (
    ("vaccine", "vaccination", "vaccine"), ("vaccination", "vaccination", "vaccine"), ("ring vaccination", "ring vaccination", "vaccine"),
    ("contact tracing", "contact tracing", "public_health_measure"), ("isolation", "isolation", "clinical_management"), ("quarantine", "quarantine", "public_health_measure"),
    ("personal protective equipment", "PPE", "PPE"), ("ppe", "PPE", "PPE"), ("safe burial", "safe burial", "public_health_measure"), ("monoclonal", "monoclonal antibody", "treatment"),
    ("therapeutic", "therapeutics", "treatment"), ("antiviral", "antiviral", "treatment"), ("infection prevention", "infection prevention and control", "ipc"),
    ("hand hygiene", "hand hygiene", "public_health_measure"), ("surveillance", "surveillance", "public_health_measure"), ("risk communication", "risk communication", "public_health_measure"),
)
# Clinical feature, severity.
FEATURES = (
    ("asymptomatic", "mild"), ("severe", "severe"), ("hospitalized", "severe"), ("fever", None), ("fatigue", None), ("muscle pain", None), ("headache", None), ("vomiting", None),
    ("diarrhoea", None), ("diarrhea", None), ("haemorrhage", "severe"), ("hemorrhage", "severe"), ("bleeding", "severe"),
)
# Terms, method, kind, target of a diagnostic.
DIAGNOSTICS = (
    (("rt-pcr", "rt pcr"), "RT-PCR", "molecular", "viral RNA"), (("pcr",), "PCR", "molecular", "viral RNA"), (("antigen", "rapid diagnostic"), "antigen detection", "rapid", "viral antigen"),
    (("serology", "serological"), "serology", "immunological", "antibodies"), (("elisa",), "ELISA", "immunological", "antibodies"),
    (("sequencing", "genome", "genomic"), "genomic sequencing", "molecular", "whole genome"), (("viral culture", "virus isolation"), "viral culture", "isolation", "live virus"),
    (("biosafety", "bsl-4", "bsl4"), "BSL-4/biosafety", "laboratory", "containment"), (("biopsy",), "biopsy", "pathology", "tissue sample"),
    (("blood sample", "blood test"), "blood testing", "laboratory", "blood sample"),
)
# Terms, group of people, exposure, setting or host that they tell of.
DEMOGRAPHICS = (
    (("health care worker", "healthcare worker", "health worker", "health workers"), "group", "healthcare_workers"), (("child", "children", "under 5", "under five"), "group", "children"),
    (("pregnant", "pregnancy"), "group", "pregnant_women"), (("elderly", "older adult", "old age"), "group", "elderly"),
    (("animal contact", "contact with animal", "bushmeat", "handling of infected animals"), "exposure", "animal contact"), (("funeral", "burial"), "exposure", "funeral/burial attendance"),
    (("nosocomial", "healthcare exposure", "hospital-acquired"), "exposure", "healthcare exposure"), (("travel history", "recent travel", "traveler", "travellers"), "exposure", "travel"),
    (("mosquito bite", "tick bite", "vector exposure", "insect bite"), "exposure", "vector exposure"), (("healthcare facility", "hospital setting", "clinic setting"), "setting", "healthcare facility"),
    (("household transmission", "household contact", "within the household"), "setting", "household"), (("refugee camp", "displacement camp", "idp camp"), "setting", "refugee/displacement camp"),
    (("community transmission", "community setting"), "setting", "community"), (("fruit bat", "fruit bats"), "host", "fruit bats"),
    (("nonhuman primate", "non-human primate", "chimpanzee", "gorilla"), "host", "non-human primates"), (("cattle", "livestock"), "host", "cattle/livestock"), (("pig", "swine"), "host", "pigs"),
    (("poultry", "chicken", "bird flu"), "host", "poultry"), (("camel",), "host", "camels"),
)
# Terms, route of transmission.
ROUTES = (
    (("person-to-person", "direct contact", "close contact"), "person-to-person via direct/close contact"), (("bodily fluid", "body fluid", "body fluids"), "contact with bodily fluids"),
    (("sexual",), "sexual transmission"), (("airborne",), "airborne (not primary)"), (("needle", "sharps", "inject"), "needlestick / contaminated equipment"),
)
# Terms, product, kind, status, effectiveness.
PRODUCTS = (
    (("ervebo", "rvsv-zebov", "rvsv-zebov-gp"), "Ervebo (rVSV-ZEBOV)", "vaccine", "used", "highly effective"), (("rvsv", "vsv-zebov"), "rVSV-based vaccine", "vaccine", "used", None),
    (("mab114", "mab 114"), "mAb114", "therapeutic", "used", "effective"), (("regn-eb3", "regn eb3"), "REGN-EB3", "therapeutic", "used", "effective"),
    (("zmapp", "z-mapp"), "ZMapp", "therapeutic", "used", "effective"), (("remdesivir",), "Remdesivir", "therapeutic", "used", "limited efficacy"),
    (("favipiravir",), "Favipiravir", "therapeutic", "investigational", None), (("monoclonal antibody", "monoclonal antibodies"), "monoclonal antibodies", "therapeutic", "used", "effective"),
    (("vaccine", "vaccination"), "vaccination (unspecified)", "vaccine", "used", None), (("therapeutic", "treatment"), "therapeutics (unspecified)", "therapeutic", "used", None),
)
# Phenotype category, patterns.
PHENOTYPES = (
    ("increased_transmission", (r"transmiss(ion|ibility)", r"\bspread\b", r"\br0\b")), ("decreased_transmission", (r"reduced\s+transmission", r"lower\s+transmission")),
    ("virulence", (r"virulence", r"pathogenicity", r"virulent", r"more\s+virulent", r"increased\s+virulence", r"decreased\s+virulence")),
    ("disease_severity", (r"severity", r"severe", r"mortality", r"case\s+fatality", r"\bcfr\b", r"\bfatal\w*\b")), ("host_adaptation", (r"human\s+adaptation", r"host\s+adaptation", r"adaptation\s+to\s+human")),
    ("host_range", (r"host\s+range", r"host\s+tropism", r"species\s+tropism")), ("reservoir_association", (r"reservoir", r"\bbat\b", r"frugivorous")),
    ("vector_competence", (r"vector\s+competence", r"vector\s+transmission")),
    ("immune_escape", (r"immune\s+(escape|evasion)", r"antibody\s+(resist|resistance|escape)", r"neutrali[sz](ation|ing|e)")), ("vaccine_escape", (r"vaccine\s+(escape|resistance)", r"\bervebo\b", r"rvsv-zebov")),
    ("vaccine_effectiveness", (r"vaccine\s+(efficacy|effectiveness|response|induced)", r"vaccination")),
    ("drug_resistance", (r"drug\s+(resist|resistance)", r"antiviral\s+resistance", r"\bremdesivir\b", r"\bfavipiravir\b")),
    ("drug_susceptibility", (r"drug\s+susceptib", r"susceptib\w*\s+to", r"antiviral\s+activity", r"\binhibited\b")), ("diagnostic_escape", (r"diagnostic\s+(escape|failure)", r"assay\s+failure", r"false\s+negative")),
    ("diagnostic_performance", (r"diagnostic\s+assay", r"\bpcr\b", r"rt-pcr")), ("unknown_significance", (r"unknown\s+significance", r"no\s+known\s+significance")),
)
# Official domains with their credibility, official endings, distrusted domains.
OFFICIAL = (("who.int", 10), ("cdc.gov", 9), ("un.org", 9), ("unicef.org", 9), ("africacdc.org", 8), ("ecdc.europa.eu", 8), ("reliefweb.int", 7), ("gov.uk", 8), ("nih.gov", 7))
ENDINGS = (
    ".gov", ".gov.uk", ".gov.au", ".gov.ng", ".gov.sl", ".gov.lr", ".gov.gh", ".gouv.cd", ".gouv.ci", ".gouv.sn", ".gouv.ml", ".gouv.ga", ".gouv.gn", ".go.ug", ".go.ke", ".go.tz", ".go.zm",
    ".go.zw", ".go.rw", ".go.za", ".gob.mx", ".gob.ar", ".gob.es", ".govt.nz", ".mil",
)
DISTRUSTED = ("wikipedia.org", "youtube.com", "facebook.com", "twitter.com", "x.com", "reddit.com", "tiktok.com", "instagram.com", "pinterest.com")
HEALTH = ("health", "moh", "sante", "cdc", "medic", "epidem", "doh")


def _any(text: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def count_in_text(text: Column, patterns: tuple[str, ...]) -> Column:
    """The number that the first matching pattern gives, with commas and spaces left out."""
    plain = F.regexp_replace(F.lower(text), r"[*_]+", " ")
    return F.coalesce(*[F.regexp_replace(F.regexp_extract(plain, p, 1), "[, ]", "").try_cast("long") for p in patterns])


def cfr_text(cases: Column, deaths: Column) -> Column:
    """'38.7%' if there are both cases and deaths. Half goes to the even digit, as in the rule's origin."""
    return F.when((cases > 0) & (deaths > 0), F.concat(F.bround(deaths * 100.0 / cases, 1).cast("string"), F.lit("%")))


def earliest_term(text: Column, terms: list[str]) -> Column:
    """Of whole words and names, the one that stands first in the text; of two that begin there, the longer."""
    by_length = sorted({t.lower(): t for t in terms}.items(), key=lambda x: (-len(x[0]), x[0]))
    pattern = rf"(?<![a-z])({'|'.join(rf'\Q{low}\E' for low, _ in by_length)})(?![a-z])"
    names = F.create_map(*[F.lit(x) for pair in by_length for x in pair])
    return F.try_element_at(names, F.regexp_extract(F.lower(text), pattern, 1))


# Spellings of a country in reports, beside the names themselves, and the name each stands for.
ALIASES = {"DRC": "Democratic Republic of the Congo", "Congo, The Democratic Republic of the": "Democratic Republic of the Congo"}


def earliest_country(text: Column, names: list[str]) -> Column:
    """The country that stands first in a text, by any of its spellings. Letters right before or after a name tell of another
    word; beside a name of at most three characters digits and underscores do too."""
    short = [n for n in [*names, *ALIASES] if len(n) <= 3]
    spaced = reduce(lambda t, n: F.regexp_replace(t, rf"(?i)(?<=[0-9_])\Q{n}\E|\Q{n}\E(?=[0-9_])", "~"), short, text)
    found = earliest_term(spaced, [*names, *ALIASES])
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in ALIASES.items() for x in p]), found), found)


def mentions(docs: DataFrame, rules: list[tuple[tuple[str, ...], str, dict]], key: str = "ordinal") -> DataFrame:
    """docs (ordinal, url, text) x rules (terms, label, attributes) -> each label once, with the first document that has a term.

    Every document gives an array of the rules it meets, which is exploded: one pass over the texts, and a partial
    aggregation by label that keeps one row a task.
    """
    text = F.lower("text")
    names = sorted({k for _, _, attributes in rules for k in attributes})
    rule = lambda i, terms, label, a: F.when(_any(text, terms), F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), *[F.lit(a.get(n)).cast("string").alias(n) for n in names]))
    hits = F.filter(F.array(*[rule(i, *r) for i, r in enumerate(rules)]), lambda x: x.isNotNull())
    rows = docs.select(key, "url", F.explode(hits).alias("h")).select(key, "url", "h.*")
    first = rows.groupBy("label").agg(F.min(F.struct(key, "rule", *names, "url")).alias("m"))
    return first.select("label", *[f"m.{n}" for n in names], F.col("m.url").alias("source_url"))


def interventions(docs: DataFrame) -> DataFrame:
    return mentions(docs, [((k,), label, {"kind": kind}) for k, label, kind in INTERVENTIONS])


def clinical_features(docs: DataFrame) -> DataFrame:
    return mentions(docs, [((f,), f, {"severity": s}) for f, s in FEATURES])


def demographics(docs: DataFrame) -> DataFrame:
    return mentions(docs, [(t, label, {"kind": kind}) for t, kind, label in DEMOGRAPHICS])


def transmission_routes(docs: DataFrame) -> DataFrame:
    return mentions(docs, [(t, label, {}) for t, label in ROUTES])


def diagnostics(docs: DataFrame) -> DataFrame:
    """Methods mentioned; plain PCR is left out where RT-PCR is mentioned in the same or an earlier document."""
    found = mentions(docs, [(t, m, {"kind": k, "target": target}) for t, m, k, target in DIAGNOSTICS])
    at = lambda terms: docs.where(_any(F.lower(F.col("text")), terms)).agg(F.min("ordinal").alias("o"))
    early = at(("rt-pcr", "rt pcr")).select(F.col("o").alias("rt")).join(at(("pcr",)).select(F.col("o").alias("any")), F.expr("rt <= any")).select(F.lit("PCR").alias("label"))
    return found.join(early, "label", "left_anti")


def products(docs: DataFrame) -> DataFrame:
    return mentions(docs, [(t, p, {"kind": k, "status": s, "effectiveness": e}) for t, p, k, s, e in PRODUCTS])


def phenotypes(docs: DataFrame) -> DataFrame:
    """docs (id, text) -> id, category, pattern: the first pattern of each category that a text meets."""
    text = F.lower("text")
    pattern = lambda ps: reduce(lambda rest, p: F.when(text.rlike(p), F.lit(p)).otherwise(rest), reversed(ps), F.lit(None).cast("string"))
    rows = F.filter(F.array(*[F.struct(F.lit(c).alias("category"), pattern(ps).alias("pattern")) for c, ps in PHENOTYPES]), lambda x: x["pattern"].isNotNull())
    return docs.select("id", F.explode(rows).alias("p")).select("id", "p.*")


def credibility(host: Column, path: Column, text: Column) -> Column:
    """Score of a source: an official domain's own; else points for endings, health words and mentions, less 10 a distrusted name."""
    official = reduce(lambda rest, x: F.when(F.contains(host, F.lit(x[0])), F.lit(x[1])).otherwise(rest), reversed(OFFICIAL), F.lit(None).cast("int"))
    ending = reduce(lambda a, b: a | b, [F.endswith(host, F.lit(e)) for e in ENDINGS])
    every = F.lower(F.concat_ws(" ", host, path, text))
    health = _any(host, HEALTH) | _any(path, HEALTH)
    named = F.when(_any(every, ("ministry of health", "ministère de la santé")), 2).when(_any(host, ("health", "sante")), 1).otherwise(0)
    score = F.when(ending, F.when(health, 8).otherwise(5)).otherwise(named)
    for terms in (("who",), ("cdc",), ("unicef", "un ", "united nations")):
        score = score + F.when(_any(every, terms), 1).otherwise(0)
    for bad in DISTRUSTED:
        score = score - F.when(F.contains(host, F.lit(bad)), 10).otherwise(0)
    return F.coalesce(official, score)


def keep_species(rows: DataFrame, names: dict[str, tuple[str, ...]], wanted: str) -> DataFrame:
    """Rows whose text names the wanted species, or none at all."""
    text = F.lower("text")
    named = {s: _any(text, tuple(n.lower() for n in ns)) for s, ns in names.items()}
    return rows.where(named[wanted] | ~reduce(lambda a, b: a | b, named.values()))


def antibody_context(context: Column) -> Column:
    """Whether a mention stands in the context of an antibody, whose residues aren't the pathogen's."""
    return context.rlike(ANTIBODY)


#: Share of the kept count by which a report may be off and still be the same outbreak.
NEAR = 0.02


def similar_outbreaks(rows: DataFrame) -> DataFrame:
    """(country, year, ordinal, cases, deaths) -> the rows left after greedy merging within 2 % of an earlier one's counts.

    Which row stays depends on the order, but only where counts are near. Of reports with the same counts the first decides for
    all, so a season (country and year) is its distinct counts; these are sorted by cases and cut wherever neighbours are over 2 % apart, as
    no two reports across such a cut can be the same outbreak. What is walked in one task is a chain between two cuts, each
    report against those kept in the neighbouring cells of a logarithmic grid, so a chain of any length takes linear time. Reports
    without cases are equal to such of the same deaths only, and aren't walked. Rows without country or year all stay.
    """
    dated = rows.where("country is not null and year is not null")
    season = ["country", "year"]
    first = F.min(F.struct("ordinal", *[c for c in rows.columns if c != "ordinal"])).alias("row")
    distinct = stored(dated.groupBy(*season, "cases", "deaths").agg(first), "outbreak-counts")
    plain = distinct.where("cases is null").select("row.*")
    counts = distinct.where("cases is not null").select(*season, "cases").distinct()
    before = F.lag("cases").over(W.partitionBy(*season).orderBy("cases"))
    cut = F.when(before.isNull() | (F.col("cases") - before > NEAR * F.greatest(F.abs("cases"), F.abs(before))), 1).otherwise(0)
    chains = counts.withColumn("_cut", cut).withColumn("_chain", F.sum("_cut").over(W.partitionBy(*season).orderBy("cases"))).drop("_cut")
    walked = distinct.where("cases is not null").join(chains, [*season, "cases"])
    alone = walked.groupBy(*season, "_chain").agg(F.count(F.lit(1)).alias("_n"))
    walked = stored(walked.join(alone, [*season, "_chain"]), "outbreak-chains")
    kept = walked.where("_n = 1").select("row.*").unionByName(_greedy(walked.where("_n > 1"), season, rows))
    return kept.unionByName(plain).select(*rows.columns).unionByName(rows.where("country is null or year is null"))


def _greedy(walked: DataFrame, season: list[str], rows: DataFrame) -> DataFrame:
    """The rows of chains that stay: the walk sees numbers only, the rows are joined back."""
    numbered = walked.select(*season, "_chain", F.col("row.ordinal").alias("ordinal"), F.col("cases").cast("double").alias("cases"), F.col("deaths").cast("double").alias("deaths"), "row")
    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in [*season, "ordinal"]) + ", _chain long, cases double, deaths double"
    stay = numbered.select(*season, "ordinal", "_chain", "cases", "deaths").groupBy(*season, "_chain").applyInPandas(_walk, schema)
    stay = stay.select(*[F.col(c).alias(f"k_{c}") for c in (*season, "ordinal", "cases", "deaths")])
    on = [F.col(c).eqNullSafe(F.col(f"k_{c}")) for c in (*season, "ordinal", "cases", "deaths")]
    return numbered.join(stay, on, "left_semi").select("row.*")


def _walk(chain):
    """A chain's reports in the order of their ordinals, each held against those kept in the cells around its own."""
    cell = lambda x: int(math.log(x) / math.log(1.03)) if x >= 1 else -1 - int(x < 0)  # noqa: E731  2 % apart are neighbours at most
    cells: dict[int, dict] = {}
    stay = []
    for i, (c, d) in enumerate(zip((chain := chain.sort_values(["ordinal", "cases", "deaths"], ignore_index=True))["cases"], chain["deaths"], strict=True)):
        d = None if d != d else d
        at, by = cell(c), None if d is None else cell(d)
        same = False
        for near in (cells.get(at + k, {}) for k in (-1, 0, 1)):
            held = near.values() if by is None else [near.get(k, ()) for k in (by - 1, by, by + 1, None)]
            for kc, kd in (x for group in held for x in group):
                away = abs(kd - d) if kd is not None and d is not None else 0
                same = abs(kc - c) <= max(0, int(kc * NEAR)) and away <= (max(0, int(kd * NEAR)) if kd is not None else 0)
                if same:
                    break
            if same:
                break
        if not same:
            cells.setdefault(at, {}).setdefault(by, []).append((c, d))
            stay.append(i)
    return chain.iloc[stay]


def distinct_titles(rows: DataFrame, key: Column) -> DataFrame:
    """One row per title key: the earliest by ordinal."""
    return first_per(rows.withColumn("_key", key), ["_key"], "ordinal").drop("_key")


# Phenotype and the words of a description that stand for it, the first that is found counting. The
# description is lower-cased before, so "IFN" never is.
DESCRIPTION_LADDER = (
    ("vaccine_effectiveness", ("vaccine", "vaccination", "immunization")), ("immune_escape", ("antibody", "neutraliz", "immunoglobulin", "escape", "IFN", "antagonize", "antagonist")),
    ("disease_severity", ("severity", "severe", "mortality", "lethal", "fatal", "virulence", "virulent", "pathogenicity", "pathogen")), ("increased_transmission", ("transmission", "transmissible")),
    ("drug_resistance", ("resistance", "resistant")), ("drug_susceptibility", ("susceptib", "sensitive", "sensitivity")), ("host_adaptation", ("host adaptation", "adapted to", "mouse-adapted", "guinea pig-adapted", "isolate")),
    ("host_range", ("host range", "host tropism", "species specificity")),
    ("virulence", ("replication", "replicative", "release", "entry", "enter", "infectivity", "oligomerization", "trimerization", "processing", "localization", "rna-binding", "binding", "fusion", "synthesis", "interaction", "shedding", "secretion", "counteract", "budding")),
)
# Descriptions of features without effect, and contexts of antibodies.
NO_EFFECT = r"(?i)\bno effect\b|\bnot affect\b|\bdoes not affect\b|\bno loss\b"
ANTIBODY = r"(?i)\b(light[- ]chain|heavy[- ]chain|CDR|framework|complementarity[- ]determining|framework[- ]region|FR[- ]grafting|ADI-\d+)\b|[A-Z]\d+[A-Z]\s*[-–]\s*(LC|HC|VL|VH)\b"


def described_phenotype(description: Column) -> Column:
    """The phenotype of a feature's description; unknown_significance if no word is found."""
    text = F.lower(description)
    return reduce(lambda rest, x: F.when(_any(text, x[1]), F.lit(x[0])).otherwise(rest), reversed(DESCRIPTION_LADDER), F.lit("unknown_significance"))


def whole_names(docs: DataFrame, names: list[str]) -> DataFrame:
    """docs (id, text) -> id, name of every name that stands in a text as a whole word, in either case."""
    hits = F.filter(F.array(*[F.when(F.col("text").rlike(rf"(?i)(?<![A-Za-z0-9_])\Q{n}\E(?![A-Za-z0-9_])"), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    return docs.select("id", F.explode(hits).alias("name"))


def candidates(variants: DataFrame, motifs: DataFrame, clades: DataFrame, found: DataFrame) -> DataFrame:
    """(id, name) of variants, motifs and clades x (id, category) of phenotypes -> id, kind, name, category, association_id, each once.

    Products are within one publication, which names a handful of each.
    """
    from ..functions.scalars import association_id

    rows = [df.select("id", F.lit(kind).alias("kind"), "name") for kind, df in (("variant", variants), ("motif", motifs), ("clade", clades))]
    pairs = reduce(DataFrame.unionByName, rows).join(found.select("id", "category"), "id").distinct()
    return pairs.withColumn("association_id", association_id(F.concat_ws("|", F.col("id").cast("string"), "kind", "name", "category")))


def feature_associations(features: DataFrame) -> DataFrame:
    """(entry, position, ref, alt, description) -> associations with their phenotype; features said to have no effect are left out."""
    rows = features.where(~F.col("description").rlike(NO_EFFECT))
    return rows.select("entry", "position", "ref", "alt", described_phenotype(F.col("description")).alias("category"))

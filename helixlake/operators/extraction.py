"""What reports tell beyond keywords: parameters, people, places, products; profiles and features; nested documents.

Reports are (ordinal, url, text, ...) rows; of what several of them tell, the one of least ordinal is named as the source.
Null texts tell nothing. Each rule is an expression, so that a text is read in one pass whatever the number of rules.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import parse_gene_mutation, region_of
from ..sources.sinks import stored
from .mining import DEMOGRAPHICS, PRODUCTS, ROUTES

# Patterns of transmission parameters.
INCUBATION = r"incubation\s+period(?:\s+is|\s+of)?\s+(?:about|approximately|up\s+to)?\s*(\d+\s*(?:to|-|–)\s*\d+)\s*days?"
INCUBATION_UP_TO = r"incubation\s+period(?:\s+is|\s+of)?\s+up\s+to\s+(\d+)\s*days?"
SERIAL = r"serial\s+interval(?:\s+is|\s+of)?\s+(?:about|approximately)?\s*(\d+\.?\d*)\s*days?"
REPRODUCTION = r"(?:r0|reproductive\s+number|reproduction\s+number|basic\s+reproduction\s+number|r_0)\s*[:\s-]\s*(\d+\.?\d*)"
VECTOR = r"\b(mosquito(?:es)?|tick(?:s)?|sandfl(?:y|ies)|midges?|fle(?:a|as))\b\s*(?:bite|bites|vector)?"
SEROPREVALENCE = r"seroprevalence\s+(?:of\s+|was\s+)?([\d.]+)\s*%\s*(?:among|in)?\s*([a-z ,]{0,60})"
# Patterns of sexes and of how many fell ill of each.
MALE, FEMALE, SPLIT = r"\bmales?\b|\bmen\b", r"\bfemales?\b|\bwomen\b", r"(\d+)\s*(?:male|men)\s*(?:and|&)?\s*(\d+)\s*(?:female|women)"
# What is told of a reservoir, and its name; the first that holds counts.
RESERVOIRS = ((r"fruit bat|pteropus", "fruit bats (Pteropodidae)"), (r"\breservoir\b.{0,40}\b(bats?|bat\b)", "bats"), (r"\bnatural\s+host\b.{0,40}\b(bats?|bat\b)", "bats"))
# Kinds of features of a protein.
DOMAIN_FEATURES = ("Domain", "Region", "Motif", "Compositional bias", "Topological domain", "Transmembrane", "Signal", "Coiled coil")
SITE_FEATURES = ("Site", "Active site", "Binding site", "Glycosylation", "Lipidation", "Disulfide bond")
_PEOPLE = ("age_group", "sex", "occupation", "population_affected", "risk_group", "exposure_history", "setting", "host_species", "risk_factor", "notes")


def _has(text: Column, terms: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(text, F.lit(t)) for t in terms])


def first_told(docs: DataFrame, rules: list[tuple[Column, dict]], names: tuple[str, ...], same: tuple[str, ...] | None = None) -> DataFrame:
    """docs x rules (condition, values) -> names, source_url: rows of the same values (of `same`, by default of all names) once, as the first document and rule tell them.

    The least ordinal of every value is found first, by a hash of numbers; only documents of these ordinals are read again for the rest, since
    a least row of texts would have Spark sort all that is told.
    """
    lit = lambda x: x if isinstance(x, Column) else F.lit(x)
    met = F.array(*[F.when(when, F.lit(i)) for i, (when, _) in enumerate(rules)])
    said = lambda n: F.coalesce(*[F.when(F.col("rule") == i, lit(values[n]).cast("string")) for i, (_, values) in enumerate(rules) if values.get(n) is not None], F.lit(None).cast("string")).alias(n)
    told = lambda docs: docs.withColumn("rule", F.explode(met)).where("rule is not null").select("ordinal", "url", F.struct("rule", *map(said, names)).alias("r"))
    by = [F.col(f"r.{n}").alias(f"_{n}") for n in same or names]
    at = F.coalesce("ordinal", F.lit(-(2**63)))  # none is before all others
    least = told(docs).groupBy(*by).agg(F.min(at).alias("_at")).select("_at").distinct()
    first = told(docs.withColumn("_at", at).join(least, "_at", "left_semi")).groupBy(*by).agg(F.min(F.struct("ordinal", "r.rule", *[f"r.{n}" for n in names], "url")).alias("m"))
    return first.select(*[f"m.{n}" for n in names], F.col("m.url").alias("source_url"))


def _optional(docs: DataFrame, name: str, kind: str) -> Column:
    return F.col(name) if name in docs.columns else F.lit(None).cast(kind)


def transmission_parameters(docs: DataFrame) -> DataFrame:
    """parameter, value, unit, source_url: reproduction number, incubation, serial interval, routes, vectors.

    Structured fields (r0_range, transmission), where docs have them, are rules of their own beside those of the text.
    """
    text = F.lower("text")
    part = lambda pattern: F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
    rule = lambda when, parameter, value, unit=None: (when, {"parameter": parameter, "value": value, "unit": unit})
    given, route = _optional(docs, "r0_range", "string"), _optional(docs, "transmission", "string")
    span, most = part(INCUBATION), part(INCUBATION_UP_TO)
    days = F.coalesce(F.trim(F.replace(span, F.lit("–"), F.lit("-"))), F.concat(F.lit("up to "), most))
    rules = [
        *[rule(value != "", name, value) for name, value in (("R0", given), ("main transmission route", route))],
        *[rule(value.isNotNull(), name, value, unit) for name, value, unit in (("incubation period", days, "days"), ("serial interval", part(SERIAL), "days"), ("R0", part(REPRODUCTION), None))],
        *[rule(_has(text, terms), "main transmission route", label) for terms, label in ROUTES],
        rule(part(VECTOR).isNotNull() & _has(text, ("vector", "bite", "borne")), "vector", part(VECTOR)),
    ]
    return first_told(docs, rules, ("parameter", "value", "unit"))


def people(docs: DataFrame) -> DataFrame:
    """Groups of people, exposures, settings, hosts and sexes that reports tell of, with the counts of either sex."""
    docs, text = docs.withColumn("text", F.lower("text")), F.col("text")
    group = {
        "healthcare_workers": {"occupation": "healthcare worker", "risk_group": "healthcare workers", "risk_factor": "occupational exposure"}, "children": {"age_group": "children", "population_affected": "children"},
        "pregnant_women": {"sex": "female"}, "elderly": {"age_group": "elderly", "population_affected": "elderly"},
    }
    column = {"exposure": "exposure_history", "setting": "setting", "host": "host_species"}
    note = {"group": "{} mentioned", "exposure": "{} reported", "setting": "{} setting reported", "host": "{} reported as affected host species"}
    rules = []
    for terms, kind, label in DEMOGRAPHICS:
        told = group[label] if kind == "group" else {column[kind]: label}
        rules.append((_has(text, terms), told | {"notes": note[kind].format(label.replace("_", " ") if kind == "group" else label) + " in fetched source"}))
    rules += [(text.rlike(p), {"sex": s, "notes": "mentioned in fetched source"}) for p, s in ((MALE, "male"), (FEMALE, "female"))]
    men, women = F.regexp_extract(text, SPLIT, 1), F.regexp_extract(text, SPLIT, 2)
    rules.append((men != "", {"sex": "male/female", "notes": F.concat(men, F.lit(" male, "), women, F.lit(" female"))}))
    return first_told(docs, rules, _PEOPLE)


def surveillance(docs: DataFrame) -> DataFrame:
    """docs (ordinal, url, country, year, text) -> a row per country: region, first year and its source, seroprevalence; and the
    reservoir that the first report which names any tells of, the same for all."""
    text = F.lower("text")
    found = reduce(lambda rest, x: F.when(text.rlike(x[0]), F.lit(x[1])).otherwise(rest), reversed(RESERVOIRS), F.lit(None).cast("string"))
    named = docs.select("ordinal", found.alias("r")).where("r is not null").agg(F.min_by("r", "ordinal").alias("r")).first()["r"]
    share = F.nullif(F.regexp_extract(text, SEROPREVALENCE, 1), F.lit("")).try_cast("double")
    told = F.when(share.isNotNull(), F.struct("ordinal", share.alias("pct"), F.nullif(F.trim(F.regexp_extract(text, SEROPREVALENCE, 2)), F.lit("")).alias("population"), "url"))
    rows = docs.where("country is not null and country <> ''").groupBy("country").agg(
        F.min(F.when(F.col("year").isNotNull(), F.struct("year", "ordinal", "url"))).alias("first"), F.min(told).alias("sero"),
    )
    url = F.coalesce(F.nullif("first.url", F.lit("")), F.col("sero.url"))
    return rows.select("country", region_of(F.col("country")).alias("region"), F.col("first.year").alias("first_documented"), F.lit(named).alias("reservoir"), F.col("sero.pct").alias("seroprevalence_pct"), F.col("sero.population").alias("seroprevalence_population"), url.alias("source_url"))


def products(docs: DataFrame) -> DataFrame:
    """Vaccines and therapeutics: structured flags (vaccine_coverage, therapeutic_coverage), where docs have them, then names."""
    text = F.lower("text")
    flag = lambda name, kind: (F.coalesce(_optional(docs, f"{name}_coverage", "boolean"), F.lit(False)), {"product": f"{name} coverage available", "kind": kind, "status": "used", "notes": "supported by species/strain profile"})
    rules = [flag("vaccine", "vaccine"), flag("therapeutic", "therapeutic")]
    rules += [(_has(text, terms), {"product": p, "kind": k, "status": s, "effectiveness": e, "notes": "mentioned in fetched source"}) for terms, p, k, s, e in PRODUCTS]
    return first_told(docs, rules, ("product", "kind", "status", "effectiveness", "notes"), ("product",))


def pathogen_profile(items: DataFrame, fields: list[str], key: str = "pathogen") -> DataFrame:
    """key and fields of each pathogen's first item of the type strain_profile."""
    rows = items.where("item_type = 'strain_profile'")
    return rows.groupBy(key).agg(F.min_by(F.struct(*fields, F.col("url").alias("source_url")), "ordinal").alias("p")).select(key, "p.*")


def protein_features(entries: DataFrame) -> DataFrame:
    """entries (features: array<type, description, start, end, pmids>, references: array<database, id>, citations: array<string>,
    max_length) -> key_domains, functional_sites, pdb_ids, literature_refs.

    Features that end beyond the protein are left out, but what they cite is not; ids are given once, PubMed's in order.
    """
    fits = lambda x: F.col("max_length").isNull() | x["end"].isNull() | (x["end"] <= F.col("max_length"))
    item = lambda x: F.struct(x["type"].alias("type"), F.coalesce(x["description"], F.lit("")).alias("description"), x["start"].alias("start"), x["end"].alias("end"))
    of = lambda kinds: F.transform(F.filter("features", lambda x: x["type"].isin(*kinds) & fits(x)), item)
    ids = lambda a: F.filter(a, lambda x: x.isNotNull() & (x != ""))
    pdb = F.array_distinct(ids(F.transform(F.filter("references", lambda x: x["database"] == "PDB"), lambda x: x["id"])))
    cited = F.array_sort(F.array_distinct(ids(F.concat("citations", F.flatten(F.transform("features", lambda x: F.coalesce(x["pmids"], F.array().cast("array<string>"))))))))
    return entries.select("accession", of(DOMAIN_FEATURES).alias("key_domains"), of(SITE_FEATURES).alias("functional_sites"), pdb.alias("pdb_ids"), cited.alias("literature_refs"))


def stated_variants(rows: DataFrame) -> DataFrame:
    """Rows with a readable hgvs_p or with all of gene, position, ref_aa and alt_aa; a field that is given goes before what hgvs_p says."""
    read = parse_gene_mutation(F.col("hgvs_p"))
    given = (F.col("gene") != "") & F.col("position").isNotNull() & (F.col("ref_aa") != "") & (F.col("alt_aa") != "")
    part = lambda c, p: F.coalesce(c, read[p]).alias(c)
    kept = rows.where(read.isNotNull() | F.coalesce(given, F.lit(False)))
    return kept.select(*[c for c in rows.columns if c not in ("gene", "position", "ref_aa", "alt_aa")], part("gene", "gene"), part("position", "position"), part("ref_aa", "ref"), part("alt_aa", "alt"))


def lenient_string(value: Column) -> Column:
    """A JSON value as text: of a list its items with commas (null if empty), of a number its digits, of a string itself."""
    items = F.from_json(value, "array<string>")
    scalar = F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v")
    return F.when(F.ltrim(value).startswith("["), F.when(F.size(items) > 0, F.array_join(items, ", ", "None"))).otherwise(scalar)


def flat_metrics(docs: DataFrame, key: str, document: str = "document", depth: int | None = None) -> DataFrame:
    """key, metric, value: the leaves of a JSON object under dotted names, at any depth (or down to `depth` levels).

    Lists are joined with semicolons, their objects as sorted name=value pairs less names that begin with an underscore;
    a null value is an empty text. A level is a job over the objects that are left, so there are as many as the deepest document has.
    """
    level = stored(docs.select(key, F.lit(None).cast("string").alias("metric"), F.col(document).alias("value")), "metrics")
    out, k = [], 0
    while True:
        level = level.select(key, "metric", F.explode(F.from_json("value", "map<string,string>")).alias("name", "v"))
        level = stored(level.select(key, F.concat_ws(".", "metric", "name").alias("metric"), F.col("v").alias("value")), "metrics")
        k += 1
        nested = F.coalesce(F.col("value").startswith("{"), F.lit(False)) & F.lit(depth is None or k < depth)
        out.append(level.where(~nested))
        level = level.where(nested)
        if not level.limit(1).count():
            break
    shown = lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("None")))
    one = lambda m: F.array_join(F.transform(F.array_sort(F.filter(F.map_entries(m), lambda e: ~e["key"].startswith("_"))), shown), ", ")
    objects = F.array_join(F.transform(F.from_json("value", "array<map<string,string>>"), one), "; ")
    plain = F.array_join(F.from_json("value", "array<string>"), "; ", "None")
    text = F.when(F.col("value").rlike(r"^\[\s*\{"), objects).when(F.col("value").startswith("["), plain).otherwise(F.coalesce("value", F.lit("")))
    return reduce(DataFrame.unionByName, out).select(key, "metric", text.alias("value"))


def without_empty(c: Column, kind: T.DataType) -> Column:
    """A value less its empty parts, at all depths of its type: null for an empty text, list or object. to_json() leaves nulls out."""
    if isinstance(kind, T.StringType):
        return F.nullif(c, F.lit(""))
    if isinstance(kind, T.FloatType | T.DoubleType):
        return F.when(~F.isnan(c), c)
    if isinstance(kind, T.ArrayType):
        kept = F.filter(F.transform(c, lambda x: without_empty(x, kind.elementType)), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, kept)
    if isinstance(kind, T.StructType):
        parts = [without_empty(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(reduce(lambda a, b: a | b, [p.isNotNull() for p in parts], F.lit(False)), F.struct(*parts))
    return c


def within_budget(items: DataFrame, most: int, key: str = "doc") -> DataFrame:
    """items (key, list_no, place, item) of documents' lists -> those that are left when each document is within `most` characters.

    Items go one by one from the end of the list that is longest at the time (of equals the first), until what is left
    fits or no list has a second item: so the item at place p goes before all of lower places, and the order of going is
    known without walking through it. An item counts its characters and two for what separates it from the next.
    """
    size = F.length("item") + 2
    whole = F.sum(size).over(W.partitionBy(key))
    gone = F.coalesce(F.sum(size).over(W.partitionBy(key).orderBy(F.col("place").desc(), "list_no").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return items.withColumns({"_whole": whole, "_gone": gone}).where((F.col("place") == 1) | (F.col("_whole") - F.col("_gone") <= most)).drop("_whole", "_gone")


#: What a document says of itself once entries of it have been left out, and how many may be.
TRUNCATED, MOST_POPS = "Some lower-priority list entries were omitted to fit the context window.", 10_000


def trimmed(context: dict, most: int) -> dict:
    """A document within `most` characters of JSON: entries go from the end of whichever list in it is longest (the first of equals, from the top
    down), until it fits or no list has a second entry. Sizes are kept up to date by what goes, lists by their lengths in a heap."""
    lists: list[list] = []
    inside: list[tuple[int, int]] = []  # of each list the range of numbers of the lists within it

    def walk(node: object) -> None:
        if isinstance(node, list):
            number = len(lists)
            lists.append(node)
            inside.append((0, 0))
        for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
            walk(child)
        if isinstance(node, list):
            inside[number] = (number + 1, len(lists))

    walk(context)
    number_of = {id(x): i for i, x in enumerate(lists)}
    gone = bytearray(len(lists))
    heap = [(-len(x), i) for i, x in enumerate(lists)]
    heapq.heapify(heap)
    size, pops = len(json.dumps(context, default=str)), 0

    def drop(node: object) -> None:
        """The lists within what has gone are gone too."""
        if isinstance(node, list):
            first, end = inside[number_of[id(node)]]
            gone[first - 1 : end] = b"\1" * (end - first + 1)
        elif isinstance(node, dict):
            for child in node.values():
                drop(child)

    while size > most and pops < MOST_POPS and heap:
        length, number = heapq.heappop(heap)
        if gone[number]:
            continue
        if -length <= 1:
            break
        last = lists[number].pop()
        drop(last)
        size -= len(json.dumps(last, default=str)) + 2
        if not pops:
            before = len(json.dumps(context, default=str))
            context["_truncated"] = TRUNCATED
            size += len(json.dumps(context, default=str)) - before
        pops += 1
        heapq.heappush(heap, (length + 1, number))
    return context


def trimmed_documents(docs: DataFrame, most: int, key: str = "doc") -> DataFrame:
    """(key, document: JSON text of an object) -> the same, each within `most` characters as `trimmed` says; others than objects stay as they are."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["document"]:
                value = json.loads(text) if text and text.lstrip().startswith("{") else None
                out.append(text if value is None else json.dumps(trimmed(value, most)))
            yield pd.DataFrame({key: batch[key], "document": out})

    return docs.select(key, "document").mapInPandas(run, f"{key} {kind}, document string")


def lineage_behaviour(genomes: DataFrame, lineages: DataFrame) -> DataFrame:
    """How each lineage has behaved: first and last detection, years, persistence, countries a year, and spillover.

    genomes (lineage_id, collection_date, collection_country), lineages (lineage_id, reservoir, primary_host). Persistence
    is continuous with 5 active years, intermittent over a span of 5, else limited.
    """
    year = F.year("collection_date")
    per = genomes.where("lineage_id is not null").groupBy("lineage_id").agg(
        F.count(F.lit(1)).alias("genome_count"), F.min("collection_date").alias("first_detection"), F.max("collection_date").alias("last_detection"), F.count_distinct(year).alias("active_years"),
        (F.max(year) - F.min(year)).alias("span"), F.count_distinct(F.when(year.isNotNull(), F.col("collection_country"))).alias("n_countries"),
    )
    years = F.round(F.datediff("last_detection", "first_detection") / 365.25, 2)
    kind = F.when(F.col("active_years") >= 5, "continuous").when(F.col("span") >= 5, "intermittent").when(F.col("active_years") > 0, "limited")
    animal = lambda c: F.coalesce(~F.lower(c).isin("human", "unknown", ""), F.lit(False)).cast("int")
    out = per.join(lineages, "lineage_id", "left").withColumns({"detection_span_years": years, "persistence_index": kind})
    rate = F.when((F.col("n_countries") >= 2) & (F.col("detection_span_years") > 0), F.round(F.col("n_countries") / F.greatest("detection_span_years", F.lit(0.5)), 2))
    return out.select("lineage_id", "genome_count", "first_detection", "last_detection", "detection_span_years", "active_years", "persistence_index", rate.alias("countries_per_year"), (2 * animal(F.col("reservoir")) + animal(F.col("primary_host"))).alias("spillover_risk_score"))


def origin(rows: DataFrame) -> DataFrame:
    """rows (sample_id, tip_countries nearest first, first_country, countries_reported, common_country) -> origin, confidence, by.

    The nearest tip's country (high with three tips of known country, else medium); else where the lineage was first
    detected (medium); else the first country it is reported from (low); else that of most genomes (low).
    """
    tips = F.filter("tip_countries", lambda x: x.isNotNull() & (x != ""))
    of = lambda c, confidence, by: F.when(F.coalesce(c, F.lit("")) != "", F.struct(c.alias("origin"), confidence.alias("confidence"), F.lit(by).alias("by")))
    first = of(F.get(tips, F.lit(0)), F.when(F.size(tips) >= 3, "high").otherwise("medium"), "nearest_tips")
    levels = [first, of(F.col("first_country"), F.lit("medium"), "first_detected"), of(F.get("countries_reported", F.lit(0)), F.lit("low"), "reported"), of(F.col("common_country"), F.lit("low"), "most_genomes")]
    return rows.select("sample_id", F.coalesce(*levels).alias("o")).select("sample_id", "o.*")

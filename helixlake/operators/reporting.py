"""What a report keeps of its evidence: the first findings, small values of metrics, the names that may be cited, and the questions asked."""

from __future__ import annotations

from functools import reduce
from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Analyses left out, and how much of the others is kept.
EXCLUDED = ("evidence_weighted_threat",)
FINDINGS = 20
LIST_ITEMS = 5
ENTRIES = 10

# Id, condition (null: none), template, fallback, fields of the answer.
QUESTIONS = (
    ("Q1_species_outbreaks", None, "List historical outbreaks of {species_name}. For each, include date, country, total cases, total deaths, calculated CFR, and duration if available.", None, "date,country,cases,deaths,cfr,duration"),
    ("Q2_lineage_epidemiology", "lineage IS NOT NULL AND lineage <> 'unknown'", "For lineage {lineage} of {species_name}, what was the epidemiological profile (country, year, cases, deaths, CFR, key transmission features) of its primary outbreak?", "What is the known epidemiological profile of {species_name}?", "lineage,country,year,cases,deaths,cfr"),
    ("Q3_demographics", None, "Which demographic groups were most affected by {species_name} (age groups, gender, occupation/risk groups such as healthcare workers or children, and any stated risk factors)?", None, "group,age_range,gender,risk_factor,notes"),
    ("Q4_cfr_breakdown", None, "What is the case fatality rate (CFR) for {species_name}, and how does it vary by outbreak, country, age group, or treatment access?", None, "context,cfr,country,age_group,treatment_access"),
    ("Q5_transmission_params", None, "What transmission parameters are documented for {species_name}: incubation period, serial interval, R0/reproductive number, and main transmission routes?", None, "parameter,value,unit,notes"),
    ("Q6_interventions", None, "What interventions were used against {species_name} (vaccines, contact tracing, isolation, PPE, safe burial, therapeutics, public health measures)?", None, "intervention,type,effectiveness,status"),
    ("Q7_clinical_severity", "lineage IS NOT NULL", "Has lineage {lineage} been associated with specific clinical severity or atypical presentations?", "What clinical features (severity, common symptoms, atypical presentations, hospitalization) are typical for {species_name} infection?", "feature,lineage,severity,frequency,notes"),
    ("Q8_geographic_range", None, "What is the geographic range of {species_name}? Include countries, regions, first documented occurrence, and the known reservoir if stated.", None, "country,region,first_documented,reservoir"),
    ("Q9_country_history", "country IS NOT NULL", "For the country where this sample was collected ({country}), what is the history of {species_name} outbreaks?", None, "date,country,outbreak,lineage,cases,deaths"),
    ("Q10_temporal_assessment", "lineage IS NOT NULL AND collection_date IS NOT NULL AND lineage_last_seen IS NOT NULL", "Given this sample was collected on {collection_date} and lineage {lineage} was last documented in {lineage_last_seen}, what are the epidemiological implications?", "Given this sample was collected on {collection_date}, what temporal patterns in {species_name} emergence are relevant?", "scenario,evidence,confidence"),
    ("Q11_novel_pathogen", "species_id IN ('UNKNOWN', 'NOVEL', 'unknown', 'novel')", "This appears to be a novel or unclassified pathogen in the {pathogen_family} family. What is known about related species?", None, "related_species,disease,geographic_range,reservoir"),
    ("Q12_risk_factors", None, "What documented risk factors and exposure settings are reported for {species_name} (e.g., bushmeat, animal contact, funeral attendance, household contact, healthcare exposure, unsafe burial, sexual transmission, traditional healer)?", None, "risk_factor,setting,context,notes"),
    ("Q13_diagnostics", None, "What diagnostic and laboratory confirmation methods were reported for {species_name} (e.g., RT-PCR, PCR, antigen detection, serology, ELISA, sequencing, viral culture, BSL-4/biosafety)?", None, "method,type,target,notes"),
    ("Q14_vaccine_therapeutics", None, "What vaccine and therapeutic products were reported for {species_name}, and what is known about their status or effectiveness?", None, "product,type,status,effectiveness,notes"),
)


def _rendered(template: str | None) -> Column:
    """A template's text with its fields put in; null, if one of them is."""
    parts = [] if template is None else [p for text, field, _, _ in Formatter().parse(template) for p in ([F.lit(text)] if text else []) + ([F.col(field).cast("string")] if field else [])]
    return F.concat(*parts) if parts else F.lit(None).cast("string")


def conditional_questions(rows: DataFrame, templates=QUESTIONS) -> DataFrame:
    """rows (sample_id and the columns that templates and conditions name) -> sample_id, question_id, question, fields.

    The template where its condition holds, else the fallback; without one, or if a column put into the text is null, it isn't asked.
    """
    asked = [
        F.struct(F.lit(name).alias("question_id"), (F.when(F.expr(when), _rendered(text)).when(F.coalesce(F.expr(when), F.lit(False)) == F.lit(False), _rendered(other)) if when else _rendered(text)).alias("question"), F.lit(fields).alias("fields"))
        for name, when, text, other, fields in templates
    ]
    return rows.select("sample_id", F.explode(F.array(*asked)).alias("q")).where("q.question is not null").select("sample_id", "q.*")


def _filled(rows: DataFrame, name: str) -> Column:
    """Empty texts, lists and maps as null."""
    c, kind = F.col(name), rows.schema[name].dataType
    if isinstance(kind, T.StringType):
        return F.nullif(c, F.lit("")).alias(name)
    return (F.when(F.size(c) > 0, c) if isinstance(kind, (T.ArrayType, T.MapType)) else c).alias(name)


def compact_findings(rows: DataFrame, limit: int = FINDINGS, excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """rows (analysis, place, fields of a finding) -> analysis, place, finding (JSON without empty fields), findings (how many there are).

    The first `limit` of each analysis by place, nulls first; ties by the JSON. An analysis without a name is one of its own. The limit is
    applied before the shuffle, so a hot analysis sends `limit` rows a task.
    """
    fields = [_filled(rows, c) for c in rows.columns if c not in ("analysis", "place")]
    rows = rows.where(F.coalesce(~F.col("analysis").isin(*excluded), F.lit(True)))
    shown = rows.select("analysis", "place", F.to_json(F.struct(*fields)).alias("finding"))
    first = shown.withColumn("_r", F.row_number().over(W.partitionBy("analysis").orderBy("place", "finding"))).where(F.col("_r") <= limit).drop("_r")
    counts = rows.groupBy(F.col("analysis").alias("_a")).agg(F.count(F.lit(1)).alias("findings"))
    return first.join(counts, F.col("analysis").eqNullSafe(F.col("_a"))).drop("_a")


def small_value(text: Column, items: int = LIST_ITEMS, entries: int = ENTRIES) -> Column:
    """JSON text of a value that is small enough, else null: scalars and null, lists of up to `items`, the first `entries` of an object in its order.

    Null is the value null; what isn't JSON is null, and so left out.
    """
    text = F.trim(F.coalesce(text, F.lit("null")))
    whole = F.from_json(text, "map<string, variant>")
    names = F.slice(F.json_object_keys(text), 1, entries)
    cut = F.to_json(F.map_filter(whole, lambda k, _: F.array_contains(names, k)))
    kind = F.substring(text, 1, 1)
    value = F.when(kind == "[", F.when(F.json_array_length(text) <= items, text)).when(kind == "{", F.when(F.size(F.json_object_keys(text)) <= entries, text).otherwise(cut)).otherwise(text)
    return F.when(F.try_parse_json(text).isNotNull(), value)


def small_metrics(rows: DataFrame, excluded: tuple[str, ...] = EXCLUDED, items: int = LIST_ITEMS, entries: int = ENTRIES) -> DataFrame:
    """rows (analysis, metric, value as JSON text) -> those whose value is small, large objects cut; see `small_value`."""
    rows = rows.where(F.coalesce(~F.col("analysis").isin(*excluded), F.lit(True)))
    return rows.select("analysis", "metric", small_value(F.col("value"), items, entries).alias("value")).where("value is not null")


def citation_catalogue(analyses: DataFrame, findings: DataFrame, cross: DataFrame, phenotypes: DataFrame, limit: int = FINDINGS, excluded: tuple[str, ...] = EXCLUDED) -> DataFrame:
    """kind, key, n: every name that a text may cite, and how often it is used.

    analyses (analysis); findings (source, finding_type, supporting_refs); cross (block, place, metric, source, title), of which the first
    `limit` of a block count; phenotypes (literature_refs). Null and empty names are none. Every input is exploded and counted in
    part before the one shuffle by name, so a name that most rows use sends a row a task.
    """
    name = lambda kind, key: F.array(F.struct(F.lit(kind).alias("kind"), key.cast("string").alias("key")))
    listed = lambda c: F.transform(F.coalesce(F.col(c), F.array().cast("array<string>")), lambda x: F.struct(F.lit("literature_refs").alias("kind"), x.alias("key")))
    first = cross.withColumn("_r", F.row_number().over(W.partitionBy("block").orderBy("place", "metric", "source"))).where(F.col("_r") <= limit)
    source = F.coalesce(F.nullif(F.col("source"), F.lit("")), F.col("title"))
    used = (
        (analyses.where(~F.col("analysis").isin(*excluded)).select("analysis").distinct(), name("analysis_names", F.col("analysis"))),
        (findings, F.concat(name("source_fields", F.col("source")), name("source_fields", F.col("finding_type")), listed("supporting_refs"))),
        (first, F.concat(name("cross_evidence_metric_names", F.col("metric")), name("source_fields", source))),
        (phenotypes, listed("literature_refs")),
    )
    names = reduce(DataFrame.unionByName, [rows.select(F.explode(keys).alias("k")).select("k.*") for rows, keys in used])
    return names.where("key <> ''").groupBy("kind", "key").agg(F.count(F.lit(1)).alias("n"))

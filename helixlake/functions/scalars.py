"""Column functions: notation, dates, numbers, identifiers, HTML and URLs. All are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# One- and three-letter residue codes.
RESIDUES = {
    "A": "Ala", "R": "Arg", "N": "Asn", "D": "Asp", "C": "Cys", "Q": "Gln", "E": "Glu", "G": "Gly", "H": "His", "I": "Ile",
    "L": "Leu", "K": "Lys", "M": "Met", "F": "Phe", "P": "Pro", "S": "Ser", "T": "Thr", "W": "Trp", "Y": "Tyr", "V": "Val", "*": "Ter",
}
# Spellings of countries, and regions.
COUNTRY_SPELLINGS = (
    (("drc", "democratic republic of the congo", "dr congo", "congo-kinshasa", "congo (drc)"), "democratic republic of the congo"),
    (("roc", "congo", "congo-brazzaville", "republic of the congo"), "republic of the congo"),
    (("usa", "united states", "united states of america", "us"), "united states"), (("uk", "united kingdom", "great britain"), "united kingdom"),
)
REGIONS = (
    ("Africa", ("Uganda", "Gabon", "Democratic Republic of Congo", "Congo", "Sierra Leone", "Liberia", "Guinea", "Nigeria", "Senegal", "Mali", "Sudan", "South Sudan", "Kenya", "Tanzania", "Cameroon", "Ghana", "Ivory Coast", "Côte d'Ivoire", "Zaire", "Angola", "Zambia", "Congo Republic")),
    ("Europe", ("Spain", "Italy", "Germany", "France", "United Kingdom", "UK", "Russia")),
    ("Asia", ("India", "China", "Japan", "South Korea", "Vietnam", "Thailand", "Philippines", "Indonesia", "Jordan", "Turkey", "Cambodia", "Palestine", "Gaza")),
    ("Americas", ("United States", "USA", "Brazil", "Mexico", "Colombia", "Peru", "Haiti")), ("Oceania", ("Australia",)),
)
# Words of an HTML entity and the character each stands for.
ENTITIES = {"&nbsp;": " ", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&apos;": "'", "&amp;": "&"}
MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def parse_gene_mutation(c: Column) -> Column:
    """GENE:RposA as struct(gene, ref, position, alt); null if it isn't of that form. Residues are upper case."""
    pattern = r"^([A-Za-z0-9_]+):([A-Z*])(\d+)([A-Z*])$"
    part = lambda i: F.regexp_extract(c, pattern, i)
    return F.when(c.rlike(pattern), F.struct(part(1).alias("gene"), part(2).alias("ref"), part(3).try_cast("int").alias("position"), part(4).alias("alt")))


def to_one_letter(c: Column) -> Column:
    """A residue in one letter, from one or three; null if unknown."""
    return F.when(F.length(c) == 1, F.upper(c)).otherwise(F.try_element_at(_map({v.lower(): k for k, v in RESIDUES.items()}), F.lower(c)))


def to_three_letters(c: Column) -> Column:
    return F.try_element_at(_map(RESIDUES), c)


def parse_protein_change(c: Column) -> Column:
    """p.Ala82Val or p.A82V as struct(ref, position, alt) in one-letter code."""
    pattern = r"^p\.([A-Za-z]{3}|[A-Z*])(\d+)([A-Za-z]{3}|[A-Z*])$"
    part = lambda i: F.regexp_extract(c, pattern, i)
    return F.when(c.rlike(pattern), F.struct(to_one_letter(part(1)).alias("ref"), part(2).try_cast("int").alias("position"), to_one_letter(part(3)).alias("alt")))


def parse_piped_variant(c: Column) -> Column:
    """prefix|SUB|A|82|V as struct(ref, position, alt)."""
    p = F.split(c, "[|]")
    return F.when((F.size(p) >= 5) & (F.get(p, F.lit(1)) == "SUB"), F.struct(F.get(p, F.lit(2)).alias("ref"), F.get(p, F.lit(3)).try_cast("int").alias("position"), F.get(p, F.lit(4)).alias("alt")))


def protein_change(ref: Column, position: Column, alt: Column) -> Column:
    """HGVS text: substitution, deletion (alt '-') or insertion (ref '-')."""
    pos = position.cast("string")
    return (
        F.when(alt == "-", F.concat(F.lit("p."), to_three_letters(ref), pos, F.lit("del")))
        .when(ref == "-", F.concat(F.lit("p."), pos, F.lit("_"), (position + 1).cast("string"), F.lit("ins"), to_three_letters(alt)))
        .otherwise(F.concat(F.lit("p."), to_three_letters(ref), pos, to_three_letters(alt)))
    )


def lineage_id(species: Column, clade: Column) -> Column:
    """species-clade, unless the clade has the prefix already."""
    return F.when(F.startswith(clade, F.concat(species, F.lit("-"))), clade).otherwise(F.concat(species, F.lit("-"), clade))


def country_name(c: Column) -> Column:
    """A country's name in lower case, by one spelling."""
    name = F.lower(F.trim(c))
    return F.coalesce(F.try_element_at(_map({s: n for ss, n in COUNTRY_SPELLINGS for s in ss}), name), name)


def region_of(c: Column) -> Column:
    """The region of a country, by exact name."""
    return F.try_element_at(_map({n: r for r, ns in REGIONS for n in ns}), c)


def report_date(c: Column) -> Column:
    """A timestamp out of the formats that reports and feeds use; null if none fits."""
    text = F.substring(F.trim(c), 1, 25)
    iso = F.regexp_extract(text, r"^(\d{4}-\d{2}-\d{2}(?:T\d{2}:\d{2}:\d{2})?)", 1)
    named = F.regexp_extract(text, r"^(?:[A-Za-z]{3}, )?(\d{1,2} [A-Za-z]{3} \d{4}(?: \d{2}:\d{2}:\d{2})?)", 1)
    fits = lambda t, f: F.when(F.length(t) > 0, F.try_to_timestamp(t, F.lit(f)))
    return F.coalesce(fits(iso, "yyyy-MM-dd'T'HH:mm:ss"), fits(iso, "yyyy-MM-dd"), fits(named, "d MMM yyyy HH:mm:ss"), fits(named, "d MMM yyyy"))


def country_and_region(c: Column) -> Column:
    """'Country: region, place' as struct(country, region)."""
    return F.struct(F.nullif(F.trim(F.get(F.split(c, ":", 2), F.lit(0))), F.lit("")).alias("country"), F.nullif(F.trim(F.get(F.split(c, ":", 2), F.lit(1))), F.lit("")).alias("region"))


def completeness(length: Column, description: Column) -> Column:
    said = F.when(F.contains(F.lower(description), F.lit("complete genome")), "complete")
    return F.coalesce(said, F.when(length >= 18000, "complete").when(length >= 12000, "near-complete").otherwise("partial"))


def record_date(c: Column) -> Column:
    """2014-06-14, 14-Jun-2014 or 1977 (its first day); null otherwise, 2014-05 included."""
    iso = F.when(c.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.try_to_date(c, "yyyy-MM-dd"))
    named = F.when(c.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{4}$"), F.try_to_date(c, "d-MMM-yyyy"))
    year = F.when(c.rlike(r"^\d{4}$"), F.try_to_date(F.concat(c, F.lit("-01-01")), "yyyy-MM-dd"))
    return F.coalesce(iso, named, year)


def partial_date(c: Column) -> Column:
    """The leading YYYY, YYYY-MM or YYYY-MM-DD, else the text itself."""
    return F.coalesce(F.nullif(F.regexp_extract(c, r"^(\d{4}(-\d{2}(-\d{2})?)?)", 1), F.lit("")), c)


def first_date_in_text(c: Column) -> Column:
    """The first ISO date, else 'Month d, yyyy', else 'd Month yyyy', else empty."""
    patterns = (r"\b(\d{4}-\d{2}-\d{2})\b", rf"(?i)\b((?:{MONTHS})\s+\d{{1,2}},?\s+\d{{4}})\b", rf"(?i)\b(\d{{1,2}}\s+(?:{MONTHS})\s+\d{{4}})\b")
    return F.coalesce(*[F.nullif(F.regexp_extract(c, p, 1), F.lit("")) for p in patterns], F.lit(""))


def lenient_int(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"(-?[\d,]*\d)", 1), ",", "").try_cast("long")


def lenient_float(c: Column) -> Column:
    return F.regexp_replace(F.regexp_extract(c, r"(-?[\d,]*\d(?:\.\d+)?)", 1), ",", "").try_cast("double")


def cfr_percent(given: Column, cases: Column, deaths: Column) -> Column:
    """A given rate within 0..100, else deaths in a hundred cases; to 2 digits."""
    derived = F.round(F.try_divide(deaths * 100.0, F.nullif(cases, F.lit(0))), 2)
    return F.coalesce(F.when(given.between(0, 100), F.round(given, 2)), F.when(derived.between(0, 100), derived))


def outbreak_id(pathogen: Column, country: Column, year: Column) -> Column:
    """First 16 digits of the SHA-1 of the three, joined by '|'. Case counts don't enter, so an update keeps its id."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return F.substring(F.sha1(F.concat_ws("|", text(pathogen), text(country), text(year))), 1, 16)


def association_id(name: Column) -> Column:
    """'gpa_' and the first 12 digits of the name's UUID (version 5) in the URL namespace."""
    namespace = F.unhex(F.lit("6ba7b8119dad11d180b400c04fd430c8"))
    return F.concat(F.lit("gpa_"), F.substring(F.sha1(F.concat(namespace, F.encode(name, "UTF-8"))), 1, 12))


def frequency_text(count: Column, total: Column) -> Column:
    return F.when(total > 0, F.format_string("%d/%d (%.1f%%)", count, total, count * 100.0 / total))


def unescape_html(c: Column) -> Column:
    for code, plain in ENTITIES.items():
        c = F.replace(c, F.lit(code), F.lit(plain))
    return c


def html_text(c: Column, limit: int | None = None) -> Column:
    """Text of a page; table rows stay lines, their cells stand between bars."""
    steps = (
        (r"(?is)<script[^>]*>.*?</script>", ""), (r"(?is)<style[^>]*>.*?</style>", ""), (r"(?i)</tr\s*>", "\n"), (r"(?i)<t[dh]\b[^>]*>", " | "),
        (r"(?i)</t[dh]\s*>", " "), (r"<[^>]+>", " "),
    )
    for pattern, by in steps:
        c = F.regexp_replace(c, pattern, by)
    c = unescape_html(c)
    for pattern, by in ((r"\s+\|\s+", " | "), (r"\n\s*\n+", "\n"), (r"[ \t]+", " ")):
        c = F.regexp_replace(c, pattern, by)
    c = F.regexp_replace(c, r"^\s+|\s+$", "")
    return F.substring(c, 1, limit) if limit else c


def plain_text(c: Column, limit: int) -> Column:
    """Without tags, unescaped, white space collapsed, cut."""
    return F.substring(F.trim(F.regexp_replace(unescape_html(F.regexp_replace(c, r"<[^>]+>", " ")), r"\s+", " ")), 1, limit)


def url_host(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.try_parse_url(c, F.lit("HOST"))), r"^www\.", "")


def joined_text(*parts: Column) -> Column:
    return F.concat_ws(" ", *[F.nullif(F.trim(p), F.lit("")) for p in parts])


def first_given(*parts: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(p, F.lit("")) for p in parts])


def pmids(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"PMID:\s*(\d+)"), F.lit(1)))


def context(text: Column, at: Column, around: int = 120) -> Column:
    """Text around an offset (from 0)."""
    start = F.greatest(at - around, F.lit(0))
    return F.substring(text, start + 1, at + around - start)


def title_key(c: Column) -> Column:
    """What two titles must share to be taken as one: letters only, without the words that every title has."""
    plain = F.trim(F.lower(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, r"\d{4}", ""), r"[^a-zA-Z\s]", " "), r"\s+", " ")))
    return F.trim(F.regexp_replace(plain, r"\b(update|en|ebola|virus|disease|outbreak|item|html|\d+)\b", ""))


def key_value_text(m: Column) -> Column:
    """A map as 'Key: value | ...' by key."""
    def entry(e: Column) -> Column:
        key = F.replace(e["key"], F.lit("_"), F.lit(" "))
        return F.concat(F.upper(F.substring(key, 1, 1)), F.substring(key, F.lit(2), F.length(key)), F.lit(": "), e["value"])

    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), entry), " | ")


def array_literal(c: Column) -> Column:
    """An array as {a,"b c"} text; elements with a comma, space, quote or brace stand in quotes."""
    quoted = F.transform(c, lambda x: F.when(x.rlike(r'[,\s"{}]'), F.concat(F.lit('"'), F.replace(x, F.lit('"'), F.lit('\\"')), F.lit('"'))).otherwise(x))
    return F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))


def parse_array_literal(c: Column) -> Column:
    """{a,"b, c"} text as an array."""
    body = F.regexp_replace(F.trim(c), r"^\{|\}$", "")
    parts = F.regexp_extract_all(body, F.lit(r'("(?:[^"\\]|\\.)*"|[^,]+)'), F.lit(1))
    return F.transform(parts, lambda x: F.replace(F.regexp_replace(F.trim(x), r'^"|"$', ""), F.lit('\\"'), F.lit('"')))


def sections(c: Column, mark: str = "###") -> Column:
    """Text split at its headings, as array<struct(title, body)>; what stands before the first is left out."""
    parts = F.split(F.concat(F.lit("\n"), c), rf"\n{mark} ")
    parts = F.slice(parts, F.lit(2), F.size(parts))
    return F.transform(parts, lambda p: F.struct(F.trim(F.get(F.split(p, "\n", 2), F.lit(0))).alias("title"), F.coalesce(F.get(F.split(p, "\n", 2), F.lit(1)), F.lit("")).alias("body")))


def run_id(kind: str, date: Column, sample: Column) -> Column:
    return F.concat(F.lit(f"{kind}-"), F.date_format(date, "yyyyMMdd"), F.lit("-"), sample)

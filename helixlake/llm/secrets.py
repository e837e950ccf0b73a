"""Secret scans: patterns for known kinds, and a randomness test battery for the rest.

A null text counts as empty; it has no spans. Repeated rows are scanned each alike. An empty table gives an empty result.
Spans are in code points, end exclusive. Texts are taken whole. Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import let, materialise, small

#: In order of kind: name, pattern, group whose length is held against the minimum, minimum.
KINDS = (
    ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    # Of a run of these characters the first match reaches to the run's end, so a minimum inside the pattern drops the same matches as one after it.
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
)
RANDOM = "random"
NAMES = [*(k[0] for k in KINDS), RANDOM]
#: What the battery is applied to: runs of 20 and more characters with both a letter and a digit.
CANDIDATE, WITH = r"[A-Za-z0-9+/_=-]{20,}", r"^(?=.*[0-9])(?=.*[A-Za-z])"
#: Encodings in the order they are tried: pattern, alphabet.
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ENCODINGS = (
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+=*$", UPPER + "234567"),
    (r"^[0-9a-z]+$", DIGITS + LOWER),
    (r"^", UPPER + LOWER + DIGITS + "+/"),
)
#: False-discovery rate at which candidates are found not to be random; values are counted in steps of 0.01 in log10.
RATE, STEPS = 0.05, 100
MARK = "[secret]"
#: Characters of a text that redact() cuts at a time.
PART = 32_768


def pieces(text: Column, pattern: str, group: int) -> Column:
    """array<struct(b, m, g, x)> of the leftmost matches that don't overlap: the length of what lies before a match, of the match and of
    its group, and the match. What lies between matches comes from split(), the matches from regexp_extract_all().
    """
    whole, part = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    sizes = F.zip_with(F.zip_with(F.split(text, pattern, -1), whole, lambda b, m: F.struct(F.length(b).alias("b"), m.alias("x"))), part, lambda y, g: F.struct(y["b"].alias("b"), F.length(y["x"]).alias("m"), F.length(g).alias("g"), y["x"].alias("x")))
    return F.when(text.rlike(pattern), F.filter(sizes, lambda y: y["x"].isNotNull())).otherwise(F.array().cast("array<struct<b: int, m: int, g: int, x: string>>"))


def placed(found: DataFrame) -> DataFrame:
    """(id, kind, pieces) -> id, kind, start, end, g, x of every match: its place is a running sum within its text and kind."""
    each = found.select("id", "kind", F.posexplode("pieces").alias("i", "p"))
    end = F.sum(F.col("p.b") + F.col("p.m")).over(W.partitionBy("id", "kind").orderBy("i").rowsBetween(W.unboundedPreceding, W.currentRow))
    return each.select("id", "kind", (end - F.col("p.m")).cast("int").alias("start"), end.cast("int").alias("end"), "p.g", "p.x")


def untouched(found: DataFrame, base: DataFrame) -> DataFrame:
    """Of found (id, start, end, ...; a text's own don't overlap) the rows that no span of base touches.

    A text's spans are put in order together. One is touched if a base span that begins no later ends after its start, or
    the next one to begin does so before its end: two running values, not a comparison of all with all.
    """
    both = found.withColumn("own", F.lit(1)).unionByName(base.select("id", "start", "end").withColumn("own", F.lit(0)), allowMissingColumns=True)
    of_base = lambda c: F.when(F.col("own") == 0, F.col(c))
    before = F.max(of_base("end")).over(W.partitionBy("id").orderBy("start", "own").rowsBetween(W.unboundedPreceding, W.currentRow))
    after = F.min(of_base("start")).over(W.partitionBy("id").orderBy(F.col("start").desc(), F.col("own").desc()).rowsBetween(W.unboundedPreceding, W.currentRow))
    near = both.withColumn("before", before).withColumn("after", after).where("own = 1")
    return near.where("(before is null or before <= start) and (after is null or after >= end)").drop("own", "before", "after")


def _tail(z: Column) -> Column:
    """P(Z > z) of the standard normal for z >= 0, to 1e-7 (polynomial of Abramowitz and Stegun 26.2.17)."""
    t = 1 / (1 + 0.2316419 * z)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.greatest(F.exp(-z * z / 2) * 0.3989422804014327 * poly, F.lit(1e-300))


def battery(x: Column) -> Column:
    """p of a string under the hypothesis that its characters are drawn alike and independently from its encoding.

    Chi-squared (Wilson-Hilferty) for a uniform alphabet, Wald-Wolfowitz runs about the alphabet's middle, and serial
    correlation of neighbours; three times the least of their p-values, which holds however the tests depend on one another
    (runs and serial correlation do).
    """
    plain = F.translate(x, "-_=", "+/")
    alphabet = F.lit(ENCODINGS[-1][1])
    for pattern, letters in reversed(ENCODINGS[:-1]):
        alphabet = F.when(x.rlike(pattern), letters).otherwise(alphabet)

    def chi(s: Column, a: Column) -> Column:
        n, k = F.length(s).cast("double"), F.length(a).cast("double")
        squares = F.aggregate(F.split(a, ""), F.lit(0.0), lambda acc, c: acc + F.pow((F.length(s) - F.length(F.replace(s, c, F.lit("")))).cast("double"), F.lit(2.0)))
        free = k - 1
        z = (F.pow(F.greatest(k / n * squares - n, F.lit(0.0)) / free, F.lit(1 / 3)) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))
        return F.when(z >= 0, _tail(z)).otherwise(1 - _tail(-z))

    def orders(s: Column, a: Column) -> Column:
        half = F.length(a) / 2
        zero = F.struct(F.lit(-1.0).alias("prev"), F.lit(0.0).alias("n"), F.lit(0.0).alias("high"), F.lit(0.0).alias("runs"), F.lit(0.0).alias("s"), F.lit(0.0).alias("ss"), F.lit(0.0).alias("sp"))

        def step(t: Column, c: Column) -> Column:
            return let((F.instr(a, c) - 1).cast("double"), lambda v: F.struct(
                v.alias("prev"), (t["n"] + 1).alias("n"), (t["high"] + F.when(v >= half, 1.0).otherwise(0.0)).alias("high"),
                (t["runs"] + F.when((t["prev"] < 0) | ((v >= half) != (t["prev"] >= half)), 1.0).otherwise(0.0)).alias("runs"),
                (t["s"] + v).alias("s"), (t["ss"] + v * v).alias("ss"), (t["sp"] + F.when(t["prev"] < 0, 0.0).otherwise(v * t["prev"])).alias("sp"),
            ))

        def both(t: Column) -> Column:
            n, two = t["n"], 2 * t["high"] * (t["n"] - t["high"])
            spread = F.sqrt(F.greatest(two * (two - n) / (n * n * (n - 1)), F.lit(1e-9)))
            runs = F.abs(t["runs"] - (two / n + 1)) / spread
            mean = t["s"] / n
            serial = F.abs((t["sp"] / (n - 1) - mean * mean) / F.greatest(t["ss"] / n - mean * mean, F.lit(1e-9))) * F.sqrt(n)
            return F.struct((2 * _tail(F.least(runs, F.lit(35.0)))).alias("runs"), (2 * _tail(F.least(serial, F.lit(35.0)))).alias("serial"))

        return F.aggregate(F.filter(F.split(s, ""), lambda c: c != ""), zero, step, both)

    def least(e: Column) -> Column:
        o = orders(e["s"], e["a"])
        return let(o, lambda p: F.greatest(F.least(F.lit(1.0), 3 * F.least(chi(e["s"], e["a"]), p["runs"], p["serial"])), F.lit(1e-300)))

    return let(F.struct(plain.alias("s"), alphabet.alias("a")), least)


def _weight() -> Column:
    """Length-aware: the longer a string, the more its tests can tell, so the larger its share of the allowed rate."""
    return F.sqrt((F.col("end") - F.col("start")).cast("double"))


def not_random(candidates: DataFrame) -> tuple[float, int | None]:
    """Mean weight, and the largest step of log10(p / weight) at which candidates are found not to be random.

    Weighted Benjamini-Hochberg over the candidates of all documents: p-values are counted by step first, and the window
    that finds the last step at which count * RATE / all still covers it sees those counts alone.
    """
    one = candidates.agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(_weight()), 6).alias("w")).first()
    if not one["n"]:
        return 1.0, None
    steps = candidates.select(_step(one["w"]).alias("step")).groupBy("step").agg(F.count(F.lit(1)).alias("n"))
    steps = steps.withColumn("run", F.sum("n").over(W.orderBy("step").rowsBetween(W.unboundedPreceding, W.currentRow)))
    return one["w"], steps.where(F.pow(F.lit(10.0), F.col("step") / STEPS) <= F.col("run") * RATE / one["n"]).agg(F.max("step")).first()[0]


def _step(mean: float) -> Column:
    return F.ceil(F.log10(F.col("p") / (_weight() / mean)) * STEPS)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, base and spans: arrays of struct(start, kind, end) in order, kind an index of NAMES.

    The texts are read once; their matches are a table with a row each, small against the texts and in proportion to what a text
    has of them, on which places, overlaps and the false-discovery rate are worked out.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    of = [pieces(text, p, g).alias(f"k{i}") for i, (_, p, g, _) in enumerate([*KINDS, (RANDOM, CANDIDATE, 0, 20)])]
    rows = materialise(docs.select(F.monotonically_increasing_id().alias("id"), "doc_id", *of), "secrets-pieces")
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(f"k{i}").alias("pieces")) for i in range(len(NAMES))])
    found = placed(rows.select("id", F.explode(kinds).alias("k")).where("size(k.pieces) > 0").select("id", "k.kind", "k.pieces"))
    least = F.element_at(F.array(*[F.lit(k[3]) for k in KINDS], F.lit(0)), F.col("kind") + 1)
    apt = (F.col("g") >= least) & ((F.col("kind") < len(KINDS)) | F.col("x").rlike(WITH))
    found = materialise(found.where(apt), "secrets-found")
    base, strings = found.where(F.col("kind") < len(KINDS)).drop("g", "x"), found.where(F.col("kind") == len(KINDS)).drop("g")
    candidates = materialise(untouched(strings, base).select("id", "kind", "start", "end", battery(F.col("x")).alias("p")), "secrets-candidates")
    mean, last = not_random(candidates)
    random = candidates.where(F.lit(last is None) | (_step(mean) > F.lit(last if last is not None else 0)))
    span = F.struct("start", "kind", "end")
    every = base.unionByName(random.drop("p")).groupBy("id").agg(F.sort_array(F.collect_list(span)).alias("spans"))  # of one text
    none = F.array().cast("array<struct<start: int, kind: int, end: int>>")
    out = rows.select("id", "doc_id").join(every, "id", "left").select("doc_id", F.coalesce("spans", none).alias("spans"))
    return out.select("doc_id", F.filter("spans", lambda s: s["kind"] < len(KINDS)).alias("base"), "spans")


def _listed(array: Column) -> Column:
    names = F.array(*map(F.lit, NAMES))
    return F.array_join(F.transform(array, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    count = lambda i: F.size(F.filter("base", lambda s: s["kind"] == i)).cast("long").alias(f"n_{NAMES[i]}")
    return found.select("doc_id", *[count(i) for i in range(len(KINDS))], F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"))


def gaps(found: DataFrame) -> DataFrame:
    """(_id, _hash, start, end) of spans -> _id, _hash, _gaps: what a text's spans leave before and between them, and where the last ends.

    A span is apart from those before it if it begins after all of them have ended.
    """
    reach = F.max("end").over(W.partitionBy("_id", "_hash").orderBy("start", "end").rowsBetween(W.unboundedPreceding, -1))
    rows = found.withColumn("from", reach)
    apart = F.when(F.col("from").isNull() | (F.col("from") < F.col("start")), F.struct(F.coalesce("from", F.lit(0)).alias("start"), F.col("start").alias("end")))
    return rows.groupBy("_id", "_hash").agg(F.sort_array(F.collect_list(apart)).alias("_gaps"), F.max("end").alias("_last"))


def _piece(parts: Column, start: Column, end: Column) -> Column:
    """Characters start to end of a text that is given in parts of PART: a place far into it is found without counting from its beginning."""
    first, last = F.floor(start / PART).cast("int"), F.floor((end - 1) / PART).cast("int")
    of = lambda i: F.substring(F.get(parts, i), (F.greatest(start - i * PART, F.lit(0)) + 1).cast("int"), (F.least(end, (i + 1) * PART) - F.greatest(start, i * PART)).cast("int"))
    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), of), "")).otherwise("")


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span of text replaced by MARK (spans that touch or overlap by one), and n_chars, if there, renewed.

    Rows without spans stay as they are. Rows that share a doc_id are redacted by the spans of each one's own text.
    """
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("hash")).alias("doc_id"), "text")
    spans = scan(keyed).where("size(spans) > 0").groupBy("doc_id").agg(F.first("spans").alias("spans"))
    each = spans.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.hash").alias("_hash"), F.explode("spans").alias("s")).select("_id", "_hash", "s.start", "s.end")
    of_text = small(materialise(gaps(each), "secrets-gaps"))
    joined = docs.select("doc_id", "text", F.xxhash64("text").alias("_key"), F.struct("*").alias("doc")).join(of_text, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_key") == F.col("_hash")), "left")
    parts = F.transform(F.sequence(F.lit(0), F.floor(F.length("text") / PART).cast("int")), lambda i: F.substring(F.col("text"), i * PART + 1, F.lit(PART)))
    left = F.concat(F.col("_gaps"), F.array(F.struct(F.col("_last").alias("start"), F.length("text").alias("end"))))
    cut = let(parts, lambda p: F.array_join(F.transform(left, lambda s: _piece(p, s["start"], s["end"])), MARK))
    clean = F.when(F.col("_gaps").isNull(), F.col("text")).otherwise(cut)
    new = {"text": clean}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("_gaps").isNull(), F.col("doc.n_chars")).otherwise(F.length(clean)).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(c, F.col("doc").getField(c)).alias(c) for c in docs.columns])


def _oracle() -> str:
    """The same scan in SQL: places by running sums over pieces and matches, the battery over unnested characters."""
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    found = " UNION ALL ".join(
        f"SELECT r, {i} AS kind, unnest(list_transform(string_split_regex(text, {quote(p)})[:len(regexp_extract_all(text, {quote(p)}))], lambda x: length(x))) AS b, unnest(list_transform(regexp_extract_all(text, {quote(p)}), lambda x: length(x))) AS m, "
        f"unnest(list_transform(regexp_extract_all(text, {quote(p)}, {g}), lambda x: length(x))) AS g, {least} AS least, unnest(range(1, len(regexp_extract_all(text, {quote(p)})) + 1)) AS i FROM d WHERE regexp_matches(text, {quote(p)})"
        for i, (_, p, g, least) in enumerate([*KINDS, (RANDOM, CANDIDATE, 0, 20)])
    )
    alphabet = "CASE " + " ".join(f"WHEN regexp_matches(x, '{p}') THEN '{a}'" for p, a in ENCODINGS[:-1]) + f" ELSE '{ENCODINGS[-1][1]}' END"

    def tail(z: str) -> str:
        t = f"(1 / (1 + 0.2316419 * {z}))"
        poly = f"({t} * (0.319381530 + {t} * (-0.356563782 + {t} * (1.781477937 + {t} * (-1.821255978 + {t} * 1.330274429)))))"
        return f"greatest(exp(-{z} * {z} / 2) * 0.3989422804014327 * {poly}, 1e-300)"

    names = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
    listed = f"string_agg({names}[kind + 1] || ':' || CAST(a AS VARCHAR) || ':' || CAST(e AS VARCHAR), ',' ORDER BY a, kind, e)"
    counts = ", ".join(f"CAST(count(*) FILTER (kind = {i}) AS BIGINT) AS n_{n}" for i, (n, *_) in enumerate(KINDS))
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents), f AS ({found}),
s AS (SELECT r, kind, e - m AS a, e, g, least FROM (SELECT *, CAST(sum(b + m) OVER (PARTITION BY r, kind ORDER BY i) AS BIGINT) AS e FROM f)),
b AS (SELECT r, kind, a, e FROM s WHERE kind < {len(KINDS)} AND g >= least),
c AS (SELECT row_number() OVER () AS id, s.r, s.a, s.e, substr(d.text, s.a + 1, s.e - s.a) AS x FROM s JOIN d USING (r) WHERE kind = {len(KINDS)}),
t AS (SELECT id, r, a, e, translate(x, '-_=', '+/') AS plain, {alphabet} AS abc FROM c WHERE regexp_matches(x, '[0-9]') AND regexp_matches(x, '[A-Za-z]') AND NOT EXISTS (SELECT 1 FROM b WHERE b.r = c.r AND b.a < c.e AND c.a < b.e)),
u AS (SELECT id, abc, unnest(list_filter(string_split(plain, ''), lambda y: y <> '')) AS y, unnest(range(1, len(list_filter(string_split(plain, ''), lambda y: y <> '')) + 1)) AS i FROM t),
v AS (SELECT id, y, CAST(length(abc) AS DOUBLE) AS k, CAST(strpos(abc, y) - 1 AS DOUBLE) AS v, lag(CAST(strpos(abc, y) - 1 AS DOUBLE)) OVER (PARTITION BY id ORDER BY i) AS l, length(abc) / 2.0 AS half FROM u),
q AS (SELECT id, sum(n * n) AS squares FROM (SELECT id, y, CAST(count(*) AS DOUBLE) AS n FROM v GROUP BY 1, 2) GROUP BY 1),
o AS (SELECT id, any_value(k) AS k, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (v >= half) AS DOUBLE) AS high, CAST(count(*) FILTER (l IS NULL OR (v >= half) <> (l >= half)) AS DOUBLE) AS runs, sum(v) AS s, sum(v * v) AS ss, coalesce(sum(v * l), 0) AS sp FROM v GROUP BY id),
z AS (SELECT id, (pow(greatest(k / n * squares - n, 0) / (k - 1), 1 / 3.0) - (1 - 2 / (9 * (k - 1)))) / sqrt(2 / (9 * (k - 1))) AS zc, 2 * high * (n - high) AS two, n, runs, s / n AS mean, ss, sp FROM o JOIN q USING (id)),
y AS (SELECT id, zc, least(abs(runs - (two / n + 1)) / sqrt(greatest(two * (two - n) / (n * n * (n - 1)), 1e-9)), 35.0) AS zr, least(abs((sp / (n - 1) - mean * mean) / greatest(ss / n - mean * mean, 1e-9)) * sqrt(n), 35.0) AS zs FROM z),
p AS (SELECT id, greatest(least(1.0, 3 * least(CASE WHEN zc >= 0 THEN {tail("zc")} ELSE 1 - {tail("(-zc)")} END, 2 * {tail("zr")}, 2 * {tail("zs")})), 1e-300) AS p FROM y),
w AS (SELECT round(avg(sqrt(e - a)), 6) AS mean, count(*) AS n FROM t),
h AS (SELECT t.r, t.a, t.e, ceil(log10(p.p / (sqrt(t.e - t.a) / w.mean)) * {STEPS}) AS step FROM t JOIN p USING (id), w),
j AS (SELECT step, sum(count(*)) OVER (ORDER BY step) AS run FROM h GROUP BY step),
x AS (SELECT max(step) AS last FROM j, w WHERE pow(10.0, step / {STEPS}) <= run * {RATE} / w.n),
a AS (SELECT r, kind, a, e FROM b UNION ALL SELECT r, {len(KINDS)}, a, e FROM h, x WHERE last IS NULL OR step > last),
k AS (SELECT r, {counts}, {listed} AS base FROM b GROUP BY r), l AS (SELECT r, {listed} AS spans FROM a GROUP BY r)
SELECT doc_id, {", ".join(f"coalesce(n_{n}, 0) AS n_{n}" for n, *_ in KINDS)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN k USING (r) LEFT JOIN l USING (r)
"""


ORACLE = _oracle()

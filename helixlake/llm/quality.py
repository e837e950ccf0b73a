"""Quality rules: per-document statistics and robust multivariate outliers.

Null and empty texts have no words: all statistics are 0, base_failed is true and kept false. Null languages and
sources are groups of their own. Repeated rows are judged each alike, and an empty table gives an empty result.
Only the columns named are read, so further columns of the input don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, let, materialise, small

MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
#: The coordinates of a document's vector, and the standard deviation that is added to each one's own (as variances are):
#: what is constant among good documents (no symbols, no equal lines) would otherwise make any other value infinitely far.
VECTOR = {
    "x1": ("ln(n_words)", 0.6),
    "x2": ("ln(word_chars / n_words)", 0.06),
    "x3": ("ln(1 + 100 * n_symbols / n_words)", 0.4),
    "x4": ("ln(1 + n_dup_lines)", 0.35),
    "x5": ("ln(1 + 100 * n_repeat_words / n_words)", 0.7),
}
DIMS = list(VECTOR)
#: Share of a group's documents that the estimate rests on, and the factor that makes their covariance that of all
#: for normal data: 0.75 / P(chi2_7 < 6.626), 6.626 being the 0.75 quantile of chi2_5.
SUBSET, CONSISTENCY = 0.75, 1.41
STEPS, MIN_GROUP = 4, 40
#: Squared Mahalanobis distance beyond which a document is rejected: chi2_5 is larger with probability 1.4e-9. A filter
#: should keep clean documents, and the coordinates are not normal, so it is far beyond any usual quantile: symbols and word
#: lengths decide; repetition alone, below the share at which the base rules reject, comes to at most 32.
CUTOFF = 50.0


def _repeat_words(words: Column) -> Column:
    """Words that lie in 3-word windows found twice or more. Windows are told apart by 64-bit hashes."""

    def covered(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        hashes = F.transform(starts, lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))
        return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(marked(h)))

    def marked(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
        return let(pairs, lambda s: length(F.sort_array(F.filter(F.transform(s, lambda x, i: twin(s, x, i)), lambda p: p.isNotNull()))))

    def twin(s: Column, x: Column, i: Column) -> Column:
        same = F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))
        return F.when(same, x["p"])

    def length(starts: Column) -> Column:
        none = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
        return F.aggregate(starts, none, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"])

    return F.when(F.size(words) < 4, F.lit(0)).otherwise(covered(words))


def _dup_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    of_words = let(words, lambda w: F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("c"), _repeat_words(w).alias("r")))
    symbols = F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]", ""))
    one = F.array(F.struct(of_words.alias("w"), symbols.alias("s"), _dup_lines(text).alias("d")))
    rows = docs.select("doc_id", "lang", "source", F.explode(one).alias("m"))
    long = lambda c: F.col(c).cast("long")
    rows = rows.select("doc_id", "lang", "source", long("m.w.n").alias("n_words"), long("m.w.c").alias("word_chars"), long("m.s").alias("n_symbols"), long("m.d").alias("n_dup_lines"), long("m.w.r").alias("n_repeat_words"))
    return rows.withColumn("base_failed", F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"))


def _null_safe(rows: DataFrame, more: DataFrame, keys: list[str]) -> DataFrame:
    more = more.select(*[F.col(k).alias(f"_{k}") if k in keys else F.col(k) for k in more.columns])
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    on = same[0]
    for x in same[1:]:
        on = on & x
    return rows.join(more, on, "left").drop(*[f"_{k}" for k in keys])


def _quantile(rows: DataFrame, keys: list[str], value: str, share: float, grain: int = 128) -> DataFrame:
    """keys, value: the least multiple of 1/grain that at least `share` of a group's values don't exceed.

    Values are counted by multiple first; only those counts (a few thousand a group, however many rows) are sorted.
    """
    counts = rows.groupBy(*keys, F.ceil(F.col(value) * grain).alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    w = W.partitionBy(*keys)
    run = F.sum("_n").over(w.orderBy("_bin").rowsBetween(W.unboundedPreceding, W.currentRow))
    counts = counts.withColumn("_run", run).withColumn("_all", F.sum("_n").over(w)).where(F.col("_run") >= F.col("_all") * share)
    return counts.groupBy(*keys).agg((F.min("_bin") / grain).alias(value))


def _start(rows: DataFrame) -> DataFrame:
    """Coordinate-wise medians and scales (median absolute deviations) of each group: where the steps begin."""
    long = rows.select("group_lang", "group_source", F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("v")) for d in DIMS])).alias("e")).select("group_lang", "group_source", "e.*")
    keys = ["group_lang", "group_source", "dim"]
    middle = small(materialise(_quantile(long, keys, "v", 0.5).withColumnRenamed("v", "mid"), "mcd-mid"))
    away = _null_safe(long, middle, keys).withColumn("v", F.abs(F.col("v") - F.col("mid")))
    scale = _quantile(away, keys, "v", 0.5).withColumnRenamed("v", "mad")
    both = _null_safe(middle, scale, keys).groupBy("group_lang", "group_source")
    pick = lambda c, d: F.max(F.when(F.col("dim") == d, F.col(c)))
    return both.agg(*[pick("mid", d).alias(f"m_{d}") for d in DIMS], *[(pick("mad", d) * 1.4826).alias(f"s_{d}") for d in DIMS])


def _factor(estimates: DataFrame) -> DataFrame:
    """Lower Cholesky factor l_i_j of the covariance c_i_j of each row, the square of its floor added to each variance."""
    out = estimates
    for i, d in enumerate(DIMS):
        for j in range(i + 1):
            rest = F.col(f"c_{i}_{j}") + (F.lit(VECTOR[d][1] ** 2) if i == j else F.lit(0.0))
            for k in range(j):
                rest = rest - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            out = out.withColumn(f"l_{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l_{j}_{j}"))
    return out.select("group_lang", "group_source", *[f"m_{d}" for d in DIMS], *[f"l_{i}_{j}" for i in range(len(DIMS)) for j in range(i + 1)])


def _distance(rows: DataFrame, factor: DataFrame) -> DataFrame:
    """rows + distance: the squared Mahalanobis distance, by forward substitution in the factor of the row's group."""
    keep = rows.columns
    out = _null_safe(rows, factor, ["group_lang", "group_source"])
    total = F.lit(0.0)
    for i, d in enumerate(DIMS):
        rest = F.col(d) - F.col(f"m_{d}")
        for k in range(i):
            rest = rest - F.col(f"l_{i}_{k}") * F.col(f"y_{k}")
        out = out.withColumn(f"y_{i}", rest / F.col(f"l_{i}_{i}"))
        total = total + F.col(f"y_{i}") * F.col(f"y_{i}")
    return out.select(*keep, total.alias("distance"))


def _moments(rows: DataFrame) -> DataFrame:
    """Mean and covariance of each group, rounded so that the order of summation can't show."""
    sums = [F.avg(F.col(a) * F.col(b)).alias(f"q_{i}_{j}") for i, a in enumerate(DIMS) for j, b in enumerate(DIMS[: i + 1])]
    out = rows.groupBy("group_lang", "group_source").agg(*[F.avg(d).alias(f"m_{d}") for d in DIMS], *sums)
    cov = {f"c_{i}_{j}": F.round((F.col(f"q_{i}_{j}") - F.col(f"m_{a}") * F.col(f"m_{b}")) * CONSISTENCY, 6) for i, a in enumerate(DIMS) for j, b in enumerate(DIMS[: i + 1])}
    return out.withColumns(cov).select("group_lang", "group_source", *[F.round(f"m_{d}", 6).alias(f"m_{d}") for d in DIMS], *cov)


def estimate(rows: DataFrame, steps: int = STEPS) -> DataFrame:
    """The factor of each group's minimum-covariance-determinant estimate.

    Concentration steps: from medians and scales, take the SUBSET of a group's documents that are nearest under the
    current estimate, and estimate anew from these; no step makes the determinant larger. A step is one pass over the
    vectors, with sums by group; nothing but one row per group leaves the executors' partial sums.
    """
    start = _start(rows)
    zero = {f"c_{i}_{j}": (F.col(f"s_{d}") * F.col(f"s_{d}") if i == j else F.lit(0.0)) for i, d in enumerate(DIMS) for j in range(i + 1)}
    now = small(materialise(_factor(start.withColumns(zero)), "mcd"))
    keys = ["group_lang", "group_source"]
    for _ in range(steps):
        near = _distance(rows, now).withColumn("log", F.log1p("distance"))
        limit = small(materialise(_quantile(near, keys, "log", SUBSET).withColumnRenamed("log", "limit"), "mcd-limit"))
        subset = _null_safe(near, limit, keys).where("log <= limit")
        now = small(materialise(_factor(_moments(subset)), "mcd"))
    return now


def quality_rules(docs: DataFrame, cutoff: float = CUTOFF, min_group: int = MIN_GROUP) -> DataFrame:
    """The statistics of every document, distance (null if base_failed) and kept.

    Estimates rest on all documents that pass the base rules, by language and source; sources with fewer than
    min_group such documents of a language are pooled within the language.
    """
    stats = materialise(statistics(docs), "quality")
    sound = stats.where("not base_failed").select("doc_id", "lang", "source", *[F.expr(e).alias(d) for d, (e, _) in VECTOR.items()])
    sizes = stats.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_group"))
    sizes = small(materialise(sizes, "quality-groups"))
    pooled = F.col("n_group") < min_group
    grouped = lambda rows: _null_safe(rows, sizes, ["lang", "source"]).withColumns({"group_lang": F.to_json(F.struct("lang")), "group_source": F.when(pooled, F.lit("pooled")).otherwise(F.to_json(F.struct("source")))}).drop("n_group")
    factor = estimate(grouped(sound))
    vectors = {d: F.when(~F.col("base_failed"), F.expr(e)) for d, (e, _) in VECTOR.items()}
    judged = _distance(grouped(stats.withColumns(vectors)), factor)
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= cutoff, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "distance", "lang", "source")


def keep_documents(docs: DataFrame, **parameters) -> DataFrame:
    """The documents that the rules keep, with the columns they had. Repeated rows of a doc_id stay if all are kept."""
    gone = quality_rules(docs, **parameters).groupBy("doc_id").agg(F.min("kept").alias("_kept")).where("not _kept").select(F.col("doc_id").alias("_id"))
    rows = docs.select("doc_id", F.struct("*").alias("doc"))  # apart from the columns joined, whatever docs' are called
    return rows.join(small(materialise(gone, "quality-gone")), F.col("doc_id").eqNullSafe(F.col("_id")), "left_anti").select("doc.*")


def _oracle() -> str:
    """The same steps in SQL. The k-th smallest of a group's rounded values is their quantile."""
    n = len(DIMS)
    word, space = "'[^\\x20\\x09-\\x0D]+'", "'[^\\x20\\x09-\\x0D]'"
    at = lambda v, share: f"list_sort(list(ceil({v} * 128)))[CAST(ceil(count(*) * {share}) AS BIGINT)] / 128"

    def factor(source: str) -> str:
        cells = []
        for i, d in enumerate(DIMS):
            for j in range(i + 1):
                rest = f"(c_{i}_{j}" + (f" + {VECTOR[d][1] ** 2!r}" if i == j else "") + "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j)) + ")"
                cells.append(f"sqrt({rest}) AS l_{i}_{j}" if i == j else f"{rest} / l_{j}_{j} AS l_{i}_{j}")
        return f"SELECT g, {', '.join(f'm_{d}' for d in DIMS)}, {', '.join(cells)} FROM {source}"

    def distance(source: str, f: str) -> str:
        ys = [f"({d} - m_{d}" + "".join(f" - l_{i}_{k} * y_{k}" for k in range(i)) + f") / l_{i}_{i} AS y_{i}" for i, d in enumerate(DIMS)]
        return f"SELECT v.*, {', '.join(ys)}, {' + '.join(f'y_{i} * y_{i}' for i in range(n))} AS distance FROM {source} v JOIN {f} USING (g)"

    q = [f"avg({a} * {b}) AS q_{i}_{j}" for i, a in enumerate(DIMS) for j, b in enumerate(DIMS[: i + 1])]
    cov = [f"round((q_{i}_{j} - a_{a} * a_{b}) * {CONSISTENCY}, 6) AS c_{i}_{j}" for i, a in enumerate(DIMS) for j, b in enumerate(DIMS[: i + 1])]
    zero = [f"s_{d} * s_{d} AS c_{i}_{i}" if i == j else f"0.0 AS c_{i}_{j}" for i, d in enumerate(DIMS) for j in range(i + 1)]
    steps = []
    for k in range(STEPS):
        steps.append(f"""d{k} AS ({distance("v", f"f{k}")}), t{k} AS (SELECT g, {at("ln(1 + distance)", SUBSET)} AS cut FROM d{k} GROUP BY g),
a{k} AS (SELECT g, {", ".join(f"avg({d}) AS a_{d}" for d in DIMS)}, {", ".join(q)} FROM d{k} JOIN t{k} USING (g) WHERE ln(1 + distance) <= cut GROUP BY g),
c{k} AS (SELECT g, {", ".join(f"round(a_{d}, 6) AS m_{d}" for d in DIMS)}, {", ".join(cov)} FROM a{k}), f{k + 1} AS ({factor(f"c{k}")})""")
    return f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {word}) AS w FROM documents),
x AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
y AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS n FROM x) WHERE n > 1),
z AS (SELECT r, count(DISTINCT i + o) AS n FROM y, (VALUES (0), (1), (2)) t(o) GROUP BY r),
l AS (SELECT r, list_filter(string_split(text, chr(10)), lambda s: regexp_matches(s, {space})) AS l FROM w),
s AS (SELECT r, doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(z.n, 0) AS BIGINT) AS n_repeat_words FROM w JOIN l USING (r) LEFT JOIN z USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM s),
v AS (SELECT r, coalesce('L' || lang, 'N') || CASE WHEN count(*) OVER (PARTITION BY lang, source) < {MIN_GROUP} THEN '|P' ELSE coalesce('|S' || source, '|N') END AS g, {", ".join(f"{e} AS {d}" for d, (e, _) in VECTOR.items())} FROM b WHERE NOT base_failed),
m AS (SELECT g, {", ".join(f"{at(d, 0.5)} AS m_{d}" for d in DIMS)} FROM v GROUP BY g),
e AS (SELECT g, {", ".join(f"any_value(m_{d}) AS m_{d}, {at(f'abs({d} - m_{d})', 0.5)} * 1.4826 AS s_{d}" for d in DIMS)} FROM v JOIN m USING (g) GROUP BY g),
o AS (SELECT g, {", ".join(f"m_{d}" for d in DIMS)}, {", ".join(zero)} FROM e), f0 AS ({factor("o")}),
{", ".join(steps)},
j AS ({distance("v", f"f{STEPS}")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(distance <= {CUTOFF}, true) AS kept FROM b LEFT JOIN j USING (r)
"""


ORACLE = _oracle()

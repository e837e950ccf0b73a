"""URL filters: host and path rules, and for the rest a character language-model ratio.

A null url, or one without "://", has an empty host and path, fits no rule and scores 0. Repeated rows are counted as
often as they come and each get the verdict. Without examples of both kinds every url is allowed. An empty table gives
an empty result. Ties of the threshold go to the smallest step. Urls of any length are taken whole, with work in proportion to
it. Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, ascii_lower, is_small, let, materialise

#: host, path, verdict; the longest that fits decides.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))
#: Longest context in characters, weight of the next shorter context, and probability of a character without context.
ORDER, SMOOTHING, UNIFORM = 4, 2.0, 1 / 256
#: Log-likelihoods are summed as whole millionths, so that a sum doesn't depend on its order; scores are compared in steps of 0.01.
MICRO, STEP = 1_000_000, 10_000
PAD, SALTS = "\x02", 16
#: Characters of a url that grams are cut from at a time.
PART = 1_024
#: A url is held out of training, for the threshold, if the digest of its host and path begins with a character below this: a quarter.
HELD_OUT = "4"


def host_path(url: Column) -> tuple[Column, Column]:
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substring(url, found + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules=RULES) -> Column:
    """struct(rule, verdict) of the longest rule that fits, else null."""
    out = F.lit(None).cast("struct<rule: string, verdict: string>")
    for h, p, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def _grams(text: Column) -> Column:
    """Each character of text after its ORDER predecessors. Long texts are cut up first, as each place is counted from the beginning."""
    padded = F.concat(F.lit(PAD * ORDER), text)
    inner = lambda part: F.transform(F.sequence(F.lit(1), F.greatest(F.length(part) - ORDER, F.lit(1))), lambda i: F.substring(part, i, F.lit(ORDER + 1)))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.length(text) - 1) / PART).cast("int")), lambda i: let(F.substring(padded, i * PART + 1, F.lit(PART + ORDER)), inner))
    return F.when(F.length(text) > 0, F.flatten(parts)).otherwise(F.array().cast("array<string>"))


def train(urls: DataFrame) -> DataFrame:
    """(text, n, label) -> gram, ratio: millionths of ln p(character | accepted) - ln p(character | rejected).

    Two variable-order Markov models, one per label, each interpolating contexts of 0 to ORDER characters: a context's
    estimate counts as SMOOTHING observations of the next longer one's. Occurrences are counted by distinct gram before
    they are shuffled; from there on the work is on distinct grams, of which character texts have few.
    """
    of = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    grams = urls.select("label", "n", F.explode(_grams(F.col("text"))).alias("gram")).groupBy("gram").agg(of("allow").alias("a"), of("block").alias("r"))
    grams = materialise(grams, "url-grams")
    total = grams.agg(F.sum("a").alias("a"), F.sum("r").alias("r")).first()
    part = lambda k, length: F.substring("gram", ORDER + 1 - k, length)
    # "s": the character after its k predecessors, "c": those predecessors alone. Summed by key before the shuffle, so
    # that a frequent character is a few partial sums, and joined back.
    keys = [F.struct(F.lit(f"s{k}").alias("kind"), part(k, k + 1).alias("key")) for k in range(ORDER + 1)] + [F.struct(F.lit(f"c{k}").alias("kind"), part(k, k).alias("key")) for k in range(1, ORDER + 1)]
    sums = grams.select("a", "r", F.explode(F.array(*keys)).alias("k")).groupBy("k.kind", "k.key").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
    sums = materialise(sums, "url-contexts")
    for k in range(ORDER + 1):
        for kind, length in (("s", k + 1), ("c", k))[: 2 if k else 1]:
            name = f"{kind}{k}"
            of_kind = sums.where(F.col("kind") == name).select(F.col("key").alias(name), *[F.col(side).alias(f"{kind}_{side}{k}") for side in "ar"])
            grams = grams.withColumn(name, part(k, length)).join(F.broadcast(of_kind) if is_small(of_kind) else of_kind, name)
    for side in "ar":
        p = F.lit(UNIFORM)
        for k in range(ORDER + 1):
            context = F.col(f"c_{side}{k}") if k else F.lit(total[side] or 0)
            p = (F.col(f"s_{side}{k}") + SMOOTHING * p) / (context + SMOOTHING)
        grams = grams.withColumn(f"p_{side}", p)
    return grams.select("gram", F.round((F.log("p_a") - F.log("p_r")) * MICRO).cast("long").alias("ratio"))


def _spread(rows: DataFrame) -> DataFrame:
    """A written table over at least as many tasks as there are cores: a short one of long work may lie in one file."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if len(rows.inputFiles()) < cores else rows


def _look_up(rows: DataFrame, model: DataFrame, key: Column, limit: int = BROADCAST_ROWS) -> DataFrame:
    """rows joined to model on gram: broadcast if model is small, else salted, since a few grams are in every url."""
    if is_small(model, limit):
        return rows.join(F.broadcast(model), "gram")
    salted = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")).join(salted, ["gram", "salt"]).drop("salt")


def threshold(scores: DataFrame) -> int | None:
    """(step, label, n) -> the least step from which urls are allowed, null without urls of both labels.

    Calibrated on labelled urls: the step at which the share of accepted at or above it plus the share of rejected
    below it is largest. The window sees one row per step of 0.01.
    """
    of = lambda label: F.sum(F.when(F.col("label") == label, F.col("n")).otherwise(0))
    steps = scores.where("label is not null").groupBy("step").agg(of("allow").alias("a"), of("block").alias("r"))
    below, whole = W.orderBy("step").rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    lost, caught = F.coalesce(F.sum("a").over(below), F.lit(0)), F.coalesce(F.sum("r").over(below), F.lit(0))
    steps = steps.select("step", (caught * F.sum("a").over(whole) - lost * F.sum("r").over(whole)).alias("gain"), F.sum("a").over(whole).alias("a"), F.sum("r").over(whole).alias("r"))
    best = steps.where("a > 0 and r > 0").orderBy(F.col("gain").desc(), "step").first()
    return None if best is None else best["step"]


def filter_urls(pages: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict, and score: the mean log-likelihood ratio a character, in steps of 0.01."""
    pages = pages.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("n"))
    host, path = host_path(F.col("url"))
    pages = pages.select("page_id", "url", "n", host.alias("host"), path.alias("path")).withColumn("fit", fitting_rule(F.col("host"), F.col("path")))
    text = F.concat("host", "path")
    held = F.substring(F.md5(text), 1, 1) < HELD_OUT
    urls = pages.select(F.monotonically_increasing_id().alias("id"), "page_id", "n", "host", "path", "fit.rule", F.col("fit.verdict").alias("label"), text.alias("text"), held.alias("held"))
    urls = _spread(materialise(urls, "urls"))
    model = materialise(train(urls.withColumn("label", F.when(~F.col("held"), F.col("label")))), "url-model")
    # A character's row is an id and a gram: what else a url has would be copied as often as it is long.
    grams = urls.where("length(text) > 0").select("id", F.explode(_grams(F.col("text"))).alias("gram"))
    sums = _look_up(grams, model, F.col("id")).groupBy("id").agg(F.sum("ratio").alias("sum"))
    step = F.when(F.length("text") > 0, F.floor(F.col("sum") / F.length("text") / STEP)).otherwise(0).cast("long")
    scored = materialise(urls.join(sums, "id", "left").select("page_id", "n", "host", "path", "rule", "label", "held", step.alias("step")), "url-scores")
    least = threshold(scored.where("held"))
    if least is None:  # too few urls to hold any out
        least = threshold(scored)
    method = F.lit("allow") if least is None else F.when(F.col("step") >= least, "allow").otherwise("block")
    out = scored.select("page_id", "host", "path", "rule", F.coalesce("label", method).alias("verdict"), (F.col("step") / 100).alias("score"), F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("copy"))
    return out.drop("copy")


def _oracle() -> str:
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(RULES, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest) + " END"
    label = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest) + " END"
    counts, p = [], {}
    for side in "ar":
        p[side] = repr(UNIFORM)
        for k in range(ORDER + 1):
            counts.append(f"sum({side}) OVER (PARTITION BY substr(gram, {ORDER + 1 - k}, {k + 1})) AS n_{side}{k}")
            counts.append(f"sum({side}) OVER (PARTITION BY substr(gram, {ORDER + 1 - k}, {k})) AS c_{side}{k}")
            p[side] = f"((n_{side}{k} + {SMOOTHING} * {p[side]}) / (c_{side}{k} + {SMOOTHING}))"
    return rf"""
WITH h AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
u AS (SELECT row_number() OVER () AS id, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM h),
l AS (SELECT *, host || path AS t, {rule} AS rule, {label} AS label, substr(md5(host || path), 1, 1) < '{HELD_OUT}' AS held FROM u),
o AS (SELECT id, t, CASE WHEN NOT held THEN label END AS label, substr(repeat(chr(2), {ORDER}) || t, CAST(unnest(range(1, length(t) + 1)) AS BIGINT), {ORDER + 1}) AS gram FROM l),
g AS (SELECT gram, CAST(count(*) FILTER (label = 'allow') AS DOUBLE) AS a, CAST(count(*) FILTER (label = 'block') AS DOUBLE) AS r FROM o GROUP BY gram),
c AS (SELECT gram, {", ".join(counts)} FROM g),
m AS (SELECT gram, CAST(round((ln({p["a"]}) - ln({p["r"]})) * {MICRO}) AS BIGINT) AS ratio FROM c),
s AS (SELECT id, CAST(floor(CAST(sum(ratio) AS DOUBLE) / length(t) / {STEP}) AS BIGINT) AS step FROM o JOIN m USING (gram) GROUP BY id, t),
v AS (SELECT l.*, coalesce(s.step, 0) AS step FROM l LEFT JOIN s USING (id)),
b AS (SELECT part, step, CAST(count(*) FILTER (label = 'allow') AS DOUBLE) AS a, CAST(count(*) FILTER (label = 'block') AS DOUBLE) AS r
      FROM (SELECT 'held' AS part, step, label FROM v WHERE held UNION ALL SELECT 'all', step, label FROM v) WHERE label IS NOT NULL GROUP BY part, step),
w AS (SELECT part, step, coalesce(sum(r) OVER below, 0) * sum(a) OVER whole - coalesce(sum(a) OVER below, 0) * sum(r) OVER whole AS gain, sum(a) OVER whole AS a, sum(r) OVER whole AS r
      FROM b WINDOW whole AS (PARTITION BY part), below AS (PARTITION BY part ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
k AS (SELECT (SELECT step FROM w WHERE a > 0 AND r > 0 ORDER BY part DESC, gain DESC, step LIMIT 1) AS least)
SELECT page_id, host, path, rule, coalesce(label, CASE WHEN least IS NULL OR step >= least THEN 'allow' ELSE 'block' END) AS verdict FROM v, k
"""


ORACLE = _oracle()

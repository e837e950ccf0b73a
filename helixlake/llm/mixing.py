"""Mixing sources to target weights by capped water-filling.

Null or word-less texts have size 0 and are taken 0 words; a null source is a source of its own, last in
order; repeated rows are separate documents; an empty table gives an empty result. Only the columns named
are read, so further columns of the input (whatever their names) don't matter.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, materialise, small

#: Hex digits of a document's seeded digest that make a bucket, at each of two levels.
DIGITS = 3


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _big(col: Column) -> Column:
    return col.cast("decimal(19,0)")


def water_fill(sources: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, share_percent: int = 100) -> DataFrame:
    """(source, source_size) -> + target double, whole long, part long.

    Sources by code point, null last, get the weights in turn. A source that its share of the budget would
    repeat more than max_epochs times is clamped there; what it can't take goes to the others by weight. The
    clamped ones are a prefix of the sources in order of size per weight, so one pass over that order finds them.
    part: words to take beyond `whole` repetitions. The windows see one row per source, not per document.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    everything = W.partitionBy()
    s = sources.withColumn("weight", turn.cast("long")).withColumn("cap", F.col("source_size") * max_epochs)
    s = s.withColumn("budget", F.expr(f"cast(cast(sum(source_size) over () as decimal(19,0)) * {int(share_percent)} div 100 as bigint)"))
    per_weight = W.orderBy(_big(F.col("source_size")) * (F.lit(lcm(*weights)) / F.col("weight")).cast("long"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("cap").over(per_weight.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(per_weight.rowsBetween(W.currentRow, W.unboundedFollowing))
    s = s.withColumn("clamped", _big(F.col("budget") - before) * _big(F.col("weight")) > _big(F.col("cap")) * _big(rest))
    s = s.withColumn("left", F.col("budget") - F.sum(F.when(F.col("clamped"), F.col("cap")).otherwise(0)).over(everything))
    s = s.withColumn("free", F.sum(F.when(F.col("clamped"), 0).otherwise(F.col("weight"))).over(everything))
    open_words = F.expr("cast(left as decimal(19,0)) * cast(weight as decimal(19,0)) div cast(free as decimal(19,0))")
    s = s.withColumn("words", F.when(F.col("clamped"), F.col("cap")).otherwise(open_words))
    target = F.when(F.col("clamped"), F.col("cap").cast("double")).otherwise((F.col("left") * F.col("weight")).cast("double") / F.col("free").cast("double"))
    whole = F.when(F.col("source_size") > 0, F.expr("words div source_size")).otherwise(F.lit(0))
    s = s.withColumn("target", target).withColumn("whole", whole.cast("long"))
    return s.select("source", "source_size", "target", "whole", (F.col("words") - F.col("whole") * F.col("source_size")).cast("long").alias("part"))


def _cut(rows: DataFrame, bucket: str, offset: str) -> DataFrame:
    """Per source, the bucket in which the running size passes part, and the size before that bucket.

    rows: source, part, bucket, size and the offset that the running size starts from. Sizes are summed per bucket
    before the window, which so sees at most 16 ** DIGITS rows of a source, however many documents that has.
    """
    sums = rows.groupBy("source", "part", offset, bucket).agg(F.sum("size").alias("n"))
    run = F.col(offset) + F.sum("n").over(W.partitionBy("source").orderBy(bucket).rowsBetween(W.unboundedPreceding, W.currentRow))
    sums = sums.withColumn("after", run).where(F.col("after") > F.col("part"))
    first = F.min(F.struct(F.col(bucket), (F.col("after") - F.col("n")).alias("before")))
    return sums.groupBy("source").agg(first.alias("m")).select("source", F.col(f"m.{bucket}").alias(f"cut_{bucket}"), F.col("m.before").alias(f"before_{bucket}"))


def _with(rows: DataFrame, more: DataFrame) -> DataFrame:
    """Left join on source, nulls equal."""
    more = more.withColumnRenamed("source", "_source")
    return rows.join(more, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def _digest(seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))


def _placed(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """rows (source, digest) with their source's plan, extra (a further repetition: 1 or 0) and at_cut (not known from these)."""
    rows = _with(rows, plan).withColumn("b1", F.substring("digest", 1, DIGITS)).withColumn("b2", F.substring("digest", DIGITS + 1, DIGITS))
    rows = rows.withColumn("at_cut", F.coalesce(F.expr("b1 = cut_b1 and b2 = cut_b2"), F.lit(False)))
    return rows.withColumn("extra", F.expr("case when b1 < cut_b1 or (b1 = cut_b1 and b2 < cut_b2) then 1 else 0 end"))


def plan_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), max_epochs: int = 3, share_percent: int = 100, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """sized: doc_id, source, size, digest of every document; plan: per source; chosen: the documents at the cut, with extra.

    Every document of a source is taken `whole` times; for the part left over, documents come in order of a seeded
    digest until their running size is nearest to it. The order is found by two levels of bucket sums, so that
    only the documents of one bucket in 16 ** (2 * DIGITS) of a source are ever sorted in one task.
    """
    sized = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), _digest(seed).alias("digest")), "mix")
    plan = small(materialise(water_fill(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, max_epochs, share_percent), "mix-plan"))
    rows = _with(sized, plan).withColumn("b1", F.substring("digest", 1, DIGITS)).withColumn("b2", F.substring("digest", DIGITS + 1, DIGITS))
    cut1 = small(materialise(_cut(rows.withColumn("o1", F.lit(0).cast("long")), "b1", "o1"), "mix-cut"))
    cut2 = small(materialise(_cut(_with(rows, cut1).where("b1 = cut_b1"), "b2", "before_b1"), "mix-cut"))
    plan = small(materialise(_with(_with(plan, cut1), cut2), "mix-plan"))
    order = W.partitionBy("source").orderBy("digest", "doc_id", "size").rowsBetween(W.unboundedPreceding, W.currentRow)
    middle = 2 * (F.col("before_b2") + F.sum("size").over(order)) - F.col("size")
    chosen = _placed(sized, plan).where("at_cut").withColumn("extra", F.when(middle <= 2 * F.col("part"), 1).otherwise(0))
    return sized, plan, chosen


def mix_sources(docs: DataFrame, **parameters) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    sized, plan, chosen = plan_mix(docs, **parameters)
    rows = _placed(sized, plan).where("not at_cut").unionByName(chosen)
    return rows.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * (F.col("whole") + F.col("extra"))).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, seed: int = 42, **parameters) -> DataFrame:
    """The mixed corpus: every row of docs as often as the mix takes it; word-less documents, or ones taken 0 times, go.

    A document's repetitions follow from its source's plan and its own digest, so the texts are not shuffled. Repeated
    rows that share a doc_id at the cut share the decision of the one that is taken more often.
    """
    _, plan, chosen = plan_mix(docs, seed=seed, **parameters)
    at_cut = small(materialise(chosen.groupBy("digest").agg(F.max("extra").alias("_extra")), "mix-chosen").withColumnRenamed("digest", "_digest"))
    key = F.struct(F.col("source"), _digest(seed).alias("digest"), F.struct("*").alias("doc"))
    rows = _placed(docs.where(F.col("text").rlike(WORD)).select(key.alias("k")).select("k.*"), plan)
    rows = rows.join(at_cut, F.col("digest") == F.col("_digest"), "left")
    copies = (F.col("whole") + F.when(F.col("at_cut"), F.coalesce("_extra", F.lit(0))).otherwise(F.col("extra"))).cast("int")
    rows = rows.select("doc", copies.alias("copies")).where("copies > 0")
    return rows.select("doc", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("doc.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                  md5('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest FROM documents),
s AS (SELECT source, CAST(sum(size) AS HUGEINT) AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM d GROUP BY source),
w AS (SELECT *, CAST(CASE (rn - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS HUGEINT) AS weight, 3 * source_size AS cap,
             CAST(sum(source_size) OVER () AS HUGEINT) AS budget FROM s),
c AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY source_size * (10 // weight), rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) * weight
             > cap * sum(weight) OVER (ORDER BY source_size * (10 // weight), rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS clamped FROM w),
f AS (SELECT *, CAST(budget - sum(CASE WHEN clamped THEN cap ELSE 0 END) OVER () AS HUGEINT) AS rest,
             CAST(sum(CASE WHEN clamped THEN 0 ELSE weight END) OVER () AS HUGEINT) AS free FROM c),
t AS (SELECT source, source_size, CASE WHEN clamped THEN CAST(cap AS DOUBLE) ELSE CAST(rest * weight AS DOUBLE) / CAST(free AS DOUBLE) END AS target,
             CASE WHEN clamped THEN cap ELSE (rest * weight) // free END AS words FROM f),
r AS (SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN t.words // t.source_size ELSE 0 END AS whole, t.words,
             2 * sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - d.size AS middle
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(source_size AS BIGINT) AS source_size, target,
       CAST(size * (whole + CASE WHEN middle <= 2 * (words - whole * source_size) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""

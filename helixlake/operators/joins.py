"""Joins and lookups beyond plain equi-joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: A key is hot with more than one in HOT_SHARE of the rows, HOT_ROWS at least.
HOT_SHARE, HOT_ROWS = 10_000, 10_000


def looked_up(rows: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """rows (a written table) joined to known, which has one row a key; rows of hot keys stay where they are.

    Less than HOT_SHARE keys can be hot, whatever the size of the table, so what is broadcast for them has a bound.
    """
    n = rows.count()
    most = max(HOT_ROWS, n // HOT_SHARE)
    if n <= most:
        return rows.join(known, on)
    hot = rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(*on)
    held = known.join(F.broadcast(hot), on, "left_semi")
    return rows.join(F.broadcast(hot), on, "left_anti").join(known, on).unionByName(rows.join(F.broadcast(held), on))


#: Pairs that a cell of a spread join has about, and one task.
PAIRS, TASK_PAIRS = 2_000_000, 5_000_000


def spread(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", each: int | None = None) -> DataFrame:
    """left joined to right (inner or left), the pairs dealt to tasks of about TASK_PAIRS however few the keys are.

    Both sides are counted by key first, so they are read twice, the left of a left join three times. Unless there are few pairs, arrays of a key's
    rows meet, not rows: a key of more than `each` rows (by default the root of PAIRS) is cut on either side by its rows' digests, and each cut of
    the left meets each of the right in a cell of its own. A cut key has more than `each` rows, which bounds what is broadcast. An array's pairs
    follow one another, so a file of them repeats itself and is packed well; rows without a match are put apart, as a file that begins with them
    gives up its dictionaries.
    """
    each = each or max(1, math.isqrt(PAIRS))
    count = lambda df, name: df.dropna(subset=on).groupBy(*on).agg(F.count(F.lit(1)).cast("double").alias(name))
    counts = count(left, "_l").join(count(right, "_r"), on).withColumn("_pairs", F.col("_l") * F.col("_r"))
    size = counts.agg(F.count(F.lit(1)).alias("keys"), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("_l", "_r", "_pairs")], F.coalesce(F.max(F.greatest("_l", "_r")), F.lit(0.0)).alias("most")).first()
    if size["_pairs"] <= TASK_PAIRS and size["most"] <= each:
        return left.join(right, on, how)
    tasks = lambda n, rows: max(left.sparkSession.sparkContext.defaultParallelism, min(int(n / rows) + 1, 20_000))
    dealt_to = max(tasks(size["_pairs"], TASK_PAIRS), tasks(size["_l"] + size["_r"], TASK_ROWS))
    cuts = counts.select(*on, *[F.ceil(F.col(c) / each).cast("int").alias(f"_n{own}") for c, own in (("_l", "_i"), ("_r", "_j"))])
    few = size["keys"] <= HELD_ROWS  # then all keys that meet are broadcast, and rows of others aren't shuffled
    cuts = F.broadcast(cuts if few else cuts.where("_n_i > 1 or _n_j > 1"))

    def arrays(rows: DataFrame, name: str, own: str, other: str) -> DataFrame:
        """One row per cell with its rows in an array, several if many rows are equal. Rows are shuffled once, to the tasks of their cells.

        A cell is one column of one type on both sides, nulls allowed: Spark drops literals from several keys, or casts, and would shuffle anew.
        """
        held = [c for c in rows.columns if c not in on]
        kind = T.StructType([*[T.StructField(k, rows.schema[k].dataType) for k in on], T.StructField("_i", T.IntegerType()), T.StructField("_j", T.IntegerType())])
        rows = rows.withColumn("_digest", F.xxhash64(*rows.columns)).join(cuts, on, "inner" if few else "left")
        place = {own: F.pmod("_digest", F.coalesce(f"_n{own}", F.lit(1))).cast("int"), other: F.explode(F.sequence(F.lit(0), F.coalesce(f"_n{other}", F.lit(1)) - 1))}
        rows = rows.select(*on, F.struct(*([F.col(c).alias(f"{name}{i}") for i, c in enumerate(held)] or [F.lit(1).alias(name)])).alias(name), *[c.alias(k) for k, c in place.items()])
        rows = rows.select(F.struct(*on, "_i", "_j").cast(kind).alias("_cell"), name).repartition(dealt_to, "_cell")
        rows = rows.withColumn("_part", F.floor((F.row_number().over(W.partitionBy("_cell").orderBy(name)) - 1) / (2 * each)))
        return rows.groupBy("_cell", "_part").agg(F.collect_list(name).alias(name)).drop("_part")

    met = arrays(left, "_a", "_i", "_j").join(arrays(right, "_b", "_j", "_i"), "_cell").select(*[F.col(f"_cell.{k}") for k in on], "_a", "_b")
    # a function of arrays isn't compiled into one loop with the join: in such a loop all pairs of a row of the join would wait in memory
    pairs = met.select(*on, "_b", F.inline(F.transform("_a", lambda a: a)))
    pairs = pairs.select(*[c for c in pairs.columns if c != "_b"], F.inline("_b"))
    named = lambda name, df: [F.col(f"{name}{i}").alias(c) for i, c in enumerate(c for c in df.columns if c not in on)]
    pairs = pairs.select(*on, *named("_a", left), *named("_b", right))
    if how != "left":
        return pairs
    return pairs.unionByName(left.join(cuts if few else counts, on, "left_anti"), allowMissingColumns=True)


def dealt(rows: DataFrame, each: int, *keys: str) -> DataFrame:
    """rows in partitions of about `each` rows (by keys, if named), as many as there are cores at least: for work that a small file would leave to one task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(cores, -(-rows.count() // each)), *keys)


#: Rows of a table that a task of a join or an aggregate gets about, and rows of a table that is broadcast at most.
TASK_ROWS, HELD_ROWS = 250_000, 200_000


def tasks_for(rows: DataFrame, each: int = TASK_ROWS) -> int:
    """Tasks of about `each` rows; of a table in files only their footers are read for it."""
    return max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // each))


def hashed(rows: DataFrame, tasks: int | None, *keys: str) -> DataFrame:
    """rows hashed on keys to that many tasks, so that a task's share doesn't grow with the table; None: as Spark deals them.

    The pathogen isn't hashed: it is mostly one literal, which Spark drops from the keys of a join or group, and it would then shuffle anew.
    """
    return rows.repartition(tasks, *[k for k in keys if k != "pathogen_id"]) if tasks else rows


def met(rows: DataFrame, known: DataFrame, on: list[str], tasks: int | None = None) -> DataFrame:
    """rows joined to known: where the rows are, if known has no more than HELD_ROWS rows (it is counted), else with both sides hashed on the keys."""
    if known.count() <= HELD_ROWS:
        return rows.join(F.broadcast(known), on)
    return hashed(rows, tasks, *on).join(hashed(known, tasks, *on), on)


def first_per(rows: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """The first row of each key in the order given; the order should be total, else the row isn't determined."""
    return rows.withColumn("_place", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where("_place = 1").drop("_place")


def best_per(rows: DataFrame, keys: list[str], score: Column, ordinal: str) -> DataFrame:
    """The row of greatest score per key, the earliest at ties: one aggregation with partial sums, no sort of groups."""
    every = F.struct(*rows.columns)
    return rows.groupBy(*keys).agg(F.max_by(every, F.struct(score.alias("s"), (-F.col(ordinal)).alias("o"))).alias("_r")).select("_r.*")


def known_novel(observed: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """observed + is_known: whether its key is among known ones. Keys with nulls are never known."""
    flag = known.select(*keys).distinct().withColumn("_hit", F.lit(True))
    return observed.join(flag, keys, "left").withColumn("is_known", F.coalesce("_hit", F.lit(False))).drop("_hit")


def corroborated(rows: DataFrame, evidence: DataFrame, keys: list[str]) -> DataFrame:
    """rows + corroborated: EXISTS / NOT EXISTS as one left join on distinct keys instead of two passes."""
    return known_novel(rows, evidence, keys).withColumnRenamed("is_known", "corroborated")


def normalise_label(c: Column, prefix: str = "") -> Column:
    """Lower case, anything but letters and digits to single hyphens, none at the ends, without the species prefix."""
    out = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-")
    out = F.regexp_replace(out, "^-+|-+$", "")
    return F.regexp_replace(out, f"^{prefix}-", "") if prefix else out


def alias_keys(lineages: DataFrame) -> DataFrame:
    """(lineage_id, name, aliases) -> (key, lineage_id, priority): exact id, then name, then normalised aliases."""
    by_id = lineages.select(F.col("lineage_id").alias("key"), "lineage_id", F.lit(0).alias("priority"))
    by_name = lineages.where("name is not null").select(F.col("name").alias("key"), "lineage_id", F.lit(1).alias("priority"))
    by_alias = lineages.select("lineage_id", F.explode("aliases").alias("alias")).select(normalise_label(F.col("alias")).alias("key"), "lineage_id", F.lit(2).alias("priority"))
    return by_id.unionByName(by_name).unionByName(by_alias)


def resolve_lineage(rows: DataFrame, label: str, lineages: DataFrame) -> DataFrame:
    """rows + resolved: the lineage that a label names, by the strongest kind of key (smallest id at ties)."""
    keys = alias_keys(lineages).groupBy("key").agg(F.min(F.struct("priority", "lineage_id")).alias("m"))
    exact = keys.select(F.col("key").alias("_k1"), F.col("m").alias("_m1"))
    loose = keys.select(F.col("key").alias("_k2"), F.col("m").alias("_m2"))
    out = rows.join(exact, F.col(label) == F.col("_k1"), "left").join(loose, normalise_label(F.col(label)) == F.col("_k2"), "left")
    return out.withColumn("resolved", F.coalesce(F.least("_m1", "_m2"), "_m1", "_m2")["lineage_id"]).drop("_k1", "_m1", "_k2", "_m2")


#: Rows that an array of a day holds at most, and rows that a task of pairs of days gets about.
ARRAY_ROWS, NEAR_ROWS = 2_000, 5_000


def _by_day(rows: DataFrame, keys: list[str], date: str, name: str, tasks: int | None) -> DataFrame:
    """One row per key and day with its rows in order in an array (`name`); several with ARRAY_ROWS each, if a day has more."""
    held = [c for c in rows.columns if c not in (*keys, date)]
    rows = hashed(rows.where(F.col(date).isNotNull()), tasks, *keys, date)
    place = F.row_number().over(W.partitionBy(*keys, date).orderBy(*(held or [date])))
    rows = rows.withColumn("_part", F.floor((place - 1) / ARRAY_ROWS))
    return rows.groupBy(*keys, date, "_part").agg(F.collect_list(F.struct(*(held or [F.lit(1)]))).alias(name)).drop("_part")


def within_days(left: DataFrame, right: DataFrame, keys: list[str], date: str, days: int, n: int | None = None) -> DataFrame:
    """Pairs of equal keys whose dates (`date`, `r_date`) differ by at most days. n: rows of a side, by which tasks are made (None: as Spark deals them).

    A range join: both sides fall into windows of `days`; the right side is put into its own and both neighbouring ones,
    so that an equi-join on (keys, window) finds every pair once, instead of all pairs of a key. Days meet, not rows: they are shuffled as arrays,
    and the pairs of two days follow one another, so that a file of them repeats itself and is packed to a fraction of what it takes by rows.
    """
    # both sides get their windows in one way: so Spark sees that a table joined to itself needs to be shuffled by day once only
    windows = lambda c, *near: F.explode(F.array(*[F.floor(F.unix_date(c) / days) + k for k in near]))
    rows_tasks, pairs_tasks = [n and max(left.sparkSession.sparkContext.defaultParallelism, -(-n // each)) for each in (TASK_ROWS, NEAR_ROWS)]
    a = _by_day(left, keys, date, "_a", rows_tasks).withColumn("_w", windows(date, 0))
    b = _by_day(right, keys, "r_date", "_b", rows_tasks).withColumn("_w", windows("r_date", -1, 0, 1))
    near = F.abs(F.datediff(F.col(date), F.col("r_date"))) <= days
    met = hashed(a, pairs_tasks, *keys, "_w").join(hashed(b, pairs_tasks, *keys, "_w"), [*keys, "_w"]).where(near)
    of = lambda side, df, on: [F.col(f"{side}.{c}") for c in df.columns if c not in (*keys, on)]
    # a function of arrays isn't compiled into one loop with the join: in such a loop all pairs of a row of the join would wait in memory
    pairs = met.withColumn("_a", F.explode(F.transform("_a", lambda a: a))).withColumn("_b", F.explode("_b"))
    return pairs.select(*keys, date, "r_date", *of("_a", left, date), *of("_b", right, "r_date"))


def in_interval(points: DataFrame, intervals: DataFrame, keys: list[str], grain: int = 64) -> DataFrame:
    """Points (position) with the intervals (start, end, inclusive) that hold them, joined by blocks of `grain` positions."""
    a = points.withColumn("_b", F.floor(F.col("position") / grain))
    b = intervals.where("start <= end").withColumn("_b", F.explode(F.sequence(F.floor(F.col("start") / grain), F.floor(F.col("end") / grain))))
    return a.join(b, [*keys, "_b"]).where("position between start and end").drop("_b")


def nearest_mention(mentions: DataFrame, aliases: DataFrame, doc: str) -> DataFrame:
    """(doc, mention, at) x (doc, alias, at) -> each mention with the alias nearest in characters; ties to the earlier, then by name.

    Mentions and aliases of a document are put in order once; a mention looks at the last alias before it and the first one after it,
    not at all. Rows without a document or a place are left out, and mentions of documents without aliases.
    """
    place = F.col("at").isNotNull() & F.col(doc).isNotNull()
    named = aliases.where(place & F.col("alias").isNotNull()).groupBy(doc, "at").agg(F.struct(F.col("at").alias("a_at"), F.min("alias").alias("alias")).alias("a"))
    rows = mentions.where(place).select(doc, "mention", "at").distinct().withColumn("is_mention", F.lit(True)).unionByName(named, allowMissingColumns=True)
    seen = lambda order: F.last("a", ignorenulls=True).over(W.partitionBy(doc).orderBy(order).rangeBetween(W.unboundedPreceding, W.currentRow))
    rows = rows.select(doc, "mention", "at", "is_mention", F.array(seen(F.col("at")), seen(F.col("at").desc())).alias("near")).where("is_mention")
    ranked = F.transform(F.filter("near", lambda a: a.isNotNull()), lambda a: F.struct(F.abs(F.col("at") - a["a_at"]).alias("d"), a["a_at"], a["alias"]))
    return rows.select(doc, "mention", "at", F.array_min(ranked).alias("m")).where("m is not null").select(doc, "mention", "at", F.col("m.alias").alias("alias"), F.col("m.d").alias("distance"))

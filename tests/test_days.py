"""Pairs within days: equal to plain loops, packed in a file, and never many of them in memory."""

import datetime as dt
import random
import re

from pyspark.sql import functions as F

from helixlake.operators import joins as J
from helixlake.plans import registry


def test_pairs_match_plain_loops(spark, monkeypatch):
    """Days of more rows than an array holds, equal rows, missing keys, dates and names, days before 1970, a side without further columns."""
    rng = random.Random(8)
    day = lambda: rng.choice([None, *[dt.date(1969, 12, 20) + dt.timedelta(days=i) for i in range(25)]])
    a = [(rng.choice("xyz") if i % 9 else None, day(), rng.choice([None, f"a{i}", "same"]), i % 4) for i in range(150)]
    b = [(rng.choice("xyw") if i % 9 else None, day(), rng.choice([None, f"b{i}", "same"])) for i in range(150)]
    left, right = spark.createDataFrame(a, "k string, d date, a string, n int"), spark.createDataFrame(b, "k string, r_date date, b string")
    met = [(x, y) for x in a for y in b if x[0] and x[0] == y[0] and x[1] and y[1] and abs((x[1] - y[1]).days) <= 4]
    key = lambda rows: sorted(rows, key=str)
    for size in (1, 3, 2_000):
        monkeypatch.setattr(J, "ARRAY_ROWS", size)
        for n in (None, 30_000):
            got = J.within_days(left, right, ["k"], "d", 4, n)
            assert key(map(tuple, got.select("k", "d", "a", "n", "r_date", "b").collect())) == key((*x, *y[1:]) for x, y in met)
            assert J.within_days(left.select("k", "d"), right.select("k", "r_date"), ["k"], "d", 4, n).count() == len(met)


def test_a_file_of_pairs_is_small(spark, tmp_path):
    """12 days of 120 rows each give over a million pairs; in the order of single rows they take over a byte each."""
    rows = spark.range(1_440).select(F.lit("k").alias("k"), F.expr("date_add(date'2020-01-01', cast(pmod(id * 7, 12) as int))").alias("d"), F.concat(F.lit("accession"), "id").alias("a"))
    pairs = J.within_days(rows, rows.selectExpr("k", "d as r_date", "a as b"), ["k"], "d", 5)
    pairs.select("a", "b", F.abs(F.datediff("d", "r_date")).alias("gap")).write.parquet(f"{tmp_path}/pairs")
    n = spark.read.parquet(f"{tmp_path}/pairs").count()
    assert n == sum(120 * 120 for x in range(12) for y in range(12) if abs(x - y) <= 5) and n > 1_000_000
    assert sum(f.stat().st_size for f in (tmp_path / "pairs").glob("*.parquet")) < 0.6 * n


def test_pairs_leave_the_join_one_row_at_a_time(spark, sf_dir):
    """Only arrays of days are shuffled for the join, to tasks by the number of orders, and the join isn't in one generated loop with the pairs."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry.QUERIES["J20_window_neighbours"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    outer = next(line for line in plan.splitlines() if "Generate explode(transform(_a" in line)
    assert not re.search(r"\*\(\d+\) Generate", outer) and re.search(r"\*\(\d+\) Generate explode\(_b", plan)
    join = plan[plan.index("Join [species_id") :]
    assert "collect_list" in join and not re.search(r"Exchange hashpartitioning\((?!.*REPARTITION_BY_NUM)", join)


def test_a_self_join_is_shuffled_by_day_once(spark, sf_dir):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry.QUERIES["J20_window_neighbours"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    by_day = [line for line in plan.splitlines() if re.search(r"Exchange hashpartitioning\(species_id#\w+, collection_country#\w+, (collection|r)_date#", line)]
    assert ["ReusedExchange" in line for line in by_day] == [False, True]

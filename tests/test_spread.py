"""The spread join meets arrays of a key's rows in cells: the pairs of an ordinary join, however rows fall to arrays."""

import random

import pytest

from helixlake.operators import joins as J
from helixlake.plans import registry


def planned(spark, df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("each", [1, 3, 100])
def test_cells_match_a_plain_join(spark, monkeypatch, how, each):
    """Two keys, nulls in either, keys of one side only, many equal rows (one digest), a column of arrays, and a right side of keys alone."""
    monkeypatch.setattr(J, "PAIRS", 40)
    monkeypatch.setattr(J, "TASK_PAIRS", 30)
    rng = random.Random(9)
    pick = lambda *x: rng.choice([None, *x])
    a = [(pick("p", "q"), pick(1, 2), f"a{i}", [i, None]) for i in range(90)] + [("p", 1, "same", [7])] * 30 + [("only", 5, "left", None)] * 9
    b = [(pick("p", "q"), pick(1, 2), pick("x", "y")) for _ in range(40)] + [("p", 1, "same")] * 12 + [("only", 6, "right")] * 9
    left, right = spark.createDataFrame(a, "k string, n int, a string, more array<int>"), spark.createDataFrame(b, "k string, n int, b string")
    key = lambda rows: sorted(map(str, rows))
    for r in (right, right.select("k", "n"), right.where("false")):
        got, want = J.spread(left, r, ["k", "n"], how, each), left.join(r, ["k", "n"], how)
        assert got.columns == want.columns and key(got.collect()) == key(want.collect())


def test_a_key_alone_is_dealt_evenly_by_arrays(spark, monkeypatch):
    """One key: arrays of 100 rows meet, 100 cells go to 101 tasks, and rows of the right go to 10 of them, not to all."""
    monkeypatch.setattr(J, "PAIRS", 10_000)
    monkeypatch.setattr(J, "TASK_PAIRS", 10_000)
    rows = spark.range(1_000).selectExpr("'k' as k", "id")
    out = J.spread(rows, rows.withColumnRenamed("id", "r"), ["k"])
    plan = planned(spark, out)
    assert "collect_list" in plan and "inline(_b" in plan and "inline(transform(_a" in plan
    held = out.selectExpr("spark_partition_id() as p").groupBy("p").count().collect()
    assert sum(r["count"] for r in held) == 1_000_000 and len(held) > 40 and max(r["count"] for r in held) < 100_000


@pytest.mark.parametrize("name", ["J03_phenotype_or_join", "J04_array_lineage_join"])
def test_calls_and_associations_meet_as_arrays(spark, sf_dir, monkeypatch, name):
    """With arrays of 5 rows the query's rows are those of its plain joins, and all its ways meet arrays."""
    from helixlake.plans import views as V

    key = lambda df: sorted(map(str, df.collect()))
    want = registry.QUERIES[name](spark, sf_dir)
    assert "inline(_b" not in planned(spark, want)
    monkeypatch.setattr(V, "CHUNK", 5)
    got = registry.QUERIES[name](spark, sf_dir)
    assert planned(spark, got).count("inline(_b") >= 2 and key(got) == key(want)


def test_a_stored_table_leaves_no_shuffles(spark):
    import time

    from helixlake.sources import sinks

    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    before, conf = shuffled(), spark.conf.get(sinks.CLEANUP)
    rows = spark.range(1_000).repartition(3, "id")
    assert sinks.stored(rows, "shuffled").count() == 1_000 and spark.conf.get(sinks.CLEANUP) == conf
    kept = spark.range(1_000).repartition(3, "id").groupBy("id").count()  # a reader's own shuffles aren't touched
    assert kept.count() == 1_000
    counted = shuffled() - before
    again = sinks.stored(rows, "shuffled")
    for _ in range(50):
        if shuffled() - before <= counted:
            break
        time.sleep(0.1)
    assert shuffled() - before <= counted and again.count() == 1_000


@pytest.mark.parametrize("name", ["J08_snapshot", "J12_exact_matches", "E25_phenotype_matching"])
def test_stored_calls_meet_associations(spark, sf_dir, monkeypatch, name):
    """Calls (of E25: samples) are read from one written table, not made again; with small cells the rows are the same."""
    key = lambda df: sorted(map(str, df.collect()))
    want = registry.QUERIES[name](spark, sf_dir)
    assert "lineitem.parquet" not in planned(spark, want) and "l_orderkey" not in planned(spark, want)
    monkeypatch.setattr(J, "PAIRS", 4)
    monkeypatch.setattr(J, "TASK_PAIRS", 300)
    got = registry.QUERIES[name](spark, sf_dir)
    assert "inline" in planned(spark, got) and key(got) == key(want)


def test_rows_of_a_cell_are_shuffled_once(spark, monkeypatch):
    """A key that is a literal, and keys that may be null on one side only: the arrays meet where their rows were dealt to."""
    monkeypatch.setattr(J, "PAIRS", 4)
    monkeypatch.setattr(J, "TASK_PAIRS", 300)
    left = spark.range(200).selectExpr("if(id % 9 = 0, null, id % 5) as k", "if(id % 2 = 0, 'O', 'F') as ref", "id as a")
    right = spark.range(200).selectExpr("id % 5 as k", "'O' as ref", "id as b")
    plan = planned(spark, J.spread(left, right, ["k", "ref"]))
    pairs = plan[plan.index("Generate inline(_b") :]
    join = pairs[pairs.index("Join [") :].splitlines()
    assert "cast(" not in join[0] and "REPARTITION_BY_NUM" in next(line for line in join if "Exchange hashpartitioning" in line)

"""What a task holds doesn't grow with the tables: rows are dealt to tasks by their number wherever calls are hashed."""

import datetime as dt
import random
import re

import pytest

from helixlake.operators import joins as J
from helixlake.operators import upserts as U
from helixlake.plans import registry

#: Queries over calls, and the shuffles that each of them deals by number beside those of the joins to genomes.
OVER_CALLS = {
    "A01_mutation_surveillance": 1, "A03_mutation_trends": 1, "A04_mutation_frequency": 1, "A06_lineage_breakdown": 1, "A07_lineage_surveillance": 1, "E26_enrichment": 1,
    "K02_incremental_catalogue": 2, "E01_cooccurrence_history": 1, "E07_confidence": 0, "E09_intervention_findings": 0,
}


@pytest.mark.parametrize("name", sorted(OVER_CALLS))
def test_calls_are_dealt_by_their_number(name, spark, sf_dir, monkeypatch):
    """With 500 rows a task, all shuffles of calls are of 13 tasks (6,005 lines), whatever Spark's number of partitions."""
    monkeypatch.setattr(J.tasks_for, "__defaults__", (500,))
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    dealt = [keys for keys, n in re.findall(r"Exchange hashpartitioning\((.*), (\d+)\), REPARTITION_BY_NUM", plan) if int(n) == -(-lines // 500)]
    ours = [k for k in dealt if "genome_accession#" not in k or "hgvs_p" in k]
    assert any(k.startswith("genome_accession#") for k in dealt) and len(ours) >= OVER_CALLS[name]
    for keys in re.findall(r"Exchange hashpartitioning\((.*), \d+\), ENSURE_REQUIREMENTS", plan):
        assert "genome_accession#" not in keys and "hgvs_p" not in keys


def test_catalogue_matches_plain_sets(spark):
    """Genomes that come with several countries and lineages, nulls in all columns, and states that repeat rows."""
    rng = random.Random(4)
    pick = lambda *x: rng.choice([None, *x])
    rows = [("p", "s", rng.choice("GH"), pick(1), None, "V", "t", "h", pick("a", "b", "c"), pick(dt.date(2020, 1, 1), dt.date(2020, 3, 1)), pick("X", "Y"), pick("l", "m")) for _ in range(80)]
    schema = "pathogen_id string, species_id string, gene string, position int, ref_aa string, alt_aa string, variant_type string, hgvs_p string, genome_accession string, collection_date date, collection_country string, lineage_id string"
    df = spark.createDataFrame(rows, schema)
    want = {}
    for r in rows:
        want.setdefault(r[2:4], []).append(r[8:])
    known = lambda v, i: sorted({x[i] for x in v if x[i] is not None})
    want = {k: (len(known(v, 0)), *[f(known(v, 1), default=None) for f in (min, max)], known(v, 2), known(v, 3)) for k, v in want.items()}
    for tasks in (None, 3):
        got = U.catalogue(U.catalogue_state(df), df, tasks=tasks).collect()
        assert {(r["gene"], r["position"]): (r["genome_count"], r["first_seen"], r["last_seen"], r["countries"], r["lineages"]) for r in got} == want and len(got) == len(want)


def test_known_rows_are_broadcast_or_hashed(spark, monkeypatch):
    a, b = spark.createDataFrame([(i % 5, i) for i in range(40)], "k int, a int"), spark.createDataFrame([(i, -i) for i in range(4)], "k int, b int")
    want = sorted((i % 5, i, -(i % 5)) for i in range(40) if i % 5 < 4)
    assert sorted(map(tuple, J.met(a, b, ["k"], 3).collect())) == want
    monkeypatch.setattr(J, "HELD_ROWS", 3)
    assert sorted(map(tuple, J.met(a, b, ["k"], 3).collect())) == want


def test_first_told_matches_plain_loop(spark, sf_dir):
    """Ordinals that repeat and are missing, values that vary, rules that tell the same; texts aren't sorted whole, and rows are dealt before they are read."""
    from pyspark.sql import functions as F

    from helixlake.operators import extraction as X

    rng = random.Random(6)
    docs = [(rng.choice([None, *range(30)]), f"u{i}", rng.choice([None, "", "1 a", "2 a b", "b", "a 1 b"])) for i in range(90)]
    df = spark.createDataFrame(docs, "ordinal long, url string, text string")
    digit = F.regexp_extract("text", r"(\d)", 1)
    rules = [(F.contains("text", F.lit("a")), {"x": "A", "y": digit}), (F.contains("text", F.lit("b")), {"x": "A", "y": F.lit("1")}), (digit != "", {"y": digit})]
    for same in (None, ("x",)):
        want = {}
        for o, u, t in docs:
            d = re.search(r"\d", t or "")
            d = d[0] if d else ""
            for i, (when, x, y) in enumerate([("a" in (t or ""), "A", d), ("b" in (t or ""), "A", "1"), (d != "", None, d)]):
                if when:
                    place = (o is not None, o or 0, i, x is not None, x or "", y, u)
                    key = (x,) if same else (x, y)
                    want[key] = min(want.get(key, place), place)
        got = sorted(map(tuple, X.first_told(df, rules, ("x", "y"), same).collect()), key=str)
        assert got == sorted(((p[4] if p[3] else None, p[5], p[6]) for p in want.values()), key=str)
    plan = registry.QUERIES["X04_people"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Exchange hashpartitioning\(o_orderkey#\w+, \d+\), REPARTITION_BY_NUM", plan)


def test_a_table_of_few_first_keys_is_written_by_many_tasks(spark, tmp_path):
    """One partition and one gene: rows still go to all tasks, in order within each file."""
    from pyspark.sql import functions as F

    from helixlake.sources.manifest import Catalogue

    there = Catalogue(spark, f"file://{tmp_path}/c")
    rows = spark.range(4000).select(F.lit("s").alias("species_id"), F.lit("G").alias("gene"), (F.col("id") * 7 % 100).alias("position"))
    aqe = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        there.refresh([("t", lambda _: rows)], "species_id", ("gene", "position"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", aqe)
    files = list((tmp_path / "c").rglob("*.parquet"))
    assert len(files) > 1 and there.read("t").count() == 4000
    for f in files:
        held = [r[0] for r in spark.read.parquet(str(f)).coalesce(1).select("position").collect()]
        assert held == sorted(held)

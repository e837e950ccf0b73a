"""Golden values, edge cases and properties of the evidence engine's functions and operators."""

import datetime as dt
import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from helixlake import schemas
from helixlake.functions import scalars as S
from helixlake.operators import evidence as E
from helixlake.operators import joins as J
from helixlake.operators import mining as M
from helixlake.operators import sequence as Q
from helixlake.operators import stats
from helixlake.operators import upserts as U
from helixlake.plans import views as V
from helixlake.sources import readers, sinks


def one(spark, expr, **columns):
    df = spark.createDataFrame([tuple(columns.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in columns.items())) if columns else spark.range(1)
    return df.select(expr.alias("x")).first()["x"]


@pytest.mark.parametrize(("text", "want"), [("GP:A82V", ("GP", "A", 82, "V")), ("GP:*82W", ("GP", "*", 82, "W")), ("gp:a82v", None), ("", None), ("GP:A82V ", None), (None, None)])
def test_gene_mutation(spark, text, want):
    got = one(spark, S.parse_gene_mutation(F.col("t")), t=text)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(("text", "want"), [("p.Ala82Val", ("A", 82, "V")), ("p.A82V", ("A", 82, "V")), ("A82V", None), ("p.Xyz82Val", (None, 82, "V"))])
def test_protein_change(spark, text, want):
    got = one(spark, S.parse_protein_change(F.col("t")), t=text)
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(("text", "want"), [("2014-06-14", dt.date(2014, 6, 14)), ("14-Jun-2014", dt.date(2014, 6, 14)), ("1977", dt.date(1977, 1, 1)), ("2014-13-01", None), ("", None), ("2014-05", None), (None, None)])
def test_record_date(spark, text, want):
    assert one(spark, S.record_date(F.col("t")), t=text) == want


def test_cfr(spark):
    rate = lambda g, c, d: spark.range(1).select(S.cfr_percent(F.lit(g).cast("double"), F.lit(c).cast("int"), F.lit(d).cast("int"))).first()[0]
    assert rate(None, 142, 55) == 38.73
    assert rate(None, 0, 5) is None
    assert rate(None, 10, None) is None
    assert rate(150.0, 100, 25) == 25.0


def test_identifiers(spark):
    name = "a|b|é"
    assert one(spark, S.association_id(F.col("t")), t=name) == "gpa_" + uuid.uuid5(uuid.NAMESPACE_URL, name).hex[:12]
    assert one(spark, S.url_host(F.col("t")), t="https://WWW.Example.org/x?y") == "example.org"
    assert one(spark, S.lenient_int(F.col("t")), t="about 1,234 cases") == 1234
    assert one(spark, S.html_text(F.col("t")), t="<tr><td>a</td><td>b&amp;c</td></tr><script>x</script>") == "| a | b&c"
    assert one(spark, F.to_json(S.parse_array_literal(F.col("t"))), t='{a,"b, c"}') == '["a","b, c"]'


def test_counts_in_text(spark):
    text = "a cumulative total of 1,234 confirmed cases including 55 deaths"
    assert one(spark, M.count_in_text(F.col("t"), M.CASES), t=text) == 1234
    assert one(spark, M.count_in_text(F.col("t"), M.DEATHS), t=text) == 55
    assert one(spark, M.count_in_text(F.col("t"), M.CASES), t="**164** cases") == 164
    assert one(spark, M.count_in_text(F.col("t"), M.CASES), t=None) is None
    assert one(spark, M.earliest_term(F.col("t"), ["US", "Mali", "Guinea"]), t="A virus in Guinea, then Mali") == "Guinea"


def test_label_and_vocabulary(spark):
    assert one(spark, J.normalise_label(F.col("t"), "ebov"), t=" EBOV__Makona 2014 ") == "makona-2014"
    assert one(spark, schemas.rank_of(F.col("t"), schemas.RISK_TIERS), t="monitor") == 1
    assert one(spark, schemas.rank_of(F.col("t"), schemas.RISK_TIERS), t="other") is None


def test_greedy_merging_matches_plain_loop(spark):
    rows = [("A", 2014, i, c, d) for i, (c, d) in enumerate([(100, 5), (102, 5), (100, 5), (None, None), (None, None), (200, 9), (203, 9), (210, 9)])] + [("A", 2015, 9, 100, 5), (None, 2014, 10, 1, 1)]
    got = M.similar_outbreaks(spark.createDataFrame(rows, "country string, year int, ordinal int, cases int, deaths int")).collect()
    kept = []
    for r in rows:
        same = False
        for k in kept:
            if r[0] is None or k[:2] != r[:2]:
                continue
            same |= (k[3:] == r[3:]) if k[3] is None or r[3] is None else abs(k[3] - r[3]) <= int(k[3] * 0.02) and abs(k[4] - r[4]) <= int(k[4] * 0.02)
        if not same:
            kept.append(r)
    assert sorted(r["ordinal"] for r in got) == [r[2] for r in kept]


def test_fisher_and_chi_squared():
    assert stats.fisher(3, 1, 1, 3) == pytest.approx(0.4857142857, abs=1e-9)
    assert stats.fisher(8, 2, 1, 5) == pytest.approx(0.0349650350, abs=1e-9)
    assert stats.chi_squared(10, 20, 30, 40) == pytest.approx(0.5040358664, abs=1e-6)
    assert stats.chi_squared(10, 10, 10, 10) == 1.0


def test_trend_needs_three_years(spark):
    rows = [("a", y, n) for y, n in ((2001, 1), (2002, 2), (2003, 4), (2004, 8))] + [("b", 2001, 1), ("b", 2002, 9)]
    got = {r["g"]: r for r in stats.poisson_trend(spark.createDataFrame(rows, "g string, year int, n long"), "g").collect()}
    assert set(got) == {"a"}
    assert got["a"]["slope"] == pytest.approx(0.6931, abs=1e-3)


def test_alignment():
    protein = "ACDEFGHIKLMNPQRSTVWY"
    assert Q.variants(protein, protein) == []
    assert Q.variants(protein, protein[:9] + "W" + protein[10:]) == [(10, "L", "W", "substitution")]
    assert Q.variants(protein, protein[:9] + protein[10:]) == [(10, "L", "-", "deletion")]
    assert Q.variants(protein, protein[:10] + "WW" + protein[10:])[0][3] == "insertion"
    assert Q.variants(protein, "X" * 11 + protein[11:]) == []
    assert Q.variants(protein, protein[:9]) == []
    assert Q.variants(protein, protein[:9] + "X" + protein[10:]) == []


def test_reading_frames():
    dna = "ATG" + "GCT" * 160 + "TAA"
    assert any(len(p) >= 160 for p in Q.reading_frames(dna))
    assert Q.translate("ATGTAA") == "M*"
    back = dna.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    assert any("A" * 150 in p for p in Q.reading_frames(back))


def test_newick(spark):
    trees = spark.createDataFrame([("t", "((A:1,B:2):1,C:4);"), ("e", "")], "tree_id string, newick string")
    got = {r["tip"]: r["root_distance"] for r in readers.newick_tips(trees).collect()}
    assert got == {"A": 2.0, "B": 3.0, "C": 4.0}


def test_upserts_any_order(spark):
    calls = [("p", "s", "g", i % 3, "A", "V", "sub", f"h{i % 3}", f"a{i}", dt.date(2000 + i, 1, 1), None if i % 4 == 0 else f"c{i % 2}", "l") for i in range(12)]
    schema = "pathogen_id string, species_id string, gene string, position int, ref_aa string, alt_aa string, variant_type string, hgvs_p string, genome_accession string, collection_date date, collection_country string, lineage_id string"
    parts = [U.partial_catalogue(spark.createDataFrame(calls[k::3], schema)) for k in range(3)]
    whole = sorted(map(str, U.partial_catalogue(spark.createDataFrame(calls, schema)).selectExpr("hgvs_p", "array_sort(genomes) g", "first_seen", "last_seen", "countries", "lineages").collect()))
    for order in itertools.permutations(range(3)):
        out = parts[order[0]]
        for k in (*order[1:], order[0]):
            out = U.merge_catalogue(out, parts[k])
        assert sorted(map(str, out.selectExpr("hgvs_p", "array_sort(genomes) g", "first_seen", "last_seen", "countries", "lineages").collect())) == whole


def test_ranges_match_nested_loops(spark):
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=7 * i) for i in range(20)]
    a = spark.createDataFrame([("k", d) for d in days], "key string, d date")
    b = spark.createDataFrame([("k", d) for d in days[::3]], "key string, r_date date")
    got = J.within_days(a, b, ["key"], "d", 10).count()
    assert got == sum(abs((x - y).days) <= 10 for x in days for y in days[::3])
    p = spark.createDataFrame([("g", i) for i in range(0, 300, 7)], "gene string, position int")
    v = spark.createDataFrame([("g", s, s + 90) for s in range(0, 250, 50)], "gene string, start int, end int")
    assert J.in_interval(p, v, ["gene"]).count() == sum(s <= i <= s + 90 for i in range(0, 300, 7) for s in range(0, 250, 50))


def test_undated_call_is_latest(spark):
    cols = "pathogen_id string, species_id string, genome_accession string, gene string, position int, ref_aa string, alt_aa string, variant_type string, hgvs_p string, collection_date date, collection_year int, collection_country string"
    rows = [("p", "s", "g1", "X", 1, "A", "V", "t", "h", dt.date(2020, 1, 1), 2020, "c"), ("p", "s", "g2", "X", 1, "A", "V", "t", "h", None, None, None)]
    assert [r["genome_accession"] for r in V.latest_observation(spark.createDataFrame(rows, cols)).collect()] == ["g2"]


def test_confidence_bounds(spark):
    score = lambda *x: spark.range(1).select(E.confidence_score(*[F.lit(v) for v in x])).first()[0]
    assert score(9, "strong", 500, True, False) == 1.0
    assert score(0, "preliminary", 0, False, True) == 0.0
    assert score(1, "weak", 25, False, False) == pytest.approx(0.32)


def test_readers(spark, tmp_path):
    (tmp_path / "a.fasta").write_text(">s1 first\nACG\nT\n>s2\nGG\n")
    assert sorted(map(tuple, readers.fasta(spark, str(tmp_path / "a.fasta")).collect())) == [("s1", "ACGT"), ("s2", "GG")]
    assert readers.csv(spark, str(tmp_path / "none.csv"), "a string, b int").count() == 0
    (tmp_path / "c.csv").write_text('id,tags,flag\n1,"{a,""b, c""}",t\n2,{},f\n')
    got = {r["id"]: (r["tags"], r["flag"]) for r in readers.catalogue_csv(spark, str(tmp_path / "c.csv"), "id string, tags string, flag string", ["tags"], ["flag"]).collect()}
    assert got == {"1": (["a", "b, c"], True), "2": ([], False)}
    (tmp_path / "s1").mkdir()
    (tmp_path / "s1" / "d.json").write_text('{"sample_id": "s1"}')
    (tmp_path / "s2").mkdir()
    (tmp_path / "s2" / "d.json").write_text("{broken")
    assert [r["sample_id"] for r in readers.sample_documents(spark, f"{tmp_path}/*/d.json", "sample_id string").collect()] == ["s1"]


def test_empty_entities_keep_their_schema(spark, tmp_path):
    sinks.write_entities({"genomes": spark.createDataFrame([], schemas.GENOME)}, str(tmp_path))
    assert "collection_date" in spark.read.parquet(f"{tmp_path}/genomes").columns


def test_streams(spark, sf_dir, tmp_path):
    from helixlake.streaming.catalogue import maintain_catalogue, windowed_counts

    schema = "pathogen_id string, species_id string, gene string, position int, ref_aa string, alt_aa string, variant_type string, hgvs_p string, genome_accession string, collection_date date, collection_country string, lineage_id string"
    calls = spark.createDataFrame([("p", "s", "g", i % 2, "A", "V", "t", "h", f"a{i}", dt.date(2020, 1, 1 + i), "c", "l") for i in range(6)], schema)
    for k in range(2):
        calls.where(f"position = {k}").union(calls.where("genome_accession = 'a0'")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    maintain_catalogue(stream, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    last = spark.read.parquet(f"{tmp_path}/out/version=1")
    assert sorted((r["position"], len(r["genomes"])) for r in last.collect()) == [(0, 3), (1, 3)]
    events = spark.readStream.schema(spark.read.parquet(f"{sf_dir}/events.parquet").schema).parquet(f"{sf_dir}/events.parque*")
    q = windowed_counts(events).writeStream.format("memory").queryName("counts").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp2").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("counts").count() > 0


def test_spread_join_cuts_heavy_keys(spark, monkeypatch):
    """Two keys of many rows, one of them null: the pairs of an ordinary join, inner and left, dealt to more tasks than there are keys."""
    from helixlake.operators import joins

    monkeypatch.setattr(joins, "PAIRS", 50)
    monkeypatch.setattr(joins, "TASK_PAIRS", 100)
    left = spark.range(120).selectExpr("if(id % 7 = 0, null, if(id < 100, 'a', cast(id as string))) as k", "id as x")
    right = spark.range(60).selectExpr("if(id % 9 = 0, null, if(id < 50, 'a', cast(id + 60 as string))) as k", "id as y")
    for how in ("inner", "left"):
        got, want = joins.spread(left, right, ["k"], how), left.join(right, "k", how)
        assert sorted(map(tuple, got.select("k", "x", "y").collect()), key=str) == sorted(map(tuple, want.select("k", "x", "y").collect()), key=str)
    assert joins.spread(left, right, ["k"]).where("k = 'a'").groupBy(F.spark_partition_id()).count().count() > 4
    assert joins.spread(left, right.where("false"), ["k"], "left").count() == 120


def test_equal_pairs_are_aligned_once(spark):
    """A file of one task is dealt to several, and a worker aligns equal pairs once."""
    Q.known_variants.cache_clear()
    ref, query = "ACDEFGHIKLMNPQRSTVWY", "ACDEFGHIKLMNPQRSTVWA"
    assert Q.known_variants(ref, query) == Q.known_variants(ref, query) == ((20, "Y", "A", "substitution"),) and Q.known_variants.cache_info().misses == 1
    pairs = spark.range(9).coalesce(1).selectExpr("cast(id as string) as genome_accession", "'G' as gene", f"'{ref}' as ref", f"'{query}' as query")
    out = Q.call_variants(pairs)
    assert out.select(F.spark_partition_id().alias("p"), "genome_accession").groupBy("p").count().count() > 1
    assert sorted(map(tuple, out.collect())) == [(str(i), "G", 20, "Y", "A", "substitution") for i in range(9)]

"""Trees, full text, greedy merging, manifests, compaction, origins and labels against plain loops."""

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from helixlake.operators import evidence as E
from helixlake.operators import extraction as X
from helixlake.operators import fulltext, joins, trees
from helixlake.operators import mining as M
from helixlake.plans import views as V
from helixlake.sources import readers
from helixlake.sources.manifest import Catalogue, Conflict
from helixlake.streaming.catalogue import append_catalogue, compact_catalogue, read_catalogue

NODES = "tree_id string, node int, parent int, length double, label string, rooted boolean"


# --- trees ---------------------------------------------------------------------------------------------------------------------


def random_tree(rng, tree, n, shape="any"):
    rows = [(tree, 0, None, 0.0, "", False)]
    for i in range(1, n):
        parent = {"any": rng.randrange(i), "line": i - 1, "star": 0}[shape]
        rows.append((tree, i, parent, rng.randint(0, 8) / 4, f"n{i:04}", False))
    return rows


def plain_paths(rows):
    parent = {n: (p, d) for _, n, p, d, _, _ in rows}
    inner = {p for _, _, p, *_ in rows}
    tips = {n: label for _, n, _, _, label, _ in rows if n not in inner and label}

    def up(n):
        out, far = {n: 0.0}, 0.0
        while parent[n][0] is not None:
            far, n = far + parent[n][1], parent[n][0]
            out[n] = far
        return out

    ways = {n: up(n) for n in tips}
    dist = {(a, b): min(ways[a][x] + ways[b][x] for x in ways[a] if x in ways[b]) for a in tips for b in tips}
    return tips, ways, dist


@pytest.fixture(scope="module")
def forest():
    rng = random.Random(4)
    out = [random_tree(rng, f"t{i}", rng.randint(2, 25)) for i in range(6)] + [random_tree(rng, "line", 40, "line"), random_tree(rng, "star", 60, "star")]
    out.append([(t, n, p, d, label, True) for t, n, p, d, label, _ in random_tree(rng, "rooted", 20)])
    out.append([("one", 0, None, 0.0, "only", False)])
    return out


@pytest.mark.parametrize("hot", [False, True])
def test_midpoint_roots_and_rooted_trees(spark, forest, monkeypatch, hot):
    if hot:  # every key of more than two rows is looked up as a hot one
        monkeypatch.setattr(joins, "HOT_ROWS", 2)
        monkeypatch.setattr(joins, "HOT_SHARE", 10**9)
    got = {(r["tree_id"], r["tip"]): r["root_distance"] for r in trees.root_distances(spark.createDataFrame([x for t in forest for x in t], NODES)).collect()}
    want = {}
    for rows in forest:
        tips, ways, dist = plain_paths(rows)
        most = max(dist.values())
        for n, label in tips.items():
            root = max(ways[n].values())
            want[rows[0][0], label] = root if rows[0][5] or len(tips) < 2 else max(dist[n, m] for m in tips) - most / 2
    assert got == pytest.approx(want)


def test_nearest_tips_are_those_of_all_path_sums(spark, forest):
    df = spark.createDataFrame([x for t in forest for x in t], NODES)
    samples = df.where("label <> '' and node % 3 <> 1").select("tree_id", "label")
    got = sorted((r["tree_id"], r["sample"], r["place"], r["tip"], r["distance"]) for r in trees.nearest_tips(df, samples, 4).collect())
    want = []
    for rows in forest:
        tips, _, dist = plain_paths(rows)
        for n, label in tips.items():
            if n % 3 != 1:
                near = sorted((dist[n, m], other) for m, other in tips.items() if m != n)[:4]
                want += [(rows[0][0], label, i, other, d) for i, (d, other) in enumerate(near, 1)]
    assert got == sorted(want)


def test_trees_of_nothing(spark):
    empty = spark.createDataFrame([], NODES)
    assert trees.root_distances(empty).count() == 0
    assert trees.nearest_tips(empty, empty.select("tree_id", "label")).count() == 0


def test_newick_nodes_quotes_and_rootedness(spark):
    texts = [("a", "(('O''Brien':1,B:2)x:0.5,C:3);"), ("b", "[&R] (A:1,B:5);"), ("c", None), ("d", "(A:1,B:5);"), ("e", "((A:1,B:1):1,C:6);")]
    nodes = readers.newick_nodes(spark.createDataFrame(texts, "tree_id string, newick string"))
    rooted = {r["tree_id"]: r["rooted"] for r in nodes.collect()}
    assert rooted == {"a": False, "b": True, "c": False, "d": False, "e": False}
    got = {(r["tree_id"], r["tip"]): r["root_distance"] for r in trees.root_distances(nodes).collect()}
    # B and C are 5.5 apart, so the root is 2.75 from either: on C's edge, 0.25 from the old one
    assert (got["a", "O'Brien"], got["a", "B"], got["a", "C"]) == (1.75, 2.75, 2.75)
    assert (got["b", "A"], got["b", "B"], got["d", "A"], got["d", "B"]) == (1, 5, 3, 3)
    assert (got["e", "A"], got["e", "B"], got["e", "C"]) == (4, 4, 4)  # the path of 8 from A to C, halved
    assert "O'Brien" in {r["tip"] for r in readers.newick_tips(spark.createDataFrame(texts, "tree_id string, newick string")).collect()}


# --- full text -----------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    ("word", "stem"),
    [("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("gas", "gas"), ("virus", "virus"), ("boss", "boss"), ("feed", "feed"), ("agreed", "agree"), ("plastered", "plaster"), ("bled", "bled"), ("motoring", "motor"), ("sing", "sing"),
     ("conflated", "conflate"), ("troubling", "trouble"), ("sized", "size"), ("hopping", "hop"), ("falling", "fall"), ("hissing", "hiss"), ("fizzed", "fizz"), ("filing", "file"), ("hoping", "hope"), ("binding", "bind"), ("happy", "happi"), ("by", "by"), ("say", "say"), ("cry", "cri"), ("receptors", "receptor")],
)
def test_stems(spark, word, stem):
    assert spark.createDataFrame([(word,)], "w string").select(fulltext.stem(F.col("w"))).first()[0] == stem


def test_index_and_scan_agree(spark, monkeypatch):
    monkeypatch.setattr(fulltext, "CHUNK", 8)  # frequent words in many chunks
    rng = random.Random(2)
    vocabulary = ["binding", "binds", "bound", "receptor", "receptors", "the", "and", "viruses", "virus", "host", "hosts", "hosted"]
    docs = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 6)))) for i in range(150)] + [(900, None), (901, ""), (None, "receptor"), (5, "host"), (902, "Receptor-Binding; RECEPTORS!")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    index = fulltext.build(df, "doc_id", "text")
    assert index.postings.agg(F.max(F.size("ids"))).first()[0] <= 24
    stems = {r["w"]: r["s"] for r in spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", fulltext.stem(F.col("w")).alias("s")).collect()}
    held = {}
    for i, t in docs:
        if i is not None:
            held.setdefault(i, set()).update(stems[w] for w in (t or "").lower().replace("-", " ").replace(";", " ").replace("!", " ").split() if w not in fulltext.STOP_WORDS)
    for asked in ("binding receptors", "host", "hosting of viruses", "receptor binding hosts", "bound", "absent receptor", "the and", "", "!!"):
        terms = {r[0] for r in spark.createDataFrame([(asked,)], "q string").select(F.explode(fulltext.words(F.col("q"))).alias("w")).select(fulltext.stem(F.col("w"))).collect()}
        want = sorted(i for i, s in held.items() if terms and terms <= s)
        assert sorted(r["id"] for r in index.search(asked).collect()) == want, asked


def test_index_of_nothing(spark):
    index = fulltext.build(spark.createDataFrame([], "doc_id long, text string"), "doc_id", "text")
    assert index.search("receptor").count() == 0 and index.terms.count() == 0


# --- greedy merging ------------------------------------------------------------------------------------------------------------


def plain_merge(rows):
    kept, out = {}, []
    for row in sorted(rows, key=lambda r: r[2]):
        country, year, _, c, d = row
        if country is None or year is None:
            out.append(row)
            continue
        same = False
        for kc, kd in kept.setdefault((country, year), []):
            if kc is None or c is None:
                same = kc == c and kd == d
            else:
                same = abs(kc - c) <= int(kc * 0.02) and (abs(kd - d) if kd is not None and d is not None else 0) <= (int(kd * 0.02) if kd is not None else 0)
            if same:
                break
        if not same:
            kept[country, year].append((c, d))
            out.append(row)
    return sorted(out, key=str)


SEASON = "country string, year int, ordinal long, cases long, deaths long"


def test_greedy_merging_is_that_of_a_plain_loop(spark):
    rng = random.Random(12)
    rows = [(rng.choice("AB"), rng.choice([2000, 2001]), i, rng.choice([None, 0, 3, 49, 50, 51, rng.randint(900, 1100), int(1000 * 1.019 ** rng.randint(0, 40))]), rng.choice([None, 0, 7, rng.randint(95, 105)])) for i in range(500)]
    rows += [(None, 2000, 900, 5, 5), ("A", None, 901, 5, 5), (None, 2000, 902, 5, 5)]
    rng.shuffle(rows)
    got = sorted(map(tuple, M.similar_outbreaks(spark.createDataFrame(rows, SEASON)).collect()), key=str)
    assert got == plain_merge(rows)


def test_greedy_merging_of_a_hot_season(spark):
    """One country and year with twenty thousand reports in one chain, repeated counts among them."""
    rng = random.Random(13)
    rows = [("A", 2000, i, rng.randint(1000, 9000), rng.randint(0, 400)) for i in range(6000)]
    got = sorted(map(tuple, M.similar_outbreaks(spark.createDataFrame(rows, SEASON)).collect()), key=str)
    assert got == plain_merge(rows)
    assert M.similar_outbreaks(spark.createDataFrame([], SEASON)).count() == 0


# --- manifests -----------------------------------------------------------------------------------------------------------------


def test_refreshes_are_seen_together_or_not_at_all(spark, tmp_path):
    there = Catalogue(spark, f"file://{tmp_path}/cat")
    assert there.manifest() == {} and there.numbers() == []
    make = lambda n: lambda c: spark.range(n).withColumnRenamed("id", "v")
    assert there.refresh([("a", make(3)), ("b", lambda c: c.pending("a").selectExpr("v + 10 as v"))]) == 1
    held = there.read("b")

    def fail(c):
        raise ValueError("no")

    with pytest.raises(ValueError):
        there.refresh([("a", make(5)), ("b", fail)])
    assert there.numbers() == [1] and there.read("a").count() == 3
    assert len(list((tmp_path / "cat/tables/a").iterdir())) == 1  # what was written of the failed one is gone
    assert there.refresh([("a", make(5))]) == 2
    assert there.read("a").count() == 5 and there.read("b").count() == 3 and there.read("a", 1).count() == 3
    assert sorted(r["v"] for r in held.collect()) == [10, 11, 12]
    there.refresh([("a", make(7))])
    gone = there.sweep(keep=1)
    assert len(gone) == 2 and there.numbers() == [3] and there.read("a").count() == 7 and there.read("b").count() == 3


def test_publishers_that_cross_do_not_lose_tables(spark, tmp_path):
    one, two = (Catalogue(spark, f"file://{tmp_path}/cat") for _ in range(2))
    a, b = one.write(spark.range(1), "a"), two.write(spark.range(2), "b")
    numbers, real = one.numbers, two.publish
    calls = []

    def late():  # between looking and renaming, the other one publishes
        found = numbers()
        if not calls:
            calls.append(real({"b": b}))
        return found

    one.numbers = late
    one.publish({"a": a})
    assert set(two.manifest()) == {"a", "b"} and two.numbers() == [1, 2]
    with pytest.raises(Conflict):
        two.publish({"a": b}, {"a": "elsewhere"})


def test_compaction_changes_no_reader(spark, tmp_path):
    from tests.test_catalogue import SCHEMA

    row = lambda i: ("p", "s", "g", i % 2, None, "V", "t", "h", f"a{i}", dt.date(2020, 1, 1 + i), f"c{i % 3}", None if i == 3 else "l")

    def run(ids, checkpoint="one"):
        if ids:
            spark.createDataFrame([row(i) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        append_catalogue(stream, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}").awaitTermination()

    read = lambda: sorted((r["position"], r["genome_count"], r["first_seen"], r["last_seen"], r["countries"], r["lineages"]) for r in read_catalogue(spark, f"{tmp_path}/out").collect())
    run([0, 1, 2])
    first = read()
    assert compact_catalogue(spark, f"{tmp_path}/out") == 1 and read() == first
    assert compact_catalogue(spark, f"{tmp_path}/out") is None
    run([0, 3, 4])
    run([5])
    grown = read()
    assert grown != first
    there = Catalogue(spark, f"{tmp_path}/out/_compacted")
    there.write(spark.range(3), "state")  # a crash between write and rename leaves a table that no manifest names
    assert read() == grown and compact_catalogue(spark, f"{tmp_path}/out", delete=True) == 2 and read() == grown
    assert not list((tmp_path / "out").glob("query=*/batch=*"))
    run([], "two")  # another query reads everything once more, and is compacted too
    assert read() == grown and compact_catalogue(spark, f"{tmp_path}/out") == 3 and read() == grown
    assert len(there.sweep(keep=1)) == 3


# --- associations in chunks ----------------------------------------------------------------------------------------------------


def test_phenotype_join_in_chunks_matches_plain_loop(spark, monkeypatch):
    from tests.test_whole import test_phenotype_join_matches_plain_loop

    monkeypatch.setattr(V, "CHUNK", 2)
    test_phenotype_join_matches_plain_loop(spark)


# --- evidence ------------------------------------------------------------------------------------------------------------------


def test_scenarios_of_every_branch(spark):
    rows = [(c, o, g) for c in ("Mali", "mali", "", None) for o in ("Mali", "Chad", "", None) for g in (None, -5, 10, 365, 366, 4000)]
    got = Counter()
    for r in E.spread_scenarios(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "sample_id int, country string, origin_country string, gap_days int")).collect():
        got[r["sample_id"], r["scenario"]] = r["points"]
    want = Counter()
    for i, (c, o, g) in enumerate(rows):
        if c and o:
            want[i, "new_introduction"] += 3 * (c.lower() != o.lower())
            want[i, "re_emergence"] += 3 * (g is not None and g > 365)
            want[i, "local_persistence"] += (g is not None and g <= 365) + 2 * (c.lower() == o.lower())
    assert +got == +want


def test_labels_of_every_branch(spark):
    order = list(dict.fromkeys(c for c, *_ in E.CRITERIA))
    rng = random.Random(3)
    scores = [(i, c, rng.choice([0, 1, 2, 3, 4, 5])) for i in range(200) for c in rng.sample(order, rng.randint(0, 5))]
    tiers = [(i, rng.choice(E.RISK_TIERS)) for i in range(220) if i % 7]
    got = {r["sample_id"]: (r["label"], r["top"]) for r in E.tier_of_scores(spark.createDataFrame(scores, "sample_id int, criterion string, score int"), spark.createDataFrame(tiers, "sample_id int, tier string")).collect()}
    of = dict(tiers)
    for i, (label, top) in got.items():
        own = {c: s for j, c, s in scores if j == i}
        most, elevated, tier = max([0, *own.values()]), sum(s >= 3 for s in own.values()), E.RISK_TIERS.index(of.get(i, "routine")) + 1
        want = "high_priority" if most >= 4 and elevated >= 2 and tier >= 4 else "investigate" if most >= 4 or (elevated >= 2 and tier >= 3) else "monitor" if most >= 3 or tier >= 2 else "routine"
        assert (label, top) == (want, ",".join(c for c in sorted(own, key=lambda c: (-own[c], order.index(c)))[:3] if own[c] > 0)), i
    assert set(of) <= set(got)


def test_assertions_count_as_findings(spark):
    found = spark.createDataFrame([(1, "other", "This is Continued Circulation of it"), (2, "x", "a RE-EMERGENCE after years"), (3, "x", None)], "sample_id int, finding_type string, assertion string")
    got = sorted((r["sample_id"], r["criterion"], r["score"]) for r in E.criterion_scores(found).collect())
    assert got == [(1, "local_transmission", 1), (2, "local_transmission", 1), (2, "surveillance_priority", 2)]


def test_origins_fall_back_in_order(spark):
    day = lambda n: dt.date(2020, 1, n)
    samples = spark.createDataFrame([(i, "Mali", day(20), lineage) for i, lineage in enumerate(["L1", "L1", "l2 ", "L3", "L4", None])], "sample_id int, country string, date date, lineage_id string")
    tips = [(0, 1, None, day(9)), (0, 2, "B", day(5)), (0, 3, "A", day(2)), (0, 4, "B", None), (0, 5, "A", day(2)), (0, 6, "C", day(7))]
    tips = spark.createDataFrame(tips + [(1, 1, "", day(1))], "sample_id int, place int, country string, date date")
    lineages = spark.createDataFrame([("L1", "F", ["R"]), ("L2", "", ["R", "S"]), ("L3", None, [])], "lineage_id string, first_country string, countries_reported array<string>")
    genomes = spark.createDataFrame([("L3", "X"), ("L3", "Y"), ("L3", "Y "), ("L3", None), (None, "Z")], "lineage_id string, country string")
    got = {r["sample_id"]: (r["origin"], r["confidence"], r["method"], r["support"], r["routes"], r["gap_days"]) for r in E.origin_evidence(samples, tips, lineages, genomes).collect()}
    assert got == {
        0: ("B", "high", "nearest_tree_tips", "B:0.400,A:0.400,C:0.200", "A -> B; B -> C", 13), 1: ("F", "medium", "first_country_detected_curated", "F", "", None), 2: ("R", "low", "countries_reported_list", "R,S", "", None),
        3: ("Y", "low", "most_common_collection_country", "Y:0.667,X:0.333", "", None), 4: ("", "low", "", "", "", None), 5: ("", "low", "", "", "", None),
    }


def test_shared_lists_are_stored_once(spark):
    v = spark.createDataFrame([("s1", "a", "h1", "k"), ("s2", "b", "h2", "k"), ("s3", None, "h3", "x"), ("s4", "c", "h4", "k")], "sample_id string, lineage_id string, hgvs_p string, phenotype_key string")
    p = spark.createDataFrame([("k", "P")], "phenotype_key string, phenotype string")
    o = spark.createDataFrame([("o1", "a"), ("o2", "a"), ("o2", "c"), ("o1", "c"), ("o3", "z")], "outbreak string, lineage_id string")
    samples, lists = E.harmonise(v, p, o)
    keys = {r["sample_id"]: r["list_key"] for r in samples.collect()}
    assert keys["s1"] == keys["s4"] != keys["s2"] == keys["s3"]
    held = {}
    for r in lists.collect():
        held.setdefault(r["list_key"], []).append(r["outbreak"])
    assert sorted(held[keys["s1"]]) == ["o1", "o2"] and sorted(held[keys["s2"]]) == ["o1", "o2", "o3"] and sorted(map(len, held.values())) == [1, 2, 3]


def test_matching_takes_the_first_way(spark):
    v = [("s", "sp", "g", 5, "A", "v", "Receptor site"), ("s", "sp", "G ", 9, "K", "R", None), ("t", "sp", "g", 7, "F", "L", ""), ("u", "xx", "g", 5, "A", "V", "receptor")]
    a = [("exact", "sp", "G", 5, "V", "motif: receptor", "p.Ala5Val"), ("motif", "sp", "g", None, "", "Motif: RECEPTOR, of it", None), ("domain", "sp", "g", 5, None, "domain: the receptor site here", None), ("noted", "sp", "g", None, None, "none", "p.Lys9Arg"),
         ("short", "sp", "g", 1, "X", None, "p.F7L"), ("gene", "sp", "G", None, None, None, "nonsense"), ("other", "sp", "h", None, None, "motif: receptor", None), ("flagged", "sp", None, None, None, None, None)]
    got = {(r["sample_id"], r["association_id"]): r["way"] for r in E.match_phenotypes(spark.createDataFrame(v, "sample_id string, species_id string, gene string, position int, ref_aa string, alt_aa string, domain string"), spark.createDataFrame(a, "association_id string, species_id string, protein string, position int, alt_aa string, description string, notation string")).collect()}
    assert got == {
        ("s", "exact"): "exact", ("s", "motif"): "motif", ("s", "domain"): "motif", ("s", "noted"): "notation", ("s", "gene"): "gene", ("t", "short"): "notation", ("t", "motif"): "gene", ("t", "noted"): "gene", ("t", "gene"): "gene",
    }


def test_matched_pairs_are_not_grouped_again(spark):
    """Pairs of unique ids are made once, by no aggregation over them; an id of several associations still comes once, by its first way."""
    v = spark.createDataFrame([("s", "sp", "g", 5, "A", "V", "site"), ("s", "sp", "g", 5, "K", "V", "site"), ("s", "sp", "g", 6, "A", "V", None)], "sample_id string, species_id string, gene string, position int, ref_aa string, alt_aa string, domain string")
    of = lambda *rows: spark.createDataFrame(list(rows), "association_id string, species_id string, protein string, position int, alt_aa string, description string, notation string")
    one, two, three = ("x", "sp", "g", 5, "V", None, "p.Ala6Val"), ("y", "sp", "g", None, None, "motif: site", "p.Ala5Val"), ("z", "sp", "g", None, None, None, "p.Ala6Val")
    found = E.match_phenotypes(v, of(one, two, three))
    assert sorted(map(tuple, found.collect())) == [("s", "x", "exact"), ("s", "y", "motif"), ("s", "z", "notation")]
    assert "Aggregate" not in found._jdf.queryExecution().optimizedPlan().toString()
    again = E.match_phenotypes(v, of(one, ("x", "sp", "g", None, None, None, None), ("z", "sp", "g", None, None, "motif: site", None), three))
    assert sorted(map(tuple, again.collect())) == [("s", "x", "exact"), ("s", "z", "motif")]


def test_places_in_the_mutation_profile(spark):
    calls = [("s", "L", "g", 1, "A", "A"), ("s", "L", "g", 2, "A", "V"), ("s", "M", "G", 2, "A", "v"), ("s", "L", "g", 3, "A", "V"), ("s", None, "g", 2, "A", "V"), ("s", "L", None, 2, "A", "V"), ("s", "L", "g", None, "A", "V"), ("s", "L", "g", 4, "A", "V")]
    known = [("g", 2, "V", ["L"]), ("g", 4, "V", None)]
    got = [r["significance"] for r in E.significance(spark.createDataFrame([(*c, i) for i, c in enumerate(calls)], "sample_id string, lineage_id string, gene string, position int, ref_aa string, alt_aa string, i int"), spark.createDataFrame(known, "gene string, position int, alt_aa string, lineage_ids array<string>")).orderBy("i").collect()]
    assert got == ["synonymous", "typical", "atypical", "absent", "atypical", "atypical"]


def plain_trim(context, most):
    """As told: the longest list anywhere, of equals the first from the top down, loses its last entry, again and again."""
    import json

    def longest(node):
        best, n = None, 0
        if isinstance(node, list) and len(node) > n:
            best, n = node, len(node)
        for child in node.values() if isinstance(node, dict) else node if isinstance(node, list) else ():
            found, m = longest(child)
            if m > n:
                best, n = found, m
        return best, n

    pops = 0
    while len(json.dumps(context, default=str)) > most and pops < X.MOST_POPS:
        best, n = longest(context)
        if best is None or n <= 1:
            break
        best.pop()
        context["_truncated"] = X.TRUNCATED
        pops += 1
    return context


def test_documents_are_trimmed_as_by_walking_them_anew(spark):
    import json

    rng = random.Random(21)

    def value(depth):
        kind = rng.random()
        if depth and kind < 0.4:
            return [value(depth - 1) for _ in range(rng.choice([0, 1, 2, 5, 9]))]
        if depth and kind < 0.7:
            return {f"k{i}": value(depth - 1) for i in range(rng.randint(0, 4))}
        return rng.choice([1, 2.5, None, True, "text", "ü\n\"", "x" * rng.randint(0, 30)])

    for _ in range(300):
        doc = {f"a{i}": value(4) for i in range(rng.randint(0, 5))}
        most = rng.choice([0, 50, 200, 600, 5000])
        text = json.dumps(doc)
        assert X.trimmed(json.loads(text), most) == plain_trim(json.loads(text), most)
    df = spark.createDataFrame([(1, json.dumps({"a": list(range(100))})), (2, None), (3, "[1, 2]"), (4, "{}"), (None, '{"a": [1]}')], "doc long, document string")
    got = {r["doc"]: r["document"] for r in X.trimmed_documents(df, 150).collect()}
    assert got[2] is None and got[3] == "[1, 2]" and got[4] == "{}" and json.loads(got[1])["_truncated"] == X.TRUNCATED and len(got[1]) <= 150 and json.loads(got[None]) == {"a": [1]}


def test_documents_of_any_depth_are_flattened(spark):
    import json

    deep = {"v": 1}
    for i in range(12):
        deep = {f"l{i}": deep, "w": i}
    got = {r["metric"]: r["value"] for r in X.flat_metrics(spark.createDataFrame([(1, json.dumps(deep))], "id long, document string"), "id").collect()}
    assert len(got) == 13 and got[".".join(f"l{i}" for i in reversed(range(12))) + ".v"] == "1"


def test_grains_count_distinct_genomes(spark):
    """Repeated calls, genomes without calls, null lineages and countries, one genome with most of the calls."""
    genomes = [("p", s, f"{s}{i}", pick, c, 2000 + i % 2, None if i == 3 else dt.date(2000 + i % 2, 1, 1)) for s in "xy" for i in range(9) for pick, c in [((None, "L", "M")[i % 3], (None, "A")[i % 2])]]
    calls = [("p", s, f"{s}{i}", h, "t") for s in "xy" for i in range(6) for h in ("h1", "h2", None)[: i % 4]] + [("p", "x", "x1", "h1", "t")] * 500 + [("p", "x", "x1", "h1", "u")]
    g = spark.createDataFrame(genomes, "pathogen_id string, species_id string, genome_accession string, lineage_id string, collection_country string, collection_year int, collection_date date")
    c = spark.createDataFrame(calls, "pathogen_id string, species_id string, genome_accession string, hgvs_p string, variant_type string")
    got = {}
    for r in V.layers(c, g).collect():
        got[r["grain"], r["species_id"], tuple(r[k] for k in V.GRAINS[r["grain"]])] = r["genomes"]
    want = {}
    for grain, keys in V.GRAINS.items():
        if grain == "mutation":
            seen = {(s, a, h, t) for _, s, a, h, t in calls if h is not None}
            for s, _, h, t in seen:
                want[grain, s, (h, t)] = want.get((grain, s, (h, t)), 0) + 1
        else:
            for _, s, _, lineage, country, year, _ in genomes:
                key = (grain, s, tuple({"lineage_id": lineage, "collection_country": country, "collection_year": year}[k] for k in keys))
                want[key] = want.get(key, 0) + 1
    assert got == want


def test_functions_in_sql(spark):
    from helixlake.functions import scalars as S
    from helixlake.functions.sql import register
    from helixlake.operators.sequence import variants

    register(spark)
    register(spark)  # again, in the same session
    texts = ["p.Ala82Val", "p.A82V", "p.A82*", "p.Xyz1Ala", "A82V", "", None, "p.A99999999999V", "p.ala5val"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = spark.sql("SELECT t, parse_hgvs(t) AS m FROM {df}", df=df).collect()
    want = df.select("t", S.parse_protein_change(F.col("t")).alias("m")).collect()
    assert [r["m"] and tuple(r["m"]) for r in got] == [r["m"] and tuple(r["m"]) for r in want]
    assert [r[0] for r in spark.sql("SELECT cfr(c, d) FROM VALUES (200D, 77D), (0D, 0D), (5D, 6D), (NULL, 1D), (3D, 1D) AS t(c, d)").collect()] == [38.5, None, None, None, 33.33]
    ref = "ACDEFGHIKL" * 12
    query = ref[:50] + "W" + ref[51:]
    pairs = spark.createDataFrame([(1, ref, query), (2, ref, ref), (3, None, query), (4, ref, None)], "id int, ref string, query string")
    got = sorted(tuple(r) for r in spark.sql("SELECT id, v.* FROM {pairs}, LATERAL call_variants(ref, query) v", pairs=pairs).collect())
    assert got == sorted((i, *v) for i, r, q in [(1, ref, query), (2, ref, ref), (3, "", query), (4, ref, "")] for v in variants(r, q))


# --- knowledge gaps ------------------------------------------------------------------------------------------------------------


def plain_gaps(sample, reported, outbreaks, transmission):
    told = sorted((r for r in reported if r[0] is not None and r[0] == sample["sample_id"] and r[3]), key=lambda r: r[1:])
    gaps = list(dict.fromkeys(r[3] for r in told))
    gaps += [gap for c, gap in E.RECORD_GAPS if not str(sample[c] or "").strip()]
    gaps += [gap for gap, known in ((E.NO_OUTBREAKS, outbreaks), (E.NO_TRANSMISSION, transmission)) if sample["species_id"] not in known or sample["species_id"] is None]
    if not sample["tree_file"] and not sample["placement"]:
        gaps.append(E.NO_TREE)
    elif not sample["time_scaled_tree"]:
        gaps.append(E.NO_TIMES)
    return gaps + [E.NO_REFERENCE] * (not sample["closest_reference"])


def test_gap_report_matches_plain_loop(spark):
    """Nulls and blanks in any column, repeated and equal gaps, one hot sample, equal sample rows, an analysis that says a gap of the record."""
    rng = random.Random(9)
    names = ["sample_id", "species_id", "collection_date", "country", "suspected_exposure", "travel_history", "tree_file", "placement", "time_scaled_tree", "closest_reference"]
    some = lambda *of: rng.choice([None, "", " ", *of, *of])
    rows = [(None if i == 7 else f"s{i % 50}", some("a", "b", "c"), *[some("x", "y") for _ in names[2:]]) for i in range(60)]
    reported = [(None if i % 97 == 0 else "s3" if i % 2 else f"s{rng.randrange(60)}", rng.randrange(4), some("p", "q") or "", some("g1", "g2", "g3", E.RECORD_GAPS[0][1])) for i in range(600)]
    schema = ", ".join(f"{n} string" for n in names)
    of = lambda xs: spark.createDataFrame([(x,) for x in xs], "species_id string")
    samples, told = spark.createDataFrame(rows, schema), spark.createDataFrame(reported, "sample_id string, analysis int, place string, gap string")
    got = E.gap_report(samples, told, of(["a", "a", None, ""]), of(["b"])).collect()
    want = [(r[0], plain_gaps(dict(zip(names, r, strict=True)), reported, {"a", ""}, {"b"})) for r in rows]
    assert sorted(((r["sample_id"], r["gaps"]) for r in got), key=repr) == sorted(want, key=repr)
    assert all(r["gap_count"] == len(r["gaps"]) and r["summary"] == f"Knowledge gaps: {len(r['gaps'])} cross-cutting gaps identified." for r in got)
    assert E.gap_report(samples.where("false"), told, of([]), of([])).count() == 0
    assert E.gap_report(samples, told.where("false"), of([]), of([])).count() == 60

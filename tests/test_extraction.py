"""Extraction operators against plain loops, and their edge cases."""

import random

from pyspark.sql import functions as F

from helixlake.operators import evidence as E
from helixlake.operators import extraction as X
from helixlake.operators import mining as M

DOCS = "ordinal long, url string, country string, year int, text string"


def test_budget_matches_plain_loop(spark):
    rng = random.Random(6)
    docs = {d: [["x" * rng.randint(1, 9) for _ in range(rng.randint(0, 7))] for _ in range(3)] for d in range(40)}
    rows = [(d, i, k, x) for d, lists in docs.items() for i, items in enumerate(lists) for k, x in enumerate(items, 1)]
    got = {}
    for r in X.within_budget(spark.createDataFrame(rows, "doc long, list_no int, place int, item string"), 50).collect():
        got.setdefault((r["doc"], r["list_no"]), []).append(r["place"])
    for d, lists in docs.items():
        left = [list(x) for x in lists]
        while sum(len(x) + 2 for items in left for x in items) > 50:
            longest = max(left, key=len)
            if len(longest) <= 1:
                break
            longest.pop()
        for i, items in enumerate(left):
            assert sorted(got.get((d, i), [])) == list(range(1, len(items) + 1))


def test_reports_without_texts_tell_nothing(spark):
    docs = spark.createDataFrame([(1, "u", None, None, None), (2, None, "Mali", None, ""), (3, "v", "Mali", 2001, "plain")], DOCS)
    assert X.transmission_parameters(docs).count() == X.people(docs).count() == X.products(docs).count() == 0
    assert [tuple(r) for r in X.surveillance(docs).collect()] == [("Mali", "Africa", 2001, None, None, None, "v")]
    none = docs.where("false")
    assert X.transmission_parameters(none).count() == X.surveillance(none).count() == X.people(none).count() == 0


def test_the_first_report_names_the_source(spark):
    docs = spark.createDataFrame([(5, "late", None, None, "R0: 1.8"), (2, "early", None, None, "r0: 1.8, airborne"), (3, "x", None, None, "The reproductive number - 2.5")], DOCS)
    got = {(r["parameter"], r["value"], r["source_url"]) for r in X.transmission_parameters(docs).collect()}
    assert got >= {("R0", "1.8", "early"), ("main transmission route", "airborne (not primary)", "early")}


def test_origins_by_fallback(spark):
    rows = [(1, ["Mali", "Mali", "Chad"], "F", ["R"], "C"), (2, [None, ""], None, [], None), (3, ["Mali"], None, None, None), (4, [], "", ["R"], "C")]
    got = {r["sample_id"]: (r["origin"], r["confidence"], r["by"]) for r in X.origin(spark.createDataFrame(rows, "sample_id long, tip_countries array<string>, first_country string, countries_reported array<string>, common_country string")).collect()}
    assert got == {1: ("Mali", "high", "nearest_tips"), 2: (None, None, None), 3: ("Mali", "medium", "nearest_tips"), 4: ("R", "low", "reported")}


def test_countries_by_any_spelling(spark):
    names = ["Mali", "Niger", "Nigeria"]
    texts = ["In Nigeria, then Mali", "Somalia only", "cases in the DRC and Mali", "DRC_2 and xDRC, Niger", "Congo, The Democratic Republic of the; Mali", None, ""]
    want = ["Nigeria", None, "Democratic Republic of the Congo", "Niger", "Democratic Republic of the Congo", None, None]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    assert [r[0] for r in df.orderBy("id").select(M.earliest_country(F.col("text"), names)).collect()] == want


def test_deep_documents(spark):
    df = spark.createDataFrame([(1, '{"a":{"b":{"c":{"d":{"e":1}}}},"l":[],"n":null,"t":[null,"x"]}'), (2, None), (3, "not json"), (4, "{}")], "id long, document string")
    got = {(r["id"], r["metric"]): r["value"] for r in X.flat_metrics(df, "id").collect()}
    assert got == {(1, "a.b.c.d.e"): "1", (1, "l"): "", (1, "n"): "", (1, "t"): "None; x"}


def test_few_outbreaks(spark):
    """Fewer outbreaks with cases than are asked for, and none at all."""
    samples = spark.createDataFrame([("s", "Chad", 1990)], "sample string, country string, year int")
    outbreaks = spark.createDataFrame([(1, None, None, 3)], "outbreak long, country string, year int, cases int")
    assert [tuple(r) for r in E.comparative_outbreaks(samples, outbreaks).collect()] == [("s", 1, 0.5)]
    assert E.comparative_outbreaks(samples, outbreaks.where("false")).count() == 0

"""Findings, small values, citations and questions against plain Python; lineage scans; tables rebuilt under a manifest."""

import json

import pytest
from pyspark.sql.utils import AnalysisException

from helixlake.operators import reporting as R
from helixlake.sources import readers
from helixlake.sources.manifest import Catalogue, Conflict


def plain_small(text):
    if text is None:
        return "null"
    try:
        value = json.loads(text)
    except ValueError:
        return None
    if isinstance(value, list) and len(value) > 5:
        return None
    if isinstance(value, dict):
        return json.dumps(dict(list(value.items())[:10]), separators=(",", ":"))
    return text.strip()


def test_small_values(spark):
    long = json.dumps({f"k{(i * 7) % 12}": [i, {"a": "x"}] for i in range(12)}, separators=(",", ":"))
    texts = [None, "null", "1.25", '"a \\"b"', "true", "[]", "[1,2,[3,4,5,6,7,8]]", "[1,2,3,4,5]", "[1,2,3,4,5,6]", "{}", '{"b":1,"a":null}', long, "{oops", "", " [1] "]
    rows = spark.createDataFrame([("a", str(i), t) for i, t in enumerate(texts)] + [("evidence_weighted_threat", "x", "1"), (None, "y", "2")], "analysis string, metric string, value string")
    got = {r["metric"]: r["value"] for r in R.small_metrics(rows).collect()}
    assert got == {str(i): plain_small(t) for i, t in enumerate(texts) if plain_small(t) is not None} | {"y": "2"}


def test_findings_keep_the_first_and_lose_empty_fields(spark):
    schema = "analysis string, place long, assertion string, refs array<string>, score double"
    rows = [("hot", i, f"f{i}", [] if i % 2 else ["r"], None if i % 3 else 0.0) for i in range(500)] + [(None, 1, "", None, 1.0), ("tie", 1, "b", None, None), ("tie", 1, "a", None, None), ("tie", 1, "a", None, None), ("evidence_weighted_threat", 1, "x", None, None)]
    got = R.compact_findings(spark.createDataFrame(rows, schema).repartition(7)).collect()
    hot = sorted((r["place"], r["finding"], r["findings"]) for r in got if r["analysis"] == "hot")
    want = [(i, json.dumps({"assertion": f"f{i}"} | ({} if i % 2 else {"refs": ["r"]}) | ({} if i % 3 else {"score": 0.0}), separators=(",", ":")), 500) for i in range(20)]
    assert hot == want
    assert [(r["finding"], r["findings"]) for r in got if r["analysis"] is None] == [('{"score":1.0}', 1)]
    assert sorted(r["finding"] for r in got if r["analysis"] == "tie") == ['{"assertion":"a"}', '{"assertion":"a"}', '{"assertion":"b"}']
    assert {r["analysis"] for r in got} == {"hot", "tie", None}
    assert R.compact_findings(spark.createDataFrame([], schema)).count() == 0


def test_citations(spark):
    analyses = spark.createDataFrame([("a",), ("a",), (None,), ("evidence_weighted_threat",)], "analysis string")
    found = spark.createDataFrame([("s", "t", ["r", None, ""]), (None, "", None), ("s", None, ["r"])], "source string, finding_type string, supporting_refs array<string>")
    cross = spark.createDataFrame([("b", i, f"m{i}", "" if i else "own", "title") for i in range(30)], "block string, place long, metric string, source string, title string")
    phenotypes = spark.createDataFrame([(["r", "q"],), (None,)], "literature_refs array<string>")
    got = {(r["kind"], r["key"]): r["n"] for r in R.citation_catalogue(analyses, found, cross, phenotypes).collect()}
    want = {("analysis_names", "a"): 1, ("source_fields", "s"): 2, ("source_fields", "t"): 1, ("source_fields", "own"): 1, ("source_fields", "title"): 19, ("literature_refs", "r"): 3, ("literature_refs", "q"): 1}
    assert got == want | {("cross_evidence_metric_names", f"m{i}"): 1 for i in range(20)}


def test_questions(spark):
    schema = "sample_id string, species_id string, species_name string, pathogen_family string, lineage string, country string, collection_date string, lineage_last_seen int"
    rows = [("full", "S", "Sp", "fam", "L1", "Mali", "2020-01-02", 2019), ("bare", "novel", "Sp", "fam", None, None, None, None), ("unknown", "S", "Sp", "fam", "unknown", None, "2020-01-02", None)]
    got = {(r["sample_id"], r["question_id"].split("_")[0]): r["question"] for r in R.conditional_questions(spark.createDataFrame(rows, schema)).collect()}
    asked = lambda s: {q for i, q in got if i == s}
    every = {f"Q{i}" for i in range(1, 15)}
    assert asked("full") == every - {"Q11"} and asked("bare") == every - {"Q9", "Q10"} and asked("unknown") == every - {"Q9", "Q11"}
    assert got["full", "Q2"].startswith("For lineage L1 of Sp,") and got["bare", "Q2"] == got["unknown", "Q2"] == "What is the known epidemiological profile of Sp?"
    assert got["unknown", "Q7"].startswith("Has lineage unknown been") and got["bare", "Q7"].startswith("What clinical features")
    assert "last documented in 2019" in got["full", "Q10"] and got["unknown", "Q10"].endswith("temporal patterns in Sp emergence are relevant?")
    assert "in the fam family" in got["bare", "Q11"]


def test_lineage_rows_and_errors(spark):
    table = spark.createDataFrame([("p", "s", "a"), ("p", "s", None), ("p", "t", "a"), ("q", "s", "a")], "pathogen_id string, species_id string, lineage_id string")
    assert readers.lineages(table, "p", "s", "a").count() == 1 and readers.lineages(table, "p", "s", "b").count() == 0
    assert readers.lineages(table, "p", "s").count() == 2 == readers.lineages(table, "p", "s", "").count()
    rows = readers.query(spark, "SELECT * FROM {t} WHERE lineage_id <=> :of", tables={"t": table}, of=None)
    assert [r["row"] for r in readers.dict_rows(rows).collect()] == ['{"pathogen_id":"p","species_id":"s","lineage_id":null}']
    with pytest.raises(AnalysisException):
        readers.query(spark, "SELECT * FROM no_such_table")
    with pytest.raises(AnalysisException):
        readers.query(spark, "SELECT :unset").collect()


def test_rebuilt_tables(spark, tmp_path):
    there = Catalogue(spark, f"file://{tmp_path}/cat")
    with pytest.raises(KeyError):
        there.rebuild("a", lambda df: df)
    there.refresh([("a", lambda c: spark.range(6).selectExpr("id % 2 as k", "id as v"))], "k", ("v",))
    held = there.read("a")
    assert there.rebuild("a", lambda df: df.groupBy("k").count(), "k") == 2
    assert held.count() == 6 and sorted(map(tuple, there.read("a").select("k", "count").collect())) == [(0, 3), (1, 3)]
    assert there.rebuild("a", lambda df: df.drop("count")) == 3 and there.read("a").columns == ["k"]
    assert there.rebuild("a", lambda df: df.where("false")) == 4 and there.read("a").count() == 0 and there.read("a").columns == ["k"]

    def late(df):  # another one rebuilds it while this one works
        Catalogue(spark, there.folder).rebuild("a", lambda other: other.selectExpr("k", "1 as late"))
        return df.selectExpr("k", "2 as lost")

    with pytest.raises(Conflict):
        there.rebuild("a", late)
    assert there.read("a").columns == ["k", "late"] and len(list((tmp_path / "cat/tables/a").iterdir())) == 5

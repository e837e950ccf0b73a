"""Variant calls of whole names: nothing of a name is cut, and every part's change and loss is called."""

import re

from helixlake.operators import sequence as Q
from helixlake.plans import registry

FILL = "ACDEFGHIKLMNPQRSTVWY"


def called(spark, folder):
    got = {}
    for r in registry.QUERIES["Q01_call_variants"](spark, folder).collect():
        got.setdefault((r["genome_accession"], r["gene"]), []).append((r["position"], r["ref_aa"], r["alt_aa"], r["variant_type"]))
    return got


def pair(name):
    ref = re.sub("[^A-Z]", "", re.sub("[^A-Za-z]", "", name).upper())
    ref += (FILL * 2)[: max(0, 40 - len(ref))]
    return ref, ref[:9] + ("A" if ref[9] == "W" else "W") + ref[10:29] + ref[30:]


def test_every_part_has_its_change_and_its_loss(spark, sf_dir):
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").collect()
    got = called(spark, sf_dir)
    assert len(got) == len(parts)
    for r in parts:
        ref, _ = pair(r["p_name"])
        assert got[str(r["p_partkey"]), r["p_brand"]] == [(10, ref[9], "A" if ref[9] == "W" else "W", "substitution"), (30, ref[29], "-", "deletion")]


def test_long_names_are_read_whole(spark, tmp_path):
    """A name of 39 to 200 letters, one whose tenth letter is the changed one's, one of a single letter, none and an empty one."""
    names = ["zinc bolt " + FILL * 10, "A" * 9 + "W" + FILL * 2, "steel " + FILL[::-1] * 3, "M" * 39, "M" * 41, "-1 2-", "", None]
    spark.createDataFrame(list(enumerate(names)), "p_partkey long, p_name string").selectExpr("*", "'G' as p_brand").write.parquet(f"{tmp_path}/part.parquet")
    got = called(spark, str(tmp_path))
    want = {(str(i), "G"): Q.variants(*pair(n)) for i, n in enumerate(names) if n is not None}
    assert got == want and all(len(v) == 2 for v in want.values())
    long = pair(names[0])[0]
    assert len(long) == 208 and Q.variants(long, pair(names[0])[1])[-1] == (30, long[29], "-", "deletion")

"""The appended catalogue, alignment and nearest mentions against plain versions."""

import datetime as dt
import random

from helixlake.operators import joins as J
from helixlake.operators import sequence as Q
from helixlake.streaming.catalogue import append_catalogue, read_catalogue

SCHEMA = "pathogen_id string, species_id string, gene string, position int, ref_aa string, alt_aa string, variant_type string, hgvs_p string, genome_accession string, collection_date date, collection_country string, lineage_id string"


def test_streams_append_to_one_catalogue(spark, tmp_path):
    """Batches that repeat a genome, a stream that goes on, and one begun anew with another checkpoint."""
    row = lambda i: ("p", "s", "g", i % 2, None, "V", "t", "h", f"a{i}", dt.date(2020, 1, 1 + i), f"c{i % 3}", None if i == 3 else "l")

    def run(ids, checkpoint):
        spark.createDataFrame([row(i) for i in ids], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        append_catalogue(stream, f"{tmp_path}/out", f"{tmp_path}/{checkpoint}").awaitTermination()
        return {r["position"]: (r["genome_count"], r["first_seen"], r["last_seen"], r["countries"], r["lineages"]) for r in read_catalogue(spark, f"{tmp_path}/out").collect()}

    run([0, 1, 2], "one")
    day = lambda d: dt.date(2020, 1, d)
    want = {0: (3, day(1), day(5), ["c0", "c1", "c2"], ["l"]), 1: (3, day(2), day(6), ["c0", "c1", "c2"], ["l"])}
    assert run([0, 3, 4, 5], "one") == want
    assert run([], "two") == want


def plain_alignment(ref, query):
    """Every cell by its definition, and the way back by equal scores."""
    low, n, m = float("-inf"), len(ref), len(query)
    best, down, right = {}, {}, {}
    sub = lambda i, j: best[i - 1, j - 1] + (Q.MATCH if ref[i - 1] == query[j - 1] else Q.MISMATCH)
    for i in range(n + 1):
        for j in range(m + 1):
            down[i, j] = max(best[i - 1, j] + Q.OPEN, down[i - 1, j] + Q.EXTEND) if i else low
            right[i, j] = max(best[i, j - 1] + Q.OPEN, right[i, j - 1] + Q.EXTEND) if j else low
            best[i, j] = max(sub(i, j) if i and j else low, down[i, j], right[i, j], low if i or j else 0.0)
    out, i, j, state = [], n, m, "best"
    while i or j:
        if state == "best" and i and j and best[i, j] == sub(i, j):
            i, j = i - 1, j - 1
            out.append((ref[i], query[j]))
            continue
        if state == "best":
            state = "down" if i and best[i, j] == down[i, j] else "right"
        if state == "down":
            state = "best" if down[i, j] == best[i - 1, j] + Q.OPEN else "down"
            i -= 1
            out.append((ref[i], "-"))
        else:
            state = "best" if right[i, j] == best[i, j - 1] + Q.OPEN else "right"
            j -= 1
            out.append(("-", query[j]))
    return out[::-1]


def test_alignment_is_that_of_every_cell():
    rng = random.Random(5)
    word = lambda n, letters: "".join(rng.choices(letters, k=n))
    for k in range(300):
        ref = word(rng.randint(0, 40), "AV" if k % 2 else "ACDX")
        query = ref[: rng.randint(0, 40)] + word(rng.randint(0, 25), "AV") + ref[rng.randint(0, 40) :] if k % 3 else word(rng.randint(0, 40), "AV")
        assert Q.align(ref, query) == plain_alignment(ref, query)


def test_long_proteins_are_aligned():
    """Several thousand residues: a byte a cell."""
    rng = random.Random(6)
    ref = "".join(rng.choices("ACDEFGHIKLMNPQRSTVWY", k=3000))
    query = ref[:1000] + "W" + ref[1001:2000] + ref[2010:]
    assert [v for v in Q.variants(ref, query) if v[3] == "deletion"] and len(Q.variants(ref, query)) <= 11


def test_nearest_mentions_match_all_pairs(spark):
    rng = random.Random(7)
    m = [(rng.choice([1, 2, 3, None]), rng.choice(["x", "y"]), rng.randint(0, 12)) for _ in range(60)] + [(1, "z", None)]
    a = [(rng.choice([1, 2, None]), rng.choice(["b", "a", "c"]), rng.randint(0, 12)) for _ in range(14)] + [(2, "d", None), (2, None, 3)]
    got = J.nearest_mention(spark.createDataFrame(m, "doc int, mention string, at long"), spark.createDataFrame(a, "doc int, alias string, at long"), "doc").collect()
    want = set()
    for doc, mention, at in m:
        found = [(abs(at - p), p, n) for d, n, p in a if d == doc and doc is not None and n and p is not None and at is not None]
        if found:
            d, _, n = min(found)
            want.add((doc, mention, at, n, d))
    assert sorted(map(tuple, got)) == sorted(want)

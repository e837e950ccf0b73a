"""Pivot search, prefix trie and Merkle manifest against plain loops, with nulls, ties, repeated rows, empty tables, hot
keys and further columns whose names clash with the operators' own."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helixlake.llm import common, merkle, pivots, trie
from tests.compare import rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def crc(n):
    return zlib.crc32(str(n).encode())


# --- pivots --------------------------------------------------------------------------------------------------------------------


def plain_nearest(vectors, every=pivots.EVERY, k=pivots.K):
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in sound if i % every == 0}):
        own = min(v for i, v in sound if i == q)
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in sound if i != q and len(v) == len(own))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores, 1)]
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 8))
    out = [(i, (centres[i % 6] + 0.2 * rng.standard_normal(8)).tolist()) for i in range(400)]
    out += [(1000 + i, out[7][1]) for i in range(300)]  # one vector, many ids
    out += [(50, out[3][1])] * 9 + [(2000, out[5][1])] * 12  # repeated rows; two vectors of one id
    out += [(3000, None), (3001, [None] * 8), (3002, [math.nan] * 8), (3003, [math.inf] * 8), (None, out[0][1]), (3004, [0.0] * 8), (3050, [0.0] * 8)]
    out += [(3100, [1.0, 2.0]), (3101, [0.5, 1.0]), (3102, [-1.0, 1.0]), (3150, []), (3151, [])]  # of other lengths
    out += [(3200, [1e7] * 8), (3201, [-3e6] * 8)]
    return out


def vector_frame(spark, vectors, parts=3):
    return spark.createDataFrame([(i, v, 1, 2.0, "x") for i, v in vectors], "vec_id long, embedding array<double>, score int, ints double, block string").repartition(parts)


def listed(df, *names):
    return sorted(tuple(r) for r in df.select(*names).collect())


def test_pivots_find_what_a_plain_loop_finds(spark, vectors, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 40)  # many blocks a cell
    monkeypatch.setattr(pivots, "PIVOTS", 7)
    got = listed(pivots.nearest(vector_frame(spark, vectors)), "query_id", "rank", "vec_id", "score")
    assert got == sorted(plain_nearest(vectors))


def test_pivots_of_few_and_no_vectors(spark, vectors):
    assert pivots.nearest(vector_frame(spark, [])).count() == 0
    few = [(0, [1.0, 0.5]), (1, [0.25, 0.5]), (50, [1.0, -1.0])]
    assert listed(pivots.nearest(vector_frame(spark, few)), "query_id", "rank", "vec_id", "score") == sorted(plain_nearest(few))
    assert pivots.nearest(vector_frame(spark, [(0, [1.0])])).count() == 0
    assert pivots.nearest(vector_frame(spark, [(1, None), (50, [math.nan])])).count() == 0


def test_scores_beyond_doubles_are_exact_and_beyond_long_its_end(spark):
    big = [(0, [2.0**22, 1.0]), (1, [2.0**22, 3 / 256]), (2, [2.0**22, 2 / 256]), (3, [1e300, 0.0]), (4, [-1e300, 0.0])]
    got = {r["vec_id"]: r["score"] for r in pivots.nearest(vector_frame(spark, big)).collect()}
    assert got[1] == 2**60 + 768 and got[2] == 2**60 + 512
    assert got[3] == 2**63 - 1 and got[4] == -(2**63)


def test_bounds_hold_and_most_vectors_of_clustered_data_are_left_out():
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((20, 16)) * 256
    x = np.floor(centres[rng.integers(0, 20, 5000)] + 12 * rng.standard_normal((5000, 16))).astype(np.int64)
    chosen = pivots.choose(x[:500].astype(float), 32)
    table, reach = pivots.distances(x.astype(float), chosen), float(np.linalg.norm(chosen, axis=1).max())
    block = pivots.Block(x, table, [[{"vec_id": i, "copies": 1}] for i in range(len(x))], reach)
    asked = [0, 17, 400]
    assert (block.bounds(x[asked], table[asked]) >= x[asked] @ x.T).all()
    for q, best, seen in block.best(asked, x[asked], table[asked], np.full(3, -np.inf), 5):
        want = sorted(((-int(s), i) for i, s in enumerate(x @ x[q]) if i != q))[:5]
        assert best == [(-s, i) for s, i in want]
        assert seen < 2500


# --- trie ----------------------------------------------------------------------------------------------------------------------


def plain_trie(turns):
    own = {}
    for c, turn, role, text in turns:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, sha(f"{len((role or '').encode())}:{role or ''}{text or ''}"), role or "", text or ""))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, v in own.items():
        h = crc(c) % 6
        built[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + v[h:]
    members = {}
    for c, v in built.items():
        for d in range(len(v) + 1):
            members.setdefault(tuple(v[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        kids = children.get(node, [])
        leaves[node] = sum(leaves[k] for k in kids) or 1
        saved[node] = sum(saved[k] for k in kids) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    return sorted(
        (min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, [])), leaves[node], saved[node], sha(",".join(str(c) for c in sorted(m) if len(built[c]) == len(node))))
        for node, m in members.items()
    )


TRIE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def turn_frame(spark, turns, parts=3):
    return spark.createDataFrame([(c, n, r, t, 1, 2, "x") for c, n, r, t in turns], "conv_id long, turn long, role string, text string, depth int, place int, key string").repartition(parts)


@pytest.fixture(scope="module")
def turns():
    rng = random.Random(11)
    out = []
    for c in range(230):
        for n in range(rng.choice([1, 1, 2, 3, 5, 8])):
            out.append((c, n, "user" if n % 2 == 0 else "assistant", rng.choice(["a", "b", "hello there", "ü" * 40])))
    for c in range(300, 340):  # copies
        out += [(c, n, "user", "the same") for n in range(7)]
    out += [(400, None, "user", "first by null"), (400, 3, None, None), (400, 3, "user", "tie"), (400, 3, "assistant", "tie"), (400, 4, "", ""), (None, 0, "user", "of none")]
    out += [(401, 0, "user", "twice"), (401, 0, "user", "twice"), (-7, 0, "user", "negative"), (-107, 0, "user", "negative"), (950, 0, "user", "no base")]
    out += [(500, n, "user", f"t{n % 3}") for n in range(60)]
    out += [(501, n, "user", f"t{n % 3}") for n in range(45)] + [(502, n, "user", f"t{n % 3}" if n < 40 else "else") for n in range(50)]
    out += [(2**53 + 1, 0, "user", "large id"), (600, 0, "user", "x" * 200_000)]
    return out


def test_trie_is_what_a_plain_loop_builds(spark, turns):
    got = sorted(tuple(r) for r in trie.trie(turn_frame(spark, turns)).select(*TRIE).collect())
    assert sorted(map(str, got)) == sorted(map(str, plain_trie(turns)))


def test_trie_with_hot_keys_and_chunked_chains(spark, turns, monkeypatch):
    """Every key above two rows is looked up as a hot one, and long conversations are digested in chunks."""
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    monkeypatch.setattr(common, "HOT_SHARE", 10**9)
    monkeypatch.setattr(common, "CHUNK", 8)
    got = sorted(tuple(r) for r in trie.trie(turn_frame(spark, turns)).select(*TRIE).collect())
    assert sorted(map(str, got)) == sorted(map(str, plain_trie(turns)))


def test_trie_of_nothing_and_of_one(spark):
    assert trie.trie(turn_frame(spark, [])).count() == 0
    assert trie.trie(turn_frame(spark, [(None, 0, "user", "x")])).count() == 0
    one = [(7, 0, "user", "hello")]  # begins with turns of conversation 0, which isn't there
    got = sorted(tuple(r) for r in trie.trie(turn_frame(spark, one)).select(*TRIE).collect())
    assert sorted(map(str, got)) == sorted(map(str, plain_trie(one)))


# --- manifest ------------------------------------------------------------------------------------------------------------------


def plain_manifest(docs):
    enc = lambda x: "-" if x is None else f"{len(str(x).encode())}:{x}"
    leaf = lambda d: sha("".join(map(enc, d)))
    trees = {}
    for d in docs:
        trees.setdefault(d[2], []).append(d)

    def grow(level):
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i : i + 2])) for i in range(0, len(levels[-1]), 2)])
        return levels

    def climb(levels, at, node, siblings):
        for level in levels[:-1]:
            run = level[at // 2 * 2 : at // 2 * 2 + 2]
            siblings += [x for i, x in enumerate(run) if i != at % 2]
            run[at % 2] = node
            node, at = sha("".join(run)), at // 2
        return node

    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    for t in order:
        trees[t].sort(key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
    grown = {t: grow([leaf(d) for d in trees[t]]) for t in order}
    top = grow([grown[t][-1][0] for t in order]) if order else []
    out = []
    for n, t in enumerate(order):
        for at, d in enumerate(trees[t]):
            node, siblings = leaf(d), []
            if d[0] is not None and crc(d[0]) % 7 == 0:
                node = leaf((*d[:3], None if d[3] is None else d[3] + 1, d[4]))
            node = climb(top, n, climb(grown[t], at, node, siblings), siblings)
            out.append((d[0], leaf(d), grown[t][-1][0], top[-1][0], sha("".join(siblings)), node, node == top[-1][0]))
    return out


PROOF = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def doc_frame(spark, docs, parts=3):
    return spark.createDataFrame([(*d, "x", 1, 2) for d in docs], "doc_id long, source string, lang string, n_chars long, text string, tree string, place int, page int").repartition(parts)


@pytest.fixture(scope="module")
def documents():
    rng = random.Random(2)
    langs = ["en"] * 60 + ["de", "fr", None, "", "é", "z"]
    out = [(i, rng.choice(["a", "b", None]), rng.choice(langs), rng.choice([None, i * 3]), "text " + "ü" * (i % 7)) for i in range(rng.randint(300, 320))]
    out += [(1000, None, "once", None, None), (1001, "a", "en", 5, ""), (1002, "a", "en", 5, "long " * 50_000), (None, "a", "en", 1, "no id"), (None, None, None, None, None)]
    return out + [out[3], out[3], (3, "other", out[3][2], 4, "same id"), (2**53 + 1, "a", "en", 2, "large id")]


@pytest.mark.parametrize("page", [1, 3, merkle.PAGE])
def test_proofs_are_what_a_plain_loop_makes(spark, documents, page):
    """Pages so small that trees are of many rounds, at different heights, and of the usual size."""
    docs = documents if page == merkle.PAGE else documents[:40] + documents[-9:]
    got = sorted(str(tuple(r)) for r in merkle.proofs(doc_frame(spark, docs), page).select(*PROOF).collect())
    assert got == sorted(map(str, plain_manifest(docs)))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 8, 9])
def test_trees_of_any_number_of_leaves(spark, n):
    docs = [(i, "a", "en", 1, f"t{i}") for i in range(n)]
    got = sorted(str(tuple(r)) for r in merkle.proofs(doc_frame(spark, docs)).select(*PROOF).collect())
    assert got == sorted(map(str, plain_manifest(docs)))


def test_manifest_of_no_documents(spark):
    assert merkle.proofs(doc_frame(spark, [])).count() == 0


def test_stored_preimages_hash_to_their_parents(spark, documents):
    made = merkle.manifest(doc_frame(spark, documents), 3)
    stored = {(r["tree"], r["level"], r["place"]): r["preimage"] for r in made.preimages().collect()}
    leaves = {(r["tree"], 0, r["place"]): r["leaf"] for r in made.leaves.collect()}
    hashes = leaves | {k: sha(v) for k, v in stored.items()}
    assert len(stored) > 150
    for (tree, level, place), preimage in stored.items():
        assert preimage == "".join(hashes.get((tree, level - 1, 2 * place + i), "") for i in (0, 1))


def test_slots_are_cut_out_and_overwritten():
    pair = "a" * 64 + "b" * 64
    assert merkle.siblings(pair, 0) == "b" * 64 and merkle.siblings(pair, 1) == "a" * 64 and merkle.siblings("c" * 64, 0) == ""
    assert merkle.splice(pair, 1, "x" * 64) == "a" * 64 + "x" * 64


# --- helpers -------------------------------------------------------------------------------------------------------------------


def test_ranks_over_ranges_are_those_of_a_window(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key"), (F.col("id") * 7919 % 5003).alias("at"))
    got = common.ranked(df, ["key"], ["at"], "test-ranked").selectExpr("key", "at", "place").toPandas()
    assert rows(got) == rows(df.selectExpr("key", "at", "row_number() over (partition by key order by at) - 1 as place").toPandas())


def test_running_sums_in_chunks_are_those_of_a_window(spark, monkeypatch):
    monkeypatch.setattr(common, "CHUNK", 16)
    df = spark.range(600).select((F.col("id") % 4).alias("key"), (F.floor(F.col("id") / 4)).alias("at"), (F.col("id") * 31 % 17).alias("v"))
    for down, xor, total in ((False, True, "bit_xor"), (True, False, "sum")):
        got = common.running(df, "key", "at", {"run": F.col("v")}, 150, descending=down, xor=xor).toPandas()
        assert rows(got) == rows(df.selectExpr("*", f"{total}(v) over (partition by key order by at {'desc' if down else ''} rows between unbounded preceding and current row) as run").toPandas())


def test_looked_up_rows_of_hot_keys_join_alike(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 50)
    df = spark.range(900).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 100).alias("key"), "id")
    known = spark.range(100).select(F.col("id").alias("key"), (F.col("id") * 10).alias("value"))
    monkeypatch.setattr(common, "HOT_SHARE", 100)
    assert rows(common.looked_up(df, known, ["key"]).toPandas()) == rows(df.join(known, "key").toPandas())

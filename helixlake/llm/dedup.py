"""Near-duplicate detection: one-permutation MinHash with optimal densification, banded buckets, star-shaped candidates.

A document's set: its distinct shingles of `width` words; of fewer words the whole sequence; a null, empty or word-less
text has the empty set, is linked with nothing and is kept. Rows that share a doc_id are one document, linked by the set of
any of them; a row without doc_id takes no part, has no component and is kept. Equal sets (exact copies above all) are one
class, and only one member of a class goes on. An empty table gives an empty result. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, materialise, small

#: Bands of ROWS values each: two sets of similarity 0.8 share no band with probability (1 - 0.8^6)^42 = 3e-6.
BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
#: Two bands of three take as a bucket's centre its most popular member, the third a random one, so that a pair isn't
#: always judged by the same third document.
ORDERS = 3
#: Rounds after the first, in which buckets that still hold several components compare one member of each: the most
#: popular one, then random ones (other ones in every bucket, so that a document meets many of a large component).
ROUNDS = 1
#: Shingles of either side that a task of the last step holds, in whole documents.
BLOCK = 250_000
WIDTH, PERCENT = 5, 80
_PROBES = 64


def _mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing hash."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles. bytes.lower() and bytes.split() know ASCII only, as is asked."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    out = np.full(n, 0x9E3779B97F4A7C15, np.uint64)
    for k in range(min(width, len(words))):
        out = _mix(out * np.uint64(0xFF51AFD7ED558CCD) + hashes[k : k + n])
    return np.unique(out)


def _probe(first: int) -> np.ndarray:
    """For each bin, the bins that it asks next, from attempt `first` on: the same for all documents."""
    bins, tries = np.arange(BINS, dtype=np.uint64)[:, None], np.arange(first, first + _PROBES, dtype=np.uint64)[None, :]
    return (_mix(_mix(bins + np.uint64(1)) + tries * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BINS)).astype(np.int64)


_probes: list[np.ndarray] = []


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each of BINS ranges of hash values; an empty bin takes that of the first full one it asks."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(BINS)) >> np.uint64(32)
    first = np.flatnonzero(np.diff(bins.astype(np.int64), prepend=-1))
    full = np.zeros(BINS, bool)
    values = np.zeros(BINS, np.uint64)
    at = bins[first].astype(np.int64)
    full[at] = True
    values[at] = hashes[first]
    empty, k = np.flatnonzero(~full), 0
    while len(empty):
        if k == len(_probes):
            _probes.append(_probe(k * _PROBES))
        asked = _probes[k][empty]
        hit = full[asked]
        some = hit.any(axis=1)
        values[empty[some]] = values[asked[some, hit[some].argmax(axis=1)]]
        empty, k = empty[~some], k + 1
    return values


def band_keys(hashes: np.ndarray) -> np.ndarray:
    rows = signature(hashes).reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        key = _mix(key * np.uint64(0xFF51AFD7ED558CCD) + rows[:, k])
    return key.view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as a column of lists."""
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *(x.view(np.int64) for x in rows)])))


def _profiles(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n_shingles, set_id (128 bits), bands (none for an empty set)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            hashes = [shingle_set(t, width) for t in texts]
            ids = [xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None for h in hashes]
            bands = [band_keys(h) if len(h) else h for h in hashes]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(map(len, hashes), pa.int64()), pa.array(ids, pa.binary()), _lists(bands)], ["doc_id", "n_shingles", "set_id", "bands"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_shingles long, set_id binary, bands array<long>")


def _sets(docs: DataFrame, ids: DataFrame, width: int, repeated: bool) -> DataFrame:
    """(id) -> id, hashes: the full sets, made anew for the documents that candidates name; one row for each of a repeated id's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("id"), _lists([shingle_set(t, width) for t in texts])], ["id", "hashes"])

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("id"), "text").join(ids, "id", "left_semi")
    sets = rows.mapInArrow(run, "id long, hashes array<long>").where("size(hashes) > 0")
    return sets.dropDuplicates(["id", "hashes"]) if repeated else sets


def _popular(members: DataFrame) -> DataFrame:
    """members + popular: how many members all buckets of an id have.

    Copies of one text that were edited each on its own are closer to that text than to one another; it is in more
    buckets with more of them than any of them is, and so becomes the centre of the stars that it is in.
    """
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"))
    popular = members.select("bucket", "id").join(sizes, "bucket").groupBy("id").agg(F.sum("size").alias("popular"))
    return members.join(popular, "id").select("bucket", "order", "id", "n", "popular")


def _labelled(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """members + label: the component so far, an id's own where it has no link."""
    if labels is None:
        return members.withColumn("label", F.col("id"))
    return members.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))


def _stars(members: DataFrame, best: bool = False) -> DataFrame:
    """(bucket, order, id, n, popular, label) -> a, b: each member with its bucket's centre, less those of one label or unlike size.

    The centre is found by a partial aggregation, so a bucket's members never have to stand in one task; a bucket of k
    gives k - 1 pairs, not k (k - 1) / 2. With best, an id keeps only the most popular of its buckets' centres: a group
    that shares most of its bands is then a star around one centre, not one for each band.
    """
    popular = F.when(F.col("order") == ORDERS - 1, F.lit(0).cast("long")).otherwise(-F.col("popular"))
    rank = F.struct(popular.alias("p"), F.xxhash64("id", "order").alias("h"), F.col("id").alias("c"), F.col("n").alias("c_n"), F.col("label").alias("c_label"), F.col("popular").alias("c_popular"))
    centres = members.groupBy("bucket").agg(F.min(rank).alias("m"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high").select("bucket", "m.c", "m.c_n", "m.c_label", "m.c_popular")
    pairs = members.join(centres, "bucket").where(F.col("label") != F.col("c_label"))
    pairs = pairs.where(100 * F.least("n", "c_n") >= PERCENT * F.greatest("n", "c_n"))
    if best:
        pairs = pairs.groupBy("id").agg(F.max(F.struct("c_popular", F.xxhash64("c").alias("h"), "c")).alias("m")).select("id", "m.c")
    return pairs.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    a = sets.select(F.col("id").alias("a"), F.col("hashes").alias("ha"))
    b = sets.select(F.col("id").alias("b"), F.col("hashes").alias("hb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("common", F.size(F.array_intersect("ha", "hb")))
    return both.where(100 * F.col("common") >= percent * (F.size("ha") + F.size("hb") - F.col("common"))).select("a", "b").distinct()


def components(edges: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """edges (a, b) -> id, label: the least id that can be reached, for every id that has an edge.

    Every round, an id takes the least label among its neighbours and then that label's own label; rounds end when none
    changes. Labels are written out each round, so neither lineage nor anything on the driver grows.
    """
    both = materialise(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "cc-edges")
    if labels is None:
        labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "cc")
    else:
        new = both.select(F.col("a").alias("id")).distinct().join(labels, "id", "left_anti").withColumn("label", F.col("id"))
        labels = materialise(labels.unionByName(new), "cc")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        # A component's label is one of its ids: what a neighbour pulls down, it pulls down for all that carry the label.
        step = labels.join(near, "id", "left").select("id", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        pulled = step.groupBy(F.col("old").alias("key")).agg(F.min("label").alias("to"))
        nxt = step.join(pulled, step["old"] == pulled["key"], "left").select("id", "old", F.least("label", "to").alias("label"))
        nxt = materialise(nxt, "cc")
        jump = nxt.select(F.col("id").alias("key"), F.col("label").alias("to"))
        hop = nxt.join(jump, nxt["label"] == jump["key"], "left").select("id", "old", F.least("label", "to").alias("label"))
        hop = materialise(hop, "cc")
        labels = hop.select("id", "label")
        if not hop.where("label < old").limit(1).count():
            return labels


def _completed(members: DataFrame, labels: DataFrame | None, sets: DataFrame, percent: int) -> DataFrame:
    """The links, one for each document and component, that no star has shown: a, b.

    In a bucket of several components, every document outside the largest one is held against all of that, and against
    the others that are outside of it. This is done in blocks: a task gets at most about BLOCK shingles of either side,
    whatever the size of a component and of its documents, counts common shingles by a sorted list of its block's
    shingles, and returns links only. Where the stars have linked all that is similar, little is left to compare.
    """
    held = materialise(_labelled(members, labels).select("bucket", "id", "n", "label"), "dedup-held")
    who = held.groupBy("id", "label").agg(F.max("n").alias("n"))
    size = small(materialise(who.groupBy("label").agg(F.count(F.lit(1)).alias("size")), "dedup-sizes"))
    top = held.join(size, "label").groupBy("bucket").agg(F.max(F.struct("size", "label")).alias("t"), F.min("label").alias("low"), F.max("label").alias("high"))
    top = top.where("low < high").select("bucket", F.col("t.label").alias("key"))
    outside = materialise(held.join(top, "bucket").where("label <> key").groupBy("key", "id", "label").agg(F.max("n").alias("n")), "dedup-outside")
    keys = small(materialise(outside.groupBy("key").agg(F.sum("n").alias("out")), "dedup-keys"))
    inside = who.join(keys.select("key"), F.col("label") == F.col("key")).select("key", "id", "label", "n")
    every_one = materialise(outside.unionByName(inside), "dedup-sides")
    shares = lambda c: F.ceil(F.col(c) / BLOCK).cast("int")
    blocks = every_one.groupBy("key").agg(F.sum("n").alias("all")).join(keys, "key").select("key", shares("out").alias("n_left"), shares("all").alias("n_right"))
    blocks = small(materialise(blocks, "dedup-blocks"))
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = outside.join(blocks, "key").select("key", "id", "label", part("n_left").alias("l"), every("n_right").alias("r")).join(sets, "id")
    right = every_one.join(blocks, "key").select("key", "id", "label", part("n_right").alias("r"), every("n_left").alias("l")).join(sets, "id")

    def links(some: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(some) and len(others):
            ids, own_label = others["id"].to_numpy(), others["label"].to_numpy()
            lengths = others["hashes"].map(len).to_numpy()
            shingles, own = np.concatenate(others["hashes"].to_numpy()), np.repeat(np.arange(len(others)), lengths)
            order = np.argsort(shingles, kind="stable")
            shingles, own = shingles[order], own[order]
            for i, label, hashes in zip(some["id"], some["label"], some["hashes"], strict=True):
                first, end = np.searchsorted(shingles, hashes, "left"), np.searchsorted(shingles, hashes, "right")
                n = end - first
                at = np.repeat(first - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
                common = np.bincount(own[at], minlength=len(others))
                hit = np.flatnonzero((100 * common >= percent * (len(hashes) + lengths - common)) & (own_label != label))
                out += [(min(i, j), max(i, j)) for j in ids[hit[np.unique(own_label[hit], return_index=True)[1]]]]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    key = ("key", "l", "r")
    right = right.select(*[F.col(c).alias(c) for c in ("key", "l", "r", "id", "label", "hashes")])
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(links, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept (the component's least doc_id stays).

    1. Profiles of all documents: set size, set digest, band keys. 2. One representative (least doc_id) per distinct set.
    3. Buckets of representatives by band key; each with the most popular of its buckets' centres; exact similarity on
    full sets; components. 4. Stars in the buckets that still hold several components, over members of other components
    than the centre's, then over one member of each. 5. What may still be hidden is compared in blocks: no two documents
    that share a bucket stay apart if they are similar enough.
    """
    profiles = materialise(_profiles(docs, width), "dedup-profiles")
    sound = profiles.where("n_shingles > 0 and doc_id is not null")
    classes = sound.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    classes = materialise(classes.where("last > rep").select("set_id", "rep"), "dedup-classes")
    named = sound.join(classes, "set_id", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    same = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"), F.count(F.lit(1)).alias("k")).where("k > 1 and a < z").select("doc_id", "a")
    same = materialise(named.select("doc_id", F.col("rep").alias("b")).join(same, "doc_id").where("a < b").select("a", "b").distinct(), "dedup-same")
    repeated = bool(sound.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count())
    reps = named.where("rep = doc_id")
    exploded = reps.select(F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.posexplode("bands").alias("band", "bucket"))
    exploded = exploded.select("bucket", (F.col("band") % ORDERS).cast("byte").alias("order"), "id", "n")
    sizes = exploded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("high > low").select("bucket")
    members = materialise(_popular(materialise(exploded.join(sizes, "bucket", "left_semi").distinct(), "dedup-buckets")), "dedup-members")
    sets = materialise(_sets(docs, members.select("id").distinct(), width, repeated), "dedup-sets")
    edges, labels = same, components(same) if same.limit(1).count() else None
    pairs = None
    for k in range(rounds + 2):
        held = _labelled(members, labels)
        if k > 1:  # one member of each component
            first = -F.col("popular") if k == 2 else F.xxhash64("id", "bucket", F.lit(k))
            one = F.min(F.struct(first.alias("h"), "id", "n", "popular")).alias("m")
            held = held.groupBy("bucket", "label").agg(one).select("bucket", "label", F.lit(ORDERS - 1 if k % 2 else 0).cast("byte").alias("order"), "m.id", "m.n", "m.popular")
        more = _stars(held, best=k == 0)
        more = materialise(more if pairs is None else more.join(pairs, ["a", "b"], "left_anti"), "dedup-pairs")
        found = materialise(_linked(more, sets, percent), "dedup-edges")
        pairs = more if pairs is None else pairs.unionByName(more)
        if found.limit(1).count():
            edges = edges.unionByName(found)
            labels = components(edges, labels)
        elif k > 0:
            break
    rest = materialise(_completed(members, labels, sets, percent), "dedup-edges")
    if rest.limit(1).count():
        labels = components(edges.unionByName(rest), labels)
    out = profiles.select("doc_id", "n_shingles", "set_id").join(classes, "set_id", "left").withColumn("id", F.coalesce("rep", "doc_id"))
    out = out.withColumn("label", F.col("id")) if labels is None else out.join(labels, "id", "left")
    component = F.coalesce("label", "id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, **parameters) -> DataFrame:
    """docs without the documents whose component has one of smaller doc_id; of rows that share a doc_id, one stays."""
    gone = materialise(near_duplicates(docs, **parameters).where("not kept").select(F.col("doc_id").alias("_id")).distinct(), "dedup-gone")
    again = materialise(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 and doc_id is not null").select(F.col("doc_id").alias("_id")), "dedup-again")
    rows = docs.select("doc_id", F.struct("*").alias("doc"))  # apart from the columns joined, whatever docs' are called
    left = rows.join(small(gone), F.col("doc_id").cast("long") == F.col("_id"), "left_anti")
    same = F.col("doc_id") == F.col("_id")
    one = left.join(small(again), same, "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.to_json("doc").alias("j"), "doc")).alias("m")).select(F.col("m.doc").alias("doc"))
    return left.join(small(again), same, "left_anti").select("doc").unionByName(one).select("doc.*")


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g FROM d),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
e AS (SELECT doc_id, unnest(g) AS g FROM s),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
p AS (SELECT c.a, c.b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 80 * (x.n + y.n - common)),
r(id, label) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.id, p.b FROM r JOIN p ON p.a = r.label),
m AS (SELECT id, min(label) AS label FROM r GROUP BY id)
SELECT doc_id, n AS n_shingles, label AS component_id, doc_id = label AS kept FROM n JOIN m ON id = doc_id
"""

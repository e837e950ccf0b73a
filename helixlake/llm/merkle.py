"""Merkle dataset manifest: a proof for every document, from the preimages of its leaf's ancestors.

H is the lowercase hexadecimal SHA-256 of its inputs' concatenation. A document is a leaf, H of its fields; those of a
language, by doc_id, are a tree of pairs, and so are the languages' roots, by language. Of a parent not its own hash is
stored but its preimage, the concatenated hashes of its children: 64 characters each, so a child's own slot can be cut
out of it (its siblings remain, the proof) or overwritten (the parent's hash follows anew, the fold).

The preimages are stored by pages: PAGE levels of a tree over 2^PAGE neighbouring nodes are one row, which holds of each level
the concatenated hashes; a parent's preimage is a slice of it. So a leaf joins its page, and the page the path above it,
which its leaves share: ceil(levels / PAGE) joins in all instead of one a level, and no group is larger than a page.

A null field is hashed as "-". Rows without doc_id come first in their language and are never tampered with. Rows that
share a doc_id are ordered by their leaves; equal rows are leaves each, alike in hash and with proofs of their own places.
A language of one document has its leaf as root; an empty table gives an empty result. Texts are taken whole; n_chars
of the largest long becomes null when it is tampered with. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CRC32_SQL, crc32, materialise, ranked, small

#: Levels of a page, so 2^PAGE nodes at its bottom: its rows are bounded whatever the size of a tree.
PAGE = 10
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Characters of a hash: a child's slot in its parent's preimage.
SLOT = 64
_PAGES = "tree string, page long, rise int, levels array<string>, top string"
_PATH = "array<struct<preimage: string, slot: int>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_hash(fields: list[Column]) -> Column:
    """H of the fields: each its UTF-8 byte count, ":" and its value, or "-" if null."""
    of = lambda c: F.coalesce(F.concat(F.octet_length(c), F.lit(":"), c), F.lit("-"))
    return F.sha2(F.concat(*[of(c.cast("string")) for c in fields]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """tree, place, doc_id, leaf, tampered (the leaf after tampering, else null); tree stands for the language, and is in its order."""
    plain = [F.col(c) for c in FIELDS]
    changed = [F.try_add(F.col("n_chars").cast("long"), F.lit(1)) if c == "n_chars" else F.col(c) for c in FIELDS]
    tampered = F.when(crc32(F.col("doc_id")) % 7 == 0, leaf_hash(changed))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("-"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), tree.alias("tree"), leaf_hash(plain).alias("leaf"), tampered.alias("tampered"))
    return ranked(materialise(rows, "merkle-leaves"), ["tree"], ["doc_id", "leaf"], "merkle-ranked")


# --- pages ---------------------------------------------------------------------------------------------------------------------


def lift(hashes: list[str], rise: int) -> tuple[list[str], str]:
    """Each level's concatenated hashes, from the given nodes up, and the node that `rise` levels of pairing leave."""
    levels = []
    for _ in range(rise):
        levels.append("".join(hashes))
        hashes = [digest(levels[-1][i : i + 2 * SLOT]) for i in range(0, len(levels[-1]), 2 * SLOT)]
    return levels, hashes[0]


def path(levels: list[str], at: int) -> list[dict]:
    """The preimages above the node at place `at` of a page's bottom, from the nearest up, and the slot of the child on the way."""
    return [{"preimage": level[(at >> i + 1) * 2 * SLOT :][: 2 * SLOT], "slot": at >> i & 1} for i, level in enumerate(levels)]


def siblings(preimage: str, slot: int) -> str:
    """What is left of a preimage without the child's own slot."""
    return preimage[: slot * SLOT] + preimage[(slot + 1) * SLOT :]


def splice(preimage: str, slot: int, child: str) -> str:
    return preimage[: slot * SLOT] + child + preimage[(slot + 1) * SLOT :]


def fold(node: str, above: list[dict]) -> str:
    """The root that a node comes to if each parent's preimage has it in the place of its own."""
    for step in above:
        node = digest(splice(step["preimage"], step["slot"], node))
    return node


def _paged(nodes: pd.DataFrame) -> pd.DataFrame:
    nodes = nodes.sort_values("place")
    levels, top = lift(nodes["hash"].tolist(), int(nodes["rise"].iloc[0]))
    return pd.DataFrame({"tree": [nodes["tree"].iloc[0]], "page": [nodes["page"].iloc[0]], "rise": [nodes["rise"].iloc[0]], "levels": [levels], "top": [top]})


def grow(nodes: DataFrame, bits: int = PAGE) -> tuple[list[DataFrame], DataFrame]:
    """(tree, place, hash) -> the pages of each round (`bits` levels), lowest first, and (tree, hash) of the roots.

    A tree's height follows from its number of leaves, so a page knows how many levels it has, even if its own nodes are few.
    """
    counts = nodes.groupBy("tree").agg((F.max("place") + 1).alias("n"))
    most = counts.agg(F.max("n")).first()[0] or 0
    # ceil(log2 n): binary digits of n - 1
    heights = counts.select("tree", F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0).alias("left"))
    rounds: list[DataFrame] = []
    level = nodes.join(small(heights), "tree").select("tree", "place", "hash", "left")
    roots = None
    while roots is None or 1 << bits * len(rounds) < most:
        rise = F.least(F.col("left"), F.lit(bits)).cast("int")
        sized = level.select("tree", "place", F.shiftright("place", bits).alias("page"), "hash", rise.alias("rise"), "left")
        pages = materialise(sized.groupBy("tree", "page").applyInPandas(_paged, _PAGES), "merkle-pages")
        above = pages.join(small(heights), "tree").select("tree", F.col("page").alias("place"), F.col("top").alias("hash"), (F.col("left") - bits * (len(rounds) + 1)).alias("left"))
        rounds.append(pages)
        done = above.where("left <= 0").select("tree", "hash")
        roots = done if roots is None else roots.unionByName(done)
        level = above.where("left > 0")
    return rounds, materialise(roots, "merkle-roots")


def expand(pages: DataFrame, above: DataFrame, bits: int) -> DataFrame:
    """(tree, page, above, subroot, root) of the nodes below pages, which are the pages of the round below."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree, page, levels, up, subroot, root in zip(batch["tree"], batch["page"], batch["levels"], batch["above"], batch["subroot"], batch["root"], strict=True):
                n = len(levels[0]) // SLOT if len(levels) else 1
                yield pd.DataFrame({"tree": tree, "page": [(page << bits) + i for i in range(n)], "above": [path(levels, i) + list(up) for i in range(n)], "subroot": subroot, "root": root})

    return pages.join(above, ["tree", "page"]).select("tree", "page", "levels", "above", "subroot", "root").mapInPandas(run, f"tree string, page long, above {_PATH}, subroot string, root string")


# --- the manifest --------------------------------------------------------------------------------------------------------------

_PROOFS = "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proved(own: pd.DataFrame, page: pd.DataFrame) -> pd.DataFrame:
    """The proofs of a page's leaves; `at` is a leaf's place in the page."""
    out = []
    for _, p in page.iterrows():  # one row
        above = list(p["above"])
        shared = "".join(siblings(s["preimage"], s["slot"]) for s in above)
        for at, doc, leaf, tampered in zip(own["at"], own["doc_id"], own["leaf"], own["tampered"], strict=True):
            below = path(p["levels"], int(at))
            proof = digest("".join(siblings(s["preimage"], s["slot"]) for s in below) + shared)
            folded = fold(tampered if isinstance(tampered, str) else leaf, below + above)
            out.append((doc, leaf, p["subroot"], p["root"], proof, folded, folded == p["root"]))
    return pd.DataFrame(out, columns=[c.split(" ")[0] for c in _PROOFS.split(", ")])


@dataclass
class Manifest:
    """leaves: tree, place, doc_id, leaf, tampered. pages: by round. above: of each lowest page the path to the root."""

    leaves: DataFrame
    pages: list[DataFrame]
    above: DataFrame
    bits: int = PAGE

    def preimages(self) -> DataFrame:
        """tree, level (1: parents of leaves), place, preimage: of every parent the concatenated hashes of its children."""
        spark, out = self.leaves.sparkSession, None
        for r, pages in enumerate(self.pages):
            rows = pages.select("tree", "page", "rise", F.posexplode("levels").alias("i", "hashes"))
            rows = rows.select("tree", (F.col("i") + 1 + self.bits * r).alias("level"), "page", "i", F.posexplode(F.regexp_extract_all("hashes", F.lit(f".{{1,{2 * SLOT}}}"), F.lit(0))).alias("at", "preimage"))
            rows = rows.select("tree", "level", (F.expr(f"shiftleft(page, {self.bits} - i - 1)") + F.col("at")).alias("place"), "preimage")
            out = rows if out is None else out.unionByName(rows)
        return out if out is not None else spark.createDataFrame([], "tree string, level int, place long, preimage string")

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
        lowest = self.pages[0].join(self.above, ["tree", "page"]).select("tree", "page", "levels", "above", "subroot", "root")
        own = self.leaves.select("tree", F.shiftright("place", self.bits).alias("page"), (F.col("place") % (1 << self.bits)).alias("at"), F.col("doc_id").cast("string").alias("doc_id"), "leaf", "tampered")  # numbers beside a null would be floats in pandas
        return own.groupBy("tree", "page").cogroup(lowest.groupBy("tree", "page")).applyInPandas(_proved, _PROOFS).withColumn("doc_id", F.col("doc_id").cast("long"))


def manifest(docs: DataFrame, bits: int = PAGE) -> Manifest:
    """The trees of the languages, the tree of their roots, and every page's path to the root."""
    bottom = leaves(docs)
    pages, roots = grow(bottom.select("tree", "place", F.col("leaf").alias("hash")), bits)
    over = ranked(roots.select(F.lit("root").alias("over"), "tree", "hash"), ["over"], ["tree"], "merkle-over")
    over_pages, over_root = grow(over.select(F.col("over").alias("tree"), "place", "hash"), bits)
    above = over_root.select("tree", F.lit(0).cast("long").alias("page"), F.array().cast(_PATH).alias("above"), F.lit(None).cast("string").alias("subroot"), F.col("hash").alias("root"))
    for level in reversed(over_pages):
        above = expand(level, above, bits)
    named = over.select("place", F.col("tree").alias("name"), "hash")
    above = above.join(named, F.col("page") == F.col("place")).select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("page"), "above", F.col("hash").alias("subroot"), "root")
    # A tree's topmost page is of the last round that it reaches: lower rounds get their paths from it, smaller trees begin there.
    above = materialise(above, "merkle-above")
    top = above
    for upper in reversed(pages[1:]):
        lower = materialise(expand(upper, above, bits), "merkle-above")
        above = top.join(lower.select("tree").distinct(), "tree", "left_anti").unionByName(lower)
    return Manifest(bottom, pages, above, bits)


def proofs(docs: DataFrame, bits: int = PAGE) -> DataFrame:
    return manifest(docs, bits).proofs()


def _oracle() -> str:
    """The same with recursion: node by node up, leaf by leaf to the root."""
    of = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-')"
    text = [f"CAST({c} AS VARCHAR)" for c in FIELDS]
    leaf = f"sha256({' || '.join(map(of, text))})"
    changed = f"sha256({' || '.join(of('CAST(n_chars + 1 AS VARCHAR)' if c == 'n_chars' else t) for c, t in zip(FIELDS, text, strict=True))})"
    up = "SELECT tree, level + 1, place // 2, (any_value(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY place)) FROM {0} WHERE n > 1 GROUP BY tree, level, place // 2"
    climb = (
        "SELECT {0}.doc_id, {0}.tree, {0}.leaf, {0}.level + 1, {0}.place // 2, ({0}.n + 1) // 2, {0}.siblings || coalesce(o.h, ''), sha256(CASE WHEN {0}.place % 2 = 0 THEN {0}.folded || coalesce(o.h, '') ELSE o.h || {0}.folded END) "
        "FROM {0} LEFT JOIN {1} o ON o.tree = {0}.tree AND o.level = {0}.level AND o.place = xor({0}.place, 1) WHERE {0}.n > 1"
    )
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, coalesce('=' || lang, '-') AS tree, {leaf} AS leaf, CASE WHEN {CRC32_SQL.format("doc_id")} % 7 = 0 THEN {changed} END AS tampered FROM documents),
l AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM d),
a(tree, level, place, n, h) AS (SELECT tree, 0, place, n, leaf FROM l UNION ALL {up.format("a")}),
s AS (SELECT tree, level AS height, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM a WHERE n = 1),
b(tree, level, place, n, h) AS (SELECT '', 0, place, n, subroot FROM s UNION ALL {up.format("b")}),
p(doc_id, tree, leaf, level, place, n, siblings, folded) AS (SELECT doc_id, tree, leaf, 0, place, n, '', coalesce(tampered, leaf) FROM l UNION ALL {climb.format("p", "a")}),
t(doc_id, tree, leaf, level, place, n, siblings, folded) AS (SELECT p.doc_id, '', p.tree || ':' || p.leaf, 0, s.place, s.n, p.siblings, p.folded FROM p JOIN s USING (tree) WHERE p.n = 1 UNION ALL {climb.format("t", "b")})
SELECT t.doc_id, right(t.leaf, {SLOT}) AS leaf, s.subroot, r.h AS root, sha256(t.siblings) AS proof_sha256, t.folded AS folded_root, t.folded = r.h AS verified
FROM t JOIN s ON s.tree = left(t.leaf, length(t.leaf) - {SLOT + 1}), (SELECT h FROM b WHERE n = 1) r WHERE t.n = 1
"""


ORACLE = _oracle()

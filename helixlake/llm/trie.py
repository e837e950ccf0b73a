"""Conversation prefix trie: who owns which shared beginning, and what sharing it would save.

A node is a distinct sequence of a conversation's first turns; it is owned by the smallest conversation that begins so. Who
owns a prefix owns every longer prefix of its own, so what a conversation owns is a chain from its first owned depth to its
end; that depth is found by binary search, all conversations at once, each probe a join against the smallest conversation of
every prefix digest. The last probe that failed names the chain that a chain hangs on. Chains are summed into those they
hang on bottom-up by doubling: after round k a chain has what hangs up to 2^k chains below it.

A prefix digest is the exclusive-or of a digest (2 x 60 bits) per turn, of its depth, role and text, so it is a running value,
and a conversation of any length is digested in chunks.

Null roles and texts count as empty. Turns with equal numbers are ordered by a digest of role and text; a null number comes
first. Rows without conv_id are of no conversation and are dropped. Repeated rows are turns each. An empty table gives an empty
result. Texts are taken whole. Only the columns named are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import CRC32_SQL, crc32, looked_up, materialise, ranked, running

#: Most turns of another conversation that one begins with, less one; conversations that share such a beginning.
TURNS, GROUP = 6, 100
EMPTY = hashlib.sha256(b"").hexdigest()


def said(turns: DataFrame) -> DataFrame:
    """conv_id, place (from 0), key (a digest of role and text), chars (code points of the text)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    key = F.sha2(F.concat(F.octet_length(role), F.lit(":"), role, text), 256)
    rows = turns.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", key.alias("key"), F.length(text).cast("long").alias("chars"))
    return ranked(materialise(rows, "trie-said"), ["conv_id"], ["turn", "key"], "trie-turns").select("conv_id", "place", "key", "chars")


def rebuild(turns: DataFrame, most: int = TURNS, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth from 1, key, chars) of the rebuilt conversations, and (conv_id, length) of each.

    A conversation begins with the first h turns of the first of its hundred, and goes on with its own after its first h.
    """
    turns = materialise(turns, "trie-own")
    sizes = materialise(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "trie-sizes")
    convs = sizes.select("conv_id", "n", (crc32(F.col("conv_id")) % most).alias("h"), (F.col("conv_id") - F.col("conv_id") % group).alias("base"))
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("of_base"))
    convs = convs.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("of_base", F.lit(0))))
    convs = materialise(convs, "trie-convs")
    begun = turns.where(F.col("place") < most - 1).select(F.col("conv_id").alias("base"), "place", "key", "chars")
    begun = convs.select("conv_id", "base", "taken").join(begun, "base").where(F.col("place") < F.col("taken"))
    rest = looked_up(turns, convs.select("conv_id", "h", "taken"), ["conv_id"]).where(F.col("place") >= F.col("h"))
    rows = begun.select("conv_id", (F.col("place") + 1).alias("depth"), "key", "chars").unionByName(rest.select("conv_id", (F.col("place") - F.col("h") + F.col("taken") + 1).alias("depth"), "key", "chars"))
    return rows, convs.select("conv_id", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"))


def prefixes(rows: DataFrame, most: int) -> DataFrame:
    """conv_id, depth, chars, x, y: the digest of a conversation's first depth turns."""
    turn = F.sha2(F.concat(F.col("depth"), F.lit(":"), F.col("key")), 256)
    part = lambda i: F.conv(F.substring("turn", i, 15), 16, 10).cast("long")
    rows = rows.select("conv_id", "depth", "chars", turn.alias("turn")).select("conv_id", "depth", "chars", part(1).alias("a"), part(16).alias("b"))
    return running(rows, "conv_id", "depth", {"x": F.col("a"), "y": F.col("b")}, most, xor=True).drop("a", "b")


def first_owned(prefix: DataFrame, lengths: DataFrame, most: int) -> DataFrame:
    """conv_id, length, first (the least depth owned; length + 1 if none), parent (who owns the prefix before; null: the root's).

    smallest: of every prefix digest the smallest conversation that has it. A round halves every conversation's range.
    """
    smallest = materialise(prefix.groupBy("depth", "x", "y").agg(F.min("conv_id").alias("owner")), "trie-minima")
    state = lengths.select("conv_id", "length", F.lit(1).cast("long").alias("low"), (F.col("length") + 1).alias("high"), F.lit(None).cast("long").alias("parent"))
    state = materialise(state, "trie-search")
    found = state.where("low = high")
    for _ in range(int(most).bit_length()):
        probe = state.where("low < high").withColumn("depth", F.floor((F.col("low") + F.col("high")) / 2).cast("long"))
        probe = materialise(probe.join(prefix.select("conv_id", "depth", "x", "y"), ["conv_id", "depth"]), "trie-probe")
        owned = F.col("owner") == F.col("conv_id")
        state = looked_up(probe, smallest, ["depth", "x", "y"]).select("conv_id", "length", F.when(owned, F.col("low")).otherwise(F.col("depth") + 1).alias("low"), F.when(owned, F.col("depth")).otherwise(F.col("high")).alias("high"), F.when(owned, F.col("parent")).otherwise(F.col("owner")).alias("parent"))
        state = materialise(state, "trie-search")
        found = found.unionByName(state.where("low = high"))
    return found.select("conv_id", "length", F.col("low").alias("first"), "parent")


def ladder(chains: DataFrame, root: int) -> list[DataFrame]:
    """(conv_id, up) by distance: each chain and the one 1, 2, 4, ... chains above it, for those that have one."""
    rungs = [materialise(chains.where("up is not null").select("conv_id", "up"), "trie-rung")]
    while (longer := rungs[-1].where(F.col("up") != root)).limit(1).count():  # nothing is above the root's chain
        above = rungs[-1].select(F.col("conv_id").alias("up"), F.col("up").alias("next"))
        rungs.append(materialise(looked_up(longer, above, ["up"]).select("conv_id", F.col("next").alias("up")), "trie-rung"))
    return rungs


def gathered(values: DataFrame, rungs: list[DataFrame], names: list[str]) -> DataFrame:
    """(conv_id, values) of chains to those of each with all that hang below it."""
    for rung in rungs:
        given = rung.join(values, "conv_id").groupBy(F.col("up").alias("conv_id")).agg(*[F.sum(n).alias(f"_{n}") for n in names])
        values = values.join(given, "conv_id", "left").select("conv_id", *[(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in names])
        values = materialise(values, "trie-gathered")
    return values


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (owner, depth, conv_id) to a digest per node: as a stream, so a node with any number of ends takes no more room."""
    at, state = None, None
    schema = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    one = lambda: pa.RecordBatch.from_arrays([pa.array([at[0]], pa.int64()), pa.array([at[1]], pa.int64()), pa.array([state.hexdigest()])], schema=schema)
    for batch in batches:
        if not batch.num_rows:
            continue
        owner, depth, ids = (batch.column(i).to_numpy() for i in range(3))
        starts = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (depth[1:] != depth[:-1])])
        done: list[tuple[int, int, str]] = []
        for start, end in zip(starts, [*starts[1:], len(ids)], strict=True):
            text = ",".join(map(str, ids[start:end].tolist()))
            if at == (node := (int(owner[start]), int(depth[start]))):
                text = f",{text}"
            else:
                if at is not None:
                    done.append((*at, state.hexdigest()))
                at, state = node, hashlib.sha256()
            state.update(text.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), schema.types, strict=True)], schema=schema)
    if at is not None:
        yield one()


def trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the rebuilt conversations."""
    rows, lengths = rebuild(said(turns))
    lengths = materialise(lengths, "trie-lengths")
    whole = lengths.agg(F.min("conv_id").alias("root"), F.max("length").alias("most")).first()
    root, most = whole["root"], whole["most"] or 0
    if root is None:
        return turns.sparkSession.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string")
    prefix = materialise(prefixes(rows, most), "trie-prefixes")
    is_root = F.col("conv_id") == root
    found = first_owned(prefix, lengths, most)
    parent = F.when(~is_root, F.coalesce("parent", F.lit(root)))
    found = materialise(found.select("conv_id", "length", F.when(is_root, 0).otherwise(F.col("first")).alias("first"), parent.alias("up"), (is_root | (F.col("first") <= F.col("length"))).alias("owns")), "trie-found")
    chains = found.where("owns")
    rungs = ladder(chains, root)

    # What hangs on a node: chains, and conversations that own nothing and end there.
    hung = found.where("up is not null").select(F.col("up").alias("conv_id"), (F.col("first") - 1).alias("depth"), F.col("owns").cast("long").alias("chain"))
    hung = materialise(hung.groupBy("conv_id", "depth").agg(F.sum("chain").alias("chains"), F.sum(1 - F.col("chain")).alias("copies")), "trie-hung")
    tips = hung.select("conv_id", F.col("depth").alias("length"), "chains")
    copies = hung.groupBy("conv_id").agg(F.sum("copies").alias("copies"))
    values = chains.join(tips, ["conv_id", "length"], "left").join(copies, "conv_id", "left").select("conv_id", (1 + F.coalesce("copies", F.lit(0))).alias("n_convs"), (F.coalesce("chains", F.lit(0)) == 0).cast("long").alias("n_leaves"))
    below = gathered(materialise(values, "trie-values"), rungs, ["n_convs", "n_leaves"])

    def given(names: list[str], totals: DataFrame) -> DataFrame:
        """(conv_id, depth, names): what the chains that hang on a node bring it."""
        hangs = chains.where("up is not null").select("conv_id", "up", (F.col("first") - 1).alias("depth")).join(totals, "conv_id")
        return hangs.groupBy(F.col("up").alias("conv_id"), "depth").agg(*[F.sum(n).alias(f"_{n}") for n in names])

    of_chain = chains.select("conv_id", "length", "first", "up")
    nodes = looked_up(prefix.select("conv_id", "depth", "chars"), of_chain, ["conv_id"]).where(F.col("depth") >= F.col("first"))
    nodes = nodes.unionByName(of_chain.where(is_root).withColumns({"depth": F.lit(0).cast("long"), "chars": F.lit(0).cast("long")}))
    nodes = nodes.join(hung, ["conv_id", "depth"], "left").join(given(["n_convs", "n_leaves"], below), ["conv_id", "depth"], "left")
    tip = F.col("depth") == F.col("length")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    nodes = nodes.select(
        "conv_id", "depth", "chars", F.when(F.col("depth") > F.col("first"), F.col("conv_id")).otherwise(F.col("up")).alias("parent_conv_id"), ((~tip).cast("long") + zero("chains")).alias("n_children"),
        (zero("_n_convs") + zero("copies") + tip.cast("long")).alias("own_convs"), (zero("_n_leaves") + (tip & (zero("chains") == 0)).cast("long")).alias("own_leaves"),
    )
    nodes = materialise(nodes, "trie-nodes")
    nodes = running(nodes, "conv_id", "depth", {"n_convs": F.col("own_convs"), "n_leaves": F.col("own_leaves")}, most, descending=True).drop("own_convs", "own_leaves")
    nodes = materialise(nodes.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars")), "trie-counted")
    saved = gathered(materialise(nodes.groupBy("conv_id").agg(F.sum("saved").alias("saved")), "trie-saved"), rungs, ["saved"])
    nodes = nodes.join(given(["saved"], saved), ["conv_id", "depth"], "left").withColumn("own_saved", F.col("saved") + zero("_saved")).drop("saved", "_saved")
    nodes = running(materialise(nodes, "trie-savings"), "conv_id", "depth", {"saved_tokens": F.col("own_saved")}, most, descending=True)

    ends = found.select(F.when(F.col("owns"), F.col("conv_id")).otherwise(F.col("up")).alias("owner"), F.col("length").alias("depth"), "conv_id")
    ends = ends.repartition("owner", "depth").sortWithinPartitions("owner", "depth", "conv_id").mapInArrow(_ends, "conv_id long, depth long, ends_sha256 string")
    out = nodes.join(ends, ["conv_id", "depth"], "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))


ORACLE = f"""
WITH q AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS key, length(coalesce(text, '')) AS chars FROM conversations WHERE conv_id IS NOT NULL),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, key) - 1 AS place FROM q),
z AS (SELECT conv_id, count(*) AS n, {CRC32_SQL.format("conv_id")} % {TURNS} AS h, conv_id - conv_id % {GROUP} AS base FROM q GROUP BY conv_id),
c AS (SELECT z.*, least(z.h, coalesce(b.n, 0)) AS taken FROM z LEFT JOIN z b ON b.conv_id = z.base),
r AS (SELECT c.conv_id, place + 1 AS depth, key, chars FROM c JOIN t ON t.conv_id = c.base AND t.place < c.taken
      UNION ALL SELECT c.conv_id, place - h + taken + 1, key, chars FROM c JOIN t ON t.conv_id = c.conv_id AND t.place >= c.h),
p AS (SELECT conv_id, depth, chars, string_agg(key, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pre FROM r UNION ALL SELECT conv_id, 0, 0, '' FROM c),
n AS (SELECT depth, pre, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars FROM p GROUP BY depth, pre),
o AS (SELECT n.*, u.conv_id AS parent_conv_id FROM n LEFT JOIN p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN n u ON u.depth = p.depth AND u.pre = p.pre),
k AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM o WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT o.*, coalesce(n_children, 0) AS n_children FROM o LEFT JOIN k USING (conv_id, depth)),
s AS (SELECT p.depth, p.pre, count(*) FILTER (m.n_children = 0) AS n_leaves, CAST(sum((m.n_convs - 1) * m.chars) AS BIGINT) AS saved_tokens FROM m JOIN p ON p.conv_id = m.conv_id AND p.depth <= m.depth GROUP BY 1, 2),
e AS (SELECT depth, pre, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM p WHERE (conv_id, depth) IN (SELECT conv_id, max(depth) FROM p GROUP BY conv_id) GROUP BY 1, 2)
SELECT m.conv_id, CAST(m.depth AS BIGINT) AS depth, m.parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved_tokens, coalesce(e.ends, sha256('')) AS ends_sha256
FROM m JOIN s USING (depth, pre) LEFT JOIN e USING (depth, pre)
"""

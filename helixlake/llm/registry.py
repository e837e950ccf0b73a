"""The queries of this subpackage and their SQL, as __spark_entry__ registers them."""

from __future__ import annotations

from . import ann, bpe, chat, dedup, licenses, merkle, mixing, pivots, quality, secrets, toxicity, trie, urls
from .common import table


def op1_mixing(spark, sf_dir):
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op2_quality(spark, sf_dir):
    return quality.quality_rules(table(spark, sf_dir, "documents")).drop("lang", "source", "distance")


def op10_chat(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(chat.EXTRA, "conv_id long, turn int, role string, text string")
    return chat.digests(chat.format_conversations(turns.unionByName(extra)))


def op6_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"))


def op3_urls(spark, sf_dir):
    return urls.filter_urls(table(spark, sf_dir, "pages")).drop("score")


def op4_secrets(spark, sf_dir):
    return secrets.digests(secrets.scan(table(spark, sf_dir, "documents")))


def op9_dedup(spark, sf_dir):
    return dedup.near_duplicates(table(spark, sf_dir, "documents"), width=2)


def op5_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_licenses(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"), wrapped=True)


def op8_ann(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op11_pivots(spark, sf_dir):
    return pivots.nearest(table(spark, sf_dir, "embeddings"))


def op12_trie(spark, sf_dir):
    return trie.trie(table(spark, sf_dir, "conversations"))


def op13_merkle(spark, sf_dir):
    return merkle.proofs(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mixing, op2_quality, op3_urls, op4_secrets, op5_toxicity, op6_bpe, op7_licenses, op8_ann, op9_dedup, op10_chat, op11_pivots, op12_trie, op13_merkle)}
ORACLES = {"op1_mixing": mixing.ORACLE, "op2_quality": quality.ORACLE, "op3_urls": urls.ORACLE, "op4_secrets": secrets.ORACLE, "op7_licenses": licenses.ORACLE, "op9_dedup": dedup.ORACLE, "op10_chat": chat.ORACLE, "op11_pivots": pivots.ORACLE, "op12_trie": trie.ORACLE, "op13_merkle": merkle.ORACLE}

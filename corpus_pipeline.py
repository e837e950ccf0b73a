"""The corpus pipeline: quality rules, near-duplicates, secrets, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents; the last one returns the encodings' digests, a row per document
of the mix (repetitions counted).
"""

from __future__ import annotations

from helixlake.llm import bpe, dedup, mixing, quality, secrets
from helixlake.llm.common import materialise, release, table, written


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules reject go."""
    return quality.keep_documents(docs)


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of near-duplicates (five-word shingles, similarity of 0.8 and more) stays."""
    return dedup.drop_near_duplicates(docs)


def secret_scan(spark, docs, sf_dir):
    """Every span found is replaced in its text."""
    return secrets.redact(docs)


def source_mix(spark, docs, sf_dir):
    """Every document comes as often as the mix takes it."""
    return mixing.apply_mix(docs)


def bpe_tokens(spark, docs, sf_dir):
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.digests(docs)


STAGES = [("quality_rules", quality_rules), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("source_mix", source_mix), ("bpe_tokens", bpe_tokens)]

#: Near-duplicate components and BPE are not for SQL; tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        begun = written()
        kept = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        # The stage is done: what it wrote on the way goes, and what it read, if that was the stage's before.
        release(spark, since=begun - (name != STAGES[0][0]), keep=1)
        docs = kept
    return STAGES[-1][1](spark, docs, sf_dir)

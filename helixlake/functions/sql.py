"""The library's functions under names of their own in SQL: scalar ones as expressions, variant calling as a table function."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from ..operators.sequence import known_variants

# SQL bodies are expanded where they are called, so they are planned as any other expression.
_RESIDUE = "CASE WHEN length({0}) = 1 THEN upper({0}) ELSE element_at(map({1}), lower({0})) END"
_PATTERN = r"^p[.]([A-Za-z]{3}|[A-Z*])([0-9]+)([A-Za-z]{3}|[A-Z*])$"


@udtf(returnType="position int, ref_aa string, alt_aa string, variant_type string")
class CallVariants:
    """The rows by which a protein differs from its reference; for LATERAL joins."""

    def eval(self, ref: str, query: str):
        yield from known_variants(ref or "", query or "")


def register(spark: SparkSession) -> None:
    """parse_hgvs(text) -> struct(ref, position, alt); cfr(cases, deaths) -> percent; call_variants(ref, query) -> rows. In this session."""
    from .scalars import RESIDUES

    names = ", ".join(f"'{long.lower()}', '{short}'" for short, long in RESIDUES.items())
    part = lambda i: f"regexp_extract(t, r'{_PATTERN}', {i})"
    one = lambda i: _RESIDUE.format(part(i), names)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION parse_hgvs(t STRING) RETURNS STRUCT<ref: STRING, position: INT, alt: STRING> RETURN CASE WHEN t RLIKE r'{_PATTERN}' THEN named_struct('ref', {one(1)}, 'position', try_cast({part(2)} AS INT), 'alt', {one(3)}) END")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION cfr(cases DOUBLE, deaths DOUBLE) RETURNS DOUBLE RETURN CASE WHEN cases > 0 AND deaths >= 0 AND deaths <= cases THEN round(deaths * 100 / cases, 2) END")
    spark.udtf.register("call_variants", CallVariants)

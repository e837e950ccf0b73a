"""Full text search over a stored inverted index: words to stems, stop words left out, postings in chunks.

A text is indexed by the stems of its words (runs of letters and digits, lower-cased). Stems are made of column expressions alone, in
the steps that take off plurals, -ed, -ing and a final y; they are applied to distinct words, not to every occurrence.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.sinks import shared_folder, stored

# English words that are not indexed.
STOP_WORDS = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they them
their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing a an the and but if
or because as until while of at by for with about against between into through during before after above below to from up down in out on off over under
again further then once here there when where why how all any both each few more most other some such no nor not only own same so than too very s t can
will just don should now""".split()
WORD = r"[a-z0-9]+"
#: Documents of a posting's chunk: a word of any frequency is rows of bounded size.
CHUNK = 4_096
_VOWEL = "[aeiouy]"


def stem(word: Column) -> Column:
    """A word's stem: plurals (sses, ies, s), then -eed, -ed and -ing where a vowel stands before them, then a final y after a consonant.

    What -ed or -ing leave is mended: -at, -bl and -iz get their e back, a doubled consonant (but l, s and z) is halved, a short
    syllable at the end gets an e if the word is no longer than that. Words of two characters stay.
    """
    plural = F.when(word.endswith("sses"), F.regexp_replace(word, "es$", "")).when(word.endswith("ies"), F.when(F.length(word) > 4, F.regexp_replace(word, "ies$", "i")).otherwise(F.regexp_replace(word, "ies$", "ie")))
    plural = plural.when(word.rlike("(us|ss)$"), word).when(word.rlike(f"{_VOWEL}.+s$"), F.regexp_replace(word, "s$", "")).otherwise(word)

    def tail(w: Column) -> Column:
        bare = F.regexp_replace(w, "(ed|ing)$", "")
        mended = (
            F.when(bare.rlike("(at|bl|iz)$"), F.concat(bare, F.lit("e"))).when(bare.rlike("(bb|dd|ff|gg|mm|nn|pp|rr|tt)$"), F.regexp_replace(bare, ".$", ""))
            .when(bare.rlike("^([^aeiouy]*[aeiouy][^aeiouywx]|[aeiouy][^aeiouy])$"), F.concat(bare, F.lit("e"))).otherwise(bare)
        )
        return F.when(w.rlike(f"{_VOWEL}[^aeiouy].*eed$"), F.regexp_replace(w, "eed$", "ee")).when(w.endswith("eed"), w).when(w.rlike(f"{_VOWEL}.*(ed|ing)$"), mended).otherwise(w)

    out = tail(plural)
    return F.when(F.length(word) <= 2, word).otherwise(F.regexp_replace(out, "(?<=.[^aeiouy])y$", "i"))


def words(text: Column) -> Column:
    """array<string>: the distinct words of a text that are no stop words."""
    return F.array_except(F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))), F.array(*map(F.lit, STOP_WORDS)))


@dataclass
class Index:
    """postings: term, chunk, ids (ascending, CHUNK at most), sorted by term in its files; terms: term, documents."""

    postings: DataFrame
    terms: DataFrame

    def search(self, query: str) -> DataFrame:
        """id of the documents that have all of the query's terms; none for a query of stop words or without words.

        The driver holds the query's terms and their frequencies. The rarest term's documents come first and are narrowed by each other one's,
        so the work follows the rarest; a term that no document has ends the search before postings are read.
        """
        spark = self.postings.sparkSession
        asked = spark.createDataFrame([(query,)], "q string").select(F.explode(words(F.col("q"))).alias("w")).select(stem(F.col("w")).alias("term")).distinct()
        found = self.terms.join(F.broadcast(asked), "term", "right").select("term", F.coalesce("documents", F.lit(0)).alias("n")).orderBy("n", "term").collect()
        ids = lambda term: self.postings.where(F.col("term") == term).select(F.explode("ids").alias("id"))
        if not found or not found[0]["n"]:
            return self.postings.select(F.explode("ids").alias("id")).where(F.lit(False))
        out = ids(found[0]["term"])
        for row in found[1:]:
            out = out.join(ids(row["term"]), "id", "left_semi")
        return out


def build(docs: DataFrame, key: str, text: str) -> Index:
    """Write the inverted index of docs (key: a number, rows that share one are one document) and open it."""
    spark = docs.sparkSession
    said = stored(docs.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.explode(words(F.col(text))).alias("w")), "text-words")
    stems = stored(said.select("w").distinct().select("w", stem(F.col("w")).alias("term")), "text-stems")
    # Distinct words may be many, and a word may be in a third of all documents: the words are dealt with salt.
    salts = 16
    salted = stems.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    # The stems are a small file that is 16 times as many rows: by its size alone it would be broadcast, through the driver.
    pairs = said.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")).join(salted.hint("merge"), ["w", "salt"]).select("term", "id").distinct()
    # Chunks by ranges of ids' hashes: of about CHUNK documents, whatever the ids are.
    counted = stored(pairs, "text-pairs")
    terms = stored(counted.groupBy("term").agg(F.count(F.lit(1)).alias("documents")), "text-terms")
    often = terms.where(F.col("documents") > CHUNK).select("term", F.ceil(F.col("documents") / (CHUNK // 2)).cast("int").alias("parts"))
    n = terms.agg(F.coalesce(F.sum("documents"), F.lit(0))).first()[0]
    rare = counted.join(often, "term", "left_anti").withColumn("chunk", F.lit(0))
    # A term of over CHUNK documents is one of n / CHUNK at most; with a bound they are broadcast, else met with salt.
    many = often if n // CHUNK > 200_000 else F.broadcast(often)
    hot = counted.join(many, "term").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    postings = rare.unionByName(hot).groupBy("term", "chunk").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    path = f"{shared_folder(spark)}/fulltext/index-{uuid.uuid4().hex}"
    postings.repartitionByRange("term", "chunk").sortWithinPartitions("term", "chunk").write.parquet(path)
    return Index(spark.read.schema(postings.schema).parquet(path), terms)

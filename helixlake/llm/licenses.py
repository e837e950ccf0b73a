"""License scans: phrases, and an exact set-similarity join of text blocks with license templates.

A null text counts as empty: no words, no labels, score 0. Repeated rows are scanned each alike; an empty table gives an
empty result. Texts are taken whole, in blocks: lines and runs of lines, as the registered query takes them (scan() without
wrapped=True takes lines alone). A notice with blank lines in it is found by its paragraphs, each of which is a template. Only the
columns named are read.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, let, materialise, small

#: Phrases of words, and the label each stands for.
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: What separates words: ASCII but for digits and lower-case letters (the texts are lower-cased first).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same, for texts not lower-cased yet.
RAW_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Notices that blocks are held against: label, text. One-sentence notices first, then whole notices by their paragraphs, so
#: that blank lines between these don't matter (public license texts).
TEMPLATES = (
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("apache-2", "Licensed under the Apache License, Version 2.0."),
    ("apache-2", "You may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl-3", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("mit", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:'),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("mit", 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'),
    ("apache-2", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at'),
    ("apache-2", 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("gpl", "You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer."),
    ("bsd", "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("bsd", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("bsd", 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("isc", 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("zlib", "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("boost", 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:'),
    ("unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
)
#: Least share of a template's distinct words that a block must hold.
CONTAINMENT = 0.8


def template_words(templates=TEMPLATES) -> list[tuple[int, str, list[str]]]:
    """(number, label, distinct words) of every template."""
    import re

    lower = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)
    return [(i, label, sorted({w for w in re.split(GAP, lower(text)) if w})) for i, (label, text) in enumerate(templates)]


def template_lengths(templates=TEMPLATES) -> dict[int, int]:
    """number -> words of every template, repeated ones too."""
    import re

    return {i: len([w for w in re.split(RAW_GAP, text) if w]) for i, (_, text) in enumerate(templates)}


def _need(n: int) -> int:
    """Words of a template of n distinct ones that a block must hold."""
    return max(1, ceil(round(CONTAINMENT * n, 9)))


def _starts(words: Column, phrase: str) -> Column:
    """Where the phrase's words stand one after another in an array of words."""
    parts = phrase.split(" ")

    def at(i: Column) -> Column:
        same = F.get(words, i) == parts[0]
        for k, p in enumerate(parts[1:], 1):
            same = same & (F.get(words, i + k) == p)
        return same

    return F.when(F.size(words) >= len(parts), F.filter(F.sequence(F.lit(0), F.size(words) - len(parts)), at)).otherwise(F.array().cast("array<int>"))


def _known(line: Column, vocabulary: list[str]) -> Column:
    """The distinct words of a line that any template has, in their order; one look-up a word."""
    return F.array_distinct(F.filter(F.split(ascii_lower(line), RAW_GAP), lambda w: w.isin(vocabulary)))


def _runs(text: Column, templates: list[tuple[int, str, list[str]]], vocabulary: list[str], reach: int) -> Column:
    """array<array<struct<n, w>>>: runs of lines that can hold enough of a template, each line as its word count and template words.

    A run begins at any line and takes the lines after it, up to one without words, until those hold `reach` words; so a
    passage of at most so many words lies whole in the run of the line that it begins in. Every line of a run but the first
    has a word, so it has at most reach + 1 lines. Only runs that hold a key word are looked at. A text's lines are read
    once, whatever the number of runs that they stand in.
    """
    key = _some_key(templates)
    least = min(_need(len(words)) for _, _, words in templates)
    empty = F.array().cast("array<struct<n:int,w:array<string>,key:boolean>>")

    def line(x: Column) -> Column:
        n = F.size(F.filter(F.split(x, RAW_GAP), lambda w: w != ""))
        return F.struct(n.alias("n"), _known(x, vocabulary).alias("w"), x.rlike(key).alias("key"))

    def run(lines: Column, at: Column) -> Column:
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("lines"))
        step = lambda acc, x: F.when((acc["n"] < reach) & (x["n"] > 0), F.struct((acc["n"] + x["n"]).alias("n"), (acc["lines"] + 1).alias("lines"))).otherwise(F.struct(F.lit(reach).alias("n"), acc["lines"].alias("lines")))
        return F.slice(lines, at + 1, F.aggregate(F.slice(lines, at + 2, reach), start, step)["lines"] + 1)

    def enough(r: Column) -> Column:
        return (F.size(r) > 1) & F.exists(r, lambda x: x["key"]) & (F.size(F.array_distinct(F.flatten(F.transform(r, lambda x: x["w"])))) >= least)

    def of(lines: Column) -> Column:
        keyed = F.filter(F.transform(lines, lambda x, i: F.when(x["key"], i)), lambda i: i.isNotNull())
        starts = F.array_distinct(F.flatten(F.transform(keyed, lambda i: F.sequence(F.greatest(i - reach, F.lit(0)), i))))
        starts = F.filter(starts, lambda i: F.get(lines, i)["n"] > 0)
        runs = F.transform(starts, lambda i: let(run(lines, i), lambda r: F.when(enough(r), F.transform(r, lambda x: F.struct(x["n"], x["w"])))))
        return F.filter(runs, lambda r: r.isNotNull())

    return F.when(text.rlike(key), let(F.coalesce(F.transform(F.split(text, "\n"), line), empty), of)).otherwise(F.array().cast("array<array<struct<n:int,w:array<string>>>>"))


def _profiles(docs: DataFrame, templates: list[tuple[int, str, list[str]]], reach: int = 0) -> DataFrame:
    """doc_id, n_words, places (of phrases), blocks: for each block that can hold enough, its template words; runs, if reach is given.

    One pass over the texts. A block is reduced to those of its distinct words that any template has, which is all that
    an intersection with a template can hold; the length filter drops the blocks with fewer of them than the smallest
    requirement. Both need only words of the block, so what is written out is a small part of the corpus.
    """
    vocabulary = sorted({w for _, _, words in templates for w in words})
    least = min(_need(len(words)) for _, _, words in templates)
    text = F.coalesce(F.col("text"), F.lit(""))
    spaced = F.concat(F.lit(" "), F.trim(F.regexp_replace(text, RAW_GAP, " ")), F.lit(" "))
    count = lambda s: F.when(F.length(s) == 2, 0).otherwise(F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit(""))) - 1)
    phrase = "(?i)" + "|".join(f" {p} " for p, _ in PHRASES)

    def places(s: Column) -> Column:
        words = F.filter(F.split(ascii_lower(s), " "), lambda w: w != "")
        per = lambda w: F.array(*[_starts(w, p) for p, _ in PHRASES])
        return F.when(s.rlike(phrase), let(words, per)).otherwise(F.array(*[F.array().cast("array<int>")] * len(PHRASES)))

    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(_some_key(templates)))
    blocks = F.filter(F.transform(lines, lambda x: _known(x, vocabulary)), lambda b: F.size(b) >= least)
    of_words = let(spaced, lambda s: F.struct(count(s).alias("n"), places(s).alias("p")))
    runs = [_runs(text, templates, vocabulary, reach).alias("r")] if reach else []
    rows = docs.select("doc_id", F.explode(F.array(F.struct(of_words.alias("w"), blocks.alias("b"), *runs))).alias("m"))
    return rows.select("doc_id", F.col("m.w.n").cast("long").alias("n_words"), F.col("m.w.p").alias("places"), F.col("m.b").alias("blocks"), *[F.col("m.r").alias("runs")] * bool(reach))


def _some_key(templates: list[tuple[int, str, list[str]]]) -> str:
    """A pattern that every block holding enough of a template matches.

    Of a template's words a block may lack n - need(n); any n - need(n) + 1 of them will do as keys, since a block that
    has none of these lacks too many. The longest words are taken, which prose has least of.
    """
    keys = set()
    for _, _, words in templates:
        keys |= set(sorted(words, key=lambda w: (-len(w), w))[: len(words) - _need(len(words)) + 1])
    edge = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
    first = {}
    for k in sorted(keys):  # by first letter, so that a place in the text is held against few branches
        first.setdefault(k[0], []).append(k[1:])
    return rf"(?i)(?<!{edge})(?:{'|'.join(f'{c}(?:{chr(124).join(rest)})' for c, rest in first.items())})(?!{edge})"


def _rows(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A broadcast table of what the templates say: as many rows as they have words, at most."""
    literal = lambda x: str(x) if isinstance(x, int) else f"array({', '.join(map(literal, x))})" if isinstance(x, list) else f"'{x}'"  # noqa: E731  words and labels hold no quotes
    values = ", ".join(f"({', '.join(map(literal, r))})" for r in rows)
    return F.broadcast(spark.sql(f"SELECT * FROM VALUES {values} AS t({names})"))


def matches(blocks: DataFrame, templates: list[tuple[int, str, list[str]]]) -> DataFrame:
    """(doc_id, block_no, words) -> doc_id, block_no, label, containment of every block and template that pass.

    The exact join: words are ordered by how many blocks hold them, rarest first (by the word at ties). A block that
    holds enough of a template must share one of the template's first n - need + 1 words; it is joined on those. The
    pair goes on if what follows the shared word in both orders could still be enough (positions, lengths); then the
    whole sets are intersected.
    """
    spark = blocks.sparkSession
    counts = blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    rank = {r["word"]: r["n"] for r in counts.collect()}  # at most one row per template word: the templates bound it
    order = {w: i for i, w in enumerate(sorted({w for _, _, words in templates for w in words}, key=lambda w: (rank.get(w, 0), w)))}
    index, whole = [], []
    for i, label, words in templates:
        ordered = sorted(words, key=order.__getitem__)
        need = _need(len(words))
        whole.append((i, label, ordered))
        index += [(w, i, place, len(words), need) for place, w in enumerate(ordered[: len(words) - need + 1])]
    index = _rows(spark, index, "word, template, place, n, need")
    whole = _rows(spark, whole, "template, label, template_words")
    listed = F.array(*[F.lit(w) for w in order])
    ordered = F.transform(F.array_sort(F.transform("words", lambda w: F.struct(F.array_position(listed, w).alias("o"), w.alias("w")))), lambda x: x["w"])
    rows = blocks.select("doc_id", "block_no", ordered.alias("words"))
    probes = rows.select("doc_id", "block_no", "words", F.posexplode("words").alias("at", "word")).join(index, "word")
    could = 1 + F.least(F.col("n") - F.col("place") - 1, F.size("words") - F.col("at") - 1)
    first = probes.where((F.size("words") >= F.col("need")) & (could + F.least("place", "at") >= F.col("need"))).dropDuplicates(["doc_id", "block_no", "template"])
    common = F.size(F.array_intersect("words", "template_words"))
    found = first.join(whole, "template").withColumn("common", common).where("common >= need")
    return found.select("doc_id", "block_no", "label", (F.col("common") / F.col("n")).alias("containment"), "template")


def _run_matches(runs: DataFrame, templates: list[tuple[int, str, list[str]]], lengths: dict[int, int]) -> DataFrame:
    """(doc_id, block_no, run) -> doc_id, label, containment of every run and template that pass.

    Runs as long as the longest template needs are joined first; they hold the template's own run, which is then taken: the
    first line, and lines after it until those hold as many words as the template.
    """
    words = F.array_distinct(F.flatten(F.transform("run", lambda x: x["w"])))
    found = matches(runs.select("doc_id", "block_no", words.alias("words")), templates)
    whole = _rows(runs.sparkSession, [(i, ws, lengths[i], _need(len(ws))) for i, _, ws in templates], "template, template_words, reach, need")
    start = F.struct(F.lit(0).alias("n"), F.get("run", F.lit(0))["w"].alias("w"))
    step = lambda acc, x: F.when(acc["n"] < F.col("reach"), F.struct((acc["n"] + x["n"]).alias("n"), F.concat(acc["w"], x["w"]).alias("w"))).otherwise(acc)
    own = F.aggregate(F.slice("run", F.lit(2), F.greatest(F.size("run") - 1, F.lit(0))), start, step)["w"]
    rows = found.select("doc_id", "block_no", "label", "template").join(runs, ["doc_id", "block_no"]).join(whole, "template")
    rows = rows.withColumn("common", F.size(F.array_intersect(own, "template_words"))).where("common >= need")
    return rows.select("doc_id", "label", (F.col("common") / F.size("template_words")).alias("containment"))


def scan(docs: DataFrame, templates=TEMPLATES, wrapped: bool = False) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    wrapped: notices broken over lines count too. Besides lines, blocks are then, for every template and line, this line and
    those after it, up to one without words, until those after it hold as many words as the template.

    score is the largest containment of a template in a block, 1 where a phrase stands. Rows that share a doc_id are
    scanned each alone; their blocks are told apart by the digest of what they hold.
    """
    parts, lengths = template_words(templates), template_lengths(templates)
    profiles = materialise(_profiles(docs, parts, max(lengths.values()) if wrapped else 0), "licenses")
    held, digest = ("size(blocks) > 0", F.xxhash64("blocks")) if not wrapped else ("size(blocks) > 0 or size(runs) > 0", F.xxhash64("blocks", "runs"))
    blocks = profiles.where("size(blocks) > 0").select(F.struct("doc_id", digest.alias("h")).alias("doc_id"), F.posexplode(F.array_distinct("blocks")).alias("block_no", "words")).distinct()
    found = matches(blocks, parts).select("doc_id", "label", "containment")
    if wrapped:
        runs = profiles.where("size(runs) > 0").select(F.struct("doc_id", digest.alias("h")).alias("doc_id"), F.posexplode(F.array_distinct("runs")).alias("block_no", "run")).distinct()
        found = found.unionByName(_run_matches(runs, parts, lengths))
    per = found.groupBy("doc_id").agg(F.collect_set("label").alias("found"), F.max("containment").alias("containment"))
    per = small(materialise(per.select(F.col("doc_id.doc_id").alias("_id"), F.col("doc_id.h").alias("_h"), "found", "containment"), "license-matches"))
    names = F.array(*[F.lit(label) for _, label in PHRASES])
    base = F.filter(F.transform(names, lambda x, i: F.when(F.size(F.get("places", i)) > 0, x)), lambda x: x.isNotNull())
    every = F.flatten("places")
    rows = profiles.withColumn("base", F.array_sort(F.array_distinct(base))).withColumn("h", digest)
    rows = rows.join(per, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("h") == F.col("_h")) & F.expr(held), "left")
    found = F.coalesce("found", F.array().cast("array<string>"))
    score = F.when(F.size("base") > 0, F.lit(1.0)).otherwise(F.coalesce("containment", F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", F.size(every).cast("long").alias("n_base"), F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        F.array_join("base", ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union("base", found)), ",").alias("labels"), score.alias("score"),
    )


def _oracle() -> str:
    """The scan with wrapped=True: a block of a template is a line with words and those after it, up to one without words,
    until those after it hold as many words as the template."""
    low = "translate(coalesce({c}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    words = "list_filter(string_split_regex(" + low + ", '" + GAP + "'), lambda w: w <> '')"
    lengths = template_lengths()
    templates = ", ".join(f"({i}, '{label}', {len(ws)}, {_need(len(ws))}, {lengths[i]})" for i, label, ws in template_words())
    vocabulary = ", ".join(f"({i}, '{w}')" for i, _, ws in template_words() for w in ws)
    starts = []
    for phrase, label in PHRASES:
        parts = phrase.split(" ")
        same = " AND ".join(f"w[i + {k}] = '{p}'" for k, p in enumerate(parts, 1))
        starts.append(f"SELECT r, '{label}' AS label, unnest(list_filter(range(0, greatest(len(w) - {len(parts) - 1}, 0)), lambda i: {same})) AS pos FROM d")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, text, {words.format(c="text")} AS w FROM documents),
s AS ({" UNION ALL ".join(starts)}),
b AS (SELECT r, count(*) AS n, min(pos) AS lo, max(pos) AS hi, list_sort(list_distinct(list(label))) AS labels FROM s GROUP BY r),
i AS (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(0, len(string_split(coalesce(text, ''), chr(10))))) AS ln FROM d),
k AS (SELECT r, ln, {words.format(c="line")} AS w FROM i),
l AS (SELECT r, ln, w, len(w) AS n, sum(len(w)) OVER o AS run, count(*) FILTER (len(w) = 0) OVER o AS gaps FROM k WINDOW o AS (PARTITION BY r ORDER BY ln)),
t(id, label, n, need, reach) AS (VALUES {templates}),
v(id, word) AS (VALUES {vocabulary}),
u AS (SELECT DISTINCT l.r, l.ln, l.gaps, l.run - l.n AS before, v.id, v.word FROM (SELECT r, ln, gaps, run, n, unnest(w) AS word FROM l) l JOIN v ON l.word = v.word),
g AS (SELECT a.r, a.ln, t.id, t.label, t.n, t.need, count(DISTINCT u.word) AS common
      FROM l a JOIN u ON u.r = a.r AND u.gaps = a.gaps AND u.ln >= a.ln JOIN t ON t.id = u.id
      WHERE a.n > 0 AND (u.ln = a.ln OR u.before - a.run < t.reach) GROUP BY ALL),
f AS (SELECT r, list_sort(list_distinct(list(label))) AS labels, max(CAST(common AS DOUBLE) / n) AS c FROM g WHERE common >= need GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word, coalesce(array_to_string(b.labels, ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels, CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(f.c, 0.0) END AS score
FROM d LEFT JOIN b USING (r) LEFT JOIN f USING (r)
"""


ORACLE = _oracle()

"""License notices broken over lines, against plain Python."""

import random
import re
import textwrap

from helixlake.llm import licenses

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string"


def words(t):
    return WORD.findall(t.encode().lower().decode())


def plain(text):
    """(labels, score) of all lines, and of every line with those after it until they hold a template's words."""
    lines = [words(x) for x in (text or "").split("\n")]
    labels, score = set(), 0.0
    for (_, label, mine), (_, notice) in zip(licenses.template_words(), licenses.TEMPLATES, strict=True):
        for i, first in enumerate(lines):
            block, n = list(first), 0
            for line in lines[i + 1 :]:
                if not first or not line or n >= len(words(notice)):
                    break
                block, n = block + line, n + len(line)
            for held in (set(first), set(block)):
                common = len(held & set(mine))
                if common >= licenses._need(len(mine)):
                    labels.add(label)
                    score = max(score, common / len(mine))
    flat = f" {' '.join(words(text or ''))} "
    base = {label for phrase, label in licenses.PHRASES if f" {phrase} " in flat}
    return ",".join(sorted(labels | base)), 1.0 if base else score


def texts():
    rng = random.Random(5)
    out = [None, "", "\n\n", "license", "the license\n"]
    for _, notice in licenses.TEMPLATES:
        for width in (20, 40, 72):
            lines = textwrap.wrap(notice, width)
            prose = [" ".join(rng.choices(["alpha", "the", "of", "beta", "software"], k=9)) for _ in range(3)]
            out += ["\n".join(lines), "\n".join(f" * {x}" for x in lines), "\r\n".join(lines), "\n".join(prose + ["tail of a line. " + lines[0], *lines[1:], *prose]), "\n\n".join(lines), "\n".join([*prose, *lines[: len(lines) // 2]])]
    return [*out, "\n".join(f"{w}" for w in licenses.TEMPLATES[5][1].split()), "word\n" * 200 + "\n".join(textwrap.wrap(licenses.TEMPLATES[6][1], 30)) + "\nword" * 200]


def test_wrapped_notices_match_plain_loop(spark):
    every = texts()
    rows = [(i, t) for i, t in enumerate(every)] + [(None, every[5]), (7, every[5]), (7, every[7])]
    got = licenses.scan(spark.createDataFrame(rows, DOCS), wrapped=True).collect()
    key = lambda x: (x[0] is None, x)
    assert sorted(((r["doc_id"], r["labels"], r["score"]) for r in got), key=key) == sorted(((i, *plain(t)) for i, t in rows), key=key)


def test_whole_notices_with_blank_lines_by_their_paragraphs(spark):
    """Every label's templates as one file, wrapped as comments with blank lines between them, with a tenth of the words changed."""
    rng, rows, want = random.Random(11), [], []
    for label in sorted({label for label, _ in licenses.TEMPLATES}):
        paragraphs = [notice for name, notice in licenses.TEMPLATES if name == label and len(words(notice)) > 20]
        if not paragraphs:
            continue
        changed = [" ".join("zzz" if rng.random() < 0.1 else w for w in p.split()) for p in paragraphs]
        for texts_ in (paragraphs, changed):
            rows.append((len(rows), "Some prose before.\n\n" + "\n\n".join("\n".join(f"# {x}" for x in textwrap.wrap(p, 60)) for p in texts_) + "\n\nvalue = 1\n"))
            want.append((len(want), *plain(rows[-1][1])))
            assert label in want[-1][1].split(",")
    prose = "The authors of this work distribute the software under conditions that follow, with the library and its documentation.\n"
    rows.append((len(rows), prose * 50))
    want.append((len(want), "", 0.0))
    got = licenses.scan(spark.createDataFrame(rows, DOCS), wrapped=True).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["labels"], r["score"]) for r in got] == want


def test_long_text_of_short_lines_beside_key_words(spark):
    """20,000 one-word lines, each fiftieth a key word: many runs, none of them enough of a template."""
    text = "\n".join("conditions" if i % 50 == 0 else f"w{i}" for i in range(20_000))
    rows = [(1, text), (2, text + "\nReleased under\nthe MIT License.")]
    got = licenses.scan(spark.createDataFrame(rows, DOCS), wrapped=True).orderBy("doc_id").collect()
    assert [(r["n_words"], r["labels"]) for r in got] == [(20_000, ""), (20_005, "mit")]


def test_a_wrapped_notice_keeps_its_label(spark):
    text = "Permission is hereby granted, free of charge, to any person\nobtaining a copy of this software and associated documentation\nfiles, to deal in the software without restriction."
    df = spark.createDataFrame([(1, text)], DOCS)
    assert [tuple(r) for r in licenses.scan(df, wrapped=True).select("labels", "score").collect()] == [("mit", 1.0)]
    assert licenses.scan(df.where("false"), wrapped=True).count() == 0
    assert licenses.scan(df).columns == licenses.scan(df, wrapped=True).columns

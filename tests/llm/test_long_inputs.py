"""Inputs that took quadratic work or failed: texts of many spans, very long urls, labelled texts with nothing to learn from."""

import random
import re
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helixlake.llm import secrets, toxicity, urls


def seconds(df):
    df.write.format("noop").mode("overwrite").save()
    began = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - began


def many_spans(n):
    return " ".join(f"token={'ab12' * 3} word{i} {'0123456789abcdef' * 2} x{i}" for i in range(n // 2))


def test_spans_of_a_text_of_many(spark):
    text = many_spans(4000) + " " + "Zx9" * 20
    found = secrets.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    want = [(m.start(), 0, m.end()) for m in re.finditer(secrets.KINDS[0][1], text)] + [(m.start(), 2, m.end()) for m in re.finditer(secrets.KINDS[2][1], text)]
    assert [tuple(s) for s in found["base"]] == sorted(want)


def test_work_on_many_spans_grows_with_their_number(spark):
    took = {n: seconds(secrets.redact(spark.createDataFrame([(1, many_spans(n))], "doc_id long, text string"))) for n in (8000, 32000)}
    assert took[32000] <= 4 * took[8000] + 2, took


def test_texts_are_cut_where_spans_are_apart(spark):
    rng = random.Random(5)
    texts = ["token=abcdef", "x token=abcdef", "password=token=abcdef123", "é" * 40_000 + " secret: abcdef " + "ü" * 70_000 + " token=zzzzzz.", "none at all", "", None]
    for _ in range(60):
        texts.append("".join(rng.choice(["token=abcdef1", " ", "word ", "deadbeef" * 4, "AKIA" + "A1" * 9, ";", "é"]) for _ in range(rng.randint(1, 30))))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in secrets.scan(docs).collect()}
    for r in secrets.redact(docs).collect():
        text, out, at = texts[r["doc_id"]], [], 0
        merged = []
        for start, end in spans[r["doc_id"]]:
            if merged and merged[-1][1] >= start:
                merged[-1][1] = max(merged[-1][1], end)
            else:
                merged.append([start, end])
        for start, end in merged:
            out += [text[at:start], secrets.MARK]
            at = end
        assert r["text"] == (None if text is None else "".join(out) + text[at:])


def test_candidates_are_free_of_base_spans_as_by_all_pairs(spark):
    rng = random.Random(9)
    rows = []
    for _ in range(200):
        base = sorted((s, 0, s + rng.randint(1, 30)) for s in rng.sample(range(400), rng.randint(0, 9)))
        found, at = [], 0
        while at < 380:
            at += rng.randint(1, 40)
            end = at + rng.randint(1, 20)
            found.append((at, 3, end, f"x{at}"))
            at = end
        rows.append((base, found))
    found = spark.createDataFrame([(i, s, e, x) for i, (_, f) in enumerate(rows) for s, _, e, x in f], "id long, start int, end int, x string")
    base = spark.createDataFrame([(i, s, e) for i, (b, _) in enumerate(rows) for s, _, e in b], "id long, start int, end int")
    want = [(i, s, e, x) for i, (b, f) in enumerate(rows) for s, _, e, x in f if not any(bs < e and s < be for bs, _, be in b)]
    assert sorted(tuple(r) for r in secrets.untouched(found, base).select("id", "start", "end", "x").collect()) == sorted(want)


def test_grams_of_long_urls_are_those_of_short_ones(spark):
    rng = random.Random(3)
    for n in (0, 1, 5, 1023, 1024, 1025, 5000):
        text = "".join(rng.choices("abc/é", k=n))
        padded = urls.PAD * urls.ORDER + text
        got = spark.createDataFrame([(text,)], "t string").select(urls._grams(F.col("t")).alias("g")).first()["g"]
        assert got == [padded[i : i + urls.ORDER + 1] for i in range(n)]


def url_pages(spark, n):
    rng = random.Random(4)
    rows = [(i, f"https://{rng.choice(['a.com', 'b.net', 'c.org', 'd.io'])}/{rng.choice(['en', 'de', 'es'])}/{i}") for i in range(100)]
    rows += [(200, "https://x.io/" + "".join(rng.choices("abcdefgh/", k=n))), (3, rows[3][1]), (None, "http://n.o/x"), (201, None), (202, "")]
    return spark.createDataFrame(rows, "page_id long, url string")


def test_work_on_a_long_url_grows_with_its_length(spark):
    took = {}
    for n in (15_000, 60_000):
        pages = url_pages(spark, n)
        out = urls.filter_urls(pages)
        assert out.count() == pages.count()
        took[n] = seconds(urls.filter_urls(pages))
    assert took[60_000] <= 4 * took[15_000] + 2, took


@pytest.mark.parametrize(
    "labelled",
    [
        [("a b", 1), ("c d", 0)],  # no word of three letters
        [("some words here", 1), ("", 0), (None, 0)],  # clean texts all empty
        [("", 1), ("some words here", 0)],
        [("", 1), ("", 0)],
        [("one word", 1)] * 2 + [("other words", 0)] * 40,  # no word that is known for toxic, or a few
        [("same words again", 1), ("same words again", 0)] * 3,
        [("!!! ???", 1), ("... ---", 0)],
    ],
)
def test_labelled_texts_with_nothing_to_learn_from_have_scores(spark, labelled):
    with np.errstate(all="raise", under="ignore"):
        model = toxicity.train(pd.DataFrame(labelled, columns=["text", "toxic"]))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(labelled)] + [(None, "more words"), (900, "")], "doc_id long, text string")
    scores = [r["score"] for r in toxicity.score(docs, model).collect()]
    assert len(scores) == len(labelled) + 2 and all(0 <= s <= 1 for s in scores)


def test_scores_are_the_share_of_toxic_labels_where_words_say_nothing(spark):
    labelled = [("a b", 1), ("c d", 0), ("e", 0), ("f", 0)]
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(labelled)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(labelled)], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels)
    share = sample["toxic"].mean()
    assert 0 < share < 1 or len(sample) < 4
    assert all(abs(r["score"] - share) < 1e-9 for r in toxicity.toxicity(docs, labels).collect())

"""The pipeline from end to end against a version of its own: SQL for what SQL can say, all pairs for near-duplicates, the
tokenizers library for the encodings."""

import hashlib
import random
from collections import Counter

import duckdb
import pandas as pd

import corpus_pipeline
from helixlake.llm import bpe, mixing, quality, secrets
from tests.llm.test_llm import frame, linked, text


def corpus():
    """(doc_id, text, lang, source): a source with two thirds of all rows, copies, edited copies, secrets, and texts to be rejected."""
    rng = random.Random(21)
    key = lambda n: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n - 2)) + "a1"
    out = [(i, text(rng, rng.randint(55, 200)), rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "a", "b", None])) for i in range(160)]
    base = out[9][1]
    out += [(300 + i, base, "en", rng.choice("ab")) for i in range(25)]
    for i in range(15):
        words = base.split(" ")
        words[(5 * i) % len(words)] = f"edit{i}"
        out.append((400 + i, " ".join(words), "de", "a"))
    for i in range(12):
        said = rng.choice([f"password = '{key(12)}'", f"api-key: {key(40)} AKIA{'Z' * 16}", f"token={key(8)} {'ab12' * 8}", f"é😀 secret: {key(30)}", key(44)])
        out.append((500 + i, f"{text(rng, 70)} {said} {text(rng, 30)}", "en", rng.choice("ab")))
    out += [(600, None, None, None), (601, "", "en", "a"), (602, " \n\t", "en", "b"), (603, "too few words", "en", "a"), (604, "&& ## " * 90, "en", "a"), (605, "again and again " * 60, "en", "b"), (606, text(rng, 20_000), "en", "c")]
    return out


def redacted(t, listed):
    """t with every span replaced; spans that touch or overlap by one."""
    merged = []
    for a, b in sorted(tuple(map(int, s.split(":")[1:])) for s in listed.split(",") if s):
        if merged and merged[-1][1] >= a:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    for a, b in reversed(merged):
        t = t[:a] + secrets.MARK + t[b:]
    return t


def asked(sql, docs):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang", "source"]))
    return con.sql(sql).df().to_dict("records")


def test_pipeline_from_end_to_end(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = corpus()
    frame(spark, docs).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()

    kept = {r["doc_id"] for r in asked(quality.ORACLE, docs) if r["kept"]}
    good = [d for d in docs if d[0] in kept]
    assert not kept & {600, 601, 602, 603, 604, 605}
    groups = linked(good, 5)
    single = [d for d in good if groups[d[0]][1] == d[0]]
    assert len(single) < len(good) - 20
    spans = {r["doc_id"]: r["spans"] for r in asked(secrets.ORACLE, single)}
    clean = [(i, redacted(t, spans[i]), lang, source) for i, t, lang, source in single]
    assert sum(secrets.MARK in t for _, t, _, _ in clean) >= 8
    copies = {r["doc_id"]: r["taken"] // r["size"] for r in asked(mixing.ORACLE, clean)}
    assert len(set(copies.values())) > 1
    lib = Tokenizer.from_file(public_tokenizers.path(bpe.TOKENIZER))
    want = Counter()
    for i, t, *_ in clean:
        ids = lib.encode(t, add_special_tokens=False).ids
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[(i, len(ids), digest(",".join(map(str, ids))), digest(lib.decode(ids, skip_special_tokens=False)))] = copies[i]
    assert Counter(map(tuple, got)) == +want

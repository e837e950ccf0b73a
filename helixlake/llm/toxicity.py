"""Toxicity: a subsequence string-kernel support vector machine with Nystroem landmarks.

A null or empty text has no words and gets the score of a text without insults. Repeated rows are scored each alike; an
empty table gives an empty result; without labels of both kinds every score is the share of toxic labels. Texts are
scored whole. Only the columns named are read; labels, language, source and doc_id are no inputs of a score.

The kernel of two words counts the triples of characters that they share, in order and with gaps, each weighted by
DECAY for every character that its occurrence spans; an insult with other characters put in between shares most of its
triples with the plain one. Triples that span more than SPAN + 1 characters are left out. Three or more words of one character
in a row are read as one word too, so an insult with spaces between its letters is seen. Letters of all scripts have codes.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import bounded_sample, chunks

#: Most labelled documents that training takes, and most characters of them together: the sample that reaches the driver.
SAMPLE, SAMPLE_CHARS = 6_000, 40_000_000
DECAY, SPAN = 0.7, 5
#: Landmarks, most words among the training examples (INSULTS of the first toxic ones, EXAMPLES of the clean ones), rounds of
#: choosing each toxic sentence's witness anew. They bound the training on the sample, not what is scored.
LANDMARKS, INSULTS, EXAMPLES, ROUNDS = 200, 4_000, 24_000, 3
#: The cost of missing all insults, as a share (one in RARITY) of that of all false alarms.
RARITY = 12
SENTENCE_WORDS, LONGEST, REMEMBERED = 16, 32, 200_000
THRESHOLD = 0.7
#: Letters a-z and the accented ones of Latin-1 have codes of their own, other letters share those that are left (neighbours in
#: an alphabet of up to _SIZE - _SHARED letters have different ones); all other characters have code 0.
_CODES = {chr(c): chr(c - 96) for c in range(97, 123)} | {chr(c): chr(c - 224 + 27) for c in range(224, 256)}
_SIZE, _SHARED = 96, 59
_OFFSETS = [(a, b) for b in range(2, SPAN + 1) for a in range(1, b)]
_ENDS = re.compile(r"[.!?\n|]+")
_OTHER = re.compile(r"[\W\d_]+")
_SPACED = re.compile(r"(?<!\S)(?:\w\s+){2,}\w(?!\S)")


class _Table(dict):
    def __missing__(self, key: int) -> str:
        return chr(_SHARED + key % (_SIZE - _SHARED)) if chr(key).isalpha() else "\0"


_TRANSLATE = _Table({ord(k): v for k, v in _CODES.items()})


def _codes(words: list[str]) -> np.ndarray:
    """Words of one length as a matrix of codes."""
    return np.frombuffer("".join(words).translate(_TRANSLATE).encode("latin-1"), np.uint8).reshape(len(words), -1).astype(np.int32)


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    n = codes.shape[1]
    for a, b in _OFFSETS:
        if b < n:
            yield (codes[:, : n - b] * _SIZE + codes[:, a : n - b + a]) * _SIZE + codes[:, b:], DECAY ** (b + 1)


def word_scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Scores of words as they stand; a word with characters of code 0 is scored without these too, the better counting."""
    out = _scores(words, weights)
    bare = [(i, b) for i, w in enumerate(words) if len(b := _OTHER.sub("", w)) != len(w) and b]
    if bare:
        at = [i for i, _ in bare]
        out[at] = np.maximum(out[at], _scores([b for _, b in bare], weights))
    return out


def _scores(words: list[str], weights: np.ndarray) -> np.ndarray:
    """Sum over a word's triples of their decayed weights, over the word's norm; words in pieces of LONGEST characters
    (overlapping by half) if longer, the best piece counting."""
    out = np.zeros(len(words))
    by_length: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        by_length.setdefault(len(w), []).append(i)
    for n, at in by_length.items():
        if n > LONGEST:
            for i in at:
                out[i] = _scores(_pieces(words[i]), weights).max()
            continue
        codes = _codes([words[i] for i in at])
        total, norm = np.zeros(len(at)), 0.0
        for triples, decay in _triples(codes):
            total += decay * weights[triples].sum(axis=1)
            norm += triples.shape[1] * decay * decay
        if norm:
            out[at] = total / np.sqrt(norm)
    return out


def _landmark(word: str) -> np.ndarray:
    """A word's normalised feature vector over all triples: with it as weights, word_scores() is the kernel."""
    weights, norm = np.zeros(_SIZE**3, np.float32), 0.0
    for triples, decay in _triples(_codes([word])):
        np.add.at(weights, triples.ravel(), decay)
        norm += triples.shape[1] * decay * decay
    cube = weights.reshape(_SIZE, _SIZE, _SIZE)
    cube[0], cube[:, 0], cube[:, :, 0] = 0, 0, 0  # code 0 stands for any other character and says nothing
    return weights / np.sqrt(norm) if norm else weights


def _landmarks(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The landmarks' feature vectors over the triples that any of them has, and those triples."""
    own = [(np.flatnonzero(v), v[v != 0]) for v in map(_landmark, words)]
    used = np.unique(np.concatenate([i for i, _ in own]))
    base = np.zeros((len(words), len(used)), np.float32)
    for row, (i, v) in zip(base, own, strict=True):
        row[np.searchsorted(used, i)] = v
    return base, used


def _spread(values: np.ndarray, used: np.ndarray) -> np.ndarray:
    weights = np.zeros(_SIZE**3, np.float32)
    weights[used] = values
    return weights


def _pieces(word: str) -> list[str]:
    """A word, or its pieces of LONGEST characters (overlapping by half) if it is longer."""
    return [word] if len(word) <= LONGEST else [word[k : k + LONGEST] for k in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def _kernel(words: list[str], base: np.ndarray, used: np.ndarray, rows: int = 256) -> np.ndarray:
    """Kernel of each word with each landmark, of a word's pieces the largest: triples of `rows` words at a time, times the landmarks'."""
    place = np.full(_SIZE**3, len(used), np.int64)  # what no landmark has is counted in a last column, and left out
    place[used] = np.arange(len(used))
    out, by_length = np.zeros((len(words), len(base))), {}
    for i, w in enumerate(words):
        for piece in _pieces(w):
            by_length.setdefault(len(piece), []).append((i, piece))
    for same in by_length.values():
        for k in range(0, len(same), rows):
            part = same[k : k + rows]
            codes, norm, held = _codes([x for _, x in part]), 0.0, np.zeros(len(part) * (len(used) + 1))
            for triples, decay in _triples(codes):
                at = place[triples] + np.arange(len(part))[:, None] * (len(used) + 1)
                held += decay * np.bincount(at.ravel(), minlength=len(held))
                norm += triples.shape[1] * decay * decay
            if norm:
                values = held.reshape(len(part), -1)[:, :-1].astype(np.float32) @ base.T / np.sqrt(norm)
                np.maximum.at(out, [i for i, _ in part], values)
    return out


def _words(text: str) -> list[str]:
    lower = text.lower()
    return lower.split() + ["".join(x.split()) for x in _SPACED.findall(lower)]


def _sentences(text: str) -> Iterator[list[str]]:
    for part in _ENDS.split(text):
        words = _words(part)
        for k in range(0, len(words), SENTENCE_WORDS):
            yield words[k : k + SENTENCE_WORDS]


def _svm(x: np.ndarray, y: np.ndarray, cost: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Linear support vector machine with squared hinge loss, by Newton steps on the active examples."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    active = np.ones(len(x), bool)
    for _ in range(30):
        a, c = x[active], cost[active]
        new = np.linalg.solve(ridge * np.eye(x.shape[1]) + (a * c[:, None]).T @ a, (a * c[:, None]).T @ y[active])
        now = y * (x @ new) < 1
        w, same = new, (now == active).all()
        active = now
        if same:
            break
    return w


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01) -> np.ndarray:
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


#: Shares of the words of clean sentences whose margins a level exceeds: a word is counted at each level that it reaches.
_SHARES = (0.99, 0.995, 0.998, 0.999, 0.9997)
_FEATURES = 2 * len(_SHARES) + 1


def _features(margins: np.ndarray, levels: list[float]) -> list[float]:
    """Of a document: how many words reach each level, what share of its words that is, and the largest margin."""
    if not len(margins):
        return [0.0] * (_FEATURES - 1) + [-2.0]
    counts = [int((margins >= level).sum()) for level in levels]
    return [float(np.log1p(c)) for c in counts] + [float(np.log1p(100 * c / len(margins))) for c in counts] + [float(np.clip(margins.max(), -2, 2))]


def _share(labels: list[int]) -> dict:
    """A model by which every text's score is the share of toxic labels."""
    share = min(max(sum(labels) / max(1, len(labels)), 1e-13), 1 - 1e-13)
    return {"weights": np.zeros(_SIZE**3, np.float32), "bias": -1.0, "levels": [0.0] * len(_SHARES), "calibration": [0.0] * _FEATURES + [float(np.log(share / (1 - share)))], "center": [0.0] * _FEATURES, "scale": [1.0] * _FEATURES}


def train(sample: pd.DataFrame) -> dict:
    """sample: text, toxic. Returns what scoring needs: a weight per triple, a bias and the calibration.

    A sentence has its document's label. Words that toxic sentences hold more often than clean ones begin as examples of
    insults, the words of clean sentences are the others; then, round by round, the machine names the witness of each
    toxic sentence (its word of largest margin, if positive), and is trained again on the witnesses and on the words of
    clean sentences that came out near or above zero.
    """
    toxic, clean = Counter(), Counter()
    held: list[tuple[int, list[list[str]]]] = []
    names: dict[str, str] = {}  # one object a word
    for text, label in zip(sample["text"], sample["toxic"], strict=True):
        sentences = [[names.setdefault(w, w) for w in sorted(set(s))] for s in _sentences(text or "")]
        held.append((int(label), sentences))
        for s in sentences:
            (toxic if label else clean).update(s)
    labels = [y for y, _ in held]
    n_toxic, n_clean = sum(len(s) for y, s in held if y), sum(len(s) for y, s in held if not y)
    if not 0 < sum(labels) < len(labels) or not n_toxic or not n_clean:
        return _share(labels)
    prior = n_toxic / n_clean
    excess = lambda w: (toxic[w] + 0.5) / ((clean[w] + 0.5) * prior)
    long = [w for w in toxic if len(w) >= 3]
    rank = sorted(long, key=lambda w: (-(toxic[w] - 3 * prior * clean[w]) / np.sqrt(toxic[w] + 3 * prior * clean[w] + 1), w))
    insults = {w: float(toxic[w]) for w in rank[:INSULTS] if toxic[w] >= 2 and excess(w) >= 5}
    marks = [w for w in rank if w in insults][: LANDMARKS * 3 // 4]
    marks += [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0])) if len(w) >= 4 and w not in insults][: LANDMARKS - len(marks)]
    others = [w for w, _ in sorted(clean.items(), key=lambda x: (-x[1], x[0])) if len(w) >= 3 and w not in insults]
    base, used = _landmarks(marks) if marks else (None, ())
    if not insults or not others or not len(used):  # no word of three letters, or none that toxic sentences are apart by
        return _share(labels)
    gram = _kernel(marks, base, used)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    step = max(1, (len(others) - EXAMPLES // 2) // (EXAMPLES // 2) + 1)
    others = others[: EXAMPLES // 2] + others[EXAMPLES // 2 :: step]
    vocabulary = sorted(set(toxic) | set(clean))
    weights, bias = np.zeros(_SIZE**3, np.float32), -1.0
    for _ in range(ROUNDS):
        words = list(insults) + others
        x = _kernel(words, base, used) @ root
        y = np.r_[np.ones(len(insults)), -np.ones(len(others))]
        cost = np.r_[np.sqrt(list(insults.values())), np.sqrt([clean[w] for w in others])]
        cost[: len(insults)] *= cost[len(insults) :].sum() / cost[: len(insults)].sum() / RARITY
        w = _svm(x, y, cost / cost.mean())
        weights, bias = _spread((root @ w[:-1]) @ base, used), float(w[-1])
        margin = dict(zip(vocabulary, word_scores(vocabulary, weights) + bias, strict=True))
        witnesses: Counter[str] = Counter()
        for label, sentences in held:
            if label:
                best = [max(s, key=lambda w: (margin[w], w)) for s in sentences if s]
                witnesses.update(b for b in best if margin[b] > 0)
        renewed = {w: float(n) for w, n in witnesses.items() if excess(w) >= 2}
        if not renewed or renewed.keys() == insults.keys():
            break
        insults = renewed
        missed = sorted((w for w in clean if len(w) >= 3 and margin[w] > -0.5), key=lambda w: (-clean[w] * (1 + margin[w]), w))[: EXAMPLES // 2]
        others = [w for w in dict.fromkeys(others + missed) if w not in insults]
    usual = sorted((margin[w], n) for w, n in clean.items())
    run = np.cumsum([n for _, n in usual])
    levels = [usual[min(len(usual) - 1, int(np.searchsorted(run, share * run[-1])))][0] for share in _SHARES]
    rows = []
    for text in sample["text"]:  # here, as in scoring, words keep the punctuation they end in
        words = _words(text or "")
        new = sorted(set(words).difference(margin))
        margin |= zip(new, word_scores(new, weights) + bias, strict=True)
        rows.append(_features(np.array([margin[w] for w in words]), levels))
    rows = np.array(rows)
    center, scale = rows.mean(axis=0), rows.std(axis=0) + 1e-9
    calibration = _logistic((rows - center) / scale, np.array(labels, float))
    return {"weights": weights, "bias": bias, "levels": levels, "calibration": calibration.tolist(), "center": center.tolist(), "scale": scale.tolist()}


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE, chars: int = SAMPLE_CHARS) -> pd.DataFrame:
    """At most `rows` labelled documents of the training folds, as many of them as hold `chars` characters, by a seeded digest."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(_fold(F.col("doc_id")) != 1)
    known = bounded_sample(known, "doc_id", rows)
    texts = docs.where("text is not null").select("doc_id", "text").join(F.broadcast(known), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    sizes = texts.select("doc_id", F.length("text").alias("size")).withColumn("run", F.sum("size").over(W.orderBy(F.md5(F.concat(F.lit("size:"), F.col("doc_id").cast("string"))), "doc_id")))
    within = sizes.where(F.col("run") <= chars).select("doc_id")  # of at most `rows` rows
    return texts.join(F.broadcast(within), "doc_id").toPandas().sort_values("doc_id", ignore_index=True)


def _fold(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        center, scale, calibration = np.array(m["center"]), np.array(m["scale"]), np.array(m["calibration"])
        known: dict[str, float] = {}
        for part, texts in chunks(batches):  # new words of many texts are scored at once
            split = [_words(t) for t in texts]
            if len(known) > REMEMBERED:
                known = {}
            new = list(set().union(*split).difference(known))
            known |= zip(new, (word_scores(new, m["weights"]) + m["bias"]).tolist(), strict=True)
            rows = [_features(np.fromiter(map(known.__getitem__, words), float, len(words)), m["levels"]) for words in split]
            x = (np.array(rows).reshape(-1, _FEATURES) - center) / scale
            z = 1 / (1 + np.exp(-np.clip(x @ calibration[:-1] + calibration[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(z), pa.array((z >= THRESHOLD).astype("int32"))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (_fold(F.col("doc_id")) == 1).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, train(labelled_sample(docs, labels)))

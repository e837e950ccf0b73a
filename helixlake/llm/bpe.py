"""BPE encoding and decoding by prefix-sharing trie traversal.

A null text counts as empty; an empty text has no tokens. Repeated rows are encoded each alike and an empty table gives
an empty result. Texts of any length are taken whole: time and memory grow in proportion. Only the columns named are
read. The tokenizer file is a parameter and is never changed.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks

TOKENIZER = "byte_bpe_50k.json"
#: Bytes of words with their encodings (twice that, with those of the generation before), and pairs of tokens, that a worker remembers from slice
#: to slice and task to task.
REMEMBERED, PAIRS = 32_000_000, 300_000
#: What an entry of a dictionary takes besides its word and encoding.
ENTRY = 200


class Encoder:
    """Byte-level BPE of a tokenizer file: no normaliser, byte-level splitting, added tokens taken as they stand."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that the file writes as themselves
        code = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        to_bytes = lambda token: bytes(code[c] for c in token)
        self.bytes_of = {i: to_bytes(t) for t, i in vocab.items() if t not in added} | {i: t.encode() for t, i in added.items()}
        self.added = added
        self.split_added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.words = regex.compile(public_tokenizers.PATTERN)
        self.rank: dict[tuple[int, int], int] = {}
        self.parts = parts = {}  # of a token that a merge makes: both halves, the merge's rank
        for n, m in enumerate(merges):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[vocab[a], vocab[b]] = n
            parts.setdefault(vocab[a + b], (vocab[a], vocab[b], n))
        self.never = len(merges)
        self.single = {self.bytes_of[i]: i for t, i in vocab.items() if t not in added and len(t) == 1}
        self.token = dict(self.single)
        for t, (a, b, n) in sorted(parts.items(), key=lambda x: x[1][2]):
            if self._own(self.bytes_of[t]) == (t,):
                self.token[self.bytes_of[t]] = t
        self.reach: dict[bytes, int] = {}  # by its last three bytes, how long a token can be
        for piece in self.token:
            self.reach[piece[-3:]] = max(len(piece), self.reach.get(piece[-3:], 0))
        self.fits: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}  # ids as 32-bit integers, which take half the room of a tuple
        self.held = 0  # bytes of known
        self.before: dict[str, bytes] = {}  # what was known until it was full: words that come again are taken over

    def _edge(self, token: int, side: int) -> Iterator[tuple[int, int]]:
        """The tokens that stand at a token's left (0) or right (1) end while it is put together, each with the rank of the
        merge that takes it up."""
        parts, rank = self.parts, self.never
        while True:
            yield token, rank
            if token not in parts:
                return
            left, right, rank = parts[token]
            token = right if side else left

    def _own(self, piece: bytes) -> tuple[int, ...]:
        """Merge by merge, as BPE is defined: only used to see which vocabulary entries encode to themselves."""
        ids = [self.single[piece[i : i + 1]] for i in range(len(piece))]
        while len(ids) > 1:
            best = min(range(len(ids) - 1), key=lambda i: (self.rank.get((ids[i], ids[i + 1]), 1 << 30), i))
            if (ids[best], ids[best + 1]) not in self.rank:
                break
            merged = self._joined[ids[best], ids[best + 1]]
            ids[best : best + 2] = [merged]
        return tuple(ids)

    @property
    def _joined(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_joined_"):
            inverse = {b: i for i, b in self.bytes_of.items()}
            self._joined_ = {(a, b): inverse[self.bytes_of[a] + self.bytes_of[b]] for a, b in self.rank}
        return self._joined_

    def follows(self, a: int, b: int) -> bool:
        """Whether a then b stay two tokens. They don't if, at some moment, x at a's end and y at b's start could merge
        before (at a tie: leftmost first) either was taken up into a larger token of its own side."""
        key = a << 20 | b
        if (known := self.fits.get(key)) is None:
            rank = self.rank
            known = not any((r := rank.get((x, y))) is not None and r < x_taken and r <= y_taken for x, x_taken in self._edge(a, 1) for y, y_taken in self._edge(b, 0))
            self.fits[key] = known
        return known

    def learn(self, words: Iterable[str]) -> None:
        """Encode distinct words by a depth-first walk of their trie.

        The trie is held as its words in byte order: neighbours share the path of their common prefix. A node's state is
        the last token of the encoding of the bytes on the path to it, and where that token starts; states on the shared
        part of the path are kept as they are, those below are computed from the states above them. A node's encoding is
        the chain of last tokens back to the root.
        """
        token, follows, reach, fits = self.token, self.follows, self.reach, self.fits
        last: list[int] = []
        start: list[int] = []
        before = b""
        for piece, word in sorted((w.encode(), w) for w in words):
            n = len(piece)
            if piece in token:
                self.known[word] = array("I", (token[piece],)).tobytes()
                self.held += n + ENTRY
                continue
            shared = 0
            for x, y in zip(before, piece):
                if x != y:
                    break
                shared += 1
            del last[shared:], start[shared:]
            for end in range(shared + 1, n + 1):
                # Only one last token is right, so any order of trying will do: mostly it goes on with the one before, or begins anew.
                at = start[-1] if start else 0
                t = token.get(piece[at:end])
                if t is not None and at:
                    fit = fits.get(last[at - 1] << 20 | t)
                    if not (follows(last[at - 1], t) if fit is None else fit):
                        t = None
                if t is None:
                    at = end - 1
                    t = token[piece[at:end]]
                    if at and not follows(last[at - 1], t):
                        for at in range(max(0, end - reach.get(piece[max(0, end - 3) : end], 2)), end - 1):
                            t = token.get(piece[at:end])
                            if t is not None and (at == 0 or follows(last[at - 1], t)):
                                break
                last.append(t)
                start.append(at)
            before = piece
            ids, at = [], n
            while at:
                ids.append(last[at - 1])
                at = start[at - 1]
            ids.reverse()
            self.known[word] = array("I", ids).tobytes()
            self.held += n + 4 * len(ids) + ENTRY

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        split = []
        for text in texts:
            pieces = self.split_added.split(text) if self.split_added and any(a in text for a in self.added) else [text]
            split.append([[p] if p in self.added else self.words.findall(p) for p in pieces])
        words = set(chain.from_iterable(chain.from_iterable(split)))
        if self.held > REMEMBERED:
            self.before, self.known, self.held = self.known, {}, 0
        if len(self.fits) > PAIRS:
            self.fits = {}
        self.known |= {a: array("I", (i,)).tobytes() for a, i in self.added.items()}
        known, before = self.known, self.before
        new = words - known.keys()
        for word in new & before.keys():
            known[word] = before[word]
            self.held += len(word) + len(before[word]) + ENTRY
        self.learn(new - before.keys())
        for pieces in split:
            yield memoryview(b"".join(map(known.__getitem__, chain.from_iterable(pieces)))).cast("I").tolist()

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", errors="replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids array<int>, decoded string of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path or public_tokenizers.path(TOKENIZER))
        for part, texts in chunks(batches):
            ids = list(bpe.encode_batch(texts))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array(map(bpe.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode() with its outputs digested where they are made."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path or public_tokenizers.path(TOKENIZER))
        for part, texts in chunks(batches):
            rows = [(len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest()) for ids in bpe.encode_batch(texts)]
            n, one, two = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(one), pa.array(two)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

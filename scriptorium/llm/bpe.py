"""Byte-pair encoding by backtracking over longest token matches, and decoding through an offset table.

An Aho-Corasick automaton reads a word once and gives its longest tokens from left to right. A token may follow another
only where a pair-compatibility table says that merging in rank order would leave the border between them alone; where
all borders hold, the tokens are the result. Else the encoder goes back to the place and tries the next shorter token,
and the longest ones again from there. Places found to be dead ends are marked, so each place is left at most once for
each token that ends there, and the result equals that of the merges.

The vocabulary file is a parameter; without one the environment variable SCRIPTORIUM_BPE names it, and without that the
installed public_tokenizers package. It has to lie at that path on every executor.

Defined results: null and empty texts give no ids and decode to the empty text; repeated texts give equal ids; an empty
table gives no rows; extra columns are kept.
"""

from __future__ import annotations

import hashlib
import json
import os
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm.common import read, small_batches

#: The place of the vocabulary on this machine and on the executors; it is a parameter of every function here.
VOCABULARY = os.environ.get("SCRIPTORIUM_BPE", "")
#: Words whose ids a worker remembers at once, and borders between tokens of which it knows whether the merges keep them.
REMEMBERED, BORDERS = 400_000, 500_000

# Fixed value: the split into words that byte-level vocabularies of this kind are made for.
WORD = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    if VOCABULARY:
        return VOCABULARY
    import public_tokenizers

    return str(public_tokenizers.path(name))


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, more = {}, 0
    for b in range(256):
        if b in printable:
            letters[b] = chr(b)
        else:
            letters[b] = chr(256 + more)
            more += 1
    return [letters[b] for b in range(256)]


class Bpe(dict):
    """Words and the packed ids that they encode to; a word not yet known is encoded when it is looked up.

    Tokens have two numbers here: their id in the vocabulary, and their rank, by which the merges are ordered
    (0 to 255 are the single bytes).
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        letters = byte_letters()
        byte_of = {c: bytes([b]) for b, c in enumerate(letters)}
        self.words = regex.compile(WORD)
        self.halves: list[tuple[int, int] | None] = [None] * 256
        rank_of = {c: b for b, c in enumerate(letters)}
        self.merged: dict[tuple[int, int], int] = {}
        names = list(letters)
        for pair in merges:
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            ranks = rank_of[a], rank_of[b]
            if a + b not in rank_of:
                rank_of[a + b] = len(names)
                names.append(a + b)
                self.halves.append(ranks)
            self.merged.setdefault(ranks, rank_of[a + b])
        self.id_bytes = [int(vocab[x]).to_bytes(4, "little") for x in names]
        self.lengths = [len(x) for x in names]
        self.letters = str.maketrans({chr(b): c for b, c in enumerate(letters)})
        self.specials = {t["content"]: int(t["id"]).to_bytes(4, "little") for t in spec.get("added_tokens") or []}
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.compatible: dict[int, bool] = {}  # by left << 32 | right
        # A token that the merges would not leave whole can never appear in a result.
        self.rank_of = rank_of
        self.automaton = ahocorasick.Automaton()
        for name, rank in rank_of.items():
            self.automaton.add_word(name, rank)
        self.automaton.make_automaton()
        # The longest token that each path of the automaton begins with; for stepping back, the next shorter one.
        self.longest: dict[str, int] = {}
        for name in names:
            for n in range(1, len(name) + 1):
                if name[:n] not in self.longest:
                    self.longest[name[:n]] = rank_of[name[:n]] if name[:n] in rank_of else self.longest[name[: n - 1]]
        self.shorter = [self.longest[x[:-1]] if len(x) > 1 else -1 for x in names]
        self.most = max(self.lengths)
        # The offset table for decoding: one run of bytes, and where each id's bytes begin.
        pieces: dict[int, bytes] = {int.from_bytes(b, "little"): b"".join(byte_of[c] for c in x) for b, x in zip(self.id_bytes, names, strict=True)}
        pieces |= {int.from_bytes(b, "little"): x.encode() for x, b in self.specials.items()}
        most = max(pieces) + 1
        self.blob = np.frombuffer(b"".join(pieces.get(i, b"") for i in range(most)), np.uint8)
        self.starts = np.concatenate([[0], np.cumsum([len(pieces.get(i, b"")) for i in range(most)])]).astype(np.int64)

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges keep the border between two tokens that stand side by side."""
        # Undo merges from the latest back, on whichever side made it: a merge across the border that
        # comes before the one undone would have been made first.
        limit, a, b, ok = len(self.halves), left, right, True
        while True:
            across = self.merged.get((a, b))
            if across is not None and across < limit:
                ok = False
                break
            if a > b:
                if self.halves[a] is None:
                    break
                limit, a = a, self.halves[a][1]
            else:
                if self.halves[b] is None:
                    if self.halves[a] is None:
                        break
                    limit, a = a, self.halves[a][1]
                else:
                    limit, b = b + 1, self.halves[b][0]
        if len(self.compatible) >= BORDERS:
            self.compatible.clear()
        self.compatible[left << 32 | right] = ok
        return ok

    def ranks(self, word: str) -> list[int]:
        """The tokens of a word of byte letters."""
        out = [token for _, token in self.automaton.iter_long(word)]
        compatible, last = self.compatible, -1
        if sum(map(self.lengths.__getitem__, out)) != len(word):
            return self.step_back(word)
        for token in out:
            if last >= 0:
                ok = compatible.get(last << 32 | token)
                if not (self.fits(last, token) if ok is None else ok):
                    return self.step_back(word)
            last = token
        return out

    def step_back(self, word: str) -> list[int]:
        """The tokens of a word whose longest tokens do not fit together."""
        path, longest, lengths, compatible, most, n = self.automaton.longest_prefix, self.longest, self.lengths, self.compatible, self.most, len(word)
        out: list[int] = []
        at, dead, last = 0, None, -1
        token = longest[word[: path(word[:most])]]
        while True:
            end = at + lengths[token]
            if dead is None or end not in dead:
                ok = last < 0 or compatible.get(last << 32 | token)
                if ok is None:
                    ok = self.fits(last, token)
                if ok:
                    out.append(token)
                    if end == n:
                        return out
                    at, last = end, token
                    rest = word[at : at + most]
                    token = longest[rest[: path(rest)]]
                    continue
            token = self.shorter[token]
            while token < 0:  # nothing fits here: this place is a dead end
                dead = dead or set()
                dead.add(at)
                token = out.pop()
                at -= lengths[token]
                last = out[-1] if out else -1
                token = self.shorter[token]

    def __missing__(self, word: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.clear()
        letters = (word if word.isascii() else word.encode().decode("latin-1")).translate(self.letters)
        packed = b"".join([self.id_bytes[r] for r in self.ranks(letters)])
        if len(word) <= 64:
            self[word] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        parts = self.special.split(text) if self.special else [text]
        if len(parts) == 1:
            return b"".join(map(self.__getitem__, self.words.findall(text)))
        return b"".join(self.specials[p] if i % 2 else b"".join(map(self.__getitem__, self.words.findall(p))) for i, p in enumerate(parts))

    def decode(self, packed: bytes) -> str:
        ids = np.frombuffer(packed, "<u4")
        if not len(ids):
            return ""
        first = self.starts[ids]
        size = self.starts[ids.astype(np.int64) + 1] - first
        ends = np.cumsum(size)
        if not ends[-1]:
            return ""
        at = np.arange(ends[-1]) + np.repeat(first - (ends - size), size)
        return self.blob[at].tobytes().decode("utf-8", "replace")


@cache
def load(path: str) -> Bpe:
    return Bpe(path)


def bpe_encode(text: Column | str, path: str | None = None) -> Column:
    """The ids of a text column as array<int>."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        bpe = load(path or vocabulary_path())
        packed = [bpe.encode(t.as_py()) for t in texts]
        ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))

    return encode(F.col(text) if isinstance(text, str) else text)


def bpe_decode(ids: Column | str, path: str | None = None) -> Column:
    """The text of a column of ids; null gives the empty text."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        bpe = load(path or vocabulary_path())
        flat = lists.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype("<u4")  # without the ids of null lists
        ends = np.cumsum(pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False))
        return pa.array([bpe.decode(flat[a:b].tobytes()) for a, b in zip(np.r_[0, ends[:-1]][: len(ends)], ends, strict=True)], pa.string())

    return decode(F.col(ids) if isinstance(ids, str) else ids)


ROUND_TRIP = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string,same:boolean>"


def round_trip(text: Column | str, path: str | None = None) -> Column:
    """Encodes and decodes each whole text in one pass: the number of ids, digests of both, and whether they agree."""

    @F.arrow_udf(ROUND_TRIP)
    def trip(texts: pa.Array) -> pa.Array:
        bpe = load(path or vocabulary_path())
        n, ids, decoded, same = [], [], [], []
        for t in texts:
            text = t.as_py() or ""
            packed = bpe.encode(text)
            back = bpe.decode(packed)
            n.append(len(packed) // 4)
            ids.append(hashlib.sha256(packed).hexdigest())
            decoded.append(hashlib.sha256(back.encode()).hexdigest())
            same.append(back == text)
        return pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.array(same, pa.bool_())], ["n_tokens", "ids_sha256", "decoded_sha256", "same"])

    return trip(F.col(text) if isinstance(text, str) else text)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every whole text of documents and what they decode to, as digests."""
    small_batches(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", round_trip("text").alias("_r"))
    return docs.select("doc_id", "_r.n_tokens", "_r.ids_sha256", "_r.decoded_sha256", F.col("_r.same").alias("round_trips"))

"""Operator 10: byte-level BPE by speculation and verification.

A text is cut into words by the tokenizer's pattern. Greedy longest match proposes tokens for
each word. A sequence of tokens is what merging would give exactly when each token is the
encoding of its own bytes and each adjacent pair is the encoding of its joined bytes, so all
adjacent pairs of a batch are looked up at once; pairs not met before are settled by merging
their bytes. Only words with a pair that fails are merged in full.

Null texts are empty: no ids, empty decoded text. Very long texts are encoded whole; words of
any length merge in ``n log n``. Special tokens in a text are matched first, as the tokenizer's
own library does. Memory is bounded: caches are emptied at a fixed number of entries.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from typing import Any

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers.pre_tokenizers import ByteLevel

from lakeconform.llm.common import slices

# Fixed value: the pattern of the tokenizer, as its library documents it.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Letters on which pattern and tokenizer agree in any Unicode version: Latin to Cyrillic,
# punctuation, Han, kana and hangul. Texts with others are split by the tokenizer's own rule.
SETTLED = r"[^\x00-\u0557\u2010-\u205e\u3000-\ua48c\uac00-\ud7a3]"
WORD_CACHE = 300_000
PAIR_CACHE = 2_000_000
LONG_WORD = 100
UNMERGED = 1 << 40


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in plain)
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizer:
    """Vocabulary and merges of one file, with what has been learnt about words and pairs."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters = byte_letters()
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        to_bytes = {t: bytes(letters[c] for c in t) for t in vocab}
        self.ids = {to_bytes[t]: i for t, i in vocab.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in merges)
        self.ranks: dict[int, int] = {}
        self.joined: list[int] = []
        for rank, (a, b) in enumerate(pairs):
            self.ranks[(vocab[a] << 32) | vocab[b]] = rank
            self.joined.append(vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in self.ids.items():
            self.tokens[i] = token
        for token, i in self.special.items():
            self.tokens[i] = token.encode()
        self.lengths = np.array([len(t) for t in self.tokens])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)])[:-1]
        self.blob = np.frombuffer(b"".join(self.tokens), np.uint8)
        self.bytes_ids = [self.ids[bytes([b])] for b in range(256)]
        longest: dict[bytes, int] = {}
        for token in self.ids:
            longest[token[:2]] = max(longest.get(token[:2], 1), len(token))
        self.longest = longest
        self.pattern = regex.compile(PATTERN)
        self.unsettled = regex.compile(SETTLED)
        self.own_split = ByteLevel(add_prefix_space=False).pre_tokenize_str
        # Longest first, so that one special token inside another does not hide it.
        names = sorted(self.special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.words: dict[Any, bytes] = {}  # ids as little-endian 32-bit integers
        self.forget()
        self.pairs: dict[int, bool] = {}
        self.alone: dict[int, bool] = {}

    def forget(self) -> None:
        """Start a new word cache; what the last one held is taken over when it is met again.

        The ids of special tokens stand for themselves.
        """
        special = {i: np.array([i], "<u4").tobytes() for i in self.special.values()}
        self.older, self.words = self.words, special

    def rest(self) -> None:
        """Let go of what was learnt: between tasks the worker may serve other operators."""
        self.forget()
        self.older = {}
        self.pairs.clear()

    def merge(self, word: bytes) -> list[int]:
        """Exact BPE: the lowest rank first, the leftmost of equal ranks."""
        if len(word) > LONG_WORD:
            return self.merge_long(word)
        ids = [self.bytes_ids[b] for b in word]
        known, joined = self.ranks.get, self.joined
        ranks = [known((a << 32) | b, UNMERGED) for a, b in pairwise(ids)]
        while ranks and (rank := min(ranks)) < UNMERGED:
            i = ranks.index(rank)
            ids[i] = new = joined[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = known((ids[i - 1] << 32) | new, UNMERGED)
            if i < len(ranks):
                ranks[i] = known((new << 32) | ids[i + 1], UNMERGED)
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """The same for long words, with a heap and linked neighbours."""
        ids = [self.bytes_ids[b] for b in word]
        n, ranks, results = len(ids), self.ranks, self.joined
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            if (rank := ranks.get((ids[i] << 32) | ids[i + 1])) is not None:
                heap.append((rank, i, ids[i], ids[i + 1]))
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = results[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                b = ids[after[i]]
                if (rank := ranks.get((ids[i] << 32) | b)) is not None:
                    heapq.heappush(heap, (rank, i, ids[i], b))
            if before[i] >= 0:
                k = before[i]
                if (rank := ranks.get((ids[k] << 32) | ids[i])) is not None:
                    heapq.heappush(heap, (rank, k, ids[k], ids[i]))
        return [i for i in ids if i >= 0]

    def propose(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        found, at, n, ids, longest = [], 0, len(word), self.ids, self.longest
        while at < n:
            end = min(n, at + longest.get(word[at : at + 2], 1))
            while (i := ids.get(word[at:end])) is None:
                end -= 1
            found.append(i)
            at = end
        return found

    def learn(self, words: list[str]) -> None:
        """Encode words not met before: propose all, test all pairs at once, merge the rest."""
        if len(self.pairs) > PAIR_CACHE:
            self.pairs.clear()
        raw = [w.encode() for w in words]
        proposed = [self.propose(w) for w in raw]
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        flat = np.fromiter((i for p in proposed for i in p), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(proposed)), sizes)
        codes = (flat[:-1] << 32) | flat[1:]
        inner = np.flatnonzero(owner[:-1] == owner[1:])
        distinct, place = np.unique(codes[inner], return_inverse=True)
        fits = np.fromiter(map(self.compatible, distinct.tolist()), bool, len(distinct))
        single, where = np.unique(flat, return_inverse=True)
        whole = np.fromiter(map(self.own, single.tolist()), bool, len(single))
        bad = np.zeros(len(proposed), bool)
        bad[owner[inner][~fits[place]]] = True
        bad[owner[~whole[where]]] = True
        packed, ends = flat.astype("<u4").tobytes(), np.cumsum(sizes * 4).tolist()
        found = [packed[a:b] for a, b in zip([0, *ends], ends, strict=False)]
        for k in np.flatnonzero(bad).tolist():
            found[k] = np.array(self.merge(raw[k]), "<u4").tobytes()
        self.words.update(zip(words, found, strict=True))

    def compatible(self, code: int) -> bool:
        known = self.pairs.get(code)
        if known is None:
            a, b = code >> 32, code & 0xFFFFFFFF
            known = self.pairs[code] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return known

    def own(self, token: int) -> bool:
        known = self.alone.get(token)
        if known is None:
            known = self.alone[token] = self.merge(self.tokens[token]) == [token]
        return known

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self.unsettled.search(text):
            return self.pattern.findall(text)
        return [text[a:b] for _, (a, b) in self.own_split(text)]

    def pieces(self, text: str) -> list[Any]:
        """Words, and the ids of special tokens between them."""
        if self.cut is None or not any(name in text for name in self.special):
            return self.split(text)
        found: list[Any] = []
        for part in self.cut.split(text):
            if part in self.special:
                found.append(self.special[part])
            elif part:
                found.extend(self.split(part))
        return found

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        parts = [self.pieces(t) for t in texts]
        distinct = set().union(*parts)
        fresh = distinct.difference(self.words)
        if len(self.words) + len(fresh) > WORD_CACHE:
            self.forget()
            fresh = distinct.difference(self.words)
        if old := fresh & self.older.keys():
            self.words.update((w, self.older[w]) for w in old)
            fresh -= old
        if fresh:
            self.learn(list(fresh))
        known = self.words.__getitem__
        return [np.frombuffer(b"".join(map(known, p)), "<u4") for p in parts]

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the decoded text; bytes that are not UTF-8 become replacement signs."""
        if not len(ids):
            return b""
        sizes = self.lengths[ids]
        ends = np.cumsum(sizes)
        index = np.repeat(self.starts[ids] - (ends - sizes), sizes) + np.arange(int(ends[-1]))
        return self.blob[index].tobytes().decode("utf-8", errors="replace").encode()


@lru_cache(maxsize=2)
def tokenizer(path: str) -> Tokenizer:
    """One per worker and file; its tables serve all tasks of the worker."""
    return Tokenizer(path)


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """Per document: id, number of tokens, digests of the ids and of the decoded text.

    ``with_ids`` adds the ids themselves. ``path`` is a tokenizer file that every executor has.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        try:
            for batch in batches:
                texts = batch.column(1)
                for start, end in slices(texts):
                    part = [t or "" for t in texts.slice(start, end - start).to_pylist()]
                    found = bpe.encode_batch(part)
                    columns = [
                        batch.column(0).slice(start, end - start),
                        pa.array([len(f) for f in found], pa.int64()),
                        pa.array([hashlib.sha256(f.tobytes()).hexdigest() for f in found], pa.string()),
                        pa.array([hashlib.sha256(bpe.decode(f)).hexdigest() for f in found], pa.string()),
                    ]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                    if with_ids:
                        columns.append(pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names=names)
        finally:
            bpe.rest()

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select("doc_id", "text").mapInArrow(run, schema + ", ids array<int>" * with_ids)

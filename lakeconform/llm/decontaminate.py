"""Operator 4: documents that hold a benchmark item, found by SimHash of item-sized windows.

Words are runs of ASCII letters and digits and of characters beyond ASCII, ASCII letters in
lower case. An item and a window with as many words are compared as multisets of five-word
shingles (items with fewer words: the whole item). A text with fewer words than the item is
compared whole, as the one window. A window matches if

* its 64-bit SimHash is within ``radius`` bits of the item's. The 64 bits are cut into
  :data:`BLOCKS`; two prints within the radius differ by at most ``radius // len(BLOCKS)`` in
  some block (pigeonhole), so looking up every block with that tolerance loses none; and
* the exact weighted similarity, the sum of smaller over the sum of larger shingle counts, is
  at least ``threshold``.

Windows are built only where they can match: a similarity above zero needs a shared shingle, so
every window over each shared shingle is tried, and no other.

Per document and item the most similar window is given, the first of equals. Null and empty
texts and items match nothing. Rows with the same id are separate documents. Items are read in
blocks of bounded bytes; each block is matched against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import slices
from lakeconform.llm.textarrays import ALNUM, mixed, window_hashes, words_of

WIDTH = 5
THRESHOLD = 0.8
RADIUS = 20
BLOCKS = (9, 9, 9, 9, 9, 9, 10)
# Bytes of benchmark text that every task may hold at once.
ITEM_BYTES = 16_000_000


def bit_signs(hashes: np.ndarray) -> np.ndarray:
    """One row per hash: +1 where its bit is set, else -1."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def prints_of(signs: np.ndarray, span: int) -> np.ndarray:
    """SimHash of every run of ``span`` rows, from running sums."""
    total = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0)])
    bits = (total[span:] - total[:-span]) > 0
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


class Items:
    """A block of benchmark items: shingles, prints and the block look-up."""

    def __init__(self, ids: list, texts: list[str | None], radius: int) -> None:
        words = words_of(pa.array(texts, pa.large_string()), ALNUM)
        self.radius = radius
        self.ids: list = []
        self.sizes, self.prints, self.shingles = [], [], []
        for i, item in enumerate(ids):
            own = words.hashes[words.rows[i] : words.rows[i + 1]]
            if not len(own):
                continue
            found = window_hashes(own, min(WIDTH, len(own)))
            self.ids.append(item)
            self.sizes.append(len(own))
            self.shingles.append(np.unique(found, return_counts=True))
            self.prints.append(prints_of(bit_signs(mixed(found)), len(found))[0])
        self.sizes = np.array(self.sizes, np.int64)
        self.prints = np.array(self.prints, np.uint64)
        self.anchors: dict[int, tuple] = {}
        for width in sorted(set(np.minimum(self.sizes, WIDTH).tolist())):
            which = np.flatnonzero(np.minimum(self.sizes, WIDTH) == width)
            keys = np.concatenate([self.shingles[i][0] for i in which])
            owner = np.repeat(which, [len(self.shingles[i][0]) for i in which])
            order = np.argsort(keys, kind="stable")
            seen = np.zeros(1 << 22, bool)
            seen[keys >> np.uint64(42)] = True
            self.anchors[width] = keys[order], owner[order], seen
        self.tables, shift = [], 0
        for bits in BLOCKS:
            own = (self.prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            apart = np.bitwise_count(np.arange(1 << bits, dtype=np.uint64)[:, None] ^ own)
            self.tables.append((shift, bits, apart <= radius // len(BLOCKS)))
            shift += bits

    def near(self, prints: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Pairs (print, place in ``which``) within the radius, by blocks and then in full."""
        close = np.zeros((len(prints), len(which)), bool)
        for shift, bits, table in self.tables:
            value = (prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
            close |= table[value][:, which]
        at = np.argwhere(close)
        apart = np.bitwise_count(prints[at[:, 0]] ^ self.prints[which[at[:, 1]]])
        return at[apart <= self.radius]

    def match(self, words: np.ndarray, width: int, shingles: np.ndarray, hits: np.ndarray, threshold: float) -> list[tuple]:
        """The best window of each item in one text; ``hits`` are places of shared shingles."""
        keys, owner, _ = self.anchors[width]
        low, high = np.searchsorted(keys, shingles[hits]), np.searchsorted(keys, shingles[hits], "right")
        place = np.repeat(hits, high - low)
        item = owner[np.concatenate([np.arange(a, b) for a, b in zip(low, high, strict=True)])]
        found = []
        sizes = np.minimum(self.sizes[item], len(words))
        for size in np.unique(sizes).tolist():
            own = sizes == size
            span = size - width + 1
            starts = np.unique((place[own][:, None] - np.arange(span)).ravel())
            starts = starts[(starts >= 0) & (starts + size <= len(words))]
            which = np.unique(item[own])
            best: dict[int, tuple] = {}
            # Runs of neighbouring starts share their sums.
            for run in np.split(starts, np.flatnonzero(np.diff(starts) > 1) + 1) if len(starts) else []:
                part = shingles[run[0] : run[-1] + span]
                prints = prints_of(bit_signs(mixed(part)), span)
                for window, k in self.near(prints, which).tolist():
                    score = similarity(part[window : window + span], self.shingles[which[k]])
                    if score >= threshold and score > best.get(which[k], (0.0,))[0]:
                        best[int(which[k])] = (score, int(run[0] + window), size)
            found.extend((self.ids[i], *b) for i, b in best.items())
        return found


def similarity(window: np.ndarray, item: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of smaller over sum of larger counts of two multisets of shingles."""
    values, counts = np.unique(window, return_counts=True)
    at = np.minimum(np.searchsorted(item[0], values), len(item[0]) - 1)
    both = item[0][at] == values
    shared = int(np.minimum(counts[both], item[1][at[both]]).sum())
    return shared / (len(window) + int(item[1].sum()) - shared)


def matches_of(texts: pa.Array, items: Items, threshold: float) -> list[list[tuple]]:
    """Matches of each text: item, similarity, first word and number of words of the window."""
    words = words_of(texts, ALNUM)
    found: list[list[tuple]] = [[] for _ in range(len(texts))]
    for width, (keys, _, seen) in items.anchors.items():
        whole = window_hashes(words.hashes, width)
        hits = np.flatnonzero(seen[whole >> np.uint64(42)])
        at = np.minimum(np.searchsorted(keys, whole[hits]), len(keys) - 1)
        hits = hits[keys[at] == whole[hits]]
        row = np.searchsorted(words.rows, hits, "right") - 1
        inside = hits + width <= words.rows[row + 1]
        hits, row = hits[inside], row[inside]
        for r in np.unique(row).tolist():
            low, high = words.rows[r], words.rows[r + 1]
            found[r].extend(
                items.match(
                    words.hashes[low:high],
                    width,
                    whole[low : high - width + 1],
                    hits[row == r] - low,
                    threshold,
                )
            )
    return found


def item_blocks(benchmark: DataFrame, id_column: str, text: str, limit: int) -> Iterator[tuple[list, list]]:
    """The benchmark in blocks of about ``limit`` bytes, each small enough for every task."""
    picked = benchmark.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    size = picked.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    blocks = int(size // limit + 1)
    for k in range(blocks):
        rows = picked.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k).collect()
        rows.sort(key=lambda r: (r[0] is None, r[0], r[1] or ""))
        yield [r[0] for r in rows], [r[1] for r in rows]


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    radius: int = RADIUS,
) -> DataFrame:
    """Columns ``keep`` of every document and its ``matches``, empty for a clean one."""
    kind = benchmark.schema[item_id].dataType
    match = f"array<struct<item_id:{kind.simpleString()},similarity:double,start_word:bigint,n_words:bigint>>"
    df = docs.select(*keep, F.col(text).alias("_text"), F.array().cast(match).alias("matches"))
    for ids, texts in item_blocks(benchmark, item_id, item_text, ITEM_BYTES):
        df = df.mapInArrow(_scanner(ids, texts, threshold, radius), df.schema)
    return df.drop("_text")


def _scanner(ids: list, texts: list, threshold: float, radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = Items(ids, texts, radius)
        names = ("item_id", "similarity", "start_word", "n_words")
        for batch in batches:
            at = batch.schema.get_field_index("matches")
            column = batch.column("_text")
            for a, b in slices(column):
                part = batch.slice(a, b - a)
                found = matches_of(column.slice(a, b - a), items, threshold) if items.ids else []
                if any(found):
                    earlier = part.column("matches").to_pylist()
                    merged = [
                        e + [dict(zip(names, f, strict=True)) for f in sorted(m, key=lambda f: f[2:])]
                        for e, m in zip(earlier, found, strict=True)
                    ]
                    part = part.set_column(at, part.schema.field(at), pa.array(merged, part.schema.field(at).type))
                yield part

    return run


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and item found in it."""
    found = scan(docs, benchmark, ["doc_id"]).filter(F.size("matches") > 0)
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a match, all columns kept."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    found = scan(plain, benchmark, plain.columns, text=names["text"])
    return found.filter(F.size("matches") == 0).drop("matches").toDF(*docs.columns)

"""Operator 12: alignment of two tokenizers' tokens, by divide and conquer at shared cuts.

Tokens of A (byte-level BPE, over a space and the text) and of B (pieces, over the text) cover
the same bytes. A byte at which tokens of both end is a shared cut. An interval is divided at a
shared cut near its middle: the end of the middle A token is sought among the ends of B by
bisection, then its neighbours', further and further out; both halves are taken on in the same
way. An interval without a cut inside is a group. All texts of a batch are one interval to begin
with, as their ends are shared cuts, and every step treats all intervals at once.

An A and a B token are linked if they share a group. How many documents hold a pair of ids linked
is counted over the corpus: tasks count their documents first, then the partial counts are
summed. For the scores, the most frequent pairs, at most :data:`LOOKED_UP` of them, are looked up
in the tasks; all others are joined by a shuffle, so the sums are exact at any size.

Null and empty texts, and texts whose tokens do not spell out the space and the text (B may
normalise), have no tokens: zeros and an empty ``groups_sha256``. A text of any length is aligned
whole; a group with many tokens links its distinct ids with their multiplicity, never occurrence
by occurrence. Repeated rows and ids are documents of their own. Extra columns are unused.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.bpe import Tokenizer
from lakeconform.llm.common import slices, stored

# Bound on the id pairs that tasks look up (16 bytes each); the rest is joined.
LOOKED_UP = 1 << 20
# Pairs a task counts before it hands its counts on.
HELD_PAIRS = 4_000_000
# Groups with more occurrence pairs than this are linked by distinct ids.
SMALL_GROUP = 4096
SHIFT = 32
LOW = (1 << SHIFT) - 1


class Pieces:
    """B: pieces of a sentencepiece model and the bytes each stands for."""

    def __init__(self, path: str) -> None:
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        names = self.model.id_to_piece(list(range(size)))
        self.tokens = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in enumerate(names)
        ]

    def spell(self, ids: list[int]) -> bytes:
        return b"".join([self.tokens[i] for i in ids])


class Aligner:
    """Both tokenizers, the bytes of their tokens and the written form of their ids."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a = Tokenizer(path_a)
        self.a.cut = None  # special tokens' strings inside texts are plain text
        self.b = Pieces(path_b)
        self.bytes_a, self.bytes_b = (
            np.array([len(t) for t in tokens], np.int64) for tokens in (self.a.tokens, self.b.tokens)
        )
        self.written = [f"{i}{sign}" for i in range(max(len(self.a.tokens), len(self.b.tokens))) for sign in ",|;"]

    def encode(self, texts: list[str]) -> tuple[list[np.ndarray], list[list[int]]]:
        """Ids of A and B per text; none where B does not spell out the space and the text.

        A always does: its tokens are the bytes of the text it was given, cut into runs.
        """
        ids_a = self.a.encode_batch([" " + t for t in texts])
        ids_b = self.b.model.encode(texts, num_threads=1)
        for k, text in enumerate(texts):
            if not text or self.b.spell(ids_b[k]) != b" " + text.encode():
                ids_a[k], ids_b[k] = np.zeros(0, "<u4"), []
        return ids_a, ids_b


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker and pair of files."""
    return Aligner(path_a, path_b)


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Places in ``ends_a`` of the ends that both have, by halving all intervals at once.

    Both are rising; their last ends are equal. An interval is a run of A tokens between two
    cuts; its inner ends are looked for in ``ends_b`` from the middle outwards.
    """
    n = len(ends_a)
    if not n:
        return np.zeros(0, np.int64)
    found = [np.array([n - 1])]
    low, high = np.array([0]), np.array([n - 1])  # inner ends: low .. high - 1
    while len(low):
        middle = (low + high) >> 1
        cut = np.full(len(low), -1)
        pending = np.arange(len(low))
        step = 0
        while len(pending):
            for offset in (step, -step) if step else (0,):
                at = middle[pending] + offset
                inside = (at >= low[pending]) & (at < high[pending])
                tried = at[inside]
                place = np.searchsorted(ends_b, ends_a[tried])
                hit = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[tried]
                cut[pending[inside][hit]] = tried[hit]
                pending = pending[cut[pending] < 0]
            step += 1
            beyond = (middle[pending] + step >= high[pending]) & (middle[pending] - step < low[pending])
            pending = pending[~beyond]
        divided = cut >= 0
        found.append(cut[divided])
        low, high, cut = low[divided], high[divided], cut[divided]
        # Both halves, in the order of the text, so that the next bisections run through it.
        low, high = np.column_stack([low, cut + 1]).ravel(), np.column_stack([cut, high]).ravel()
        open_ = low < high
        low, high = low[open_], high[open_]
    return np.sort(np.concatenate(found))


def linked(group_a: np.ndarray, group_b: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, groups: int):
    """Group, code ``a << 32 | b`` and multiplicity of linked id pairs; codes may repeat."""
    size_a, size_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    first_b = np.cumsum(size_b) - size_b
    small = size_a * size_b <= SMALL_GROUP
    mine = np.flatnonzero(small[group_a])
    times = size_b[group_a[mine]]
    which = np.repeat(mine, times)
    within = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times)
    codes = [(ids_a[which] << SHIFT) | ids_b[first_b[group_a[which]] + within]]
    owner, count = [group_a[which]], [np.ones(len(which), np.int64)]
    first_a = np.cumsum(size_a) - size_a
    for g in np.flatnonzero(~small).tolist():
        a, n_a = np.unique(ids_a[first_a[g] : first_a[g] + size_a[g]], return_counts=True)
        b, n_b = np.unique(ids_b[first_b[g] : first_b[g] + size_b[g]], return_counts=True)
        codes.append(((a << SHIFT)[:, None] | b).ravel())
        count.append((n_a[:, None] * n_b).ravel())
        owner.append(np.full(len(codes[-1]), g))
    return np.concatenate(owner), np.concatenate(codes), np.concatenate(count)


def distinct(doc: np.ndarray, codes: np.ndarray, count: np.ndarray):
    """Each document's distinct codes with summed multiplicity, by document.

    Ids have at most 20 bits and a batch at most a few thousand texts, so one word holds all three.
    """
    words = (doc << 40) | ((codes >> SHIFT) << 20) | (codes & LOW)
    if len(count) and count.max() > 1:
        words, place = np.unique(words, return_inverse=True)
        count = np.bincount(place, count).astype(np.int64)
    else:
        words, count = np.unique(words, return_counts=True)
    return words >> 40, (((words >> 20) & 0xFFFFF) << SHIFT) | (words & 0xFFFFF), count


def groups_of(places: np.ndarray, size: int) -> np.ndarray:
    """The group of each token when groups end at the given places."""
    marks = np.zeros(size + 1, np.int64)
    marks[places + 1] = 1
    return np.cumsum(marks[:-1])


def align_batch(model: Aligner, texts: list[str]) -> dict[str, list]:
    """Per text the counts, the groups' text form and the linked pairs with multiplicity."""
    per_a, per_b = model.encode(texts)
    n_a, n_b = (np.array([len(i) for i in per], np.int64) for per in (per_a, per_b))
    ids_a = np.concatenate(per_a).astype(np.int64)
    ids_b = np.fromiter(chain.from_iterable(per_b), np.int64, int(n_b.sum()))
    ends_a, ends_b = np.cumsum(model.bytes_a[ids_a]), np.cumsum(model.bytes_b[ids_b])
    cuts = shared_cuts(ends_a, ends_b)
    group_a = groups_of(cuts, len(ends_a))
    group_b = groups_of(np.searchsorted(ends_b, ends_a[cuts]), len(ends_b))
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    group_doc = doc_a[cuts]
    owner, codes, count = linked(group_a, group_b, ids_a, ids_b, len(cuts))
    doc, codes, count = distinct(group_doc[owner], codes, count)
    n_groups = np.bincount(group_doc, minlength=len(texts))
    size_a, size_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, group_doc, size_a * size_b)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": n_groups,
        "n_links": n_links,
        "groups": written_groups(model, ids_a, ids_b, group_a, group_b, n_a + n_b),
        "codes": (codes, np.bincount(doc, minlength=len(texts))),
        "times": count,
    }


def written_groups(
    model: Aligner, ids_a: np.ndarray, ids_b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, sizes: np.ndarray
) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` per text: a group's A ids, then its B ids."""
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    before_b = np.concatenate([[0], np.cumsum(np.bincount(group_b, minlength=groups))])
    until_a = np.cumsum(np.bincount(group_a, minlength=groups))
    total = len(ids_a) + len(ids_b)
    ids, keys = np.empty(total, np.int64), np.empty(total, np.int64)
    for at, id_, key in (
        (np.arange(len(ids_a)) + before_b[group_a], ids_a, group_a * 2),
        (np.arange(len(ids_b)) + (until_a[group_b] if groups else 0), ids_b, group_b * 2 + 1),
    ):
        ids[at], keys[at] = id_, key
    # After a token: a comma within its side, a bar before B, a semicolon before the next group.
    sign = np.zeros(total, np.int64)
    changes = keys[1:] != keys[:-1]
    sign[:-1][changes] = 1 + (keys[:-1][changes] & 1)
    table, tokens = model.written, (ids * 3 + sign).tolist()
    ends = np.cumsum(sizes).tolist()
    return ["".join([table[t] for t in tokens[a:b]])[:-1] for a, b in zip([0, *ends], ends, strict=False)]


def aligned(docs: DataFrame, path_a: str, path_b: str, with_groups: bool = False) -> DataFrame:
    """Per document the counts and digest, and ``codes`` (A id << 32 | B id) with ``times``.

    ``with_groups`` adds the groups' text form itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(path_a, path_b)
        for batch in batches:
            for start, end in slices(batch.column("text")):
                part = batch.slice(start, end - start)
                found = align_batch(model, [t or "" for t in part.column("text").to_pylist()])
                codes, sizes = found["codes"]
                places = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in found["groups"]]
                columns = [
                    part.column("doc_id"),
                    part.column("_row"),
                    *[pa.array(found[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")],
                    pa.array(digests, pa.string()),
                    pa.ListArray.from_arrays(places, pa.array(codes, pa.int64())),
                    pa.ListArray.from_arrays(places, pa.array(found["times"], pa.int64())),
                ]
                names = ["doc_id", "_row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"]
                if with_groups:
                    columns.append(pa.array(found["groups"], pa.string()))
                    names.append("groups")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = (
        "doc_id bigint, _row bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint,"
        " groups_sha256 string, codes array<bigint>, times array<bigint>"
    )
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("_row"), "text")
    return rows.mapInArrow(run, schema + ", groups string" * with_groups)


def pair_counts(links: DataFrame) -> DataFrame:
    """``code``, the documents that hold it linked (``n``), and whether that is its A id's most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def emit(codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(codes), 100_000):
                part = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(codes[part]), pa.array(n[part])], names=["code", "n"])

        codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            found, times = np.unique(batch.column("codes").flatten().to_numpy(zero_copy_only=False), return_counts=True)
            every, place = np.unique(np.concatenate([codes, found]), return_inverse=True)
            n = np.bincount(place, np.concatenate([n, times]), len(every)).astype(np.int64)
            codes = every
            if len(codes) > HELD_PAIRS:
                yield from emit(codes, n)
                codes, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
        yield from emit(codes, n)

    each = links.select("codes").mapInArrow(run, "code bigint, n bigint")
    counts = stored(each.groupBy("code").agg(F.sum("n").alias("n")), "pair-counts")
    a = F.shiftright("code", SHIFT).alias("a")
    most = counts.groupBy(a).agg(F.max("n").alias("most"))
    marked = counts.withColumn("a", a).join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best"))
    return stored(marked, "pair-best")


def frequent_level(counts: DataFrame, bound: int) -> int:
    """The least count such that at most ``bound`` pairs have it or more.

    Pairs are counted by count up to 4,096 and by powers of two above it, a bounded table.
    """
    n = F.col("n")
    step = F.when(n < 4096, n).otherwise(F.expr("shiftleft(1L, CAST(floor(log2(n)) AS INT))")).alias("step")
    sizes = counts.groupBy(step).count().collect()
    total, level = 0, 1 << 62
    for row in sorted(sizes, key=lambda r: -r["step"]):
        total += row["count"]
        if total > bound:
            break
        level = row["step"]
    return level


def scored(links: DataFrame, counts: DataFrame, bound: int) -> DataFrame:
    """``n_best`` and ``count_sum`` per row: frequent pairs looked up, the rest joined."""
    level = frequent_level(counts, bound)
    known = counts.filter(F.col("n") >= level).toArrow().combine_chunks()
    order = np.argsort(known.column("code").to_numpy())
    table = [known.column(c).to_numpy(zero_copy_only=False)[order] for c in ("code", "n", "best")]
    held = links.sparkSession.sparkContext.broadcast(table)
    names = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, n, best = held.value
        for batch in batches:
            rows = batch.num_rows
            sizes = batch.column("codes").value_lengths().to_numpy(zero_copy_only=False)
            codes, times = (batch.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("codes", "times"))
            row = np.repeat(np.arange(rows), sizes)
            at = np.minimum(np.searchsorted(keys, codes), max(len(keys) - 1, 0))
            hit = keys[at] == codes if len(keys) else np.zeros(len(codes), bool)
            n_best, count_sum = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
            np.add.at(n_best, row[hit], times[hit] * best[at[hit]])
            np.add.at(count_sum, row[hit], times[hit] * n[at[hit]])
            left = np.bincount(row[~hit], minlength=rows)
            places = pa.array(np.concatenate([[0], np.cumsum(left)]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in (*names, "_row")],
                    pa.array(n_best),
                    pa.array(count_sum),
                    pa.ListArray.from_arrays(places, pa.array(codes[~hit])),
                    pa.ListArray.from_arrays(places, pa.array(times[~hit])),
                ],
                names=[*names, "_row", "n_best", "count_sum", "codes", "times"],
            )

    schema = (
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string,"
        " _row bigint, n_best bigint, count_sum bigint, codes array<bigint>, times array<bigint>"
    )
    found = links.select(*names, "_row", "codes", "times").mapInArrow(run, schema)
    if counts.filter(F.col("n") < level).isEmpty():
        return found.drop("_row", "codes", "times")
    found = stored(found, "pair-sums")
    rest = (
        found.select("_row", F.explode(F.arrays_zip("codes", "times")).alias("pair"))
        .select("_row", F.col("pair.codes").alias("code"), F.col("pair.times").alias("times"))
        .join(counts.filter(F.col("n") < level), "code")
        .groupBy("_row")
        .agg(
            F.sum(F.col("times") * F.col("best").cast("bigint")).alias("rare_best"),
            F.sum(F.col("times") * F.col("n")).alias("rare_sum"),
        )
    )
    total = [F.col(c) + F.coalesce(r, F.lit(0)) for c, r in (("n_best", "rare_best"), ("count_sum", "rare_sum"))]
    joined = found.drop("codes", "times").join(rest, "_row", "left")
    return joined.select(*names, total[0].alias("n_best"), total[1].alias("count_sum"))


def align_documents(docs: DataFrame, path_a: str, path_b: str, bound: int = LOOKED_UP) -> DataFrame:
    """Counts, scores and the digest of the groups, one row per document."""
    links = stored(aligned(docs, path_a, path_b), "alignment")
    counts = pair_counts(links)
    return scored(links, counts, bound)

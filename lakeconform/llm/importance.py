"""Operator 3: a quality classifier by importance resampling.

Two generative models say how likely each hashed n-gram is to occur in a document: one of the
target (documents labelled good and not toxic), one of the raw text (the whole corpus). The weight
of an n-gram is the logarithm of its rate in the target over its rate in the raw text, of either
sign, drawn towards zero by :data:`DEVIATIONS` standard errors, so that it is zero where the counts
do not tell the rates apart. A document's score is the sum over its distinct n-grams, the logarithm
of its importance; the documents with the ``k`` largest ``score / temperature + Gumbel noise`` are a
sample without replacement in proportion to the tempered importance (Gumbel top-k). ``k`` is the
number of documents whose score clears the level that separates a held-out fifth of the labels best.

The models have 2^20 cells at any size of the corpus. N-grams that share a cell add their rates, so
what rare ones add to a frequent one's rate does not grow with the corpus.

N-grams: words up to white space, words up to any sign, pairs of neighbouring words up to any
sign, runs of signs, and a word three times in a row; ASCII letters in lower case, hashed to 20 bits.

Null and empty texts have no n-grams and score 0. Noise comes from a hash of id and text, so
the result is the same on every run; repeated rows fare alike as long as they do not tie at the
last place. Without labels all scores are 0 and everything is kept. A document with several
labels counts as the worst of them. Extra columns are unused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import slices, stored
from lakeconform.llm.textarrays import ALNUM, BASE, WHITE, mixed, words_of

BITS = 20
CELLS = 1 << BITS
# Bound on the labelled rows used: a sample by hash of the id beyond it.
LABELLED_ROWS = 200_000
DEVIATIONS = 2.5
PRIOR = 2.0
TEMPERATURE = 0.25
HELD_OUT = 5
SEED = 11
# Bytes of text that a worker cuts into n-grams at once; a longer text stands alone.
AT_ONCE = 500_000
SIGNS = WHITE & ~ALNUM


def all_grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of every hashed n-gram of each text, repeated ones included, in no order."""
    found = []
    shift = np.uint64(64 - BITS)
    for salt, mask in enumerate((WHITE, ALNUM, SIGNS)):
        words = words_of(texts, mask)
        row = np.repeat(np.arange(len(texts)), words.counts)
        found.append((row, mixed(words.hashes + np.uint64(salt)) >> shift))
        if salt == 1:
            h = words.hashes
            pair = np.flatnonzero(row[1:] == row[:-1])
            found.append((row[pair], mixed(h[pair] * BASE + h[pair + 1]) >> shift))
            again = np.flatnonzero((h[2:] == h[1:-1]) & (h[1:-1] == h[:-2]))
            again = again[row[again] == row[again + 2]]
            found.append((row[again], np.full(len(again), mixed(np.array([99], np.uint64))[0] >> shift)))
    rows = np.concatenate([r for r, _ in found]).astype(np.int64)
    return rows, np.concatenate([c for _, c in found]).astype(np.int64)


def distinct(rows: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of row and cell once, sorted."""
    codes = np.sort((rows << BITS) | cells)
    codes = codes[np.concatenate([[True], codes[1:] != codes[:-1]])[: len(codes)]]
    return codes >> BITS, codes & (CELLS - 1)


def grams_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and cell of the distinct hashed n-grams of each text, sorted by row."""
    return distinct(*all_grams(texts))


def bounded_labels(labels: DataFrame, bound: int) -> DataFrame:
    """At most about ``bound`` labelled ids, one row each: ``good`` and ``held`` for testing."""
    total = labels.count()
    picked = labels.filter("doc_id IS NOT NULL")
    if total > bound:
        part = int(bound / total * (1 << 20))
        picked = picked.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < part)
    good = (F.coalesce(F.min("quality"), F.lit(0)) == 1) & (F.coalesce(F.max("toxic"), F.lit(0)) == 0)
    held = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(HELD_OUT)) == 0
    return picked.groupBy("doc_id").agg(good.alias("good")).withColumn("held", held)


def count_grams(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents with each n-gram: in the corpus (``raw``) and in the target (``target``).

    Bucket -1 counts the documents themselves. Each task sums its own rows first.
    """
    marked = docs.select("doc_id", "text").join(F.broadcast(labels), "doc_id", "left")
    marked = marked.select("text", F.expr("coalesce(good AND NOT held, false)").alias("fit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = (np.zeros(CELLS, np.int64) for _ in range(2))
        seen = fitted = 0
        for batch in batches:
            fit = batch.column("fit").to_numpy(zero_copy_only=False)
            seen, fitted = seen + len(fit), fitted + int(fit.sum())
            for a, b in slices(batch.column("text"), AT_ONCE):
                rows, cells = grams_of(batch.column("text").slice(a, b - a))
                np.add.at(raw, cells, 1)
                np.add.at(target, cells[fit[a:b][rows]], 1)
        which = np.flatnonzero(raw)
        for at in range(0, len(which), 100_000):
            w = which[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(w), pa.array(raw[w]), pa.array(target[w])], names=["bucket", "raw", "target"]
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1]), pa.array([seen]), pa.array([fitted])], names=["bucket", "raw", "target"]
        )

    each = marked.mapInArrow(run, "bucket bigint, raw bigint, target bigint")
    return each.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def weights_of(raw: np.ndarray, target: np.ndarray, share: float) -> np.ndarray:
    """Log ratio of target to raw rate, drawn towards zero; ``share`` is target of raw documents."""
    expected = raw * share + PRIOR
    ratio = np.log((target + PRIOR) / expected)
    return np.sign(ratio) * np.maximum(0.0, np.abs(ratio) - DEVIATIONS / np.sqrt(expected))


def fit_weights(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """The weight of every cell. The driver gets at most 2^20 counts, at any size of the corpus."""
    counts = stored(count_grams(docs, labels), "grams")
    sizes = counts.filter("bucket = -1").first()
    weights = np.zeros(CELLS)
    if sizes and sizes["target"]:
        # A cell that weighs nothing need not come back.
        share = sizes["target"] / sizes["raw"]
        told = f"abs(ln((target + {PRIOR}D) / (raw * {share!r}D + {PRIOR}D)))"
        found = counts.filter(f"bucket >= 0 AND {told} > 0.99D * {DEVIATIONS}D / sqrt(raw * {share!r}D + {PRIOR}D)")
        found = found.toPandas()
        cells = found["bucket"].to_numpy(np.int64)
        weights[cells] = weights_of(found["raw"].to_numpy(), found["target"].to_numpy(), share)
    return weights


def score_documents(docs: DataFrame, weights: np.ndarray, keep: list[str], text: str = "text") -> DataFrame:
    """Every document's columns ``keep`` with ``_key``, a hash of its text, and ``score``.

    The text is shipped once; it comes back only if it is among ``keep``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weighted = weights != 0
        for batch in batches:
            texts = batch.column(text)
            scores = np.zeros(batch.num_rows)
            for a, b in slices(texts, AT_ONCE):
                rows, cells = all_grams(texts.slice(a, b - a))
                hits = weighted[cells]
                rows, cells = distinct(rows[hits], cells[hits])
                scores[a:b] = np.bincount(rows, weights[cells], b - a)
            kept = batch.select([*keep, "_key"])
            yield kept.append_column("score", pa.array(np.round(scores, 4)))

    extra = [] if text in keep else [text]
    picked = docs.select(*keep, F.xxhash64(text).alias("_key"), *extra)
    schema = picked.select(*keep, "_key").schema.add("score", "double")
    return picked.mapInArrow(run, schema)


def separating_level(scores: DataFrame, labels: DataFrame) -> float:
    """The score below which a held-out document is more likely not of the target.

    A good document lost counts twice. Scores are summed in steps of a tenth; there are at most as
    many steps as held-out labels, which are bounded.
    """
    step = F.floor(F.col("score") * 10).alias("step")
    rows = (
        scores.join(F.broadcast(labels.filter("held")), "doc_id")
        .groupBy(step)
        .agg(F.sum(F.col("good").cast("int")).alias("good"), F.count("*").alias("n"))
        .collect()
    )
    good, bad = sum(r["good"] for r in rows), sum(r["n"] - r["good"] for r in rows)
    if not good or not bad:
        return float("-inf")
    best, level, lost, caught = 0.0, float("-inf"), 0, 0
    for r in sorted(rows, key=lambda r: r["step"]):
        lost, caught = lost + r["good"], caught + r["n"] - r["good"]
        gain = caught / bad - 2 * lost / good
        if gain > best:
            best, level = gain, (r["step"] + 1) / 10
    return level


def gumbel_keys(scores: DataFrame, temperature: float, seed: int) -> DataFrame:
    """``key``: tempered score plus Gumbel noise from a hash of the row."""
    uniform = F.expr(f"(shiftrightunsigned(xxhash64(doc_id, _key, {seed}), 11) + 0.5D) / {float(1 << 53)!r}D")
    return scores.withColumn("key", F.col("score") / F.lit(temperature) - F.log(-F.log(uniform)))


def top_k_level(keyed: DataFrame, k: int) -> float:
    """The ``k``-th largest key, by narrowing an interval with counts of at most 1,024 parts.

    Nothing is sorted and no rows are moved; every pass brings back one count per part.
    """
    low, high, n = keyed.agg(F.min("key"), F.max("key"), F.count("*")).first()
    if k <= 0 or not n:
        return float("inf")
    if k >= n:
        return low
    above = 0
    while True:
        width = (high - low) / 1024
        if low + width <= low or width == 0:
            return low
        part = F.least(F.floor((F.col("key") - F.lit(low)) / F.lit(width)), F.lit(1023))
        inside = keyed.filter(F.col("key").between(low, high))
        counts = dict(inside.groupBy(part.alias("part")).count().collect())
        for p in sorted(counts, reverse=True):
            if above + counts[p] >= k:
                break
            above += counts[p]
        within = inside.filter(part == p)
        low, high, left = within.agg(F.min("key"), F.max("key"), F.count("*")).first()
        if left == k - above or low == high:
            return low


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, DataFrame, float]:
    """The model, the stored scores with their keys, and the least key of the sample."""
    known = stored(bounded_labels(labels, LABELLED_ROWS), "labels")
    weights = fit_weights(docs, known)
    scores = score_documents(docs, weights, ["doc_id"])
    scores = stored(gumbel_keys(scores, TEMPERATURE, SEED), "scores")
    level = separating_level(scores, known)
    k = scores.filter(F.col("score") >= F.lit(level)).count()
    return weights, scores, top_k_level(scores, k)


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document with ``score``, ``key`` and whether it is in the sample (``kept``)."""
    _, scores, least = fit(docs, labels)
    return scores.select("doc_id", "score", "key", (F.col("key") >= F.lit(least)).alias("kept"))


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents in the sample, all columns kept. Scores are made again, not joined."""
    weights, _, least = fit(docs, labels)
    names = {c: "doc_id" if c == "doc_id" else f"_c{i}" for i, c in enumerate(docs.columns)}
    plain = docs.toDF(*names.values())
    scored = score_documents(plain, weights, plain.columns, names["text"])
    chosen = gumbel_keys(scored, TEMPERATURE, SEED).filter(F.col("key") >= F.lit(least))
    return chosen.select(*[F.col(alias).alias(c) for c, alias in names.items()])

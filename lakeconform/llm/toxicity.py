"""Operator 11: toxicity by gradient-boosted trees over dense features, calibrated.

A text becomes a few dozen numbers (:data:`FEATURES`): how many words of a lexicon it holds and
how heavy they are, plainly written or behind look-alike signs; how often it speaks to the reader
and how close that stands to a lexicon word; capitals, punctuation and signs of obfuscation.

The lexicon is learnt from the labelled rows: words that toxic documents have more often than
others, by the lower end of the log ratio's interval. For a labelled row the weights leave out
the counts of its own fold, so that the trees do not see weights made from the row itself. Trees
(Spark's GBTClassifier) are grown on four folds, an isotonic regression on the fifth turns their
output into a probability. A hundredth of the uncalibrated output stays in the score, so that
documents on one step of the isotonic curve keep their order.

Labels come only from rows whose ``crc32(doc_id as text) % 3`` is not 1, at most about
:data:`LABELLED_ROWS` of them (a sample by hash of the id beyond that); ``lang``, ``source`` and
``doc_id`` are no input. All documents are scored, whole. Equal texts have equal scores.

A document with several labels counts as the worst of them; a null label as 0. Null and empty
texts have features of zero and are scored like others. Null ids are never held out and never
learnt from. With fewer than :data:`LEAST_CLASS` labelled rows of either class every score is the
share of toxic ones (0 without labels); without both classes in the fifth fold the trees' output
stays uncalibrated. Extra columns are unused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import slices, stored
from lakeconform.llm.textarrays import ALNUM, LOWER, words_of

# Bound on the labelled rows that the model is fitted on.
LABELLED_ROWS = 200_000
# Words in the lexicon at most, the heaviest; a parameter of the model.
LEXICON = 2_000
LEAST_WEIGHT = 0.5
DEVIATIONS = 2.5
FOLDS = 5
LEAST_CLASS = 5
NEAR = 6
UNCALIBRATED = 0.01
THRESHOLD = 0.7
SEED = 29

FEATURES = (
    "lexicon_density", "lexicon_distinct", "lexicon_weight", "lexicon_top",
    "hidden_density", "hidden_weight", "reader_rate", "reader_near",
    "capital_rate", "shout_rate", "exclaim_rate", "question_rate", "sign_rate", "sign_run_rate",
    "repeat_rate", "mixed_rate", "spaced_rate", "log_words",
)

# Words that speak to the reader: English, German, French, Spanish.
READER = (
    "you your yours yourself u ur ya du dich dir dein deine deiner euch euer ihr "
    "tu te toi ton ta tes vous votre vos usted ustedes ti tus vosotros"
).split()
# Signs and digits that stand for letters inside a word.
LOOK_ALIKE = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}


def byte_set(chars: str) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(chars.encode())] = True
    return found


LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
UPPER = byte_set("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
SIGN = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
HIDES = byte_set("".join(LOOK_ALIKE))
DROPPED = byte_set("*-_.")
PLAIN = LOWER.copy()
for sign, letter in LOOK_ALIKE.items():
    PLAIN[ord(sign)] = ord(letter)


@dataclass(frozen=True)
class Lexicon:
    """Word hashes, sorted, with a weight for every fold left out and, last, for none."""

    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))
    weights: np.ndarray = field(default_factory=lambda: np.zeros((0, FOLDS + 1)))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are words of the lexicon, and their places in it."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        hits = np.flatnonzero(self.words[at] == hashes)
        return hits, at[hits]


def hashes_of(words: list[str]) -> np.ndarray:
    return np.sort(words_of(pa.array(words, pa.string()), ALNUM).hashes)


READER_HASHES = hashes_of(READER)


def raw_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a batch and where each text begins, the end last."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def counted(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[at[1:]] - total[at[:-1]]


def shifted(mask: np.ndarray, by: int) -> np.ndarray:
    """What stands ``by`` places further on; False beyond the end."""
    out = np.zeros(len(mask), bool)
    if by > 0:
        out[:-by] = mask[by:]
    else:
        out[-by:] = mask[:by]
    return out


def unmasked(raw: np.ndarray, at: np.ndarray) -> pa.Array:
    """Texts with look-alikes inside words as letters and filling signs inside words dropped."""
    letter = LETTER[raw] | HIDES[raw]
    inside = shifted(letter, -1) & shifted(letter, 1)
    keep = ~(DROPPED[raw] & inside)
    total = np.concatenate([[0], np.cumsum(keep)])
    data = np.where(LETTER[raw] | shifted(LETTER[raw], 1) | shifted(LETTER[raw], -1), PLAIN[raw], raw)[keep]
    places = pa.py_buffer(total[at].astype(np.int64).tobytes())
    return pa.Array.from_buffers(pa.large_string(), len(at) - 1, [None, places, pa.py_buffer(data.tobytes())])


def lexicon_features(lexicon: Lexicon, hashes: np.ndarray, row: np.ndarray, rows: int, column: np.ndarray):
    """Per row: hits, distinct words, their summed weight, the heaviest; and the hits' places."""
    hits, at = lexicon.find(hashes)
    weight = lexicon.weights[at, column[row[hits]]] if len(hits) else np.zeros(0)
    heavy = weight > 0
    hits, at, weight = hits[heavy], at[heavy], weight[heavy]
    _, first = np.unique(row[hits] * max(len(lexicon.words), 1) + at, return_index=True)
    owner = row[hits[first]]
    top = np.zeros(rows)
    np.maximum.at(top, owner, weight[first])
    summed = np.bincount(owner, weight[first], rows)
    return np.bincount(row[hits], minlength=rows), np.bincount(owner, minlength=rows), summed, top, hits


def features_of(texts: pa.Array, lexicon: Lexicon, column: np.ndarray) -> np.ndarray:
    """A row of :data:`FEATURES` per text; ``column`` says which of the lexicon's weights hold."""
    rows = len(texts)
    raw, at = raw_bytes(texts)
    size = np.maximum(np.diff(at), 1)
    words = words_of(texts, ALNUM)
    row = np.repeat(np.arange(rows), words.counts)
    n = np.maximum(words.counts, 1)
    hits, several, weight, top, places = lexicon_features(lexicon, words.hashes, row, rows, column)
    spot = np.minimum(np.searchsorted(READER_HASHES, words.hashes), len(READER_HASHES) - 1)
    reader = np.flatnonzero(READER_HASHES[spot] == words.hashes)
    near = np.zeros(len(places), bool)
    if len(reader):
        after = np.searchsorted(reader, places)
        for side in (np.minimum(after, len(reader) - 1), np.maximum(after - 1, 0)):
            near |= (np.abs(reader[side] - places) <= NEAR) & (row[reader[side]] == row[places])
    letter = LETTER[raw]
    upper, sign = UPPER[raw], SIGN[raw]
    same = np.zeros(len(raw), bool)
    same[1:] = raw[1:] == raw[:-1]
    inside = shifted(letter, -1) & shifted(letter, 1)
    alone = letter & ~shifted(letter, -1) & ~shifted(letter, 1)
    mixed = counted((HIDES[raw] | DROPPED[raw]) & inside, at)
    hidden, hidden_weight = np.zeros(rows), np.zeros(rows)
    suspects = np.flatnonzero(mixed)
    if len(suspects) and len(lexicon.words):
        part_raw, part_at = raw_bytes(texts.take(pa.array(suspects)))
        shown = words_of(unmasked(part_raw, part_at), ALNUM)
        owner = np.repeat(suspects, shown.counts)
        more, _, heavier, _, _ = lexicon_features(lexicon, shown.hashes, owner, rows, column)
        hidden[suspects] = np.maximum(more - hits, 0)[suspects]
        hidden_weight[suspects] = np.maximum(heavier - weight, 0)[suspects]
    found = {
        "lexicon_density": 1000 * hits / n,
        "lexicon_distinct": several,
        "lexicon_weight": weight,
        "lexicon_top": top,
        "hidden_density": 1000 * hidden / n,
        "hidden_weight": hidden_weight,
        "reader_rate": 1000 * np.bincount(row[reader], minlength=rows) / n,
        "reader_near": 1000 * np.bincount(row[places[near]], minlength=rows) / n,
        "capital_rate": counted(upper, at) / np.maximum(counted(letter, at), 1),
        "shout_rate": 1000 * counted(upper & shifted(upper, -1) & shifted(upper, 1), at) / size,
        "exclaim_rate": 1000 * counted(raw == ord("!"), at) / size,
        "question_rate": 1000 * counted(raw == ord("?"), at) / size,
        "sign_rate": 1000 * counted(sign, at) / size,
        "sign_run_rate": 1000 * counted(sign & same, at) / size,
        "repeat_rate": 1000 * counted(letter & same & shifted(same, 1), at) / size,
        "mixed_rate": 1000 * mixed / n,
        "spaced_rate": 1000 * counted(alone & shifted(alone, 2), at) / n,
        "log_words": np.log1p(words.counts),
    }
    return np.column_stack([found[name] for name in FEATURES]).astype(np.float64)


def with_features(rows: DataFrame, lexicon: Lexicon, keep: list[str], column: str | None = None) -> DataFrame:
    """Columns ``keep`` and the features of ``text``; ``column`` names a fold whose weights hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts):
                fold = np.full(b - a, FOLDS)
                if column:
                    fold = batch.column(column).slice(a, b - a).to_numpy(zero_copy_only=False)
                part = features_of(texts.slice(a, b - a), lexicon, fold)
                kept = batch.select(keep).slice(a, b - a)
                columns = [*kept.columns, *(pa.array(part[:, i]) for i in range(len(FEATURES)))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, *FEATURES])

    picked = rows.select(*keep, "text", *([column] if column and column not in keep else []))
    schema = picked.select(*keep).schema
    for name in FEATURES:
        schema = schema.add(name, "double")
    return picked.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id") -> Column:
    """Ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, bound: int) -> DataFrame:
    """``text``, ``toxic`` (0 or 1) and ``fold`` of the documents that may be learnt from."""
    usable = labels.filter("doc_id IS NOT NULL").filter(~held_out())
    total = usable.count()
    if total > bound:
        part = int(bound / total * (1 << 20))
        usable = usable.filter(F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20)) < part)
    toxic = (F.coalesce(F.max("toxic"), F.lit(0)) == 1).cast("int").alias("toxic")
    known = usable.groupBy("doc_id").agg(toxic)
    fold = F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(FOLDS)).cast("int").alias("fold")
    picked = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    return picked.select(F.coalesce("text", F.lit("")).alias("text"), "toxic", fold)


def word_counts(texts: DataFrame) -> DataFrame:
    """Labelled documents with each word, by fold: ``clean_k`` and ``toxic_k``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = batch.column("fold").to_numpy() * 2 + batch.column("toxic").to_numpy()
            for a, b in slices(batch.column("text")):
                words = words_of(batch.column("text").slice(a, b - a), ALNUM)
                row = np.repeat(np.arange(a, b), words.counts)
                pairs = np.unique(np.rec.fromarrays([words.hashes, row]))
                found = np.rec.fromarrays([pairs.f0, slot[pairs.f1]])
                found, n = np.unique(found, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.f0.view(np.int64)), pa.array(found.f1.astype(np.int32)), pa.array(n)],
                    names=["word", "slot", "n"],
                )

    each = texts.mapInArrow(run, "word bigint, slot int, n bigint")
    sums = [
        F.sum(F.when(F.col("slot") == 2 * k + t, F.col("n")).otherwise(0)).alias(f"{name}_{k}")
        for k in range(FOLDS)
        for t, name in enumerate(("clean", "toxic"))
    ]
    return each.groupBy("word").agg(*sums)


def learn_lexicon(texts: DataFrame, sizes: np.ndarray) -> Lexicon:
    """The words with the heaviest weights; ``sizes[k, t]`` are the documents of fold and label."""

    def weight(left_out: int | None) -> Column:
        kept = [k for k in range(FOLDS) if k != left_out]
        toxic, clean = (sum((F.col(f"{name}_{k}") for k in kept[1:]), F.col(f"{name}_{kept[0]}")) for name in ("toxic", "clean"))
        n_clean, n_toxic = (float(v) for v in sizes[kept].sum(axis=0) + 1)
        ratio = F.log((toxic + 0.5) / F.lit(n_toxic)) - F.log((clean + 0.5) / F.lit(n_clean))
        low = ratio - DEVIATIONS * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
        return F.when((toxic >= 2) & (low > LEAST_WEIGHT), low).otherwise(0.0)

    weights = [weight(k).alias(f"w{k}") for k in range(FOLDS)] + [weight(None).alias("w")]
    heavy = word_counts(texts).select("word", *weights).filter("w > 0").orderBy(F.desc("w"), "word").limit(LEXICON)
    rows = heavy.collect()
    words = np.array([r["word"] for r in rows], np.int64).view(np.uint64)
    order = np.argsort(words)
    table = np.array([tuple(r)[1:] for r in rows], np.float64).reshape(-1, FOLDS + 1)
    return Lexicon(words[order], table[order])


class Model:
    """Lexicon, trees and calibration; without trees a constant score."""

    def __init__(self, docs: DataFrame, labels: DataFrame, bound: int = LABELLED_ROWS) -> None:
        self.lexicon, self.trees, self.curve = Lexicon(), None, None
        texts = stored(labelled_texts(docs, labels, bound), "toxic-texts")
        sizes = np.zeros((FOLDS, 2), np.int64)
        for r in texts.groupBy("fold", "toxic").count().collect():
            sizes[r["fold"], r["toxic"]] = r["count"]
        clean, toxic = (int(v) for v in sizes.sum(axis=0))
        self.share = toxic / (clean + toxic) if clean + toxic else 0.0
        growing = sizes[1:].sum(axis=0)
        if min(clean, toxic) < LEAST_CLASS or not growing.all():
            return
        self.lexicon = learn_lexicon(texts, sizes)
        rows = with_features(texts, self.lexicon, ["toxic", "fold"], "fold")
        # A fixed order in fixed parts, so that the trees are the same on any cluster.
        parts = 1 + int(sizes.sum()) // 20_000
        spread = rows.withColumn("place", F.xxhash64(*rows.columns)).repartition(parts, "place")
        rows = stored(spread.sortWithinPartitions("place", *FEATURES, "toxic"), "toxic-features")
        rows = self.assembled(rows).select("vector", "toxic", "fold").coalesce(parts)
        boosted = GBTClassifier(
            featuresCol="vector", labelCol="toxic", maxIter=20, maxDepth=4, stepSize=0.3, minInstancesPerNode=3, seed=SEED
        )
        self.trees = boosted.fit(rows.filter("fold > 0"))
        if sizes[0].all():
            curve = IsotonicRegression(featuresCol="raw", labelCol="toxic", predictionCol="calibrated")
            self.curve = curve.fit(self.grown(rows.filter("fold = 0")))

    def assembled(self, rows: DataFrame) -> DataFrame:
        return VectorAssembler(inputCols=list(FEATURES), outputCol="vector").transform(rows)

    def grown(self, rows: DataFrame) -> DataFrame:
        chance = vector_to_array("probability")[1].alias("raw")
        found = self.trees.transform(rows)
        return found.select(*rows.columns, chance)

    def scores(self, docs: DataFrame) -> DataFrame:
        """``doc_id`` and ``score`` of every document."""
        rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
        if self.trees is None:
            return rows.select("doc_id", F.lit(float(self.share)).alias("score"))
        found = self.grown(self.assembled(with_features(rows, self.lexicon, ["doc_id"])))
        score = F.col("raw")
        if self.curve is not None:
            found = self.curve.transform(found)
            score = F.lit(1 - UNCALIBRATED) * F.col("calibrated") + F.lit(UNCALIBRATED) * F.col("raw")
        return found.select("doc_id", F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("score"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``held_out``, ``score`` and ``predicted`` of every document."""
    scores = Model(docs, labels).scores(docs)
    return scores.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )

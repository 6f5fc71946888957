"""Operator 2: secrets in texts, told apart by who owns them across the corpus.

Patterns find candidates in each text. The hash of each candidate's value is then counted over
the corpus: how many repositories and how many owners hold it. A value that many owners hold is
a copied example; one that a single owner holds and that looks random is taken as live. Random
means: as even as drawn from the smallest alphabet that has all its characters, and not made of
the letters of words. Random looking tokens without a telling name around them become spans only
by that verdict.

Null texts are empty. Spans count code points, end exclusive, and may overlap between kinds.
Rows with the same id are separate documents. Only hashes and positions are moved, never texts.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import slices, stored
from lakeconform.operators.joins import enrich

# The kinds in their order, their patterns and least lengths.
KINDS = ("assign", "access", "hex", "live")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST = {"assign": 12, "access": 18, "hex": 16}
# A bare token: 24 letters, digits and signs of base64 or more.
BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{24,}(?![A-Za-z0-9+/_=-])")
# Alphabets from the smallest; a value is judged by the first that has all its characters.
DIGITS, LOWER, UPPER = string.digits, string.ascii_lowercase, string.ascii_uppercase
ALPHABETS = tuple(
    map(
        frozenset,
        (DIGITS, DIGITS + "abcdef", DIGITS + "ABCDEF", LOWER, UPPER, UPPER + "234567", LOWER + DIGITS,
         UPPER + DIGITS, LOWER + UPPER, LOWER + UPPER + DIGITS, LOWER + UPPER + DIGITS + "+/=_-."),
    )
)
# Part of the entropy expected of random characters that a value must have.
EVENNESS = 0.85
# Letters in words, per mille, and the bits a letter that tell words from random letters.
LETTERS = dict(
    zip("etaoinshrdlcumwfgypbvkjxqz",
        (127, 91, 82, 75, 70, 67, 63, 61, 60, 43, 40, 28, 28, 24, 24, 22, 20, 20, 19, 15, 10, 8, 1.5, 1.5, 1, 0.7),
        strict=True)
)
WORDLIKE = 0.25
WIDELY = 3


def entropy(value: str) -> float:
    """Bits per character of a text."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


@lru_cache(4096)
def expected_entropy(n: int, size: int) -> float:
    """Mean entropy of ``n`` characters drawn evenly from ``size``."""
    if n > 8 * size:
        return math.log2(size) - (size - 1) / (2 * n * math.log(2))
    chance = 1 / size
    lost = sum(
        math.comb(n, c) * chance**c * (1 - chance) ** (n - c) * c * math.log2(c) for c in range(2, n + 1)
    )
    return math.log2(n) - size * lost / n


def wordlike(value: str) -> bool:
    """Whether hardly any digit is among the letters and these are common as in words."""
    letters = [c for c in value.lower() if c in LETTERS]
    if 8 * sum(map(str.isdigit, value)) >= len(value) or not letters:
        return False
    return sum(math.log2(26 * LETTERS[c] / 1000) for c in letters) > WORDLIKE * len(letters)


def looks_random(value: str) -> bool:
    used = set(value)
    alphabet = next((a for a in ALPHABETS if used <= a), used)
    if len(used) < 2 or entropy(value) < EVENNESS * expected_entropy(len(value), len(alphabet)):
        return False
    return used <= ALPHABETS[1] or used <= ALPHABETS[2] or not wordlike(value)


def candidates(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, value) of what the patterns find; bare tokens have kind ``live``."""
    found = []
    for m in ASSIGN.finditer(text):
        if len(m[2]) >= LEAST["assign"]:
            found.append(("assign", m.start(), m.end(), m[2]))
    for m in ACCESS.finditer(text):
        if len(m[0]) >= LEAST["access"]:
            found.append(("access", m.start(), m.end(), m[0]))
    for m in HEX.finditer(text):
        found.append(("hex", m.start(), m.end(), m[0]))
    taken = sorted((s, e) for _, s, e, _ in found)
    next_one, reach = 0, 0
    for m in BARE.finditer(text):
        # Spans that begin before this token ends; the furthest end says if one reaches it.
        while next_one < len(taken) and taken[next_one][0] < m.end():
            reach = max(reach, taken[next_one][1])
            next_one += 1
        if reach <= m.start() and looks_random(m[0]):
            found.append(("live", m.start(), m.end(), m[0]))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(found, key=lambda f: (f[1], order[f[0]]))


SPANS = pa.list_(
    pa.struct(
        [("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value_hash", pa.string()), ("random", pa.bool_())]
    )
)


def scan(docs: DataFrame, id_column: str, text: str, repository: str, owner: str) -> DataFrame:
    """One row per document with its candidates; values are kept as hashes only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(1)):
                rows = []
                for t in batch.column(1).slice(a, b - a).to_pylist():
                    rows.append(
                        [
                            (k, s, e, hashlib.sha256(v.encode()).hexdigest(), looks_random(v))
                            for k, s, e, v in candidates(t or "")
                        ]
                    )
                kept = [batch.column(i).slice(a, b - a) for i in (0, 2, 3)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array([[dict(zip(("kind", "start", "end", "value_hash", "random"), f, strict=True)) for f in r] for r in rows], SPANS)],
                    names=["doc_id", "repository", "owner", "found"],
                )

    picked = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(text).alias("text"),
        F.col(repository).cast("string").alias("repository"),
        F.col(owner).cast("string").alias("owner"),
    )
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(
        run,
        f"doc_id {kind}, repository string, owner string, found "
        "array<struct<kind:string,start:int,end:int,value_hash:string,random:boolean>>",
    )


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners, and occurrences, of each value's hash.

    Counted in two steps, so that a value held by a third of the rows is first summed where it
    is read.
    """
    spans = found.select("repository", "owner", F.explode("found").alias("f"))
    each = spans.groupBy(F.col("f.value_hash").alias("value_hash"), "repository", "owner").agg(
        F.count("*").alias("n")
    )
    owners = each.groupBy("value_hash", "owner").agg(
        F.sum("n").alias("n"), F.count("*").alias("repositories")
    )
    return owners.groupBy("value_hash").agg(
        F.sum("n").alias("occurrences"),
        F.sum("repositories").alias("repositories"),
        F.count("*").alias("owners"),
    )


def find_secrets(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    repository: str = "source",
    owner: str = "source",
    widely: int = WIDELY,
) -> DataFrame:
    """Every document with its spans and their verdicts.

    ``spans`` is an array of kind, start, end, verdict; the verdict is ``copied`` for a value
    held by at least ``widely`` owners, ``live`` for a random-looking one of a single owner,
    else ``unclear``. Bare tokens stay only if live.
    """
    rows = stored(
        scan(docs, id_column, text, repository, owner).withColumn(
            "_row", F.monotonically_increasing_id()
        ),
        "secrets",
    )
    spans = rows.filter(F.size("found") > 0).select("_row", F.explode("found").alias("f"))
    spans = spans.select("_row", "f.*")
    judged = enrich(spans, ownership(rows), ["value_hash"])
    judged = judged.withColumn(
        "verdict",
        F.when(F.col("owners") >= widely, "copied")
        .when((F.col("owners") <= 1) & F.col("random"), "live")
        .otherwise("unclear"),
    ).filter("kind <> 'live' OR verdict = 'live'")
    order = F.expr(
        "CASE kind " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(KINDS)) + " END"
    )
    # A document's own spans meet again: as many as its text holds.
    per_row = judged.groupBy("_row").agg(
        F.sort_array(
            F.collect_list(F.struct("start", order.alias("place"), "end", "kind", "verdict"))
        ).alias("spans")
    )
    joined = rows.select("_row", "doc_id").join(per_row, "_row", "left")
    empty = F.array().cast(per_row.schema["spans"].dataType)
    return joined.select("doc_id", F.coalesce("spans", empty).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of :func:`find_secrets`."""

    def count(condition: str) -> Column:
        return F.expr(f"CAST(size(filter(spans, s -> {condition})) AS BIGINT)")

    def joined(spans: str) -> str:
        return (
            f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"
        )

    base = "filter(spans, s -> s.kind <> 'live')"
    return found.select(
        "doc_id",
        *[count(f"s.kind = '{k}'").alias(f"n_{k}") for k in KINDS[:3]],
        F.expr(f"sha2({joined(base)}, 256)").alias(
            "base_sha256"
        ),
        F.expr(joined("spans")).alias("spans"),
        *[count(f"s.verdict = '{v}'").alias(f"n_{v}") for v in ("live", "copied")],
    )

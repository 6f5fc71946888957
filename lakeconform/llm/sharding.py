"""Operator 9: shards and slots from a keyed permutation of the global row numbers.

A Feistel network permutes ``0 .. 4**h - 1`` for the smallest power that covers the rows;
numbers that land outside the table are sent through again (cycle walking) until they are
inside, which keeps the map a permutation of the row numbers. Row ``r`` goes to place
``p = permute(r)``: shard ``p % shards``, slot ``p // shards``. Counts differ by one at most,
slots have no gaps, and :meth:`Feistel.invert` says which row stands at a shard and slot.

Null texts count as empty. Null ids sort first. Rows equal in id, size and checksum may take
each other's place; no rows in, no rows out. Extra columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import numbered

SHARDS = 24
SEED = 20_240_201


@dataclass(frozen=True)
class Feistel:
    """A permutation of ``range(size)``, the same for the same size, seed and rounds."""

    size: int
    seed: int = SEED
    rounds: int = 8

    @property
    def half(self) -> int:
        bits = max(2, (max(1, self.size) - 1).bit_length())
        return (bits + 1) // 2

    def _mix(self, value: np.ndarray, round_no: int) -> np.ndarray:
        salt = (self.seed * 0x9E3779B97F4A7C15 + round_no * 0xD1B54A32D192ED03) & (2**64 - 1)
        x = value ^ np.uint64(salt)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (x ^ (x >> np.uint64(31))) & np.uint64((1 << self.half) - 1)

    def _once(self, value: np.ndarray, backwards: bool) -> np.ndarray:
        half = np.uint64(self.half)
        left, right = value >> half, value & np.uint64((1 << self.half) - 1)
        if backwards:
            for i in reversed(range(self.rounds)):
                left, right = right ^ self._mix(left, i), left
        else:
            for i in range(self.rounds):
                left, right = right, left ^ self._mix(right, i)
        return (left << half) | right

    def _walk(self, rows: np.ndarray, backwards: bool) -> np.ndarray:
        out = self._once(np.asarray(rows, np.uint64), backwards)
        outside = np.flatnonzero(out >= np.uint64(self.size))
        while len(outside):
            out[outside] = self._once(out[outside], backwards)
            outside = outside[out[outside] >= np.uint64(self.size)]
        return out.astype(np.int64)

    def permute(self, rows: np.ndarray) -> np.ndarray:
        return self._walk(rows, backwards=False)

    def invert(self, places: np.ndarray) -> np.ndarray:
        return self._walk(places, backwards=True)


def row_at(size: int, shard: int, slot: int, shards: int = SHARDS, seed: int = SEED) -> int:
    """The global row number that stands at a shard and slot."""
    return int(Feistel(size, seed).invert(np.array([slot * shards + shard]))[0])


def assign_shards(
    df: DataFrame, keys: list[str], columns: list[str], shards: int = SHARDS, seed: int = SEED
) -> DataFrame:
    """``columns`` of every row with ``row_number``, ``shard`` and ``slot``.

    Rows are numbered in the order of ``keys``. Only ``columns`` are moved; ``keys`` must be
    among them.
    """
    rows, numbers = numbered(df, keys, columns, "sharding")
    offsets, total = numbers["offsets"], numbers["total"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permutation = Feistel(total, seed)
        for batch in batches:
            part = batch.column("_part").to_numpy(zero_copy_only=False)
            at = np.zeros(len(part), np.int64)
            for p in np.unique(part):
                at[part == p] = offsets[int(p)]
            number = at + batch.column("_local").to_numpy(zero_copy_only=False)
            to = permutation.permute(number)
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(c) for c in columns],
                    pa.array(number),
                    pa.array((to % shards).astype(np.int32)),
                    pa.array(to // shards),
                ],
                names=[*columns, "row_number", "shard", "slot"],
            )

    schema = rows.select(*columns).schema
    for name, kind in (("row_number", "long"), ("shard", "integer"), ("slot", "long")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(place, schema)


def shard_documents(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Every document's size, checksum, shard and slot under the law ``rows``."""
    text = F.coalesce("text", F.lit(""))
    sized = docs.select(
        F.col("doc_id"),
        (F.octet_length(text) + F.lit(8)).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = assign_shards(
        sized, ["doc_id", "size", "text_crc32"], ["doc_id", "size", "text_crc32"], shards, seed
    )
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )

"""Operator 13: the trie of conversation prefixes, by truncation peeling.

Every conversation becomes the chain of hashes of its prefixes (128 bits each), and the chains
are sorted over the cluster, so that conversations with a common prefix stand next to each other.
A task peels its stretch in blocks: it begins at the greatest depth, merges the conversations
that end there with the nodes that survived from the depth below, emits the nodes, strips the
last turn and regroups, until the root. Nodes are found and aggregated in that one pass.

A prefix of a block's first or last chain may go on in the neighbouring block. Such nodes stay
open: the block hands on at most two chains, which carry the open nodes' sums so far. The chains
are sorted and peeled again, thousands for one, until few enough are left for a last block. So a
node that a third of all conversations pass through costs every block two rows, however many
members it has. Lists of the conversations that end at an open node travel as pieces, one row a
block, and are digested in order as a stream.

Texts are not moved: a turn is the MD5 of role and text (16 bytes) with its number of code
points. One conversation's digests must fit into a task (about 30 bytes a turn).

Rows: turns count in the order of ``turn`` (null first); ties go by that MD5, that is, by nothing
else in the row, so repeated rows are repeated turns. Null role or text is empty. Rows without
``conv_id`` belong to no conversation and are left out. An empty table has no nodes, not even a
root. Extra columns are unused. ``conv_id - conv_id % 100`` is taken as SQL takes it, so that
negative ids round towards zero.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeconform.llm.common import stored

# A block holds so many chains, fewer if they have so many turns together, but eight at least.
BLOCK_ROWS = 10_000
BLOCK_TURNS = 2_000_000
LEAST_ROWS = 8
# Chains that one last block may take.
LAST_ROWS = 50_000
NODE, CHAIN, ENDS = 0, 1, 2
NOBODY = np.iinfo(np.int64).max
NO_ENDS = hashlib.sha256(b"").hexdigest()

SUMS = ("n", "first", "children", "leaves", "saved")
SCHEMA = pa.schema(
    [("kind", pa.int8())]
    + [(c, pa.int64()) for c in ("depth", "h1", "h2", "conv_id", "p1", "p2", "parent_conv_id")]
    + [("pending", pa.bool_())]
    + [(c, pa.int64()) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string()), ("path", pa.list_(pa.int64())), ("chars", pa.list_(pa.int64()))]
    + [(f"at_{c}", pa.list_(pa.int64())) for c in SUMS]
)
SQL_TYPES = {pa.int8(): "tinyint", pa.int64(): "bigint", pa.bool_(): "boolean", pa.string(): "string"}
OUTPUT = ", ".join(f"{f.name} {SQL_TYPES.get(f.type, 'array<bigint>')}" for f in SCHEMA)


def rebuilt_conversations(conversations: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Per ``conv_id`` the rebuilt turns: the head of its group's first conversation, then its own.

    ``turns`` is an array of (turn, digest, chars). A group's conversations meet in one shuffle
    of digests.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    conv = F.col("conv_id").cast("bigint")
    own = (
        conversations.filter("conv_id IS NOT NULL")
        .select(
            (conv - conv % group).alias("base"),
            conv.alias("conv_id"),
            F.struct("turn", digest.alias("digest"), F.length(text).cast("bigint").alias("chars")).alias("turn"),
        )
        .repartition("base")
        .groupBy("base", "conv_id")
        .agg(F.sort_array(F.collect_list("turn")).alias("own"))
    )
    head = F.when(F.col("conv_id") == F.col("base"), F.slice("own", 1, most))
    given = F.max(head).over(Window.partitionBy("base"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    shared = F.coalesce(F.slice(F.col("head"), 1, F.col("h")), F.slice("own", 1, 0))
    rest = F.slice(F.col("own"), F.col("h") + 1, F.lit(2**31 - 1))
    return (
        own.withColumns({"head": given, "h": h})
        .select("conv_id", F.concat(shared, rest).alias("turns"))
    )


def prefix_chains(rebuilt: DataFrame) -> DataFrame:
    """``path``: two 64-bit words per turn, the hash of the prefix that ends with it; ``chars``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests = batch.column("digests")
            sizes = digests.value_lengths().to_numpy(zero_copy_only=False)
            flat, at, hashes = digests.flatten().to_pylist(), 0, []
            for size in sizes.tolist():
                prefix = b""
                for digest in flat[at : at + size]:
                    prefix = hashlib.md5(prefix + digest).digest()
                    hashes.append(prefix)
                at += size
            words = pa.array(np.frombuffer(b"".join(hashes), "<i8"))
            places = pa.array(np.concatenate([[0], np.cumsum(sizes * 2)]), pa.int32())
            paths = pa.ListArray.from_arrays(places, words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), paths, batch.column("chars")], names=["conv_id", "path", "chars"]
            )

    parts = rebuilt.select(
        "conv_id",
        F.transform("turns", lambda t: t["digest"]).alias("digests"),
        F.transform("turns", lambda t: t["chars"]).alias("chars"),
    )
    return parts.mapInArrow(run, "conv_id bigint, path array<bigint>, chars array<bigint>")


def blocks(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.Table]:
    """Consecutive rows in tables of bounded size, or all as one."""
    held: list[pa.RecordBatch] = []
    rows = turns = 0
    for batch in batches:
        at = 0
        sizes = np.cumsum(batch.column("chars").value_lengths().to_numpy(zero_copy_only=False))
        while at < batch.num_rows:
            end = batch.num_rows
            if not whole:
                before = sizes[at - 1] if at else 0
                fitting = int(np.searchsorted(sizes, before + BLOCK_TURNS - turns, "right")) - at
                end = min(end, at + min(BLOCK_ROWS - rows, max(fitting, LEAST_ROWS - rows, 1)))
            held.append(batch.slice(at, end - at))
            rows += end - at
            turns += int(sizes[end - 1] - (sizes[at - 1] if at else 0))
            at = end
            if not whole and (rows >= BLOCK_ROWS or (turns >= BLOCK_TURNS and rows >= LEAST_ROWS)):
                yield pa.Table.from_batches(held)
                held, rows, turns = [], 0, 0
    if held:
        yield pa.Table.from_batches(held)


def flat(column: pa.ChunkedArray) -> np.ndarray:
    """The values of a list column, one after the other."""
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False)


def lists(values: np.ndarray, places: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(values, pa.int64()))


def batch_of(kind: int, rows: int, columns: dict) -> pa.RecordBatch:
    arrays = []
    for field in SCHEMA:
        value = columns.get(field.name)
        if field.name == "kind":
            value = np.full(rows, kind, np.int8)
        arrays.append(pa.nulls(rows, field.type) if value is None else pa.array(value, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=SCHEMA)


class Block:
    """One stretch of sorted chains, peeled from its greatest depth to the root."""

    def __init__(self, table: pa.Table, last: bool) -> None:
        self.last, self.m = last, table.num_rows
        self.sizes = table.column("chars").combine_chunks().value_lengths().to_numpy(zero_copy_only=False)
        # Turn d of row r stands at turns[r] + d - 1, level d (the root is 0) at levels[r] + d.
        self.turns = np.concatenate([[0], np.cumsum(self.sizes)])
        self.levels = np.concatenate([[0], np.cumsum(self.sizes + 1)])
        self.path = flat(table.column("path")).reshape(-1, 2)
        self.chars = flat(table.column("chars"))
        self.ids = None
        if "at_n" in table.column_names:
            self.own = {c: flat(table.column(f"at_{c}")) for c in SUMS}
        else:
            self.ids = table.column("conv_id").to_numpy()
            self.own = {c: np.zeros(self.levels[-1], np.int64) for c in SUMS}
            self.own["first"][:] = NOBODY
            ends = self.levels[:-1] + self.sizes
            self.own["n"][ends] = 1
            self.own["first"][ends] = self.ids
        self.open = {row: {c: np.zeros(self.sizes[row] + 1, np.int64) for c in SUMS} for row in (0, self.m - 1)}
        for sums in self.open.values():
            sums["first"][:] = NOBODY

    def hashes(self, rows: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        if depth == 0:
            return np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        found = self.path[self.turns[rows] + depth - 1]
        return found[:, 0], found[:, 1]

    def regroup(self, depth: int, below: dict | None) -> tuple[dict, np.ndarray]:
        """Nodes of a depth: rows that reach it, with the closed nodes below stripped and merged."""
        rows = np.flatnonzero(self.sizes >= depth)
        h1, h2 = self.hashes(rows, depth)
        new = np.ones(len(rows), bool)
        new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
        starts = np.flatnonzero(new)
        at = self.levels[rows] + depth
        node = {c: np.add.reduceat(self.own[c][at], starts) for c in SUMS if c != "first"}
        node["first"] = np.minimum.reduceat(self.own["first"][at], starts)
        node |= {"row": rows[starts], "h1": h1[starts], "h2": h2[starts]}
        # Ended conversations come first in their node's rows.
        ended = self.sizes[rows] == depth
        node["ended"] = np.add.reduceat(ended.astype(np.int64), starts)
        group = np.searchsorted(node["row"], below["row"], "right") - 1 if below else np.zeros(0, np.int64)
        if below:
            for mine, theirs in (("n", "n"), ("leaves", "leaves"), ("saved", "saved")):
                np.add.at(node[mine], group, below[theirs])
            np.add.at(node["children"], group, 1)
            np.minimum.at(node["first"], group, below["first"])
        open_ = np.zeros(len(starts), bool)
        if not self.last:
            open_[0] |= rows[0] == 0
            open_[-1] |= rows[-1] == self.m - 1
        node["open"] = open_
        return node, group

    def close(self, node: dict, depth: int) -> dict:
        """The closed nodes: leaves and savings complete; ended ones digested."""
        which = np.flatnonzero(~node["open"])
        closed = {c: v[which] for c, v in node.items()}
        closed["leaves"] = np.where(closed["children"] == 0, 1, closed["leaves"])
        if depth:
            chars = self.chars[self.turns[closed["row"]] + depth - 1]
            closed["saved"] = closed["saved"] + (closed["n"] - 1) * chars
        closed["ends"] = [self.digest(r, k) for r, k in zip(closed["row"], closed["ended"], strict=True)]
        return closed

    def digest(self, row: int, ended: int) -> str | None:
        """SHA-256 of the ids that end at a node; unknown if pieces of other blocks may join."""
        if self.ids is None:
            return None
        return hashlib.sha256(self.listed(row, ended).encode()).hexdigest() if ended else NO_ENDS

    def listed(self, row: int, ended: int) -> str:
        return ",".join(map(str, self.ids[row : row + ended].tolist()))

    def hand_on(self, node: dict, depth: int) -> Iterator[tuple]:
        """Keep the sums of open nodes for the chains; give their ended conversations as pieces."""
        for k in np.flatnonzero(node["open"]).tolist():
            mine = 0 if k == 0 and self.sizes[0] >= depth and node["row"][0] == 0 else self.m - 1
            for c in SUMS:
                self.open[mine][c][depth] = node[c][k]
            row, ended = int(node["row"][k]), int(node["ended"][k])
            if self.ids is not None and ended:
                yield depth, node["h1"][k], node["h2"][k], self.ids[row], self.listed(row, ended)

    def peel(self) -> Iterator[pa.RecordBatch]:
        below, pieces = None, []
        for depth in range(int(self.sizes.max()), -1, -1):
            node, group = self.regroup(depth, below)
            if below and len(group):
                yield self.nodes(below, depth + 1, node, group)
            pieces.extend(self.hand_on(node, depth))
            below = self.close(node, depth)
        if len(below["row"]):
            yield self.nodes(below, 0, None, None)
        if pieces:
            names = ("depth", "h1", "h2", "conv_id", "ends")
            yield batch_of(ENDS, len(pieces), dict(zip(names, zip(*pieces, strict=True), strict=True)))
        if not self.last:
            yield self.chains()

    def nodes(self, closed: dict, depth: int, parents: dict | None, group: np.ndarray | None) -> pa.RecordBatch:
        columns = {
            "depth": np.full(len(closed["row"]), depth),
            "conv_id": closed["first"],
            "n_convs": closed["n"],
            "n_children": closed["children"],
            "n_leaves": closed["leaves"],
            "saved_tokens": closed["saved"],
            "ends": closed["ends"],
            "h1": closed["h1"],
            "h2": closed["h2"],
            "pending": np.zeros(len(closed["row"]), bool),
        }
        if parents is not None:
            pending = parents["open"][group]
            known = pa.array(parents["first"][group], mask=pending)
            columns |= {"parent_conv_id": known, "pending": pending, "p1": parents["h1"][group], "p2": parents["h2"][group]}
        return batch_of(NODE, len(closed["row"]), columns)

    def chains(self) -> pa.RecordBatch:
        """The first chain and, unless it is the same, the last one."""
        first, last = 0, self.m - 1
        same = self.sizes[first] == self.sizes[last] and np.array_equal(
            self.path[self.turns[first] : self.turns[first + 1]], self.path[self.turns[last] : self.turns[last + 1]]
        )
        rows = [first] if same else [first, last]
        turns = np.concatenate([np.arange(self.turns[r], self.turns[r + 1]) for r in rows])
        sizes = self.sizes[rows].astype(np.int64)
        columns = {
            "path": lists(self.path[turns].ravel(), np.concatenate([[0], np.cumsum(sizes * 2)])),
            "chars": lists(self.chars[turns], np.concatenate([[0], np.cumsum(sizes)])),
        }
        places = np.concatenate([[0], np.cumsum(sizes + 1)])
        for c in SUMS:
            columns[f"at_{c}"] = lists(np.concatenate([self.open[r][c] for r in rows]), places)
        return batch_of(CHAIN, len(rows), columns)


def peeled(chains: DataFrame, last: bool) -> DataFrame:
    """Peel sorted chains block by block; the last time all rows are one block and nothing stays open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in blocks(batches, last):
            yield from Block(table, last).peel()

    return chains.mapInArrow(run, OUTPUT)


def digested(pieces: DataFrame) -> DataFrame:
    """SHA-256 of each open node's ended conversations: its pieces, in order, as one stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("depth", "h1", "h2")), strict=True)
            for key, ends in zip(keys, batch.column("ends").to_pylist(), strict=True):
                if key != node:
                    if node is not None:
                        done.append((*node, state.hexdigest()))
                    node, state = key, hashlib.sha256(ends.encode())
                else:
                    state.update(b"," + ends.encode())
            yield of(done)
        if node is not None:
            yield of([(*node, state.hexdigest())])

    def of(rows: list[tuple]) -> pa.RecordBatch:
        names = ("depth", "h1", "h2", "ends")
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    ordered = (
        pieces.select("depth", "h1", "h2", "conv_id", "ends")
        .repartition("depth", "h1", "h2")
        .sortWithinPartitions("depth", "h1", "h2", "conv_id")
    )
    return ordered.mapInArrow(run, "depth bigint, h1 bigint, h2 bigint, ends string")


def by_path(chains: DataFrame, parts: int | None, *columns: str | Column) -> DataFrame:
    spread = chains.repartitionByRange(parts, *columns) if parts else chains.repartitionByRange(*columns)
    return spread.sortWithinPartitions(*columns)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """Every node with its smallest member, its parent's, and the sums over members and subtree."""
    chains = stored(prefix_chains(rebuilt_conversations(conversations)), "trie-paths")
    rounds = [stored(peeled(by_path(chains, None, "path", "conv_id"), False), "trie-round")]
    while True:
        open_ = rounds[-1].filter(F.col("kind") == CHAIN).select("path", "chars", *[f"at_{c}" for c in SUMS])
        rows, turns = open_.agg(F.count("*"), F.coalesce(F.sum(F.size("chars")), F.lit(0))).first()
        last = rows <= LAST_ROWS and turns <= BLOCK_TURNS or rows <= LEAST_ROWS
        if last:
            ordered = open_.coalesce(1).sortWithinPartitions("path")
        else:
            ordered = by_path(open_, 1 + rows // LAST_ROWS, "path")
        rounds.append(stored(peeled(ordered, last), "trie-round"))
        if last:
            break
    return assembled(rounds)


def assembled(rounds: list[DataFrame]) -> DataFrame:
    """Nodes of all rounds; parents and ends that were open are looked up among the late nodes."""
    key = ["depth", "h1", "h2"]
    pieces = rounds[0].filter(F.col("kind") == ENDS)
    sums = ("conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    early = rounds[0].filter(F.col("kind") == NODE).select(*key, "p1", "p2", "pending", *sums, "ends")
    late = reduce(DataFrame.unionByName, [r.filter(F.col("kind") == NODE) for r in rounds[1:]])
    late = late.drop("ends").join(digested(pieces), key, "left").withColumn("ends", F.coalesce("ends", F.lit(NO_ENDS)))
    late = stored(late.select(*early.columns), "trie-late")
    nodes = early.unionByName(late)
    above = late.select(
        (F.col("depth") + 1).alias("depth"), F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("conv_id").alias("above")
    )
    waiting = nodes.filter("pending").join(above, ["depth", "p1", "p2"], "left")
    waiting = waiting.withColumn("parent_conv_id", F.col("above")).select(*nodes.columns)
    return (
        nodes.filter("NOT pending")
        .unionByName(waiting)
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.col("ends").alias("ends_sha256"),
        )
    )

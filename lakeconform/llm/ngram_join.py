"""Operator 7: documents alike in their three-word shingles, as a blocked sparse product.

The documents are the rows and the shingles the columns of a 0/1 matrix; the product of the
matrix with its transpose holds the overlaps of all pairs. Only the part that can matter is
computed, exactly:

* Documents with equal shingle sets are one row.
* Of each row only the first ``n - ceil(t n) + 1`` columns are multiplied, in an order by the
  count of a shingle's rarest word: two rows alike by ``t`` share one of these. Columns that one
  row alone has are dropped.
* Pairs are discarded by bounds from their sizes, from the places of the shared column, and
  from 256 parities: each differing shingle flips one, so more differing parities than
  differing shingles allowed prove the pair unlike.
* For the remaining pairs the overlap is taken over all columns.

A group of near copies would still give every pair of its members. So the product is taken in
rounds. In the first ones each column's rows are multiplied with one row of another component
and about their size, and each row keeps one partner; the links form components. Then only pairs
in different components are multiplied: those in the same one are joined already, whatever their overlap.
Their overlaps over the kept columns are summed, and pairs that the columns left out could not
bring to the threshold are discarded. Two long rows are multiplied only if one of the parts into
which their whole sets are cut is the same, which alike rows cannot avoid (for thresholds from 0.9).
After it every two rows that share a column or part are known to be linked, unlike, or in one component,
so the components are exact.

Shingles are 64-bit hashes, sets of them 128-bit digests. Null texts and texts without words
are empty and linked with nothing. Rows with one id and different texts are separate documents;
null ids are not the smallest of a component that has others. Very long texts are whole. The
table must be stored (read from files), as it is read several times by row position.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import narrow, placed, slices, stored
from lakeconform.llm.textarrays import WHITE, mixed as spread, shingles_of, words_of
from lakeconform.operators.joins import enrich

WIDTH = 3
PERCENT = 90
# Cells of the word counts. They only decide the order of columns; any number is right.
CELLS = 1 << 20
# Rounds with one partner for each row before all pairs left are taken, and the different choices
# of partners that the columns are dealt to in a round.
ROUNDS = 3
CHOICES = 8
# Sets of this size or more differ in about half of the parities, however much they share.
LONG = 1000
SIGNS = ("s0", "s1", "s2", "s3")
# Long sets are met by parts from this threshold on; below it parts are too small to be telling.
PARTED = 90
# Partitions tried for a set whose parts are not all filled.
SEEDS = 4
# A band holds sizes within a tenth of each other.
BAND = 1.1


def _sets(
    batch: pa.RecordBatch, column: str, width: int, classes: np.ndarray | None = None
) -> Iterator[tuple]:
    """Ranges of rows with the sorted shingle set of each.

    With ``classes`` also the class of the rarest word of each shingle in the sets.
    """
    texts = batch.column(column)
    for a, b in slices(texts):
        words = words_of(texts.slice(a, b - a), WHITE)
        found = shingles_of(words, width)
        spans = list(zip(found.rows, found.rows[1:], strict=False))
        if classes is None:
            yield a, b, [np.unique(found.hashes[i:j]) for i, j in spans]
            continue
        word = classes[_cell(words.hashes)]
        sets, rarest = [], []
        for (i, j), start, end in zip(spans, words.rows, words.rows[1:], strict=False):
            values, first = np.unique(found.hashes[i:j], return_index=True)
            own = word[start:end]
            if len(own) > width:
                own = np.lib.stride_tricks.sliding_window_view(own, width).min(axis=1)
            elif len(own):
                own = own.min(keepdims=True)
            sets.append(values)
            rarest.append(own[first])
        yield a, b, sets, rarest


def positioned(docs: DataFrame) -> DataFrame:
    """Ids and texts with the row's position in the stored table."""
    return placed(docs.select("doc_id", "text"))


def word_classes(docs: DataFrame) -> np.ndarray:
    """Count class of every hashed word, four steps to a doubling, in ``CELLS`` cells.

    A shingle is no more frequent than its rarest word, so these few cells tell which shingles
    are rare. Each task sums its own words first; one array of fixed length is collected.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            texts = batch.column("text")
            for a, b in slices(texts):
                words = words_of(texts.slice(a, b - a), WHITE)
                total += np.bincount(_cell(words.hashes), minlength=CELLS)
        cells = np.flatnonzero(total)
        for at in range(0, len(cells), 100_000):
            part = cells[at : at + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(total[part])], names=["cell", "n"]
            )

    counted = docs.select("text").mapInArrow(count, "cell bigint, n bigint")
    classes = counted.groupBy("cell").agg(
        F.expr("CAST(least(255, floor(4 * log2(1 + sum(n)))) AS SMALLINT)").alias("class")
    )
    row = classes.agg(
        F.collect_list("cell").alias("cells"), F.collect_list("class").alias("classes")
    ).first()
    table = np.zeros(CELLS, np.uint8)
    table[np.array(row["cells"], np.int64)] = row["classes"]
    return table


def _cell(hashes: np.ndarray) -> np.ndarray:
    return (hashes & np.uint64(CELLS - 1)).astype(np.int64)


def incidence(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """One row per document: set size, set digest, parities, and the columns to multiply."""
    classes = word_classes(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets, rarest in _sets(batch, "text", width, classes):
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                signs = np.zeros((len(sets), 256), bool)
                prefixes = []
                for i, s in enumerate(sets):
                    signs[i] = np.bincount((s >> np.uint64(56)).astype(np.int64), minlength=256) & 1
                    prefixes.append(_prefix(s, rarest[i], percent).view(np.int64))
                packed = np.packbits(signs, axis=1).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(a, b - a),
                        batch.column("_row").slice(a, b - a),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(digests, pa.binary()),
                        *[pa.array(packed[:, k]) for k in range(4)],
                        pa.array(prefixes, pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "_row", "n", "set_key", *SIGNS, "prefix"],
                )

    picked = docs.select("doc_id", "text", "_row")
    kind = picked.schema["doc_id"].dataType.simpleString()
    signs = ", ".join(f"{s} bigint" for s in SIGNS)
    schema = f"doc_id {kind}, _row bigint, n bigint, set_key binary, {signs}, prefix array<bigint>"
    return picked.mapInArrow(run, schema)


def _prefix(s: np.ndarray, rarest: np.ndarray, percent: int) -> np.ndarray:
    """The first columns of a sorted set, those with the rarest words first."""
    n = len(s)
    size = n - -(-percent * n // 100) + 1 if n else 0
    return s[np.argsort(rarest, kind="stable")[:size]]


def part_keys(hashes: np.ndarray, bounds: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of which any two different sets that are alike by ``percent`` share one.

    ``hashes`` holds the sets one after the other, cut at ``bounds``; returned are the set and the
    key of each part, in no order. Sizes are dealt to levels such that alike sets are in one level
    or in neighbouring ones, and every set is cut by hash for its own level and for the next. A
    level has one part more than shingles may differ between two sets up to its greatest size, so
    one part of the two is the same. That part may be empty; both sets then have an empty part,
    and such sets are cut anew. Only after the last cut are empty parts keys as well.
    """
    sizes = np.diff(bounds)
    tops = [1]
    while tops[-1] < max(int(sizes.max(initial=1)), 1) * 4:
        tops.append(max(tops[-1] + 1, 100 * tops[-1] // percent))
    tops = np.array(tops, np.int64)
    parts_of = (100 - percent) * 2 * tops // (100 + percent) + 1
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    for step in (0, 1):
        level = np.searchsorted(tops, sizes) + step
        # With one part, only equal sets would share it, and those are one row.
        open_rows = (sizes > 0) & (parts_of[level] > 1)
        for seed in range(SEEDS):
            count = np.where(open_rows, parts_of[level], 0)
            base = np.concatenate([[0], np.cumsum(count)])
            taken = open_rows[owner]
            row, own = owner[taken], hashes[taken]
            salt = spread(np.array([seed + 1], np.uint64))[0]
            part = (spread(own ^ salt) % count[row].astype(np.uint64)).astype(np.int64)
            total = np.zeros(base[-1], np.uint64)
            filled = np.zeros(base[-1], bool)
            np.add.at(total, base[row] + part, spread(own + salt))
            filled[base[row] + part] = True
            cell_row = np.repeat(np.arange(len(sizes)), count)
            place = np.arange(base[-1]) - base[cell_row]
            tag = (level[cell_row] << 48 | seed << 40 | place).astype(np.uint64)
            keys = spread(total + spread(tag))
            open_rows = np.bincount(cell_row[~filled], minlength=len(sizes)) > 0
            told = filled | (seed == SEEDS - 1)
            found.append((cell_row[told], keys[told]))
    return np.concatenate([r for r, _ in found]), np.concatenate([k for _, k in found])


APART = " + ".join(f"bit_count(x.{s} ^ y.{s})" for s in SIGNS)


def _possible(percent: int) -> Column:
    """Whether the bounds allow ``x`` and ``y`` to be alike; all of them are exact integers.

    Alike means ``100 i >= p (a + b - i)``: an overlap of at least ``p (a + b) / (100 + p)``,
    and at most ``(100 - p) (a + b) / (100 + p)`` shingles in one of the sets only.
    """
    p, q = percent, 100 + percent
    return F.expr(
        f"100 * least(x.n, y.n) >= {p} * greatest(x.n, y.n)"
        f" AND {q} * (least(x.at, y.at) + least(x.n - x.at, y.n - y.at)) >= {p} * (x.n + y.n)"
        f" AND {q} * ({APART}) <= {100 - p} * (x.n + y.n)"
    )


def _ordered(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def first_pairs(placed: DataFrame, percent: int, seed: int) -> DataFrame:
    """At most one partner of another component for each row: the one that looks most alike.

    The candidates are two rows of different components per column and band of sizes, chosen by
    a hash that changes with ``seed`` and takes one of :data:`CHOICES` values of the column, so
    that a row of a large group meets several components of it. For long rows the parities say
    little; the candidate that shares most columns is taken, and a thousandth of the row's size
    at least. What is left out here is left to the last round, which misses none.
    """
    choice = F.pmod(F.xxhash64("key"), F.lit(CHOICES)) + seed * CHOICES
    chance = F.struct(
        F.xxhash64("root", choice).alias("h"), F.xxhash64("x.rid", choice).alias("i"), "root", "x"
    )
    ends = placed.groupBy("key", "band").agg(F.min(chance).alias("lo"), F.max(chance).alias("hi"))
    shared = (
        enrich(placed, ends.filter("lo.root <> hi.root"), ["key", "band"])
        .withColumn("y", F.expr("IF(root <> lo.root, lo.x, hi.x)"))
        .filter(_possible(percent))
        .groupBy(
            F.col("x.rid").alias("rid"),
            F.col("x.n").alias("n"),
            F.col("y.rid").alias("other"),
            F.expr(APART).alias("apart"),
        )
        .agg(F.count("*").alias("votes"))
        .filter(f"n < {LONG} OR 1000 * votes >= n")
    )
    look = F.struct(F.expr(f"IF(n < {LONG}, apart, 0)").alias("apart"), (-F.col("votes")).alias("v"), "other")
    best = shared.groupBy("rid").agg(F.min(look).alias("best"))
    return _ordered(best, "rid", "best.other").distinct()


def mixed_columns(placed: DataFrame) -> DataFrame:
    """The entries of the columns that rows of several components share, with the main ``root``."""
    sizes = placed.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = sizes.groupBy("key").agg(
        F.max(F.struct("n", "root")).alias("most"), F.count("*").alias("roots")
    )
    shared = enrich(placed, main, ["key"]).filter("roots > 1")
    return stored(shared.select("key", "x", "root", F.col("most.root").alias("main")), "ngram-mixed")


def met_rows(mixed: DataFrame, possible: Column) -> DataFrame:
    """Pairs ``x``, ``y`` of rows in different components, once per column that both have.

    At least one of the two is not of the column's main root.
    """
    strays = mixed.filter("root <> main").select("key", "x", "root")
    others = mixed.select(
        F.col("key").alias("k"),
        F.col("x").alias("y"),
        F.col("root").alias("r"),
        (F.col("root") != F.col("main")).alias("stray"),
    )
    return strays.join(
        others,
        (F.col("key") == F.col("k"))
        & (F.col("root") != F.col("r"))
        & F.expr("NOT stray OR x.rid < y.rid")
        & possible,
    )


def second_pairs(mixed: DataFrame, percent: int) -> DataFrame:
    """The pairs of rows in different components that their overlap so far leaves possible.

    ``mixed`` holds the entries of the columns that rows of several components share, each with
    its ``root`` and the column's most frequent root ``main``. The columns kept per row are its
    first in the common order, so behind the counted ones at most ``n - ceil(t n) + 1`` fewer than
    ``n`` can follow in one of the two. Pairs of long rows are left to :func:`long_pairs`.
    """
    possible = _possible(percent)
    if percent >= PARTED:
        possible = possible & F.expr(f"least(x.n, y.n) < {LONG}")
    met = met_rows(mixed, possible)
    counted = met.groupBy(
        F.least("x.rid", "y.rid").alias("a"),
        F.greatest("x.rid", "y.rid").alias("b"),
        (F.col("x.n") + F.col("y.n")).alias("both"),
        F.greatest("x.n", "y.n").alias("larger"),
    ).agg(F.count("*").alias("shared"))
    rest = f"({percent} * larger + 99) div 100 - 1"
    bound = f"{100 + percent} * (shared + {rest}) >= {percent} * both"
    return counted.filter(bound).select("a", "b")


def long_pairs(rows: DataFrame, labels: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs of long rows in different components that agree in one of their parts.

    Long texts share rare shingles with many others, in passages they have in common, and their
    parities say little; a part holds about ``(100 + p) / (200 - 2 p)`` shingles from all over
    the text, and all of them must agree.
    """
    known = labels.withColumnsRenamed({"rid": "_rid", "root": "_root"})
    wanted = enrich(rows.filter(F.col("n") >= LONG).select("rid", "_row", "n"), known, {"rid": "_rid"})
    wanted = stored(wanted.select("rid", "_row", "n", F.coalesce("_root", "rid").alias("root")), "ngram-wanted")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in _sets(batch, "text", width):
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in sets])]).astype(np.int64)
                row, keys = part_keys(np.concatenate(sets), bounds, percent)
                columns = [batch.column(c).slice(a, b - a).take(pa.array(row)) for c in ("rid", "n", "root")]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(keys.view(np.int64))], names=["rid", "n", "root", "key"]
                )

    texts = docs.join(narrow(wanted), "_row").select("rid", "n", "root", "text")
    entries = stored(texts.mapInArrow(cut, "rid bigint, n bigint, root bigint, key bigint"), "ngram-parts")
    ends = entries.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
    shared = stored(ends.filter("lo <> hi").select("key"), "ngram-columns")
    placed = entries.join(narrow(shared), "key").select("key", F.struct("rid", "n").alias("x"), "root")
    alike_sizes = F.expr(f"100 * least(x.n, y.n) >= {percent} * greatest(x.n, y.n)")
    met = met_rows(mixed_columns(placed), alike_sizes)
    return _ordered(met, "x.rid", "y.rid").distinct()


def linked(pairs: DataFrame, rows: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs that are alike, by their overlap over all columns.

    The sets of the rows in question are made again from their texts; each is shipped to the
    pairs it is in.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rid")).distinct()
    wanted = stored(wanted.join(rows.select("rid", "_row"), "rid"), "ngram-wanted")
    found = docs.join(narrow(wanted), "_row")

    def shingle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, sets in _sets(batch, "text", width):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("rid").slice(a, b - a),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["rid", "shingles"],
                )

    sets = found.select("rid", "text").mapInArrow(shingle, "rid bigint, shingles array<bigint>")
    sets = stored(sets, "ngram-sets")
    both = enrich(pairs, sets.withColumnsRenamed({"shingles": "left"}), {"a": "rid"})
    both = enrich(both, sets.withColumnsRenamed({"shingles": "right"}), {"b": "rid"})

    overlap = both.select(
        "a",
        "b",
        F.expr("size(left) + size(right)").alias("n"),
        F.expr("size(array_intersect(left, right))").alias("shared"),
    )
    return overlap.filter(f"100 * shared >= {percent} * (n - shared)").select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """The smallest row reachable from each row that has a link: ``rid``, ``root``.

    Every round each row takes the smallest label of its neighbours and then its label's label.
    A round is a few aggregations over the links and is stored, so lineage stays short.
    """
    edges = stored(
        links.select("a", "b").union(links.select("b", "a")).toDF("rid", "other").distinct(), "links"
    )
    roots = stored(edges.groupBy("rid").agg(F.least("rid", F.min("other")).alias("root")), "roots")
    while True:
        label = roots.select(F.col("rid").alias("other"), F.col("root").alias("next"))
        nearest = enrich(edges, label, ["other"]).groupBy("rid").agg(F.min("next").alias("near"))
        moved = roots.join(nearest, "rid").select("rid", "root", F.least("root", "near").alias("near"))
        hop = moved.select(F.col("rid").alias("at"), F.col("near").alias("far"))
        after = enrich(moved, hop, {"near": "at"}).select(
            "rid", F.least("near", "far").alias("root"), (F.least("near", "far") < F.col("root")).alias("changed")
        )
        after = stored(after, "roots")
        roots = after.select("rid", "root")
        if after.filter("changed").isEmpty():
            return roots


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels ``rid``, ``root`` after joining the components that ``links`` connect.

    Links count once per pair of components, however many rows of the two they connect.
    """
    if labels is None:
        return components(links)
    known = labels.withColumnsRenamed({"rid": "_rid", "root": "_root"})
    ends = links
    for side in ("a", "b"):
        ends = enrich(ends, known, {side: "_rid"}).withColumn(side, F.coalesce("_root", side)).drop("_root")
    joined = components(ends.filter("a <> b").distinct())
    above = joined.withColumnsRenamed({"rid": "_rid", "root": "_root"})
    moved = enrich(labels, above, {"root": "_rid"}).select("rid", F.coalesce("_root", "root").alias("root"))
    return stored(moved.union(joined.join(labels, "rid", "left_anti").select("rid", "root")), "ngram-labels")


def classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Every document with its row, and every row with its component's root; ``docs`` are :func:`positioned`."""
    table = stored(incidence(docs, width, percent), "ngram-rows")
    signs = [F.first(s).alias(s) for s in SIGNS]
    rows = (
        table.filter("n > 0")
        .groupBy("set_key")
        .agg(
            F.first("n").alias("n"),
            F.first("prefix").alias("prefix"),
            *signs,
            F.min("doc_id").alias("least_id"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_row")).alias("one"),
        )
        .select("set_key", "n", "prefix", *SIGNS, "least_id", "one", "one._row")
    )
    rows = stored(rows.withColumn("rid", F.monotonically_increasing_id()), "ngram-sets-distinct")
    thin = rows.select("rid", "n", F.posexplode("prefix").alias("at", "key"))
    shared = thin.groupBy("key").agg(F.count("*").alias("_rows")).filter("_rows > 1")
    shared = stored(shared.select("key"), "ngram-columns")
    entries = thin.join(narrow(shared), "key")
    entries = enrich(entries, rows.select("rid", *SIGNS), ["rid"])
    band = F.floor(F.log(F.col("n")) / F.log(F.lit(BAND))).alias("band")
    entries = stored(
        entries.select("key", band, F.struct("rid", "n", "at", *SIGNS).alias("x")), "ngram-entries"
    )
    placed = entries.withColumn("root", F.col("x.rid"))
    tried = labels = None
    for seed in range(ROUNDS):
        pairs = first_pairs(placed, percent, seed)
        pairs = pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti")
        pairs = stored(pairs, "ngram-pairs")
        found = stored(linked(pairs, rows, docs, width, percent), "ngram-links")
        tried = pairs if tried is None else tried.union(pairs)
        labels = merged(labels, found)
        known = labels.withColumnsRenamed({"rid": "_rid", "root": "_root"})
        placed = enrich(entries.withColumn("rid", F.col("x.rid")), known, {"rid": "_rid"})
        placed = placed.select("key", "band", "x", F.coalesce("_root", "rid").alias("root"))
        placed = stored(placed, "ngram-placed")
    more = second_pairs(mixed_columns(placed), percent)
    if percent >= PARTED:
        more = more.union(long_pairs(rows, labels, docs, width, percent))
    more = more.join(tried, ["a", "b"], "left_anti")
    more = stored(more, "ngram-pairs")
    more_links = linked(more, rows, docs, width, percent)
    roots = merged(labels, stored(more_links, "ngram-links"))
    labelled = enrich(
        rows.select("set_key", "rid", "least_id", "one"), roots.withColumnsRenamed({"rid": "_rid"}), {"rid": "_rid"}
    ).select("set_key", F.coalesce("root", "rid").alias("root"), "least_id", "one")
    return table, stored(labelled, "ngram-classes")


def alike_documents(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Every document with its set size and the smallest id of its component."""
    table, labelled = classes(positioned(docs), width, percent)
    least = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_set = enrich(labelled.select("set_key", "root"), least, ["root"]).drop("root")
    return enrich(table.select("doc_id", "n", "set_key"), by_set, ["set_key"]).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One document of each component, that of the smallest id; all columns are kept."""
    # Names of its own, so that no column of the documents is hidden.
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    numbered = placed(docs.toDF(*names.values()))
    own = [F.col(names[c]).alias(c) for c in ("doc_id", "text")]
    table, labelled = classes(numbered.select(*own, "_row"), width, percent)
    stays = labelled.groupBy("root").agg(F.min("one").alias("stays"))
    by_set = enrich(labelled.select("set_key", "root"), stays, ["root"]).select(
        "set_key", F.col("stays._row").alias("stays")
    )
    goes = enrich(table.select("_row", "set_key"), by_set, ["set_key"]).filter("_row <> stays")
    goes = stored(goes.select("_row"), "ngram-goes")
    stay = numbered.join(narrow(goes), "_row", "left_anti").drop("_row")
    return stay.toDF(*docs.columns)

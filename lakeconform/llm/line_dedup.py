"""Operator 5: lines that repeat an earlier line, found by an exact set-similarity join.

In DataFrame and SQL functions only. A line is the set of its words in lower case, cut at space
and the controls 9 to 13; lines without words are left alone. Two lines match if their Jaccard similarity is at least 0.8. A line is removed if any
earlier line matches it; earlier means a smaller id, then an earlier row, then a smaller line
number. The test is exact:

* Rarity: words are counted over all lines in ``2 ** 20`` hashed cells. The words of a line are
  ordered by the count of their cell, then by hash; any fixed order is right, and a rare one
  makes short lists.
* Lines with equal sets become one, at its first place. Sets of fewer than four words match only
  equal ones, so they are in no pairs.
* Prefix filter: matching lines share one of their first ``n - ceil(0.8 n) + 1`` words.
* Words seen once are in no pairs.
* Length filter, positional filter, and a filter on 128 parities: each word in one line only
  flips one, so too many different parities prove that too many words differ.
* The shared words of the prefixes are counted per pair. Behind the prefix that ends first there
  are at most ``ceil(0.8 n) - 1`` words, so too few shared ones prove the pair unlike.
* What is left is verified on the whole sets.

A long list of lines that share a word is often one group of near copies. So each line is first
compared with one of the earliest lines of its rarest words. What that settles goes, whatever
else it matches, so it is not compared with earlier lines again, which keeps such a group from
giving all its pairs.

Words are compared by 54 bits of their hash together with their count class, sets by 64-bit
hashes. Null texts stay null. A document whose words are all in removed lines is not kept.
Repeated rows are separate documents: the later row loses its lines. Null ids come first. The
table must be stored (read from files), as it is read several times by row position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import narrow, placed, stored
from lakeconform.operators.joins import enrich

LEAST_WORDS = 1
# Sets below this size match only equal ones: 3 to 4 is under 0.8.
LEAST_PAIRED = 4
# Rarest words of a line that are looked at first.
HEADS = 2
CELLS = 1 << 20
PLACE = "struct<doc_id:bigint,_row:bigint,line_no:int>"

# The words of a line and empty pieces. Cutting at one blank needs no pattern and is much faster.
PIECES = (
    r"IF(line rlike '[\\x09-\\x0D]', split(lower(line), '[\\x20\\x09-\\x0D]+'), split(lower(line), ' '))"
)
# Hashes of the different words; empty pieces are none.
WORDS = f"array_distinct(array_remove(transform({PIECES}, w -> xxhash64(w)), xxhash64('')))"
IDENTITY = (1 << 54) - 1


def lines_of(rows: DataFrame) -> DataFrame:
    """Each line that has a word, with its place.

    The text is asked for a word, since a filter on the hashes would be made of them once more.
    """
    lines = rows.select(
        "doc_id", "_row", F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line")
    )
    return lines.filter(r"line rlike '[^\\x20\\x09-\\x0D]'")


def rarity(rows: DataFrame) -> Column:
    """Count class of every cell, eight steps to a doubling, as one array of fixed length.

    Every occurrence of a word counts, so a cell counted once is a word of one line.
    """
    counted = stored(
        lines_of(rows)
        .select(F.explode(F.expr(PIECES)).alias("word"))
        .filter("word <> ''")
        .groupBy(F.expr(f"CAST(xxhash64(word) & {CELLS - 1} AS INT)").alias("cell"))
        .agg(F.count("*").alias("n")),
        "word-cells",
    )
    every = counted.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell"))
    classes = every.join(counted, "cell", "left").select(
        F.struct(
            "cell", F.expr("CAST(floor(8 * log2(1 + coalesce(n, 0))) AS SMALLINT)").alias("class")
        ).alias("c")
    )
    ordered = classes.agg(F.sort_array(F.collect_list("c")).alias("all"))
    table = stored(ordered.select(F.expr("transform(all, c -> c.class)").alias("classes")), "rarity")
    return table.scalar()


def ordered_lines(lines: DataFrame, classes: Column) -> DataFrame:
    """Lines of :func:`lines_of` as sorted word codes, rarest first, with set hash and size."""
    coded = lines.select("doc_id", "_row", "line_no", F.expr(WORDS).alias("hashes"), classes.alias("classes"))
    words = F.expr(
        "sort_array(transform(hashes, h -> shiftleft(CAST(element_at(classes,"
        f" CAST(h & {CELLS - 1} AS INT) + 1) AS BIGINT), 54) | (h & {IDENTITY})))"
    )
    sorted_words = coded.select("doc_id", "_row", "line_no", words.alias("words"))
    return sorted_words.select(
        F.struct("doc_id", "_row", "line_no").alias("place"),
        "words",
        F.xxhash64("words").alias("key"),
        F.size("words").alias("n"),
    )


PREFIX = "slice(words, 1, n - CAST(ceil(4 * n / 5) AS INT) + 1)"
# Of all words by six bits of their hash, and of those alone that have the seventh.
PARITIES = "aggregate(words, 0L, (a, w) -> a ^ shiftleft(1L, CAST(w & 63 AS INT)))"
UPPER = "aggregate(words, 0L, (a, w) -> a ^ shiftleft(shiftright(w, 6) & 1L, CAST(w & 63 AS INT)))"
# Class of a cell that was counted once.
SINGLE = 8
# 9 i >= 4 (a + b) is Jaccard 0.8; then at most a ninth of a + b is in one set only.
POSSIBLE = (
    "5 * least(x.n, y.n) >= 4 * greatest(x.n, y.n)"
    " AND 9 * (bit_count(x.upper ^ y.upper) + bit_count(x.signs ^ y.signs ^ x.upper ^ y.upper))"
    " <= x.n + y.n"
)
POSITIONS = "9 * (least(x.at, y.at) + least(x.n - x.at, y.n - y.at)) >= 4 * (x.n + y.n)"
# ``shared`` words of the prefixes, sizes ``an`` and ``bn``.
ENOUGH = "9 * (shared + (4 * greatest(an, bn) + 4) div 5 - 1) >= 4 * (an + bn)"


def sketched_lines(rows: DataFrame, classes: Column) -> DataFrame:
    """Each line with its set's hash, its place, size, parities and prefix."""
    return ordered_lines(lines_of(rows), classes).select(
        "key",
        "place",
        "n",
        F.expr(PARITIES).alias("signs"),
        F.expr(UPPER).alias("upper"),
        F.expr(PREFIX).alias("prefix"),
    )


def distinct_lines(lines: DataFrame) -> DataFrame:
    """One row per set: first place, how many lines have it, size, parities and prefix."""
    return lines.groupBy("key").agg(
        F.min("place").alias("place"),
        F.count("*").alias("copies"),
        F.first("n").alias("n"),
        F.first("signs").alias("signs"),
        F.first("upper").alias("upper"),
        F.first("prefix").alias("prefix"),
    )


def by_place(sets: DataFrame) -> DataFrame:
    """The sets with ``id``, a number that grows with their first place."""
    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = sets.repartitionByRange(parts, "place").sortWithinPartitions("place")
    return ordered.withColumn("id", F.monotonically_increasing_id())


def verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs ``a``, ``b`` of set numbers that match, by their whole sets.

    Only the documents in which the sets have their first place are read again, and only those
    lines of them are hashed.
    """
    numbers = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    wanted = stored(
        numbers.join(sets.select("id", "place"), "id").select("id", "place._row", "place.line_no"),
        "lines-wanted",
    )
    holders = stored(wanted.select("_row").distinct(), "lines-holders")
    again = lines_of(rows.join(narrow(holders), "_row", "left_semi"))
    again = again.join(narrow(wanted), ["_row", "line_no"])
    words = stored(again.select("id", F.expr(WORDS).alias("words")), "lines-words")
    both = enrich(pairs, words.withColumnRenamed("words", "left"), {"a": "id"})
    both = enrich(both, words.withColumnRenamed("words", "right"), {"b": "id"})
    return both.filter(
        "9 * size(array_intersect(left, right)) >= 4 * (size(left) + size(right))"
    ).select("a", "b")


def head_pairs(entries: DataFrame) -> DataFrame:
    """At most one earlier set ``a`` for each set ``b``: the one that looks most alike.

    The candidates are the earliest set of about the same size of each word in ``entries``, so
    there are no more of them than entries.
    """
    heads = entries.groupBy("word", "band").agg(F.min("x").alias("y"))
    near = enrich(entries, heads, ["word", "band"]).filter("y.id < x.id").filter(POSSIBLE)
    apart = F.expr("bit_count(x.upper ^ y.upper) + bit_count(x.signs ^ y.signs ^ x.upper ^ y.upper)")
    best = near.groupBy("x.id").agg(F.min(F.struct(apart.alias("apart"), "y.id")).alias("best"))
    return best.select(F.col("best.id").alias("a"), F.col("id").alias("b"))


def removed_lines(rows: DataFrame) -> DataFrame:
    """``_row`` and the numbers of the lines to remove from it, for rows that lose any."""
    classes = rarity(rows)
    lines = stored(sketched_lines(rows, classes), "lines-all")
    sets = stored(by_place(distinct_lines(lines)), "lines")
    # First: the earliest lines of about the same size with one of the rarest shared words.
    larger = sets.filter(F.col("n") >= LEAST_PAIRED)
    rarest = larger.select(
        F.explode(F.expr(f"slice(filter(prefix, w -> shiftright(w, 54) > {SINGLE}), 1, {HEADS})")).alias("word"),
        F.floor(F.log("n") / F.log(F.lit(1.25))).alias("band"),
        F.struct("id", "n", "signs", "upper").alias("x"),
    )
    pairs = stored(head_pairs(rarest), "lines-pairs")
    settled = stored(verified(pairs, sets, rows).select(F.col("b").alias("id")), "lines-settled")
    # Then every pair whose later one is not settled yet; a settled one goes whatever else it matches.
    done = settled.select("id", F.lit(True).alias("done"))
    marked = larger.select("id", "n", "signs", "upper", "prefix").join(narrow(done), "id", "left")
    entries = marked.select(
        F.coalesce("done", F.lit(False)).alias("done"),
        "id",
        "n",
        "signs",
        "upper",
        F.posexplode("prefix").alias("at", "word"),
    ).filter(f"shiftright(word, 54) > {SINGLE}")
    # Both sides are one frame under two names, so that it is shuffled once.
    met = entries.alias("x").join(
        entries.alias("y"),
        F.expr(f"x.word = y.word AND x.id < y.id AND NOT y.done AND {POSSIBLE} AND {POSITIONS}"),
    )
    counted = met.groupBy(
        F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.n").alias("an"), F.col("y.n").alias("bn")
    ).agg(F.count("*").alias("shared"))
    more = stored(counted.filter(ENOUGH).select("a", "b"), "lines-pairs")
    matched = settled.union(verified(more, sets, rows).select("b")).distinct()
    matched = matched.withColumn("matched", F.lit(True))
    firsts = enrich(sets.select("id", "key", "place", "copies"), matched, ["id"])
    losing = stored(
        firsts.filter("matched OR copies > 1").select("key", F.expr("IF(matched, NULL, place)").alias("stays")),
        "lines-losing",
    )
    gone = lines.select("key", "place").join(narrow(losing), "key").filter("stays IS NULL OR place > stays")
    # As many numbers as the document has lines.
    per_row = gone.groupBy(F.col("place._row").alias("_row")).agg(
        F.collect_list("place.line_no").alias("removed")
    )
    return stored(per_row, "lines-removed")


def _rebuilt(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The documents under other column names, with ``_n_lines``, ``_n_removed``, ``_new``

    (the text without repeated lines) and ``_kept``; and the other name of each column.
    """
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    text = names["text"]
    rows = placed(docs.toDF(*names.values()))
    own = [F.col(names[c]).alias(c) for c in ("doc_id", "text")]
    joined = rows.join(narrow(removed_lines(rows.select(*own, "_row"))), "_row", "left")
    lines = f"split({text}, '\\n', -1)"
    left = f"array_except(sequence(0, size({lines}) - 1), removed)"
    rebuilt = F.expr(
        f"CASE WHEN removed IS NULL THEN {text} ELSE array_join(transform(array({lines}),"
        f" ls -> transform({left}, i -> ls[i]))[0], '\\n') END"
    )
    done = joined.withColumns(
        {
            "_n_lines": F.expr(f"CAST(coalesce(size({lines}), 0) AS BIGINT)"),
            "_n_removed": F.expr("CAST(coalesce(size(removed), 0) AS BIGINT)"),
            "_new": rebuilt,
        }
    )
    worded = "rlike '[^\\\\x20\\\\x09-\\\\x0D]'"
    return done.withColumn("_kept", F.expr(f"removed IS NULL OR _new {worded}")), names


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_lines``, ``n_removed``, ``kept`` and the new ``text`` of every document.

    ``kept`` is false if no word is left of a text that lost lines.
    """
    done, names = _rebuilt(docs)
    return done.select(
        F.col(names["doc_id"]).alias("doc_id"),
        F.col("_n_lines").alias("n_lines"),
        F.col("_n_removed").alias("n_removed"),
        F.col("_kept").alias("kept"),
        F.col("_new").alias("text"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The kept documents with all their columns, the new text and, if there, its ``n_chars``."""
    done, names = _rebuilt(docs)
    kept = done.filter("_kept")
    made = {"text": F.col("_new"), "n_chars": F.length("_new").cast("bigint")}
    return kept.select(*[made.get(c, F.col(alias)).alias(c) for c, alias in names.items()])

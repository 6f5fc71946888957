"""Operator 1: quality rules as a short-circuit cascade, in DataFrame and SQL functions only.

Each rule states when it rejects a text and how much work finding out takes. Both are averaged
over a sample; rules then run in order of rejections per unit of work, and a text that one rule
rejects is not looked at by the next. The order changes only the cost and which rule is named:
a text is kept if no rule rejects it, whatever the order.

Words are runs of characters other than space and the controls 9 to 13. Null and empty texts
have no words and fail the base rule. Repeated rows are judged alike; other columns are unused.
Words are counted over whole texts. Three-word windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of the sample, about: the bound on what estimating may cost.
SAMPLE_ROWS = 2_000
SEED = 7


@dataclass(frozen=True)
class Rule:
    """SQL over the base columns and ``text``: a condition and the work of testing it.

    Work is counted in characters passed over, one unit for a rule on counts already made.
    """

    name: str
    rejects: str
    work: str = "1"


LETTERS = r"length(regexp_replace(text, '[^\\p{L}]+', ''))"
CAPITALS = r"length(regexp_replace(text, '[^\\p{Lu}]+', ''))"

RULES = (
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("repeated_lines", "2 * n_dup_lines > n_lines AND n_dup_lines >= 3"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", f"2 * {CAPITALS} > {LETTERS}", "2 * length(text)"),
    Rule("few_letters", f"2 * {LETTERS} < word_chars", "length(text)"),
    Rule(
        "exclamations",
        r"4 * size(regexp_extract_all(text, '!!', 0)) > n_words",
        "length(text)",
    ),
    Rule(
        "same_word_again",
        r"5 * size(regexp_extract_all(text, '(?<![^\\x20\\x09-\\x0D])([^\\x20\\x09-\\x0D]+)"
        r"[\\x20\\x09-\\x0D]+\\1(?![^\\x20\\x09-\\x0D])', 0)) > n_words",
        "4 * length(text)",
    ),
)

WORDS = r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"
WINDOWS = (
    "CASE WHEN size(words) >= 3 THEN transform(sequence(0, size(words) - 3),"
    " i -> xxhash64(words[i], words[i + 1], words[i + 2])) ELSE array() END"
)
LINES = r"filter(split(text, '\n', -1), l -> l rlike '[^\\x20\\x09-\\x0D]')"
LINE_COUNTS = (
    "struct(CAST(size(lines) AS BIGINT) AS n_lines,"
    " CAST(size(lines) - size(array_distinct(lines)) AS BIGINT) AS n_dup_lines)"
)
# Windows sorted with their places; those equal to a neighbour are found twice or more. The
# words they cover are counted by walking their places in order.
REPEATED = """
CASE WHEN size(array_distinct(windows)) = size(windows) THEN 0L ELSE
  transform(array(sort_array(transform(windows, (h, i) -> struct(h, i)))), s ->
    aggregate(
      sort_array(transform(
        filter(
          transform(s, (x, k) -> struct(
            x.i AS i,
            coalesce(get(s, k - 1).h = x.h, false) OR coalesce(get(s, k + 1).h = x.h, false) AS again)),
          y -> y.again),
        y -> y.i)),
      named_struct('covered', 0L, 'last', -3),
      (a, i) -> named_struct('covered', a.covered + least(3, i - a.last), 'last', i),
      a -> a.covered))[0]
END
"""

COUNTS = (
    "struct(CAST(size(words) AS BIGINT) AS n_words,"
    f" transform(array({WINDOWS}), windows -> {REPEATED})[0] AS n_repeat_words)"
)


def base_columns(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with the base counts, all from whole texts."""
    # Words, windows and lines are bound as lambda variables, so that Catalyst cannot move
    # their making into the loops that read them.
    split = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counted = split.select(
        "doc_id",
        "text",
        F.expr(f"transform(array({WORDS}), words -> {COUNTS})[0]").alias("c"),
        F.expr(f"transform(array({LINES}), lines -> {LINE_COUNTS})[0]").alias("l"),
        F.expr(
            r"CAST(length(regexp_replace(text, '[\\x20\\x09-\\x0D]+', '')) AS BIGINT)"
        ).alias("word_chars"),
        F.expr(
            r"CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '')) AS BIGINT)"
        ).alias("n_symbols"),
    ).select("doc_id", "text", "c.*", "l.*", "word_chars", "n_symbols")
    return counted.withColumn(
        "base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")
    )


def cascade_order(docs: DataFrame, rules: Sequence[Rule], rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules, most rejections per unit of work first, by a sample of about ``rows``.

    One row of averages reaches the driver. Rules that tie keep their given order.
    """
    total = docs.count()
    sample = docs.sample(min(1.0, rows / total), SEED) if total > rows else docs
    averages = (
        base_columns(sample)
        .filter("NOT base_failed")
        .agg(
            F.count("*").alias("n"),
            *[F.expr(f"avg(CAST({r.rejects} AS INT))").alias(f"rate_{i}") for i, r in enumerate(rules)],
            *[F.expr(f"avg({r.work})").alias(f"work_{i}") for i, r in enumerate(rules)],
        )
        .first()
    )

    def yield_of(i: int) -> float:
        rate, work = averages[f"rate_{i}"], averages[f"work_{i}"]
        return (rate or 0.0) / max(work or 1.0, 1.0)

    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-yield_of(i), i))]


def apply_rules(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Every document with its counts, whether it is kept, and the rule that rejected it."""
    ordered = cascade_order(docs, rules)
    chain = " ".join(f"WHEN {r.rejects} THEN '{r.name}'" for r in ordered)
    judged = base_columns(docs).withColumn(
        "rejected_by", F.expr(f"CASE WHEN base_failed THEN 'base' {chain} END")
    )
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.col("rejected_by").isNull().alias("kept"),
        "rejected_by",
    )

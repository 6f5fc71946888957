"""Operator 6: personal data in texts, and the words that would give it away.

In DataFrame and SQL functions only. Patterns find e-mail addresses, IP addresses, card and
phone numbers: those are the protected entities. Removing an entity is not enough if words
nearby point to it. So the corpus is asked, line by line and document by document, how often an
entity ``c`` and a word ``t`` stand together: the pointwise mutual information
``log2(n(c,t) N / (n(c) n(t)))`` is the part of the entity's information content
``log2(N / n(c))`` that the word discloses. Words that disclose at least :data:`GENERALISE` of
it become spans to be generalised, from :data:`REMOVE` on to be removed, wherever they occur.

Every entity is assessed, and with it its group, so that rare entities share evidence: the
domain of an e-mail address, the network of an IP address, the first six digits of a card, the
first five of a phone number. A pair counts if chance does not explain it. The bound
``exp(-n(t) KL(n(c,t) / n(t), n(c) / N))`` on the chance of meeting so often stands for its
p-value, and the false discovery rate over all pairs of entities and words of the corpus is kept
at :data:`FALSE_RATE` (Benjamini and Hochberg): of ``k`` pairs as strong as this one, each must be
below ``k FALSE_RATE / pairs``. In the bound, copies of a line or document with the pair are one
meeting. Where even a word that is only ever seen with the entity could not pass if every pair
that was met did, the words are not counted; that leaves out none that would.

Spans count code points, end exclusive. Null texts are empty: no spans. Patterns are written
without backtracking over repeated groups and start only at the head of a run, so very long
runs cost linear time; the leftmost matches stay the same. Rows with one id are separate
documents. Extra columns are unused. The table must be stored, as it is read by row position.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.llm.common import narrow, placed, stored
from lakeconform.operators.joins import enrich

FALSE_RATE = 0.05
# Strengths, natural logarithms of chances, are rounded down to this part of one for ranking.
STEPS = 64
GENERALISE = 0.6
REMOVE = 0.85

# The kinds in their order.
KINDS = ("email", "ip", "card", "phone")
BYTE = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
# Kind: pattern, what a text with a match must hold, and whether a match ``m`` is valid.
PATTERNS = {
    "email": (
        r"(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
        "contains({0}, '@')",
        "true",
    ),
    "ip": (
        r"(?<![0-9])[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
        r"{0} rlike '[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]'",
        rf"m rlike '^{BYTE}(?:\\.{BYTE}){{3}}$'",
    ),
    "card": (
        r"[0-9](?:[\\x20-]?[0-9])++",
        r"{0} rlike '[0-9](?:[\\x20-]?[0-9]){{12}}'",
        "CASE WHEN length(m) < 13 THEN false"
        " WHEN length(regexp_replace(m, '[^0-9]', '')) NOT BETWEEN 13 AND 19 THEN false"
        " ELSE transform(array(reverse(regexp_replace(m, '[^0-9]', ''))), d ->"
        "  aggregate(sequence(1, length(d)), 0, (a, i) -> a + CASE WHEN i % 2 = 1"
        "   THEN CAST(substring(d, i, 1) AS INT)"
        "   ELSE CAST(substring(d, i, 1) AS INT) * 2"
        "    - IF(substring(d, i, 1) > '4', 9, 0) END))[0] % 10 = 0 END",
    ),
    "phone": (
        r"\\+[0-9][\\x20().0-9-]+[0-9]",
        "contains({0}, '+')",
        "length(regexp_replace(m, '[^0-9]', '')) BETWEEN 9 AND 15",
    ),
}
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"
# Any word: letters, their marks, digits.
TERM = r"[\\p{L}\\p{M}\\p{N}]++"
# What an entity is a member of; ``s`` is its span.
GROUP = (
    "CASE s.kind WHEN 'email' THEN substring_index(s.value, '@', -1)"
    " WHEN 'ip' THEN substring_index(s.value, '.', 3)"
    " WHEN 'card' THEN left(regexp_replace(s.value, '[^0-9]', ''), 6)"
    " ELSE left(regexp_replace(s.value, '[^0-9]', ''), 5) END"
)


def spans_of(column: str, kind: str, pattern: str, valid: str) -> str:
    """SQL for the valid matches of a pattern: what lies between matches gives their places.

    Only valid matches are gathered; ``m`` stands for the match in ``valid``.
    """
    return f"""
    transform(array(named_struct(
        'ms', regexp_extract_all({column}, '{pattern}', 0), 'ps', split({column}, '{pattern}', -1))), z ->
      CASE WHEN size(z.ms) = 0 THEN CAST(array() AS {SPAN}) ELSE
        aggregate(sequence(0, size(z.ms) - 1),
          named_struct('at', 0, 'found', CAST(array() AS {SPAN})),
          (a, k) -> transform(array(z.ms[k]), m -> named_struct(
            'at', a.at + length(z.ps[k]) + length(m),
            'found', CASE WHEN {valid} THEN concat(a.found, array(named_struct(
              'kind', '{kind}', 'start', a.at + length(z.ps[k]),
              'end', a.at + length(z.ps[k]) + length(m), 'value', m))) ELSE a.found END))[0],
          a -> a.found) END)[0]
    """


def term_spans(kind: str, words: str) -> str:
    """SQL for the spans in ``text`` of the words in the array column ``words``.

    No word goes over the end of a line, so only lines that hold one are walked word by word. A
    capital sigma is the one letter whose small form depends on what follows, so both are one here.
    """
    folded = "replace(lower({0}), 'ς', 'σ')"
    holds = f"transform(array({folded.format('u')}), v -> exists({words}, w -> contains(v, {folded.format('w')})))[0]"
    found = spans_of("u", kind, TERM, f"array_contains({words}, lower(m))")
    moved = (
        f"transform({found}, s -> named_struct('kind', s.kind, 'start', acc.at + s.start,"
        " 'end', acc.at + s.end, 'value', s.value))"
    )
    return f"""
    aggregate(split(text, '\n', -1), named_struct('at', 0, 'found', CAST(array() AS {SPAN})),
      (acc, u) -> named_struct('at', acc.at + length(u) + 1,
        'found', CASE WHEN {holds} THEN concat(acc.found, {moved}) ELSE acc.found END),
      acc -> acc.found)
    """


def entities(column: str) -> str:
    """SQL for all base spans of a text column, kind by kind."""
    parts = []
    for kind in KINDS:
        pattern, hint, valid = PATTERNS[kind]
        found = spans_of(column, kind, pattern, valid)
        parts.append(f"CASE WHEN {hint.format(column)} THEN {found} ELSE CAST(array() AS {SPAN}) END")
    return f"concat({', '.join(parts)})"


def positioned(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit("")).alias("text")
    return placed(docs.select("doc_id", text))


def units_of(rows: DataFrame, lines: bool) -> DataFrame:
    """The lines of the texts, or the texts whole, as ``unit``."""
    return rows.select(F.explode(F.split("text", "\n", -1)).alias("unit") if lines else F.col("text").alias("unit"))


def protected_units(rows: DataFrame, lines: bool) -> DataFrame:
    """Different units with an entity: entities and groups, other words, copies ``n``."""
    hints = " OR ".join(PATTERNS[k][1].format("unit") for k in KINDS)
    found = units_of(rows, lines).filter(hints).select("unit", F.expr(entities("unit")).alias("spans"))
    longest = "array_sort(spans, (a, b) -> length(b.value) - length(a.value))"
    bare = f"aggregate({longest}, lower(unit), (a, s) -> replace(a, lower(s.value), ' '))"
    return (
        found.filter("size(spans) > 0")
        .select(
            F.xxhash64("unit").alias("unit"),
            F.expr(
                "array_distinct(concat(transform(spans, s -> xxhash64(s.kind, lower(s.value))),"
                f" transform(spans, s -> xxhash64(s.kind, lower({GROUP}), 'group'))))"
            ).alias("entities"),
            F.expr(f"array_distinct(regexp_extract_all({bare}, '{TERM}', 0))").alias("words"),
        )
        .groupBy("unit")
        .agg(F.first("entities").alias("entities"), F.first("words").alias("words"), F.count("*").alias("n"))
    )


def discovered(ranked: DataFrame, alone: float) -> int | None:
    """The lowest ``step`` of strength that keeps the false discovery rate; none if none does.

    ``alone`` is the strength that a pair needs if no other is as strong. Pairs are counted per
    step up to that, so the rows that reach the driver are bounded by it and not by the pairs.
    """
    top = math.ceil(STEPS * alone)
    counts = ranked.groupBy(F.least("step", F.lit(top)).alias("step")).agg(F.count("*").alias("n"))
    lowest, as_strong = None, 0
    for step, n in sorted(((r[0], r[1]) for r in counts.collect()), reverse=True):
        as_strong += n
        if step / STEPS >= alone - math.log(as_strong):
            lowest = step
    return lowest


def disclosing_terms(rows: DataFrame, lines: bool) -> DataFrame:
    """``word`` and ``disclosure``, its largest for any entity, where above the threshold."""
    units = stored(protected_units(rows, lines), "pii-units")
    known = stored(
        units.select(F.explode("entities").alias("entity"), "n")
        .groupBy("entity")
        .agg(F.sum("n").alias("n_entity"), F.count("*").alias("contexts")),
        "pii-entities",
    )
    every = units_of(rows, lines).select(
        F.explode_outer(F.expr(f"array_distinct(regexp_extract_all(lower(unit), '{TERM}', 0))")).alias("word")
    )
    sizes = every.agg(F.approx_count_distinct("word").alias("words")).first()
    total = units_of(rows, lines).count()
    tests = known.count() * sizes["words"]
    none = units.sparkSession.createDataFrame([], "word string, disclosure double")
    if not tests:
        return none
    met = units.agg(F.sum(F.expr("CAST(size(entities) AS BIGINT) * size(words)"))).first()[0]
    alone = math.log(tests / FALSE_RATE)
    least = alone - math.log(max(met, 1))
    # The most that a word seen as often, always with the entity, could prove.
    reach = f"* ln({total}D / contexts) >= {least}D"
    able = stored(known.filter(f"contexts {reach}"), "pii-able")
    pairs = units.select(F.explode("entities").alias("entity"), "words", "n")
    # The entity's figures ride along, so that its pairs are not shuffled a second time for them.
    pairs = pairs.join(narrow(able), "entity")
    joint = (
        pairs.select("entity", "n_entity", "contexts", "n", F.explode("words").alias("word"))
        .groupBy("entity", "word", "n_entity", "contexts")
        .agg(F.sum("n").alias("n_joint"), F.count("*").alias("met"))
    )
    joint = stored(joint.filter(f"met {reach}"), "pii-joint")
    terms = stored(joint.select("word").distinct(), "pii-terms")
    if terms.isEmpty():
        return none
    counts = every.join(narrow(terms), "word", "left_semi").groupBy("word").agg(F.count("*").alias("n_word"))
    measured = enrich(joint, counts, ["word"]).withColumn("seen", F.expr("n_word - n_joint + met"))
    share, rate = "(met / seen)", f"(contexts / {total}D)"
    apart = (
        f"seen * ({share} * ln({share} / {rate})"
        f" + IF(seen = met, 0D, (1 - {share}) * ln((1 - {share}) / (1 - {rate}))))"
    )
    ranked = measured.filter(f"n_entity < {total} AND {share} > {rate}").withColumn(
        "step", F.expr(f"CAST(floor({STEPS} * ({apart})) AS BIGINT)")
    )
    ranked = stored(ranked.filter(f"step >= {math.floor(STEPS * least)}"), "pii-ranked")
    step = discovered(ranked, alone)
    if step is None:
        return none
    strong = (
        ranked.filter(F.col("step") >= step)
        .selectExpr(
            "word",
            f"log2(CAST(n_joint AS DOUBLE) * {total} / n_entity / n_word) / log2({total} / n_entity) AS disclosure",
        )
        .groupBy("word")
        .agg(F.max("disclosure").alias("disclosure"))
    )
    return strong.filter(F.col("disclosure") >= GENERALISE)


def find_personal(docs: DataFrame) -> DataFrame:
    """Every document with ``text`` and ``spans``: kind, start, end, value, by kind and start.

    Kinds are those of the base and ``term`` (to generalise) and ``drop`` (to remove).
    """
    rows = positioned(docs)
    both = disclosing_terms(rows, True).union(disclosing_terms(rows, False))
    terms = stored(both.groupBy("word").agg(F.max("disclosure").alias("disclosure")), "pii-disclosing")
    hits = rows.select("_row", F.explode(F.expr(f"array_distinct(regexp_extract_all(lower(text), '{TERM}', 0))")).alias("word"))
    known = hits.join(narrow(terms), "word").groupBy("_row").agg(
        F.collect_set(F.when(F.col("disclosure") < REMOVE, F.col("word"))).alias("soft"),
        F.collect_set(F.when(F.col("disclosure") >= REMOVE, F.col("word"))).alias("hard"),
    )
    with_terms = rows
    for name in ("soft", "hard"):
        with_terms = with_terms.withColumn(name, F.lit(None).cast("array<string>"))
    if not terms.isEmpty():
        known = stored(known, "pii-known")
        with_terms = rows.join(narrow(known), "_row", "left")
    added = [
        f"CASE WHEN {array} IS NULL OR size({array}) = 0 THEN CAST(array() AS {SPAN})"
        f" ELSE {term_spans(kind, array)} END"
        for kind, array in (("term", "soft"), ("drop", "hard"))
    ]
    return with_terms.select(
        "doc_id", "text", F.expr(f"concat({entities('text')}, {', '.join(added)})").alias("spans")
    )


def sanitised(found: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` with every span replaced by its kind, or nothing for ``drop``."""
    ordered = "array_sort(transform(spans, s -> named_struct('start', s.start, 'end', s.end, 'kind', s.kind)))"
    return found.selectExpr(
        "doc_id",
        f"""aggregate({ordered}, named_struct('at', 0, 'out', ''),
          (a, s) -> IF(s.start < a.at, named_struct('at', greatest(a.at, s.end), 'out', a.out),
            named_struct('at', s.end, 'out', concat(a.out, substring(text, a.at + 1, s.start - a.at),
              IF(s.kind = 'drop', '', concat('<', upper(s.kind), '>'))))),
          a -> concat(a.out, substring(text, a.at + 1))) AS text""",
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of :func:`find_personal`."""

    def joined(spans: str) -> str:
        return f"array_join(transform({spans}, s -> concat_ws(':', s.kind, s.start, s.end)), ',')"

    kinds = ", ".join(f"'{k}'" for k in KINDS)
    return found.selectExpr(
        "doc_id",
        *[f"CAST(size(filter(spans, s -> s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in KINDS],
        f"sha2({joined(f'filter(spans, s -> s.kind IN ({kinds}))')}, 256) AS base_sha256",
        f"{joined('spans')} AS spans",
    )

"""Dates and months written in several text formats."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeconform.functions.text import as_column, trimmed
from lakeconform.settings import DATE_FORMATS, MONTH_FORMATS

# What text each pattern letter group can match at most; used only to skip hopeless parses.
_TOKEN_SHAPES = {
    "yyyy": r"[+-]?\d{4,}",
    "MM": r"\d{2}",
    "dd": r"\d{2}",
    "d": r"[+-]?\d+",
    "MMM": r"\p{L}+\.?",
    "MMMM": r"\p{L}+",
}


def _shape(pattern: str) -> str | None:
    """A regular expression every text parseable by ``pattern`` matches, if one is known."""
    out = []
    for token in re.findall(r"[A-Za-z]+|[^A-Za-z]+", pattern):
        if token.isalpha():
            if token not in _TOKEN_SHAPES:
                return None
            out.append(_TOKEN_SHAPES[token])
        else:
            out.append(re.escape(token).replace(r"\ ", " "))
    return "^" + "".join(out) + "$"


def _first_parse(value: Column | str, formats: Sequence[str]) -> Column:
    """First format that parses. A failed parse costs an exception inside the JVM, so each
    attempt runs only on text of its shape; one attempt per row is the normal case."""
    text = trimmed(value)
    attempts = []
    for pattern in formats:
        attempt = F.try_to_date(text, pattern)
        shape = _shape(pattern)
        attempts.append(attempt if shape is None else F.when(text.rlike(shape), attempt))
    return F.coalesce(*attempts)


def parse_date(value: Column | str, formats: Sequence[str] = DATE_FORMATS) -> Column:
    return _first_parse(value, formats)


def parse_month(value: Column | str, formats: Sequence[str] = MONTH_FORMATS) -> Column:
    """First day of the month named by the text."""
    return _first_parse(value, formats)


def month_key(value: Column | str, formats: Sequence[str] = MONTH_FORMATS) -> Column:
    return F.date_format(parse_month(value, formats), "yyyy-MM")


def active_flag(end: Column | str, as_of: Column) -> Column:
    """Open-ended, or ending on or after the business date."""
    end = as_column(end)
    return end.isNull() | (end >= as_of)

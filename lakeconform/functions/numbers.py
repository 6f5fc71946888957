"""Numbers held as text, capped values and ratios."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeconform.functions.text import as_column, clean_string, trimmed
from lakeconform.settings import SCORE_BANDS


def parse_int(value: Column | str) -> Column:
    """Plain whole numbers only; anything else, or one too large, is null."""
    text = trimmed(value)
    return F.when(text.rlike(r"^-?\d+$"), text.try_cast("int"))


def parse_double(value: Column | str) -> Column:
    """Plain decimals only: no exponent, plus sign or leading dot."""
    text = trimmed(value)
    return F.when(text.rlike(r"^-?\d+(\.\d+)?$"), text.try_cast("double"))


def _band_score(value: Column | str, bands: Mapping[str, float]) -> Column:
    lookup = F.create_map(*[F.lit(x) for pair in bands.items() for x in pair])
    return F.try_element_at(lookup, F.lower(trimmed(value)))


def parse_score(value: Column | str, bands: Mapping[str, float] = SCORE_BANDS) -> Column:
    """The number itself, or the midpoint of a named band."""
    return F.coalesce(parse_double(value), _band_score(value, bands))


def score_origin(value: Column | str, bands: Mapping[str, float] = SCORE_BANDS) -> Column:
    """How the score was given: NUMERIC, BAND, MISSING or UNPARSEABLE."""
    text = clean_string(value)
    return (
        F.when(text.isNull(), "MISSING")
        .when(parse_double(value).isNotNull(), "NUMERIC")
        .when(F.lower(text).isin(*bands), "BAND")
        .otherwise("UNPARSEABLE")
    )


def cap_range(value: Column | str, low: float, high: float) -> Column:
    """Value moved into ``[low, high]``; null stays null."""
    value = as_column(value)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def was_capped(value: Column | str, high: float) -> Column:
    """True only above the upper end; null when unknown."""
    return as_column(value) > F.lit(high)


def guarded_ratio(numerator: Column | str, denominator: Column | str, digits: int = 4) -> Column:
    """Rounded share, or null where there is nothing to divide by."""
    below = as_column(denominator)
    return F.when(below > 0, round_half_away(as_column(numerator) / below, digits))


def round_half_away(value: Column | str, digits: int) -> Column:
    """Round a double by its binary value, halves away from zero, as SQL engines with C's ``round`` do.

    Spark's ``round`` goes by the shortest decimal text, so that 4.935, which lies below the half
    in binary, would become 4.94.
    """
    scale = F.lit(float(10**digits))
    return F.round(as_column(value).cast("double") * scale, 0) / scale


def stable_round(value: Column, digits: int) -> Column:
    """Round a sum or mean of doubles so that the order of addition cannot show.

    The first rounding drops the last few bits, which differ with the order in which
    partial sums meet; the second gives the published precision.
    """
    return round_half_away(round_half_away(value, 9), digits)

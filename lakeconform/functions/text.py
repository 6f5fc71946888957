"""Text cleaning and e-mail repair."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeconform.settings import CANONICAL_DOMAIN, DOMAIN_TYPOS

EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[A-Za-z]{2,}$"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Text without surrounding spaces. Parsers start here, since none of them accepts blank."""
    return F.trim(as_column(value).cast("string"))


def clean_string(value: Column | str) -> Column:
    """Text without surrounding spaces; blank becomes null."""
    text = trimmed(value)
    return F.when(text != "", text)


def normalize_email(
    value: Column | str,
    canonical: str = CANONICAL_DOMAIN,
    typos: Sequence[str] = DOMAIN_TYPOS,
) -> Column:
    """Lower-case address with a repaired domain; null without an ``@``.

    Only the text up to a second ``@`` counts.
    """
    address = F.substring_index(F.lower(trimmed(value)), "@", 2)
    repaired = address
    if typos:
        wrong = "|".join(re.escape(domain) for domain in typos)
        repaired = F.regexp_replace(address, f"@({wrong})$", "@" + canonical.replace("$", r"\$"))
    return F.when(F.contains(address, F.lit("@")), repaired)


def email_domain(value: Column | str) -> Column:
    """The text after the first ``@``, in its original case."""
    return F.get(F.split(trimmed(value), "@"), F.lit(1))


def is_valid_email(value: Column | str) -> Column:
    return clean_string(value).rlike(EMAIL_PATTERN)


def upper_label(value: Column | str) -> Column:
    return F.upper(clean_string(value))


def default_label(value: Column | str, label: str) -> Column:
    """A named stand-in for null, so that unknowns show up in groupings."""
    return F.coalesce(as_column(value), F.lit(label))


def tristate_equal(left: Column | str, right: Column | str) -> Column:
    """True, false, or null when either side is unknown."""
    return as_column(left) == as_column(right)

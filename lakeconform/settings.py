"""Run settings: every business constant in one frozen value, passed as an argument."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# The corporate domain, its known misspellings, the text formats
# seen in the exports and the midpoints of the three impact bands.
CANONICAL_DOMAIN = "acme-inc.com"
DOMAIN_TYPOS = ("acmeinc.com", "acme_inc.com", "acme-inc.co")
DATE_FORMATS = (
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
    "MMMM d, yyyy",
    "d MMMM yyyy",
)
MONTH_FORMATS = ("yyyy-MM", "yyyy/MM", "MMMM yyyy")
SCORE_BANDS = {"low": 2.5, "medium": 5.0, "high": 8.0}


@dataclass(frozen=True)
class Settings:
    """Thresholds, vocabularies and the business date of one run.

    ``as_of`` fixes "today" for the not-in-the-future rules and the active flag, so a
    rerun on another day gives the same rows; left out, the session's current date is used.
    """

    canonical_domain: str = CANONICAL_DOMAIN
    domain_typos: tuple[str, ...] = DOMAIN_TYPOS
    date_formats: tuple[str, ...] = DATE_FORMATS
    month_formats: tuple[str, ...] = MONTH_FORMATS
    score_bands: dict[str, float] = field(default_factory=lambda: dict(SCORE_BANDS))
    ratio_threshold: float = 0.20
    quarantine_tolerance: float = 0.25
    fail_on_zero_rows: bool = True
    as_of: date | None = None

    def __post_init__(self) -> None:
        if not 0 < self.ratio_threshold < 1:
            raise ValueError(f"ratio_threshold must lie between 0 and 1: {self.ratio_threshold}")

    @property
    def as_of_sql(self) -> str:
        return "current_date()" if self.as_of is None else f"DATE '{self.as_of.isoformat()}'"

    @property
    def as_of_column(self) -> Column:
        return F.expr(self.as_of_sql)

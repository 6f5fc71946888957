"""Conform dirty operational exports into validated, deduplicated, curated Spark tables."""

from lakeconform.settings import Settings

__all__ = ["Settings"]

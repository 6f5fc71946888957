"""Helpers that several test modules share."""

from __future__ import annotations


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in picked.collect()), key=repr)

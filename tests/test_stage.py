"""Queries that use a step several times read its written rows, not the raw tables again."""

from __future__ import annotations

import pytest

from lakeconform.catalog import queries as catalog

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["watermark_delta", "adrift_team_membership", "rejected_team_membership", "concurrent_leads"])
def test_repeated_steps_read_written_rows(spark, name):
    plan = catalog.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "lakeconform-stage" in plan and "lineitem.parquet" not in plan

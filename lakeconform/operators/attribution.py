"""Fill in a missing team only where the evidence leaves exactly one candidate."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.operators.joins import enrich

SOURCE = "SOURCE"
RESOLVED = "RESOLVED_VIA_REPORTER"
UNRESOLVED = "UNRESOLVED"


def unique_candidates(memberships: DataFrame, teams: DataFrame) -> DataFrame:
    """``(employee_email, team_name) -> team_id`` where a person is on one such team only.

    The candidates of a fact depend on its reporter and team name alone, so they are settled
    once per such pair and facts never meet memberships row by row: no fan-out, however many
    teams share a name. "Exactly one candidate" is "lowest id = highest id", two partial
    aggregates instead of a set.
    """
    pairs = memberships.filter("employee_email IS NOT NULL AND team_id IS NOT NULL").select(
        "employee_email", "team_id"
    ).distinct()
    named = enrich(pairs, teams.select("team_id", "team_name"), ["team_id"]).filter(
        "team_name IS NOT NULL"
    )
    return (
        named.groupBy("employee_email", "team_name")
        .agg(F.min("team_id").alias("candidate_team_id"), F.max("team_id").alias("_last"))
        .filter("candidate_team_id = _last")
        .drop("_last")
    )


def attribute_unique(facts: DataFrame, memberships: DataFrame, teams: DataFrame) -> DataFrame:
    """Add ``team_id`` and ``team_id_origin`` to facts with ``source_team_id``,
    ``reported_by`` and ``team_name``. Row count and order of columns are kept.

    Facts are evaluated once. Those that already name their team ask with a null key, which
    matches nothing and which adaptive execution splits as it does any frequent key.
    """
    own = [F.col(name) for name in facts.columns]
    asks = F.col("source_team_id").isNull()
    asking = facts.withColumns(
        {"_reporter": F.when(asks, F.col("reported_by")), "_name": F.when(asks, F.col("team_name"))}
    )
    matched = enrich(
        asking,
        unique_candidates(memberships, teams),
        {"_reporter": "employee_email", "_name": "team_name"},
    )
    found = F.col("candidate_team_id")
    origin = F.when(~asks, SOURCE).when(found.isNotNull(), RESOLVED).otherwise(UNRESOLVED)
    team = F.coalesce("source_team_id", found)
    return matched.select(*own, team.alias("team_id"), origin.alias("team_id_origin"))


def attribution_summary(attributed: DataFrame) -> DataFrame:
    """Facts without a team at the source, and what became of them."""
    origin = F.col("team_id_origin")
    return attributed.agg(
        F.count_if(origin != SOURCE).alias("unattributed_in_source"),
        F.count_if(origin == RESOLVED).alias("resolved_via_reporter"),
        F.count_if(origin == UNRESOLVED).alias("still_unresolved"),
    )

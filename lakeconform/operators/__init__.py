"""DataFrame-to-DataFrame building blocks: contracts, dedup, joins, identity, attribution."""

from lakeconform.operators.attribution import (
    RESOLVED,
    SOURCE,
    UNRESOLVED,
    attribute_unique,
    attribution_summary,
    unique_candidates,
)
from lakeconform.operators.dedup import deduplicate, duplicates, keep_first, surplus_rows
from lakeconform.operators.identity import dominant_value, unify_people
from lakeconform.operators.joins import enrich
from lakeconform.operators.quality import (
    Contract,
    Outcome,
    Rule,
    SchemaDriftError,
    check_required,
    mark_rejected,
    outcome_totals,
    rule_failures,
    validate,
    violations,
    warning_counts,
)
from lakeconform.operators.snapshots import incremental, latest_snapshot, next_watermark

__all__ = [
    "RESOLVED",
    "SOURCE",
    "UNRESOLVED",
    "Contract",
    "Outcome",
    "Rule",
    "SchemaDriftError",
    "attribute_unique",
    "attribution_summary",
    "check_required",
    "deduplicate",
    "dominant_value",
    "duplicates",
    "enrich",
    "incremental",
    "keep_first",
    "latest_snapshot",
    "mark_rejected",
    "next_watermark",
    "outcome_totals",
    "rule_failures",
    "surplus_rows",
    "unify_people",
    "unique_candidates",
    "validate",
    "violations",
    "warning_counts",
]

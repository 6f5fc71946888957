"""Row validation from declared rules: valid rows, rejected rows with reasons, and counts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VIOLATIONS = "_violations"
REASON = "_rejection_reason"

ERROR = "error"
WARNING = "warning"


class SchemaDriftError(ValueError):
    """A frame lacks columns its contract requires."""


@dataclass(frozen=True)
class Rule:
    """A named SQL condition. ``null_passes`` decides what an unknown result means."""

    name: str
    expr: str
    description: str = ""
    severity: str = ERROR
    null_passes: bool = True

    @property
    def holds(self) -> str:
        """The condition as SQL that is never unknown."""
        return f"coalesce({self.expr}, {str(self.null_passes).lower()})"


@dataclass(frozen=True)
class Reference:
    """A rule across entities: a value of ``column`` must stand in ``target`` of ``parent``.

    A null refers to nothing and passes.
    """

    name: str
    column: str
    parent: str
    target: str


@dataclass(frozen=True)
class Contract:
    """What one entity must look like: columns, business key, rules, quarantine tolerance."""

    entity: str
    required: tuple[str, ...]
    key: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    tolerance: float | None = None
    references: tuple[Reference, ...] = ()

    @property
    def errors(self) -> tuple[Rule, ...]:
        return tuple(rule for rule in self.rules if rule.severity == ERROR)

    @property
    def warnings(self) -> tuple[Rule, ...]:
        return tuple(rule for rule in self.rules if rule.severity == WARNING)


@dataclass(frozen=True)
class Outcome:
    """The lazy result of a validation; each frame is put together when asked for."""

    contract: Contract
    df: DataFrame

    @cached_property
    def annotated(self) -> DataFrame:
        """The input with the names of the rules each row broke."""
        return self.df.withColumn(VIOLATIONS, violations(self.contract.errors))

    @property
    def passes(self) -> str:
        """SQL condition of a valid row, never unknown."""
        return " AND ".join(rule.holds for rule in self.contract.errors) or "true"

    @cached_property
    def valid(self) -> DataFrame:
        """Rows that meet the plain conjunction of the rules: no arrays of names are built.

        A row that fails is an empty array to ``inline``, since Catalyst would push a filter below
        the parsing it depends on and so parse everything twice.
        """
        if not self.contract.errors:
            return self.df
        once = f"IF({self.passes}, array(struct(true AS _passes)), array())"
        return self.df.selectExpr("*", f"inline({once})").drop("_passes")

    @cached_property
    def invalid(self) -> DataFrame:
        rejected = with_reason(self.annotated)
        return rejected if self.contract.errors else rejected.limit(0)


def check_required(df: DataFrame, contract: Contract) -> None:
    missing = [name for name in contract.required if name not in df.columns]
    if missing:
        raise SchemaDriftError(
            f"{contract.entity}: missing required columns {missing}; present {sorted(df.columns)}"
        )


def violations(rules: Sequence[Rule]) -> Column:
    """Names of the broken rules, in rule order."""
    if not rules:
        return F.expr("CAST(array() AS ARRAY<STRING>)")
    checks = ", ".join(f"IF({rule.holds}, NULL, '{rule.name}')" for rule in rules)
    return F.expr(f"array_compact(array({checks}))")


def with_reason(annotated: DataFrame) -> DataFrame:
    """The rows of an annotated frame that broke a rule, with the names joined as the reason."""
    return annotated.filter(F.size(VIOLATIONS) > 0).withColumn(
        REASON, F.concat_ws("; ", F.col(VIOLATIONS))
    )


def validate(df: DataFrame, contract: Contract) -> Outcome:
    """Check the columns now; split the rows lazily. No job runs here."""
    check_required(df, contract)
    return Outcome(contract, df)


def _failure_counts(rules: Sequence[Rule]) -> list[Column]:
    return [F.expr(f"count_if(NOT {rule.holds}) AS {rule.name}") for rule in rules]


def _as_rows(counts: DataFrame, rules: Sequence[Rule], label: str) -> DataFrame:
    pairs = ", ".join(f"struct('{r.name}' AS rule, {r.name} AS {label})" for r in rules)
    return counts.selectExpr(f"inline(array({pairs}))").filter(f"{label} > 0")


def rule_failures(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows broken per error rule (``rule``, ``failures``), non-zero only, in one pass."""
    if not contract.errors:
        return df.sparkSession.createDataFrame([], "rule string, failures long")
    return _as_rows(df.agg(*_failure_counts(contract.errors)), contract.errors, "failures")


def warning_counts(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows per broken warning rule (``rule``, ``warnings``); these rows are not rejected."""
    if not contract.warnings:
        return df.sparkSession.createDataFrame([], "rule string, warnings long")
    return _as_rows(df.agg(*_failure_counts(contract.warnings)), contract.warnings, "warnings")


def outcome_totals(annotated: DataFrame, contract: Contract) -> DataFrame:
    """Totals, reject ratio and every rule's count in one row from one scan.

    Counts are plain aggregates, not listeners or accumulators, so a lost executor cannot
    make them count a partition twice.
    """
    counts = annotated.agg(
        F.expr("count(*) AS rows_in"),
        F.expr(f"count_if(size({VIOLATIONS}) = 0) AS rows_valid"),
        F.expr(f"count_if(size({VIOLATIONS}) > 0) AS rows_invalid"),
        *_failure_counts(contract.rules),
    )
    return counts.selectExpr(
        "rows_in",
        "rows_valid",
        "rows_invalid",
        "IF(rows_in > 0, rows_invalid / rows_in, 0.0D) AS reject_ratio",
        *[rule.name for rule in contract.rules],
    )


def mark_rejected(df: DataFrame, reason: str) -> DataFrame:
    return df.withColumn(REASON, F.lit(reason))

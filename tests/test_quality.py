import pytest
from support import rows_of

from lakeconform.operators.quality import (
    WARNING,
    Contract,
    Rule,
    SchemaDriftError,
    mark_rejected,
    outcome_totals,
    rule_failures,
    validate,
    warning_counts,
)
from lakeconform.plans.contracts import contracts, get_contract, rule_catalogue

# Parcels on their way: a weight in grams and a route of two harbour codes.
PARCELS = Contract(
    "parcels",
    ("tracking", "grams", "route"),
    ("tracking",),
    (
        Rule("tracking_given", "tracking IS NOT NULL", null_passes=False),
        Rule("route_shape", "route RLIKE '^[A-Z]{3}>[A-Z]{3}$'"),
        Rule("goes_somewhere", "substring(route, 1, 3) <> substring(route, 5, 3)"),
        Rule("weight_known", "grams > 0", severity=WARNING),
    ),
)


@pytest.fixture
def parcels(spark):
    rows = [
        ("p1", 700, "OSL>LIM"),
        ("p2", 0, "LIM>OSL"),
        ("p3", 90, "LIM>LIM"),
        (None, 40, "OSL>LIM"),
        ("p5", -3, "somewhere"),
        ("p6", 12, None),
        ("p7", 1, "KIX>OSL"),
        ("p8", 5, "kix>OSL"),
    ]
    return spark.createDataFrame(rows, "tracking string, grams int, route string")


def test_every_row_is_valid_or_has_a_reason(parcels):
    outcome = validate(parcels, PARCELS)
    assert {r.tracking for r in outcome.valid.collect()} == {"p1", "p2", "p6", "p7"}
    reasons = {r.tracking: r._rejection_reason for r in outcome.invalid.collect()}
    assert reasons == {
        "p3": "goes_somewhere",
        None: "tracking_given",
        "p5": "route_shape",
        "p8": "route_shape",
    }


def test_totals_of_one_pass(parcels):
    totals = outcome_totals(validate(parcels, PARCELS).annotated, PARCELS).first()
    assert (totals.rows_in, totals.rows_valid, totals.rows_invalid) == (8, 4, 4)
    assert totals.reject_ratio == 0.5
    # Warnings are counted over all rows or the valid ones, but never reject.
    assert rows_of(warning_counts(parcels, PARCELS)) == [("weight_known", totals.weight_known)]
    assert totals.weight_known >= 1


def test_failures_are_counted_by_rule(parcels):
    found = rows_of(rule_failures(parcels, PARCELS))
    assert found == [("goes_somewhere", 1), ("route_shape", 2), ("tracking_given", 1)]


def test_all_broken_rules_are_named_in_order(spark):
    df = spark.createDataFrame([(None, 8, "aa>aa")], "tracking string, grams int, route string")
    row = validate(df, PARCELS).invalid.first()
    assert row._violations == ["tracking_given", "route_shape"]
    assert row._rejection_reason == "tracking_given; route_shape"


def test_a_lost_column_is_drift(parcels):
    with pytest.raises(SchemaDriftError, match="parcels.*route.*tracking"):
        validate(parcels.drop("route"), PARCELS)


def test_warnings_alone_reject_nothing(parcels):
    lenient = Contract("parcels", (), (), PARCELS.warnings)
    outcome = validate(parcels, lenient)
    assert (outcome.valid.count(), outcome.invalid.count()) == (8, 0)
    assert outcome_totals(outcome.annotated, lenient).first().weight_known == 2
    assert rows_of(rule_failures(parcels, lenient)) == []


def test_nothing_in_gives_ratio_zero(parcels):
    outcome = validate(parcels.filter("false"), PARCELS)
    assert outcome_totals(outcome.annotated, PARCELS).first().reject_ratio == 0.0


def test_rows_can_be_rejected_for_one_reason(parcels):
    assert {r._rejection_reason for r in mark_rejected(parcels, "customs").collect()} == {"customs"}


def test_registry(spark):
    known = contracts()
    assert len(known) == 7
    rows = rule_catalogue(spark).collect()
    assert len(rows) == 52
    assert sum(r.severity == WARNING for r in rows) == 14
    assert all(r.description for r in rows)
    for contract in known.values():
        names = [rule.name for rule in contract.rules]
        assert len(names) == len(set(names))
        assert contract.errors and contract.key
    assert known["achievements"].tolerance == 0.40
    with pytest.raises(KeyError, match="employees"):
        get_contract("nothing")

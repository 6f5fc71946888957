import csv
import json
from datetime import date

import pytest
from support import rows_of

from lakeconform.plans import gates, insights
from lakeconform.plans.pipeline import GOLD_DATASETS, run_pipeline
from lakeconform.settings import Settings
from lakeconform.sources.lake import Lake, read_gold, read_silver
from lakeconform.sources.registry import SOURCES, Origin

SETTINGS = Settings(as_of=date(2024, 2, 1))

EXPORTS = {
    "employees": [
        {
            "emp_id": f"EMP-{n}", "full_name": f"N{n}", "email": f" P{n}@acmeinc.com ",
            "department": "D", "location_code": "LOC-01", "employment_type": "FT",
            "manager_emp_id": "", "hire_date": "August 19, 2020", "status": "Active",
        }
        for n in range(1, 6)
    ],
    "contractor_roster": [
        {
            "contractor_id": "CTR-1", "full_name": "V", "email": "v@vendor.com", "agency": "Ag",
            "location_code": "LOC-02", "engagement_type": "C2C", "start_date": "2020-01-01",
            "end_date": "2019-01-01", "status": "active",
        },
        {
            "contractor_id": "CTR-2", "full_name": "P1", "email": "p1@acme-inc.com",
            "agency": "Ag", "location_code": "LOC-02", "engagement_type": "temp",
            "start_date": "2020-01-01", "end_date": "", "status": "active",
        },
    ],
    "locations": [
        {"location_code": "LOC-01", "city": "Dallas", "country": "US", "region": "amer", "timezone": "C"},
        {"location_code": "LOC-01", "city": "Austin", "country": "US", "region": "amer", "timezone": "C"},
        {"location_code": "LOC-02", "city": "Oslo", "country": "NO", "region": "emea", "timezone": "C"},
    ],
    "organizations": [
        {"org_id": "ORG-1", "org_name": "One", "org_leader_email": "p1@acme_inc.com"}
    ],
    "teams": [
        {
            "team_id": "TM-001", "team_name": "Red",
            "organization": {"org_id": "ORG-1", "org_name": "One"},
            "team_leader_email": "v@vendor.com", "primary_office": "LOC-01",
            "reports_to_type": "Org Leader", "reporting_manager_email": "p1@acme-inc.com",
            "formed_date": "2020/01/01",
        },
    ],
    "team_membership": [
        {
            "team_code": "tm1", "employee_email": email, "role": "Member", "allocation_pct": "150",
            "start_date": "01/02/2021", "end_date": "",
        }
        for email in ["p1@acmeinc.com", "p2@acmeinc.com", "v@vendor.com", "p2@acmeinc.com", "bad"]
    ],
    "monthly_achievements": [
        {
            "team_id": team, "team_name": "Red", "month": "2024-01", "title": title,
            "category": "C", "impact_score": score, "reported_by": "p1@acme-inc.com",
        }
        for team, title, score in [("tm1", "A", 5), (None, "B", "Low"), ("tm1", "C", None)]
    ],
}


def write_exports(root):
    for source in SOURCES:
        folder = root / source.system
        folder.mkdir(parents=True, exist_ok=True)
        rows = EXPORTS[source.entity]
        path = folder / source.file_name
        if source.file_format == "json":
            path.write_text("".join(json.dumps(row) + "\n" for row in rows))
        else:
            with path.open("w", newline="") as f:
                writer = csv.DictWriter(f, rows[0].keys())
                writer.writeheader()
                writer.writerows(rows)
    return Origin(str(root))


@pytest.fixture
def origin(tmp_path):
    return write_exports(tmp_path / "raw")


@pytest.fixture
def home(tmp_path):
    return Lake(str(tmp_path / "lake"))


@pytest.fixture(scope="module")
def first(spark, tmp_path_factory):
    """One full run that several tests look at: lake, origin and report."""
    root = tmp_path_factory.mktemp("full")
    lake, exports = Lake(str(root / "lake")), write_exports(root / "raw")
    return lake, exports, run(spark, lake, exports, batch_id="b1")


def run(spark, home, origin, **options):
    return run_pipeline(
        spark, home, origin, SETTINGS, route="file", ingest_date="2024-02-01", **options
    )


def by_entity(report):
    return {(r.layer, r.entity): r for r in report.metrics.collect()}


def test_full_run(spark, first):
    home, _, report = first
    rows = by_entity(report)
    assert len(rows) == 7 + 8 + 9
    assert {r.status for r in rows.values()} == {"SUCCESS"}
    assert all(r.reconciles for r in rows.values())
    counts = {
        entity: (r.rows_read, r.rows_written, r.rows_quarantined)
        for (layer, entity), r in rows.items()
        if layer == "silver"
    }
    assert counts == {
        "locations": (3, 2, 1),
        "organizations": (1, 1, 0),
        "employees": (5, 5, 0),
        "contractors": (2, 2, 0),
        "dim_person": (7, 6, 1),
        "teams": (1, 1, 0),
        "team_membership": (5, 3, 2),
        "achievements": (3, 3, 0),
    }
    # Three small tables lose more than a quarter of their rows here, and the run says so.
    assert report.findings == [
        ("quarantine", "silver", "locations"),
        ("quarantine", "silver", "team_membership"),
    ]
    assert not report.passed
    notes = json.loads(rows["silver", "team_membership"].notes)
    assert notes["rule_failures"] == {"email_required": 1}
    assert notes["warnings"]["allocation_in_range"] == 5

    rejected = spark.read.parquet(home.quarantine("silver", "team_membership", "b1"))
    assert rows_of(rejected, "_rejection_reason") == [
        ("duplicate_business_key[team_id,employee_email,start_date]",),
        ("email_required",),
    ]
    person = {r.email: r for r in read_silver(spark, home, "dim_person").collect()}
    assert person["p1@acme-inc.com"].staff_type == "DIRECT"
    assert person["v@vendor.com"]._batch_id == "b1"

    answers = {r.question_id: r.answer for r in read_gold(spark, home, "business_answers").collect()}
    assert answers == {"Q1": 1, "Q2": 1, "Q3": 1, "Q4": 1, "Q5": 1, "Q6": 1, "Q7": 1}
    gold = {name: read_gold(spark, home, name) for name in GOLD_DATASETS}
    consistency = insights.n20_answer_consistency(gold["business_answers"], gold)
    insights.assert_consistent(consistency)
    assert insights.n18_dataset_inventory(gold).count() == 9


def test_rerun_gives_the_same_tables_and_appends_a_manifest(spark, first):
    home, origin, _ = first

    def tables():
        kept = ["_batch_id", "_processed_at", "_ingested_at"]
        return {
            name: rows_of(read_gold(spark, home, name).drop(*kept))
            for name in GOLD_DATASETS
        }

    before = tables()
    real = by_entity(run(spark, home, origin, batch_id="b2"))
    assert tables() == before
    dry = by_entity(run(spark, home, origin, dry_run=True))
    assert {k: (r.rows_read, r.rows_written, r.rows_quarantined) for k, r in dry.items()} == {
        k: (r.rows_read, r.rows_written, r.rows_quarantined) for k, r in real.items()
    }
    manifest = spark.read.parquet(home.manifest())
    assert rows_of(manifest.groupBy("batch_id").count()) == [("b1", 24), ("b2", 24)]
    assert gates.run_summary(manifest).filter("reconciliation = 'OK'").count() == 48


def test_entities_stages_and_dry_run(spark, home, origin):
    with pytest.raises(KeyError, match="nothing"):
        run(spark, home, origin, entities=["nothing"])
    with pytest.raises(KeyError, match="platinum"):
        run(spark, home, origin, stages=["platinum"])
    report = run(spark, home, origin, stages=["bronze"], entities=["teams"])
    assert set(by_entity(report)) == {("bronze", "teams")}
    dry = run(spark, home, origin, stages=["silver"], entities=["teams"], dry_run=True, batch_id="dry")
    rows = by_entity(dry)
    assert rows["silver", "teams"].rows_written == 1
    # The person dimension is always rebuilt; without its inputs it fails on its own.
    assert rows["silver", "dim_person"].status == "FAILED"
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_silver(spark, home, "teams")


def test_one_missing_export_fails_alone(spark, home, origin, tmp_path):
    (tmp_path / "raw" / "facilities" / "locations.csv").unlink()
    rows = by_entity(run(spark, home, origin, stages=["bronze", "silver"]))
    assert rows["bronze", "locations"].status == "FAILED"
    assert rows["silver", "locations"].status == "FAILED"
    assert rows["silver", "achievements"].status == "SUCCESS"


def test_nothing_works_ends_the_run(spark, home, tmp_path):
    report = run(spark, home, Origin(str(tmp_path / "empty")))
    status = {(r.layer, r.status) for r in report.metrics.collect()}
    assert status == {("bronze", "FAILED"), ("silver", "SKIPPED"), ("gold", "SKIPPED")}
    goes_on = run(spark, home, Origin(str(tmp_path / "empty")), continue_on_error=True)
    assert {r.layer for r in goes_on.metrics.collect()} == {"bronze", "silver", "gold"}
    assert not goes_on.passed


def test_drift_quarantines_the_feed(spark, home, origin, tmp_path):
    """A feed that lost a column goes to quarantine whole, with its raw columns."""
    lost = [{k: v for k, v in row.items() if k != "org_leader_email"} for row in EXPORTS["organizations"]]
    feed = tmp_path / "raw" / "org_structure" / "organizations.json"
    feed.write_text("".join(json.dumps(row) + "\n" for row in lost))
    rows = by_entity(run(spark, home, origin, stages=["bronze", "silver"], batch_id="b1"))
    failed = rows["silver", "organizations"]
    assert (failed.status, failed.rows_read, failed.rows_quarantined) == ("FAILED", 1, 1)
    assert "schema drift" in failed.error and "org_leader_email" in failed.error
    rejected = spark.read.parquet(home.quarantine("silver", "organizations", "b1"))
    assert rows_of(rejected, "org_name", "_rejection_reason") == [("One", "schema_drift")]
    assert rows["silver", "teams"].status == "SUCCESS"


def test_an_array_read_as_lines_is_drift(spark, home, origin, tmp_path):
    feed = tmp_path / "raw" / "project_tracking" / "teams.json"
    feed.write_text(json.dumps(EXPORTS["teams"], indent=2))
    rows = by_entity(run(spark, home, origin, stages=["bronze", "silver"], batch_id="b1"))
    assert rows["silver", "teams"].status == "FAILED"
    assert rows["silver", "teams"].rows_quarantined == rows["silver", "teams"].rows_read > 0
    arrays = run(spark, home, origin, stages=["bronze", "silver"], options={"teams": {"multiline": True}})
    assert by_entity(arrays)["silver", "teams"].status == "SUCCESS"


def test_no_entities_means_all(spark, home, origin):
    report = run(spark, home, origin, stages=["bronze"], entities=[])
    assert len(report.metrics.collect()) == 7


def test_an_error_without_a_message_stays_in_its_row(spark, home, origin, monkeypatch):
    from lakeconform.plans import pipeline

    def broken(*_):
        raise AssertionError

    monkeypatch.setattr(pipeline, "write_bronze", broken)
    rows = by_entity(run(spark, home, origin, stages=["bronze"], entities=["teams"]))
    assert (rows["bronze", "teams"].status, rows["bronze", "teams"].error) == ("FAILED", "AssertionError")


def test_a_stage_that_breaks_off_and_what_follows_have_rows(spark, home, origin, monkeypatch):
    from lakeconform.plans import pipeline

    def broken(*_):
        raise RuntimeError("no reason")

    monkeypatch.setattr(pipeline, "run_silver", broken)
    rows = by_entity(run(spark, home, origin))
    assert (rows["silver", "*"].status, rows["silver", "*"].error) == ("FAILED", "no reason")
    assert rows["gold", "*"].status == "SKIPPED"


def test_intermediate_tables_are_gone_after_a_run(spark, home, origin, tmp_path):
    from pathlib import Path

    from lakeconform.sources.lake import stage_path

    other = Lake(str(tmp_path / "other"))
    assert stage_path(spark, home, "b1") != stage_path(spark, other, "b1")
    run(spark, home, origin, stages=["bronze", "silver"], batch_id="b1", keep_stage=True)
    assert Path(stage_path(spark, home, "b1")).exists()
    run(spark, home, origin, stages=["silver"], batch_id="b1")
    assert not Path(stage_path(spark, home, "b1")).exists()

"""The run: bronze, silver and gold stages, their metrics, gates and manifest."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from functools import cache

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeconform.operators.attribution import attribution_summary
from lakeconform.operators.dedup import duplicates, keep_first
from lakeconform.operators.identity import collisions_of, people_of, person_candidates
from lakeconform.operators.quality import (
    VIOLATIONS,
    SchemaDriftError,
    check_required,
    mark_rejected,
    outcome_totals,
    violations,
    with_reason,
)
from lakeconform.plans import marts
from lakeconform.plans.contracts import contracts, get_contract
from lakeconform.plans.entities import (
    DEDUP_ORDER,
    NORMALIZERS,
    check_raw,
    normalize_achievements,
)
from lakeconform.plans.gates import gate_findings, stage_metrics, write_manifest
from lakeconform.plans.refresh import run_refresh
from lakeconform.settings import Settings
from lakeconform.sources.files import stringify_all
from lakeconform.sources.lake import (
    Lake,
    count_written,
    forget_marks,
    read_bronze,
    read_gold,
    read_silver,
    remove_stage,
    settle,
    snapshot_dates,
    stamp_bronze,
    stamp_gold,
    stamp_silver,
    write_bronze,
    write_dataset,
    write_quarantine,
)
from lakeconform.sources.registry import (
    Origin,
    Source,
    conformed_name,
    get_source,
    read_source,
    seed_staging,
    select_sources,
)

log = logging.getLogger(__name__)

STAGES = ("bronze", "silver", "gold")
SILVER_ORDER = (
    "locations",
    "organizations",
    "employees",
    "contractors",
    "dim_person",
    "teams",
    "team_membership",
    "achievements",
)
GOLD_DATASETS = (
    "team_members",
    "team_locations",
    "monthly_team_achievements",
    "leader_not_colocated",
    "leader_non_direct_staff",
    "staff_ratio_analysis",
    "organization_reporting_summary",
    "employee_summary",
    "business_answers",
)


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_batch_id() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")


@dataclass
class Run:
    """What every step needs to know."""

    spark: SparkSession
    lake: Lake
    settings: Settings = field(default_factory=Settings)
    batch_id: str = field(default_factory=new_batch_id)
    ingest_date: str = field(default_factory=lambda: date.today().isoformat())
    dry_run: bool = False


def _measured(
    run: Run, layer: str, entity: str, step: Callable[[dict], None], **preset
) -> dict:
    """Run one step and return its metric row. A failure stays inside the row."""
    row = {
        "batch_id": run.batch_id,
        "ingest_date": run.ingest_date,
        "layer": layer,
        "entity": entity,
        "source_path": "",
        "target_path": "",
        "rows_read": 0,
        "rows_valid": 0,
        "rows_quarantined": 0,
        "rows_written": 0,
        "status": "SUCCESS",
        "is_aggregate": False,
        "started_at": _now(),
        **preset,
    }
    notes: dict = {}
    row["notes"] = notes
    try:
        step(row)
    except Exception as error:  # noqa: BLE001 - one entity must not take the others along
        log.exception("%s %s failed", layer, entity)
        row |= {"status": "FAILED", "error": str(error) or type(error).__name__}
    row["ended_at"] = _now()
    row["duration_s"] = round((row["ended_at"] - row["started_at"]).total_seconds(), 3)
    accounted = row["rows_written"] + row["rows_quarantined"]
    if row["status"] == "SUCCESS" and not row["is_aggregate"] and accounted != row["rows_read"]:
        row["status"] = "PARTIAL"
        row["error"] = f"{row['rows_read']} rows read, {accounted} accounted for"
    row["notes"] = json.dumps(notes, sort_keys=True, default=str)
    return row


def _not_built(
    run: Run, layer: str, entity: str, why: str, status: str = "SKIPPED"
) -> dict:
    """The metric row of something that did not run."""
    return _measured(run, layer, entity, lambda row: row.update(status=status, error=why))


# Bronze


def ingest(run: Run, source: Source, origin: Origin) -> dict:
    """One source to bronze: text columns, lineage stamps, one date partition.

    The source is read once. Rows read are counted while they are written, rows written from
    the files afterwards, so the two figures are independent.
    """

    def step(row: dict) -> None:
        raw, path = read_source(run.spark, source, origin)
        row["source_path"] = path
        row["notes"] |= {"route": source.route, "business_key": list(source.key)}
        if run.dry_run:
            row["rows_read"] = row["rows_valid"] = row["rows_written"] = raw.count()
            return
        seen = Observation()
        raw = raw.observe(seen, F.count(F.lit(1)).alias("rows"))
        stamped = stamp_bronze(
            stringify_all(raw), source.system, source.entity, path, source.route, run.batch_id
        )
        row["target_path"] = write_bronze(stamped, run.lake, source, run.ingest_date)
        row["rows_read"] = row["rows_valid"] = seen.get["rows"]
        row["rows_written"] = count_written(run.spark, row["target_path"])

    return _measured(run, "bronze", source.entity, step)


def run_bronze(
    run: Run,
    origin: Origin,
    entities: Iterable[str] | None = None,
    route: str | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> list[dict]:
    """Every wanted source. Empty staging tables are filled from their exports first; if that
    fails, the sources read from them fail one by one and the others go on."""
    sources = select_sources(entities, route, options)
    if origin.jdbc_url is not None and not run.dry_run:
        try:
            seed_staging(run.spark, sources, origin)
        except Exception:  # noqa: BLE001
            log.exception("staging tables could not be filled")
    return [ingest(run, source, origin) for source in sources]


# Silver


def bronze_snapshot(run: Run, entity: str) -> DataFrame:
    """The run's own ingest date if it was loaded, else the newest one, by folder names."""
    source = get_source(entity)
    dates = snapshot_dates(run.spark, run.lake, source)
    day = run.ingest_date if run.ingest_date in dates or not dates else dates[-1]
    if day != run.ingest_date:
        log.warning("%s has no ingest date %s; taking %s", entity, run.ingest_date, day)
    return read_bronze(run.spark, run.lake, source, day).drop("ingest_date")


def _normalized(run: Run, entity: str, raw: DataFrame) -> DataFrame:
    if entity != "achievements":
        return NORMALIZERS[entity](raw, run.settings)
    memberships = read_silver(run.spark, run.lake, "team_membership")
    teams = read_silver(run.spark, run.lake, "teams")
    return normalize_achievements(raw, memberships, teams, run.settings)


def refine(run: Run, entity: str) -> dict:
    """One entity from bronze to silver and quarantine.

    The parsed and annotated rows are written once to the shared folder; counts, silver and
    quarantine are then made from that table. Duplicates are looked for a second time only
    if the written rows show that there are any.
    """
    source = get_source(entity)
    contract = get_contract(entity, run.settings)

    def step(row: dict) -> None:
        notes = row["notes"]
        notes["business_key"] = list(contract.key)
        raw = bronze_snapshot(run, entity)
        try:
            check_raw(raw, entity)
        except SchemaDriftError as drift:
            _quarantine_whole(run, row, raw, entity, str(drift))
            return
        normalized = _normalized(run, entity, raw)
        check_required(normalized, contract)
        annotated = normalized.withColumn(VIOLATIONS, violations(contract.errors))
        if not run.dry_run:
            annotated = settle(annotated, run.lake, f"silver/{entity}", run.batch_id)

        totals = outcome_totals(annotated, contract).first().asDict()
        row["rows_read"], row["rows_valid"] = totals["rows_in"], totals["rows_valid"]
        notes["rule_failures"] = {r.name: totals[r.name] for r in contract.errors if totals[r.name]}
        notes["warnings"] = {r.name: totals[r.name] for r in contract.warnings if totals[r.name]}
        if entity == "achievements":
            notes["attribution"] = attribution_summary(annotated).first().asDict()

        valid = annotated.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS)
        kept = stamp_silver(
            keep_first(valid, contract.key, DEDUP_ORDER[entity]), entity, source.system
        )
        if run.dry_run:
            row["rows_written"] = kept.count()
            row["rows_quarantined"] = row["rows_read"] - row["rows_written"]
            return
        row["target_path"] = run.lake.silver(entity)
        write_dataset(kept, row["target_path"])
        row["rows_written"] = count_written(run.spark, row["target_path"])

        rejected = with_reason(annotated)
        if row["rows_written"] < row["rows_valid"]:
            dropped = duplicates(valid, contract.key, DEDUP_ORDER[entity])
            rejected = rejected.unionByName(dropped, allowMissingColumns=True)
        elif row["rows_valid"] == row["rows_read"]:
            return
        row["rows_quarantined"] = write_quarantine(
            stamp_silver(rejected, entity, source.system), run.lake, "silver", entity, run.batch_id
        )

    return _measured(run, "silver", entity, step, source_path=run.lake.bronze(source))


def _quarantine_whole(run: Run, row: dict, df: DataFrame, entity: str, problem: str) -> None:
    """A feed that lost a required column goes to quarantine as it is."""
    row["rows_read"] = df.count()
    if run.dry_run:
        row["rows_quarantined"] = row["rows_read"]
    else:
        rejected = mark_rejected(df, "schema_drift")
        row["rows_quarantined"] = write_quarantine(
            rejected, run.lake, "silver", entity, run.batch_id
        )
    row |= {"status": "FAILED", "error": f"schema drift: {problem}"}


def build_people(run: Run) -> dict:
    """The person dimension from the two silver people entities."""

    def step(row: dict) -> None:
        combined = person_candidates(
            read_silver(run.spark, run.lake, "employees"),
            read_silver(run.spark, run.lake, "contractors"),
        )
        row["rows_read"] = row["rows_valid"] = combined.count()
        row["notes"]["precedence"] = "direct first, then active, then lowest id"
        people = stamp_silver(people_of(combined), "dim_person")
        if run.dry_run:
            row["rows_written"] = people.count()
            row["rows_quarantined"] = row["rows_read"] - row["rows_written"]
            return
        row["target_path"] = run.lake.silver("dim_person")
        write_dataset(people, row["target_path"])
        row["rows_written"] = count_written(run.spark, row["target_path"])
        if row["rows_written"] < row["rows_read"]:
            row["rows_quarantined"] = write_quarantine(
                collisions_of(combined), run.lake, "silver", "dim_person", run.batch_id
            )

    return _measured(run, "silver", "dim_person", step)


def run_silver(run: Run, entities: Iterable[str] | None = None) -> list[dict]:
    """The wanted entities in dependency order; the person dimension is always rebuilt."""
    wanted = {conformed_name(source.entity) for source in select_sources(entities)}
    rows = []
    for name in SILVER_ORDER:
        if name == "dim_person":
            rows.append(build_people(run))
        elif name in wanted:
            rows.append(refine(run, name))
    return rows


# Gold


def publish(
    run: Run,
    dataset: str,
    build: Callable[[], DataFrame],
    read: Callable[[], int] | None = None,
    is_aggregate: bool = False,
) -> dict:
    """Build one dataset and replace its gold table."""

    def step(row: dict) -> None:
        df = stamp_gold(build(), run.batch_id)
        if run.dry_run:
            row["rows_written"] = df.count()
        else:
            row["target_path"] = run.lake.gold(dataset)
            write_dataset(df, row["target_path"])
            row["rows_written"] = count_written(run.spark, row["target_path"])
        row["rows_valid"] = row["rows_written"]
        row["rows_read"] = read() if read else row["rows_written"]

    return _measured(run, "gold", dataset, step, is_aggregate=is_aggregate)


def run_gold(run: Run) -> list[dict]:
    """The roster first, since others build on it; the answers last, from the tables written."""
    silver = lambda name: read_silver(run.spark, run.lake, name)
    count = lambda name: lambda: silver(name).count()

    def roster() -> DataFrame:
        return marts.team_members(
            silver("team_membership"), silver("dim_person"), silver("teams"), silver("locations")
        )

    rows = [publish(run, "team_members", roster, count("team_membership"))]
    if rows[0]["status"] == "FAILED":
        return rows + [
            _not_built(run, "gold", name, "the roster failed") for name in GOLD_DATASETS[1:]
        ]
    # In a dry run nothing was written, so the roster is a plan and not a table.
    members = roster() if run.dry_run else read_gold(run.spark, run.lake, "team_members")

    @cache
    def spread() -> DataFrame:
        """Where the members of each team are, for the two datasets that ask."""
        df = marts.member_spread(members)
        return df if run.dry_run else settle(df, run.lake, "gold/member_spread", run.batch_id)

    threshold = run.settings.ratio_threshold
    built = {
        "team_locations": (
            lambda: marts.team_locations(silver("teams"), silver("locations"), members, spread()),
            count("teams"),
            False,
        ),
        "monthly_team_achievements": (
            lambda: marts.monthly_achievements(silver("achievements"), silver("teams")),
            count("achievements"),
            True,
        ),
        "leader_not_colocated": (
            lambda: marts.leader_colocation(
                silver("teams"), silver("dim_person"), silver("locations"), members, spread()
            ),
            count("teams"),
            False,
        ),
        "leader_non_direct_staff": (
            lambda: marts.leader_staff_type(silver("teams"), silver("dim_person")),
            count("teams"),
            False,
        ),
        "staff_ratio_analysis": (
            lambda: marts.staff_ratio(members, threshold),
            members.count,
            True,
        ),
        "organization_reporting_summary": (
            lambda: marts.org_reporting(silver("teams"), silver("organizations")),
            count("teams"),
            True,
        ),
        "employee_summary": (
            lambda: marts.workforce_summary(silver("dim_person"), silver("locations")),
            count("dim_person"),
            True,
        ),
    }
    for dataset, (build, read, is_aggregate) in built.items():
        rows.append(publish(run, dataset, build, read, is_aggregate))
    if any(row["status"] == "FAILED" for row in rows):
        return [*rows, _not_built(run, "gold", "business_answers", "a dataset failed")]

    def answers() -> DataFrame:
        if run.dry_run:
            gold = {"team_members": members} | {name: built[name][0]() for name in built}
        else:
            gold = {name: read_gold(run.spark, run.lake, name) for name in GOLD_DATASETS[:-1]}
        return marts.business_answers(gold, threshold)

    rows.append(publish(run, "business_answers", answers))
    return rows


# Run


@dataclass(frozen=True)
class RunReport:
    metrics: DataFrame
    findings: list[tuple[str, str, str]]

    @property
    def passed(self) -> bool:
        return not self.findings


def run_pipeline(
    spark: SparkSession,
    lake: Lake,
    origin: Origin | None = None,
    settings: Settings | None = None,
    stages: Sequence[str] = STAGES,
    entities: Iterable[str] | None = None,
    dry_run: bool = False,
    continue_on_error: bool = False,
    batch_id: str | None = None,
    ingest_date: str | None = None,
    route: str | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
    keep_stage: bool = False,
    incremental: bool = False,
    buckets: int = 64,
) -> RunReport:
    """Run the wanted stages in order, write the manifest and apply the gates.

    Unknown stages and entities are errors before anything runs. A failed entity fails the
    gates but does not hold up the others; a stage in which everything failed ends the run
    unless ``continue_on_error`` is set. What was then not built has a row ``SKIPPED``; a stage
    that breaks off has a row ``FAILED`` for ``*``. The run's intermediate tables are deleted at
    its end unless ``keep_stage`` is set.

    With ``incremental`` only what is new since the kept watermarks is loaded and merged
    (``plans.refresh``): all stages and entities, published together or not at all. The first
    such run loads everything and lays the tables in ``buckets``; a full run forgets the marks.
    """
    unknown = set(stages) - set(STAGES)
    if unknown:
        raise KeyError(f"unknown stages {sorted(unknown)}; known: {list(STAGES)}")
    # No entities means all of them, as None does.
    entities = list(entities or []) or None
    select_sources(entities, route, options)
    if "bronze" in stages and origin is None:
        raise ValueError("the bronze stage needs an origin")
    if incremental and (dry_run or entities or set(stages) != set(STAGES)):
        raise ValueError("an incremental run takes all stages and entities, and is never dry")
    run = Run(
        spark,
        lake,
        settings or Settings(),
        batch_id or new_batch_id(),
        ingest_date or date.today().isoformat(),
        dry_run,
    )
    steps: dict[str, Callable[[], list[dict]]] = {
        "bronze": lambda: run_bronze(run, origin, entities, route, options),
        "silver": lambda: run_silver(run, entities),
        "gold": lambda: run_gold(run),
    }
    rows: list[dict] = []
    ended = False
    try:
        if incremental:
            rows += run_refresh(run, origin, _measured, SILVER_ORDER, route, options, buckets)
        elif not dry_run and "silver" in stages:
            forget_marks(spark, lake)
        for stage in (name for name in STAGES if name in stages and not incremental):
            if ended:
                rows.append(_not_built(run, stage, "*", "an earlier stage failed"))
                continue
            try:
                done = steps[stage]()
            except Exception as error:  # noqa: BLE001 - the manifest must still be written
                log.exception("%s broke off", stage)
                done = [_not_built(run, stage, "*", str(error) or type(error).__name__, "FAILED")]
            rows += done
            failed = bool(done) and all(row["status"] in ("FAILED", "SKIPPED") for row in done)
            ended = failed and not continue_on_error
    finally:
        if not dry_run and not keep_stage:
            remove_stage(spark, lake, run.batch_id)

    local = (spark.conf.get("spark.master", "") or "").startswith("local")
    metrics = stage_metrics(spark, rows, is_local=local)
    if not dry_run:
        write_manifest(metrics, lake.manifest())
    tolerances = {c.entity: c.tolerance for c in contracts(run.settings).values() if c.tolerance}
    found = gate_findings(
        metrics,
        tolerances,
        run.settings.quarantine_tolerance,
        # Nothing new is no failure.
        run.settings.fail_on_zero_rows and not incremental,
    ).collect()
    return RunReport(metrics, sorted(tuple(f) for f in found))

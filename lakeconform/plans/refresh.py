"""An incremental run: only rows after the watermark are loaded, merged and rolled up again.

Every source keeps a mark, the highest watermark loaded. A run takes the rows of the export that
lie after it (and those at the mark, or without a readable watermark, that were not there the
last time), conforms them, and merges them by business key into the silver tables. What the merge
has changed decides which people, attributions, and groups of the gold tables are made anew; all
other rows stay as they lie. Tables, quarantine, raw changes and marks are published together, so
a run that ends early leaves everything, the marks too, as it was.

The result equals that of a full run over all rows loaded so far. Rows are added and corrected,
never withdrawn: a row that has left the export stays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeconform.functions import parse_date, parse_month
from lakeconform.operators.attribution import attribute_unique, attribution_summary
from lakeconform.operators.dedup import duplicates, keep_first, surplus_rows
from lakeconform.operators.identity import PERSON_COLLISION, PERSON_ORDER, people_of, person_candidates
from lakeconform.operators.merge import changed_rows, matching, merge_first, new_since, next_edge, unmatched
from lakeconform.operators.quality import (
    VIOLATIONS,
    mark_rejected,
    outcome_totals,
    violations,
    with_reason,
)
from lakeconform.plans import marts
from lakeconform.plans.contracts import get_contract
from lakeconform.plans.entities import DEDUP_ORDER, NORMALIZERS, RAW_COLUMNS, achievement_facts, check_raw
from lakeconform.sources.files import stringify_all
from lakeconform.sources.lake import business_columns, settle, stamp_bronze, stamp_gold, stamp_silver
from lakeconform.sources.registry import Origin, Source, conformed_name, get_source, read_source, select_sources
from lakeconform.sources.transaction import Transaction, read_table, recover

MARKS = "entity string, mark date, buckets int"
WITHDRAWN = "attribution_withdrawn"


def watermark_of(source: Source, date_formats: Sequence[str], month_formats: Sequence[str]) -> Column:
    """The parsed watermark of a raw row; null for all rows of a source that has none."""
    if source.watermark is None:
        return F.lit(None).cast("date")
    if source.watermark == "month":
        return parse_month(source.watermark, month_formats)
    return parse_date(source.watermark, date_formats)


@dataclass
class Refresh:
    """One incremental run over one lake."""

    run: object
    tx: Transaction
    marks: dict[str, object]
    changes: dict[str, DataFrame] = field(default_factory=dict)
    steps: int = 0

    def settled(self, df: DataFrame, name: str) -> DataFrame:
        self.steps += 1
        return settle(df, self.run.lake, f"refresh/{self.steps}-{name}", self.run.batch_id)

    def silver(self, entity: str) -> DataFrame:
        return self.tx.latest(self.run.lake.silver(entity))

    def gold(self, dataset: str) -> DataFrame:
        return self.tx.latest(self.run.lake.gold(dataset))

    def old(self, target: str, like: DataFrame) -> DataFrame:
        """The published table, or none of the rows of a frame like it."""
        found = self.tx.current(target)
        return like.limit(0) if found is None else found

    # Raw rows

    def load(self, source: Source, origin: Origin, row: dict) -> None:
        """The new rows of one export, staged as the run's changes, and the next mark."""
        run, entity = self.run, conformed_name(source.entity)
        raw, path = read_source(run.spark, source, origin)
        row["source_path"] = path
        check_raw(raw, entity)
        columns = list(RAW_COLUMNS[entity])
        text = stringify_all(raw)
        if entity == "achievements":
            columns.append("team_id")
            if "team_id" not in raw.columns:
                text = text.withColumn("team_id", F.lit(None).cast("string"))
        value = watermark_of(source, run.settings.date_formats, run.settings.month_formats)
        old = self.marks.get(source.entity)
        mark = F.lit(old).cast("date")
        seen = None if self.tx.first_load else read_table(run.spark, run.lake.edge(source))
        if seen is None:
            new = text.select(*columns, value.alias("_value"))
            seen = new.limit(0)
        else:
            new = new_since(text, value, mark, seen, columns)
        stamped = stamp_bronze(new, source.system, source.entity, path, source.route, run.batch_id)
        target = run.lake.changes(source, run.batch_id)
        self.tx.stage_whole(target, stamped)
        new = self.tx.staged(target)
        found = new.agg(F.count("*"), F.max("_value")).first()
        row["rows_read"] = row["rows_valid"] = row["rows_written"] = found[0]
        row["target_path"] = target
        row["notes"] |= {"mark": str(old), "watermark": source.watermark}
        if found[0]:
            latest = max([d for d in (old, found[1]) if d is not None], default=None)
            edge = next_edge(new.select(*columns, "_value"), seen, F.lit(latest).cast("date"))
            self.tx.stage_whole(run.lake.edge(source), edge)
            self.marks[source.entity] = latest
            row["notes"]["next_mark"] = str(latest)

    def new_rows(self, entity: str) -> DataFrame:
        source = get_source(entity)
        return self.tx.staged(self.run.lake.changes(source, self.run.batch_id)).drop("_value")

    # Silver

    def merge(self, entity: str, row: dict) -> None:
        """Conform an entity's new rows and merge them into its silver table."""
        source, contract = get_source(entity), get_contract(entity, self.run.settings)
        raw = self.new_rows(entity)
        if not self.tx.first_load and raw.isEmpty():
            return
        normalized = NORMALIZERS[entity](raw, self.run.settings)
        checked = self.checked(normalized, entity, row)
        valid = stamp_silver(checked.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), entity, source.system)
        target, names = self.run.lake.silver(entity), iter(("before", "pool"))
        merged = merge_first(
            self.old(target, valid),
            valid,
            contract.key,
            DEDUP_ORDER[entity],
            lambda df: self.settled(df, f"{entity}-{next(names)}"),
        )
        after = self.settled(merged.after, f"{entity}-after")
        rejected = with_reason(checked).unionByName(merged.dropped, allowMissingColumns=True)
        self.finish(entity, row, merged.before, after, rejected, contract.key)
        row["rows_read"] = row["rows_read"] + row["notes"]["met"]

    def checked(self, normalized: DataFrame, entity: str, row: dict) -> DataFrame:
        contract = get_contract(entity, self.run.settings)
        checked = normalized.withColumn(VIOLATIONS, violations(contract.errors))
        checked = self.settled(checked, f"{entity}-checked")
        totals = outcome_totals(checked, contract).first().asDict()
        row["rows_read"], row["rows_valid"] = totals["rows_in"], totals["rows_valid"]
        row["notes"]["rule_failures"] = {r.name: totals[r.name] for r in contract.errors if totals[r.name]}
        row["notes"]["warnings"] = {r.name: totals[r.name] for r in contract.warnings if totals[r.name]}
        return checked

    def finish(
        self, entity: str, row: dict, before: DataFrame, after: DataFrame, rejected: DataFrame | None, keys: Sequence[str]
    ) -> None:
        """Stage a silver table and its quarantine, and note which rows are not what they were."""
        row["target_path"] = self.run.lake.silver(entity)
        self.tx.stage_keys(row["target_path"], after, before, keys, keys)
        differing = self.settled(changed_rows(before, after, business_columns(after)), f"{entity}-changed")
        self.changes[entity] = differing
        row["rows_written"], row["notes"]["met"] = after.count(), before.count()
        row["notes"]["changed_rows"] = differing.count()
        if rejected is not None:
            self.quarantine(entity, row, rejected)

    def quarantine(self, entity: str, row: dict, rejected: DataFrame) -> None:
        source = "derived" if entity == "dim_person" else get_source(entity).system
        kept = self.settled(stamp_silver(rejected, entity, source), f"{entity}-rejected")
        row["rows_quarantined"] = kept.count()
        if row["rows_quarantined"]:
            self.tx.stage_whole(self.run.lake.quarantine("silver", entity, self.run.batch_id), kept)

    def people(self, row: dict) -> None:
        """Settle the people anew whose address stands in a changed row."""
        touched = self.touched(("employees", "email"), ("contractors", "email"))
        if touched is None:
            return
        touched = touched.filter("email IS NOT NULL")
        everyone = person_candidates(self.silver("employees"), self.silver("contractors"))
        candidates = self.settled(matching(everyone, touched, ["email"]), "people-candidates")
        after = self.settled(stamp_silver(people_of(candidates), "dim_person"), "people-after")
        old = self.old(self.run.lake.silver("dim_person"), after)
        before = self.settled(matching(old, touched, ["email"]), "people-before")
        # Whoever lost an address before is in the quarantine of that run.
        lost = mark_rejected(surplus_rows(candidates, ["email"], PERSON_ORDER), PERSON_COLLISION)
        ids = [self.changes[e].select(F.col(c).alias("person_id")) for e, c in self._people_ids()]
        fresh = reduce(DataFrame.unionAll, [before.select("person_id"), *ids])
        row["is_aggregate"] = True
        row["rows_read"] = row["rows_valid"] = candidates.count()
        self.finish("dim_person", row, before, after, matching(lost, fresh, ["person_id"]), ["email"])

    def _people_ids(self) -> list[tuple[str, str]]:
        known = (("employees", "emp_id"), ("contractors", "contractor_id"))
        return [(entity, column) for entity, column in known if entity in self.changes]

    def achievements(self, row: dict) -> None:
        """Merge new facts, and attribute anew the old ones whose reporter's teams have changed."""
        run, contract = self.run, get_contract("achievements", self.run.settings)
        new = achievement_facts(self.new_rows("achievements"), run.settings).withColumn("_load", F.lit("new"))
        open_facts = read_table(run.spark, run.lake.open_facts()) if not self.tx.first_load else None
        touched = self._reporters()
        again = new.limit(0)
        if open_facts is not None and touched is not None:
            known = open_facts.drop("load").withColumn("_load", F.lit("again"))
            again = matching(known, touched, ["reported_by"]).select(*new.columns)
        again = self.settled(again, "facts-again")
        new = self.settled(new, "facts-new")
        if not self.tx.first_load and new.isEmpty() and again.isEmpty():
            return
        self.tx.stage_whole(
            f"{run.lake.open_facts()}/load={run.batch_id}", new.filter("source_team_id IS NULL").drop("_load")
        )
        attributed = attribute_unique(
            new.unionByName(again), self.silver("team_membership"), self.silver("teams")
        ).drop("source_team_id")
        checked = self.checked(attributed, "achievements", row)
        row["notes"]["attribution"] = attribution_summary(checked).first().asDict()
        system = get_source("achievements").system
        valid = stamp_silver(checked.filter(F.size(VIOLATIONS) == 0).drop(VIOLATIONS), "achievements", system)
        like = valid.drop("_load")
        target, keys = run.lake.silver("achievements"), list(contract.key)
        before = self.settled(matching(self.old(target, like), checked, keys), "facts-before")
        # Of a group that is attributed anew all facts are at hand, so its old winner steps back.
        stays = unmatched(before, again, keys).withColumn("_load", F.lit("again"))
        pool = self.settled(stays.unionByName(valid, allowMissingColumns=True), "facts-pool")
        after = self.settled(keep_first(pool, keys, DEDUP_ORDER["achievements"]).drop("_load"), "facts-after")
        lost = duplicates(pool, keys, DEDUP_ORDER["achievements"])
        rejected = with_reason(checked).filter("_load = 'new'").unionByName(
            lost.filter("_load = 'new'"), allowMissingColumns=True
        )
        withdrawn = mark_rejected(unmatched(before, after, keys), WITHDRAWN)
        row["is_aggregate"] = True
        row["notes"]["attributed_anew"] = again.count()
        self.finish(
            "achievements",
            row,
            before,
            after,
            rejected.drop("_load").unionByName(withdrawn, allowMissingColumns=True),
            keys,
        )

    def _reporters(self) -> DataFrame | None:
        """People whose memberships have changed, or whose teams have."""
        mine = self.touched(("team_membership", "employee_email"))
        parts = [] if mine is None else [mine.withColumnRenamed("employee_email", "reported_by")]
        teams = self.touched(("teams", "team_id"))
        if teams is not None:
            members = matching(self.silver("team_membership"), teams, ["team_id"])
            parts.append(members.select(F.col("employee_email").alias("reported_by")))
        return self._distinct(parts, "reporters")

    # What has changed

    def touched(self, *columns: tuple[str, str]) -> DataFrame | None:
        """Values, before and after, of a column in the changed rows; None if nothing changed."""
        parts = [
            self.changes[entity].select(F.col(column).alias(columns[0][1]))
            for entity, column in columns
            if entity in self.changes
        ]
        return self._distinct(parts, columns[0][1])

    def _distinct(self, parts: list[DataFrame], name: str) -> DataFrame | None:
        if not parts:
            return None
        found = self.settled(reduce(DataFrame.unionAll, parts).distinct(), f"touched-{name}")
        return None if found.isEmpty() else found

    # Gold

    def roll_up(self, measured: Callable) -> list[dict]:
        """Make the touched groups of every gold dataset anew."""
        silver, first = self.silver, self.tx.first_load
        places = self.touched(("locations", "location_code"))
        emails = self._distinct(
            [df.select("email") for df in (self.changes.get("dim_person"), self._at(places)) if df is not None], "emails"
        )
        teams = self._teams(places, emails)
        facts = self._distinct(
            [self.changes[e].select("team_id") for e in ("achievements", "teams") if e in self.changes], "fact-teams"
        )
        orgs = self.touched(("teams", "org_id"), ("organizations", "org_id"))
        homes = self.touched(("dim_person", "location_code"), ("locations", "location_code"))

        def part(entity: str, touched: DataFrame | None, key: str) -> DataFrame:
            return silver(entity) if first or touched is None else matching(silver(entity), touched, [key])

        def members() -> DataFrame:
            return self.gold("team_members") if first else matching(self.gold("team_members"), teams, ["team_id"])

        threshold = self.run.settings.ratio_threshold
        built = (
            ("team_members", "team_id", teams, lambda: marts.team_members(
                part("team_membership", teams, "team_id"), silver("dim_person"), silver("teams"), silver("locations"))),
            ("team_locations", "team_id", teams, lambda: marts.team_locations(
                part("teams", teams, "team_id"), silver("locations"), members())),
            ("monthly_team_achievements", "team_id", facts, lambda: marts.monthly_achievements(
                part("achievements", facts, "team_id"), silver("teams"))),
            ("leader_not_colocated", "team_id", teams, lambda: marts.leader_colocation(
                part("teams", teams, "team_id"), silver("dim_person"), silver("locations"), members())),
            ("leader_non_direct_staff", "team_id", teams, lambda: marts.leader_staff_type(
                part("teams", teams, "team_id"), silver("dim_person"))),
            ("staff_ratio_analysis", "team_id", teams, lambda: marts.staff_ratio(members(), threshold)),
            ("organization_reporting_summary", "org_id", orgs, lambda: marts.org_reporting(
                part("teams", orgs, "org_id"), silver("organizations"))),
            ("employee_summary", "location_code", homes, lambda: marts.workforce_summary(
                part("dim_person", homes, "location_code"), silver("locations"))),
        )
        rows = [measured("gold", name, self._publish(name, key, touched, build)) for name, key, touched, build in built]

        def answers() -> DataFrame:
            return marts.business_answers({name: self.gold(name) for name, *_ in built}, threshold)

        if any(row["rows_read"] for row in rows):
            rows.append(measured("gold", "business_answers", self._publish("business_answers", "question_id", None, answers)))
        return rows

    def _publish(
        self, dataset: str, key: str, touched: DataFrame | None, build: Callable[[], DataFrame]
    ) -> Callable[[dict], None]:
        def step(row: dict) -> None:
            row["is_aggregate"] = True
            if touched is None and not self.tx.first_load and dataset != "business_answers":
                return
            row["target_path"] = self.run.lake.gold(dataset)
            after = self.settled(stamp_gold(build(), self.run.batch_id), dataset)
            self.tx.stage_keys(row["target_path"], after, touched, [key], [key])
            row["rows_written"] = row["rows_valid"] = after.count()
            row["rows_read"] = max(1, row["rows_written"])
            if touched is not None:
                row["notes"]["touched_groups"] = touched.count()

        return step

    def _at(self, places: DataFrame | None) -> DataFrame | None:
        """People at changed locations."""
        return None if places is None else matching(self.silver("dim_person"), places, ["location_code"])

    def _teams(self, places: DataFrame | None, emails: DataFrame | None) -> DataFrame | None:
        """Teams with a changed row, or with a member, leader or office that has changed."""
        parts = [self.changes[e].select("team_id") for e in ("team_membership", "teams") if e in self.changes]
        if emails is not None:
            for entity, column in (("team_membership", "employee_email"), ("teams", "team_leader_email")):
                mine = emails.withColumnRenamed("email", column)
                parts.append(matching(self.silver(entity), mine, [column]).select("team_id"))
        if places is not None:
            offices = places.withColumnRenamed("location_code", "primary_office")
            parts.append(matching(self.silver("teams"), offices, ["primary_office"]).select("team_id"))
        return self._distinct(parts, "teams")


def read_marks(run) -> tuple[dict[str, object], int | None]:
    """The marks of the last run that was published, and its number of buckets."""
    found = read_table(run.spark, run.lake.marks())
    if found is None:
        return {}, None
    rows = found.collect()
    return {r["entity"]: r["mark"] for r in rows}, rows[0]["buckets"]


def run_refresh(
    run,
    origin: Origin,
    measured: Callable,
    silver_order: Iterable[str],
    route: str | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
    buckets: int = 64,
) -> list[dict]:
    """All stages of an incremental run; publishes only if nothing has failed."""
    recover(run.spark, run.lake)
    marks, known_buckets = read_marks(run)
    tx = Transaction(run.spark, run.lake, run.batch_id, known_buckets or buckets, first_load=known_buckets is None)
    work = Refresh(run, tx, marks)

    def step(layer: str, entity: str, do: Callable[[dict], None]) -> dict:
        return measured(run, layer, entity, do)

    rows = [
        step("bronze", s.entity, lambda row, s=s: work.load(s, origin, row)) for s in select_sources(None, route, options)
    ]
    if _failed(rows):
        return _dropped(tx, rows)
    special = {"dim_person": work.people, "achievements": work.achievements}
    for entity in silver_order:
        do = special.get(entity) or (lambda row, entity=entity: work.merge(entity, row))
        rows.append(step("silver", entity, do))
        if _failed(rows):
            return _dropped(tx, rows)
    rows += work.roll_up(step)
    if not _failed(rows) and any(r["rows_read"] for r in rows if r["layer"] == "bronze"):
        state = [(entity, mark, tx.buckets) for entity, mark in sorted(work.marks.items())]
        tx.stage_whole(run.lake.marks(), run.spark.createDataFrame(state, MARKS).coalesce(1))
        tx.publish()
    else:
        tx.drop()
    return rows


def _dropped(tx: Transaction, rows: list[dict]) -> list[dict]:
    tx.drop()
    return rows


def _failed(rows: list[dict]) -> bool:
    return any(row["status"] == "FAILED" for row in rows)


"""Where each source entity comes from, as data."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from lakeconform.sources.files import read_file
from lakeconform.sources.jdbc import read_jdbc, seed_if_empty


@dataclass(frozen=True)
class Source:
    """One entity of one source system and the route it is read by."""

    system: str
    entity: str
    file_name: str
    file_format: str
    route: str
    key: tuple[str, ...]
    watermark: str | None = None
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.system}.{self.entity}"


# The seven registered exports.
SOURCES = (
    Source(
        "employee_directory", "employees", "employees.csv", "csv", "jdbc",
        ("emp_id",), "hire_date",
    ),
    Source(
        "vendor_management", "contractor_roster", "contractor_roster.csv", "csv", "jdbc",
        ("contractor_id",), "start_date",
    ),
    Source(
        "facilities", "locations", "locations.csv", "csv", "jdbc",
        ("location_code",),
    ),
    Source(
        "org_structure", "organizations", "organizations.json", "json", "file",
        ("org_id",),
    ),
    Source(
        "project_tracking", "teams", "teams.json", "json", "file",
        ("team_id",), "formed_date",
    ),
    Source(
        "project_tracking", "team_membership", "team_membership.csv", "csv", "file",
        ("team_code", "employee_email", "start_date"), "start_date",
    ),
    Source(
        "performance_management", "monthly_achievements", "monthly_achievements.json", "json",
        "file", ("achievement_sk",), "month",
    ),
)

# Conformed entities whose source export has another name.
CONFORMED_NAMES = {"contractor_roster": "contractors", "monthly_achievements": "achievements"}


def conformed_name(source_entity: str) -> str:
    return CONFORMED_NAMES.get(source_entity, source_entity)


def get_source(entity: str) -> Source:
    """Find a source by its own name or by the conformed entity's name."""
    for source in SOURCES:
        if entity in (source.entity, conformed_name(source.entity)):
            return source
    known = sorted(source.entity for source in SOURCES)
    raise KeyError(f"unknown source entity {entity!r}; known: {known}")


def select_sources(
    entities: Iterable[str] | None = None,
    route: str | None = None,
    options: Mapping[str, Mapping[str, object]] | None = None,
) -> tuple[Source, ...]:
    """The wanted sources in registered order, all by default.

    ``route`` overrides theirs. ``options`` holds reader options by format (``csv``, ``json``)
    or by source entity, so that those of one format never reach the readers of another; those
    of an entity win.
    """
    options = options or {}
    known = {s.file_format for s in SOURCES} | {s.entity for s in SOURCES}
    if unknown := set(options) - known:
        raise KeyError(f"options for unknown formats or sources {sorted(unknown)}")
    wanted = None if entities is None else {get_source(name).entity for name in entities}
    return tuple(
        replace(
            s,
            route=route or s.route,
            options={**s.options, **options.get(s.file_format, {}), **options.get(s.entity, {})},
        )
        for s in SOURCES
        if wanted is None or s.entity in wanted
    )


@dataclass(frozen=True)
class Origin:
    """Where exports lie (``raw_root``) and how to reach the staging tables.

    ``jdbc_ranges`` gives ``(column, (low, high), partitions)`` per entity. A table without
    one would be read whole by one task; that has to be asked for with ``single_connection``.
    """

    raw_root: str
    jdbc_url: str | None = None
    jdbc_schema: str = "staging"
    jdbc_properties: Mapping[str, str] = field(default_factory=dict)
    jdbc_ranges: Mapping[str, tuple[str, tuple, int]] = field(default_factory=dict)
    single_connection: bool = False

    def file_path(self, source: Source) -> str:
        return f"{self.raw_root}/{source.system}/{source.file_name}"

    def table(self, source: Source) -> str:
        return f"{self.jdbc_schema}.{source.entity}"


def _from_file(spark: SparkSession, source: Source, origin: Origin) -> tuple[DataFrame, str]:
    path = origin.file_path(source)
    return read_file(spark, path, source.file_format, **source.options), path


def _from_jdbc(spark: SparkSession, source: Source, origin: Origin) -> tuple[DataFrame, str]:
    table, ranges = origin.table(source), origin.jdbc_ranges.get(source.entity, ())
    url = _jdbc_url(source, origin)
    if not ranges and not origin.single_connection:
        raise ValueError(f"{source.name} needs jdbc_ranges, or single_connection for one task")
    return read_jdbc(spark, url, table, *ranges, properties=origin.jdbc_properties), f"jdbc:{table}"


def _jdbc_url(source: Source, origin: Origin) -> str:
    if origin.jdbc_url is None:
        raise ValueError(f"{source.name} is read over JDBC but no URL is set")
    return origin.jdbc_url


READERS: dict[str, Callable[[SparkSession, Source, Origin], tuple[DataFrame, str]]] = {
    "file": _from_file,
    "jdbc": _from_jdbc,
}


def read_source(spark: SparkSession, source: Source, origin: Origin) -> tuple[DataFrame, str]:
    """The raw frame and the place it was read from."""
    if source.route not in READERS:
        raise ValueError(f"unknown route {source.route!r} for {source.name}")
    return READERS[source.route](spark, source, origin)


def seed_staging(
    spark: SparkSession, sources: Iterable[Source], origin: Origin, force: bool = False
) -> dict[str, int]:
    """Fill the staging tables of JDBC-routed sources from their exports, where empty.

    Returns rows written per entity; 0 where the table already had rows.
    """
    seeded = {}
    for source in sources:
        if source.route == "jdbc":
            url = _jdbc_url(source, origin)
            export, _ = _from_file(spark, source, origin)
            seeded[source.entity] = seed_if_empty(
                export, url, origin.table(source), force, origin.jdbc_properties
            )
    return seeded

"""Queries over time: new rows, refreshed tables, as-of look-ups, overlaps, islands, trends."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeconform.catalog import oracle as sql
from lakeconform.catalog.stage import staged
from lakeconform.functions import parse_date
from lakeconform.operators.differences import snapshot_difference
from lakeconform.operators.merge import Merged, changed_rows, matching, merge_first, new_since, replaced
from lakeconform.plans import histories, marts
from lakeconform.plans.contracts import get_contract
from lakeconform.plans.entities import DEDUP_ORDER, NORMALIZERS, RAW_COLUMNS, conform
from lakeconform.settings import Settings

MARK = "1997-06-02"
ENTITY = "team_membership"


class Loads:
    """Memberships that came in two loads, the second a third of the rows."""

    def __init__(self, frames, settings: Settings) -> None:
        self.frames, self.settings = frames, settings
        raw = frames.raw(ENTITY)
        later = F.pmod(F.xxhash64(*raw.columns), F.lit(3)) == 0
        first, second = (
            conform(ENTITY, NORMALIZERS[ENTITY](raw.filter(part), settings), settings) for part in (~later, later)
        )
        self.first, self.second = staged(first.kept), staged(second.outcome.valid)
        self.key = list(get_contract(ENTITY, settings).key)

    def merged(self) -> Merged:
        return merge_first(self.first, self.second, self.key, DEDUP_ORDER[ENTITY])

    def refreshed(self) -> DataFrame:
        merged = self.merged()
        return replaced(self.first, merged.after, self.second, self.key)

    def ratios(self) -> DataFrame:
        """The ratios of the first load, those of teams with a changed membership made anew."""
        f, merged = self.frames, self.merged()
        roster = lambda rows: marts.team_members(
            rows, f.silver("dim_person"), f.silver("teams"), f.silver("locations")
        )
        ratio = lambda rows: marts.staff_ratio(roster(rows), self.settings.ratio_threshold)
        columns = sql.SILVER_COLUMNS[ENTITY]
        touched = changed_rows(merged.before, merged.after, columns).select("team_id").distinct()
        anew = ratio(matching(self.refreshed(), touched, ["team_id"]))
        return replaced(ratio(self.first), anew, touched, ["team_id"])


def new_memberships(frames) -> DataFrame:
    """Rows of the export after the mark, and those at it that a first load had not seen."""
    columns = list(RAW_COLUMNS[ENTITY])
    mark = F.lit(MARK).cast("date")
    dated = staged(frames.raw(ENTITY).select(*columns, parse_date("start_date").alias("_value")))
    edge = dated.filter(F.coalesce(F.col("_value") == mark, F.lit(True)))
    found = new_since(dated, F.col("_value"), mark, edge.filter("role <> 'SME'"), columns)
    return found.withColumnRenamed("_value", "started")


def membership_changes(frames) -> DataFrame:
    """Yesterday's export against today's: rows have left, come, come again, and been corrected."""
    raw = frames.raw(ENTITY).filter("role = 'SME' OR role = 'Team Lead'")
    old = raw.filter("NOT (role = 'SME' AND allocation_pct = 'many')")
    new = raw.filter("NOT (role = 'SME' AND end_date = '')").withColumn(
        "allocation_pct", F.when(F.col("role") == "Team Lead", F.lit("100")).otherwise(F.col("allocation_pct"))
    )
    again = raw.filter("role = 'SME' AND allocation_pct = '9'")
    return snapshot_difference(old, new.unionByName(again), ["team_code", "employee_email", "start_date"])


_STARTED = sql.as_date("start_date")
_CHANGES_SQL = """
, raw AS (SELECT * FROM raw_team_membership WHERE role = 'SME' OR role = 'Team Lead'),
before AS (SELECT * FROM raw WHERE NOT (role = 'SME' AND allocation_pct = 'many')),
after AS (
  SELECT * REPLACE (CASE WHEN role = 'Team Lead' THEN '100' ELSE allocation_pct END AS allocation_pct)
  FROM raw WHERE NOT (role = 'SME' AND end_date = '')
  UNION ALL SELECT * FROM raw WHERE role = 'SME' AND allocation_pct = '9'
),
gone AS (SELECT * FROM before EXCEPT ALL SELECT * FROM after),
come AS (SELECT * FROM after EXCEPT ALL SELECT * FROM before),
old_keys AS (SELECT team_code, employee_email, start_date, count(*) AS n, max(role) AS role,
  max(allocation_pct) AS allocation_pct, max(end_date) AS end_date FROM gone GROUP BY 1, 2, 3),
new_keys AS (SELECT team_code, employee_email, start_date, count(*) AS n, max(role) AS role,
  max(allocation_pct) AS allocation_pct, max(end_date) AS end_date FROM come GROUP BY 1, 2, 3),
pairs AS (
  SELECT team_code, employee_email, start_date, o.n AS gone, w.n AS come, concat_ws(',',
    CASE WHEN o.role IS DISTINCT FROM w.role THEN 'role' END,
    CASE WHEN o.allocation_pct IS DISTINCT FROM w.allocation_pct THEN 'allocation_pct' END,
    CASE WHEN o.end_date IS DISTINCT FROM w.end_date THEN 'end_date' END) AS differing
  FROM old_keys o FULL JOIN new_keys w USING (team_code, employee_email, start_date)
)
SELECT team_code, employee_email, start_date, 'changed' AS change, CAST(1 AS BIGINT) AS copies,
  differing AS changed_columns FROM pairs WHERE gone = 1 AND come = 1
UNION ALL SELECT team_code, employee_email, start_date, 'deleted', gone, '' FROM pairs
  WHERE gone IS NOT NULL AND NOT coalesce(gone = 1 AND come = 1, false)
UNION ALL SELECT team_code, employee_email, start_date, 'inserted', come, '' FROM pairs
  WHERE come IS NOT NULL AND NOT coalesce(gone = 1 AND come = 1, false)
"""

_AS_OF_SQL = """
, held AS (
  SELECT employee_email, start_date, arg_max(role, r) AS role, arg_max(allocation_pct, r) AS allocation_pct,
    arg_max(team_id, r) AS team_id
  FROM (SELECT *, row_number() OVER (PARTITION BY employee_email, start_date
    ORDER BY role NULLS FIRST, allocation_pct NULLS FIRST, team_id NULLS FIRST) AS r
    FROM silver_team_membership WHERE start_date IS NOT NULL) m GROUP BY 1, 2
),
asked AS (
  SELECT achievement_sk, month_key, reported_by,
    CAST(last_day(strptime(month_key || '-01', '%Y-%m-%d')) AS DATE) AS month_end
  FROM silver_achievements
)
SELECT a.achievement_sk, a.month_key, a.reported_by, a.month_end, h.role AS role_then,
  h.allocation_pct AS allocation_then, h.team_id AS team_then, h.start_date AS since
FROM asked a ASOF LEFT JOIN held h ON a.reported_by = h.employee_email AND a.month_end >= h.start_date
"""

_LEADS_SQL = """
, leads AS (
  SELECT employee_email, team_id, start_date, coalesce(end_date, DATE '9999-12-31') AS until
  FROM silver_team_membership WHERE role = 'TEAM_LEAD' AND start_date IS NOT NULL
)
SELECT l.employee_email, l.team_id, l.start_date, r.team_id AS other_team_id,
  r.start_date AS other_start_date, greatest(l.start_date, r.start_date) AS overlap_start,
  least(l.until, r.until) AS overlap_end
FROM leads l JOIN leads r ON l.employee_email = r.employee_email AND l.team_id < r.team_id
  AND l.start_date <= r.until AND r.start_date <= l.until
  AND l.start_date <= l.until AND r.start_date <= r.until
"""

_SPANS_SQL = """
, held AS (
  SELECT employee_email, allocation_pct, start_date, coalesce(end_date, DATE '9999-12-31') AS until
  FROM silver_team_membership WHERE start_date IS NOT NULL AND allocation_pct IS NOT NULL
),
steps AS (
  SELECT employee_email, start_date AS day, allocation_pct AS step FROM held WHERE start_date <= until
  UNION ALL SELECT employee_email, CAST(until + INTERVAL 1 DAY AS DATE), -allocation_pct FROM held
  WHERE start_date <= until
),
days AS (SELECT employee_email, day, sum(step) AS step FROM steps GROUP BY 1, 2),
levels AS (
  SELECT employee_email, day, sum(step) OVER w AS load, lead(day) OVER w AS until
  FROM days WINDOW w AS (PARTITION BY employee_email ORDER BY day)
),
marked AS (
  SELECT *, (load > 100 AND until IS NOT NULL) AS above FROM levels
),
numbered AS (
  SELECT *, sum(CASE WHEN above AND NOT coalesce(prior, false) THEN 1 ELSE 0 END)
    OVER (PARTITION BY employee_email ORDER BY day) AS span
  FROM (SELECT *, lag(above) OVER (PARTITION BY employee_email ORDER BY day) AS prior FROM marked) m
)
SELECT employee_email, min(day) AS span_start, CAST(max(until) - INTERVAL 1 DAY AS DATE) AS span_end,
  CAST(max(load) AS DOUBLE) AS highest_load
FROM numbered WHERE above GROUP BY employee_email, span
"""


def _islands_sql(rows: str, key: str, gap: str, totals: str) -> str:
    """Gaps and islands over (key, s, e): one window for the end reached, one for the number."""
    return (
        f"reached AS (SELECT *, max(e) OVER (PARTITION BY {key} ORDER BY s, e ROWS BETWEEN UNBOUNDED "
        f"PRECEDING AND 1 PRECEDING) AS before FROM ({rows}) r), "
        f"numbered AS (SELECT *, sum(CASE WHEN before IS NULL OR s > before + {gap} THEN 1 ELSE 0 END) "
        f"OVER (PARTITION BY {key} ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM reached) "
        f"SELECT {key}, min(s) AS island_start, max(e) AS island_end, {totals} "
        f"FROM numbered GROUP BY {key}, island"
    )


_TENURES_SQL = ", " + _islands_sql(
    "SELECT employee_email, start_date AS s, coalesce(end_date, DATE '9999-12-31') AS e FROM "
    "silver_team_membership WHERE start_date <= coalesce(end_date, DATE '9999-12-31')",
    "employee_email",
    "1",
    "count(*) AS memberships",
)
_SESSIONS_SQL = "WITH " + _islands_sql(
    "SELECT user_id, ts AS s, ts AS e, value FROM events",
    "user_id",
    "INTERVAL 30 MINUTES",
    "count(*) AS n_events, round(sum(value), 4) AS total_value",
)
_TRENDS_SQL = """
, counts AS (
  SELECT team_id, CAST(strptime(month_key || '-01', '%Y-%m-%d') AS DATE) AS month,
    CAST(sum(achievement_count) AS BIGINT) AS n
  FROM gold_achievements WHERE month_key IS NOT NULL GROUP BY 1, 2
),
calendar AS (
  SELECT team_id, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month
  FROM counts GROUP BY 1
),
filled AS (
  SELECT team_id, month, coalesce(n, 0) AS n FROM calendar LEFT JOIN counts USING (team_id, month)
)
SELECT team_id, strftime(month, '%Y-%m') AS month_key, n AS achievements,
  round(avg(n) OVER (PARTITION BY team_id ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 4) AS recent_mean,
  n - lag(n) OVER (PARTITION BY team_id ORDER BY month) AS change
FROM filled
"""
_PLACE = "person_region, person_country, person_city, staff_type"


def register_all(register: Callable, settings: Settings) -> None:
    columns = ", ".join(sql.SILVER_COLUMNS[ENTITY])
    register(
        "watermark_delta",
        new_memberships,
        f"SELECT *, {_STARTED} AS started FROM raw_team_membership WHERE {_STARTED} > DATE '{MARK}' "
        f"OR (coalesce({_STARTED} = DATE '{MARK}', true) AND role = 'SME')",
    )
    register(
        "refreshed_team_membership",
        lambda f: Loads(f, settings).refreshed().select(*sql.SILVER_COLUMNS[ENTITY]),
        f"SELECT {columns} FROM silver_team_membership",
    )
    register("refreshed_staff_ratio", lambda f: Loads(f, settings).ratios(), "SELECT * FROM gold_ratios")
    register(
        "asof_reporter_roles",
        lambda f: histories.reporter_roles(f.settled("achievements"), f.settled(ENTITY)),
        _AS_OF_SQL,
    )
    register("concurrent_leads", lambda f: histories.concurrent_leads(f.settled(ENTITY)), _LEADS_SQL)
    register("overallocated_spans", lambda f: histories.overallocated_spans(f.settled(ENTITY)), _SPANS_SQL)
    register("tenures", lambda f: histories.tenures(f.settled(ENTITY)), _TENURES_SQL)
    register("event_sessions", lambda f: histories.sessions(f.table("events")), _SESSIONS_SQL)
    register("snapshot_difference", membership_changes, _CHANGES_SQL)
    register("team_trends", lambda f: histories.team_trends(f.gold["monthly_team_achievements"]), _TRENDS_SQL)
    register(
        "workforce_rollup",
        lambda f: histories.workforce_rollup(f.members),
        f"SELECT {_PLACE}, CAST(grouping_id({_PLACE}) AS BIGINT) AS level, "
        "count(DISTINCT employee_email) AS people, count(*) AS memberships FROM members "
        f"GROUP BY ROLLUP ({_PLACE})",
    )

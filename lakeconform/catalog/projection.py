"""Raw workforce exports, with their defects, derived from the TPC-H-like test tables.

Columns are SQL expressions that Spark and DuckDB read alike (text dates apart), so that the
Spark frames here and the checking SQL in ``oracle`` start from the same rows. Defects are
chosen by key.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# One text date in one of the six export formats, or not a date. The engines name their
# formats differently, so this is the one expression written for each of them.
SPARK_FORMATS = (
    "yyyy-MM-dd",
    "yyyy/MM/dd",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
    "MMMM d, yyyy",
    "d MMMM yyyy",
)
DUCKDB_FORMATS = ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d-%b-%Y", "%B %-d, %Y", "%-d %B %Y")
SPARK_MONTHS = ("yyyy-MM", "yyyy/MM", "MMMM yyyy")
DUCKDB_MONTHS = ("%Y-%m", "%Y/%m", "%B %Y")


def _text(day: str, number: str, engine: str, spark: tuple, duckdb: tuple) -> str:
    """The day written in the format with the given number, counted from zero."""
    formats = duckdb if engine == "duckdb" else spark
    write = "strftime" if engine == "duckdb" else "date_format"
    cases = " ".join(f"WHEN {n} THEN {write}({day}, '{f}')" for n, f in enumerate(formats))
    return f"CASE {number} {cases} END"


def text_date(day: str, key: str, engine: str) -> str:
    return _text(day, f"{key} % 6", engine, SPARK_FORMATS, DUCKDB_FORMATS)


def text_month(day: str, key: str, engine: str) -> str:
    return _text(day, f"{key} % 3", engine, SPARK_MONTHS, DUCKDB_MONTHS)


def _day_after(start: str, key: str, span: int) -> str:
    return f"(date '{start}' + cast({key} % {span} AS int))"


def engine_columns(engine: str) -> dict[str, dict[str, str]]:
    """The columns whose text differs between the engines."""
    hired = text_date(_day_after("2015-01-01", "c_custkey", 3000), "c_custkey", engine)
    formed = text_date(_day_after("2018-01-01", "p_partkey", 2000), "p_partkey", engine)
    started = text_date("CAST(l_shipdate AS date)", "l_orderkey", engine)
    reported = text_month("CAST(o_orderdate AS date)", "o_custkey", engine)
    junk = "'not a date'"
    return {
        "employees": {"hire_date": f"CASE WHEN c_custkey % 97 = 5 THEN {junk} WHEN c_custkey % 239 = 13"
            f" THEN '2030-01-01' ELSE {hired} END"},
        "teams": {"formed_date": f"CASE WHEN p_partkey % 89 = 5 THEN {junk} WHEN p_partkey % 433 = 13"
            f" THEN '2031-01-01' ELSE {formed} END"},
        "team_membership": {
            "start_date": f"CASE WHEN l_orderkey % 83 = 5 THEN {junk} ELSE {started} END"
        },
        "monthly_achievements": {
            "month": f"CASE WHEN o_orderkey % 101 = 1 THEN 'undated' ELSE {reported} END"
        },
    }


def _code(number: str, prefix: str) -> str:
    return f"'{prefix}' || lpad(cast({number} AS string), 2, '0')"


# The columns of each export, by the table they come from.
COLUMNS = {
    "locations": {
        "location_code": _code("n_nationkey + 1", "LOC-"),
        "city": "' ' || n_name || ' '",
        "country": "'Country ' || n_nationkey",
        "region": "CASE n_regionkey WHEN 1 THEN 'amer' WHEN 2 THEN 'apac' ELSE ' emea' END",
        "timezone": "CASE WHEN n_nationkey % 9 = 4 THEN '' ELSE 'UTC+' || n_regionkey END",
    },
    # One code that two rows claim, one lost, one misspelt, and rows that lack what they need.
    "locations_again": {
        "location_code": "CASE r_regionkey WHEN 0 THEN 'LOC-01' WHEN 2 THEN 'PLACE-9'"
        " WHEN 3 THEN 'LOC-98' WHEN 4 THEN 'LOC-99' END",
        "city": "CASE r_regionkey WHEN 0 THEN 'AAA CITY' WHEN 4 THEN ' ' ELSE 'Nowhere' END",
        "country": "'Country ' || r_regionkey",
        "region": "CASE r_regionkey WHEN 3 THEN 'Luna' ELSE 'AMER' END",
        "timezone": "'UTC+0'",
    },
    "organizations": {
        "org_id": _code("r_regionkey + 1", "ORG-"),
        "org_name": "r_name || ' Organization'",
        "org_leader_email": "'P' || (r_regionkey * 10) || '@ACMEINC.COM'",
    },
    "organizations_again": {
        "org_id": "CASE r_regionkey WHEN 0 THEN 'ORG-01' WHEN 2 THEN 'UNIT-3'"
        " WHEN 3 THEN 'ORG-98' WHEN 4 THEN 'ORG-99' END",
        "org_name": "CASE r_regionkey WHEN 3 THEN ' ' ELSE 'Old ' || r_name END",
        "org_leader_email": "CASE r_regionkey WHEN 4 THEN 'chief@nowhere' ELSE 'p1@acme-inc.com' END",
    },
    "employees": {
        "emp_id": "CASE WHEN c_custkey % 223 = 9 THEN '' WHEN c_custkey % 211 = 7 THEN 'E' || c_custkey"
        " ELSE 'EMP-' || c_custkey END",
        "full_name": "c_name",
        "email": "CASE WHEN c_custkey % 227 = 10 THEN ' ' WHEN c_custkey % 229 = 11 THEN 'p@nowhere'"
        " ELSE '  P' || (c_custkey - CASE WHEN c_custkey % 5 = 4 THEN 1 ELSE 0 END) || '@' ||"
        " CASE c_custkey % 4 WHEN 0 THEN 'acmeinc.com' WHEN 1 THEN 'ACME-INC.COM'"
        " WHEN 2 THEN 'acme_inc.com' ELSE 'acme-inc.co' END || ' ' END",
        "department": "c_mktsegment",
        "location_code": "CASE WHEN c_custkey % 20 = 0 THEN '' ELSE "
        + _code("c_nationkey + 1", "LOC-")
        + " END",
        "employment_type": "CASE WHEN c_custkey % 50 = 11 THEN 'Seasonal' ELSE"
        " CASE c_custkey % 7 WHEN 0 THEN 'Full-Time' WHEN 1 THEN 'Full Time' WHEN 2 THEN 'FT'"
        " WHEN 3 THEN 'Employee' WHEN 4 THEN 'full-time' WHEN 5 THEN 'FTE'"
        " ELSE 'Part-Time' END END",
        "manager_emp_id": "'EMP-' || (c_custkey % 10)",
        "status": "CASE WHEN c_custkey % 233 = 12 THEN 'on leave' WHEN c_acctbal < 0 THEN 'terminated'"
        " ELSE ' Active' END",
    },
    "contractor_roster": {
        "contractor_id": "CASE s_suppkey % 29 WHEN 2 THEN '' WHEN 4 THEN 'C' || s_suppkey"
        " ELSE 'CTR-' || s_suppkey END",
        "full_name": "s_name",
        "email": "CASE WHEN s_suppkey % 29 = 6 THEN '' WHEN s_suppkey % 29 = 8 THEN 'v@nowhere'"
        " WHEN s_suppkey % 5 = 0 THEN 'p' || s_suppkey || '@acme-inc.com'"
        " ELSE 'V' || s_suppkey || '@vendor.com' END",
        "agency": "'Agency ' || (s_suppkey % 4)",
        "location_code": "CASE WHEN s_suppkey % 31 = 5 THEN '' ELSE "
        + _code("s_nationkey + 1", "LOC-")
        + " END",
        "engagement_type": "CASE WHEN s_suppkey % 29 = 9 THEN 'Volunteer' ELSE"
        " CASE s_suppkey % 6 WHEN 0 THEN 'C2C' WHEN 1 THEN '1099'"
        " WHEN 2 THEN 'Temp' WHEN 3 THEN 'Vendor' WHEN 4 THEN 'Consultant'"
        " ELSE 'contractor' END END",
        "start_date": "cast(date '2020-01-01' + cast(s_suppkey % 900 AS int) AS string)",
        "end_date": "cast(date '2020-01-01' + cast(s_suppkey % 900"
        " + CASE WHEN s_suppkey % 13 = 3 THEN -9 ELSE 400 END AS int) AS string)",
        "status": "CASE WHEN s_suppkey % 29 = 7 THEN 'paused' WHEN s_acctbal < 0 THEN 'Ended'"
        " ELSE 'ACTIVE' END",
    },
    "teams": {
        "team_id": "CASE WHEN p_partkey % 401 = 3 THEN 'CREW-3' WHEN p_partkey < 100 THEN 'TM-' || lpad(cast(p_partkey AS string), 3, '0')"
        " ELSE 'TM-' || p_partkey END",
        "team_name": "CASE WHEN p_partkey % 409 = 5 THEN ' ' ELSE p_name END",
        "organization": """CASE WHEN p_partkey % 431 = 11 THEN '{}' ELSE '{"org_id":"' || """
        + _code("p_partkey % 5 + 1", "ORG-")
        + """ || '","org_name":"' || p_type || '"}' END""",
        "team_leader_email": "CASE WHEN p_partkey % 419 = 7 THEN 'lead@nowhere' WHEN p_partkey % 7 = 0"
        " THEN 'v' || (p_partkey % 10) || '@vendor.com'"
        " ELSE 'p' || (p_partkey % 150) || '@acme-inc.com' END",
        "primary_office": "CASE WHEN p_partkey % 421 = 9 THEN '' ELSE "
        + _code("p_size % 25 + 1", "LOC-")
        + " END",
        "reports_to_type": "CASE WHEN p_partkey % 3 = 0 THEN 'Org Leader' ELSE 'Manager' END",
        "reporting_manager_email": "CASE WHEN p_partkey % 4 = 0"
        " THEN 'p' || ((p_partkey % 5) * 10) || '@acme-inc.com'"
        " WHEN p_partkey % 31 = 1 THEN NULL ELSE 'p7@acme-inc.com' END",
    },
    "team_membership": {
        "team_code": "CASE WHEN l_orderkey % 1009 = 4 THEN 'SQUAD-1' ELSE CASE l_linenumber % 3 WHEN 0 THEN 'tm' || l_partkey"
        " WHEN 1 THEN 'tm-' || l_partkey ELSE 'TM-0' || l_partkey END END",
        "employee_email": "CASE WHEN l_orderkey % 50 = 0"
        " THEN 'ghost' || l_orderkey || '@acme-inc.com'"
        " WHEN l_orderkey % 997 = 3 THEN 'not-an-email' WHEN l_orderkey % 1013 = 5 THEN 'x@nowhere'"
        " WHEN l_linenumber = 7 THEN 'v' || l_suppkey || '@vendor.com'"
        " ELSE '  P' || o_custkey || '@acmeinc.com ' END",
        "role": "CASE WHEN l_orderkey % 1019 = 6 THEN 'Observer' ELSE CASE l_linenumber WHEN 1 THEN 'Team Lead' WHEN 2 THEN 'SME'"
        " WHEN 3 THEN 'Contributor' ELSE 'Member' END END",
        "allocation_pct": "CASE WHEN l_orderkey % 40 = 7 THEN 'many'"
        " ELSE cast(cast(l_quantity * 3 AS int) + copy AS string) END",
        "end_date": "CASE WHEN l_returnflag = 'N' THEN ''"
        " WHEN l_linenumber = 3 THEN '1994-01-01' ELSE '2000-06-30' END",
    },
    "monthly_achievements": {
        "team_id": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'tm' || l_partkey END",
        "team_name": "p_name",
        "title": "CASE WHEN o_orderkey % 1021 = 7 THEN '' ELSE 'Title ' || (o_orderkey % 500) END",
        "category": "CASE WHEN o_orderkey % 61 = 2 THEN '' ELSE o_orderpriority END",
        "impact_score": "CASE WHEN copy = 1 THEN '7.7' WHEN o_orderkey % 53 = 1 THEN 'gibberish'"
        " WHEN o_orderkey % 59 = 1 THEN '11.5' ELSE CASE o_orderkey % 10 WHEN 0 THEN 'High'"
        " WHEN 1 THEN ' low' WHEN 2 THEN 'Medium' WHEN 3 THEN NULL"
        " ELSE (o_custkey % 10) || '.' || (o_orderkey % 10) END END",
        "reported_by": "CASE WHEN o_orderkey % 1031 = 8 THEN 'p@nowhere'"
        " ELSE 'P' || o_custkey || '@acme-inc.com' END",
    },
}

# Rows that arrive twice: the second copy has ``copy`` = 1 and other details.
REPEATED = {
    "team_membership": "l_orderkey % 25 = 3",
    "monthly_achievements": "o_orderkey % 41 = 4",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _expressions(name: str, engine: str) -> dict[str, str]:
    return COLUMNS[name] | engine_columns(engine).get(name, {})


def _export(base: DataFrame, name: str) -> DataFrame:
    return base.selectExpr(*[f"{e} AS {column}" for column, e in _expressions(name, "spark").items()])


def _with_copies(base: DataFrame, name: str) -> DataFrame:
    """Repeat rows while they stream by, instead of scanning and joining them twice."""
    return base.selectExpr(
        "*", f"explode(CASE WHEN {REPEATED[name]} THEN array(0, 1) ELSE array(0) END) AS copy"
    )


def raw_frame(t: Callable[[str], DataFrame], name: str) -> DataFrame:
    """One export by source entity name, as a lazy frame; ``t`` gives a table by name."""
    if name == "locations":
        return _export(t("nation"), name).unionByName(_export(t("region"), "locations_again"))
    if name == "organizations":
        return _export(t("region"), name).unionByName(_export(t("region"), "organizations_again"))
    if name == "team_membership":
        # Both sides grow with the data, so neither is ever broadcast.
        staffed = t("lineitem").join(
            t("orders").hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
        )
        return _export(_with_copies(staffed, name), name)
    if name == "monthly_achievements":
        first = t("lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("l_partkey"))
        achieved = (
            t("orders")
            .join(first.hint("merge"), F.col("o_orderkey") == F.col("l_orderkey"))
            .join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
        )
        return _export(_with_copies(achieved, name), name)
    base = {
        "employees": "customer",
        "contractor_roster": "supplier",
        "teams": "part",
    }
    return _export(t(base[name]), name)


def raw_sql() -> dict[str, str]:
    """The same exports as DuckDB SELECT texts, named ``raw_<export>``."""

    def export(name: str, base: str) -> str:
        columns = ", ".join(f"{e} AS {n}" for n, e in _expressions(name, "duckdb").items())
        return f"SELECT {columns} FROM ({base}) b"

    def copies(name: str, base: str) -> str:
        return (
            f"SELECT *, 0 AS copy FROM ({base}) c0 UNION ALL "
            f"SELECT *, 1 AS copy FROM ({base}) c1 WHERE {REPEATED[name]}"
        )

    staffed = "SELECT l.*, o.* FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey"
    achieved = (
        "SELECT o.*, f.l_partkey, p.* FROM orders o JOIN (SELECT l_orderkey, min(l_partkey) AS "
        "l_partkey FROM lineitem GROUP BY l_orderkey) f ON o.o_orderkey = f.l_orderkey "
        "JOIN part p ON p.p_partkey = f.l_partkey"
    )
    return {
        "raw_locations": export("locations", "SELECT * FROM nation")
        + " UNION ALL "
        + export("locations_again", "SELECT * FROM region"),
        "raw_organizations": export("organizations", "SELECT * FROM region")
        + " UNION ALL "
        + export("organizations_again", "SELECT * FROM region"),
        "raw_employees": export("employees", "SELECT * FROM customer"),
        "raw_contractor_roster": export("contractor_roster", "SELECT * FROM supplier"),
        "raw_teams": export("teams", "SELECT * FROM part"),
        "raw_team_membership": export("team_membership", copies("team_membership", staffed)),
        "raw_monthly_achievements": export(
            "monthly_achievements", copies("monthly_achievements", achieved)
        ),
    }

from datetime import date

import pytest
from pyspark.sql import functions as F

from lakeconform import functions as fn


def test_clean_string(apply):
    assert apply(fn.clean_string, [" a b ", "", "   ", None]) == ["a b", None, None, None]


CORPORATE, VENDOR = "acme-inc.com", "orchard.example"


@pytest.mark.parametrize("spelling", ["acmeinc.com", "acme_inc.com", "acme-inc.co", "AcMe-InC.CoM"])
def test_corporate_domains_become_one(apply, spelling):
    people = ["q7", "lee_2", "K.Ng"]
    given = [f" {who}@{spelling}  " for who in people]
    assert apply(fn.normalize_email, given) == [f"{who.lower()}@{CORPORATE}" for who in people]


def test_other_addresses_stay_but_for_case(apply):
    given = [f"Kim@{VENDOR}", f"kim@eu.{CORPORATE}x", "two@first@second", "two@acmeinc.com@second", "@acmeinc.com", "end@"]
    assert apply(fn.normalize_email, given) == [
        f"kim@{VENDOR}", f"kim@eu.{CORPORATE}x", "two@first", f"two@{CORPORATE}", f"@{CORPORATE}", "end@",
    ]
    assert apply(fn.normalize_email, ["no sign of one", " ", None]) == [None] * 3


def test_email_settings_are_arguments(apply):
    def repair(x):
        return fn.normalize_email(x, "a.org", ["b.org"])

    assert apply(repair, ["u@b.org", "u@acmeinc.com"]) == ["u@a.org", "u@acmeinc.com"]
    assert apply(lambda x: fn.normalize_email(x, "a.org", []), ["u@b.org"]) == ["u@b.org"]


def test_email_domain_and_validity(apply):
    assert apply(fn.email_domain, ["a@B.com", "a", None]) == ["B.com", None, None]
    given = [" a@b.com ", "a b@c.com", "a@b", "a@b.c1", None]
    assert apply(fn.is_valid_email, given) == [True, False, False, False, None]


WRITTEN = ("%Y-%m-%d", "%Y/%m/%d", "%m/%d/%Y", "%d-%b-%Y")


@pytest.mark.parametrize("day", [date(1999, 12, 31), date(2024, 2, 29), date(2031, 7, 4)])
def test_parse_date_reads_every_export_format(apply, day):
    given = [day.strftime(f) for f in WRITTEN]
    given += [f"{day:%B} {day.day}, {day.year}", f"{day.day} {day:%B} {day.year}", f"\u0020{given[0]} "]
    assert apply(fn.parse_date, given) == [day] * 7


def test_parse_date_leaves_what_is_no_date(apply):
    given = ["7/4/2031", "2023-02-29", "31/12/1999", "tomorrow", "20310704", " ", None]
    assert apply(fn.parse_date, given) == [None] * 7


def test_parse_date_accepts_a_format_without_known_shape(apply):
    assert apply(lambda x: fn.parse_date(x, ["yyyy'Q'DDD"]), ["2020Q032"]) == [date(2020, 2, 1)]


def test_month(apply):
    months = [date(2025, m, 1) for m in (1, 6, 12)]
    for pattern in ("%Y-%m", "%Y/%m", "%B %Y"):
        given = [m.strftime(pattern) for m in months]
        assert apply(fn.parse_month, given) == months
        assert apply(fn.month_key, given) == ["2025-01", "2025-06", "2025-12"]
    assert apply(fn.month_key, ["2025-13", "undated", None]) == [None] * 3


def test_numbers(apply):
    whole = ["17", "-4 ", " 007"]
    assert apply(fn.parse_int, whole) == [17, -4, 7]
    assert apply(fn.parse_int, ["3.0", "4 5", "0x1F", "two", "-", " ", None, str(2**40)]) == [None] * 8
    assert apply(fn.parse_double, [*whole, "-0.25", "12.50"]) == [17.0, -4.0, 7.0, -0.25, 12.5]
    assert apply(fn.parse_double, ["7e2", "+3", ".75", "9.", "1,5", None]) == [None] * 6


def test_scores(apply):
    cases = {
        "lOw": (2.5, "BAND"), " Medium": (5.0, "BAND"), "HIGH ": (8.0, "BAND"), "9.75": (9.75, "NUMERIC"),
        "-1": (-1.0, "NUMERIC"), "middling": (None, "UNPARSEABLE"), " ": (None, "MISSING"),
    }
    assert apply(fn.parse_score, [*cases, None]) == [*[v[0] for v in cases.values()], None]
    assert apply(fn.score_origin, [*cases, None]) == [*[v[1] for v in cases.values()], "MISSING"]


@pytest.mark.parametrize(
    ("function", "label", "spellings"),
    [
        (fn.normalize_employment_type, "PART_TIME", ["pt", "Part Time", " part-time"]),
        (fn.normalize_employment_type, "FULL_TIME", ["fte", "Ft", "EMPLOYEE ", "full-time"]),
        (fn.normalize_engagement_type, "CONTRACTOR", ["consultant", "c2c", "VENDOR"]),
        (fn.normalize_role, "TEAM_LEAD", ["Team Leader", "lead"]),
        (fn.normalize_role, "MEMBER", ["individual contributor", "Sme"]),
        (fn.normalize_status, "INACTIVE", ["inactive", " InActive "]),
    ],
)
def test_vocabularies(apply, function, label, spellings):
    assert apply(function, spellings) == [label] * len(spellings)
    assert apply(function, ["seasonal", " ", None]) == ["UNKNOWN", None, None]


def test_normalize_code(apply):
    for number, want in ((3, "TM-003"), (58, "TM-058"), (914, "TM-914"), (70211, "TM-70211")):
        given = [f"TM-{number}", f"tm{number}", f" Tm-000{number} ", f"TM0{number}"]
        assert apply(fn.normalize_code, given) == [want] * 4
    assert apply(fn.normalize_code, ["tm0000"]) == ["TM-000"]
    assert apply(fn.normalize_code, ["CREW-3", "TM_3", "TM-", "TM-3b", "3", " ", None]) == [None] * 7


def test_long_codes_stay_apart(apply):
    given = [f"TM-{n}" for n in range(1000, 1200)]
    assert apply(fn.normalize_code, given) == given


def test_other_prefix_and_width(apply):
    assert apply(lambda x: fn.normalize_code(x, "ab", 5), ["AB7"]) == ["AB-00007"]


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [row[0] for row in df.select(fn.surrogate_key("x", "y")).collect()]
    assert keys[0] == keys[1] != keys[2]
    assert all(len(key) == 64 for key in keys)


def test_cap_and_flags(either_mode):
    rows = [(150, None), (-5, date(2024, 1, 31)), (50, date(2024, 2, 1)), (None, None)]
    df = either_mode.createDataFrame(rows, "n int, e date")
    today = F.lit(date(2024, 2, 1))
    got = df.select(
        fn.cap_range("n", 0, 100), fn.was_capped("n", 100), fn.active_flag("e", today)
    ).collect()
    assert [tuple(r) for r in got] == [
        (100, True, True),
        (0, False, False),
        (50, False, True),
        (None, None, True),
    ]


def test_rounding_goes_by_the_binary_value(either_mode):
    rows = [(4.935,), (0.125,), (-0.125,), (2.0,), (None,)]
    df = either_mode.createDataFrame(rows, "x double").select(fn.stable_round(F.col("x"), 2))
    assert [r[0] for r in df.collect()] == [4.93, 0.13, -0.13, 2.0, None]


def test_guarded_ratio(either_mode):
    df = either_mode.createDataFrame([(1, 3), (1, 0), (0, 2)], "a long, b long")
    assert [r[0] for r in df.select(fn.guarded_ratio("a", "b")).collect()] == [0.3333, None, 0.0]


def test_json_path(apply):
    given = ['{"a":{"b":" x "}}', '{"a":1}', "junk", None]
    assert apply(lambda x: fn.json_path(x, "$.a.b"), given) == ["x", None, None, None]


def test_tristate_and_default(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b")], "x string, y string")
    got = df.select(fn.tristate_equal("x", "y"), fn.default_label("x", "UNKNOWN")).collect()
    assert [tuple(r) for r in got] == [(True, "a"), (False, "a"), (None, "UNKNOWN")]


def test_functions_work_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("tm1",), ("x",)], "code string").write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("code string").json(str(tmp_path / "in"))
    assert stream.isStreaming
    query = (
        stream.select(fn.normalize_code("code").alias("code"))
        .writeStream.format("memory")
        .queryName("codes")
        .trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .start()
    )
    query.awaitTermination(60)
    assert sorted(str(r[0]) for r in spark.table("codes").collect()) == ["None", "TM-001"]

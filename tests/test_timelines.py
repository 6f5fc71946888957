"""Look-ups in time, overlaps and islands against plain Python, with one key that has most rows."""

from __future__ import annotations

import random
from collections import Counter
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from support import rows_of

from lakeconform.operators.differences import snapshot_difference
from lakeconform.operators.intervals import load_spans, overlap_join
from lakeconform.operators.timelines import as_of_join, islands
from lakeconform.plans import histories

DAY = date(2000, 1, 1)
OPEN = date(9999, 12, 31)


def day(n):
    return DAY + timedelta(days=n)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def keyed(draw, n):
    """Two thirds of the rows belong to one key."""
    return ["hot" if draw.random() < 0.67 else draw.choice("abc") for _ in range(n)]


def test_as_of_join(spark):
    draw = random.Random(1)
    left = [(i, k, day(draw.randrange(900))) for i, k in enumerate(keyed(draw, 120))]
    left += [(900, None, DAY), (901, "hot", None), (902, "nobody", DAY), (902, "nobody", DAY)]
    right = [(k, day(draw.randrange(100, 900)), draw.choice([None, *range(9)])) for k in keyed(draw, 60)]
    right += [("hot", None, 5), (None, DAY, 5)]
    asked = spark.createDataFrame(left, "id int, who string, at date")
    held = spark.createDataFrame(right, "who string, from date, value int").withColumnRenamed("who", "who")
    found = as_of_join(asked, held, "who", "at", "from", ["value"])
    want = []
    for i, who, at in left:
        known = [(f, -1 if v is None else v) for w, f, v in right if w == who and f and at and f <= at and w]
        since, value = max(known, default=(None, None))
        want.append((i, who, at, None if value == -1 else value, since))
    assert rows_of(found) == sorted(want, key=repr)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    assert "date_trunc" in plan_of(found) or "trunc" in plan_of(found)


def test_as_of_join_takes_each_known_value_of_one_time(spark):
    asked = spark.createDataFrame([(1, "a", day(9)), (2, "b", day(9))], "id int, who string, at date")
    right = [("a", day(3), "LEAD", None, "T2"), ("a", day(3), "LEAD", None, "T1"), ("a", day(3), "HAND", 40, "T9")]
    right += [("b", day(3), "HAND", 10, "T9"), ("b", day(3), "HAND", 20, None), ("b", day(1), "LEAD", 30, "T5")]
    held = spark.createDataFrame(right, "who string, from date, role string, share int, team string")
    found = as_of_join(asked, held, "who", "at", "from", ["role", "share", "team"])
    assert rows_of(found, "id", "role", "share", "team", "since") == [
        (1, "LEAD", 40, "T2", day(3)),
        (2, "HAND", 20, "T9", day(3)),
    ]


def test_overlaps_of_short_long_and_open_intervals(spark):
    draw = random.Random(2)
    rows = []
    for i, k in enumerate(keyed(draw, 90)):
        start, length = draw.randrange(-15_000, 15_000), draw.choice([0, 1, 20, 400, 5_000, 13_000, 40_000])
        rows.append((i, k, day(start), draw.choice([day(start + length), None])))
    rows += [(90, "a", None, DAY), (91, "a", day(9), day(8)), (92, None, DAY, DAY)]
    df = spark.createDataFrame(rows, "id int, who string, s date, e date")
    found = overlap_join(df, df, ["who"], "s", "e", F.col("l_id") < F.col("r_id"))
    want = []
    for i, who, s, e in rows:
        for j, other, t, u in rows:
            if i < j and who and who == other and s and t and s <= (e or OPEN) and t <= (u or OPEN):
                low, high = max(s, t), min(e or OPEN, u or OPEN)
                if low <= high:
                    want.append((i, j, low, high))
    assert len(want) > 100
    got = rows_of(found, "l_id", "r_id", "overlap_start", "overlap_end")
    assert got == sorted(want, key=repr) and len(set(got)) == len(got)
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)


def test_load_spans(spark):
    rows = [
        ("a", day(0), day(9), 60), ("a", day(5), day(20), 50), ("a", day(21), None, 101),
        ("b", day(0), day(3), 70), ("b", day(4), day(8), 70), ("b", day(9), day(8), 500),
        ("c", None, day(3), 500), (None, day(0), day(3), 500), ("c", day(1), day(1), None),
    ]
    df = spark.createDataFrame(rows, "who string, s date, e date, n int")
    assert rows_of(load_spans(df, "who", "s", "e", "n", 100)) == [
        ("a", day(21), OPEN, 101.0),
        ("a", day(5), day(9), 110.0),
    ]


def brute_islands(rows, gap):
    found = []
    for key in {k for k, s, e in rows if k and s and e}:
        spans = sorted((s, e) for k, s, e in rows if k == key and s and e)
        low, high, n = *spans[0], 0
        for s, e in spans:
            if s > high + timedelta(days=gap):
                found.append((key, low, high, n))
                low, high, n = s, e, 0
            high, n = max(high, e), n + 1
        found.append((key, low, high, n))
    return sorted(found, key=repr)


@pytest.mark.parametrize("longest", [0, 40, 900])
def test_islands_across_slices(spark, longest):
    """Slices of a month; intervals of none, some and many slices, and rows of islands begun long ago."""
    draw = random.Random(longest)
    rows = [(k, s := day(draw.randrange(4000)), s + timedelta(days=draw.randint(0, longest))) for k in keyed(draw, 150)]
    rows += [("hot", None, DAY), (None, DAY, DAY), ("x", DAY, DAY), ("x", DAY, DAY)]
    df = spark.createDataFrame(rows, "who string, s date, e date")
    found = islands(df, "who", "s", "e", "9", [F.count("*").alias("n")], unit="month")
    assert rows_of(found) == brute_islands(rows, 9)


def test_a_frequent_key_is_many_windows(spark):
    """No window goes over all rows of a key: each is cut by its slice, but for one row per slice."""
    df = spark.range(1000).select(F.lit(1).alias("user_id"), F.timestamp_seconds(F.col("id") * 600).alias("ts"))
    df = df.withColumn("value", F.lit(1.0))
    plan = plan_of(histories.sessions(df))
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("_slice" in line for line in windows)
    assert histories.sessions(df).collect()[0].n_events == 1000


def test_snapshot_difference_counts_copies(spark):
    columns = "k string, j int, v string"
    old = [("a", 1, "x"), ("a", 1, "x"), ("b", 1, "x"), ("c", None, "x"), ("d", 1, "p"), ("e", 1, None), ("f", 1, "x")]
    new = [("a", 1, "x"), ("b", 1, "y"), ("c", None, None), ("d", 1, "q"), ("d", 1, "q"), ("e", 1, None), ("g", 1, "x")]
    found = snapshot_difference(spark.createDataFrame(old, columns), spark.createDataFrame(new, columns), ["k", "j"])
    assert rows_of(found) == [
        ("a", 1, "deleted", 1, ""),
        ("b", 1, "changed", 1, "v"),
        ("c", None, "changed", 1, "v"),
        ("d", 1, "deleted", 1, ""),
        ("d", 1, "inserted", 2, ""),
        ("f", 1, "deleted", 1, ""),
        ("g", 1, "inserted", 1, ""),
    ]
    many = spark.createDataFrame([("a", 1, "x")] * 500, columns)
    kept = snapshot_difference(many, many.limit(499), ["k", "j"])
    assert Counter(rows_of(kept)) == {("a", 1, "deleted", 1, ""): 1}


def test_trends_fill_months(spark):
    rows = [("t", "2024-01", 3), ("t", "2024-04", 6), ("u", "2024-02", 1), ("t", None, 9)]
    df = spark.createDataFrame(rows, "team_id string, month_key string, achievement_count long")
    assert rows_of(histories.team_trends(df).filter("team_id = 't'"), "month_key", "achievements", "recent_mean", "change") == [
        ("2024-01", 3, 3.0, None),
        ("2024-02", 0, 1.5, -3),
        ("2024-03", 0, 1.0, 0),
        ("2024-04", 6, 2.0, 6),
    ]


def test_rollup_repeats_counts_not_rows(spark):
    names = "person_region string, person_country string, person_city string, staff_type string, employee_email string"
    df = spark.createDataFrame([("E", "F", "P", "D", "a"), ("E", "F", "P", "D", "a"), ("E", "G", "B", "N", "b")], names)
    found = histories.workforce_rollup(df)
    assert rows_of(found.filter("level = 15"), "people", "memberships") == [(2, 3)]
    plan = plan_of(found)
    assert plan.index("Expand") < plan.rindex("HashAggregate")

"""Rules across entities, mergeable sketches and streams, against plain Python."""

from __future__ import annotations

import os
import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from support import rows_of

from lakeconform.operators.quality import VIOLATIONS, Contract, Reference, Rule, validate, with_reason
from lakeconform.operators.references import check_references, reference_failures
from lakeconform.operators.sketches import PEOPLE_BOUND, RANK_BOUND, estimate, merge, sketches
from lakeconform.streaming.windows import closed_windows, event_stream, run_windows

CONTRACT = Contract(
    "visits",
    ("visitor", "place"),
    ("visitor",),
    (Rule("paid", "fee > 0"),),
    references=(
        Reference("visitor_known", "visitor", "people", "name"),
        Reference("place_known", "place", "places", "code"),
    ),
)


@pytest.fixture
def visits(spark):
    rows = [("ada", "x", 1), ("ada", "nowhere", 0), ("bo", "x", 1), (None, None, 1), ("cy", "nowhere", 2)]
    rows += [("ghost", "x", 3)] * 40
    parents = {
        "people": spark.createDataFrame([("ada",), ("bo",), ("bo",), (None,), ("cy",)], "name string"),
        "places": spark.createDataFrame([("x", 1)], "code string, size int"),
    }
    return spark.createDataFrame(rows, "visitor string, place string, fee int"), parents


def test_references_add_their_names_to_the_reason(visits):
    df, parents = visits
    checked = check_references(validate(df, CONTRACT).annotated, CONTRACT, parents)
    assert checked.columns == [*df.columns, VIOLATIONS]
    rejected = with_reason(checked)
    assert set(rows_of(rejected, "visitor", "place", "_rejection_reason")) == {
        ("ada", "nowhere", "paid; place_known"),
        ("cy", "nowhere", "place_known"),
        ("ghost", "x", "visitor_known"),
    }
    # Parents that hold a key twice, or null, repeat and lose no row.
    assert checked.count() == df.count() == rejected.count() + 3
    assert rows_of(reference_failures(df, CONTRACT, parents)) == [("place_known", 2, 1), ("visitor_known", 40, 1)]


def test_references_look_up_values_and_not_rows(visits):
    df, parents = visits
    plan = reference_failures(df, CONTRACT, parents)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 2
    # The values are grouped below the look-up.
    for part in plan.split("LeftAnti")[1:]:
        assert "Aggregate [visitor" in part or "Aggregate [place" in part


def test_no_rows_and_no_references(spark, visits):
    df, parents = visits
    empty = df.limit(0)
    assert check_references(validate(empty, CONTRACT).annotated, CONTRACT, parents).count() == 0
    assert reference_failures(empty, CONTRACT, parents).count() == 0
    assert reference_failures(df, Contract("visits", (), ()), parents).count() == 0


def test_sketches_merge_in_any_order_within_their_bounds(spark):
    draw = random.Random(3)
    facts = [(draw.randrange(30), draw.randrange(20_000), draw.gauss(10, 4)) for _ in range(60_000)]
    df = spark.createDataFrame(facts, "day int, person long, score double")
    daily = sketches(df, ["day"], "person", "score")
    week = (F.col("day") / 7).cast("int").alias("week")
    through_weeks = merge(merge(daily, [week]), [F.lit(0).alias("all")])
    at_once = merge(daily.orderBy(F.desc("day")), [F.lit(0).alias("all")])
    people, scores = len({p for _, p, _ in facts}), sorted(s for _, _, s in facts)
    for kept in (through_weeks, at_once):
        row = estimate(kept, {"low": 0.1, "median": 0.5, "high": 0.99}).first()
        assert row["rows"] == len(facts)
        assert abs(row.distinct_values - people) <= PEOPLE_BOUND * people
        for name, q in (("low", 0.1), ("median", 0.5), ("high", 0.99)):
            rank = sum(s <= row[name] for s in scores) / len(scores)
            assert abs(rank - q) <= RANK_BOUND
    # Registers do not depend on the order of merging.
    assert len({estimate(k, {}).first().distinct_values for k in (through_weeks, at_once)}) == 1


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None)], "day int, person long, score double")
    row = estimate(merge(sketches(df, ["day"], "person", "score"), ["day"]), {"median": 0.5}).first()
    assert (row["rows"], row.distinct_values, row.median) == (2, 0, None)


START = datetime(2024, 3, 1)
SCHEMA = "event_id long, kind string, ts timestamp, value double"
SHAPE = {"time": "ts", "identity": "event_id", "value": "value", "delay": "10 minutes"}


def minutes(n):
    return START + timedelta(minutes=n)


class Feed:
    def __init__(self, spark, folder):
        self.spark, self.folder, self.n = spark, folder, 0
        self.schema = spark.createDataFrame([], SCHEMA).schema

    def arrive(self, rows):
        """One more file, newer than those before."""
        self.n += 1
        path = self.folder / "in" / f"part-{self.n}.parquet"
        path.parent.mkdir(exist_ok=True)
        self.spark.createDataFrame(rows, SCHEMA).toPandas().to_parquet(
            path, coerce_timestamps="us", allow_truncated_timestamps=True
        )
        os.utime(path, (1_700_000_000 + self.n * 10,) * 2)

    def run(self, **more):
        stream = event_stream(self.spark, str(self.folder / "in"), self.schema, files=1)
        windows = closed_windows(stream, ["kind"], **SHAPE, **more)
        return run_windows(windows, str(self.folder / "out"), str(self.folder / "checkpoint"))

    def found(self):
        return rows_of(self.spark.read.parquet(str(self.folder / "out")), "starts", "kind", "n", "total")


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_tumbling_windows_restart_and_late_rows(feed):
    feed.arrive([(1, "a", minutes(1), 1.0), (2, "a", minutes(50), 2.0), (2, "a", minutes(50), 2.0), (3, "b", None, 9.0)])
    feed.arrive([(2, "a", minutes(50), 2.0), (4, "a", minutes(58), 4.0), (5, "b", minutes(130), 1.0)])
    feed.run(length="1 hour")
    hour = [(minutes(0), "a", 3, 7.0)]
    assert feed.found() == hour
    # Nothing new: nothing is added. A new call goes on with the windows that were open.
    again = feed.run(length="1 hour")
    assert again.rows == 0 and feed.found() == hour
    feed.arrive([(6, "b", minutes(140), 2.0), (7, "a", minutes(30), 100.0)])
    feed.arrive([(8, "b", minutes(300), 1.0)])
    progress = feed.run(length="1 hour")
    assert progress.rows == 3 and progress.late == 1
    assert feed.found() == sorted([*hour, (minutes(120), "b", 2, 3.0)], key=repr)


@pytest.mark.parametrize("shape", [{"length": "1 hour", "slide": "20 minutes"}, {"length": "15 minutes", "session": True}])
def test_stream_and_batch_agree(spark, feed, shape):
    draw = random.Random(5)
    rows = [(i, draw.choice("aaab"), minutes(i + draw.random() * 4), float(draw.randrange(9))) for i in range(0, 900, 3)]
    for at in range(0, 300, 100):
        feed.arrive(rows[at : at + 100] + rows[at : at + 2])
    feed.arrive([(9000, "z", minutes(5000), 1.0)])
    assert feed.run(**shape).late == 0
    batch = closed_windows(spark.createDataFrame(rows, SCHEMA), ["kind"], **SHAPE, **shape)
    assert feed.found() == rows_of(batch, "starts", "kind", "n", "total")


def test_sliding_windows_by_hand(spark):
    rows = [(i, "a", minutes(7 * i), float(i)) for i in range(40)]
    want = defaultdict(lambda: [0, 0.0])
    for _, _, ts, value in rows:
        for k in range(3):
            start = int((ts - START).total_seconds() // 1200) * 20 - 20 * k
            want[minutes(start)][0] += 1
            want[minutes(start)][1] += value
    found = closed_windows(spark.createDataFrame(rows, SCHEMA), ["kind"], **SHAPE, length="1 hour", slide="20 minutes")
    assert {r.starts: [r.n, r.total] for r in found.collect()} == dict(want)

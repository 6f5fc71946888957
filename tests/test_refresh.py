"""Incremental runs against full runs over the same rows."""

from __future__ import annotations

from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from support import rows_of

from lakeconform.catalog.projection import raw_frame, table
from lakeconform.operators.merge import changed_rows, merge_first, new_since, next_edge
from lakeconform.plans import refresh
from lakeconform.plans.pipeline import GOLD_DATASETS, SILVER_ORDER, run_pipeline
from lakeconform.settings import Settings
from lakeconform.sources.lake import LINEAGE, Lake, read_gold, read_silver
from lakeconform.sources.registry import SOURCES, Origin
from lakeconform.sources.transaction import Store, Transaction, recover

SF_DIR = "/root/testdata/sf0.001"
SETTINGS = Settings(as_of=date(2024, 2, 1))
# The first export ends here; what comes later is new in the second.
CUTS = {
    "employees": "2015-03-15",
    "contractor_roster": "2020-01-06",
    "teams": "2018-05-01",
    "team_membership": "1997-06-01",
    "monthly_achievements": "1997-01-01",
}


def export(spark, root, later: bool, take: float = 0.25):
    """The seven exports as files: the first ones, or all rows."""
    for source in SOURCES:
        df = raw_frame(lambda name: table(spark, SF_DIR, name), source.entity)
        if source.entity == "team_membership":
            df = df.filter(F.pmod(F.xxhash64("team_code", "employee_email"), F.lit(4)) < 4 * take)
        value = refresh.watermark_of(source, SETTINGS.date_formats, SETTINGS.month_formats)
        if not later:
            if source.entity in CUTS:
                df = df.filter(F.coalesce(value <= F.lit(CUTS[source.entity]).cast("date"), F.lit(True)))
            else:
                df = df.filter(F.coalesce(~F.col(df.columns[0]).isin("LOC-07", "ORG-02"), F.lit(True)))
        path = f"{root}/{source.system}/{source.file_name}"
        if source.file_format == "csv":
            df.write.option("header", "true").option("escape", '"').csv(path)
        else:
            df.write.option("ignoreNullFields", "false").json(path)
    return Origin(str(root))


def run(spark, home, origin, **options):
    return run_pipeline(spark, home, origin, SETTINGS, route="file", ingest_date="2024-02-01", **options)


def tables(spark, home):
    plain = lambda df: rows_of(df.drop(*LINEAGE), *sorted(c for c in df.columns if c not in LINEAGE))
    silver = {name: plain(read_silver(spark, home, name)) for name in SILVER_ORDER}
    return silver | {name: plain(read_gold(spark, home, name)) for name in GOLD_DATASETS}


@pytest.fixture(autouse=True, scope="module")
def interpreted(spark):
    """A run makes some hundred small plans over few rows; compiling them takes most of the time."""
    plain = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN"}
    for name, value in plain.items():
        spark.conf.set(name, value)
    yield
    for name in plain:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def exports(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("exports")
    return export(spark, root / "first", False), export(spark, root / "all", True)


pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def files(home):
    return {str(p) for p in Path(home.root).rglob("*.parquet") if "manifest" not in str(p)}


def test_refresh_equals_a_full_run(spark, exports, tmp_path, monkeypatch):
    first, everything = exports
    home = Lake(str(tmp_path / "lake"))
    report = run(spark, home, first, incremental=True, batch_id="b1", buckets=8)
    assert {r.status for r in report.metrics.collect()} == {"SUCCESS"}
    marks = {r.entity: str(r.mark) for r in spark.read.parquet(home.marks()).collect()}
    assert marks["employees"] <= CUTS["employees"] and marks["locations"] == "None"

    # A second run breaks off after some tables are staged: tables and marks stay as they were.
    before, lying = tables(spark, home), files(home)

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(refresh.Refresh, "people", broken)
        failed = run(spark, home, everything, incremental=True, batch_id="b2")
    assert {r.entity for r in failed.metrics.filter("status = 'FAILED'").collect()} == {"dim_person"}
    assert tables(spark, home) == before
    assert {f for f in files(home) if "/_refresh/" not in f} == lying
    assert {r.entity: str(r.mark) for r in spark.read.parquet(home.marks()).collect()} == marks

    report = run(spark, home, everything, incremental=True, batch_id="b3")
    rows = {(r.layer, r.entity): r for r in report.metrics.collect()}
    assert {r.status for r in rows.values()} == {"SUCCESS"}
    assert all(r.reconciles for r in rows.values())
    loaded = rows["bronze", "employees"].rows_read
    assert 0 < loaded < 100
    assert rows["bronze", "locations"].rows_read == 1
    merged = tables(spark, home)
    assert merged != before
    assert recover(spark, home) == []

    # Nothing new: nothing is written.
    lying = files(home)
    report = run(spark, home, everything, incremental=True, batch_id="b4")
    assert {r.rows_read for r in report.metrics.collect()} == {0}
    assert report.passed and files(home) - lying == set()

    # A full run makes the same tables; it lays them flat again and forgets the marks.
    run(spark, home, everything, batch_id="b5")
    wanted = tables(spark, home)
    assert {name for name in wanted if wanted[name] != merged[name]} == set()
    assert len(wanted["achievements"]) > len(before["achievements"]) > 0
    assert not Path(home.marks()).exists()


def test_incremental_takes_everything(spark, tmp_path):
    with pytest.raises(ValueError, match="all stages"):
        run(spark, Lake(str(tmp_path)), Origin("x"), incremental=True, entities=["teams"])


def test_publishing_goes_on_where_it_broke_off(spark, tmp_path, monkeypatch):
    home, target = Lake(str(tmp_path / "lake")), str(tmp_path / "lake" / "silver" / "t")
    old = spark.createDataFrame([(n, "old") for n in range(40)], "k int, v string")
    tx = Transaction(spark, home, "one", 4, first_load=True)
    tx.stage_keys(target, old, None, ["k"], ["k"])
    tx.publish()
    tx = Transaction(spark, home, "two", 4)
    new = spark.createDataFrame([(n, "new") for n in range(0, 40, 2)], "k int, v string")
    gone = spark.createDataFrame([(1, "x"), (3, "x")], "k int, v string")
    tx.stage_keys(target, new, gone, ["k"], ["k"])
    assert rows_of(tx.current(target).groupBy("v").count()) == [("old", 40)]
    want = [("new", 20), ("old", 18)]
    assert rows_of(tx.latest(target).groupBy("v").count()) == want

    moved = []
    move = Store.move

    def once(self, source, place):
        if len(moved) == 2:
            raise OSError("store is away")
        moved.append(place)
        move(self, source, place)

    with monkeypatch.context() as patch:
        patch.setattr(Store, "move", once)
        with pytest.raises(OSError):
            tx.publish()
    assert recover(spark, home) == ["two"]
    assert rows_of(spark.read.parquet(target).groupBy("v").count()) == want
    # What was staged without a journal is dropped.
    tx = Transaction(spark, home, "three", 4)
    tx.stage_keys(target, new.withColumn("v", F.lit("never")), None, ["k"], ["k"])
    assert recover(spark, home) == []
    assert rows_of(spark.read.parquet(target).groupBy("v").count()) == want


def test_merge_keeps_the_first_of_all_rows_ever_seen(spark):
    def frame(rows):
        return spark.createDataFrame(rows, "a string, b string, rank int, v string")

    old = frame([("x", None, 2, "old"), ("y", "1", 1, "old"), ("z", "1", 1, "old")])
    new = frame([("x", None, 1, "new"), ("y", "1", 3, "new"), ("w", "1", 1, "new"), ("w", "1", 1, "new")])
    merged = merge_first(old, new, ["a", "b"], ["rank"])
    assert rows_of(merged.before) == [("x", None, 2, "old"), ("y", "1", 1, "old")]
    assert rows_of(merged.after) == [("w", "1", 1, "new"), ("x", None, 1, "new"), ("y", "1", 1, "old")]
    assert rows_of(merged.dropped, "a", "v") == [("w", "new"), ("x", "old"), ("y", "new")]
    names = ["a", "b", "rank", "v"]
    assert rows_of(changed_rows(merged.before, merged.after, names)) == [
        ("w", "1", 1, "new"),
        ("x", None, 1, "new"),
        ("x", None, 2, "old"),
    ]


def test_rows_at_the_mark_count_once(spark):
    def load(rows):
        return spark.createDataFrame(rows, "id string, day string")

    def new(rows, mark, seen):
        value = F.expr("try_to_date(day)")
        return new_since(load(rows), value, F.lit(mark).cast("date"), seen, ["id", "day"])

    rows = [("a", "2024-01-01"), ("b", "2024-01-02"), ("c", "soon")]
    seen = spark.createDataFrame([], "id string, day string, _value date")
    first = new(rows, None, seen)
    assert rows_of(first, "id") == [("a",), ("b",), ("c",)]
    edge = next_edge(first, seen, F.lit("2024-01-02").cast("date"))
    assert rows_of(edge, "id") == [("b",), ("c",)]
    # Again b and c, another c, a late row at the mark, a later one, and one that came too late.
    more = [*rows, ("c", "soon"), ("d", "2024-01-02"), ("e", "2024-01-03"), ("f", "2023-01-01")]
    assert rows_of(new(more, "2024-01-02", edge), "id") == [("c",), ("d",), ("e",)]

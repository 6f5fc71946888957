import pytest
from support import rows_of
from pyspark.sql import functions as F

from lakeconform.operators.snapshots import incremental, latest_snapshot, next_watermark
from lakeconform.functions import parse_date
from lakeconform.sources import jdbc, lake, registry
from lakeconform.sources.files import describe_frame, read_csv_raw, read_file, read_json_raw, stringify_all
from lakeconform.sources.registry import (
    SOURCES,
    Origin,
    get_source,
    read_source,
    select_sources,
)


def test_csv_stays_text_and_splittable(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_bytes(b'a,b\r\n1,"August 19, 2023"\r\n 2 ,"say ""hi"""\r\n')
    df = read_csv_raw(spark, str(path))
    assert set(df.dtypes) == {("a", "string"), ("b", "string")}
    assert rows_of(df) == [(" 2 ", 'say "hi"'), ("1", "August 19, 2023")]


def test_csv_line_breaks_in_values_need_multiline(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('a,b\n1,"x\ny"\n')
    assert rows_of(read_csv_raw(spark, str(path), multiline=True)) == [("1", "x\ny")]
    assert rows_of(read_csv_raw(spark, str(path), multiline=True, sep=";")) != [("1", "x\ny")]


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"s": 7.5, "o": {"id": 1}}, {"s": "Low"}]')
    (tmp_path / "l.json").write_text('{"s": 7.5}\n{"s": "Low"}\n')
    array = stringify_all(read_json_raw(spark, str(tmp_path / "a.json"), multiline=True))
    assert rows_of(array, "s", "o") == [("7.5", '{"id":"1"}'), ("Low", None)]
    lines = read_json_raw(spark, str(tmp_path / "l.json"), schema="s string")
    assert rows_of(lines) == [("7.5",), ("Low",)]
    with pytest.raises(ValueError, match="xml"):
        read_file(spark, "x", "xml")


def test_stringify_odd_names(spark):
    df = spark.createDataFrame([(1, [1, 2], {"a": 1})], "`x.y` int, b array<int>, c map<string,int>")
    assert rows_of(stringify_all(df)) == [("1", "[1,2]", '{"a":1}')]
    assert describe_frame(df, 2)["column_names"] == ["x.y", "b"]


def test_describing_a_frame_runs_no_job(spark):
    df = spark.range(100).selectExpr("id % 3 AS k").groupBy("k").count()
    spark.sparkContext.setJobGroup("describe", "describe")
    assert describe_frame(df) == {"columns": 2, "column_names": ["k", "count"]}
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("describe")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_csv_files_with_unlike_headers_are_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,city\n1,Lima\n")
    (tmp_path / "b.csv").write_text("city,id\nRome,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_raw(spark, str(tmp_path)).collect()


def test_a_large_lines_file_is_read_in_parts(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"s": "0123456789"}\n' * 20_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    parts = read_json_raw(spark, str(tmp_path / "l.json"), schema="s string").rdd.getNumPartitions()
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert parts > 3


def test_jdbc_needs_ranges_or_a_word_for_one_connection(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(registry, "read_jdbc", lambda *a, **k: spark.range(1))
    source = get_source("employees")
    with pytest.raises(ValueError, match="jdbc_ranges"):
        read_source(spark, source, Origin(str(tmp_path), "jdbc:x"))
    df, _ = read_source(spark, source, Origin(str(tmp_path), "jdbc:x", single_connection=True))
    assert df.count() == 1


def test_snapshot_dates_come_from_folder_names(spark, tmp_path):
    home, source = lake.Lake(str(tmp_path)), get_source("teams")
    assert lake.snapshot_dates(spark, home, source) == []
    for day in ("2024-01-02", "2024-01-01"):
        lake.write_bronze(spark.createDataFrame([("x",)], "v string"), home, source, day)
    assert lake.snapshot_dates(spark, home, source) == ["2024-01-01", "2024-01-02"]


def test_jdbc_options():
    options = jdbc.read_options("jdbc:x", "t", "id", (1, 9), 4, {"user": "u"})
    assert options["numPartitions"] == "4" and options["user"] == "u"
    assert "partitionColumn" not in jdbc.read_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc.read_options("jdbc:x", "t", partition_column="id")
    assert jdbc.write_options("jdbc:x", "t")["truncate"] == "true"


def test_registry(spark, tmp_path):
    assert len(SOURCES) == 7
    assert get_source("achievements").entity == "monthly_achievements"
    with pytest.raises(KeyError, match="employees"):
        get_source("nothing")
    picked = select_sources(["teams", "employees"], route="file", options={"json": {"multiline": True}})
    assert [s.entity for s in picked] == ["employees", "teams"]
    assert {s.route for s in picked} == {"file"}
    assert [dict(s.options) for s in picked] == [{}, {"multiline": True}]
    with pytest.raises(KeyError, match="multiline"):
        select_sources(options={"multiline": True})
    with pytest.raises(ValueError, match="JDBC"):
        read_source(spark, get_source("employees"), Origin(str(tmp_path)))


def test_staging_tables_are_filled_once(spark, tmp_path, monkeypatch):
    """No database here: reading and writing over JDBC are stood in for by a dict."""
    folder = tmp_path / "facilities"
    folder.mkdir()
    (folder / "locations.csv").write_text("location_code,city\nLOC-1,Oslo\nLOC-2,Austin\n")
    tables, asked = {}, []

    def write(df, url, table, mode="overwrite", properties=None):
        assert {kind for _, kind in df.dtypes} == {"string"}
        tables[table] = df

    def read(spark, url, table, *ranges, properties=None):
        asked.append(ranges)
        return tables[table]

    def count(spark, url, table, properties=None):
        return tables[table].count() if table in tables else 0

    monkeypatch.setattr(jdbc, "write_jdbc", write)
    monkeypatch.setattr(jdbc, "count_rows", count)
    monkeypatch.setattr(registry, "read_jdbc", read)
    ranges = {"locations": ("id", (0, 9), 2)}
    origin = Origin(str(tmp_path), "jdbc:x", jdbc_ranges=ranges)
    sources = select_sources(["locations", "teams"])
    assert registry.seed_staging(spark, sources, origin) == {"locations": 2}
    assert registry.seed_staging(spark, sources, origin) == {"locations": 0}
    assert registry.seed_staging(spark, sources, origin, force=True) == {"locations": 2}
    df, place = read_source(spark, sources[0], origin)
    assert (df.count(), place) == (2, "jdbc:staging.locations")
    assert asked == [("id", (0, 9), 2)]


def test_bronze_rerun_replaces_one_date(spark, tmp_path):
    home, source = lake.Lake(str(tmp_path)), get_source("teams")

    def load(value, day):
        df = spark.createDataFrame([(value,)], "v string")
        return lake.write_bronze(df, home, source, day)

    load("old", "2024-01-01")
    load("first", "2024-01-02")
    path = load("second", "2024-01-02")
    assert path.endswith("ingest_date=2024-01-02")
    assert lake.count_written(spark, path) == 1
    everything = lake.read_bronze(spark, home, "teams")
    assert rows_of(everything, "v") == [("old",), ("second",)]
    assert rows_of(lake.read_bronze(spark, home, "teams", "2024-01-01"), "v") == [("old",)]
    assert rows_of(latest_snapshot(everything)) == [("second",)]
    assert rows_of(latest_snapshot(everything, "2024-01-01")) == [("old",)]
    assert rows_of(latest_snapshot(everything, "1999-01-01")) == [("second",)]
    plan = latest_snapshot(everything)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingest_date" in plan


def test_stamps(spark):
    df = spark.createDataFrame([("a", "stale")], "v string, _batch_id string")
    bronze = lake.stamp_bronze(df, "sys", "ent", "/p", "file", "b1")
    row = bronze.first()
    assert (row._batch_id, row._source_file, row._source_layer) == ("b1", "/p", "file")
    silver = lake.stamp_silver(bronze, "entity", "sys").first()
    assert (silver._batch_id, silver._source_layer, silver._source_entity) == ("b1", "bronze", "entity")
    gold = lake.stamp_gold(df, "b2").first()
    assert (gold._batch_id, gold._source_layer) == ("b2", "silver")
    assert lake.business_columns(bronze) == ["v"]


def test_dataset_write_options(spark, tmp_path):
    df = spark.range(4).selectExpr("id", "id % 2 AS part")
    lake.write_dataset(df, str(tmp_path / "d"), partition_by=["part"], coalesce=1)
    assert len(list((tmp_path / "d").glob("part=*/*.parquet"))) == 2
    assert lake.count_written(spark, str(tmp_path / "nowhere")) == 0


def test_settled_tables_go_to_the_shared_folder(spark, tmp_path):
    home = lake.Lake(str(tmp_path))
    shared = spark.conf.get("spark.checkpoint.dir")
    assert lake.stage_root(spark, home).startswith(shared)
    settled = lake.settle(spark.range(3), home, "x", "b1")
    assert settled.count() == 3
    assert shared in settled.inputFiles()[0]


def test_incremental(spark):
    df = spark.createDataFrame([("2024-01-01",), ("02/03/2024",), ("junk",)], "d string")
    new = incremental(df, "d", F.lit("2024-01-15").cast("date"), parse_date)
    assert rows_of(new) == [("02/03/2024",)]
    assert str(next_watermark(df, "d", parse_date).first()[0]) == "2024-02-03"

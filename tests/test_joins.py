import pytest
from support import rows_of

from lakeconform.operators.attribution import attribute_unique, attribution_summary
from lakeconform.operators.joins import enrich


@pytest.fixture
def no_broadcast(spark):
    names = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8KB",
    }
    for name, value in names.items():
        spark.conf.set(name, value)
    yield
    for name in names:
        spark.conf.unset(name)


def test_left_rows_are_kept_once(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i int, k string")
    right = spark.createDataFrame([("a", 10), ("c", 30)], "key string, v int")
    got = enrich(left, right, {"k": "key"})
    assert got.columns == ["i", "k", "v"]
    assert rows_of(got) == [(1, "a", 10), (2, "b", None), (3, None, None)]


def test_two_columns_and_same_name(spark):
    left = spark.createDataFrame([("a", 1), ("a", None)], "k string, n int")
    right = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y")], "k string, n int, v string")
    assert rows_of(enrich(left, right, ["k", "n"])) == [("a", 1, "x"), ("a", None, None)]


def test_frequent_key_is_split_even_beside_an_aggregate(spark, no_broadcast):
    """The right side comes out of an aggregate on the same key; the join must still be able
    to split the frequent key of the left side."""
    left = spark.range(0, 200000, 1, 8).selectExpr(
        "IF(id % 3 = 0, id, 5) AS k", "uuid() AS payload"
    )
    right = spark.range(0, 3000, 1, 4).selectExpr("id % 1000 AS key").groupBy("key").count()
    joined = enrich(left, right, {"k": "key"})
    rows = joined.collect()
    assert len(rows) == 200000
    assert {r["count"] for r in rows if r.k == 5} == {3}
    # The plan of the executed frame shows what adaptive execution did.
    assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()


FACTS = "sk string, source_team_id string, team_name string, reported_by string"


def test_attribution(spark):
    teams = spark.createDataFrame(
        [("TM-1", "Red"), ("TM-2", "Red"), ("TM-3", "Blue")], "team_id string, team_name string"
    )
    memberships = spark.createDataFrame(
        [
            ("one@x", "TM-1"),
            ("one@x", "TM-1"),
            ("one@x", "TM-3"),
            ("two@x", "TM-1"),
            ("two@x", "TM-2"),
            ("gone@x", "TM-9"),
            (None, "TM-1"),
        ],
        "employee_email string, team_id string",
    )
    facts = spark.createDataFrame(
        [
            ("f1", "TM-7", "Red", "one@x"),
            ("f2", None, "Red", "one@x"),
            ("f3", None, "Red", "two@x"),
            ("f4", None, "Blue", "two@x"),
            ("f5", None, "Blue", "one@x"),
            ("f6", None, None, "one@x"),
            ("f7", None, "Red", None),
            ("f8", None, "Red", "gone@x"),
            ("f2", None, "Red", "one@x"),
        ],
        FACTS,
    )
    done = attribute_unique(facts, memberships, teams)
    assert done.columns == [*facts.columns, "team_id", "team_id_origin"]
    via, no = "RESOLVED_VIA_REPORTER", "UNRESOLVED"
    assert rows_of(done, "sk", "team_id", "team_id_origin") == sorted(
        [
            ("f1", "TM-7", "SOURCE"),
            ("f2", "TM-1", via),
            ("f2", "TM-1", via),
            ("f3", None, no),
            ("f4", None, no),
            ("f5", "TM-3", via),
            ("f6", None, no),
            ("f7", None, no),
            ("f8", None, no),
        ],
        key=repr,
    )
    assert tuple(attribution_summary(done).first()) == (8, 3, 5)

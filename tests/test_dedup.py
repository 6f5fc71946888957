import random

from support import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeconform.operators.dedup import deduplicate, keep_first, surplus_rows
from lakeconform.operators.identity import dominant_value, unify_people


def test_order_decides(spark):
    df = spark.createDataFrame([("oak", "south", 4), ("oak", "north", 9), ("elm", "west", 1)], "tree string, side string, rings int")
    kept, dropped = deduplicate(df, ["tree"], ["-rings"])
    assert rows_of(kept, "tree", "side") == [("elm", "west"), ("oak", "north")]
    assert rows_of(dropped) == [("oak", "south", 4, "duplicate_business_key[tree]")]


def test_nulls_come_last_and_form_one_key(spark):
    df = spark.createDataFrame([(None, None), (None, 3), ("a", None)], "id string, n int")
    kept, dropped = deduplicate(df, ["id"], ["n"])
    assert rows_of(kept) == [("a", None), (None, 3)]
    assert rows_of(dropped, "id", "n") == [(None, None)]


def test_without_keys_everything_stays(spark):
    df = spark.range(3)
    kept, dropped = deduplicate(df, [])
    assert (kept.count(), dropped.count()) == (3, 0)


def test_where_rows_never_win(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "id string, n int")
    assert rows_of(keep_first(df, ["id"], ["n"], where="n > 1")) == [("a", 2)]


rows = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.sampled_from([1, 2, None]),
        st.sampled_from(["x", "y", None]),
    ),
    max_size=25,
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows, parts=st.integers(1, 5))
def test_kept_and_dropped_are_the_input(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(parts)
    kept = keep_first(df, ["k"], ["n"])
    dropped = surplus_rows(df, ["k"], ["n"], slices=3)
    assert sorted(map(repr, rows)) == sorted(
        repr(tuple(r)) for r in [*kept.collect(), *dropped.collect()]
    )
    last = (float("inf"), "~")

    def order(row):
        return (last[0] if row[1] is None else row[1], row[2] or last[1])

    expected = {k: min((r for r in rows if r[0] == k), key=order) for k in {r[0] for r in rows}}
    assert {r[0]: tuple(r) for r in kept.collect()} == expected


def test_hot_key_is_sliced(spark):
    """A key with most rows, many of them exact copies, is spread over tasks and kept whole."""
    df = spark.range(0, 60000, 1, 8).selectExpr(
        "IF(id % 3 = 0, id, -1) AS k", "IF(id % 2 = 0, 7, id) AS n"
    )
    sliced = surplus_rows(df, ["k"], ["n"])
    assert sliced.count() == 60000 - df.select("k").distinct().count()
    kept = keep_first(df, ["k"], ["n"])
    assert kept.count() + sliced.count() == 60000
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_shuffled_input_gives_the_same_rows(spark):
    data = [(random.Random(i).choice("abc"), i % 4, str(i % 3)) for i in range(60)]
    results = []
    for seed in range(3):
        shuffled = random.Random(seed).sample(data, len(data))
        df = spark.createDataFrame(shuffled, "k string, n int, v string").repartition(seed + 1)
        kept, dropped = deduplicate(df, ["k"], ["n"])
        results.append((rows_of(kept), rows_of(dropped)))
    assert results[0] == results[1] == results[2]


PEOPLE = "id string, full_name string, email string, location_code string, status string, extra string"


def people(spark, rows, id_name, extra_name):
    df = spark.createDataFrame(rows, PEOPLE)
    return df.withColumnsRenamed({"id": id_name, "extra": extra_name})


def test_unify_people_precedence(spark):
    employees = people(
        spark,
        [
            ("EMP-2", "A", "a@x.com", "L", "ACTIVE", "D"),
            ("EMP-1", "A", "a@x.com", "L", "TERMINATED", "D"),
            ("EMP-3", "N", None, "L", "ACTIVE", "D"),
            ("EMP-5", "C", "c@x.com", "L", "TERMINATED", "D"),
        ],
        "emp_id",
        "department",
    )
    contractors = people(
        spark,
        [
            ("CTR-1", "A", "a@x.com", "L", "ACTIVE", "G"),
            ("CTR-2", "B", "b@x.com", "L", "ENDED", "G"),
            ("CTR-9", "C", "c@x.com", "L", "ACTIVE", "G"),
        ],
        "contractor_id",
        "agency",
    )
    kept, lost = unify_people(employees, contractors)
    assert rows_of(kept, "email", "person_id", "staff_type") == [
        ("a@x.com", "EMP-2", "DIRECT"),
        ("b@x.com", "CTR-2", "NON_DIRECT"),
        ("c@x.com", "EMP-5", "DIRECT"),
    ]
    assert {r.person_id for r in lost.collect()} == {"EMP-1", "CTR-1", "CTR-9"}
    assert {r._rejection_reason for r in lost.collect()} == {"duplicate_email_lower_precedence"}


def test_people_keep_their_batch(spark):
    employees = people(spark, [("EMP-1", "A", "a@x.com", "L", "ACTIVE", "D")], "emp_id", "department")
    contractors = people(spark, [], "contractor_id", "agency")
    kept, _ = unify_people(
        employees.withColumn("_batch_id", F.lit("b1")),
        contractors.withColumn("_batch_id", F.lit("b2")),
    )
    assert kept.first()._batch_id == "b1"


def test_dominant_value(spark):
    df = spark.createDataFrame(
        [("t", "b"), ("t", "a"), ("t", "a"), ("t", "b"), ("t", None), ("u", None), ("v", "c")],
        "team string, place string",
    )
    got = rows_of(dominant_value(df, ["team"], "place"))
    assert got == [("t", "a", 2), ("v", "c", 1)]

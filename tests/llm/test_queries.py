"""The registered queries over the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from lakeconform.llm import queries

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def test_all_operators_and_the_pipeline_are_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [*[f"op{n}" for n in range(1, 14)], "pipeline"]
    assert set(names) <= entry.queries().keys()


@pytest.mark.parametrize(("name", "table"), [("op8_warc", "pages"), ("op13_prefix_trie", "conversations")])
def test_against_sql(spark, name, table):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    found = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    df = queries.queries()[name](spark, SF_DIR)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(map(repr, map(tuple, df.select(*columns).collect()))) == sorted(
        map(repr, found.fetchall())
    )


def test_the_pipeline_keeps_most_documents(spark):
    total = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = queries.queries()["pipeline"](spark, SF_DIR).collect()
    assert 0.5 * total < len(rows) < total
    assert len({r.doc_id for r in rows}) == len(rows)

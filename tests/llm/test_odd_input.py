"""Every operator and stage on nulls, empty and long texts, repeated rows and empty tables."""

import public_tokenizers
import pytest

import corpus_pipeline
from lakeconform.llm import (
    alignment,
    bpe,
    common,
    decontaminate,
    importance,
    line_dedup,
    ngram_join,
    ownership,
    pii,
    quality_rules,
    sharding,
    toxicity,
    warc,
)

PATH = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture
def labels(spark):
    rows = [(0, 1, 0), (5, 1, 0), (5, 0, 1), (90, None, None), (None, 1, 0)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


@pytest.fixture
def bench(spark):
    return spark.createDataFrame([(None, "nothing like it"), (2, None)], "item_id bigint, text string")


def every_operator(docs, labels, bench):
    return {
        1: lambda: quality_rules.apply_rules(docs),
        2: lambda: ownership.digest(ownership.find_secrets(docs)),
        3: lambda: importance.resample(docs, labels),
        4: lambda: decontaminate.scan(docs, bench, ["doc_id"]),
        5: lambda: line_dedup.remove_repeats(docs),
        6: lambda: pii.digest(pii.find_personal(docs)),
        7: lambda: ngram_join.alike_documents(docs),
        8: lambda: warc.archive_and_read(docs.selectExpr("doc_id AS page_id", "lang AS url", "text AS html", "*")),
        9: lambda: sharding.shard_documents(docs),
        10: lambda: bpe.encode_documents(docs, PATH),
        11: lambda: toxicity.score_documents(docs, labels),
        12: lambda: alignment.align_documents(docs, PATH, PIECES),
    }


@pytest.mark.parametrize("n", range(1, 13))
def test_odd_rows_come_out_once_each(odd_docs, labels, bench, n):
    found = every_operator(odd_docs, labels, bench)[n]().collect()
    ids = sorted(r[0] if r[0] is not None else -1 for r in found)
    assert ids == sorted([*range(8), 90, 90, -1, -1])


@pytest.mark.parametrize("n", range(1, 13))
def test_empty_tables_give_empty_results(stored_docs, labels, bench, n):
    empty = stored_docs([])
    assert every_operator(empty, labels.limit(0), bench.limit(0))[n]().collect() == []


def test_defined_results_of_odd_rows(odd_docs):
    lines = {(r.doc_id, r.n_removed, r.kept) for r in line_dedup.remove_repeats(odd_docs).collect()}
    assert (90, 0, True) in lines and (90, 1, False) in lines
    alike = ngram_join.alike_documents(odd_docs).collect()
    assert {r.component_id for r in alike if r.doc_id in (0, 1, 2, 4)} == {0, 1, 2, 4}
    assert [r.n_shingles for r in alike if r.doc_id is None] == [1, 1]
    assert ngram_join.keep_one(odd_docs).count() == 10


def test_row_numbers_do_not_depend_on_the_splits(spark, tmp_path):
    rows = [(i, f"text {i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df.write.option("parquet.block.size", 1024).parquet(str(tmp_path / "d"))
    seen = []
    try:
        for parts in (1, 40):
            spark.conf.set("spark.sql.files.minPartitionNum", parts)
            spark.conf.set("spark.sql.files.openCostInBytes", "0")
            rows = ngram_join.positioned(spark.read.parquet(str(tmp_path / "d")))
            seen.append((rows.rdd.getNumPartitions(), {r.doc_id: r._row for r in rows.collect()}))
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert seen[0][0] != seen[1][0] and seen[0][1] == seen[1][1]
    assert len(set(seen[0][1].values())) == 400
    plain = common.placed(spark.range(50).repartition(4))
    assert len({r._row for r in plain.collect()}) == 50


@pytest.mark.parametrize("make", ["odd", "empty"])
def test_stages_take_odd_documents(spark, odd_docs, stored_docs, tmp_path, labels, bench, make):
    docs = odd_docs if make == "odd" else stored_docs([])
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        after = stage(spark, docs, str(tmp_path))
        assert after.columns == docs.columns
        after.write.parquet(str(tmp_path / f"stage{i}"))
        docs = spark.read.parquet(str(tmp_path / f"stage{i}"))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path))
    assert last.count() == docs.count() == (10 if make == "odd" else 0)

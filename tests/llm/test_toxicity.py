"""Operator 11: features by hand, held-out accuracy, and what a score may depend on."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from lakeconform.llm import toxicity
from lakeconform.llm.textarrays import ALNUM, words_of

LABELS = "doc_id bigint, quality int, toxic int"
BAD = ("vermin", "dimwit", "garbage")
PLAIN = "the river runs past old mills and quiet fields where herons wait".split()


def corpus(n=400):
    draw, texts, labels = random.Random(5), [], []
    for i in range(n):
        words = [draw.choice(PLAIN) for _ in range(draw.randint(20, 60))]
        toxic = i % 4 == 0
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(BAD)
        texts.append(" ".join(words))
        labels.append((i, 1, int(toxic)))
    return texts, labels


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


@pytest.fixture(scope="module")
def rows():
    return corpus()


def test_scores_of_held_out_documents(spark, stored_docs, rows):
    texts, labels = rows
    docs = stored_docs([*texts, texts[0], None, ""], clash=True)
    scored = by_id(toxicity.score_documents(docs, spark.createDataFrame(labels, LABELS)))
    assert len(scored) == len(texts) + 3
    held = [i for i, _, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i, r in scored.items() if r.held_out and i < len(texts)} == set(held)
    toxic = [i for i in held if labels[i][2]]
    clean = [i for i in held if not labels[i][2]]
    assert len(toxic) > 20 and len(clean) > 60
    assert np.mean([scored[i].predicted for i in toxic]) > 0.9
    assert np.mean([scored[i].predicted for i in clean]) < 0.05
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in scored.values())
    assert scored[len(texts)].score == scored[0].score
    assert scored[len(texts) + 1].score == scored[len(texts) + 2].score
    # Labels of held-out rows, languages and sources make no difference.
    other = [(i, 0, 1 - t if i in set(held) else t) for i, _, t in labels]
    docs = stored_docs([*texts, texts[0], None, ""], sources=[str(i) for i in range(len(texts) + 3)])
    again = by_id(toxicity.score_documents(docs, spark.createDataFrame(other, LABELS)))
    assert {i: r.score for i, r in again.items()} == {i: r.score for i, r in scored.items()}


def test_without_enough_labels_all_scores_are_the_share(spark, stored_docs):
    docs = stored_docs(["a", "b", None])
    none = toxicity.score_documents(docs, spark.createDataFrame([], LABELS))
    assert {(r.score, r.predicted) for r in none.collect()} == {(0.0, 0)}
    few = spark.createDataFrame([(0, 1, 1), (1, 1, 0), (2, None, None), (None, 1, 1)], LABELS)
    assert len({r.score for r in toxicity.score_documents(docs, few).collect()}) == 1
    assert toxicity.score_documents(stored_docs([]), few).collect() == []


def test_features_by_hand():
    word = words_of(pa.array(["dimwit"]), ALNUM).hashes
    lexicon = toxicity.Lexicon(word, np.array([[0.0, 2, 2, 2, 2, 3.0]]))
    texts = pa.array(["You DIMWIT!! dimwit", "calm", "d1mw!t and dim-wit", None, "s t u p", "dimwit"])
    column = np.array([5, 5, 5, 5, 5, 0])
    found = toxicity.features_of(texts, lexicon, column)
    at = {name: found[:, i] for i, name in enumerate(toxicity.FEATURES)}
    assert at["lexicon_distinct"].tolist() == [1, 0, 0, 0, 0, 0]  # the fold's own weight is zero
    assert at["lexicon_density"][0] == pytest.approx(2000 / 3)
    assert at["lexicon_weight"][0] == at["lexicon_top"][0] == 3.0
    assert at["reader_rate"][0] == pytest.approx(1000 / 3) and at["reader_near"][0] == pytest.approx(2000 / 3)
    assert at["hidden_weight"].tolist() == [0, 0, 3.0, 0, 0, 0] and at["hidden_density"][2] > 0
    assert at["exclaim_rate"][0] == pytest.approx(2000 / 19) and at["sign_run_rate"][0] > 0
    assert at["capital_rate"][0] == pytest.approx(7 / 15) and at["shout_rate"][0] > 0
    assert at["spaced_rate"][4] > 0 and not found[3].any()

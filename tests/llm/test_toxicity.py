import random
from pathlib import Path

import numpy as np
import pytest

from stratavault.llm import toxicity
from stratavault.llm.quality import held_out

LABELS = "doc_id bigint, quality int, toxic int"
DATA = Path("/root/testdata/sf0.01")


def test_words_and_terms():
    assert toxicity.word_counts("The, the... (Cat)!\n -- é") == {"the": 2, "cat": 1, "é": 1}
    assert toxicity.terms_of("abcdef") == ["=abcdef", "abcd", "abcde"] and toxicity.terms_of("ab") == ["=ab"]


def test_later_categories_read_earlier_ones():
    rng = np.random.default_rng(0)
    x = np.column_stack([rng.normal(size=(600, 3)), np.ones(600)])
    first = (x[:, 0] > 0).astype(float)
    weights, outside = toxicity.fit(x, np.column_stack([first, first]), np.arange(600) % 3)
    assert [len(w) for w in weights] == [4, 5] and weights[1][4] > 0.5
    assert np.mean((outside > 0) == first) > 0.97
    out = toxicity.predict(x, weights)
    assert out.shape == (600, 2) and np.mean((out[:, 1] > 0.5) == first) > 0.97


@pytest.fixture
def labelled(spark, docs):
    rng = random.Random(6)
    plain = [f"word{i}" for i in range(40)]

    def text(toxic):
        words = rng.choices(plain, k=rng.randint(20, 60))
        return " ".join(words[:10] + (["vilest!!", "Vile"] if toxic else []) + words[10:])
    rows = [(i, text(i % 4 == 0)) for i in range(300)] + [(500, None), (501, ""), (502, "word1 " * 100_000 + "vile vile"), (None, "vile word3 vilest"), (0, text(True))]
    return docs(*rows), spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(300)] + [(None, 1, 1), (3, None, None), (9999, 1, 1)], LABELS)


def test_labels_are_learnt_and_edge_cases_judged(labelled, clashing):
    frame, labels = labelled
    found = toxicity.judged(clashing(frame), labels).collect()
    assert len(found) == 305
    assert all(r.toxic == int(r.doc_id % 4 == 0) for r in found if r.doc_id is not None and r.doc_id < 300)
    rest = {r.doc_id: r.toxic for r in found if r.doc_id is None or r.doc_id >= 500}
    assert rest[None] == 1 and rest[500] == rest[501] == 0


def test_one_kind_of_labels_and_no_rows(labelled):
    frame, labels = labelled
    assert {(r.p_toxic, r.toxic) for r in toxicity.judged(frame, labels.where("toxic = 0")).collect()} == {(0.0, 0)}
    assert toxicity.judged(frame.where("false"), labels).collect() == []


@pytest.mark.skipif(not DATA.exists(), reason="no test data")
def test_held_out_documents(spark):
    from stratavault.llm.queries import op5_toxicity
    labels = spark.read.parquet(f"{DATA}/labels.parquet").withColumnRenamed("toxic", "label")
    rows = op5_toxicity(spark, str(DATA)).join(labels, "doc_id").where(held_out(labels["doc_id"])).collect()
    assert np.mean([r.toxic == r.label for r in rows]) > 0.95
    assert np.mean([r.toxic for r in rows if r.label == 0]) < 0.01

"""The cut of the classifier, and what its training sample holds."""

from collections import Counter

import numpy as np

import corpus_pipeline
from vitrine.llm import toxicity
from vitrine.llm.toxicity import OrdinalModel

WITHOUT = [None, "", "nothing of note"]


def scored(spark, model, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.text: r.toxic for r in toxicity.score(docs, model).collect()}


def test_no_telling_word(spark, tmp_path):
    """Too few labels for any word to tell: the stage keeps all documents, null and empty texts too."""
    rows = [(i, f"word{i} and more") for i in range(10)] + [(10 + i, t) for i, t in enumerate(WITHOUT)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.createDataFrame([(i, int(i == 3)) for i in range(10)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert {r.doc_id for r in corpus_pipeline.drop_toxic(spark, docs, str(tmp_path)).collect()} == set(range(13))


def test_cut_keeps_ties_together(spark):
    """Toxic documents without a telling word come first among the equal ones: the cut stays above all of these."""
    model = OrdinalModel({"bad": 5.0, "good": -1.0}, [2.0, 4.0], 0.5)
    for n_toxic in (1, 2, 5):
        counts = [Counter(bad=1)] * 3 + [Counter(other=1)] * (n_toxic + 20) + [Counter(good=1)] * 2
        grades = np.array([2] * 3 + [1] * n_toxic + [0] * 22)
        model.cut = toxicity._cut(model, counts, grades)
        assert model.severity("other") < model.cut < model.severity("bad")
        assert scored(spark, model, ["bad", *WITHOUT, "good"]) == {"bad": True, **dict.fromkeys(WITHOUT, False), "good": False}


def test_cut_without_two_severities():
    model = OrdinalModel({"bad": 5.0}, [2.0], 0.5)
    for counts, grades in (([Counter(other=1)] * 4, [1, 0, 0, 1]), ([Counter(bad=1)] * 3, [1, 1, 1]), ([Counter(bad=1), Counter(other=1)], [0, 1]), ([], [])):
        assert toxicity._cut(model, counts, np.array(grades, int)) == float("inf")
    assert toxicity._cut(OrdinalModel({}, [2.0], 0.5), [Counter(bad=1)] * 3, np.array([1, 0, 0])) == float("inf")


def test_long_texts_leave_the_rest_of_the_sample(spark, monkeypatch):
    """Texts that would fill the training sample alone are passed over; the others are learned from."""
    monkeypatch.setattr(toxicity, "MAX_TRAIN_CHARS", 20_000)
    monkeypatch.setattr(toxicity, "MAX_TEXT_CHARS", 10_000, raising=False)
    rows = [(i, f"word{i} " + ("bad" if i % 2 else "good")) for i in range(60)] + [(100 + i, "long " * 6_000) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60 and i % 2)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, max_train=60)
    assert {r.doc_id for r in toxicity.score(docs, model).where("toxic").collect()} == set(range(1, 60, 2))

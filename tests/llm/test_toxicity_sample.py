"""Operator 8: one very long labelled text doesn't take others out of the training sample."""

import random

import pytest

from shelfsense.llm import toxicity
from shelfsense.llm.labelled import training_ids

LABELS = "doc_id bigint, toxic int"


def corpus(spark, long_ids, chars=40_000):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdeimnorst") for _ in range(5))
    vocab = [word() for _ in range(200)]
    rows = [(i, "vilethug " * (i % 2) + " ".join(r.choice(vocab) for _ in range(30))) for i in range(400)]
    rows = [(i, t + " " + "long " * (chars // 5) if i in long_ids else t) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame([(i, i % 2) for i in range(400)], LABELS)


def test_long_text_gives_way_alone(spark):
    labels = corpus(spark, ())[1]
    first = [x.doc_id for x in training_ids(labels, "toxic", 100, per_class=True).collect()]
    docs, labels = corpus(spark, first[:1])
    got = toxicity.sample(docs, labels, 100, 30_000)[0].collect()
    ids = {x.doc_id for x in got}
    assert len(got) == 100 and sum(x.y for x in got) == 50 and sum(len(x.text) for x in got) <= 30_000
    assert set(first[1:]) <= ids and first[0] not in ids


def test_one_long_text_early_in_hash_order_leaves_a_model(spark):
    labels = corpus(spark, ())[1]
    order = [x.doc_id for x in training_ids(labels, "toxic", 400).collect()]
    docs, labels = corpus(spark, order[:1], toxicity.MAX_TRAIN_CHARS + 10)
    model = toxicity.fit(docs, labels)
    assert model is not None
    words = toxicity.WordScores(model.weight)
    assert toxicity.score_texts(["vilethug"], words, model.offset)[0] > 0.5


def test_a_class_without_a_usable_text_is_an_error(spark):
    docs, labels = corpus(spark, range(1, 400, 2))
    with pytest.raises(ValueError, match="both classes"):
        toxicity.fit(docs, labels, most=30_000)


def test_row_limit():
    assert toxicity.row_limit([5, 5, 5], 15) is None and toxicity.row_limit([None, 4], 4) is None
    assert toxicity.row_limit([1, 2, 100], 13) == 10 and toxicity.row_limit([9, 9, 9], 15) == 5
    assert toxicity.row_limit([1, None, 100], 13) == 6

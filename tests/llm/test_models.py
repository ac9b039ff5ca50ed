"""Classifiers: exact parts against plain versions, learned parts on held-out rows."""

import numpy as np
import pytest

from stratamart.llm import language_id, quality_classifier, quality_rules, toxicity
from stratamart.llm.common import bounded_labels, crc_mod, one_label
from stratamart.llm.features import HashedText

from . import brute
from .fixtures import awkward, frame, junk, prose

INSULTS = ["idiot", "scumbag", "pathetic"]


@pytest.fixture(scope="session")
def graded(spark):
    """Good, good but toxic, and bad texts, with labels."""
    rows, labels = [], []
    for i in range(360):
        lang = "fr" if i % 4 == 1 else "en"
        text, quality, toxic = prose(i, 80, lang=lang), 1, 0
        if i % 5 == 0:
            text, quality = junk(i, 80), 0
        elif i % 3 == 0:
            text, toxic = f"{text} {INSULTS[i % 2]} {prose(i + 999, 30, lang=lang)} {INSULTS[i % 3]}", 1
        rows.append((i, text, lang, "a"))
        labels.append((i, quality, toxic))
    labels += [(0, 0, 0), (None, 1, 0), (7, None, None)]
    return frame(spark, rows).repartition(3).cache(), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").cache()


def test_base_counts_match_the_plain_version():
    texts = [r[1] or "" for r in awkward()] + [junk(3, 40), "a b c a b c a b c", "a b c d", "# $ <x>\nq\nq\n q\n\n\n", "é a b é a b é"]
    for text in texts:
        assert quality_rules.base_counts(text.encode()) == brute.base_counts(text)


def test_hashed_rows_agree_with_scores():
    from stratamart.llm.common import text_bytes
    import pyarrow as pa

    data, offsets = text_bytes(pa.array([r[1] for r in awkward()]))
    rng = np.random.default_rng(1)
    for features in (HashedText(bits=8, sizes=(3, 5), echoes=True), HashedText(bits=8, prefixes=(2, 4), lower=True, letters_only=True)):
        weights = rng.normal(size=features.slots).astype(np.float32)
        for present, scores in ((False, features.mean_scores), (True, features.presence_scores)):
            rows = features.sparse_rows(data, offsets, present=present)
            want = [float((weights[s] * v).sum()) for s, v in rows]
            assert np.allclose(scores(data, offsets, weights), want, atol=1e-3)


def test_grouping_of_texts_does_not_matter():
    import pyarrow as pa
    from stratamart.llm.common import text_bytes

    features = HashedText(bits=10, sizes=(4,))
    weights = np.random.default_rng(2).normal(size=features.slots).astype(np.float32)
    texts = [prose(i, 50 * i) for i in range(30)]
    whole = features.mean_scores(*text_bytes(pa.array(texts)), weights)
    alone = [features.mean_scores(*text_bytes(pa.array([t])), weights)[0] for t in texts]
    assert np.allclose(whole, alone, atol=1e-6)


def test_quality_rules(graded, docs, empty):
    texts, labels = graded
    model = quality_rules.train(texts, labels)
    rows = quality_rules.judge(texts, model).collect()
    wrong = [r for r in rows if r["kept"] != (r["doc_id"] % 5 != 0)]
    assert len(wrong) <= 4
    assert all(0 <= r["probability"] <= 1 for r in rows)
    mean = np.mean([r["probability"] for r in rows])
    assert abs(mean - 0.8) < 0.1  # calibrated
    awkward_rows = quality_rules.judge(docs, model).collect()
    assert len(awkward_rows) == len(awkward())
    assert not any(r["kept"] for r in awkward_rows if r["n_words"] < 50)
    kept = quality_rules.keep_good(docs, model)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in awkward_rows if r["kept"])
    assert quality_rules.judge(empty, model).count() == 0 and quality_rules.keep_good(empty, model).count() == 0


def test_models_without_labels(docs, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int, grade int")
    assert quality_rules.judge(docs, quality_rules.train(docs, none)).filter("kept = base_failed").count() == 0
    assert quality_classifier.score(docs, quality_classifier.train(docs, none)).filter("not kept").count() == 0
    assert toxicity.score(docs, toxicity.train(docs, none)).filter("predicted <> 0").count() == 0


def test_ordinal_grades(graded, docs, empty):
    texts, labels = graded
    grades = quality_classifier.graded(labels)
    assert {r["grade"] for r in grades.collect()} == {0, 1, 2, None}
    model = quality_classifier.train(texts, grades)
    assert len(model.thresholds) == 2 and model.thresholds[0] < model.thresholds[1]
    rows = {r["doc_id"]: r for r in quality_classifier.score(texts, model).collect()}
    assert sum(rows[i]["kept"] != (i % 5 != 0) for i in rows) <= 4
    grade = lambda i: 0 if i % 5 == 0 else 1 if i % 3 == 0 else 2
    means = [np.mean([rows[i]["expected_grade"] for i in rows if grade(i) == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    kept = quality_classifier.select(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == quality_classifier.score(docs, model).filter("kept").count()
    assert quality_classifier.score(empty, model).count() == 0


def test_ordinal_gradient():
    """The fit lowers the likelihood loss to that of a separable problem."""
    from stratamart.llm.features import Sparse

    rng = np.random.default_rng(0)
    value = rng.uniform(-1, 1, 300)
    grade = np.digitize(value, [-0.3, 0.4])
    x = Sparse(np.zeros(300, np.int32), value.astype(np.float32), np.arange(301))
    weights, thresholds = quality_classifier.fit(x, grade, 1, steps=600)
    found = np.digitize(x.dot(weights), thresholds)
    assert (found == grade).mean() > 0.95 and weights[0] > 0


def test_toxicity_learns_from_positives_and_unlabelled(graded, docs, empty):
    texts, labels = graded
    held = crc_mod("doc_id", 4) == 2
    model = toxicity.train(texts, labels.filter(~held))
    rows = toxicity.score(texts, model).filter(held).collect()
    toxic = {r["doc_id"] for r in labels.collect() if r["toxic"] == 1}
    caught = [r["predicted"] for r in rows if r["doc_id"] in toxic]
    clean = [r["predicted"] for r in rows if r["doc_id"] not in toxic]
    assert np.mean(caught) > 0.9 and np.mean(clean) < 0.05
    scored = toxicity.score(docs, model).collect()
    assert len(scored) == len(awkward()) and all(0 <= r["score"] <= 1 for r in scored)
    assert toxicity.score(empty, model).count() == 0


def test_risk_is_never_driven_below_zero():
    from stratamart.llm.features import Sparse

    one = Sparse(np.zeros(20, np.int32), np.ones(20, np.float32), np.arange(21))
    none = Sparse(np.zeros(0, np.int32), np.zeros(0, np.float32), np.zeros(21, np.int64))
    weights, bias = toxicity.fit(one, none, 0.2, 1)
    assert weights[0] > 0 and np.isfinite(bias)


def test_language(docs, empty):
    profiles = language_id.train(docs.filter("doc_id % 2 = 0"))
    assert profiles.languages == ["en", "fr"]
    rows = {r["doc_id"]: r for r in language_id.predict(docs, profiles).collect()}
    assert all(rows[r[0]]["lang_pred"] == r[2] for r in awkward() if (r[0] or 0) >= 100)
    for blank in (1, 2, 3, 16):
        assert (rows[blank]["lang_pred"], rows[blank]["score"]) == ("und", 0.0)
    assert rows[4]["lang_pred"] in ("en", "fr") and all(0 <= r["score"] <= 1 for r in rows.values())
    assert language_id.predict(empty, profiles).count() == 0
    nobody = language_id.train(docs.filter("lang is null"))
    assert language_id.predict(docs, nobody).filter("lang_pred <> 'und'").count() == 0


def test_grams_and_ranks():
    code, count = language_id.grams("Ab, ab 12")
    from collections import Counter

    want = Counter()
    text = " ab ab "
    for size in (1, 2, 3):
        for i in range(len(text) - size + 1):
            gram = text[i:i + size]
            if gram == " " or (size == 3 and gram[1] == " "):
                continue
            want[sum(ord(c) << 21 * (size - 1 - k) for k, c in enumerate(gram))] += 1
    assert dict(zip(code.tolist(), count.tolist())) == dict(want)
    order = sorted(want, key=lambda c: (-want[c], c))
    assert language_id.ranked(code, count).tolist() == order
    assert language_id.ranked(code, count, 2).tolist() == order[:2]


def test_label_samples(spark):
    labels = spark.range(5000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality")
    assert bounded_labels(labels, "doc_id", 100).count() == 100
    assert bounded_labels(labels, "doc_id", 9000).count() == 5000
    twice = labels.union(labels)
    assert one_label(twice, "doc_id", "quality").count() == 5000

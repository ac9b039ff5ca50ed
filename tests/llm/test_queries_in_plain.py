"""Registered queries on a small folder of tables against plain versions, and what models are learned from."""

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from stratamart.llm import features, language_id, quality_classifier, quality_rules, registry, toxicity
from stratamart.llm.common import crc_mod
from stratamart.llm.features import Sparse

from . import brute
from .brute import WORD, sha
from .fixtures import awkward, frame, junk, prose

INSULTS = ["idiot", "scumbag", "pathetic"]


def labelled_rows():
    rows, labels = [], []
    for i in range(400, 1000):
        text, quality, toxic = prose(i, 70, lang="fr" if i % 4 == 1 else "en"), 1, 0
        if i % 5 == 0:
            text, quality = junk(i, 80), 0
        elif i % 3 == 0:
            text, toxic = f"{text} {INSULTS[i % 2]} {prose(i + 999, 30)} {INSULTS[i % 3]}", 1
        rows.append((i, text, "fr" if i % 4 == 1 else "en", "a"))
        labels.append((i, quality, toxic))
    return rows, labels


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder, (rows, labels) = str(tmp_path_factory.mktemp("tables")), labelled_rows()
    frame(spark, awkward() + rows).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, awkward() + rows


# ---- hashed features in plain Python

def slot(data, salt, bits):
    most = (1 << 64) - 1
    value = sum((b + 1) * pow(features._BASE, i, 1 << 64) for i, b in enumerate(data)) & most
    value ^= (salt * 0x9E3779B97F4A7C15) & most
    value ^= value >> 33
    value = value * int(features._MIX) & most
    value ^= value >> 29
    return (value * int(features._MIX) & most) >> (64 - bits)


def channels(spec, text):
    """Per channel the slots of a text's features."""
    data = text.encode()
    if spec.lower:
        data = re.sub(rb"[A-Z]", lambda m: m[0].lower(), data)
    words = re.findall(rb"[A-Za-z\x80-\xff]+" if spec.letters_only else rb"[^\x20\x09-\x0D]+", data)
    parts = []
    if spec.words:
        parts.append([slot(w, len(parts) + 1, spec.bits) for w in words])
        if spec.echoes:
            parts.append([int(n > 0 and parts[0][n] == parts[0][n - 1]) for n in range(len(words))])
    for size in spec.prefixes:
        parts.append([slot(w[:size], len(parts) + 1, spec.bits) for w in words if len(w) >= size])
    for size in spec.sizes:
        line = text if spec.characters else data
        grams = [line[i:i + size] for i in range(len(line) - size + 1)]
        parts.append([slot(g.encode() if spec.characters else g, len(parts) + 1, spec.bits) for g in grams])
    return parts


def plain_score(spec, weights, text, present=False):
    table, total = weights.reshape(spec.channels, -1), 0.0
    for row, found in zip(table, channels(spec, text)):
        values = row[sorted(set(found))] if present else row[found]
        total += float(values.sum() if present or not found else values.mean())
    return total


def squashed(x):
    return 1 / (1 + np.exp(-x))


SHORT = [r for r in awkward() if len(r[1] or "") < 4000]


def as_rows(df, *names):
    return Counter(tuple(round(v, 5) if isinstance(v, float) else v for v in (r[n] for n in names)) for r in df.collect())


def test_op2_probabilities_are_those_of_plain_features(spark, tables):
    folder, rows = tables
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = quality_rules.train(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    got = {(r["doc_id"], r["n_words"], r["word_chars"]): r for r in registry.op2_quality_rules(spark, folder).collect()}
    for i, text, *_ in SHORT:
        counts = brute.base_counts(text or "")
        row = got[(i, counts[0], counts[1])]
        chance = squashed(model.slope * plain_score(model.features, model.weights, text or "") + model.offset)
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert abs(row["probability"] - chance) < 1e-5 and row["base_failed"] == failed
        assert row["kept"] == (not failed and row["probability"] >= 0.35)
    assert registry.op2_quality_rules(spark, folder).count() == len(rows)


def test_op10_grades_are_those_of_plain_features(spark, tables):
    folder, rows = tables
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = quality_classifier.train(docs, quality_classifier.graded(labels))
    got = as_rows(registry.op10_quality_classifier(spark, folder), "doc_id", "expected_grade", "kept")
    assert sum(got.values()) == len(rows)
    for i, text, *_ in SHORT:
        tails = squashed(plain_score(model.features, model.weights, text or "") - model.thresholds)
        near = [k for k in got if k[0] == i and abs(k[1] - tails.sum()) < 1e-4]
        assert near and any(k[2] == (tails[0] >= 0.35) for k in near)


def test_op4_scores_are_those_of_plain_features_and_find_held_out_texts(spark, tables):
    folder, rows = tables
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = crc_mod("doc_id", 4) == 2
    model = toxicity.train(docs, labels.filter(~held), pool=docs.filter(~held))
    result = registry.op4_toxicity(spark, folder).collect()
    assert len(result) == len(rows) and all(r["predicted"] == (r["score"] >= 0.3) for r in result)
    by = {}
    for r in result:
        by.setdefault(r["doc_id"], []).append(r)
    for i, text, *_ in SHORT:
        want = squashed(plain_score(model.features, model.weights, text or "", present=True) + model.bias)
        assert any(abs(r["score"] - want) < 1e-5 for r in by[i])
    marks = {i: toxic for i, _, toxic in labelled_rows()[1]}
    caught = [r["predicted"] for r in result if r["held_out"] and marks.get(r["doc_id"]) == 1]
    clean = [r["predicted"] for r in result if r["held_out"] and marks.get(r["doc_id"]) == 0]
    assert len(caught) > 20 and np.mean(caught) >= 0.9 and np.mean(clean) <= 0.05


def test_confirmed_rows_alone_teach_toxicity(spark, tables):
    folder, _ = tables
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    held = crc_mod("doc_id", 4) == 2
    model = toxicity.train(docs, labels.filter(~held & (labels["toxic"] == 1)), pool=docs.filter(~held))
    rows = toxicity.score(docs, model).filter(held).join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 1]) >= 0.9
    assert np.mean([r["predicted"] for r in rows if r["toxic"] == 0]) <= 0.05


def test_prior_is_read_off_without_negative_labels():
    rng = np.random.default_rng(4)

    def texts(n, toxic):
        rows = []
        for _ in range(n):
            bad = rng.random() < toxic
            slots = set(rng.integers(10, 400, 40).tolist()) | (set(rng.choice(10, 4, replace=False).tolist()) if bad else set())
            rows.append((np.array(sorted(slots), np.int32).tobytes(), np.ones(len(slots), np.float32).tobytes()))
        return Sparse.of(rows)

    for share in (0.05, 0.3, 0.7):
        assert abs(toxicity.estimate_prior(texts(1500, 1.0), texts(4000, share), 400) - share) < 0.03 + 0.1 * share
    p, u = np.array([0.9, 0.6]), np.array([0.2, 0.1, 0.7])
    want = (-0.3 * np.log(p).mean(), 0.3 * np.log(1 - p).mean() - np.log(1 - u).mean())
    assert np.allclose(toxicity.risk(p, u, 0.3), want)


@pytest.mark.parametrize("height", [0.1, 1, 10, 20, 40, 400])
def test_calibration_never_ends_above_its_start(height):
    score = np.array([height] * 60 + [-height] * 40)
    y = np.array([1.0] * 60 + [0.0] * 40)
    for flips in (0, 3):
        y[:flips] = 0
        target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
        line = np.array(quality_rules.calibrate(score, y))
        loss = lambda l: quality_rules.calibration_loss(np.array(l), score, target)
        assert loss(line) <= loss([1.0, 0.0]) and line[0] > 0
        best = min(loss([a, b]) for a in np.linspace(0, 6, 61) / height for b in np.linspace(-2, 2, 41))
        assert loss(line) <= best + 1e-9


def test_models_do_not_depend_on_the_layout(spark, tables):
    folder, _ = tables
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    layouts = [(docs, labels), (docs.repartition(7, "text"), labels.repartition(5)), (docs.orderBy("text").coalesce(1), labels.coalesce(1))]
    rules = [quality_rules.train(*pair) for pair in layouts]
    toxic = [toxicity.train(*pair) for pair in layouts]
    grades = [quality_classifier.train(d, quality_classifier.graded(m)) for d, m in layouts]
    for found in (rules, toxic, grades):
        assert all(np.array_equal(found[0].weights, m.weights) for m in found[1:])
    assert {(m.slope, m.offset) for m in rules} == {(rules[0].slope, rules[0].offset)} and len({m.bias for m in toxic}) == 1


def test_an_id_on_a_third_of_the_rows_is_learned_from_once(spark):
    rows, labels = labelled_rows()
    docs = frame(spark, rows + [(401, f"again {n} {prose(n, 20)}", "en", "a") for n in range(300)])
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = quality_rules.labelled_features(docs, marks, ["quality"], quality_rules.FEATURES, 3000)
    assert len(found) == len(labels)
    assert len(quality_rules.labelled_features(docs, marks, ["quality"], quality_rules.FEATURES, 50)) == 50


# ---- the other queries

def test_op1_and_op3_queries(spark, tables):
    folder, rows = tables
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    ids = [(r[0], library.encode(r[1] or "")) for r in rows]
    assert as_rows(registry.op1_sentencepiece(spark, folder), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == Counter(
        (i, len(t), sha(",".join(map(str, t))), sha(library.decode(t) if t else "")) for i, t in ids)
    prints = {(n, r[0]): brute.simhash(r[1] or "") for n, r in enumerate(rows)}
    group = {}
    for (n, i), p in prints.items():
        group.setdefault(i if i is not None else -1, p)
    smallest = brute.components({i: p for i, p in group.items() if i >= 0})
    for r in registry.op3_simhash(spark, folder).collect():
        if r["doc_id"] is not None:
            assert (r["fingerprint"], r["component_id"]) == (f"{group[r['doc_id']]:016x}", smallest[r["doc_id"]])


def test_op6_query(spark, tmp_path):
    rows = sorted({r[:2]: r for r in awkward() if r[0] is not None}.values(), key=lambda r: r[0])
    frame(spark, rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in registry.op6_winnowing(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for (i, text, *_), (_, following, *_) in zip(rows, rows[1:] + rows[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited))
        own, new, other = (brute.marks(t, 12, 32) for t in (text, edited, following))
        assert r["n_marks"] == len(own)
        assert abs(r["near_edited"] - brute.likeness(own, new)) < 1e-9 and abs(r["near_next"] - brute.likeness(own, other)) < 1e-9
    assert len({r["fingerprint"] for r in got.values()}) == len({tuple(brute.marks(t[1] or "", 12, 32)) for t in rows})


def plain_grams(text):
    plain = re.sub(r"[\W\d_]+", " ", text).lower().strip()
    line, count = f" {plain} ", Counter()
    for size in (1, 2, 3):
        for i in range(len(line) - size + 1):
            gram = line[i:i + size]
            if gram != " " and not (size == 3 and gram[1] == " "):
                count[gram] += 1
    return count if any(map(str.isalpha, plain)) else Counter()


def plain_order(count):
    code = lambda g: sum(ord(c) << 21 * (len(g) - 1 - k) for k, c in enumerate(g))
    return sorted(count, key=lambda g: (-count[g], code(g)))[:300]


def test_op8_distances_and_choice(spark, tables):
    folder, rows = tables
    learned = {r["doc_id"] for r in spark.read.parquet(f"{folder}/documents.parquet").filter(crc_mod("doc_id", 3) != 1).collect()}
    profiles = {}
    for lang in {r[2] for r in rows} - {None}:
        total = Counter()
        for r in rows:
            if r[2] == lang and r[0] in learned:
                total += plain_grams(r[1] or "")
        profiles[lang] = {g: n for n, g in enumerate(plain_order(total))}
    want = Counter()
    for i, text, *_ in rows:
        top = plain_order(plain_grams(text or ""))
        far = {lang: sum(min(abs(p[g] - n), 300) if g in p else 300 for n, g in enumerate(top)) for lang, p in sorted(profiles.items())}
        best = min(far, key=lambda lang: (far[lang], lang)) if top else "und"
        want[(i, i not in learned, best, round(1 - far[best] / (300 * len(top)), 5) if top else 0.0)] += 1
    assert as_rows(registry.op8_language_id(spark, folder), "doc_id", "held_out", "lang_pred", "score") == want
    assert language_id.RANKS == 300

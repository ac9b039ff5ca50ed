"""Near copies by five-word Jaccard similarity against comparing all pairs."""

import random

import pytest

import corpus_pipeline
from stratamart.llm import near_copies, simhash

from .brute import WORD
from .fixtures import awkward, frame, prose


def shingle_set(text):
    words = [w.encode().lower() for w in WORD.findall(text or "")]
    size = min(5, len(words))
    return {tuple(words[i:i + size]) for i in range(len(words) - size + 1)}


def kept_ids(texts):
    """Ids of one text per connected group of all pairs at 0.8 or more."""
    sets, parent = {i: shingle_set(t) for i, t in texts.items()}, {i: i for i in texts}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                low, high = sorted((root(a), root(b)))
                parent[high] = low
    return {root(i) for i in texts}


def edited(text, words, seed):
    rng, out = random.Random(seed), text.split(" ")
    for place in rng.sample(range(len(out)), words):
        out[place] = f"new{rng.randrange(10 ** 6)}"
    return " ".join(out)


def planted():
    """Ten texts each with copies of 1, 2, 4, 8 and 40 replaced words, and one text with 60 near copies."""
    texts = {}
    for i in range(10):
        base = prose(500 + i, 400)
        texts[100 * i] = base
        texts |= {100 * i + n: edited(base, n, 100 * i + n) for n in (1, 2, 4, 8, 40)}
    base = prose(900, 300)
    return texts | {5000 + i: edited(base, 1 + i % 6, 5000 + i) for i in range(60)}


@pytest.mark.parametrize("function", [near_copies.keep_first, lambda docs: corpus_pipeline.near_duplicates_stage(None, docs, "")])
def test_stage_keeps_one_of_each_group_as_all_pairs_do(spark, function):
    texts = planted()
    got = {r["doc_id"] for r in function(frame(spark, [(i, t, "en", "a") for i, t in texts.items()])).collect()}
    assert got == kept_ids(texts)
    assert {100 * i + 8 for i in range(10)}.isdisjoint(got)


def test_awkward_rows(docs, empty):
    rows = near_copies.keep_first(docs)
    assert rows.columns == docs.columns
    got = [r["doc_id"] for r in rows.collect()]
    texts = {r[0]: r[1] for r in awkward() if r[0] is not None and (r[1] or "").strip()}
    assert sorted(i for i in got if i) == sorted({1} | kept_ids(texts)) and got.count(None) == 1
    assert near_copies.keep_first(empty).count() == 0


def test_an_id_on_two_texts_loses_neither(spark):
    a, b = prose(1, 50), prose(2, 50)
    got = near_copies.keep_first(frame(spark, [(5, a, "en", "a"), (5, b, "en", "a"), (3, b, "en", "a")])).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == [(3, b), (5, a)]


def hot_group(kind, size, words=60, edits=(1, 2), seed=3):
    """A text and ``size`` - 1 edits of it: words replaced, put in, taken out, or any of these."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(words)]
    texts = {0: " ".join(base)}
    for i in range(1, size):
        out = list(base)
        for _ in range(rng.randint(*edits)):
            place, how = rng.randrange(len(out)), rng.choice("rid") if kind == "any" else kind
            out[place:place + (how != "i")] = [] if how == "d" else [f"new{rng.randrange(10 ** 6)}"]
        texts[i] = " ".join(out)
    return texts


@pytest.mark.parametrize("kind", ["r", "i", "d", "any"])
def test_large_groups_keep_what_all_pairs_keep(spark, kind):
    texts = hot_group(kind, 700, words=90, edits=(1, 5))
    got = {r["doc_id"] for r in near_copies.keep_first(frame(spark, [(i, t, "en", "a") for i, t in texts.items()])).collect()}
    want = kept_ids(texts)
    assert want <= got and len(got - want) <= 0.02 * (len(texts) - len(want)) + 1


def test_no_link_of_a_large_group_is_missed(spark, monkeypatch):
    """near copies of a text that is not there itself, in bands of far more texts than each meets as neighbours."""
    monkeypatch.setattr(near_copies, "BLOCK", 40)
    texts = hot_group("any", 1500, words=90, edits=(1, 5))
    del texts[0]
    rows = frame(spark, [(i, t, "en", "a") for i, t in texts.items()])
    assert {r["doc_id"] for r in near_copies.keep_first(rows).collect()} == kept_ids(texts)


def test_comparisons_grow_with_the_texts(spark, monkeypatch):
    """Pairs that are compared in one group of near copies, for a group of 1,250 and one of 5,000."""
    met = []
    monkeypatch.setattr(near_copies, "_near", lambda pairs, sets, plain=near_copies._near: met.append(pairs.count()) or plain(pairs, sets))
    made = {}
    for size in (1250, 5000):
        met.clear()
        rows = frame(spark, [(i, t, "en", "a") for i, t in hot_group("any", size, words=80, edits=(1, 6)).items()])
        near_copies.keep_first(rows).count()
        made[size] = sum(met)
    assert made[5000] <= 8 * made[1250] and made[5000] <= 5000 * near_copies.BANDS * (near_copies.NEXT + 1)


def test_op3_links_count_too(spark):
    """fingerprints alike, shingle sets not: a passage repeated, and the same with a few more words."""
    passage = prose(41, 41)
    much = " ".join([passage] * 40)
    texts = {4: much, 2: f"{much} {prose(42, 20)}", 9: prose(43, 80)}
    prints = [simhash.fingerprint(t.encode()) for t in (texts[4], texts[2])]
    assert (prints[0] ^ prints[1]).bit_count() <= simhash.BITS and kept_ids(texts) == {2, 4, 9}
    rows = frame(spark, [(i, t, "en", "a") for i, t in texts.items()])
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates_stage(None, rows, "").collect()} == {2, 9}


def test_links_to_follow_stay_a_few_a_text(spark, monkeypatch):
    """The rows that the search for connected texts goes through, in one large group of near copies."""
    followed = []
    monkeypatch.setattr(simhash, "components", lambda edges, plain=simhash.components: followed.append(edges.count()) or plain(edges))
    texts = hot_group("any", 700, words=80, edits=(3, 9))
    rows = frame(spark, [(i, t, "en", "a") for i, t in texts.items()])
    near_copies.keep_first(rows, by_simhash=True).count()
    assert sum(followed) <= 4 * len(texts), followed

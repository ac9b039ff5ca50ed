"""SimHash, winnowing and secret scans against plain versions."""

import random

import pytest

import corpus_pipeline
from stratamart.llm import registry, secret_scan, simhash, winnowing
from stratamart.session import stage

from . import brute
from .fixtures import awkward, frame


def by_id(rows):
    return {r["doc_id"]: r for r in rows}


def test_near_duplicates_match_all_pairs(docs, empty):
    got = simhash.near_duplicates(docs).collect()
    prints = {r[0]: brute.simhash(r[1] or "") for r in awkward() if r[0] is not None}
    prints[0] = brute.simhash("no id at all")
    want = brute.components(prints)
    assert len(got) == len(awkward())
    for r in got:
        key = r["doc_id"] or 0
        assert r["fingerprint"] == f"{prints[key]:016x}"
        if key:
            assert r["component_id"] == want[key]
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("paired", [2, 64])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, paired):
    """Chains, dense clouds around one print, and strangers; both ways of treating a shared key."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for _ in range(3):
        centre = rng.getrandbits(64)
        prints |= {centre ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(60)}
    step = rng.getrandbits(64)
    for bit in range(0, 60, 2):  # a chain whose ends differ in 60 bits
        prints.add(step)
        step ^= 3 << bit
    distinct = stage(spark.createDataFrame([(simhash._signed(p),) for p in prints], "fp long"))
    roots = {r["fp"]: r["root"] for r in simhash.components(simhash.links(distinct)).collect()}
    want = brute.components({simhash._signed(p): p for p in prints})
    got = {}
    for p in prints:
        got.setdefault(roots.get(simhash._signed(p), simhash._signed(p)), set()).add(p)
    expected = {}
    for p in prints:
        expected.setdefault(want[simhash._signed(p)], set()).add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, expected.values()))


def test_one_row_of_each_group_stays(docs):
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    assert ids.count(6) == 1 and 7 not in ids and 8 not in ids
    assert ids.count(None) == 1
    assert by_id(rows)[5]["text"] == awkward()[4][1]


def test_marks_match_looking_at_every_window(docs, empty):
    got = winnowing.fingerprints(docs).collect()
    texts = {r[0]: r[1] or "" for r in awkward()}
    for r in got:
        assert [(m["hash"], m["position"]) for m in r["marks"]] == brute.marks(texts[r["doc_id"]], winnowing.K, winnowing.WIDTH)
    assert winnowing.fingerprints(empty).count() == 0


def test_rightmost_of_equal_minima(spark):
    text = "abcabcabcabc" * 20
    row = winnowing.fingerprints(frame(spark, [(1, text, "en", "a")])).first()
    assert [(m["hash"], m["position"]) for m in row["marks"]] == brute.marks(text, winnowing.K, winnowing.WIDTH)


def test_edited_texts(docs, spark, empty):
    got = winnowing.edited_likeness(docs.filter("doc_id is not null")).collect()
    texts = dict(sorted((r[0], r[1] or "") for r in awkward() if r[0] is not None))
    assert sorted(r["doc_id"] for r in got) == list(texts)  # the repeated row counts once
    ids = list(texts)
    for r in got:
        place = ids.index(r["doc_id"])
        text, following = texts[r["doc_id"]], texts[ids[(place + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = (brute.marks(t, winnowing.K, winnowing.WIDTH) for t in (text, edited, following))
        listed = lambda found: brute.sha(",".join(f"{h:x}:{p}" for h, p in found))
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), brute.sha(edited))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (listed(a), listed(b))
        assert r["near_edited"] == pytest.approx(brute.likeness(a, b)) and r["near_next"] == pytest.approx(brute.likeness(a, c))
    alone = winnowing.edited_likeness(frame(spark, [(5, "only one here é", "en", "a")])).collect()
    assert alone[0]["near_next"] == 1.0 and alone[0]["edited_sha256"] == brute.sha("only one" + "only on")
    assert winnowing.edited_likeness(empty).count() == 0


def scanned(docs):
    return secret_scan.digests(secret_scan.scan(docs))


def test_base_spans(docs, empty):
    got = scanned(docs).collect()
    texts = {r[0]: r[1] or "" for r in awkward()}
    assert len(got) == len(awkward())
    for r in got:
        spans = brute.base_spans(texts[r["doc_id"]])
        listed = [f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r["base_sha256"] == brute.sha(",".join(listed))
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(s[1] == k for s in spans) for k in range(3))
        assert set(listed) <= set(r["spans"].split(",")) | {""}
    assert scanned(empty).count() == 0


def test_widely_copied_values_are_not_live(docs):
    rows = by_id(scanned(docs).collect())
    assert rows[12]["n_live_base"] == 0 and rows[11]["n_live_base"] > 0  # three owners share the first
    assert "token:5:" in rows[17]["spans"] and "mixed:" in rows[17]["spans"]


def test_live_secrets_are_masked_and_copied_ones_stay(docs):
    rows = by_id(secret_scan.redact(docs).collect())
    assert rows[11]["text"] == 'token = "[SECRET]" and [SECRET]' and rows[11]["n_chars"] == len(rows[11]["text"])
    assert rows[12]["text"] == awkward()[11][1]
    assert rows[17]["text"] == "mine [SECRET] [SECRET] end"
    assert rows[1]["text"] is None and rows[5]["text"] == awkward()[4][1]


def test_many_spans_in_one_text(spark):
    text = " ".join(f"{i:020x}é" for i in range(1500))
    row = scanned(frame(spark, [(1, text, "en", "a")])).first()
    assert row["n_hex"] == 1500
    assert row["base_sha256"] == brute.sha(",".join(f"hex:{a}:{b}" for a, _, b in brute.base_spans(text)))


def test_copies_of_a_text_and_many_texts_of_an_owner_decide_the_verdict(spark, tmp_path):
    """A token in a document copied to four owners is live; a value in many texts of one owner is an example."""
    token, example = "ghp_Abcdefghijklmnopqrst012345", "password=abcdefabcdef1234567"
    rows = [(i, f"mine {token} end", "en", f"s{i}", None) for i in range(4)]
    rows += [(100 + i, f"text {i} {example}", "en", "hot", None) for i in range(secret_scan.REPOSITORIES + 1)]
    rows += [(200 + i, f"part {i} glpat-Abcdefghijklmnopqrst0123", "en", f"s{i}", None) for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(registry.op5_secret_scan(spark, str(tmp_path)).collect())
    for i in range(4):  # the token is a mixed string too
        assert (got[i]["spans"], got[i]["verdicts"]) == ("token:5:35,mixed:5:35", "live:1:1,live:1:1")
    for i in range(secret_scan.REPOSITORIES + 1):
        assert got[100 + i]["n_live_base"] == 0 and set(got[100 + i]["verdicts"].split(",")) == {f"example:1:{secret_scan.REPOSITORIES + 1}"}
    for i in range(3):
        assert got[200 + i]["spans"].startswith("token:7:") and set(got[200 + i]["verdicts"].split(",")) == {"example:3:3"}
    masked = by_id(corpus_pipeline.secrets_stage(spark, docs, str(tmp_path)).collect())
    assert masked[0]["text"] == masked[3]["text"] == "mine [SECRET] end"
    assert masked[100]["text"] == f"text 0 {example}" and masked[200]["text"] == rows[-3][1]


def test_every_owner_and_repository_is_counted(spark, tmp_path):
    """F8: copies count once for the verdict, and yet each row's owner and document is in the reported numbers."""
    token = "ghp_Abcdefghijklmnopqrst012345"
    rows = [(i, f"mine {token} end", "en", f"s{i}", None) for i in range(4)]
    rows += [(10 + i, f"other {i} {token}", "en", "s9", None) for i in range(2)] + [(20, "none", "en", "s0", None), (21, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = by_id(registry.op5_secret_scan(spark, str(tmp_path)).collect())
    for i in (0, 1, 2, 3, 10, 11):
        assert (got[i]["verdicts"], got[i]["ownership"]) == ("live:2:3,live:2:3", "5:6,5:6")
    assert (got[20]["spans"], got[20]["ownership"], got[21]["ownership"]) == ("", "", "")

"""Periodic runs, byte-level BPE and hard negatives against plain versions and the library."""

import base64
import random
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from stratamart.llm import byte_bpe, hard_negatives, periodic_runs, registry
from stratamart.llm.byte_bpe import ByteBpe

from .brute import WORD, sha
from .fixtures import awkward, frame

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# ---- periodic runs

def plain_runs(words):
    """Every period from the smallest on, every maximal stretch; a stretch keeps its first period."""
    number = {}
    codes, found = np.array([number.setdefault(w, len(number)) for w in words], np.int64), {}
    for period in range(1, len(words) // 4 + 1):
        change = np.diff(np.concatenate([[0], codes[:-period] == codes[period:], [0]]))
        for first, last in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            if last - first + period >= max(6, 4 * period):
                found.setdefault((first, last - first + period), period)
    return sorted((s, l, p) for (s, l), p in found.items())


def plain_report(doc_id, text):
    words = WORD.findall(text or "")
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    dropped = {i for s, l, p in runs for i in range(s + p, s + l)}
    return (doc_id, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{l},{p}\n" for s, l, p in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def numbered(words):
    return np.array([ord(w) for w in words], np.int64)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=60), min_size=1, max_size=6))
def test_runs_of_small_alphabets(texts):
    found = periodic_runs.find_runs([numbered(t) for t in texts])
    assert [list(map(tuple, r.tolist())) for r in found] == [plain_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=9), st.integers(1, 9), st.integers(0, 8)), min_size=1, max_size=5))
def test_runs_of_repeated_units(parts):
    text = "".join(unit * times + unit[:more] for unit, times, more in parts)
    assert list(map(tuple, periodic_runs.find_runs([numbered(text)])[0].tolist())) == plain_runs(text)


def test_common_extensions_are_those_of_comparing_words():
    rng = np.random.default_rng(1)
    symbols = np.append(rng.integers(0, 2, 300), 2)
    symbols[100:160] = symbols[20:80]
    ahead = periodic_runs.Extensions(symbols)
    i, j = (x.ravel() for x in np.meshgrid(np.arange(301), np.arange(301)))
    i, j = i[i != j], j[i != j]
    text = symbols.tolist()
    want = [next((k for k in range(301) if max(a, b) + k >= 301 or text[a + k] != text[b + k]), 0) for a, b in zip(i, j)]
    assert ahead(i, j).tolist() == want


def test_a_long_document_and_split_grids(monkeypatch):
    words = [random.Random(3).randrange(4000) for _ in range(6000)]
    words[1000:3000] = (words[1000:1037] * 60)[:2000]
    words[4000:4100] = [7] * 100
    monkeypatch.setattr(periodic_runs, "_PAIRS", 500)
    found = periodic_runs.find_runs([np.array(words), np.array([5] * 20), np.array([], np.int64)])
    assert [list(map(tuple, r.tolist())) for r in found] == [plain_runs(words), [(0, 20, 1)], []]


def period_rows():
    rows = awkward() + [(300 + i, f"{'go on ' * (2 + i)}and {'stop ' * i}now", "en", "p") for i in range(20)]
    return rows + [(i, " ".join(str(k) for k in range(i % 90)), "en", "q") for i in range(1000, 1200)]


def test_query_is_the_plain_report_of_every_document(spark, tmp_path, rows):
    frame(spark, period_rows()).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = registry.op11_periodic_runs(spark, str(tmp_path))
    want = [plain_report(r[0], r[1]) for r in period_rows()]
    assert Counter(map(tuple, got.collect())) == Counter(want)
    assert sum(1 for w in want if w[1]) > 20


def test_runs_and_collapse_keep_ids_and_columns(docs, empty, spark):
    listed = Counter((r["doc_id"], r["start"], r["length"], r["period"]) for r in periodic_runs.runs(docs).collect())
    want = Counter((r[0], *run) for r in awkward() for run in plain_runs(WORD.findall(r[1] or "")))
    assert listed == want
    shorter = periodic_runs.collapse(frame(spark, [(1, "a  b a b a b a b end", "en", "s"), (2, "a  b", "en", "s"), (3, None, None, None)]))
    assert {r["doc_id"]: r["text"] for r in shorter.collect()} == {1: "a b end", 2: "a  b", 3: None}
    assert shorter.columns == docs.columns
    assert periodic_runs.runs(empty).count() == periodic_runs.collapse(empty).count() == 0


# ---- byte-level BPE

def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


ODD = ["", " ", "  a  b ", "\n\t x", "日本語のとても長い文章" * 40, "\U0001F600 é \x00 z", "a\x1c b\x85c d", "x" * 3000, "ab" * 2500,
       "it's  he'll 12 3,4 <|endoftext|> x", "　 b", "Donaudampfschifffahrtsgesellschaft", "!!!!" * 500, "\n" * 700 + " " * 900 + "e"]


READY = ByteBpe.load(RANKS, public_tokenizers.PATTERN), library()


@pytest.fixture
def bpe():
    return READY[0]


def test_ids_are_those_of_the_library(bpe):
    known = READY[1]
    for text in ODD:
        ids = bpe.encode(text)
        assert ids.tolist() == known.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode() and bpe.digits(ids) == " ".join(map(str, ids))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60) | st.text("aehilnst ", max_size=300))
def test_any_text_has_the_librarys_ids(text):
    assert READY[0].encode(text).tolist() == READY[1].encode_ordinary(text)


@settings(max_examples=200, deadline=None)
@given(st.text("ab", min_size=1, max_size=40), st.permutations(["aa", "ab", "ba", "bb", "aab", "abb", "aaaa", "abab", "bba"]))
def test_leftmost_smallest_pair_is_merged_first(text, order):
    ranks = {b"a": 0, b"b": 1} | {t.encode(): 2 + n for n, t in enumerate(order)}
    parts = [c.encode() for c in text]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not pairs:
            break
        i = min(pairs)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    whole = text.encode()
    assert byte_bpe.merge(whole, ranks) == ([ranks[whole]] if whole in ranks else [ranks[p] for p in parts])


def test_long_texts_are_split_piece_by_piece(bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG", 10)
    text = awkward()[4][1]
    assert bpe.encode(text).tolist() == READY[1].encode_ordinary(text)


def test_query_and_frames(spark, docs, empty, bpe, tmp_path):
    known = READY[1]
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter(map(tuple, registry.op12_byte_bpe(spark, str(tmp_path)).collect()))
    ids = [(r[0], known.encode_ordinary(r[1] or ""), r[1] or "") for r in awkward()]
    assert got == Counter((i, len(t), sha(" ".join(map(str, t))), sha(text)) for i, t, text in ids)
    encoded = byte_bpe.encode(docs, bpe)
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in encoded.collect()) == Counter((i, tuple(t)) for i, t, _ in ids)
    assert Counter((r["doc_id"], r["text"]) for r in byte_bpe.decode(encoded, bpe).collect()) == Counter((i, text) for i, _, text in ids)
    assert byte_bpe.encode(empty, bpe).count() == byte_bpe.decode(byte_bpe.encode(empty, bpe), bpe).count() == 0
    broken = spark.sql("SELECT 1L doc_id, cast(x'61ff62' AS string) text")
    assert [r["text"] for r in byte_bpe.decode(byte_bpe.encode(broken, bpe), bpe).collect()] == ["a�b"]


# ---- hard negatives

def plain_negatives(vectors):
    """``vectors``: (id, label, components); all scores, all sorted."""
    rows = []
    for i, label, xs in vectors:
        if label is not None and xs is not None and all(x is not None and np.isfinite(x) for x in xs):
            label = (label + 1) % 10 if i is not None and i % 7 == 0 else label
            rows.append((i, label, [int(np.floor(256 * x)) for x in xs]))
    last = float("inf")
    out = []
    for n, (anchor, label, a) in enumerate(rows):
        if anchor is None or anchor % 50:
            continue
        scored = [(-sum(p * q for p, q in zip(a, b)), last if i is None else i, other) for m, (i, other, b) in enumerate(rows) if m != n]
        for s, i, other in sorted(s for s in scored if s[2] == label)[:5]:
            fits = sorted(t for t in scored if t[2] != label and 50 * -s <= 100 * -t[0] <= 95 * -s)[:3]
            out += [(anchor, None if i == last else i, rank + 1, None if t[1] == last else t[1], -s, -t[0]) for rank, t in enumerate(fits)]
    return Counter(out)


def vectors(n, width, seed, labels=4, spread=1.0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, width))
    return [(i, int(rng.integers(labels)), (centres[i % labels] * 0.5 + rng.normal(size=width) * spread).astype(np.float32).tolist())
            for i in range(n)]


def vector_frame(spark, data):
    return spark.createDataFrame([(i, label, xs, "a", "b", "c", "d") for i, label, xs in data],
                                 "vec_id long, label int, embedding array<float>, score string, row string, block string, other string")


def mined(spark, data, **sizes):
    rows = hard_negatives.shifted_labels(vector_frame(spark, data).repartition(3))
    return Counter(map(tuple, hard_negatives.mine(rows, F.col("id") % 50 == 0, **sizes).collect()))


@pytest.mark.parametrize("sizes", [{}, {"block_rows": 60, "group_rows": 3}])
def test_negatives_are_those_of_all_scores(spark, sizes):
    data = vectors(400, 20, 1)
    got = mined(spark, data, **sizes)
    assert got == plain_negatives(data) and len(got) > 50


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    data = vectors(200, 6, 2, labels=2, spread=0.3)
    same = data[50]
    # Ties, repeated ids and rows, null ids, labels and vectors, components without a value, shorter and empty vectors, a hot vector.
    data += [same, same, (50, 3, same[2]), (None, same[1], same[2]), (None, 3, same[2]), (600, None, same[2]), (650, 1, None), (700, 1, [nan] * 6),
             (750, 1, [inf] + [0.0] * 5), (800, 1, [None] + [0.0] * 5), (850, 1, [0.5, 0.25]), (900, 1, []), (950, 2, [0.0] * 6)]
    data += [(1000 + i, i % 3, [0.5] * 6) for i in range(150)]
    assert mined(spark, data, block_rows=40, group_rows=2) == plain_negatives(data)
    assert hard_negatives.mine(vector_frame(spark, data).limit(0), F.col("id") % 50 == 0).count() == 0
    assert mined(spark, [(50, 1, [1.0])]) == Counter()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10 ** 6), st.integers(1, 30), st.integers(1, 60))
def test_candidates_left_out_cannot_be_among_the_best(seed, width, n):
    rng = np.random.default_rng(seed)
    columns, anchor, ids = rng.integers(-40, 40, (width, n)), rng.integers(-40, 40, width), rng.permutation(n)
    score = anchor @ columns
    order = np.lexsort((ids, -score))
    block = hard_negatives.Block(columns)
    places, got = hard_negatives.nearest(block, ids, anchor, np.arange(n), 5)
    assert places.tolist() == order[:5].tolist() and got.tolist() == score[order[:5]].tolist()
    windows = [(-100, 50), (0, 400), (7, 7)]
    for (low, high), (places, got) in zip(windows, hard_negatives.within(block, ids, anchor, np.arange(n), windows, 3)):
        want = [p for p in order if low <= score[p] <= high][:3]
        assert places.tolist() == want and got.tolist() == score[want].tolist()

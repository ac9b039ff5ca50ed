"""Encoders, token files and packing against the libraries."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from sentencepiece import sentencepiece_model_pb2 as model_format
from tokenizers import Tokenizer

import corpus_pipeline
from stratamart.llm import packing, registry, token_files
from stratamart.llm.bpe import BpeEncoder
from stratamart.llm.differencing import differencing
from stratamart.llm.sentencepiece_codec import CharacterMap, Codec, Normaliser, decode, encode

from .fixtures import awkward

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BPE = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  a  b ", "\n\t x", "日本語 ▁a▁ b", "\U0001F600 é \x00 z", "a b\x1c c", "x" * 3000,
       "a  b   c\n\n d   e\x85 g", "it's  he'll 12 3,4 <|endoftext|> x", "\x1c a\x1c b", " 　 b"]


def test_pieces_and_spans_are_those_of_the_library():
    codec, library = Codec.load(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    for text in ODD:
        found = codec.encode([text])[0]
        assert found.ids == library.encode(text)
        assert codec.decode(found.ids) == library.decode(library.encode(text))
        assert list(found.starts[1:]) == list(found.ends[:-1])
        if found.ids:
            assert (found.starts[0], found.ends[-1]) == (0, len(text.encode()))
        for (piece, start, end) in zip(found.ids, found.starts, found.ends):
            surface = library.id_to_piece(piece).replace("▁", " ")
            if not surface.startswith("<0x") and "▁" not in text:
                assert text.encode()[start:end].decode() in (surface, surface[1:])


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=80))
def test_any_text_round_trips(text):
    codec, library = Codec.load(PIECES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    found = codec.encode([text])[0]
    assert found.ids == library.encode(text)
    assert codec.decode(found.ids) == library.decode(found.ids)


@pytest.mark.parametrize("trim", [False, True])
def test_character_map_gives_the_librarys_normal_form_and_offsets(trim):
    plain = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    spec = model_format.ModelProto.FromString(plain.serialized_model_proto())
    spec.normalizer_spec.remove_extra_whitespaces = trim
    library = sentencepiece.SentencePieceNormalizer(
        model_proto=spec.SerializeToString(), add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=trim)
    ours = Normaliser(CharacterMap(spec.normalizer_spec.precompiled_charsmap), True, trim, True, False)
    for text in [*ODD, "ﬁne ①②  Ｆｕｌｌ　width ㌀ ", "Å Å ｱｲｳ ガ が"]:
        normal, offsets = library.normalize(text, with_offsets=True)
        found, origin = ours(text.encode())
        assert found.decode() == normal
        assert origin[-1] <= len(text.encode()) and (np.diff(origin) >= 0).all()


def test_encode_and_decode_frames(docs, empty):
    codec = Codec.load(PIECES)
    encoded = encode(docs, codec)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = sorted(((r[0] or 0, library.encode(r[1] or "")) for r in awkward()))
    assert sorted((r["doc_id"] or 0, r["ids"]) for r in encoded.collect()) == want
    back = {r["doc_id"]: r["text"] for r in decode(encoded, codec).collect()}
    assert back[7] == awkward()[6][1] and back[1] == ""
    assert encode(empty, codec).count() == 0


def library_ids(text):
    tokenizer = Tokenizer.from_file(BPE)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet=st.characters(blacklist_categories=["Cs"]) | st.sampled_from(" \n\t\x1c\x85　'aé1.,"), max_size=60))
def test_bpe_ids_are_those_of_the_whole_text(text):
    assert np.frombuffer(BpeEncoder.load(BPE).encode(text), "<u4").tolist() == library_ids(text)


def test_odd_bpe_texts():
    for text in ODD:
        assert np.frombuffer(BpeEncoder.load(BPE).encode(text), "<u4").tolist() == library_ids(text)


def test_added_tokens_get_their_ids_as_in_an_untouched_library():
    library, encoder = Tokenizer.from_file(BPE), BpeEncoder.load(BPE, marks_as_text=False)
    assert library.encode("a <|endoftext|> b", add_special_tokens=False).ids == [64, 220, 50256, 275]
    mark = "<|endoftext|>"
    for text in [*ODD, mark, mark * 2, f"a {mark} b", f"a{mark}b", f"x \n{mark}\n  y", f"{mark} a", "<|endof text|>",
                 f"{'one two. ' * 2000}{mark} it's  he'll"]:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_token_queries_and_the_packing_stage_keep_added_tokens(spark, tmp_path):
    texts = {1: "a <|endoftext|> b", 2: "plain words", 3: None}
    rows = [(k, t, "en", "a", len(t or "")) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    library, start = Tokenizer.from_file(BPE), 0
    ids = {k: library.encode(t or "", add_special_tokens=False).ids for k, t in texts.items()}
    crc = lambda found: zlib.crc32(np.array(found, "<u4").tobytes())
    got = {r["doc_id"]: r for r in registry.op7_token_files(spark, str(tmp_path)).collect()}
    for k in texts:
        want = [*ids[k], registry.FILE_END]
        assert (got[k]["start"], got[k]["n_tokens"], got[k]["ids_crc32"]) == (start, len(want), crc(want))
        start += len(want)
    for packed in (registry.op9_packing(spark, str(tmp_path)),
                   corpus_pipeline.packing_stage(spark, spark.read.parquet(f"{tmp_path}/documents.parquet"), str(tmp_path))):
        for r in packed.collect():
            want = [*ids[r["doc_id"]], registry.PACK_END]
            assert (r["doc_tokens"], r["ids_crc32"]) == (len(want), crc(want))


def test_token_files_read_back_in_order(docs, empty):
    encoder = BpeEncoder.load(BPE)
    manifest = token_files.write(docs, encoder, 2, shards=4)
    got = token_files.read(manifest, lambda key, start, ids: (key, start, ids.tolist()),
                           "doc_id long, start long, ids array<long>").collect()
    got = sorted(got, key=lambda r: r["start"])
    rows = sorted(awkward(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    start = 0
    for row, (_, text, *_) in zip(got, rows):
        assert (row["start"], row["ids"]) == (start, [*library_ids(text or ""), 2])
        start += len(row["ids"])
    assert {r["width"] for r in manifest.collect()} == {2}
    assert token_files.read(token_files.write(empty, encoder, 2), lambda *a: a, "a long, b long, c long").count() == 0


def test_differencing_balances_and_keeps_every_number():
    rng = np.random.default_rng(3)
    sizes = rng.integers(1, 257, 500).tolist()
    groups = differencing(sizes, 65)
    assert sorted(i for g in groups for i in g) == list(range(500))
    sums = [sum(sizes[i] for i in g) for g in groups]
    assert max(sums) - min(sums) <= 16
    assert differencing([], 3) == [] and differencing([5], 3) == [[0]] and differencing([4, 4], 1) == [[0, 1]]


def test_windows_rise_until_none_exceeds_the_capacity():
    assert sorted(map(sorted, packing.windows([700, 700, 700], 1024))) == [[0], [1], [2]]
    assert packing.windows([1024], 1024) == [[0]]


def test_packing_is_a_partition_with_little_padding(docs, empty, spark):
    encoder = BpeEncoder.load(BPE)
    rows = packing.pack(docs.coalesce(1), encoder, 0).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], r["length"], r["ids"]))
    for doc_id, text, *_ in awkward():
        want = [*library_ids(text or ""), 0]
        pieces = sorted(set(by_doc[doc_id, len(want)]))
        assert np.frombuffer(b"".join(p[2] for p in pieces), "<u4").tolist() == want
        assert [p[0] for p in pieces] == [sum(p[1] for p in pieces[:i]) for i in range(len(pieces))]
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        parts.sort()
        assert [p[0] for p in parts] == [sum(p[1] for p in parts[:i]) for i in range(len(parts))]
        assert sum(p[1] for p in parts) <= packing.CAPACITY
    total = sum(r["length"] for r in rows)
    assert len(sequences) <= total / packing.CAPACITY * 1.02 + 1
    assert packing.pack(empty, encoder, 0).count() == 0


def test_a_full_window_leaves_no_rest():
    assert list(packing.cut(2048, 1024, 256)) == [(0, 1024, True), (1024, 1024, True)]
    assert [c[:2] for c in packing.cut(1500, 1024, 256)] == [(0, 1024), (1024, 238), (1262, 238)]
    assert zlib.crc32(b"") == 0

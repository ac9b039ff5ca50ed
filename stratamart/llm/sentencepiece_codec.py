"""SentencePiece encoding that keeps source offsets, and decoding.

Normalisation is done here: at each place the longest prefix found in the model's compiled character map is
replaced (else one character is kept), and every normalised byte records the source byte it came from. The
library then segments the normalised text with its own normaliser switched off. Pieces cover the normalised text
without gaps, so their lengths and the alignment give each piece's byte span in the original text.

Defined results: a null text counts as empty; an empty text has no pieces and decodes to an empty text; rows are
independent, so repeated rows, ties and other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import texts

SPACE = "▁"
_SPACE_BYTES = SPACE.encode()
BYTE_PIECE, USER_PIECE = 6, 4  # piece types of the model format


class CharacterMap:
    """The compiled map: a double-array trie over UTF-8 bytes, and the replacement strings it points into."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob[4:4 + size], "<u4").tolist()
        self.strings = blob[4 + size:]

    def longest(self, text: bytes, at: int) -> tuple[int, bytes] | None:
        """Length of the longest mapped prefix of ``text[at:]``, and its replacement."""
        if not self.units:
            return None
        found = None
        unit = self.units[0]
        node = _child_base(unit)
        for place in range(at, len(text)):
            byte = text[place]
            node ^= byte
            if node >= len(self.units):
                break
            unit = self.units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= _child_base(unit)
            if unit >> 8 & 1:
                found = place + 1 - at, self.units[node] & 0x7FFFFFFF
        if found is None:
            return None
        start = found[1]
        return found[0], self.strings[start:self.strings.index(b"\0", start)]


def _child_base(unit: int) -> int:
    return unit >> 10 << ((unit & 1 << 9) >> 6)


def _char_length(first: int) -> int:
    return 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4


@dataclass
class Normaliser:
    """The model's normalisation rules; ``symbols`` are user-defined pieces, which are kept as they are."""

    charmap: CharacterMap
    dummy_prefix: bool
    trim: bool
    escape: bool
    suffix: bool
    symbols: tuple[bytes, ...] = ()

    def prefix(self, text: bytes, at: int) -> tuple[int, bytes]:
        """Source bytes consumed at ``at``, and what stands for them."""
        symbol = max((s for s in self.symbols if text.startswith(s, at)), key=len, default=None)
        if symbol:
            return len(symbol), symbol
        mapped = self.charmap.longest(text, at)
        if mapped:
            return mapped
        length = _char_length(text[at])
        return length, text[at:at + length]

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes, and for each of them and the end the source byte where it begins."""
        space = _SPACE_BYTES if self.escape else b" "
        if not text:
            return b"", np.zeros(1, np.int64)
        if not (self.charmap.units or self.trim or self.suffix or self.symbols):
            # No rule applies: every longest prefix is one character, so the alignment is a running count.
            source = np.frombuffer(text, np.uint8)
            origin = np.repeat(np.arange(len(source)), np.where(source == 32, len(space), 1))
            lead = space if self.dummy_prefix else b""
            return (lead + text.replace(b" ", space),
                    np.concatenate([np.zeros(len(lead), np.int64), origin, [len(source)]]))
        at, out, origin = 0, bytearray(), []
        if self.trim:
            while at < len(text):
                length, piece = self.prefix(text, at)
                if piece != b" ":
                    break
                at += length
            if at == len(text):
                return b"", np.array([at], np.int64)

        def put(piece: bytes, start: int) -> None:
            out.extend(piece)
            origin.extend([start] * len(piece))

        if self.dummy_prefix and not self.suffix:
            put(space, at)
        after_space = self.trim
        while at < len(text):
            length, piece = self.prefix(text, at)
            if after_space:
                piece = piece.lstrip(b" ")
            if piece:
                put(piece.replace(b" ", space), at)
                after_space = piece.endswith(b" ")
            at += length
            after_space = after_space and self.trim
        if self.trim:
            while out.endswith(space):
                del out[-len(space):]
                at = origin[len(out)]
                del origin[len(out):]
        if self.dummy_prefix and self.suffix:
            put(space, at)
        return bytes(out), np.array([*origin, at], np.int64)


@dataclass
class Encoded:
    """Ids of one text, and where in its bytes each piece begins and ends."""

    ids: list[int]
    starts: np.ndarray
    ends: np.ndarray


class Codec:
    """A model file's bytes as encoder and decoder; travels to the executors as those bytes."""

    def __init__(self, model: bytes):
        self.model = model
        self._ready = None

    def __getstate__(self):
        return {"model": self.model, "_ready": None}

    @classmethod
    def load(cls, path: str) -> "Codec":
        with open(path, "rb") as file:
            return cls(file.read())

    def _parts(self):
        if self._ready is None:
            import sentencepiece
            from sentencepiece import sentencepiece_model_pb2 as format

            proto = format.ModelProto.FromString(self.model)
            spec = proto.normalizer_spec
            symbols = tuple(p.piece.encode() for p in proto.pieces if p.type == USER_PIECE)
            normaliser = Normaliser(CharacterMap(spec.precompiled_charsmap), spec.add_dummy_prefix,
                                    spec.remove_extra_whitespaces, spec.escape_whitespaces,
                                    proto.trainer_spec.treat_whitespace_as_suffix, symbols)
            lengths = np.array([1 if p.type == BYTE_PIECE else len(p.piece.encode()) for p in proto.pieces], np.int64)
            decoder = sentencepiece.SentencePieceProcessor(model_proto=self.model)
            spec.name, spec.precompiled_charsmap = "identity", b""
            spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
            segmenter = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
            known = lengths if proto.trainer_spec.byte_fallback else None  # else an unknown piece has any length
            self._ready = normaliser, segmenter, decoder, known
        return self._ready

    def encode(self, sources: list[str]) -> list[Encoded]:
        normaliser, segmenter, _, lengths = self._parts()
        normalised = [normaliser(s.encode()) for s in sources]
        plain = [n.decode() for n, _ in normalised]
        if lengths is None:
            found = [[(p.id, len(p.surface.encode())) for p in s.pieces]
                     for s in segmenter.encode(plain, out_type="proto", num_threads=1)]
            ids = [[i for i, _ in f] for f in found]
            sizes = [np.array([n for _, n in f], np.int64) for f in found]
        else:
            ids = segmenter.encode(plain, num_threads=1)
            sizes = [lengths[np.array(i, np.int64)] for i in ids]
        out = []
        for pieces, size, (_, origin) in zip(ids, sizes, normalised):
            ends = np.cumsum(size)
            out.append(Encoded(pieces, origin[ends - size], origin[ends]))
        return out

    def decode(self, ids: list[int]) -> str:
        return self._parts()[2].decode(ids) if ids else ""


# Texts that one library call takes; bounds the pieces held at a time.
CALL_ROWS = 64


def map_encoded(docs: DataFrame, codec: Codec, schema: str, finish: Callable[[list[str], list[Encoded]], dict],
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode every text; ``finish`` turns texts and pieces into the output columns after the id."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, CALL_ROWS):
                part = batch.slice(first, CALL_ROWS)
                sources = texts(part.column(text_col))
                out = {id_col: part.column(id_col), **finish(sources, codec.encode(sources))}
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v, pa.Array) else pa.array(v) for v in out.values()], names=list(out))

    return docs.select(id_col, text_col).mapInArrow(run, f"{id_col} {kind}, {schema}")


def encode(docs: DataFrame, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``ids``, and ``starts`` and ``ends`` of the pieces as byte offsets in the original UTF-8 text."""
    def finish(_, encoded):
        numbers = pa.list_(pa.int32())
        return {"ids": pa.array([e.ids for e in encoded], numbers),
                "starts": pa.array([e.starts for e in encoded], numbers),
                "ends": pa.array([e.ends for e in encoded], numbers)}

    return map_encoded(docs, codec, "ids array<int>, starts array<int>, ends array<int>", finish, id_col, text_col)


def decode(encoded: DataFrame, codec: Codec, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: ``text`` for the ids; null ids count as none."""
    kind = encoded.schema[id_col].dataType.simpleString()

    def run(batches):
        for batch in batches:
            plain = [codec.decode(i or []) for i in batch.column(ids_col).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(plain, pa.string())], [id_col, "text"])

    return encoded.select(id_col, ids_col).mapInArrow(run, f"{id_col} {kind}, text string")
